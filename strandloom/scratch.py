"""Folders for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder that the driver and all executors share.

    That is ``spark.checkpoint.dir``. Where it is unset, it is the warehouse on a cluster, if that is in a shared store, and a temporary folder of this
    process with a local master, where all tasks run on this machine. A warehouse on the machines' own disks is an error. Nothing is deleted: what was written is
    read lazily by results, so whoever owns the folder empties it when the session has ended.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        local = spark.sparkContext.master.partition("[")[0] == "local"
        root = _own_folder() if local else f"{_shared(spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _shared(warehouse: str) -> str:
    if "://" not in warehouse or warehouse.startswith("file:"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share: the warehouse {warehouse} is on each machine's own disk")
    return warehouse


@cache
def _own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='spark-')}"
