"""Stages whose results are kept, so that a run can go on where an earlier one ended."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def clock(seconds: float) -> str:
    """Seconds as h:mm:ss."""
    minutes, s = divmod(round(seconds), 60)
    return f"{minutes // 60}:{minutes % 60:02d}:{s:02d}"


class Manifest:
    """Named stages under one folder: each is a Parquet folder and, once it is whole, a line of the manifest.

    A stage with a line isn't run again, unless an earlier one was run in this session or its
    parameters differ; then it and all later ones are. The line (rows, seconds, parameters) is written last.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rerun = spark, path.rstrip("/"), False

    def _first(self, path: str) -> str | None:
        try:
            row = self.spark.read.text(path).first()
        except Exception as e:  # Spark's own class for a path that isn't there
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return row[0] if row else None

    def _line(self, name: str) -> dict | None:
        row = self._first(f"{self.path}/manifest/{name}")
        return json.loads(row) if row else None

    def stage(self, name: str, make: Callable[[], DataFrame], **parameters) -> DataFrame:
        kept = None if self.rerun else self._line(name)
        where = f"{self.path}/{name}"
        if kept is None or kept["parameters"] != parameters:
            self.rerun, began = True, time.time()
            make().write.mode("overwrite").parquet(where)
            line = {"rows": self.spark.read.parquet(where).count(), "seconds": round(time.time() - began, 3), "parameters": parameters}
            self.spark.range(1).select(F.lit(json.dumps(line)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/{name}")
            log.info("%s: %s rows in %s", name, line["rows"], clock(line["seconds"]))
        return self.spark.read.parquet(where)

    def put(self, key: str, value: object) -> None:
        """Keep a JSON value under a key, in place of the one that is there."""
        line = F.lit(json.dumps(value)).alias("value")
        self.spark.range(1).select(line).coalesce(1).write.mode("overwrite").text(f"{self.path}/values/{key}")

    def get(self, key: str, default: object = None) -> object:
        """The value of a key, or ``default``."""
        row = self._first(f"{self.path}/values/{key}")
        return default if row is None else json.loads(row)

    def forget(self, key: str) -> None:
        """No value under this key from now on."""
        self.spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.mode("overwrite").text(f"{self.path}/values/{key}")

    def counted(self, key: str, make: Callable[[], DataFrame]) -> int:
        """Rows of ``make()``, counted once and kept; counted again where a stage of this session has run."""
        kept = None if self.rerun else self.get(key)
        if kept is None:
            kept = make().count()
            self.put(key, kept)
        return kept

    def count(self, name: str) -> int | None:
        """Rows of a whole stage, from its line."""
        line = self._line(name)
        return line and line["rows"]

    def counts(self) -> DataFrame:
        """(name, value): the rows of each whole stage of this folder."""
        lines = self.spark.read.text(f"{self.path}/manifest/*").withColumn("name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        return lines.select("name", F.get_json_object("value", "$.rows").cast("bigint").alias("value"))
