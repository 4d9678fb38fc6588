"""Stages that are kept by buckets of one key, so that joins and groupings on it move none of their rows again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from strandloom.scratch import scratch


def bucketed(df: DataFrame, key: str, n: int, what: str) -> DataFrame:
    """``df`` as a table of ``n`` buckets by ``key``, one sorted file each, in the shared folder. One shuffle makes it; joins with another of as many need none."""
    name = f"strandloom_{what}_{uuid.uuid4().hex}"
    ready = df.repartition(n, key).sortWithinPartitions(key)
    ready.write.bucketBy(n, key).sortBy(key).option("path", scratch(df.sparkSession, what)).saveAsTable(name)
    return df.sparkSession.table(name)
