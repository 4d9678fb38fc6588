"""Small helpers that several operators share: tables, scratch space, prefix sums and components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType
from pyspark.sql.window import Window

from strandloom.scratch import scratch

#: The words of the contracts are runs of anything but these ASCII characters.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: A side of more bytes is joined by shuffle, not broadcast.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``sf_dir``, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there."""
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_of(df: DataFrame) -> int:
    """Bytes of the values of ``df``, measured by one pass: 16 for a fixed-width value, and what strings and arrays hold."""

    def width(column: Column, kind) -> Column:
        if isinstance(kind, (StringType, BinaryType)):
            return F.lit(16) + F.coalesce(F.octet_length(column), F.lit(0))
        if isinstance(kind, (ArrayType, MapType, StructType)):
            return F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        return F.lit(16)

    each = reduce(lambda a, b: a + b, [width(F.col(f.name), f.dataType) for f in df.schema])
    return df.agg(F.coalesce(F.sum(each.cast("bigint")), F.lit(0))).first()[0]


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """``df``, a table at rest, with a broadcast hint if its measured size is within the bound, else as it is."""
    return F.broadcast(df) if size_of(df) <= BROADCAST_BYTES else df


def small_parts(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts in ``column`` have about ``size`` bytes in all; a longer text is a slice of its own.

    After a batch, a worker gives back the memory that its arrays no longer need.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths) // size
    ends = [*(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
    start = 0
    for end in ends:
        if end > start:
            yield batch.slice(start, end - start)
        start = end
    pa.default_memory_pool().release_unused()


def ordered_parts(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` written in ascending order of ``key``, with the file's number in column ``part``.

    Nulls come first. Rows with equal keys are in one part.
    """
    out = df.repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    return materialise(out.withColumn("part", F.spark_partition_id()), what)


def running_start(parts: DataFrame, key: str, amount: str, tie: list[str], start: str) -> DataFrame:
    """Add ``start``: the sum of ``amount`` over all rows before this one in the order of ``key``.

    ``parts`` comes from ``ordered_parts``. A task sums the rows of a part; the driver sees a
    total for each part only.
    """
    spark = parts.sparkSession
    totals = parts.groupBy("part").agg(F.sum(amount).alias("total")).orderBy("part").collect()
    before, offsets = 0, []
    for row in totals:
        offsets.append((row["part"], before))
        before += row["total"] or 0
    offset = spark.createDataFrame(offsets, "part int, part_start bigint")
    w = Window.partitionBy("part").orderBy(F.col(key).asc_nulls_first(), *tie).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(maybe_broadcast(offset), "part")
    return out.withColumn(start, F.col("part_start") + F.coalesce(F.sum(amount).over(w), F.lit(0))).drop("part_start")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component), the component's smallest node.

    Alternates the large-star and the small-star step (Kiveris et al., 2014) until the edges stay
    as they are; every step is a grouping and a join, and each round is written to the shared
    folder. Nodes without an edge to another node aren't listed.
    """
    edges = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = state(edges)
    for _ in range(rounds):
        if seen[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        )
        edges = materialise(
            small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), "edges"
        )
        before, seen = seen, state(edges)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def unused(df: DataFrame, name: str) -> str:
    """``name``, with marks in front until no column of ``df`` has it."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once for a row, also where ``body`` has lambdas."""
    return F.transform(F.array(value), body)[0]


def crc_remainder(column: str) -> Column:
    """crc32 of the column as text, modulo 4; 0 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0)) % 4
