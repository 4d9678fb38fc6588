"""Counters of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.intervals import ratio

DIGEST = ("reads", "sites_cut", "monomers_generated", "monomers_short_removed", "monomers_kept", "reads_multi_monomer", "reads_lt2_monomers", "pairs")
GUIDED = ("reads", "monomers_generated", "monomers_short_removed", "monomers_kept", "reads_multi_monomer", "reads_lt2_monomers", "pairs", "cuts")


def counter_columns(mode: str = "all") -> list[Column]:
    """Sums over reads with their cuts; null without reads, but for the number of reads."""
    made, kept = F.size("made"), F.size("kept")
    pairs = kept * (kept - 1) / 2 if mode == "all" else kept - 1
    total = lambda x, name: F.sum(x.cast("bigint")).alias(name)
    return [
        F.count(F.lit(1)).alias("reads"),
        total(F.col("n_sites"), "sites_cut"),
        total(made, "monomers_generated"),
        total(made - kept, "monomers_short_removed"),
        total(kept, "monomers_kept"),
        total(kept >= 2, "reads_multi_monomer"),
        total(kept < 2, "reads_lt2_monomers"),
        total(F.when(kept >= 2, pairs).otherwise(0), "pairs"),
    ]


def counters(cuts: DataFrame, mode: str = "all") -> DataFrame:
    """One row of all counters; each task sums its reads first."""
    row = cuts.agg(*counter_columns(mode))
    return row.select([F.coalesce(F.col(c), F.lit(0)).alias(c) for c in row.columns]).withColumn("cuts", F.col("sites_cut"))


def observe(cuts: DataFrame, mode: str = "all") -> tuple[DataFrame, Observation]:
    """``cuts``, which count themselves as they pass on to what an action writes: no job of its own."""
    seen = Observation()
    return cuts.observe(seen, *counter_columns(mode)), seen


def observed_metrics(spark: SparkSession, seen: Observation, names: tuple[str, ...]) -> DataFrame:
    """(metric, value) of counters that an action has collected."""
    got = seen.get
    value = {n: int(got.get("sites_cut" if n == "cuts" else n) or 0) for n in names}
    return spark.createDataFrame(list(value.items()), "metric string, value bigint").coalesce(1)


def as_metrics(row: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The one row as (metric, value)."""
    each = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names]
    return row.select(F.explode(F.array(*each)).alias("m")).select("m.metric", "m.value")


def digest_stats(cuts: DataFrame, mode: str = "all") -> DataFrame:
    return as_metrics(counters(cuts, mode), DIGEST)


def guided_stats(cuts: DataFrame) -> DataFrame:
    return as_metrics(counters(cuts, "all"), GUIDED)


def per_read(cuts: DataFrame) -> DataFrame:
    """Kept monomers a read, 0 without reads."""
    kept: Column = F.coalesce(F.sum(F.size("kept").cast("bigint")), F.lit(0))
    return cuts.agg(F.count("*").alias("reads"), kept.alias("kept")).withColumn("monomers_per_read", ratio(F.col("kept"), F.col("reads")))


def genome_stats(reads: DataFrame) -> DataFrame:
    """Number, total and mean length of reads."""
    bases = F.coalesce(F.sum(F.col("len").cast("bigint")), F.lit(0))
    return reads.agg(F.count("*").alias("reads"), bases.alias("bases")).withColumn("mean_len", ratio(F.col("bases"), F.col("reads"), 1))
