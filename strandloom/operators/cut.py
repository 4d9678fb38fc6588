"""Cut reads into monomers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.intervals import at_least, between, cut_out
from strandloom.functions.motif import motif_starts


def _cut_at(reads: DataFrame, starts: Column, ends: Column, min_len: int) -> DataFrame:
    made = reads.withColumn("made", between(starts, ends, F.col("len")))
    return made.withColumn("kept", at_least(F.col("made"), min_len))


def digest_cuts(reads: DataFrame, motif: str, offset: int, dup: bool, min_len: int) -> DataFrame:
    """Reads with ``n_sites``, ``made`` (all monomers) and ``kept`` (those long enough), as arrays.

    Every non-overlapping motif is cut, case-sensitively. With ``dup`` a monomer ends after the motif and the
    next begins before it. Row-local: no shuffle, and valid on a stream.
    """
    reads = reads.withColumn("starts", motif_starts(F.col("seq"), motif))
    at = F.col("starts")
    shift = lambda by: F.transform(at, lambda s: s + by)
    cut = _cut_at(reads, at if dup else shift(offset), shift(len(motif)) if dup else shift(offset), min_len)
    return cut.withColumn("n_sites", F.size("starts").cast("bigint")).drop("starts")


def guided_cuts(reads: DataFrame, sites_final: DataFrame, dup: bool, min_len: int) -> DataFrame:
    """The same, cut at the sites of class C only; reads without one stay whole."""
    at = sites_final.where(F.col("class") == "C").groupBy("read_idx").agg(F.array_sort(F.collect_list(F.struct("x", "motif_start", "motif_end"))).alias("at"))
    reads = reads.join(at, "read_idx", "left")
    field = lambda name: F.coalesce(F.transform("at", lambda s: s[name]), F.array().cast("array<bigint>"))
    cut = _cut_at(reads, field("motif_start" if dup else "x"), field("motif_end" if dup else "x"), min_len)
    return cut.withColumn("n_sites", F.coalesce(F.size("at"), F.lit(0)).cast("bigint")).drop("at")


def monomers(cuts: DataFrame) -> DataFrame:
    """(read_idx, read_id, rank, beg, end, seq, qual): a row for each kept monomer, ranked among those of its read."""
    own = cut_out({"seq": F.col("seq"), "qual": F.col("qual")}, F.col("kept"), "beg", "end")
    # an outer explode and a filter behind it: Spark would put one on ``kept`` below, and work all of it out again there
    m = cuts.select("read_idx", "read_id", F.posexplode_outer(own).alias("pos", "m")).where("m is not null")
    return m.select("read_idx", "read_id", (F.col("pos") + 1).cast("bigint").alias("rank"), "m.beg", "m.end", "m.seq", "m.qual")
