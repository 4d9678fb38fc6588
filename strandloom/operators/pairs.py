"""Pairs of monomers of one read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.intervals import cut_out


def pair(cuts: DataFrame, mode: str = "all") -> DataFrame:
    """(read_idx, read_id, i, j, and seq and qual of both): all pairs i < j of a read, or adjacent ones (``seq``).

    Reads with fewer than two kept monomers give none. Both sides are in one row, so they stay in step.
    No shuffle: a read's pairs come from its own row. Its monomers are cut out once. All pairs come in two steps, first monomers, each with
    those behind it, and then the second of each pair, so a row is never copied for each of its pairs: what is copied is about what comes out.
    """
    own = cut_out({"seq": F.col("seq"), "qual": F.col("qual")}, F.col("kept"))
    ready = cuts.select("read_idx", "read_id", own.alias("own"))
    # reads without pairs go after the outer explodes: a filter before them would work out the cuts again
    if mode == "seq":
        n = F.size("own")
        steps = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(i.alias("i"), F.get("own", i - 1).alias("one"), F.get("own", i).alias("two"))))
        each = ready.select("read_idx", "read_id", F.explode_outer(steps).alias("p")).where("p is not null").select("read_idx", "read_id", F.col("p.i").alias("i"), (F.col("p.i") + 1).alias("j"), "p.one", "p.two")
    else:
        first = ready.select("read_idx", "read_id", "own", F.posexplode_outer("own").alias("at", "one")).where("one is not null")
        behind = F.slice("own", F.col("at") + 2, F.size("own"))
        each = first.select("read_idx", "read_id", "at", "one", F.posexplode_outer(behind).alias("next", "two")).where("two is not null")
        each = each.select("read_idx", "read_id", (F.col("at") + 1).alias("i"), (F.col("at") + F.col("next") + 2).alias("j"), "one", "two")
    sides = [F.col(f"{m}.{c}").alias(f"r{k}_{c}") for k, m in ((1, "one"), (2, "two")) for c in ("seq", "qual")]
    return each.select("read_idx", "read_id", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), *sides)
