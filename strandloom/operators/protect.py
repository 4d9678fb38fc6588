"""Which sites enough supporting reads span."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.functions.intervals import ratio

SITE = ["read_idx", "len", "motif_start", "motif_end", "x"]


def _classed(spans: DataFrame, min_cov: int) -> DataFrame:
    return spans.withColumn("class", F.when(F.col("span") >= min_cov, "P").otherwise("C"))


def protect(sites: DataFrame, blocks: DataFrame, flank: int = 15, min_cov: int = 3, bin_size: int | None = None) -> DataFrame:
    """Sites with ``span`` and ``class``: P (protected) if at least ``min_cov`` targets span it, else C (cut).

    A target spans a site if one block of it holds [max(0, x - flank), min(len, x + flank)). Sites without
    any have span 0. ``bin_size`` adds bins of the read to the join's keys, for reads with very many sites and
    blocks: a site is in one bin, a block in all that it touches. The distinct count is on the read's
    own partitioning, so it needs no further shuffle. The join's work is a read's sites times its blocks; ``protect_sweep`` has no such product.
    """
    s = sites.withColumns({"lo": F.greatest(F.lit(0).cast("bigint"), F.col("x") - flank), "hi": F.least(F.col("len"), F.col("x") + flank)})
    b = blocks.select(F.col("read_idx").alias("b_read"), "q_start", "q_end", "target_id")
    holds = (F.col("read_idx") == F.col("b_read")) & (F.col("q_start") <= F.col("lo")) & (F.col("q_end") >= F.col("hi"))
    if bin_size:
        s = s.withColumn("bin", F.floor(F.col("lo") / bin_size))
        b = b.withColumn("b_bin", F.explode(F.sequence(F.floor(F.col("q_start") / bin_size), F.floor(F.col("q_end") / bin_size))))
        holds = holds & (F.col("bin") == F.col("b_bin"))
    return _classed(s.join(b, holds, "left").groupBy(*SITE).agg(F.count_distinct("target_id").alias("span")), min_cov)


def span_events(lengths: DataFrame, blocks: DataFrame, flank: int) -> DataFrame:
    """(read_idx, at, delta): by how much the number of targets that span a site changes from x = ``at`` on.

    A block spans the sites of one range of x: from q_start + flank (0 where the block begins the read) to q_end - flank (the
    read's end where it ends it). Of a target's ranges, in order, only what those before don't cover counts, so
    the parts of a target never overlap and a running sum counts targets, not blocks. Changes at one place are summed before they
    are dealt out by read: a read has no more of them than bases, however many blocks it has. ``lengths``: (read_idx, len).
    """
    reads = lengths.groupBy("read_idx").agg(F.max("len").alias("len"))
    placed = blocks.select("read_idx", "target_id", "q_start", "q_end").join(reads, "read_idx")
    first = F.when(F.col("q_start") <= 0, F.lit(0).cast("bigint")).otherwise(F.col("q_start") + flank)
    last = F.when(F.col("q_end") >= F.col("len"), F.col("len")).otherwise(F.col("q_end") - flank)
    ranges = placed.select("read_idx", "target_id", first.alias("first"), last.alias("last")).where("first <= last")
    ranges = ranges.groupBy("read_idx", "target_id", "first").agg(F.max("last").alias("last"))
    before = F.max("last").over(Window.partitionBy("read_idx", "target_id").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    own = ranges.withColumn("before", before).where("before is null or last > before")
    start = F.greatest("first", F.col("before") + 1)  # greatest passes over a null
    change = F.array(F.struct(start.alias("at"), F.lit(1).alias("delta")), F.struct((F.col("last") + 1).alias("at"), F.lit(-1).alias("delta")))
    return own.select("read_idx", F.explode(change).alias("c")).groupBy("read_idx", "c.at").agg(F.sum("c.delta").alias("delta")).where("delta <> 0")


def protect_sweep(sites: DataFrame, blocks: DataFrame, flank: int = 15, min_cov: int = 3, lengths: DataFrame | None = None) -> DataFrame:
    """The same as ``protect`` in time linear in sites and blocks: a sweep over each read's changes and sites.

    Sites and changes of a read are put in one order, and a site's span is the sum of the changes up to it. No row
    comes from a site and a block together. Repeated sites stay as they are. Lengths of reads are taken from the sites, unless
    there is a table (read_idx, len) of them, which spares a second pass over what makes the sites.
    """
    none = [F.lit(None).cast("bigint").alias(c) for c in SITE[1:4]]
    changes = span_events(sites if lengths is None else lengths, blocks, flank).select("read_idx", F.col("at").alias("x"), "delta", *none, F.lit(False).alias("site"))
    points = sites.select("read_idx", "x", F.lit(0).cast("bigint").alias("delta"), *SITE[1:4], F.lit(True).alias("site"))
    up_to = Window.partitionBy("read_idx").orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.unionByName(changes).withColumn("span", F.sum("delta").over(up_to))
    return _classed(swept.where("site").select(*SITE, "span"), min_cov)


def span_histogram(sites_final: DataFrame) -> DataFrame:
    """How many sites have each span."""
    return sites_final.groupBy("span").agg(F.count("*").alias("n_sites"))


def class_summary(sites_final: DataFrame) -> DataFrame:
    """Counts and shares of the two classes; shares are 0 without sites."""
    n = sites_final.agg(
        F.count("*").alias("sites"),
        F.coalesce(F.sum((F.col("class") == "P").cast("bigint")), F.lit(0)).alias("protected"),
        F.coalesce(F.sum((F.col("class") == "C").cast("bigint")), F.lit(0)).alias("cut"),
    )
    return n.withColumns({f"pct_{k}": ratio(F.col(k) * 100.0, F.col("sites"), 1) for k in ("protected", "cut")})
