"""Motif sites of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.motif import motif_starts


def locate_sites(reads: DataFrame, motif: str, offset: int, overlap: bool = True, case_sensitive: bool = False, interior_only: bool = True) -> DataFrame:
    """(read_idx, len, motif_start, motif_end, x): one row a site, x = motif_start + offset. No shuffle.

    ``interior_only`` keeps 0 < x < len, the sites at which a cut makes two parts.
    """
    start = F.explode(motif_starts(F.col("seq"), motif, overlap, case_sensitive)).alias("motif_start")
    sites = reads.select("read_idx", F.col("len").cast("bigint").alias("len"), start)
    sites = sites.withColumns({"motif_end": F.col("motif_start") + len(motif), "x": F.col("motif_start") + offset})
    return sites.where((F.col("x") > 0) & (F.col("x") < F.col("len"))) if interior_only else sites
