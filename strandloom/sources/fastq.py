"""FASTQ and FASTA files, plain or compressed, by any path that Spark's text reader opens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.sources.fastq_source import register

def _id(header: Column) -> Column:
    """A header up to its first space or tab, without the leading mark."""
    return F.regexp_extract(header, r"^[@>]?([^ \t\r]*)", 1)


def read_fastq(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """(read_idx, read_id, seq, qual, len) of FASTQ records, whose sequences and qualities may span lines; ``read_idx`` ascends with file names and places.

    See ``fastq_source`` for how plain files are read in ranges. A truncated record, a missing ``@`` or ``+``, and a quality
    of another length than its sequence fail the job.
    """
    register(spark)
    reader = spark.read.format("fastq")
    return (reader.option("rangeBytes", range_bytes) if range_bytes else reader).load(path)


def stream_fastq(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream: files that appear under ``path`` are read once each, in the order of their times and names."""
    register(spark)
    return spark.readStream.format("fastq").load(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, seq, len) of FASTA records, whose sequences may span lines; blank records are passed over."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    head, body = F.substring_index("value", "\n", 1), F.regexp_replace(F.regexp_extract("value", r"(?s)^[^\n]*\n?(.*)$", 1), r"\s", "")
    return raw.where(F.trim("value") != "").select(_id(head).alias("read_id"), body.alias("seq")).withColumn("len", F.length("seq").cast("bigint"))


def total_bases(reads: DataFrame) -> int:
    """The sum of the lengths of sequences."""
    return reads.agg(F.coalesce(F.sum("len"), F.lit(0))).first()[0]
