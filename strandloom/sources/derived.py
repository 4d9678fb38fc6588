"""Reads and alignments derived from the general tables, where no sequencing files are at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Each letter of a text stands for a nucleotide.
LETTERS, BASES = "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC"


def reads_from(docs: DataFrame) -> DataFrame:
    """(read_idx, read_id, seq, qual, len) from the letters of each document."""
    seq = F.translate(F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), LETTERS, BASES)
    reads = docs.select(F.col("doc_id").alias("read_idx"), F.concat(F.lit("read"), F.col("doc_id").cast("string")).alias("read_id"), seq.alias("seq"))
    n = F.length("seq")
    return reads.withColumns({"len": n.cast("bigint"), "qual": F.repeat(F.lit("I"), n)})


def derived_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_from(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def derived_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments with a CIGAR string from ``lineitem``, each on the read its order number leads to."""
    n_docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    lengths = derived_reads(spark, sf_dir).where("len >= 1000").select("read_idx", "len")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"]
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*cols)
    quantity = F.col("l_quantity").cast("bigint")
    items = items.withColumns(
        {
            "read_idx": F.col("l_orderkey") % n_docs,
            "strand": F.when(F.col("l_returnflag") == "R", "-").otherwise("+"),
            "target_id": F.concat(F.lit("hifi"), (F.col("l_suppkey") % 12).cast("string")),
            "op": F.element_at(F.array(F.lit("D"), F.lit("I"), F.lit("N")), (F.col("l_orderkey") % 3 + 1).cast("int")),
            "g": F.col("l_linenumber").cast("bigint") * 15,
            "a": 100 + quantity * 5,
            "b": 100 + F.col("l_partkey") % 200,
            "j": F.col("l_suppkey") * 17 % 40,
        }
    )
    qlen = F.col("a") + F.col("b") + F.when(F.col("op") == "I", F.col("g")).otherwise(0)
    on = items.join(lengths, "read_idx").withColumn("qlen", qlen)
    start = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 101 + F.col("l_orderkey") * 13) % (F.col("len") - F.col("qlen"))
    on = on.withColumn("q_start", start).withColumn("q_end", F.col("q_start") + F.col("qlen"))
    cigar = F.concat(F.col("a").cast("string"), F.lit("M"), F.col("g").cast("string"), F.col("op"), F.col("b").cast("string"), F.lit("M"))
    t_start = F.when(F.col("strand") == "+", F.col("q_start") + F.col("j")).otherwise(200000 - F.col("q_end") + F.col("j"))
    return on.select("read_idx", F.lit(0).cast("bigint").alias("win_off"), "q_start", "q_end", "strand", "target_id", t_start.alias("t_start"), cigar.alias("cigar"))
