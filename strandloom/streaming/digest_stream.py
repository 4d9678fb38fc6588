"""The digest on a stream of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandloom.config import DigestConfig
from strandloom.operators.cut import digest_cuts
from strandloom.operators.pairs import pair
from strandloom.operators.stats import DIGEST, as_metrics, counters
from strandloom.scratch import scratch
from strandloom.sources.derived import reads_from
from strandloom.sources.fastq import stream_fastq


def stream_pairs(reads: DataFrame, config: DigestConfig, path: str, checkpoint: str) -> StreamingQuery:
    """Append the pairs of streamed reads to Parquet files; cutting and pairing are row-local, so no state is kept."""
    pairs = pair(digest_cuts(reads, config.motif, config.cut_offset, config.dup_motif, config.min_mono_len), config.pair_mode)
    return pairs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _counted(spark: SparkSession, reads: DataFrame, config: DigestConfig) -> DataFrame:
    """Counters of a digest over what a stream of reads has now.

    Each micro-batch's counters go to a folder of their own, so a batch that runs again replaces its own;
    the result sums them.
    """
    base = scratch(spark, "stream")
    cuts = digest_cuts(reads, config.motif, config.cut_offset, config.dup_motif, config.min_mono_len)

    def keep(batch: DataFrame, number: int) -> None:
        counters(batch, config.pair_mode).write.mode("overwrite").parquet(f"{base}/counters/batch={number}")

    # a Python source has no trigger that ends; both kinds end when all that is there has been read
    query = cuts.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema(", ".join(f"{n} bigint" for n in DIGEST)).parquet(f"{base}/counters")
    return as_metrics(rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in DIGEST]), DIGEST)


def streamed_stats(spark: SparkSession, path: str, config: DigestConfig) -> DataFrame:
    """Counters of a digest over the Parquet files that ``path`` has now, read as a stream."""
    # a pattern, as a stream reads folders or patterns, and a table may be a single file
    docs = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 64).parquet(path.replace(".parquet", "[.]parquet"))
    return _counted(spark, reads_from(docs.select("doc_id", "text")), config)


def streamed_fastq_stats(spark: SparkSession, path: str, config: DigestConfig) -> DataFrame:
    """The same over FASTQ files, plain or compressed, as they appear under ``path``."""
    return _counted(spark, stream_fastq(spark, path), config)
