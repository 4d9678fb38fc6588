"""Files that a run leaves: paired FASTQ, monomers, sites, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F


# What the text sink's codec calls the levels of gzip.
_LEVELS = "BEST_SPEED TWO THREE FOUR FIVE SIX SEVEN EIGHT BEST_COMPRESSION".split()


def _packed(df: DataFrame, level: int) -> DataFrameWriter:
    """A writer that packs at a level of 1 to 9."""
    if not 1 <= level <= 9:
        raise ValueError("level must be in 1 to 9")
    return df.write.mode("overwrite").option("zlib.compress.level", _LEVELS[level - 1])


def _record(name: Column, seq: Column, qual: Column) -> Column:
    return F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def monomer_records(monomers: DataFrame) -> DataFrame:
    """(read_idx, record): a FASTQ record for each monomer, named by its read and range."""
    name = F.concat_ws("_", "read_id", "beg", "end")
    return monomers.select("read_idx", _record(name, F.col("seq"), F.col("qual")).alias("record"))


def side_record(k: int) -> Column:
    """The FASTQ record of one side of a pair."""
    name = F.concat(F.col("read_id"), F.lit(":"), F.col("i").cast("string"), F.lit("-"), F.col("j").cast("string"), F.lit(f"/{k}"))
    return _record(name, F.col(f"r{k}_seq"), F.col(f"r{k}_qual"))


def pair_records(pairs: DataFrame) -> DataFrame:
    """(read_idx, record): two FASTQ records for each pair, /1 and /2."""
    return pairs.select("read_idx", F.explode(F.array(side_record(1), side_record(2))).alias("record"))


def write_pairs(pairs: DataFrame, path: str, compression: str = "gzip", level: int = 6) -> None:
    """``path``/side=1 and side=2: part files of FASTQ records that are in step, file by file.

    One job writes both sides: a task writes a side's records of its rows to that side's file, both
    sorted by read and ranks. No pairs give an empty folder. Spark's commit makes files appear when whole.
    """
    sides = F.explode(F.array(*[F.struct(F.lit(k).alias("side"), side_record(k).alias("value")) for k in (1, 2)]))
    records = pairs.select("read_idx", "i", "j", sides.alias("r")).select("r.side", "read_idx", "i", "j", "r.value")
    ordered = records.sortWithinPartitions("side", "read_idx", "i", "j").select("side", "value")
    _packed(ordered, level).partitionBy("side").text(path, compression=compression)


def write_monomers(monomers: DataFrame, path: str, compression: str = "gzip", level: int = 6) -> None:
    """A FASTQ record for each monomer."""
    _packed(monomer_records(monomers).select("record"), level).text(path, compression=compression)


def window_records(windows: DataFrame) -> DataFrame:
    """(read_idx, record): a FASTA record for each window, named ``<read>_W<offset>``, from which ``read_paf`` takes the offset back."""
    name = F.concat(F.lit(">"), F.col("read_id"), F.lit("_W"), F.col("win_off").cast("string"))
    return windows.select("read_idx", F.concat(name, F.lit("\n"), F.col("win_seq")).alias("record"))


def write_windows(windows: DataFrame, path: str, compression: str = "gzip", level: int = 6) -> None:
    """What an aligner gets as its queries."""
    _packed(window_records(windows).select("record"), level).text(path, compression=compression)


def write_sites(sites_final: DataFrame, path: str, compression: str = "gzip") -> None:
    """The seven columns, separated by tabs, sorted within each file."""
    columns = ["read_idx", "len", "motif_start", "motif_end", "x", "span", "class"]
    sites_final.select(*columns).sortWithinPartitions("read_idx", "x").write.mode("overwrite").csv(path, sep="\t", compression=compression)


def write_stats(stats: DataFrame, path: str, labelled: bool = True) -> None:
    """Labelled: two columns under a header. Else one line of the values in order, separated by spaces."""
    if labelled:
        stats.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)
    else:
        line = F.array_join(F.transform(F.collect_list("value"), lambda v: v.cast("string")), " ")
        stats.coalesce(1).agg(line.alias("value")).write.mode("overwrite").text(path)
