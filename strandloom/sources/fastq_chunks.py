"""Paired FASTQ files as chunks with a list of them: ``df.write.format("fastq_chunks")``.

Each task writes one R1 and one R2 file side by side, in one pass and without a sort, under names of its own, and tells the driver their
names and counts. The commit gives the files of the tasks that count their final names and writes the list last: where
there is a list, all that it names is whole. A task that fails removes what it wrote; a job that fails removes everything.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from strandloom.sources.fastq_source import open_path
from strandloom.sources.sinks import side_record

LIST = "chunks.json"


@dataclass
class Written(WriterCommitMessage):
    part: int
    names: list[str]
    pairs: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, level: int, overwrite: bool):
        self.path, self.level, self.overwrite = path.rstrip("/"), level, overwrite
        self.work = f"_work-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, place = open_path(self.path)
        part = TaskContext.get().partitionId()
        names = [f"{self.work}/{part}-{uuid.uuid4().hex}-R{k}.fastq.gz" for k in (1, 2)]
        pairs, files = 0, []
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if not files:
                    system.create_dir(f"{place}/{self.work}", recursive=True)
                    raw = [system.open_output_stream(f"{place}/{n}", compression=None) for n in names]
                    files = [(gzip.GzipFile(filename="", fileobj=r, mode="wb", compresslevel=self.level, mtime=0), r) for r in raw]
                for (file, _), column in zip(files, ("r1", "r2")):
                    file.write("\n".join(batch.column(column).to_pylist()).encode() + b"\n")
                pairs += batch.num_rows
            for file, raw in files:
                file.close()
                raw.close()
        except BaseException:
            for _, raw in files:
                raw.close()
            self._remove(system, [f"{place}/{n}" for n in names])
            raise
        return Written(part, names if files else [], pairs)

    @staticmethod
    def _remove(system: pafs.FileSystem, names: list[str]) -> None:
        for found in system.get_file_info(names):
            if found.type == pafs.FileType.File:
                system.delete_file(found.path)

    def commit(self, messages: list[Written | None]) -> None:
        system, place = open_path(self.path)
        if self.overwrite:
            old = system.get_file_info(pafs.FileSelector(place, allow_not_found=True))
            self._remove(system, [f"{place}/{LIST}"])
            self._remove(system, [f.path for f in old if f.type == pafs.FileType.File])
        system.create_dir(place, recursive=True)
        chunks = []
        for m in sorted((m for m in messages if m is not None and m.names), key=lambda m: m.part):
            final = [f"chunk-{len(chunks):05d}_R{k}.fastq.gz" for k in (1, 2)]
            for name, to in zip(m.names, final):
                system.move(f"{place}/{name}", f"{place}/{to}")
            chunks.append({"r1": final[0], "r2": final[1], "pairs": m.pairs})
        self._clear(system, place)
        with system.open_output_stream(f"{place}/{LIST}", compression=None) as f:
            f.write("".join(json.dumps(c) + "\n" for c in chunks).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, place = open_path(self.path)
        self._clear(system, place)

    def _clear(self, system: pafs.FileSystem, place: str) -> None:
        if system.get_file_info(f"{place}/{self.work}").type == pafs.FileType.Directory:
            system.delete_dir(f"{place}/{self.work}")


class FastqChunks(DataSource):
    """Options: ``path`` and ``level`` (of gzip, 6). Columns ``r1`` and ``r2``: whole records without the last line break."""

    @classmethod
    def name(cls) -> str:
        return "fastq_chunks"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if schema.names != ["r1", "r2"]:
            raise ValueError("fastq_chunks takes the columns r1 and r2")
        level = int(self.options.get("level", 6))
        if not 1 <= level <= 9:
            raise ValueError("level must be in 1 to 9")
        return _Writer(self.options["path"], level, overwrite)


def write_chunks(pairs: DataFrame, path: str, level: int = 6) -> None:
    """Both sides of ``pairs`` as chunks under ``path``, in place of those that are there. No pairs give an empty list."""
    pairs.sparkSession.dataSource.register(FastqChunks)
    pairs.select(side_record(1).alias("r1"), side_record(2).alias("r2")).write.format("fastq_chunks").option("level", level).mode("overwrite").save(path)


def read_chunk_list(spark: SparkSession, path: str) -> DataFrame:
    """(r1, r2, pairs): the chunks, in order of their names."""
    return spark.read.schema("r1 string, r2 string, pairs bigint").json(f"{path.rstrip('/')}/{LIST}").orderBy("r1")


def chunk_lists(spark: SparkSession, path: str) -> tuple[str, str]:
    """The paths of R1 and of R2 chunks, separated by commas, as mapping programs take them."""
    base = path.rstrip("/")
    row = read_chunk_list(spark, path).agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in ("r1", "r2")]).first()
    return tuple(",".join(f"{base}/{n}" for n in row[c]) for c in ("r1", "r2"))
