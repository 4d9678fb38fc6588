"""``spark.read.format("fastq")`` and ``spark.readStream.format("fastq")``.

A plain file is read in byte ranges by many tasks, though nothing in FASTQ marks where a record begins: a line that starts with ``@`` may be
a quality. Lines are the letters of an automaton: a header, sequence lines up to one that starts with ``+``, and quality lines until
they are as long as the sequence. A task doesn't know the state in which its range begins, so it runs the automaton from every line near it that could be
a header before it. Wrong runs break, as their lengths don't fit; until all runs that are left have one result, and that of a wider window is the same, the task looks further
back and ahead, at last from the file's start, where the state is known. That is a guess still, and it is proved: each
task works out by the same rule where the next range's records begin, and holds the end of its own last record against it. The
first task begins where the file does, so together they have followed one chain of records from the first byte to the last. What breaks
the chain, a broken record or a quality that imitates records for longer than was looked at, fails the job and can't give wrong
reads; one range for a file (``rangeBytes``) then tells which it was. The driver plans ranges from file sizes alone.

A read's number is its file's place in the order of names times ``STRIDE``, plus the byte at which its record begins, uncompressed: it is the
same whatever the ranges, and ascends in the order of the file. Files that end in ``.gz`` are one range each.
"""

from __future__ import annotations

import fnmatch
import gzip
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "read_idx bigint, read_id string, seq string, qual string, len bigint"
STRIDE = 1 << 40
#: Bytes of a range by default, of a step of reading, and that are first looked at to find where a range's records begin.
RANGE, STEP, LOOK = 64 << 20, 8 << 20, 1 << 16
#: Records that a run must pass before it counts.
SURE = 2
#: Records of a batch that goes to Spark.
RECORDS = 4096
_ID = re.compile(rb"[^ \t\r]*")
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs"}


class BrokenRecord(ValueError):
    """Bytes that are no FASTQ record."""


class Lines:
    """The complete lines of a buffer, with what the automaton needs of them, and steps from header to header."""

    def __init__(self, data: bytes, whole: bool):
        """``whole``: the file ends with the buffer, so what is behind the last line break is a line."""
        raw = np.frombuffer(data, np.uint8)
        breaks = np.flatnonzero(raw == 10)
        if whole and len(raw) and raw[-1] != 10:
            breaks = np.append(breaks, len(raw))
        self.data, self.whole, self.n = data, whole, len(breaks)
        self._not_plain: list[np.ndarray] | None = None
        self.starts = np.concatenate([[0], breaks[:-1] + 1]).astype(np.int64) if self.n else np.zeros(0, np.int64)
        self.ends = breaks.astype(np.int64)
        if self.n:
            self.ends = self.ends - ((self.ends > self.starts) & (raw[np.maximum(self.ends - 1, 0)] == 13))
        self.after = np.append(self.starts, min(int(breaks[-1]) + 1, len(raw)) if self.n else 0)
        self.sizes = self.ends - self.starts
        self.sums = np.concatenate([[0], np.cumsum(self.sizes)])
        first = np.where(self.sizes > 0, raw[np.minimum(self.starts, max(len(raw) - 1, 0))], 0) if self.n else np.zeros(0, np.uint8)
        self._is_header, self._is_plus = first == 64, first == 43
        self.headers, self.pluses, self.filled = np.flatnonzero(self._is_header), np.flatnonzero(self._is_plus), np.flatnonzero(self.sizes > 0)

    def next(self, header: int) -> tuple[int, int] | None:
        """The line of the record's ``+`` and the header behind it (``n`` if that isn't here yet); None if the record isn't complete."""
        if header >= self.n:
            return None
        if not self._is_header[header]:
            raise BrokenRecord(f"no record begins with {self.text(header)!r}")
        at = np.searchsorted(self.pluses, header + 1)
        if at == len(self.pluses):
            return self._open(header)
        plus = int(self.pluses[at])
        size = self.sums[plus] - self.sums[header + 1]
        behind = int(np.searchsorted(self.sums, self.sums[plus + 1] + size, side="left"))
        if behind > self.n:
            return self._open(header)
        behind = max(behind, plus + 1)
        if self.sums[behind] - self.sums[plus + 1] != size:
            raise BrokenRecord(f"sequence and quality of {self.text(header)!r} differ in length")
        at = np.searchsorted(self.filled, behind)
        following = int(self.filled[at]) if at < len(self.filled) else self.n
        if following < self.n and not self._is_header[following]:
            raise BrokenRecord(f"behind {self.text(header)!r} stands {self.text(following)!r}")
        return plus, following

    def _open(self, header: int) -> None:
        if self.whole:
            raise BrokenRecord(f"the file ends within {self.text(header)!r}")

    def text(self, line: int) -> str:
        return self.data[self.starts[line] : self.ends[line]][:60].decode("utf-8", "replace")

    def joined(self, first: int, last: int) -> str:
        """Lines first to last - 1 as one."""
        if last <= first:
            return ""
        out = self.data[self.starts[first] : self.ends[last - 1]]
        return (out if last == first + 1 else out.replace(b"\n", b"").replace(b"\r", b"")).decode()

    def runs(self, begin: int) -> set[int | None]:
        """Where the first record at or behind ``begin`` starts, by each run from a header before: those in which the automaton passes ``SURE`` records, or all up to the file's end, and then reaches the buffer's end.

        A run from a header behind ``begin`` would only name itself. None stands for a run that reaches the buffer's end before.
        All headers take their step at once, and a run is known from that of its second record, so each header is worked out once.
        """
        headers = self.headers
        at = np.searchsorted(self.pluses, headers + 1)
        open_ = at == len(self.pluses)
        plus = self.pluses[np.minimum(at, max(len(self.pluses) - 1, 0))] if len(self.pluses) else headers
        size = self.sums[plus] - self.sums[np.minimum(headers + 1, self.n)]
        behind = np.searchsorted(self.sums, self.sums[np.minimum(plus + 1, self.n)] + size, side="left")
        open_ |= behind > self.n
        behind = np.minimum(np.maximum(behind, plus + 1), self.n)
        good = self.sums[behind] - self.sums[np.minimum(plus + 1, self.n)] == size
        at = np.searchsorted(self.filled, behind)
        following = np.append(self.filled, self.n)[np.minimum(at, len(self.filled))]
        good &= np.append(self._is_header, True)[following]
        # an open record is a run of none, unless the file ends
        good = ~open_ & good | open_ & (not self.whole)
        records: dict[int, tuple[int, int | None]] = {}  # and the run's first start at or behind
        for header, start, incomplete, then in zip(*(x[good][::-1].tolist() for x in (headers, self.starts[headers], open_, following))):
            own = start if start >= begin else None
            if incomplete:
                records[header] = 0, own
            elif then >= self.n or then in records:
                n, first = records.get(then, (0, len(self.data) if self.whole else None))
                records[header] = n + 1, first if own is None else own
        least = 1 if self.whole else SURE
        return {first for header, (n, first) in records.items() if n >= least and self.starts[header] < begin}

    def plain(self, header: int) -> int:
        """How many records of four lines follow each other from this header on."""
        n = (self.n - header) // 4
        if n <= 0:
            return 0
        if self._not_plain is None:  # of each fourth of the lines, once
            good = np.zeros(self.n, bool)
            i = np.arange(self.n - 3)
            good[:-3] = self._is_header[i] & self._is_plus[i + 2] & ~self._is_plus[i + 1] & (self.sizes[i + 1] == self.sizes[i + 3]) & np.append(self._is_header, True)[i + 4]
            bad = np.flatnonzero(~good)
            self._not_plain = [bad[bad % 4 == k] for k in range(4)]
        bad = self._not_plain[header % 4]
        at = np.searchsorted(bad, header)
        return min(n, (int(bad[at]) - header) // 4) if at < len(bad) else n

    def every_fourth(self, first: int, n: int) -> pa.Array:
        """Lines first, first + 4, ... as strings."""
        at = first + 4 * np.arange(n)
        offsets = np.empty(2 * n + 1, np.int32)  # a line, and what stands between it and the next
        offsets[0:-1:2], offsets[1::2], offsets[-1] = self.starts[at], self.ends[at], len(self.data)
        both = pa.Array.from_buffers(pa.binary(), 2 * n, [None, pa.py_buffer(offsets), pa.py_buffer(self.data)])
        return both.take(pa.array(2 * np.arange(n))).cast(pa.string())


@dataclass
class Range(InputPartition):
    uri: str
    number: int
    size: int
    begin: int
    end: int


def open_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    scheme, colon, rest = uri.partition("://")
    if colon:
        return pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


def list_files(path: str) -> list[tuple[str, int, int]]:
    """(URI, bytes, time of the last change in ns) of the files that a path, a folder (with those below) or a pattern in the last part names, by name."""
    scheme = path.partition("://")[0] + "://" if "://" in path else ""
    system, place = open_path(path)
    last = place.rstrip("/").rpartition("/")[2]
    if any(c in last for c in "*?["):
        found = system.get_file_info(pafs.FileSelector(place.rstrip("/").rpartition("/")[0] or ".", recursive=False))
        found = [f for f in found if fnmatch.fnmatchcase(f.base_name, last)]
    else:
        info = system.get_file_info(place)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = system.get_file_info(pafs.FileSelector(place, recursive=True)) if info.type == pafs.FileType.Directory else [info]
    files = [f for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", "."))]
    return sorted((f"{scheme}{f.path}", f.size, f.mtime_ns or 0) for f in files)


class _Reads:
    """The records of ranges, as Arrow batches with the schema's columns."""

    def __init__(self, schema: StructType):
        self.names = schema.names
        unknown = set(self.names) - {c.split()[0] for c in SCHEMA.split(", ")}
        if unknown:
            raise ValueError(f"FASTQ has no columns {sorted(unknown)}")

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, place = open_path(part.uri)
        if part.uri.endswith(".gz"):
            with system.open_input_stream(place, compression=None) as raw, gzip.GzipFile(fileobj=raw) as file:
                yield from self._records(part, 0, lambda at, held: file.read(max(STEP, held)), None)
            return
        with system.open_input_file(place) as file:
            begin = _first_record(file, part.size, part.begin)

            def step(at: int, held: int) -> bytes:
                # to the range's end and a little more; twice as much each time where a record is longer
                file.seek(at)
                return file.read(min(max(STEP, held), max(part.end - at, 0) + max(LOOK, held), part.size - at))

            if begin < part.end:
                yield from self._records(part, begin, step, lambda: _first_record(file, part.size, part.end))
            elif begin != _first_record(file, part.size, part.end):  # no record begins here, so the next range must begin with the same
                raise BrokenRecord(f"the record that ends at byte {begin} of {part.uri} isn't followed by one")

    def _records(self, part: Range, begin: int, step, expected) -> Iterator[pa.RecordBatch]:
        rest, at, own = b"", begin, 0
        out: list[tuple] = []
        while True:
            more = step(at + len(rest), len(rest))
            lines = Lines(rest + more, not more)
            header, ended = (int(lines.filled[0]) if len(lines.filled) else lines.n), False
            while header < lines.n and not (ended := expected is not None and at + int(lines.starts[header]) >= part.end):
                if many := lines.plain(header):
                    if expected is not None:  # those that begin in this range
                        many = int(np.searchsorted(at + lines.starts[header + 4 * np.arange(many)], part.end))
                    if out:
                        yield self._batch(out)
                        out = []
                    for first in range(0, many, RECORDS):
                        yield self._plain(part, at, lines, header + 4 * first, min(RECORDS, many - first))
                    header += 4 * many
                    continue
                found = lines.next(header)
                if found is None:
                    break
                plus, following = found
                out.append(self._row(part, at, lines, header, plus, following))
                header = following
                if len(out) >= RECORDS:
                    yield self._batch(out)
                    out = []
            own = at + int(lines.after[header])
            if ended or not more:
                break
            rest, at = lines.data[lines.after[header] :], own
        if out:
            yield self._batch(out)
        if expected is not None and own != expected():
            raise BrokenRecord(f"the record that ends at byte {own} of {part.uri} isn't followed by one")

    def _row(self, part: Range, at: int, lines: Lines, header: int, plus: int, following: int) -> tuple:
        seq = lines.joined(header + 1, plus)
        last = following
        while last > plus + 1 and lines.sizes[last - 1] == 0:
            last -= 1
        values = {
            "read_idx": part.number * STRIDE + at + int(lines.starts[header]),
            "read_id": _ID.match(lines.data, int(lines.starts[header]) + 1, int(lines.ends[header]))[0].decode(),
            "seq": seq,
            "qual": lines.joined(plus + 1, last) if "qual" in self.names else None,
            "len": len(seq),
        }
        return tuple(values[c] for c in self.names)

    def _plain(self, part: Range, at: int, lines: Lines, header: int, n: int) -> pa.RecordBatch:
        """``n`` records of four lines, without a step for each."""
        make = {
            "read_idx": lambda: pa.array(part.number * STRIDE + at + lines.starts[header + 4 * np.arange(n)]),
            "read_id": lambda: pc.replace_substring_regex(lines.every_fourth(header, n), r"(?s)^@([^ \t\r]*).*$", r"\1"),
            "seq": lambda: lines.every_fourth(header + 1, n),
            "qual": lambda: lines.every_fourth(header + 3, n),
            "len": lambda: pc.utf8_length(lines.every_fourth(header + 1, n)).cast(pa.int64()),
        }
        return pa.RecordBatch.from_arrays([make[c]() for c in self.names], self.names)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"read_idx": pa.int64(), "len": pa.int64()}
        columns = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(self.names, zip(*rows))]
        return pa.RecordBatch.from_arrays(columns, self.names)


def _first_record(file, size: int, begin: int) -> int:
    """Where the first record at or behind ``begin`` starts; the file's size if there is none."""
    if begin >= size:
        return size
    back, ahead, before = LOOK, LOOK, None
    while True:
        lo, hi = max(begin - back, 0), min(begin + ahead, size)
        file.seek(max(lo - 1, 0))
        data = file.read(hi - max(lo - 1, 0))
        skip = 0
        if lo > 0:  # a line that begins before ``lo`` is of no use
            skip = data.find(b"\n") + 1
            if skip == 0:
                skip = len(data)
        lines = Lines(data[skip:], hi == size)
        base = max(lo - 1, 0) + skip
        if lo == 0:
            found = {_at_or_behind(lines, r, base, begin) for r in lines.filled[:1].tolist()}
        else:
            found = {x if x is None else base + x for x in lines.runs(begin - base)}
        own = found.pop() if len(found) == 1 else None
        if own is not None and (lo == 0 or own == before):  # two windows, of which the wider sees past longer records, agree
            return own
        before = own
        if hi == size and lo == 0:
            if not len(lines.filled):
                return size
            raise BrokenRecord("the file isn't made of FASTQ records")
        back, ahead = back * 4, ahead * 4


def _at_or_behind(lines: Lines, header: int | None, base: int, begin: int) -> int | None:
    """The byte of the first record at or behind ``begin`` in a run; None if the buffer ends before."""
    while header is not None and header < lines.n:
        if base + int(lines.starts[header]) >= begin:
            return base + int(lines.starts[header])
        step = lines.next(header)
        header = step[1] if step else None
    return base + len(lines.data) if lines.whole and header is not None else None


class _BatchReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, span: int):
        self.reads, self.path, self.span = _Reads(schema), path, span

    def partitions(self) -> list[Range]:
        out = []
        for number, (uri, size, _) in enumerate(list_files(self.path)):
            cuts = [0, size] if uri.endswith(".gz") else [*range(0, size, self.span), size]
            out += [Range(uri, number, size, a, b) for a, b in zip(cuts, cuts[1:])]
        return out or [Range("", 0, 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.reads.read(partition) if partition.size else iter(())


class _StreamReader(DataSourceStreamReader):
    """Files in the order of their last change, then of names; an offset names the last file that was read. Files must appear whole, with rising times."""

    def __init__(self, schema: StructType, path: str, span: int):
        self.reads, self.path, self.span = _Reads(schema), path, span

    def _files(self) -> list[tuple[int, str, int]]:
        return sorted((changed, uri, size) for uri, size, changed in list_files(self.path))

    def initialOffset(self) -> dict:
        return {"last": json.dumps([0, ""])}

    def latestOffset(self) -> dict:
        files = self._files()
        return {"last": json.dumps(list(files[-1][:2])) if files else json.dumps([0, ""])}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        after, upto = (tuple(json.loads(o["last"])) for o in (start, end))
        out = []
        for number, (changed, uri, size) in enumerate(self._files()):
            if after < (changed, uri) <= upto and size:
                cuts = [0, size] if uri.endswith(".gz") else [*range(0, size, self.span), size]
                out += [Range(uri, number, size, a, b) for a, b in zip(cuts, cuts[1:])]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.reads.read(partition)


class FastqSource(DataSource):
    """Options: ``path`` and ``rangeBytes``. A schema with some of the columns reads those alone."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def _made(self, kind: type, schema: StructType):
        if "path" not in self.options:
            raise ValueError("a FASTQ source needs a path")
        return kind(schema, self.options["path"], max(1, int(self.options.get("rangeBytes", RANGE))))

    def reader(self, schema: StructType) -> DataSourceReader:
        return self._made(_BatchReader, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return self._made(_StreamReader, schema)


def register(spark: SparkSession) -> None:
    """Make ``format("fastq")`` known to the session."""
    spark.dataSource.register(FastqSource)
