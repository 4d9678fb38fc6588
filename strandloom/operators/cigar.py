"""Split alignments at large gaps into blocks that are continuous on both sides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = "read_idx bigint, strand string, target_id string, q1 bigint, q2 bigint, t1 bigint, t2 bigint"
#: Which operations move on the query and on the target, and which may end a block.
_QUERY, _TARGET, _GAP = (np.isin(np.arange(256), list(ops)) for ops in (b"M=XI", b"M=XDN", b"IDN"))
_KNOWN = np.isin(np.arange(256), list(b"MIDNSHP=X"))


def cigar_ops(cigar: Column) -> Column:
    """A CIGAR string as an array of (len, op)."""
    pattern = F.lit("([0-9]+)([MIDNSHP=X])")
    return F.zip_with(F.regexp_extract_all(cigar, pattern, F.lit(1)), F.regexp_extract_all(cigar, pattern, F.lit(2)), lambda n, op: F.struct(n.cast("bigint").alias("len"), op.alias("op")))


def parse_cigars(text: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length and letter of every operation of CIGAR strings one after another, which end at ``ends``. Letters without a number or a meaning are passed over."""
    raw = np.frombuffer(text, np.uint8)
    digit = (raw >= 48) & (raw <= 57)
    at = np.flatnonzero(~digit)
    # a number goes back from its letter to the last letter or the row's start
    row = np.searchsorted(ends, at, side="right")
    begin = np.maximum(np.concatenate([[0], at[:-1] + 1]) if len(at) else at, np.concatenate([[0], ends])[row])
    size = at - begin
    value = np.zeros(len(at), np.int64)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        value[has] = value[has] * 10 + (raw[begin[has] + k] - 48)
    known = (size > 0) & _KNOWN[raw[at]]
    return row[known], value[known], raw[at[known]]


def _spans(row: np.ndarray, size: np.ndarray, letter: np.ndarray, max_gap: int) -> tuple[np.ndarray, ...]:
    """Row and, counted from the alignment's start, both ends on query and target of each stretch between large gaps: running sums, no step for each operation."""
    big = _GAP[letter] & (size >= max_gap)
    query, target = (np.concatenate([[0], np.cumsum(np.where(moves[letter], size, 0))]) for moves in (_QUERY, _TARGET))
    rest = np.flatnonzero(~big)
    if not len(rest):
        return (rest,) * 5
    gaps = np.cumsum(big)[rest]
    new = np.flatnonzero(np.concatenate([[True], (row[rest][1:] != row[rest][:-1]) | (gaps[1:] != gaps[:-1])]))
    first, last = rest[new], rest[np.append(new[1:], len(rest)) - 1] + 1
    start = np.searchsorted(row, row[first])
    return row[first], query[first] - query[start], query[last] - query[start], target[first] - target[start], target[last] - target[start]


def split_alignments(alignments: DataFrame, max_gap: int = 50) -> DataFrame:
    """(read_idx, strand, target_id, q1, q2, t1, t2): a row a block, in read coordinates. No shuffle.

    A block ends at an insertion, deletion or skip of at least ``max_gap``. The query moves on M, =, X and
    I, the target on M, =, X, D and N; on the minus strand the query runs down from its end. Window
    offsets are added; blocks without query bases are dropped. An alignment whose CIGAR is null or empty is one block from
    its ends, for which there must be a column ``t_end``. All CIGARs of a batch are split together, in time linear in their operations.
    """
    t_end = F.col("t_end") if "t_end" in alignments.columns else F.lit(None)
    off = F.coalesce(F.col("win_off"), F.lit(0))
    columns = {"q_start": F.col("q_start") + off, "q_end": F.col("q_end") + off, "t_start": F.col("t_start"), "t_end": t_end}
    rows = alignments.select("read_idx", "strand", "target_id", F.coalesce("cigar", F.lit("")).cast("binary").alias("cigar"), *[c.cast("bigint").alias(n) for n, c in columns.items()])

    places = list(columns)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("cigar").to_pylist()
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            own, q0, q1, t0, t1 = _spans(*parse_cigars(b"".join(texts), ends), max_gap)
            place = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in places}
            plain = np.flatnonzero(np.array([not t for t in texts], bool) & batch.column("t_end").is_valid().to_numpy(zero_copy_only=False))
            if len(plain):
                own, q0, t0 = (np.concatenate([x, y]) for x, y in ((own, plain), (q0, np.zeros(len(plain), np.int64)), (t0, np.zeros(len(plain), np.int64))))
                q1 = np.concatenate([q1, (place["q_end"] - place["q_start"])[plain].astype(np.int64)])
                t1 = np.concatenate([t1, (place["t_end"] - place["t_start"])[plain].astype(np.int64)])
            keep = q1 > q0
            own, q0, q1, t0, t1 = own[keep], q0[keep], q1[keep], t0[keep], t1[keep]
            index = pa.array(own)
            named = [batch.column(c).take(index) for c in ("read_idx", "strand", "target_id")]
            plus = np.array([s == "+" for s in named[1].to_pylist()], bool)
            start, end, target = (place[c][own].astype(np.int64) for c in ("q_start", "q_end", "t_start"))
            out = [np.where(plus, start + q0, end - q1), np.where(plus, start + q1, end - q0), target + t0, target + t1]
            yield pa.RecordBatch.from_arrays([*named, *[pa.array(x.astype(np.int64)) for x in out]], [c.split()[0] for c in _BLOCK.split(", ")])

    return rows.mapInArrow(split, _BLOCK)
