"""Pack token sequences into bins of one capacity: dominance reduction, then best fit.

Pieces of equal length are the same to a packer. So it works on the number of pieces of each length,
2048 numbers however many documents there are: whole groups of equal bins at a time. Spark
counts the lengths and gives each piece its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm import _common as c
from strandloom.llm._tokens import AT_ONCE, with_end, word_encoder


@dataclass(frozen=True)
class Group:
    """``bins`` equal bins; ``items`` has (length, how many in each bin)."""

    bins: int
    items: tuple[tuple[int, int], ...]


class _Counts:
    """How many pieces of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {k: v for k, v in counts.items() if v}
        self.sizes = sorted(self.left)

    def take(self, size: int, n: int) -> None:
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect.bisect_left(self.sizes, size))

    def at_most(self, room: int, without: tuple[int, ...] = ()) -> int | None:
        """The largest length within ``room`` of which a piece is left besides ``without``."""
        i = bisect.bisect_right(self.sizes, room) - 1
        while i >= 0:
            s = self.sizes[i]
            if self.left[s] > without.count(s):
                return s
            i -= 1
        return None

    def least(self, n: int, without: tuple[int, ...]) -> list[int]:
        """The ``n`` smallest pieces left besides ``without``, or fewer if there are fewer."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(n - len(out), self.left[s] - without.count(s))
            if len(out) == n:
                break
        return out


def _best_pair(counts: _Counts, room: int, first: int) -> tuple[int, int] | None:
    """The two pieces of largest sum within ``room``, besides one of length ``first``; the more equal one of ties."""
    best = None
    for a in counts.sizes:
        if counts.left[a] <= (a == first):
            continue
        b = counts.at_most(room - a, (first, a))
        if b is None or b < a:
            continue
        if best is None or a + b >= sum(best):
            best = (b, a)
        if sum(best) == room and b - a <= 1:
            break
    return best


def dominant(counts: _Counts, size: int, capacity: int) -> tuple[int, ...] | None:
    """Pieces that go with one of length ``size`` in some optimal packing, or None if not proven.

    Martello and Toth's rules for sets of at most three: (1) nothing fits: the piece alone; (2) one
    piece fills the bin, or two more never fit: the largest piece that fits; (3) three more never
    fit: the largest single one if it is as large as the best pair together, or the best pair if
    it dominates every other pair and single one.
    """
    room = capacity - size
    one = counts.at_most(room, (size,))
    if one is None:
        return ()
    if one == room:
        return (one,)
    small = counts.least(3, (size,))
    if len(small) < 2 or small[0] + small[1] > room:
        return (one,)
    if len(small) < 3 or sum(small) > room:
        pair = _best_pair(counts, room, size)
        if pair is None or one >= sum(pair):
            return (one,)
        if pair[0] == one and not _beaten(counts, pair, room, size):
            return pair
    return None


def _beaten(counts: _Counts, pair: tuple[int, int], room: int, size: int) -> bool:
    """Whether two pieces fit that are both longer than the shorter one of ``pair``."""
    for a in counts.sizes:
        if counts.left[a] <= (a == size) or a <= pair[1]:
            continue
        b = counts.at_most(min(room - a, pair[0]), (size, a))
        if b is not None and b > pair[1]:
            return True
    return False


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Fix bins that some optimal packing has; return them and the counts of what remains.

    Goes through the lengths from the largest down, and again until a round fixes nothing. Equal
    bins are fixed together, as many as the rule holds for.
    """
    left, fixed, again = _Counts(counts), [], True
    while again:
        again = False
        for size in sorted(left.sizes, reverse=True):
            while size in left.left:
                rest = dominant(left, size, capacity)
                if rest is None:
                    break
                need: dict[int, int] = defaultdict(int)
                for s in (size, *rest):
                    need[s] += 1
                # what is left only shrinks, so a set that dominates now does so while it lasts
                n = min(left.left[s] // k for s, k in need.items())
                for s, k in need.items():
                    left.take(s, n * k)
                fixed.append(Group(n, tuple(sorted(need.items(), reverse=True))))
                again = True
    return fixed, left.left


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best fit, longest first: a piece goes where the least room is left that still takes it."""
    rooms: dict[int, list[list]] = defaultdict(list)  # room -> [bins, items]
    order: list[int] = []

    def put(room: int, bins: int, items: tuple) -> None:
        if not rooms[room]:
            bisect.insort(order, room)
        rooms[room].append([bins, items])

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            i = bisect.bisect_left(order, size)
            if i == len(order):
                each = capacity // size
                if n >= each:
                    put(capacity - each * size, n // each, ((size, each),))
                if n % each:
                    put(capacity - n % each * size, 1, ((size, n % each),))
                n = 0
                break
            room = order[i]
            bins, items = rooms[room].pop()
            if not rooms[room]:
                order.pop(i)
            each = room // size
            full = min(bins, n // each)
            if full:
                put(room - each * size, full, (*items, (size, each)))
                n -= full * each
                bins -= full
            if n and n < each and bins:
                put(room - n * size, 1, (*items, (size, n)))
                n, bins = 0, bins - 1
            if bins:
                put(room, bins, items)
    return [Group(bins, items) for room in order for bins, items in rooms[room]]


def plan(counts: dict[int, int], capacity: int) -> list[Group]:
    """Groups of equal bins that hold all pieces of ``counts`` (length -> how many)."""
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of a length go, by rank: (length, first, each, past, sequence, offset).

    Ranks from ``first`` to before ``past`` fill the sequences from ``sequence`` on, ``each`` of them
    in one, from ``offset`` on.
    """
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for g in groups:
        offset = 0
        for size, each in g.items:
            first = used[size]
            used[size] += g.bins * each
            rows.append((size, first, each, used[size], sequence, offset))
            offset += size * each
        sequence += g.bins
    return rows


def pieces(df: DataFrame, tokenizer_path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32.

    Whole texts are encoded and ``end_id`` added; only documents longer than ``capacity`` are cut.
    """
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        for batch in batches:
            for part in c.small_parts(batch, 1, AT_ONCE):
                ids, offsets = with_end(*encoder.encode(part.column(1)), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                sizes = np.diff(offsets)
                n_pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n_pieces)
                at = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = at * capacity
                length = np.minimum(capacity, sizes[row] - start)
                first = offsets[row] + start
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(first.tolist(), (first + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return df.select(key, text).mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(df: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents of ``df``: the columns of ``pieces``, sequence_id and offset.

    A null or empty text is its end id alone; null keys and repeated rows are packed like others;
    other columns are left out; an empty table gives no rows. Of all documents, the driver sees
    how many pieces each length has: ``capacity`` numbers at most.
    """
    spark = df.sparkSession
    made = pieces(df, tokenizer_path, end_id, capacity, key, text)
    staged = c.materialise(made.withColumn("slot", F.spark_partition_id()), "pieces")
    counts = {r["length"]: r["n"] for r in staged.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = places(plan(counts, capacity))
    # the rank of a piece among those of its length: all of earlier slots, then those before it in its own
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = staged.groupBy("length", "slot").agg(F.count("*").alias("n"))
    base = base.select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("slot", "length").orderBy(F.col("doc_id").asc_nulls_first(), "piece", "ids_crc32")
    ranked = staged.withColumn("own", F.row_number().over(own) - 1).join(base, ["length", "slot"]).withColumn("rank", F.col("before") + F.col("own"))
    where = spark.createDataFrame(rows, "size bigint, first bigint, each bigint, past bigint, sequence bigint, at bigint")
    placed = ranked.join(
        c.maybe_broadcast(where),
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")),
    )
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"),
    )
