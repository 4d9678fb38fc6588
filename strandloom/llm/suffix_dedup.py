"""Exact substring deduplication: maximal repeats from an enhanced suffix array's common-prefix intervals.

A suffix array of all bytes of a corpus doesn't fit a cluster's shuffle, and needn't be made: a repeat of ``length`` bytes
shows at a sampled place. Every window of ``length`` bytes picks the k-gram of smallest hash in it (winnowing), so equal windows
pick the same one, at the same offset. Windows side by side that pick one place are a *run*; the suffix array is made
for runs, in buckets of one k-gram:

1. Equal runs (by 128 bits of hashes, 64 of the k-gram and 64 of the whole run) are one class; all members but the first repeat as a whole.
   A task joins its own equal runs before anything is shuffled, so a frequent passage is one row a task.
2. Classes that share a k-gram with another class may repeat in part. Their first members' bytes meet in a bucket: suffixes that start
   at the windows of the runs are sorted, neighbours' common prefixes make the interval tree, a stack scan finds its
   intervals, and those whose suffixes have different bytes on their left are the maximal repeats (an interval with one
   left byte is part of the longer one that starts there). A run's first window counts as different, as the
   run ends there. Each interval gives all occurrences, and all but the first repeat.
3. A k-gram that very many different runs share (the edge of a passage that a third of all documents hold) goes another way:
   each of its windows is a row of its own, keyed by 128 bits of its hash, so the group spreads over tasks. Which
   k-grams do is found by a pass over all documents. There are at most ``HEAVIEST``, as each holds a larger share of the runs than that allows.

Results don't depend on which way a k-gram goes. Documents with repeated or null keys: see ``keyed``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strandloom.llm._common import materialise

LENGTH = 100
#: Windows of a longer text are worked on in segments of so many.
SEGMENT = 1 << 18
#: A task joins its equal runs at so many, and hands them on.
AT_ONCE = 1 << 21
#: A k-gram is heavy from so many different runs on, and above this share of all runs: 500,000 numbers are 4 MB.
HEAVY, HEAVIEST = 2048, 500_000
#: Runs in a bucket, and runs whose bytes are in a bucket, on average.
BUCKET, SUFFIX_BUCKET = 1 << 16, 1 << 13
#: Buckets at least, so that tasks get about equal numbers of them.
LEAST_BUCKETS = 1024

_RUN = np.dtype([("gram", "<u8"), ("body", "<u8"), ("key", "<i8"), ("lo", "<u4"), ("n", "<u2")])
_WINDOW = np.dtype([("h", "<u8"), ("g", "<u8"), ("key", "<i8"), ("lo", "<u4")])
_MARK = np.dtype([("key", "<i8"), ("lo", "<u4"), ("hi", "<u4"), ("first_key", "<i8"), ("first_lo", "<u4")])
_RUNS, _WINDOWS, _MARKS = 0, 1, 2
_FOUND = "key bigint, lo int, hi int, first_key bigint, first_lo int, gram bigint"
_REPEATS = "key bigint, lo int, hi int, first_key bigint, first_lo int"


class _Rolling:
    """Polynomial hashes modulo 2^64 of any stretch of a buffer, from running sums; odd random values stand for bytes."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.of = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(0, 1 << 60)) * 8 + 5
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:
            each = (1 << 64) - 1
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, self.base & each, np.uint64))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, pow(self.base, -1, 1 << 64), np.uint64))])
        out = np.zeros(n, np.uint64)
        np.cumsum(self.of[data] * self.up[: n - 1], out=out[1:])
        return out

    def between(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (sums[hi] - sums[lo]) * self.down[lo]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_HASHES: dict[int, _Rolling] = {}


def _rolling(seed: int) -> _Rolling:
    """One for a worker, as its powers grow with the longest buffer."""
    return _HASHES.setdefault(seed, _Rolling(seed))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values side by side, by doubling."""
    step = 1
    while 2 * step <= width:
        values, step = np.minimum(values[:-step], values[step:]), 2 * step
    return np.minimum(values[: len(values) - (width - step)], values[width - step :]) if step < width else values


def _gram_length(length: int) -> int:
    return max(2, length // 4)


def _runs(data: np.ndarray, key: int, length: int) -> Iterator[np.ndarray]:
    """The runs of one document."""
    k = _gram_length(length)
    rolling = _rolling(1)
    for at in range(0, max(len(data) - length + 1, 0), SEGMENT):
        own = data[at : at + SEGMENT + length - 1]
        sums = rolling.sums(own)
        n = len(own) - k + 1
        gram = _mix((sums[k:] - sums[:n]) * rolling.down[:n])
        low = np.uint64((1 << (SEGMENT + length).bit_length()) - 1)
        # the low bits are the place, so equal hashes fall to the one on the left, wherever the window stands
        pick = _least((gram & ~low) | np.arange(n, dtype=np.uint64), length - k + 1)
        lo = np.flatnonzero(np.concatenate([[True], pick[1:] != pick[:-1]]))
        hi = np.concatenate([lo[1:], [len(pick)]])
        out = np.empty(len(lo), _RUN)
        place = (pick[lo] & low).astype(np.int64)
        out["gram"] = gram[place]
        out["body"] = _mix(rolling.between(sums, lo, hi + length - 1) + np.uint64(0x9E3779B97F4A7C15) * ((hi - lo) * 1024 + (place - lo)).astype(np.uint64))
        out["key"], out["lo"], out["n"] = key, at + lo, hi - lo
        yield out


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(key, bytes) of the rows of (key, data), without copies."""
    data = batch.column("data")
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    buffer = data.buffers()[2]
    every = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    for key, lo, hi in zip(batch.column("key").to_numpy(), offsets[:-1].tolist(), offsets[1:].tolist()):
        yield int(key), every[lo:hi]


def _new(sorted_rows: np.ndarray, *fields: str) -> np.ndarray:
    """Which rows differ from the one before in any of the fields."""
    out = np.ones(len(sorted_rows), bool)
    if len(sorted_rows):
        out[1:] = np.logical_or.reduce([sorted_rows[f][1:] != sorted_rows[f][:-1] for f in fields])
    return out


def _marks(rows: np.ndarray, new: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All rows but the first of each class, which ``new`` begins, as marks that name the first."""
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, np.int64)
    out = np.empty(int((~new).sum()), _MARK)
    out["key"], out["lo"], out["hi"] = rows["key"][~new], rows["lo"][~new], ends[~new]
    out["first_key"], out["first_lo"] = rows["key"][first[~new]], rows["lo"][first[~new]]
    return out


def _join_equal(runs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first of each class of equal runs, in order of k-grams, and marks for the others."""
    runs = runs[np.lexsort((runs["lo"], runs["key"], runs["body"], runs["gram"]))]
    new = _new(runs, "gram", "body")
    return runs[new], _marks(runs, new, runs["lo"] + runs["n"] + np.uint32(length - 1))


def _packed(kind: int, rows: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows as one binary value for each bucket."""
    if not len(rows):
        return
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    edges = [*np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist(), len(rows)]
    blobs = [rows[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[edges[:-1]].astype(np.int32)), pa.array(np.full(len(blobs), kind, np.int32)), pa.array(blobs, pa.binary())], ["bucket", "kind", "rows"]
    )


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, data): the text's UTF-8 bytes, null as empty, under unique keys in the order of documents.

    The key is ``doc_id`` where no two rows share one and none is null. Else rows are numbered: null first, then
    by ``doc_id``; rows of one ``doc_id`` are documents of their own, in the order of their texts' MD5.
    """
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be a whole number")
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    if own.groupBy("doc_id").count().where("`count` > 1 or doc_id is null").isEmpty():
        return own.select(F.col("doc_id").alias("key"), "doc_id", "data")
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")]
    numbered = own.withColumns({"digest": F.md5("data"), "row": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(numbered.select(F.monotonically_increasing_id().alias("key"), "doc_id", "data"), "numbered")


def _heavy(docs: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """K-grams of very many different runs, at most ``HEAVIEST``, and the number of all runs. A task reports those that are many in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n, total = [], 0, 0

        def report() -> Iterator[pa.RecordBatch]:
            first, _ = _join_equal(np.concatenate(kept), length)
            grams, times = np.unique(first["gram"], return_counts=True)
            many = times >= max(8, len(first) // 4096)
            yield pa.RecordBatch.from_arrays([pa.array(grams[many].view(np.int64)), pa.array(times[many])], ["gram", "n"])

        for batch in batches:
            for key, data in _documents(batch):
                for runs in _runs(data, key, length):
                    kept.append(runs)
                    n, total = n + len(runs), total + len(runs)
                if n >= AT_ONCE:
                    yield from report()
                    kept, n = [], 0
        if kept:
            yield from report()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["gram", "n"])

    counts = materialise(docs.select("key", "data").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = counts.where("gram is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = counts.where("gram is not null").where(F.col("n") >= max(HEAVY, total // HEAVIEST + 1)).select("gram").toPandas()["gram"].to_numpy(np.int64)
    return np.sort(heavy.view(np.uint64)), total


def _classes(docs: DataFrame, length: int) -> DataFrame:
    """Marks (``gram`` null) and first members of classes that share a k-gram with another class, at rest."""
    heavy, total = _heavy(docs, length)
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    n_buckets = max(LEAST_BUCKETS, total // BUCKET)

    def hand_on(runs: np.ndarray, texts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        first, marks = _join_equal(runs, length)
        grams = shared.value
        at = np.searchsorted(grams, first["gram"])
        is_heavy = np.zeros(len(first), bool) if not len(grams) else grams[np.minimum(at, len(grams) - 1)] == first["gram"]
        yield from _packed(_RUNS, first[~is_heavy], (first["gram"][~is_heavy] % np.uint64(n_buckets)).astype(np.int64))
        if is_heavy.any():
            rows = []
            for run in first[is_heavy]:
                lo = np.arange(int(run["n"]))
                own = texts[int(run["key"])][int(run["lo"]) : int(run["lo"]) + int(run["n"]) + length - 1]
                out = np.empty(len(lo), _WINDOW)
                for name, seed in (("h", 1), ("g", 2)):
                    rolling = _rolling(seed)
                    out[name] = _mix(rolling.between(rolling.sums(own), lo, lo + length))
                out["key"], out["lo"] = run["key"], run["lo"] + lo
                rows.append(out)
            windows = np.concatenate(rows)
            windows = windows[np.lexsort((windows["lo"], windows["key"], windows["g"], windows["h"]))]
            new = _new(windows, "h", "g")
            marks = np.concatenate([marks, _marks(windows, new, windows["lo"] + np.uint32(length))])
            yield from _packed(_WINDOWS, windows[new], (windows["h"][new] % np.uint64(n_buckets)).astype(np.int64))
        yield from _packed(_MARKS, marks, marks["key"] % n_buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        texts: dict[int, np.ndarray] = {}
        n = 0
        for batch in batches:
            for key, data in _documents(batch):
                texts[key] = data
                for runs in _runs(data, key, length):
                    kept.append(runs)
                    n += len(runs)
                if n >= AT_ONCE:
                    yield from hand_on(np.concatenate(kept), texts)
                    kept, texts, n = [], {}, 0
        if kept:
            yield from hand_on(np.concatenate(kept), texts)

    def meet(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        blobs = table.column("rows").to_pylist()

        def of(kind: int, dtype: np.dtype) -> np.ndarray:
            return np.frombuffer(b"".join(b for b, k in zip(blobs, kinds) if k == kind), dtype)

        runs, marks = _join_equal(of(_RUNS, _RUN), length)
        new = _new(runs, "gram")
        mixed = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1 if len(runs) else np.zeros(0, bool)
        asked = runs[mixed]
        windows = of(_WINDOWS, _WINDOW)
        windows = windows[np.lexsort((windows["lo"], windows["key"], windows["g"], windows["h"]))]
        more = _marks(windows, _new(windows, "h", "g"), windows["lo"] + np.uint32(length))
        every = np.concatenate([of(_MARKS, _MARK), marks, more])
        own, none = len(every), len(asked)

        def column(a: np.ndarray, b: np.ndarray, to: type) -> pa.Array:
            return pa.array(np.concatenate([a.astype(to), b.astype(to)]))

        blank = np.arange(own + none) >= own
        return pa.table(
            {
                "key": column(every["key"], asked["key"], np.int64),
                "lo": column(every["lo"], asked["lo"], np.int32),
                "hi": column(every["hi"], asked["lo"] + asked["n"] + np.uint32(length - 1), np.int32),
                "first_key": pa.array(np.concatenate([every["first_key"], asked["key"]]), mask=blank),
                "first_lo": pa.array(np.concatenate([every["first_lo"], asked["lo"]]).astype(np.int32), mask=blank),
                "gram": pa.array(np.concatenate([np.zeros(own, np.int64), asked["gram"].view(np.int64) if none else np.zeros(0, np.int64)]), mask=~blank),
            }
        )

    packed = docs.select("key", "data").mapInArrow(cut, "bucket int, kind int, rows binary")
    return materialise(packed.groupBy("bucket").applyInArrow(meet, _FOUND), "classes")


def maximal_repeats(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of at least ``length`` bytes among the stretches data[begins[i]:ends[i]], which are sorted and don't overlap.

    Suffixes start at each place of a stretch that has ``length`` bytes, and end with the stretch. Returns the suffix
    array (places in ``data``), each place's stretch, and of each common-prefix interval with different left bytes its common length,
    first and last index in the array: all occurrences of one maximal repeat.
    """
    count = np.maximum(ends - begins - length + 1, 0)
    stretch = np.repeat(np.arange(len(begins)), count)
    place = begins[stretch] + np.arange(len(stretch)) - np.repeat(np.cumsum(count) - count, count)
    empty = np.zeros(0, np.int64)
    if len(place) < 2:
        return empty, empty, empty, empty, empty
    # suffixes whose first ``length`` bytes no other has are in no interval; nor are needed those of one left byte
    rolling = _rolling(1)
    h = rolling.between(rolling.sums(data), place, place + length)
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    heads = np.flatnonzero(new)
    left = np.where(place == begins[stretch], -1, data[np.maximum(place - 1, 0)].astype(np.int64))
    low, high = np.minimum.reduceat(left[order], heads), np.maximum.reduceat(left[order], heads)
    use = (np.diff(np.append(heads, len(order))) > 1) & ((low != high) | (low < 0))
    chosen = np.sort(order[use[np.cumsum(new) - 1]])
    place, stretch, left = place[chosen], stretch[chosen], left[chosen]
    if len(place) < 2:
        return empty, empty, empty, empty, empty

    size = ends[stretch] - place
    width = int(size.max())
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[place]
    rows[np.arange(width) >= size[:, None]] = 0
    by_size = np.argsort(size, kind="stable")
    array = by_size[np.argsort(np.ascontiguousarray(rows[by_size]).view(f"S{width}").ravel(), kind="stable")]
    rows, size, left = rows[array], size[array], left[array].tolist()
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(size[1:], size[:-1]))
    common = np.append(np.where(common >= length, common, 0), 0).tolist()

    found: list[tuple[int, int, int]] = []
    stack: list[list[int]] = []  # common length, first index, left byte or -1 for different ones
    for i, depth in enumerate(common):
        first, byte = i, left[i]
        while stack and stack[-1][0] > depth:
            own_depth, first, own_byte = stack.pop()
            byte = byte if byte == own_byte else -1
            if byte < 0:
                found.append((own_depth, first, i))
        if stack and stack[-1][0] == depth:
            if stack[-1][2] != byte:
                stack[-1][2] = -1
        elif depth:
            stack.append([depth, first, byte])
    depths, firsts, lasts = np.array(found, np.int64).reshape(-1, 3).T
    return place[array], stretch[array], depths, firsts, lasts


def _partial(docs: DataFrame, asked: DataFrame, length: int, links: bool) -> DataFrame:
    """Repeats between the runs that ``asked`` names, in buckets of whole k-grams. Without ``links``, a run's repeated bytes come as few stretches."""
    n_buckets = max(LEAST_BUCKETS, asked.count() // SUFFIX_BUCKET)
    own = asked.groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "gram")).alias("runs"))
    cut = F.transform("runs", lambda r: F.struct(r["gram"].alias("gram"), r["lo"].alias("lo"), F.substring(F.col("data"), r["lo"] + 1, r["hi"] - r["lo"]).alias("body")))
    bodies = docs.join(own, "key").select("key", F.explode(cut).alias("r")).select("key", "r.*")

    def scan(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("lo").to_numpy(), table.column("key").to_numpy()))
        key, lo = table.column("key").to_numpy()[order], table.column("lo").to_numpy()[order].astype(np.int64)
        body = table.column("body").take(pa.array(order)).to_pylist()
        ends = np.cumsum([len(b) for b in body], dtype=np.int64)
        begins = ends - np.array([len(b) for b in body], np.int64)
        array, stretch, depth, first, last = maximal_repeats(np.frombuffer(b"".join(body), np.uint8), begins, ends, length)
        # stretches are in the order of documents, so the earliest occurrence is the one at the smallest place
        size = last - first + 1
        group = np.repeat(np.arange(len(size)), size)
        each = array[first[group] + np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)] if len(size) else np.zeros(0, np.int64)
        of = np.searchsorted(begins, each, side="right") - 1
        # two runs of one document may overlap, so the earliest is by document and place in it
        rank = np.lexsort((lo[of] + each - begins[of], key[of], group))
        new = np.concatenate([[True], group[rank][1:] != group[rank][:-1]]) if len(rank) else np.zeros(0, bool)
        head = rank[np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))] if len(rank) else rank
        rest, source = rank[~new], head[~new]
        at = lambda i: lo[of[i]] + each[i] - begins[of[i]]
        if not links:
            # a byte is repeated or not: what overlaps in a run is one stretch, however many intervals hold it
            apart = np.int64(1 << 20)
            rest = rest[np.lexsort((each[rest], of[rest]))]
            start, reach = each[rest] + of[rest] * apart, np.maximum.accumulate(each[rest] + depth[group[rest]] + of[rest] * apart)
            heads = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if len(rest) else rest
            first_of, size = rest[heads], reach[np.append(heads[1:] - 1, len(rest) - 1)] - start[heads] if len(rest) else rest
            none = pa.nulls(len(heads), pa.int64())
            return pa.table({"key": pa.array(key[of[first_of]]), "lo": pa.array(at(first_of).astype(np.int32)), "hi": pa.array((at(first_of) + size).astype(np.int32)), "first_key": none, "first_lo": none.cast(pa.int32())})
        return pa.table(
            {
                "key": pa.array(key[of[rest]]),
                "lo": pa.array(at(rest).astype(np.int32)),
                "hi": pa.array((at(rest) + depth[group[rest]]).astype(np.int32)),
                "first_key": pa.array(key[of[source]]),
                "first_lo": pa.array(at(source).astype(np.int32)),
            }
        )

    bucket = F.pmod(F.xxhash64("gram"), F.lit(n_buckets)).cast("int")
    return bodies.select(bucket.alias("bucket"), "key", "lo", "body").groupBy("bucket").applyInArrow(scan, _REPEATS)


def find_repeats(docs: DataFrame, length: int = LENGTH, links: bool = True) -> DataFrame:
    """(key, lo, hi, first_key, first_lo): bytes lo to hi of a document of ``keyed`` repeat those that start at first_lo in an earlier place.

    A maximal repeat comes as its occurrences after the first, each with a link to it. A long repeat comes in overlapping
    stretches, run by run. Without ``links`` a run's overlapping occurrences are one row, whose link is null: the number of rows
    follows the runs, and not how often repeats are nested in each other.
    """
    if length < 8:
        raise ValueError("length must be at least 8")
    found = _classes(docs, length)
    whole = found.where("gram is null").select("key", "lo", "hi", "first_key", "first_lo")
    return whole.unionByName(_partial(docs, found.where("gram is not null").select("key", "lo", "hi", "gram"), length, links))


def deduplicate(docs: DataFrame, length: int = LENGTH, with_bytes: bool = False) -> DataFrame:
    """Remove each byte that a string of ``length`` bytes covers which also starts earlier: in a smaller ``doc_id``, or before in the same text.

    Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), and with ``with_bytes`` ``spans`` (the maximal removed
    runs, as lists of begin and end) and ``kept``, the other bytes, which may begin or end within a character. Strings overlap
    and are judged on the input. Texts shorter than ``length``, empty and null ones lose nothing; an empty
    table gives no rows. Of equal rows all but one lose their text. Other columns aren't read.
    """
    rows = keyed(docs)
    spans = find_repeats(rows, length, links=False).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    joined = rows.join(spans, "key", "left").select("key", "doc_id", "data", F.col("found.lo").alias("lo"), F.col("found.hi").alias("hi"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            los, his = batch.column("lo"), batch.column("hi")
            for i, (_, data) in enumerate(_documents(batch)):
                begin = end = np.zeros(0, np.int64)
                if los[i].is_valid:
                    lo, hi = los[i].values.to_numpy().astype(np.int64), his[i].values.to_numpy().astype(np.int64)
                    order = np.argsort(lo, kind="stable")
                    lo, reach = lo[order], np.maximum.accumulate(hi[order])
                    new = np.concatenate([[True], lo[1:] > reach[:-1]])
                    begin, end = lo[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)]
                edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
                values = (len(data), int((end - begin).sum()), len(begin), hashlib.sha256(kept).hexdigest())
                for column, value in zip(out, (*values, np.stack([begin, end], 1).tolist() if with_bytes else None, kept if with_bytes else None)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(out, kinds)][: 6 if with_bytes else 4]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names[: len(columns) + 1])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.mapInArrow(remove, schema + (", spans array<array<bigint>>, kept binary" if with_bytes else ""))
