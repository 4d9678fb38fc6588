"""Merge blocks that continue each other on one diagonal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KEYS = ["read_idx", "target_id", "strand"]
_PLACES = ["q1", "q2", "t1", "t2"]
_MERGED = "read_idx bigint, q_start bigint, q_end bigint, target_id string"


class _Fold:
    """The running block of a sorted stream, carried from batch to batch."""

    def __init__(self, max_gap: int):
        self.gap, self.key, self.block = max_gap, None, None
        self.out: list[tuple] = []

    def close(self) -> None:
        if self.block is not None:
            self.out.append((self.key[0], self.block[0], self.block[1], self.key[1]))
            self.block = None

    def run(self, key: tuple, rows: list[tuple]) -> None:
        """Blocks of one read, target and strand, in order, after those before."""
        if key != self.key:
            self.close()
            self.key = key
        gap, plus = self.gap, key[2] == "+"
        for a, b, x, y in rows:
            p = self.block
            if p is not None:
                q, t = a - p[1], x - p[3] if plus else p[2] - y
                if q < gap and t < gap and abs(q - t) < gap:
                    p[1] = max(p[1], b)
                    if plus:
                        p[3] = max(p[3], y)
                    else:
                        p[2] = min(p[2], x)
                    continue
                self.close()
            self.block = [a, b, x, y]

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = [list(c) for c in zip(*rows)] if rows else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["read_idx", "q_start", "q_end", "target_id"])


def merge_blocks(blocks: DataFrame, max_gap: int = 50) -> DataFrame:
    """(read_idx, q_start, q_end, target_id): colinear blocks of a read, a target and a strand as one.

    In the order of (q1, q2, t1, t2), a block joins the running one if the gaps on both sides are below
    ``max_gap`` and differ by less than that; else it becomes the running one. One shuffle by read, target and strand and a sort, which
    Spark spills; then one pass in which a task holds a batch and one running block, in time linear in the blocks, however
    many one read has. The next step groups by read, so reads of one key are together already.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Fold(max_gap)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c) for c in KEYS]
            codes = [np.asarray(k.dictionary_encode().indices.fill_null(-1)) for k in keys]
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in codes])) + 1
            places = list(zip(*(batch.column(c).to_pylist() for c in _PLACES)))
            edges = [0, *new.tolist(), batch.num_rows]
            heads = list(zip(*(k.take(pa.array(edges[:-1])).to_pylist() for k in keys)))
            for key, a, b in zip(heads, edges, edges[1:]):
                state.run(key, places[a:b])
            yield state.taken()
        state.close()
        yield state.taken()

    ordered = blocks.select(*KEYS, *_PLACES).repartition(*KEYS).sortWithinPartitions(*KEYS, *_PLACES)
    return ordered.mapInArrow(fold, _MERGED)
