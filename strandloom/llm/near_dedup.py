"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

Banding with L tables of k hashes each needs L*k minhashes. Tensoring makes two small collections of
m groups of k/2 hashes and forms m*m table keys from pairs of groups, one of each: 2*m*k/2 minhashes
for m*m tables, about the square root of the work. Documents that share a key are candidates. Links
among them are confirmed on the whole sets of shingles, in steps that emit no group's pairs:

1. PIVOTS times, every bucket compares one of its sets, its pivot, with all others; the pivot has then met all of
   its bucket and leaves it, and a bucket whose sets are all connected is closed;
2. sets of buckets that are open after that meet where they share one of their rarest shingles. Sets that are
   similar enough do (prefix filtering), so this is exact however large a bucket is. Only pairs that would join two
   components come out, and only where lengths, places and bit maps of the two sets leave room for the similarity.
   Shingles that no other set holds are known not to be shared, and what two sets share cancels out in their maps, so
   members of a large family that aren't similar enough mostly make no row.

All steps lose no link between candidates that would join two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm import _common as c

#: Groups in each of the two collections, and minhashes in a group: 72 minhashes make 144 tables of 6.
#: Two sets of similarity 0.8 share a key with probability 0.9996, of 0.85 with 0.99998.
GROUPS, ROWS = 12, 3
#: Longs in the bit map of a set.
MAP_LONGS = 16
#: Rounds in which each open bucket compares one set with all others.
PIVOTS = 2
#: Texts of about so many characters are turned into arrays of shingles at once.
TEXTS_AT_ONCE = 1 << 21

_SEED = np.random.default_rng(20_240_001)
_MULTIPLIERS = _SEED.integers(1, 2**63, 2 * GROUPS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Values of a block of shingles that are hashed at once, so a long text needs no large array.
_BLOCK = 4096


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``.

    A-Z are lower-cased and words are what stands between ASCII white space. A text with fewer
    words makes one shingle of all of them; one without words has none.
    """
    raw = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not raw:
        return np.empty(0, dtype=np.uint64)
    if len(raw) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(raw), seed=1)], dtype=np.uint64)
    known: dict[bytes, int] = {}
    for w in set(raw):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, raw), dtype=np.uint64, count=len(raw))
    n = len(h) - words + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        out = (out ^ h[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def group_hashes(found: np.ndarray) -> np.ndarray:
    """The 2 * GROUPS hashes of a set: each of the minimum values of ROWS hash functions."""
    low = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(found), _BLOCK):
        x = found[i : i + _BLOCK, None] * _MULTIPLIERS[None, :]
        x ^= x >> np.uint64(31)
        low = np.minimum(low, (x * _MIX).min(axis=0))
    by_group = low.reshape(2 * GROUPS, ROWS)
    out = np.zeros(2 * GROUPS, dtype=np.uint64)
    for k in range(ROWS):
        out = (out ^ by_group[:, k]) * _MIX
        out ^= out >> np.uint64(32)
    return out


def bit_map(found: np.ndarray) -> np.ndarray:
    """Whether odd many of the shingles fall on each bit.

    In the exclusive or of two maps, shingles of both sets cancel out: it is the map of those that one set alone has,
    and can't have more bits than there are of these.
    """
    at = ((found >> np.uint64(17)) % np.uint64(MAP_LONGS * 64)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=MAP_LONGS * 64) & 1).astype(np.uint8)).view(np.int64)


def sketches(df: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """For each row: node (the key), n_shingles, set_key (128 bits of the whole set), groups, bits."""
    kind = df.schema[key].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            for part in c.small_parts(batch, 1, TEXTS_AT_ONCE):
                n, keys, groups, bits = [], [], [], []
                for t in part.column(1):
                    found = shingles(t.as_py(), words)
                    n.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    groups.append(group_hashes(found).view(np.int64) if len(found) else None)
                    bits.append(bit_map(found) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(groups, longs), pa.array(bits, longs)],
                    names=["node", "n_shingles", "set_key", "groups", "bits"],
                )

    schema = f"node {kind}, n_shingles bigint, set_key binary, groups array<bigint>, bits array<bigint>"
    return df.select(key, text).mapInArrow(sketch, schema)


def _whole_sets(df: DataFrame, wanted: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """(node, set_key, own): the whole shingle sets of the wanted nodes, worked out again from their texts."""
    kind = df.schema[key].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in c.small_parts(batch, 1, TEXTS_AT_ONCE):
                own = [shingles(t.as_py(), words).view(np.int64) for t in part.column(1)]
                keys = [xxhash.xxh3_128_digest(x.tobytes()) for x in own]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), pa.array(own, pa.list_(pa.int64()))], names=["node", "set_key", "own"])

    docs = df.select(F.col(key).alias("node"), F.col(text).alias("text"))
    return docs.join(c.maybe_broadcast(wanted), "node", "left_semi").mapInArrow(sets, f"node {kind}, set_key binary, own array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose whole sets have 100 * intersection >= percent * union.

    The set of ``b`` comes first and moves to where that of ``a`` is, so a pivot ``a`` of many pairs is read there, not sent with each.
    """
    left = sets.select(F.col("node").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("node").alias("b"), F.col("own").alias("own_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("own_a", "own_b"))
    counted = both.select(*pairs.columns, common.alias("common"), (F.size("own_a") + F.size("own_b")).alias("total"))
    return counted.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select(*pairs.columns)


def _differing_bits(a: str, b: str) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(MAP_LONGS)])


def buckets(reps: DataFrame) -> DataFrame:
    """(bucket, node) of all table keys that more than one set has.

    The 2 * GROUPS group hashes are counted first. Only hashes that some other set has go on to be combined
    in pairs, so a set that is like no other makes no table keys.
    """
    single = reps.select("node", F.posexplode("groups").alias("at", "hash"))
    shared = single.groupBy("at", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    mine = single.join(shared, ["at", "hash"]).groupBy("node").agg(F.collect_list(F.struct("at", "hash")).alias("own"))
    first = F.filter("own", lambda x: x["at"] < GROUPS)
    second = F.filter("own", lambda x: x["at"] >= GROUPS)
    keys = F.flatten(F.transform(first, lambda x: F.transform(second, lambda y: F.xxhash64(x["at"], y["at"], x["hash"], y["hash"]))))
    return mine.select("node", F.explode(keys).alias("bucket"))


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(*[F.col(x).alias(f"{x}_{side}") for x in rows.columns])


def _can_link(percent: int) -> Column:
    """Whether components differ, and lengths and bit maps of two sides leave room for the similarity."""
    # similarity >= percent/100 means: differing shingles * (100 + percent) <= total * (100 - percent)
    room = (100 + percent) * _differing_bits("bits_a", "bits_b") <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return (F.col("component_a") != F.col("component_b")) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & room


def _joined(info: DataFrame, links: DataFrame) -> DataFrame:
    """``info`` with the components that ``links`` (component_a, component_b) connect made one."""
    merged = c.components(links.select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("last"))
    out = info.join(merged, "component", "left").withColumn("component", F.coalesce("last", "component")).drop("last")
    return c.materialise(out.select(*info.columns), "components")


def _open(active: DataFrame, info: DataFrame) -> DataFrame:
    """The rows (bucket, node) of buckets with more than one component."""
    at = active.join(info.select("node", "component"), "node")
    several = at.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    return c.materialise(active.join(several, "bucket", "left_semi").select("bucket", "node"), "open")


def _pivot_links(active: DataFrame, pivots: DataFrame, info: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the pivot of each bucket and its other sets, where they would join two components."""
    pairs = active.join(pivots, "bucket").where("node <> pivot").select(F.col("pivot").alias("node_a"), F.col("node").alias("node_b")).distinct()
    near = pairs.join(_side(info, "a"), "node_a").join(_side(info, "b"), "node_b").where(_can_link(percent))
    near = near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "component_a", "component_b").distinct()
    return c.materialise(_confirmed(near, sets, percent), "links")


def _rare_links(active: DataFrame, info: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between any two sets of ``active``, where they would join two components.

    Of n shingles in the order of how few of these sets hold them, two sets that are similar enough share one of their
    first n - ceil(percent/100 * n) + 1; those that one set alone holds need no row.
    """
    own = sets.join(active.select("node").distinct(), "node", "left_semi")
    each = c.materialise(own.select("node", "set_key", F.explode("own").alias("shingle")), "shingles")
    held = each.groupBy("shingle").agg(F.count("*").alias("held"))
    whole = Window.partitionBy("node", "set_key")
    # a row that is there twice has its set twice, so places are those of distinct shingles
    place = F.dense_rank().over(whole.orderBy("held", "shingle"))
    ranked = each.join(held, "shingle").withColumns({"place": place, "alone": F.count_if(F.col("held") == 1).over(whole)}).where("held > 1")
    rare = ranked.join(info, ["node", "set_key"]).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    rare = c.materialise(rare.select("shingle", "place", "alone", "node", "n", "bits", "component"), "rare")
    several = rare.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("shingle")
    rare = c.materialise(rare.join(several, "shingle", "left_semi"), "rare")
    a, b = (_side(rare, x).withColumnRenamed(f"shingle_{x}", "shingle") for x in "ab")
    # what both can share: up to the places at most all that aren't held alone, and what is left of either
    most = F.least(F.col("place_a") - F.col("alone_a"), F.col("place_b") - F.col("alone_b")) + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    fits = (F.col("component_a") < F.col("component_b")) & _can_link(percent) & ((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b")))
    near = a.join(b, "shingle").where(fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "component_a", "component_b").distinct()
    return c.materialise(_confirmed(c.materialise(near, "pairs"), sets, percent), "links")


def link(df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: the key, n_shingles, component_id, kept.

    Documents whose sets of distinct ``words``-word shingles have 100 * intersection >= ``percent`` * union are
    linked; ``component_id`` is the smallest key that links lead to, ``kept`` whether it is the own one.
    Texts without words and null texts have no shingles and are linked with nothing. Rows with
    the same key are one document: it is linked with what any of its texts is. Rows with a null key stay alone: their
    component is null and they are kept. Other columns of ``df`` are left out. Equal sets are brought together first, by a
    grouping with a partial step, so thousands of copies cost one row for each task.
    """
    sketch = c.materialise(sketches(df, words, key, text), "sketch")
    real = sketch.where("n_shingles > 0 and node is not null")
    reps = c.materialise(
        real.groupBy("set_key").agg(F.min("node").alias("node"), F.max("n_shingles").alias("n"), F.max("groups").alias("groups"), F.max("bits").alias("bits")),
        "sets",
    )
    rows = c.materialise(buckets(reps), "buckets")
    pivots = rows.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("bucket", "pivot")
    active = c.materialise(rows.join(pivots.select("bucket"), "bucket", "left_semi"), "active")
    wanted = c.materialise(active.select("node").distinct(), "wanted")
    sets = c.materialise(_whole_sets(df, wanted, words, key, text), "whole-sets")
    info = reps.select("node", "set_key", "n", "bits").join(wanted, "node", "left_semi").withColumn("component", F.col("node"))
    info = c.materialise(info, "components")
    for _ in range(PIVOTS):
        info = _joined(info, _pivot_links(active, pivots, info, sets, percent))
        active = _open(active.join(pivots, "bucket").where("node <> pivot"), info)
        # the smallest again: a family that shares many buckets has one pivot in most of them, so few pairs are told apart
        pivots = active.groupBy("bucket").agg(F.min("node").alias("pivot"))
    info = _joined(info, _rare_links(active, info, sets, percent))

    found = info.select("node", "component").distinct()
    classes = reps.select("set_key", "node").join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("class_id"))
    placed = c.materialise(real.select("node", "set_key").join(classes, "set_key").where("class_id <> node").select("node", "class_id").distinct(), "placed")
    # a key with several texts holds together the classes of all of them
    several = real.groupBy("node").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).where("x <> y").select("node")
    joints = real.join(several, "node", "left_semi").join(classes, "set_key").select(F.col("node").alias("a"), F.col("class_id").alias("b"))
    merged = c.components(joints).select(F.col("node").alias("class_id"), F.col("component").alias("last"))
    moved = placed.join(merged, "class_id", "left").select("node", F.coalesce("last", "class_id").alias("class_id"))
    moved = moved.unionByName(merged.select(F.col("class_id").alias("node"), F.col("last").alias("class_id"))).groupBy("node").agg(F.min("class_id").alias("class_id"))
    out = sketch.select("node", "n_shingles").join(c.materialise(moved, "moved"), "node", "left").select(
        F.col("node").alias(key), "n_shingles", F.coalesce("class_id", "node").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def oracle_sql(words: int = 3, percent: int = 85) -> str:
    """The rows of ``link`` for ``documents`` in DuckDB SQL: every pair that shares a shingle, then a recursive walk."""
    gram = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(words))
    return rf"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
g as (
  select distinct doc_id, unnest(case
    when len(w) = 0 then []
    when len(w) < {words} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {words - 2}), lambda i: {gram}) end) as gram
  from d
),
n as (select doc_id, count(*) as n from g group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from g a join g b on a.gram = b.gram and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (
  select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= {percent} * (na.n + nb.n - k)
),
steps as (select a, b from links union all select b, a from links),
walk as (
  select doc_id, doc_id as reached from d
  union
  select walk.doc_id, steps.b from walk join steps on steps.a = walk.reached
),
least as (select doc_id, min(reached) as component_id from walk group by doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, component_id = d.doc_id as kept
from d join least using (doc_id) left join n on n.doc_id = d.doc_id
"""
