"""The prefix trie of conversations, by ROLLUP over columns of turns.

A turn is a binary id: the MD5 of role and text, and the text's bytes. A conversation is cut into blocks of ``BLOCK`` turns, each a
row with a column for each turn and a key: the node at which the block before ended. ``GROUP BY block, key,
ROLLUP(t1, ..., t8)`` then gives every prefix of every block in one grouping, and ``grouping_id`` says how long it is. The key
is the exclusive or of 128 bits for each (place, turn) before, so all blocks are grouped at once, however long a conversation is, and
none waits for the one before. Sums over subtrees are a second ROLLUP, over the nodes; what lies in later blocks
is added to the node at which they begin, after log2(blocks) rounds of pointer doubling.

No conversation is in one row or one task: turns are ordered by ranges of (conversation, turn), and places are offsets of
ranges plus places in them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm._common import materialise

BLOCK = 8
TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]
#: Blocks of a conversation whose keys are summed by one task.
CHUNK = 512
KEY = ["depth", "x1", "x2"]
_LONG = "bigint"


def _bits(place: Column, turn: Column) -> tuple[Column, Column]:
    """128 bits for a turn at a place."""
    return F.xxhash64(place.cast(_LONG), turn), F.xxhash64(turn, place.cast(_LONG), F.lit(BLOCK))


def _turns(convs: DataFrame) -> DataFrame:
    """(conv_id, turn_id, part, row): turns in order. Rows without a ``conv_id`` belong to no conversation and are left out."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    turn_id = F.unhex(F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)), size))
    rows = convs.where("conv_id is not null").select(F.col("conv_id").cast(_LONG).alias("conv_id"), "turn", turn_id.alias("turn_id"))
    # the last key deals equal rows out
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id"), F.col("row")]
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    return materialise(ordered.select("conv_id", "turn_id", F.shiftright(row, 33).alias("part"), row.alias("row")), "turns")


def with_heads(convs: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, turn_id, total) of rebuilt conversations, and (conv_id, total) of all, also those without a turn.

    A conversation gets the first h turns of conversation c - c % ``family`` (all if it has fewer, none if there is no such
    conversation) in place of its own first h, h = crc32(c) % ``heads``. With ``heads`` = 1 every conversation is as it was.
    """
    turns = _turns(convs)
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("conv_id").agg(F.sum("n").alias("n_own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    base = F.col("conv_id") - F.col("conv_id") % family
    others = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    info = sizes.withColumns({"h": h, "base": base}).join(others, "base", "left")
    head = F.least("h", F.coalesce("n_base", F.lit(0)))
    info = info.select("conv_id", "h", head.alias("head"), (head + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("total"))
    info = materialise(info, "conversations")

    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(info, "conv_id")
    within = Window.partitionBy("conv_id", "part").orderBy("row")
    numbered = turns.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["conv_id", "part"])
    numbered = materialise(numbered.select("conv_id", "turn_id", (F.col("before") + F.col("nth")).alias("place"), "h", "head", "total"), "places")
    own = numbered.where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("place"), "turn_id", "total")
    near = F.explode(F.sequence(F.lit(1 - family), F.lit(family - 1)))
    given = numbered.where((F.col("conv_id") % family == 0) & (F.col("place") < heads - 1)).select(F.col("conv_id").alias("base"), "place", "turn_id", near.alias("k"))
    given = given.withColumn("conv_id", F.col("base") + F.col("k")).where(base == F.col("base"))
    given = given.join(info.select("conv_id", "h", "total"), "conv_id").where("place < h").select("conv_id", "place", "turn_id", "total")
    return own.unionByName(given), info.select("conv_id", "total")


def _blocks(turns: DataFrame) -> DataFrame:
    """A row for each block of a conversation: its key (p1, p2), turns, 128 bits, number of turns."""
    slot, (z1, z2) = F.col("place") % BLOCK, _bits(F.col("place"), F.col("turn_id"))
    columns = [F.max(F.when(slot == i, F.col("turn_id"))).alias(t) for i, t in enumerate(TURNS)]
    rows = turns.withColumns({"block": F.floor(F.col("place") / BLOCK), "z1": z1, "z2": z2})
    rows = rows.groupBy("conv_id", "block").agg(*columns, F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.count("*").alias("m"), F.max("total").alias("total"))
    rows = materialise(rows.withColumn("chunk", F.floor(F.col("block") / CHUNK)), "rows")

    def before(df: DataFrame, by: list[str], order: str, names: tuple[str, str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({n: F.coalesce(F.bit_xor(z).over(w), F.lit(0).cast(_LONG)) for n, z in zip(names, ("z1", "z2"))})

    chunks = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    chunks = before(chunks, ["conv_id"], "chunk", ("c1", "c2")).drop("z1", "z2")
    keyed = before(rows, ["conv_id", "chunk"], "block", ("p1", "p2")).join(chunks, ["conv_id", "chunk"])
    keys = {f"p{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"c{i}")) for i in (1, 2)}
    return materialise(keyed.withColumns(keys).drop("chunk", "c1", "c2"), "blocks")


def _rolled(df: DataFrame, *aggregates: str) -> DataFrame:
    """``aggregates`` for each prefix of the turns of each block, with its ``level``."""
    query = f"select block, p1, p2, {', '.join(TURNS)}, {BLOCK} - cast(bit_count(grouping_id()) as int) as level, {', '.join(aggregates)} from {{df}} group by block, p1, p2, rollup({', '.join(TURNS)})"
    return df.sparkSession.sql(query, df=df)


def _nodes(blocks: DataFrame) -> DataFrame:
    """Nodes below the root: their key (depth, x1, x2), their parent's (q1, q2), members and bytes of the last text."""
    rolled = _rolled(blocks, "min(conv_id) as conv_id", "count(*) as n_convs")
    last = F.element_at(F.array(*TURNS), F.greatest(F.col("level"), F.lit(1)))
    # a conversation that has ended has null for the turns behind, which make no node
    real = rolled.where((F.col("level") > 0) & last.isNotNull())
    bits = [_bits(F.col("block") * BLOCK + i, F.col(t)) for i, t in enumerate(TURNS)]

    def key(which: int, levels: Column) -> Column:
        each = [F.when(F.lit(i + 1) <= levels, b[which]).otherwise(F.lit(0).cast(_LONG)) for i, b in enumerate(bits)]
        return reduce(lambda a, b: a.bitwiseXOR(b), each, F.col(f"p{which + 1}"))

    own = {"depth": F.col("block") * BLOCK + F.col("level"), "bytes": F.conv(F.hex(F.substring(last, 17, 4)), 16, 10).cast(_LONG)}
    own |= {f"x{i + 1}": key(i, F.col("level")) for i in (0, 1)} | {f"q{i + 1}": key(i, F.col("level") - 1) for i in (0, 1)}
    return materialise(real.withColumns(own), "nodes")


def _later_blocks(nodes: DataFrame) -> DataFrame | None:
    """(depth, x1, x2, leaves, saved): what all blocks below the node hold, for each node at which a block begins."""
    group = [F.col("block"), F.col("p1"), F.col("p2")]
    groups = nodes.where("block > 0").groupBy(*group).agg(F.sum("leaf").alias("leaves"), F.sum("cost").alias("saved"))
    most = nodes.agg(F.max("block")).first()[0]
    if not most:
        return None
    ends = nodes.where(F.col("level") == BLOCK).select((F.col("block") + 1).alias("block"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("p1").alias("a1"), F.col("p2").alias("a2"))
    # a1, a2: the key of the group ``step`` blocks above; blocks 0 have no group here
    state, step = materialise(groups.join(ends, ["block", "p1", "p2"]), "later"), 1
    while step < most:
        more = state.where(F.col("block") > step).groupBy((F.col("block") - step).alias("block"), F.col("a1").alias("p1"), F.col("a2").alias("p2"))
        more = more.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.select((F.col("block") + step).alias("block"), F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("a1").alias("n1"), F.col("a2").alias("n2"))
        summed = state.join(more, ["block", "p1", "p2"], "left").join(above, ["block", "a1", "a2"], "left")
        total = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}
        state = materialise(summed.select("block", "p1", "p2", F.col("n1").alias("a1"), F.col("n2").alias("a2"), *[v.alias(c) for c, v in total.items()]), "later")
        step *= 2
    return state.select((F.col("block") * BLOCK).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.col("leaves").alias("later_leaves"), F.col("saved").alias("later_saved"))


def _ends(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): the digest of the ids of conversations that end at a node, ascending, joined by commas.

    Ids are joined by ranges first, a row for each node and range; a task then feeds a node's rows to its digest one by one.
    """
    last = blocks.where(F.col("block") * BLOCK + F.col("m") == F.col("total"))
    zero = F.lit(0).cast(_LONG)
    every = last.select("conv_id", F.col("total").alias("depth"), F.col("p1").bitwiseXOR(F.col("z1")).alias("x1"), F.col("p2").bitwiseXOR(F.col("z2")).alias("x2"))
    every = every.unionByName(sizes.where("total = 0").select("conv_id", zero.alias("depth"), zero.alias("x1"), zero.alias("x2")))
    parts = materialise(every.repartitionByRange("conv_id").withColumn("part", F.spark_partition_id()), "ends")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = parts.groupBy(*KEY, "part").agg(joined.alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sha = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in here], pa.array([sha.hexdigest()])], [*KEY, "ends_sha256"])

        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key != here:
                    if here is not None:
                        yield row()
                    here, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
        if here is not None:
            yield row()

    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "part")
    return ordered.select(*KEY, "ids").mapInArrow(digest, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")


def trie(convs: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """A row for each distinct sequence of first turns of the conversations that ``with_heads`` rebuilds, and the root.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). Turns are ordered by ``turn``, null
    first, and by their MD5 where numbers are equal; repeated rows are turns of their own. A null role or text is an empty one.
    Rows without a ``conv_id`` are left out; an empty table gives no rows. Other columns aren't read.
    """
    turns, sizes = with_heads(convs, family, heads)
    blocks = _blocks(turns)
    nodes = _nodes(blocks)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("x1"), F.col("q2").alias("x2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast(_LONG)))
    nodes = materialise(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast(_LONG), "cost": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")

    later = _later_blocks(nodes)
    if later is not None:
        nodes = nodes.join(later, KEY, "left")
        nodes = nodes.withColumns({"leaf": F.col("leaf") + F.coalesce("later_leaves", F.lit(0)), "cost": F.col("cost") + F.coalesce("later_saved", F.lit(0))})
    # of the nodes of a group the one it is named after is the shortest
    own = "min_by(struct(conv_id, n_convs, n_children, depth, x1, x2, q1, q2, level as own_level), level) as own"
    sums = _rolled(nodes, "sum(leaf) as n_leaves", "sum(cost) as saved_tokens", own)
    below = materialise(sums.where("level = 0 and block = 0 or level = own.own_level").select("level", "n_leaves", "saved_tokens", "own.*"), "sums")

    total, first = sizes.agg(F.count("*"), F.min("conv_id")).first()
    top = below.where("level = 0").select("n_leaves", "saved_tokens")
    n_top = below.where("level > 0 and depth = 1").count()
    spark = convs.sparkSession
    root = spark.createDataFrame([(first, total, n_top)] if total else [], "conv_id bigint, n_convs bigint, n_children bigint")
    leaves, saved = (top.first() or (1, 0)) if total else (1, 0)
    zero = F.lit(0).cast(_LONG)
    root = root.select("conv_id", zero.alias("depth"), F.lit(None).cast(_LONG).alias("parent_conv_id"), "n_convs", "n_children", F.lit(leaves).cast(_LONG).alias("n_leaves"), F.lit(saved).cast(_LONG).alias("saved_tokens"), zero.alias("x1"), zero.alias("x2"))

    below = below.where("level > 0")
    parents = below.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("q1"), F.col("x2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "x1", "x2"]
    shallow = below.where("depth = 1").withColumn("parent_conv_id", F.lit(first).cast(_LONG)).select(*columns)
    deep = below.where("depth > 1").join(parents, ["depth", "q1", "q2"]).select(*columns)
    every = root.unionByName(shallow).unionByName(deep).join(_ends(blocks, sizes), KEY, "left")
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    return every.select(*columns[:-2], digest.alias("ends_sha256"))


def oracle_sql() -> str:
    """The same by lists of turns and joins of prefixes, as DuckDB SQL."""
    step = "lambda a, b: xor(a >> 1, (a & 1) * 3988292384)"
    byte = f"list_reduce(list_prepend(xor(acc, v), cast(range(8) as bigint[])), {step})"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))), lambda acc, v: {byte}), 4294967295)"
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
),
own as (
  select conv_id, list({{r: role, t: text}} order by turn nulls first, md5(length(role) || ':' || role || text)) as own, {crc} % 9 as h
  from turns group by conv_id
),
rebuilt as (
  select a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) as own from own a left join own b on b.conv_id = a.conv_id - a.conv_id % 5
),
prefixes as (select conv_id, len(own) as n, d, own[1:d] as p from (select *, unnest(range(len(own) + 1)) as d from rebuilt)),
nodes as (
  select d, p, min(conv_id) as conv_id, count(*) as n_convs, coalesce(sha256(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d)), sha256('')) as ends,
    case when d = 0 then 0 else (count(*) - 1) * octet_length(encode(p[d].t)) end as cost
  from prefixes group by d, p
),
kids as (select p[1:d - 1] as p, count(*) as n from nodes where d > 0 group by 1),
full_nodes as (select n.*, coalesce(k.n, 0) as n_children from nodes n left join kids k on k.p = n.p),
up as (select p[1:a] as p, n_children = 0 as leaf, cost from (select *, unnest(range(d + 1)) as a from full_nodes)),
sums as (select p, count(*) filter (leaf) as n_leaves, sum(cost) as saved from up group by p)
select n.conv_id, n.d as depth, q.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, cast(s.saved as bigint) as saved_tokens, n.ends as ends_sha256
from full_nodes n join sums s on s.p = n.p left join nodes q on n.d > 0 and q.p = n.p[1:n.d - 1]"""
