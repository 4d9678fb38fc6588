"""SpotSigs fingerprints: chains of content words after common-word anchors, compared by Jaccard.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm import _common as c
from strandloom.llm._common import let

# Anchors, very common words of English, French, German and Spanish.
ANCHORS = (
    "the a an of to is in and or for on it was that with as at by this be are from "
    "la le les des un une du que qui est dans pour et en de au par "
    "der die und das den von zu mit ist ein eine auf dem "
    "el los las y con se del al lo no su es por"
).split()
#: Words in a chain, and the distance from one to the next in content words.
CHAIN, DISTANCE = 2, 1
#: Documents in a bucket of neighbours, about, and buckets at most.
BUCKET_ROWS, BUCKETS = 1_000, 100_000


def signatures(text: Column, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> Column:
    """The sorted distinct signatures of a whole text: 32-bit hashes of an anchor and its chain.

    The chain of an anchor is the 1st, (1 + ``distance``)th, ... content word after it, ``chain`` of them; anchors in
    between are passed over. A text without a whole chain has one signature, of all its words
    (null and empty texts: of none), so every text has at least one.
    """
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    is_anchor = lambda x: x.isin(list(anchors))

    def of_words(w: Column) -> Column:
        at = F.filter(F.transform(w, lambda x, i: F.when(is_anchor(x), i)), lambda i: i.isNotNull())
        content = F.filter(w, lambda x: ~is_anchor(x) & (x != ""))

        def chains(content: Column) -> Column:
            # the j-th anchor, at word i, has i - j content words before it
            def spot(i: Column, j: Column) -> Column:
                own = [F.get(content, i - j + k * distance) for k in range(chain)]
                return F.when(own[-1].isNotNull(), F.xxhash64(F.get(w, i), *own).bitwiseAND(F.lit(0xFFFFFFFF)))

            return F.filter(F.transform(at, spot), lambda s: s.isNotNull())

        # empty strings before the first and after the last word aren't content; they would shift the count
        whole = F.array(F.xxhash64(F.array_join(w, " ")).bitwiseAND(F.lit(0xFFFFFFFF)))
        return let(let(content, chains), lambda s: F.when(F.size(s) > 0, F.array_sort(F.array_distinct(s))).otherwise(whole))

    return let(F.filter(words, lambda x: x != ""), of_words)


def fingerprint(found: Column) -> Column:
    """Signatures as a string: eight hexadecimal digits each, joined by spaces."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct signatures."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def add_fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each whole text; a column of the same name is replaced. No shuffle."""
    return df.withColumn(out, fingerprint(signatures(F.col(text))))


def similar(df: DataFrame, at_least: float = 0.8, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Links (a, b, likeness) between representatives, and members (key, representative).

    Documents with equal fingerprints are one class, represented by the smallest key. Sets are
    partitioned by length: a set of n signatures goes to the partitions whose sets could reach ``at_least``, that
    is lengths up to n / ``at_least``. In a partition only sets that share one of their rarest signatures meet
    (n - ceil(at_least * n) + 1 of them: of sets similar enough, two share one of those), and
    only if their lengths allow the similarity. Null keys are left out of classes.
    """
    found = c.materialise(df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), signatures(F.col(text)).alias("own")), "spots")
    named = found.withColumn("class", F.sha2(F.to_json("own"), 256))
    members = named.groupBy("class").agg(F.min("k").alias("representative"))
    sets = c.materialise(named.groupBy("class").agg(F.min("k").alias("k"), F.first("own").alias("own")), "spot-sets")
    counts = sets.select(F.explode("own").alias("spot")).groupBy("spot").agg(F.count("*").alias("n"))
    each = sets.select("k", F.size("own").alias("size"), F.explode("own").alias("spot")).join(counts, "spot")
    by_rarity = Window.partitionBy("k").orderBy("n", "spot")
    prefix = F.col("size") - F.ceil(F.col("size") * at_least - 1e-9) + 1
    rare = each.withColumn("at", F.row_number().over(by_rarity)).where((F.col("at") <= prefix) & (F.col("n") > 1))
    # lengths in steps of 1 / at_least: sets that can be similar enough are in one step or in adjacent ones
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(1.0 / at_least)) if at_least < 1 else F.col("size").cast("double"))
    rare = rare.select("k", "size", "spot", step.cast("long").alias("part"))
    one = rare.select(F.col("k").alias("a"), F.col("size").alias("na"), "spot", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    two = rare.select(F.col("k").alias("b"), F.col("size").alias("nb"), "spot", "part")
    shorter = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = one.join(two, ["part", "spot"]).where(shorter & (F.col("na") >= at_least * F.col("nb") - 1e-9)).select("a", "b").distinct()
    sides = [sets.select(F.col("k").alias(x), F.col("own").alias(f"own_{x}")) for x in "ab"]
    links = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", likeness(F.col("own_a"), F.col("own_b")).alias("likeness")).where(F.col("likeness") >= at_least)
    return links, named.join(members, "class").select(F.col("k").alias(key), "representative")


def _bucket(order: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below ``order``, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    array = F.lit(bounds) if len(bounds) > 1 else F.array(F.lit(bounds[0]))

    def search(b: Column) -> Column:
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.get(b, at + s - 1) < order, at + s).otherwise(at))

    return let(array, search)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``text``, ``own``, ``next_text``, ``next_own``): each document, the next one, and their signatures.

    Next is the one with the next smaller key; the last one's is the first. Equal keys are in the order of their
    texts' hashes, null keys last. Keys are cut into ranges by approximate percentiles; whole texts
    are shuffled once, to their range, and the first document of a range also goes to the range
    above, whose last one it follows. The driver sees a key for each range. A key that is no whole number is an error: it
    couldn't be cut into ranges.
    """
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"the key {key} must be a whole number, not {df.schema[key].dataType.simpleString()}")
    low = -(2**63)
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(low)).alias("order"), F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = min(BUCKETS, max(1, rows.count() // BUCKET_ROWS))
    bounds: list[int] = []
    if n > 1:
        got = rows.agg(F.percentile_approx("order", [i / n for i in range(1, n)], max(10_000, 10 * n)).alias("b")).first()["b"]
        bounds = sorted(set(got or []))
    rows = rows.withColumn("bucket", _bucket(F.col("order"), bounds))
    tops = sorted((r["bucket"], r["top"]) for r in rows.groupBy("bucket").agg(F.max("order").alias("top")).collect())
    # the first of a range follows the last of the range above; the very first follows the very last
    follows = [(tops[i - 1][1], tops[i][0]) for i in range(len(tops))]
    also = df.sparkSession.createDataFrame(follows, "order bigint, also int")
    sent = rows.join(c.maybe_broadcast(also), "order", "left")
    sent = sent.select("order", "k", "text", F.explode(F.array(F.struct(F.lit(0).alias("guest"), "bucket"), F.struct(F.lit(1).alias("guest"), F.col("also").alias("bucket")))).alias("to"))
    sent = sent.select("order", "k", "text", "to.guest", "to.bucket").where("bucket is not null").repartition("bucket")
    sent = sent.withColumn("own", signatures(F.col("text")))
    w = Window.partitionBy("bucket").orderBy("guest", F.col("order").desc(), F.xxhash64("text"))
    out = sent.withColumns({"next_text": F.lead("text").over(w), "next_own": F.lead("own").over(w)}).where("guest = 0")
    return out.select(F.col("k").alias(key), "text", "own", "next_text", "next_own")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``following``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def compare(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every document and its edited text, and compare them and the next document.

    Columns: the key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts are
    empty; a table of one document has itself for the next; an empty table gives no rows.
    """
    rows = with_next(df, key, text).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_own", signatures(F.col("edited")))
    return rows.select(
        key,
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
