"""A content-addressed store of token ids.

A document's ids are cut into chunks where a rolling hash of the last few ids says so, so equal
stretches in different documents make equal chunks. The store is a folder of Parquet files:

``chunks``    chunk (its SHA-256, cut to 16 bytes), ids (unsigned 16- or 32-bit little-endian,
              as ``width`` says), width, n_ids: each distinct chunk once
``recipes``   doc_id, part, start, n_tokens, chunks (array of chunk names in order), root (Merkle
              root of those names): files in ascending order of doc_id
``manifest``  part, page, n_docs, n_tokens, root: a Merkle tree for each page of documents, whose leaves are
              their doc_id, start, n_tokens and root
``root``      one row: n_docs, n_tokens, root (of the tree over the parts' trees over their pages) and the type of doc_id
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm import _common as c
from strandloom.llm._tokens import AT_ONCE, with_end, word_encoder

#: Ids seen by the rolling hash, and the chunk lengths: mean about LEAST + 2**BITS, MOST at most.
REACH, LEAST, BITS, MOST = 8, 64, 9, 4096
#: Odd multiplier of the rolling hash (a fixed value of this file format).
FACTOR = np.uint32(0x9E3779B1)
#: Documents in a page of the manifest.
PAGE = 1024
#: Chunk names that a task remembers, so that it hands on each chunk once; more are forgotten, and a grouping finds them.
REMEMBERED = 1 << 18


def marks(ids: np.ndarray) -> np.ndarray:
    """The places after ids where the top BITS bits of the polynomial hash of the last REACH ids are zero."""
    x = ids.astype(np.uint32) + np.uint32(1)
    rolling, power = np.zeros(len(x), dtype=np.uint32), np.uint32(1)
    with np.errstate(over="ignore"):
        for back in range(min(REACH, len(x))):
            rolling[back:] += x[: len(x) - back] * power
            power = power * FACTOR
        rolling *= FACTOR
    return np.flatnonzero(rolling >> np.uint32(32 - BITS) == 0) + 1


def ends_between(found: list[int], start: int, stop: int) -> list[int]:
    """Ends of the chunks of the ids from ``start`` to ``stop``, where ``found`` are the marks between them.

    A mark within LEAST ids of its chunk's start doesn't count, so no hash reaches back before ``start``; a chunk ends at
    MOST ids anyway. The places depend on nearby ids only, so an edit changes chunks nearby.
    """
    ends = []
    for mark in [*found, stop]:
        while mark - start > MOST:
            start += MOST
            ends.append(start)
        if mark - start >= LEAST or (mark == stop and mark > start):
            ends.append(mark)
            start = mark
    return ends


def cut_points(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one document's ``ids``; the last is its length."""
    return ends_between([x for x in marks(ids).tolist() if x < len(ids)], 0, len(ids))


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary tree of SHA-256 over ``leaves``; an odd node moves up as it is."""
    level = [sha256(b"\0" + x).digest() for x in leaves] or [sha256(b"").digest()]
    while len(level) > 1:
        level = [sha256(b"\1" + b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def pack(ids: np.ndarray) -> tuple[bytes, int]:
    """The bytes of ids and their width: 2 bytes an id where all fit, else 4."""
    width = 2 if not len(ids) or int(ids.max()) < 65536 else 4
    return ids.astype("<u2" if width == 2 else "<u4").tobytes(), width


def name_of(raw: bytes, width: int) -> bytes:
    return sha256(bytes([width]) + raw).digest()[:16]


def chunked(df: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts and cut the ids: (doc_id, n_tokens, root, chunks, pieces).

    ``chunks`` has the names in order; ``pieces`` is an array of (chunk, ids, width, n_ids) of those that the task meets
    for the first time. Every document ends with ``end_id``.
    """
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        met: set[bytes] = set()
        for batch in batches:
            for part in c.small_parts(batch, 1, AT_ONCE):
                ids, offsets = with_end(*encoder.encode(part.column(1)), end_id)
                raw, wide = pack(ids)
                found = marks(ids)
                first, last = np.searchsorted(found, offsets[:-1], "right").tolist(), np.searchsorted(found, offsets[1:], "left").tolist()
                found, bounds = found.tolist(), offsets.tolist()
                names, n_names, roots = [], [0], []
                new, n_new = ([], [], [], []), [0]
                for i, start in enumerate(bounds[:-1]):
                    for end in ends_between(found[first[i] : last[i]], start, bounds[i + 1]):
                        own, width = (raw[2 * start : 2 * end], 2) if wide == 2 else pack(ids[start:end])
                        name = name_of(own, width)
                        names.append(name)
                        if name not in met:
                            met.add(name)
                            for column, value in zip(new, (name, own, width, end - start), strict=True):
                                column.append(value)
                        start = end
                    roots.append(merkle(names[n_names[-1] :]))
                    n_names.append(len(names))
                    n_new.append(len(new[0]))
                if len(met) > REMEMBERED:
                    met.clear()
                kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32()]
                pieces = pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(new, kinds, strict=True)], names=["chunk", "ids", "width", "n_ids"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(offsets)), pa.array(roots, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(n_names, pa.int32()), pa.array(names, pa.binary())), pa.ListArray.from_arrays(pa.array(n_new, pa.int32()), pieces),
                    ],
                    names=["doc_id", "n_tokens", "root", "chunks", "pieces"],
                )

    return df.select(key, text).mapInArrow(
        cut, f"doc_id {kind}, n_tokens bigint, root binary, chunks array<binary>, pieces array<struct<chunk: binary, ids: binary, width: int, n_ids: int>>"
    )


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the store of all rows of ``df`` to ``path``.

    Null texts are empty: they hold the end id alone. Null keys come first. Rows with the same
    key stay apart rows, in the order of their roots. Other columns are left out; an empty table makes an empty store. A
    task hands on a chunk once, so copies, however many, don't meet in one task. Of all documents, the driver sees a token
    count for each file only.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    staged = c.materialise(chunked(df, tokenizer_path, end_id, key, text), "token-stage")
    pieces = staged.select(F.explode("pieces").alias("p")).select("p.*")
    # the first of equal chunks, without a sort before the shuffle: few are left there
    before = F.lag("width").over(Window.partitionBy("chunk").orderBy("chunk"))
    pieces.withColumn("before", before).where("before is null").drop("before").write.option("compression", "zstd").parquet(f"{path}/chunks")
    parts = c.ordered_parts(staged.drop("pieces"), "doc_id", "token-parts")
    recipes = c.running_start(parts, "doc_id", "n_tokens", ["root"], "start")
    order = [F.col("doc_id").asc_nulls_first(), F.col("root")]
    recipes.sortWithinPartitions("part", *order).write.partitionBy("part").parquet(f"{path}/recipes")
    manifest(_recipes(spark, path, kind)).write.parquet(f"{path}/manifest")
    store_root(spark.read.schema(MANIFEST).parquet(f"{path}/manifest")).withColumn("key_type", F.lit(kind)).write.parquet(f"{path}/root")


MANIFEST = "part int, page bigint, n_docs bigint, n_tokens bigint, root string"


def _recipes(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = f"doc_id {kind}, n_tokens bigint, root binary, chunks array<binary>, start bigint, part int"
    return spark.read.schema(schema).parquet(f"{path}/recipes")


def _key_type(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(f"{path}/root").first()["key_type"]


def tree(leaves: Column) -> Column:
    """Hexadecimal root of a binary tree of SHA-256 over an array of hexadecimal hashes; an odd node moves up as it is."""

    def up(level: Column, _: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")),
            lambda i: F.when(2 * i + 1 < F.size(level), F.sha2(F.concat(F.get(level, 2 * i), F.get(level, 2 * i + 1)), 256)).otherwise(F.get(level, 2 * i)),
        )
        return F.when(F.size(level) > 1, pairs).otherwise(level)

    levels = F.ceil(F.log2(F.greatest(F.size(leaves), F.lit(1)))).cast("int") + 1  # one more than needed, which changes nothing
    return F.coalesce(F.get(F.aggregate(F.sequence(F.lit(1), levels), leaves, up), F.lit(0)), F.sha2(F.lit(""), 256))


def manifest(recipes: DataFrame) -> DataFrame:
    """Merkle roots of the documents, PAGE at a time within a file; a leaf has all that a recipe says."""
    leaf = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "start", "n_tokens", F.hex("root")), 256)
    w = Window.partitionBy("part").orderBy("start", "root")
    paged = recipes.select("part", "start", "root", "n_tokens", leaf.alias("leaf")).withColumn("at", F.row_number().over(w) - 1)
    paged = paged.withColumn("page", F.floor(F.col("at") / PAGE))
    leaves = F.transform(F.array_sort(F.collect_list(F.struct("at", "leaf"))), lambda x: x["leaf"])
    return paged.groupBy("part", "page").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), tree(leaves).alias("root"))


def store_root(pages: DataFrame) -> DataFrame:
    """One row for a manifest: n_docs, n_tokens, and the root of the tree over the parts' trees."""
    in_order = lambda at: F.transform(F.array_sort(F.collect_list(F.struct(at, "root"))), lambda x: x["root"])
    parts = pages.groupBy("part").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), tree(in_order("page")).alias("root"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).alias(x)
    return parts.agg(total("n_docs"), total("n_tokens"), tree(in_order("part")).alias("root"))


def _joined_crc(before: int, own: int, size: int) -> int:
    """crc32 of two byte strings one after another, from the crc32 of each and the second's size."""
    zeros = bytes(size)
    return zlib.crc32(zeros, before) ^ zlib.crc32(zeros) ^ own


CHUNKS = "chunk binary, ids binary, width int, n_ids int"


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Every stored chunk: chunk, n_ids, crc32 of its ids as unsigned 32-bit integers, and whether its name holds."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc, n, sound = [], [], []
            for name, raw, width in zip(*(batch.column(i) for i in range(3)), strict=True):
                raw, width = raw.as_py(), width.as_py()
                ids = np.frombuffer(raw, dtype=f"<u{width}").astype("<u4")
                crc.append(zlib.crc32(ids.tobytes()))
                n.append(len(ids))
                sound.append(name_of(raw, width) == name.as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sound, pa.bool_())], names=["chunk", "n_ids", "crc", "sound"]
            )

    return spark.read.schema(CHUNKS).parquet(f"{path}/chunks").select("chunk", "ids", "width").mapInArrow(check, "chunk binary, n_ids bigint, crc bigint, sound boolean")


def _or_fail(sound: Column, value: Column, message: str) -> Column:
    return F.when(sound, value).otherwise(F.raise_error(F.lit(message)).cast("bigint"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each stored document, from the files: doc_id, start, n_tokens, ids_crc32.

    The recipes are held against the manifest and its root first, by ``verify_manifest``. Then every chunk is read once and
    its name checked, its length and crc32 are joined to the recipes, and a document's crc32 is put together from its
    chunks in order, so no ids are shuffled. A recipe that is lost, repeated or changed, a chunk that is missing or unsound,
    a wrong root or a wrong token count fails the job.
    """
    wrong = verify_manifest(spark, path).count()
    if wrong:
        raise ValueError(f"token store: {wrong} pages of the manifest do not verify")
    used = _recipes(spark, path, _key_type(spark, path)).select("doc_id", "start", "n_tokens", "root", F.posexplode_outer("chunks").alias("at", "chunk"))
    found = used.join(read_chunks(spark, path), "chunk", "left")
    whole = found.groupBy("start", "doc_id", "n_tokens", "root").agg(
        F.array_sort(F.collect_list(F.struct("at", "chunk", "n_ids", "crc", "sound"))).alias("own")
    )

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs, sound = [], []
            for n, root, own in zip(batch.column(2), batch.column(3), batch.column(4), strict=True):
                own, crc = own.as_py(), 0
                for p in own:
                    crc = _joined_crc(crc, p["crc"], 4 * p["n_ids"]) if p["sound"] else crc
                crcs.append(crc)
                sound.append(all(p["sound"] for p in own) and sum(p["n_ids"] for p in own) == n.as_py() and merkle([p["chunk"] for p in own]) == root.as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(0), batch.column(2), pa.array(crcs, pa.int64()), pa.array(sound, pa.bool_())],
                names=["doc_id", "start", "n_tokens", "crc", "sound"],
            )

    kind = whole.schema["doc_id"].dataType.simpleString()
    rows = whole.mapInArrow(join_up, f"doc_id {kind}, start bigint, n_tokens bigint, crc bigint, sound boolean")
    return rows.select("doc_id", "start", "n_tokens", _or_fail(F.col("sound"), F.col("crc"), "token store: a document does not verify").alias("ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents' ids themselves: doc_id, start, ids (array<bigint>), rebuilt from recipes and chunks."""

    @F.arrow_udf("array<bigint>")
    def unpack(raw: pa.Array, width: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(r, dtype=f"<u{w}").tolist() for r, w in zip(raw.to_pylist(), width.to_pylist(), strict=True)], pa.list_(pa.int64()))

    used = _recipes(spark, path, _key_type(spark, path)).select("doc_id", "start", "root", F.posexplode("chunks").alias("at", "chunk"))
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").select("chunk", unpack("ids", "width").alias("ids"))
    whole = used.join(chunks, "chunk").groupBy("start", "doc_id", "root").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("own"))
    return whole.select("doc_id", "start", F.flatten(F.col("own.ids")).alias("ids"))


def verify_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the manifest that don't match the recipes, and page -1 if the store's root doesn't: none in a sound store."""
    kept, counts = spark.read.schema(MANIFEST).parquet(f"{path}/manifest"), ["n_docs", "n_tokens", "root"]
    made = manifest(_recipes(spark, path, _key_type(spark, path)))
    other = kept.select("part", "page", *[F.col(x).alias(f"kept_{x}") for x in counts])
    differs = lambda: ~F.col("n_docs").eqNullSafe(F.col("kept_n_docs")) | ~F.col("n_tokens").eqNullSafe(F.col("kept_n_tokens")) | ~F.col("root").eqNullSafe(F.col("kept_root"))
    pages = made.join(other, ["part", "page"], "full").where(differs()).select("part", "page")
    top = spark.read.parquet(f"{path}/root").select(*[F.col(x).alias(f"kept_{x}") for x in counts])
    return pages.unionByName(store_root(kept).join(F.broadcast(top), F.lit(True)).where(differs()).select(F.lit(None).cast("int").alias("part"), F.lit(-1).cast("bigint").alias("page")))
