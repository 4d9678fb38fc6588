"""Whitening of embeddings by distributed block matrices.

Vectors become whole numbers first, so counts and sums are exact. The scatter matrix of the distinct vectors is the product of a
``BlockMatrix`` of their centred rows, transposed, with itself; the middle dimension is split, as all its products would
meet in one task. Only that matrix (dimension x dimension) comes to the driver, where ``eigh`` makes the whitening
matrix; a second ``BlockMatrix`` product projects the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm._common import materialise, maybe_broadcast

#: Rows and columns of a block: 8 MB of doubles at most.
SIDE = 1024
#: A component whose eigenvalue is a smaller part of the largest has no direction to speak of.
LEAST_PART = 1e-12
_LONG = 1 << 63


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, x): rows whose vector has neither nulls nor entries that aren't finite; entries as floor(scale * entry), held to the range of a long."""
    sound = F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return vectors.where(sound).select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def _numbered(df: DataFrame, what: str) -> DataFrame:
    """``df`` at rest with ``index``, 0, 1, ... without gaps. The driver sees the number of rows of each part."""
    kept = materialise(df.withColumn("row", F.monotonically_increasing_id()), what)
    kept = kept.withColumns({"part": F.shiftright("row", 33), "nth": F.col("row").bitwiseAND((1 << 33) - 1)})
    starts, at = [], 0
    for part, n in kept.groupBy("part").count().orderBy("part").collect():
        starts.append((part, at))
        at += n
    start = kept.sparkSession.createDataFrame(starts, "part bigint, start bigint")
    return kept.join(maybe_broadcast(start), "part").withColumn("index", F.col("start") + F.col("nth")).drop("row", "part", "nth", "start")


def _sums(vectors: DataFrame, dimension: int) -> tuple[int, list[int], int]:
    """Rows, sums of each entry and the largest absolute entry, exact: tasks sum upper and lower halves of the numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, dimension)
            if not len(x):
                continue
            most = max(abs(int(x.min())), abs(int(x.max())))
            columns = [np.arange(dimension), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
            columns += [np.full(dimension, len(x)), np.full(dimension, min(most, _LONG - 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["at", "high", "low", "n", "most"])

    parts = vectors.select("x").mapInArrow(add, "at bigint, high bigint, low bigint, n bigint, most bigint")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = parts.groupBy("at").agg(total("high").alias("high"), total("low").alias("low"), F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("at").collect()
    if not rows:
        return 0, [], 0
    return rows[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows], max(r["most"] for r in rows)


def _centred(rows: DataFrame, n: int, sums: list[int], most: int) -> DataFrame:
    """Adds ``centred``, x - sums / n, and ``deviation``, the sum of (n * x - sums)^2, null where that is no long."""
    dimension, total = len(sums), np.array(sums, object)
    names = [f.name for f in rows.schema if f.name != "x"]
    small = dimension * (2 * n * (most + 1)) ** 2 < _LONG

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, dimension)
            off = x * n - total.astype(np.int64) if small else x.astype(object) * n - total
            each = (off * off).sum(axis=1)
            deviation = pa.array([int(d) if d < _LONG else None for d in each.tolist()], pa.int64())
            flat = pa.array((off.astype(np.float64) / n if small else (off / n).astype(np.float64)).ravel())
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * dimension)
            columns = [*[batch.column(c) for c in names], deviation, pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "deviation", "centred"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "x")
    return rows.mapInArrow(centre, f"{kinds}, deviation bigint, centred array<double>")


def _matrix(rows: DataFrame, n: int, dimension: int) -> BlockMatrix:
    """Rows (index, centred) as a block matrix; vectors are made and dealt out on the JVM."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("centred").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dimension).toBlockMatrix(SIDE, SIDE)


def _project(spark: SparkSession, rows: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """(index, whitened): rows of a block matrix times ``matrix``."""
    dimension, k = matrix.shape
    blocks = [((i, 0), Matrices.dense(len(part), k, part.ravel(order="F").tolist())) for i, part in enumerate(np.split(matrix, range(SIDE, dimension, SIDE)))]
    weights = BlockMatrix(spark.sparkContext.parallelize(blocks, 1), SIDE, SIDE, dimension, k)
    product = rows.multiply(weights).toIndexedRowMatrix()
    made = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return made.select("index", vector_to_array("vector").alias("whitened"))


def _scatter(blocks: BlockMatrix, n: int) -> np.ndarray:
    """The sum of outer products of the rows: one small matrix, whose parts are summed over splits of the rows."""
    wrapper = blocks.transpose()._java_matrix_wrapper
    splits = max(1, -(-n // SIDE))
    product = BlockMatrix(wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits), SIDE, SIDE)
    return product.toLocalMatrix().toArray()


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each kept vector and component.

    Kept are rows of ``whole_vectors``. The mean and the covariance (divisor n) are those of the n distinct vectors. Repeated and null ids are
    rows of their own. A vector needs the length that most have (the smaller of equals): others can't be
    projected and are left out. There are fewer components where the dimension or the rank is smaller, so one distinct vector alone, an empty
    table or empty vectors give no rows. ``deviation`` is null where it is no long. Other columns aren't read.
    """
    kept = whole_vectors(vectors, scale)
    lengths = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if lengths is None or not lengths["size"]:
        return _nothing(vectors)
    dimension = lengths["size"]
    rows = _numbered(kept.where(F.size("x") == dimension), "vectors")
    fit = _numbered(rows.select("x").distinct(), "distinct")
    n, sums, most = _sums(fit, dimension)
    fit = materialise(_centred(fit.select("index", "x"), n, sums, most).select("index", "centred"), "centred")
    # used three times: both factors of the scatter matrix, and the check of the result; blocks that are lost are made again
    blocks = _matrix(fit, n, dimension).persist(StorageLevel.MEMORY_AND_DISK)
    scatter = _scatter(blocks, n)
    covariance = (scatter + scatter.T) / (2 * n)
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(LEAST_PART * values.max(), 0)]
    if not len(order):
        return _nothing(vectors)
    weights, explained = directions[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)

    flat = _project(vectors.sparkSession, blocks, weights).select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(len(order))])
    pairs = [(i, j) for i in range(len(order)) for j in range(i + 1)]
    found = flat.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)

    centred = materialise(_centred(rows.select("index", "vec_id", "x"), n, sums, most), "rows")
    projected = centred.select("index", "vec_id", "deviation").join(_project(vectors.sparkSession, _matrix(centred, centred.count(), dimension), weights), "index")
    share = F.element_at(F.array(*[F.lit(float(e)) for e in explained]), F.col("component"))
    each = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).withColumn("component", F.col("at") + 1)
    return each.select("vec_id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(float(error)).alias("identity_error"))


def _nothing(vectors: DataFrame) -> DataFrame:
    spark: SparkSession = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    return spark.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
