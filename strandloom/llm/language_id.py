"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

1. Document frequencies of hashed n-grams are counted over all training rows.
2. Weights are learned by follow-the-regularised-leader with elastic-net penalties, on a sample
   of labelled rows of bounded size, in several tasks whose weights are averaged.
3. A temperature for the probabilities is fitted on sampled rows left out of step 2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import _common as c

#: n-grams of one to ORDER characters, hashed to BUCKETS features.
ORDER, BUCKETS = 3, 1 << 15
#: Rows of each language to learn from and rows to calibrate on, about, at most.
SAMPLE, CALIBRATION = 2_000, 400
#: Tasks that learn from a share of the sample each, and times each goes through its share.
SHARDS, EPOCHS = 4, 3
#: FTRL: step size, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
#: Characters of a text that are counted at once, so a long text needs no large arrays.
BLOCK = 1 << 16
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram features of the whole lower-cased text: indices in order, and counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(codes), BLOCK):
        x = codes[at : at + BLOCK + ORDER - 1]
        rolling = np.zeros(len(x), dtype=np.uint32)
        for k in range(ORDER):
            own = min(BLOCK, len(x) - k)
            if own <= 0:
                break
            rolling = rolling[:own] * _MIX[0] + x[k : k + own] * _MIX[1] + np.uint32(k)
            h = rolling ^ (rolling >> np.uint32(15))
            counts += np.bincount((h * _MIX[2]) >> np.uint32(17), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass(frozen=True)
class Model:
    """``weights``: BUCKETS + 1 rows (the last is the bias), one column for each language."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """A learned language and its probability; ``und`` and 0 for a text without a letter."""
        if not text or not LETTER.search(text) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(logits(*vector(text, self.idf), self.weights) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length: 1 + log(count), times the feature's idf."""
    found, counts = features(text)
    x = (1.0 + np.log(counts)) * idf[found]
    size = math.sqrt(float(x @ x))
    return found, x / size if size else x


def logits(found: np.ndarray, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return x @ weights[found] + weights[-1]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights by FTRL-proximal with L1 and L2 penalties, for rows (indices, values, class)."""
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(epochs):
        for found, x, y in rows:
            at, values = np.append(found, BUCKETS), np.append(x, 1.0)
            own_z, own_n = z[at], n[at]
            w = weights(own_z, own_n)
            error = softmax(values @ w)
            error[y] -= 1.0
            g = values[:, None] * error[None, :]
            step = (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / ALPHA
            z[at] = own_z + g - step * w
            n[at] = own_n + g * g
    return weights(z, n)


def fit_temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / math.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(truth)), truth]).mean())

    low, high, ratio = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def document_frequencies(df: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many of all rows each feature occurs, and the number of rows; each partition counts first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS + 1, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                total[features(t.as_py())[0]] += 1
                rows += 1
        total[BUCKETS] = rows
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["feature", "n"])

    rows = df.select(text).mapInArrow(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in rows:
        out[r["feature"]] = r["n"]
    return out[:BUCKETS], int(out[BUCKETS])


def fit(df: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", sample: int = SAMPLE, calibration: int = CALIBRATION) -> Model:
    """Learn from ``text`` and ``label`` of ``df``, whose rows must all be training rows.

    Rows with a null label or a text that is null or without a letter are left out. Document frequencies
    cover all other rows. Of each language about ``sample`` + ``calibration`` rows are drawn by a
    hash of ``key``, the only use of the key; the text and the label alone make features. The driver
    gets counts by language and feature, the averaged weights, and the scores of the
    calibration rows. Without a single labelled row, the model answers ``und`` for every text.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).alias("y")).where(F.col("t").rlike(r"\p{L}") & F.col("y").isNotNull())
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    df_counts, n_rows = document_frequencies(rows, "t")
    idf = np.log((1 + n_rows) / (1 + df_counts)) + 1.0
    if not languages:
        return Model((), idf, np.zeros((BUCKETS + 1, 0)), 1.0)

    steps = 1 << 30
    share = spark.createDataFrame(
        [(y, i, int(steps * min(1.0, (sample + calibration) / sizes[y])), int(steps * min(1.0, (sample + calibration) / sizes[y]) * sample / (sample + calibration))) for i, y in enumerate(languages)],
        "y string, klass int, drawn bigint, learn bigint",
    )
    place = F.pmod(F.xxhash64(F.lit("language-sample"), F.col("k").cast("string")), F.lit(steps))
    drawn = rows.withColumn("place", place).join(c.maybe_broadcast(share), "y").where("place < drawn")
    drawn = c.materialise(drawn.select("t", "klass", "place", (F.col("place") < F.col("learn")).alias("learns"), F.pmod("place", F.lit(SHARDS)).alias("shard")), "language-sample")
    n_classes = len(languages)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "klass", "t"]).sample(frac=1.0, random_state=7)
        w = ftrl([(*vector(t, idf), int(y)) for t, y in zip(pdf["t"], pdf["klass"], strict=True)], n_classes)
        f, k = np.nonzero(w)
        return pd.DataFrame({"feature": f.astype("int64"), "klass": k.astype("int32"), "w": w[f, k]})

    learned = drawn.where("learns").groupBy("shard").applyInPandas(learn, "feature bigint, klass int, w double")
    shards = max(1, drawn.where("learns").select("shard").distinct().count())
    weights = np.zeros((BUCKETS + 1, n_classes))
    for r in learned.groupBy("feature", "klass").agg(F.sum("w").alias("w")).collect():
        weights[r["feature"], r["klass"]] = r["w"] / shards

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [logits(*vector(t.as_py(), idf), weights).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.list_(pa.float64()))], names=["klass", "scores"])

    held = drawn.where("not learns").select("t", "klass").mapInArrow(score, "klass int, scores array<double>").collect()
    t = fit_temperature(np.array([r["scores"] for r in held]).reshape(-1, n_classes), np.array([r["klass"] for r in held], dtype=int))
    return Model(languages, idf, weights, t)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) for each whole text; other columns stay, but ones of these two names are replaced.

    ``und`` and 0 if the text is null or has no letter. Equal texts get equal results.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["lang_pred", "score"])

    found = c.unused(df, "_language")
    out = df.withColumn(found, identify(F.col(text)))
    return out.withColumns({"lang_pred": F.col(found)["lang_pred"], "score": F.col(found)["score"]}).drop(found)


def train_split(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of a table to learn from: crc32 of the key as text, modulo 4, is not 2."""
    return df.where(c.crc_remainder(key) != 2)
