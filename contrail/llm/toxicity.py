"""Toxicity: FTRL-proximal logistic regression on hashed word features.

Features of a text are the hashes of its words, word pairs and pairs of words
with one word between them, each counted once.  Training rows are dealt to
shards of about ``SHARD_ROWS`` as lists of feature indexes; each shard runs FTRL-proximal (per-coordinate rates,
L1 and L2) over its rows in hash order, and the shards' weights are averaged.
L1 leaves most of the 2^20 weights at zero; the rest, at most 2^20 pairs of an
index and a float, travel to the scoring tasks.

The training rows are a sample of about ``MAX_ROWS`` labelled rows (all, when
there are fewer), taken by a hash of the id.  Scores read whole texts only.

Cases: null and empty texts have no feature but the bias; null labels are
ignored and rows with differing labels count as toxic; without any training row
every score is 0; null ids are scored but never used for training; repeated
rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import remainder, ship_code, tidy, utf8
from contrail.llm.decontaminate import words_of

BITS = 20
MAX_ROWS = 60_000
SHARD_ROWS, EPOCHS = 10_000, 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.1
_M = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]  # odd multipliers


def features(text: bytes) -> np.ndarray:
    """Hashed indexes of words, word pairs and skip pairs, repeats included."""
    words = words_of(text)
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    one, two, skip = h * _M[0], h[:-1] * _M[1] + h[1:] * _M[2], h[:-2] * _M[2] + h[2:] * _M[0] + np.uint64(1)
    mixed = np.concatenate([one, two, skip])
    mixed ^= mixed >> np.uint64(29)
    mixed *= _M[1]
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Sparse online logistic regression; coordinate 2^BITS is the bias, which L1 does not touch."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
        self.l1 = np.full((1 << BITS) + 1, L1)
        self.l1[-1] = 0

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        size = np.maximum(np.abs(z) - self.l1[at], 0)
        return -np.sign(z) * size / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / ALPHA * w


_INDEXED = "shard int, order long, toxic int, at array<int>"


def _indexed(batches):
    """Training rows as their distinct feature indexes; texts stay behind."""
    for batch in batches:
        at = [np.unique(features(t.as_py())).astype(np.int32) for t in batch.column("t")]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*at, np.zeros(0, np.int32)])))
        yield pa.RecordBatch.from_arrays([batch.column("shard").cast(pa.int32()), batch.column("order"), batch.column("toxic"), lists],
                                         names=["shard", "order", "toxic", "at"])
    tidy()


def _train_shard(group: pa.Table) -> pa.Table:
    order, rows = np.argsort(group.column("order").to_numpy(), kind="stable"), []
    for lists, toxic in zip(group.column("at").chunks, group.column("toxic").chunks):
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()  # views of the shuffled columns
        rows += [(values[a:b], y) for a, b, y in zip(ends, ends[1:], toxic.to_pylist())]
    model = Ftrl()
    for _ in range(EPOCHS):
        for i in order:
            at, label = rows[i]
            model.learn(np.append(at, np.int32(1 << BITS)), label)
    used = np.flatnonzero(model.n)
    w = model.weights(used)
    del rows, model
    tidy()
    return pa.table({"feature": used[w != 0], "weight": w[w != 0]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray] | None:
    """(features, weights) learnt from labelled rows; None without any."""
    ship_code(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if not n:
        return None
    place = F.pmod(F.xxhash64("__id"), F.lit(1 << 30))
    sample = known.filter(place < F.lit(min(1.0, MAX_ROWS / n) * (1 << 30)))  # about MAX_ROWS ids, a bounded broadcast
    shards = -(-min(n, MAX_ROWS) // SHARD_ROWS)
    sample = sample.withColumn("shard", F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(shards))).withColumn("order", F.xxhash64("__id", F.lit(2)))
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), utf8(F.col(text_col)).alias("t")).join(F.broadcast(sample), "__id")
    got = rows.select("shard", "order", "toxic", "t").mapInArrow(_indexed, _INDEXED).groupBy("shard").applyInArrow(_train_shard, "feature long, weight double")
    # Summed in feature order with rounding to 1e-9, so that reruns agree.
    mean = got.groupBy("feature").agg((F.sum(F.round(F.col("weight") * 1e9).cast("long")) / (1e9 * shards)).alias("weight")).orderBy("feature").toPandas()
    return mean["feature"].to_numpy(np.int64), mean["weight"].to_numpy(np.float64)


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and score (0 to 1)."""
    ship_code(docs.sparkSession)
    dense = _Weights(model)

    def run(batches):
        for batch in batches:
            values = [dense.score(t.as_py()) for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])
        tidy()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("t"))
    return rows.mapInArrow(run, "doc_id long, score double")


class _Weights:
    """Sparse weights as shipped, dense once per task."""

    def __init__(self, model):
        self.model, self.dense = model, None

    def __getstate__(self):
        return {"model": self.model, "dense": None}

    def score(self, text: bytes) -> float:
        if self.model is None:
            return 0.0
        if self.dense is None:
            self.dense = np.zeros((1 << BITS) + 1)
            self.dense[self.model[0]] = self.model[1]
        at = features(text)
        at = np.unique(at[self.dense[at] != 0])
        return float(1 / (1 + np.exp(-np.clip(self.dense[at].sum() + self.dense[-1], -30, 30))))


def training_labels(labels: DataFrame, folds: int = 5) -> DataFrame:
    """Labels that may be learnt from: those whose crc32(doc_id) mod ``folds`` is not 0."""
    return labels.filter(remainder(F.col("doc_id"), folds) != 0)


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = score(docs, train(docs, training_labels(labels, folds)))
    return out.select("doc_id", (remainder(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def acceptable(docs: DataFrame, labels: DataFrame, folds: int = 5, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``; all columns kept."""
    ship_code(docs.sparkSession)
    dense, names = _Weights(train(docs, training_labels(labels, folds))), docs.columns

    def keep(batches):
        for batch in batches:
            fine = [i for i, t in enumerate(batch.column(batch.num_columns - 1)) if dense.score(t.as_py()) < limit]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=names).take(pa.array(fine, pa.int64()))
        tidy()

    return docs.select(*names, utf8(F.col("text")).alias("__words_of")).mapInArrow(keep, docs.schema)
