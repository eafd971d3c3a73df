"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

Features of a text: its words, hashed into ``buckets`` classes (log of the count,
scaled to length 1 over the text); statistics of its structure (shares of upper
case, digits, marks, blanks, line ends, bars, odd word ends, repeated words and word
pairs, ...), standardised over the training rows; and, as metadata, its declared
length n_chars against the true one.  The pairwise part is
0.5 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so scoring is linear in the
number of features.

Training takes at most ``max_rows`` labelled rows (a documented bound), those first
in the order of a hash of doc_id; only their features (not their texts) reach the
driver, where mini-batch Adam fits the weights with a fixed seed.  Everything else,
features and scores, covers all rows and whole texts.

Defined cases: null text is empty, and empty texts have a score as others do; null
n_chars counts as the true length, a missing n_chars column likewise; labels that
are null are passed over, of several labels of a doc_id the smallest counts; without
labelled rows nothing speaks against a text and every score is 1; repeated rows are
scored each; an empty table gives an empty result; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import Words, in_fold, lean, mix, row_of, row_texts, rows_and_texts, small_batches, word_slices

BUCKETS = 1 << 13
FACTORS = 4
MAX_ROWS = 8_000
THRESHOLD = 0.7
STATS = 16

_CLASS = np.zeros(256, np.int64)  # 0 other marks, 1 upper, 2 lower, 3 digit, 4 blank, 5 line end, 6 bar, 7 sentence mark, 8 beyond ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10], _CLASS[124] = 4, 5, 6
_CLASS[[ord(c) for c in ".,;:'"]] = 7
_CLASS[128:] = 8


@dataclass
class Model:
    bias: float
    weight: np.ndarray  # one per feature
    factor: np.ndarray  # FACTORS x features
    mean: np.ndarray
    scale: np.ndarray

    def score(self, texts: int, row: np.ndarray, col: np.ndarray, val: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(margin(self.bias, self.weight, self.factor, texts, row, col, val)[0], -40, 40)))


def margin(bias, weight, factor, n, row, col, val):
    """FM output by the sum-of-squares identity, and the factor sums."""
    out = bias + np.bincount(row, weights=weight[col] * val, minlength=n)
    sums = np.empty((len(factor), n))
    for f, v in enumerate(factor):
        x = v[col] * val
        sums[f] = np.bincount(row, weights=x, minlength=n)
        out = out + 0.5 * (sums[f] ** 2 - np.bincount(row, weights=x * x, minlength=n))
    return out, sums


def word_features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the hashed words, each text scaled to length 1."""
    key = words.text * buckets + (words.hash >> np.uint64(20)).astype(np.int64) % buckets
    key, tf = np.unique(key, return_counts=True)
    row, col = np.divmod(key, buckets)
    val = np.log1p(tf)
    norm = np.sqrt(np.bincount(row, weights=val * val, minlength=len(words.counts)))
    return row, col, val / norm[row]


def structure(words: Words, n_chars: np.ndarray) -> np.ndarray:
    """STATS numbers of each text, all finite (a text without words has zeros)."""
    off, n = words.off, len(words.off) - 1
    size = np.diff(off)
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * 9 + _CLASS[words.buf], minlength=n * 9).reshape(n, 9)
    share = kinds / np.maximum(size, 1)[:, None]
    count = np.maximum(words.counts, 1)
    owner = words.text

    def of_words(x):
        return np.bincount(owner, weights=x, minlength=n) / count

    long = words.end - words.start
    odd_end = _CLASS[words.buf[words.end - 1]] == 0 if len(owner) else np.zeros(0)
    odd_start = np.isin(_CLASS[words.buf[words.start]], (0, 6)) if len(owner) else np.zeros(0)
    order = np.lexsort((words.hash, owner))
    h, o = words.hash[order], owner[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    repeated = np.bincount(o, weights=again, minlength=n) / count
    pair = mix(words.hash[:-1] * np.uint64(3) + words.hash[1:]) if len(owner) > 1 else np.zeros(0, np.uint64)
    po = owner[:-1][owner[:-1] == owner[1:]]
    pair = pair[owner[:-1] == owner[1:]]
    order = np.lexsort((pair, po))
    pair, po = pair[order], po[order]
    twice = np.zeros(len(pair), bool)
    twice[1:] = (pair[1:] == pair[:-1]) & (po[1:] == po[:-1])
    pairs = np.bincount(po, weights=twice, minlength=n) / count
    chars = size - np.bincount(text, weights=(words.buf & 0xC0) == 0x80, minlength=n)
    declared = np.where(np.isfinite(n_chars), n_chars, chars)
    return np.column_stack([*share.T[[0, 1, 3, 4, 5, 6, 7, 8]], of_words(long) / 10, of_words(long == 1), of_words(odd_end), of_words(odd_start),
                            repeated, pairs, np.log1p(words.counts) / 10, np.log1p(np.abs(declared - chars)) / 10])


def _features(batch: pa.RecordBatch, buckets: int):
    """Slices of a batch: (first row, row after, words' features, statistics)."""
    declared = batch.column("_n_chars").to_numpy(zero_copy_only=False).astype(float)
    for i, j, words in word_slices(row_texts(batch)):
        yield i, j, word_features(words, buckets), structure(words, declared[i:j])


def _declared(docs: DataFrame) -> Column:
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return n_chars.alias("_n_chars")


def _collected(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, (row, col, val), stats in _features(batch, buckets):
            at = np.searchsorted(row, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("_id").slice(i, j - i), batch.column("_label").slice(i, j - i),
                pa.array([col[a:b].astype(np.int32).tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                pa.array([val[a:b].astype(np.float32).tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                pa.array([s.astype(np.float64).tobytes() for s in stats], pa.binary())], names=["_id", "_label", "col", "val", "stats"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, buckets: int = BUCKETS, factors: int = FACTORS, epochs: int = 12, seed: int = 7) -> Model | None:
    """``labels``: doc_id, label 0 or 1; the rows to learn from."""
    chosen = labels.where("doc_id is not null and label is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("label").cast("int").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)  # the documented bound; so it can be broadcast
    rows = small_batches(docs).select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"), _declared(docs)).join(F.broadcast(chosen), "_id").select("_id", "_label", "_text", "_n_chars")
    got = rows.mapInArrow(lean(_collected, buckets), "_id long, _label int, col binary, val binary, stats binary").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["_id", "col", "val", "stats"]).reset_index(drop=True)
    y = got["_label"].to_numpy(float)
    stats = np.stack([np.frombuffer(s) for s in got["stats"]])
    mean, scale = stats.mean(0), stats.std(0) + 1e-6
    z = np.clip((stats - mean) / scale, -8, 8)
    cols = [np.concatenate([np.frombuffer(c, np.int32), buckets + np.arange(STATS)]) for c in got["col"]]
    vals = [np.concatenate([np.frombuffer(v, np.float32), s]) for v, s in zip(got["val"], z)]
    rng = np.random.default_rng(seed)
    size = buckets + STATS
    prior = (y.sum() + 1) / (len(y) + 1.5)
    params = np.concatenate([np.zeros((1, size)), rng.normal(0, 0.02, (factors, size))])
    bias, m, v, step = np.log(prior / (1 - prior)), np.zeros_like(params), np.zeros_like(params), 0
    mb = vb = 0.0
    decay = np.r_[np.full(buckets, 2e-3), np.full(STATS, 1e-4)]
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 64):
            own = order[k : k + 64]
            row = np.repeat(np.arange(len(own)), [len(cols[i]) for i in own])
            col, val = np.concatenate([cols[i] for i in own]), np.concatenate([vals[i] for i in own])
            out, sums = margin(bias, params[0], params[1:], len(own), row, col, val)
            g = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - y[own]) / len(own)
            grad = np.empty_like(params)
            grad[0] = np.bincount(col, weights=g[row] * val, minlength=size)
            for f in range(factors):
                grad[f + 1] = np.bincount(col, weights=g[row] * val * (sums[f][row] - params[f + 1][col] * val), minlength=size)
            grad += decay * params / 4
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            params = params - 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            mb, vb = 0.9 * mb + 0.1 * g.sum(), 0.99 * vb + 0.01 * g.sum() ** 2
            bias -= 0.02 * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return Model(float(bias), params[0], params[1:], mean, scale)


def _scored(batches: Iterator[pa.RecordBatch], model: Model, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [np.zeros(0)]
        for i, j, (row, col, val), stats in _features(batch, buckets):
            n = j - i
            z = np.clip((stats - model.mean) / model.scale, -8, 8)
            row = np.concatenate([row, np.repeat(np.arange(n), STATS)])
            col = np.concatenate([col, np.tile(buckets + np.arange(STATS), n)])
            scores.append(model.score(n, row, col, np.concatenate([val, z.ravel()])))
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(np.concatenate(scores))], names=["_row", "_score"])


def score(docs: DataFrame, model: Model | None, buckets: int = BUCKETS, keep: list[str] | None = None) -> DataFrame:
    """_row (a struct of ``keep``, by default all columns) and _score."""
    if model is None:
        return docs.select(row_of(docs, keep), F.lit(1.0).alias("_score"))
    ready = rows_and_texts(docs, keep, _declared(docs))
    schema = StructType([ready.schema["_row"]]).add("_score", DoubleType())
    return ready.mapInArrow(lean(_scored, model, buckets), schema)


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return labels.where(~in_fold("doc_id", 4, 2))


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    scored = score(docs, fit(docs, training_labels(spark, sf_dir)), keep=["doc_id"])
    scored = scored.select("_row.doc_id", "_score")
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
