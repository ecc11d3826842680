"""Toxicity by a classifier chain: one linear model a category, in order, each fed the probabilities of the categories
before it. Those probabilities are out-of-fold in training, so a later model learns from what it will see.

Models are logistic regressions on the hashed distinct letter words of the whole text, trained with follow-the-regularised-
leader updates in numpy. The L1 term leaves only words that carry a category, so a long text scores by them and not by
its length. Training uses a bounded sample of labelled rows; decisions use the threshold with the best F1 out of fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.llm.letters import letter_words, list_views
from areapanel.llm.shingles import shingle_sets

#: Labelled rows to train on, hash buckets of words, folds and passes.
TRAIN_ROWS, BUCKETS, FOLDS, PASSES = 12_000, 1 << 18, 3, 5
#: Follow-the-regularised-leader: step, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 6.0, 1.0

#: Categories in the order of the chain, as SQL over the label columns.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def word_buckets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Distinct buckets of each text's letter words."""
    for h in shingle_sets(list(map(letter_words, texts)), 1):
        yield np.unique((h >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64))


@dataclass
class Chain:
    categories: list[str]
    weights: np.ndarray  # categories x (buckets + 1 + categories): words, bias, earlier probabilities
    thresholds: list[float]

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (texts x categories) and whether each text has letter words."""
        found = list(word_buckets(texts))
        cut = np.cumsum([0, *map(len, found)])
        flat = np.concatenate([np.zeros(0, np.int64), *found])
        doc = np.repeat(np.arange(len(found)), np.diff(cut))
        p = np.zeros((len(found), len(self.categories)))
        for c, w in enumerate(self.weights):
            z = np.bincount(doc, weights=w[flat], minlength=len(found)) + w[BUCKETS] + p[:, :c] @ w[BUCKETS + 1 :][:c]
            p[:, c] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return p, np.diff(cut) > 0


def _fit(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
    """Weights of words, bias and extra features."""
    width = BUCKETS + 1 + extra.shape[1]
    z, n = np.zeros(width), np.zeros(width)
    tail = np.arange(BUCKETS, width)
    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)):
            at = np.concatenate([rows[i], tail])
            x = np.concatenate([np.ones(len(rows[i]) + 1), extra[i]])
            w = _weights(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y[i]) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _predict(w: np.ndarray, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    z = np.array([w[r].sum() for r in rows]) + w[BUCKETS] + extra @ w[BUCKETS + 1 :]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap below the cut with the best F1; 0.5 if nothing is positive."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.r_[np.diff(p[order]) != 0, True]  # equal scores fall on one side
    best = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          categories: dict[str, str] | None = None) -> Chain:
    """A chain from at most ``TRAIN_ROWS`` labelled rows, those with the smallest hashes of their keys.

    A key labelled more than once has each category that any of its labels has. Labels with a null, and null keys, are left
    out; rows that repeat a key count each, within the bound. A null text has no words. Without any labelled row (an empty
    table too) the chain gives every text probability 0.5 and no category. Columns of other names are not read.
    """
    categories = categories or CATEGORIES
    known = labels.select(F.col(key).alias("_id"), *[F.expr(sql).cast("double").alias(f"y{i}")
                                                     for i, sql in enumerate(categories.values())]).dropna()
    ys = [f"y{i}" for i in range(len(categories))]
    place = F.xxhash64("_id")
    drawn = known.groupBy("_id").agg(*[F.max(y).alias(y) for y in ys]).orderBy(place, "_id").limit(TRAIN_ROWS)
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(drawn), "_id").select(
        "text", "_id", F.array(*ys).alias("y"), F.struct(place.alias("a"), F.xxhash64("text").alias("b")).alias("place"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([x.tolist() for x in word_buckets(batch.column(0).to_pylist())], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), found, batch.column(2), batch.column(3)], ["id", "x", "y", "place"])

    kind = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(tidy(features), f"id {kind}, x array<int>, y array<double>, place struct<a: long, b: long>")
    got = found.orderBy("place", "id").limit(TRAIN_ROWS).drop("place").toArrow().sort_by("id")
    if not len(got):
        return Chain(list(categories), np.zeros((len(categories), BUCKETS + 1 + len(categories))), [2.0] * len(categories))
    x = list_views(got["x"])
    y = np.array(got["y"].to_pylist())
    fold = np.random.default_rng(0).integers(0, FOLDS, len(x))
    seen = np.zeros((len(x), len(categories)))
    weights, thresholds = np.zeros((len(categories), BUCKETS + 1 + len(categories))), []
    for c in range(len(categories)):
        before = seen[:, :c].copy()
        for k in range(FOLDS):
            own = np.flatnonzero(fold != k)
            w = _fit([x[i] for i in own], before[own], y[own, c], k)
            out = np.flatnonzero(fold == k)
            seen[out, c] = _predict(w, [x[i] for i in out], before[out])
        thresholds.append(_threshold(seen[:, c], y[:, c]))
        w = _fit(x, before, y[:, c], FOLDS)
        weights[c, : len(w)] = w
    return Chain(list(categories), weights, thresholds)


def score_toxicity(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, then for each category its probability ``p_<category>`` and decision.

    A text without letters, null included, has no word: it gets the models' base rates and no category. Rows that repeat
    score alike. An empty table gives an empty result; columns of other names are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [x for c in chain.categories for x in (f"p_{c}", c)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            p, words = chain.probabilities(texts)
            out = [batch.column(0)]
            for c, least in enumerate(chain.thresholds):
                out += [pa.array(p[:, c], pa.float64()), pa.array(words & (p[:, c] >= least), pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, ["key", *names])

    columns = ", ".join(f"`p_{c}` double, `{c}` boolean" for c in chain.categories)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        tidy(score), f"key {kind}, {columns}").withColumnRenamed("key", key)
