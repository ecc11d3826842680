"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by stochastic gradient
descent in numpy, with calibrated scores and rejection.

A document is the mean of the embeddings of its byte n-grams (inside words, with the word's edges); a linear layer gives
one logit a language. At prediction the two are one table of logits per n-gram bucket. A bounded sample of labelled rows
trains the model on the driver; scores are calibrated by a temperature, and rejection by a quantile of the scores that
right answers get, both on rows the training did not see. A text most of whose n-grams the training never met, as one in an
unknown script, is rejected too, by a quantile of the shares of known n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.llm.letters import blocks, grams, list_views

#: Labelled rows to train on for each language, and n-gram sizes, buckets and width of the embedding.
ROWS_PER_LANGUAGE, SIZES, BUCKETS, WIDTH = 800, (2, 3, 4), 1 << 15, 16
#: Expected texts drawn for each that is wanted.
DRAWN = 1.5
#: Finer buckets for n-grams met in training: the first bits of a fine bucket are those of its bucket.
FINE_BITS = 5
EPOCHS, BATCH, RATE = 6, 32, 0.5
#: Rows taken from an Arrow batch at a time.
ROWS = 512
#: Share of rows kept from training for calibration; share of right answers that rejection may cost.
HELD, COST = 0.25, 0.002
#: Share of the usual share of known n-grams below which a text is rejected.
KNOWN = 0.8

UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    threshold: float
    met: np.ndarray  # fine buckets of the n-grams of training
    least_known: float

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities (documents x languages), whether each text has letters, and whether it is rejected."""
        sums, counts, known = [], [], []
        for data, starts in blocks(texts):
            total, n = np.zeros((len(starts) - 1, len(self.languages))), np.zeros(len(starts) - 1)
            old = np.zeros(len(n))
            for size in SIZES:
                fine, doc = grams(data, starts, size, BUCKETS << FINE_BITS)
                bucket = fine >> FINE_BITS
                n += np.bincount(doc, minlength=len(n))
                old += np.bincount(doc, weights=self.met[fine], minlength=len(n))
                for c in range(len(self.languages)):
                    total[:, c] += np.bincount(doc, weights=self.logits[bucket, c], minlength=len(n))
            sums.append(total)
            counts.append(n)
            known.append(old)
        n = np.concatenate([np.zeros(0), *counts])
        if not self.languages:  # nothing was learned
            return np.ones((len(n), 1)), np.zeros(len(n), bool), np.ones(len(n), bool)
        total = np.concatenate([np.zeros((0, len(self.languages))), *sums])
        p = _softmax((total / np.maximum(n, 1)[:, None] + self.bias) / self.temperature)
        strange = np.concatenate([np.zeros(0), *known]) < self.least_known * n
        return p, n > 0, (n == 0) | (p.max(axis=1, initial=0.0) < self.threshold) | strange


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True, initial=-np.inf))
    return e / e.sum(axis=1, keepdims=True)


def _counts(texts: list[str | None]) -> Iterator[tuple[pa.ListArray, pa.ListArray]]:
    """Distinct fine buckets of each text's n-grams and how often each occurs, a block of texts at a time."""
    fine = BUCKETS << FINE_BITS
    for data, starts in blocks(texts):
        found = [grams(data, starts, size, fine) for size in SIZES]
        bucket, doc = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        pair, n = np.unique(doc * fine + bucket, return_counts=True)
        cut = pa.array(np.searchsorted(pair, np.arange(len(starts)) * fine).astype(np.int32))
        yield tuple(pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (pair % fine, n))


def _nothing() -> LanguageModel:
    return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0, np.zeros(BUCKETS << FINE_BITS, bool), 0.0)


def train(docs: DataFrame, usable: Column, text: str = "text", language: str = "lang") -> LanguageModel:
    """A model from at most ``ROWS_PER_LANGUAGE`` distinct texts a language: those with the smallest hashes among the rows
    that ``usable`` selects.

    Rows with a null language, a null text or a text without letters are left out, and copies count once. Without any row to
    learn from (an empty table too) the model finds no language: every text is ``und`` and rejected. Columns of other
    names are not read.
    """
    rows = docs.where(usable & F.col(language).isNotNull() & F.col(text).rlike("\\p{L}")).select(
        F.col(text).alias("text"), F.col(language).alias("language"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "draw": F.pmod(F.xxhash64("text"), F.lit(1 << 30))})
    sizes = dict(rows.groupBy("language").agg(F.approx_count_distinct("h")).toArrow().to_pandas().itertuples(index=False))
    if not sizes:
        return _nothing()
    # A little more than enough by their hashes, then copies made one and the rest counted off.
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (
        lang, int(min(1.0, DRAWN * ROWS_PER_LANGUAGE / n) * (1 << 30)))])
    distinct = rows.where(F.col("draw") < limit[F.col("language")]).groupBy("language", "draw", "h").agg(
        F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("language").orderBy("draw", "h"))
    sample = distinct.withColumn("place", place).where(F.col("place") <= ROWS_PER_LANGUAGE).select("text", "language", "h")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for bucket, n in _counts(batch.column(0).to_pylist()):
                rest = batch.slice(at, len(n))
                at += len(n)
                yield pa.RecordBatch.from_arrays([bucket, n, rest.column(1), rest.column(2)], ["bucket", "n", "language", "h"])

    got = sample.mapInArrow(tidy(features), "bucket array<int>, n array<int>, language string, h long").toArrow()
    names = got["language"].to_pylist()
    languages = sorted(sizes)
    order = np.lexsort((names, got["h"].to_numpy()))
    buckets, counts = list_views(got["bucket"]), list_views(got["n"])
    fine_x = [(buckets[i], counts[i].astype(np.float32)) for i in order]
    docs_x = [(f >> FINE_BITS, n) for f, n in fine_x]
    y = np.array([languages.index(names[i]) for i in order])
    held = np.random.default_rng(1).random(len(y)) < HELD
    if held.all() or not held.any() or len(y) < 20:
        held = np.zeros(len(y), bool)
    table, bias = _fit([x for x, h in zip(docs_x, held, strict=True) if not h], y[~held], len(languages))
    check = held if held.any() else ~held
    z = np.array([(n @ table[b]) / n.sum() for (b, n), h in zip(docs_x, check, strict=True) if h]) + bias
    truth = y[check]
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    threshold = float(min(np.quantile(right, COST), 0.5)) if len(right) else 0.0
    met = np.zeros(BUCKETS << FINE_BITS, bool)
    for (f, _), h in zip(fine_x, held, strict=True):
        if not h:
            met[f] = True
    shares = [n[met[f]].sum() / n.sum() for (f, n), h in zip(fine_x, check, strict=True) if h]
    return LanguageModel(languages, table, bias, temperature, threshold, met, KNOWN * float(np.quantile(shares, COST)))


def _fit(x: list, y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(0)
    embed = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH))
    weight, bias = rng.normal(0, 0.1, (WIDTH, classes)), np.zeros(classes)
    steps = EPOCHS * -(-len(y) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(y)), max(1, -(-len(y) // BATCH))):
            rate = RATE * (1 - step / steps)
            step += 1
            share = [x[i][1] / x[i][1].sum() for i in at]
            mean = np.array([s @ embed[x[i][0]] for s, i in zip(share, at, strict=True)])
            error = _softmax(mean @ weight + bias)
            error[np.arange(len(at)), y[at]] -= 1
            back = error @ weight.T
            weight -= rate / len(at) * mean.T @ error
            bias -= rate / len(at) * error.sum(axis=0)
            for s, i, g in zip(share, at, back, strict=True):  # n-grams are rare: a larger step for their rows
                embed[x[i][0]] -= rate * 20 * s[:, None] * g
    return embed @ weight, bias


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, lang_pred, score, rejected; only the text is an input.

    A text that is null or has no letter is ``und`` with score 0 and rejected. Others get the likeliest learned language
    and its calibrated probability; they are rejected below the model's threshold, or with too few n-grams it knows. Rows that repeat are predicted alike.
    An empty table gives an empty result; columns of other names are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            p, letters, rejected = model.scores(batch.column(1).to_pylist())
            best = p.argmax(axis=1)
            score = np.where(letters, p[np.arange(len(p)), best], 0.0)
            names = [model.languages[b] if has else UNKNOWN for b, has in zip(best.tolist(), letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], ["key", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(predict), f"key {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed(
        "key", key)


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the key as text, modulo 4, is 2. A null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, all columns as they are.

    Null texts and texts without letters go; rows that repeat stay or go alike; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                rejected = model.scores(some.column(place).to_pylist())[2]
                yield some.filter(pa.array(~rejected, pa.bool_()))

    return docs.mapInArrow(tidy(keep), docs.schema)
