"""Document fingerprints by consistent weighted sampling.

A text is its lower-cased words (white space and ASCII punctuation part them), each weighted by how often it occurs. For every sample and word, two Gamma(2, 1) draws
and one uniform draw, all functions of the word alone, turn the weight into a level and a rank; the sample is the word and
level of the smallest rank. Two texts agree in a sample with a probability equal to their generalised Jaccard similarity,
the sum of the smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from areapanel.llm import tidy
from areapanel.llm.shingles import mix, word_counts

#: Samples of a fingerprint (4 hex digits each), slots for weighted words whose draws a task remembers, and words of a
#: text drawn at once.
SAMPLES, REMEMBERED, AT_ONCE = 64, 1 << 17, 4096
#: Ranges of the key order for each shuffle partition.
RANGES = 4


class Sampler:
    """Fingerprints of many texts; draws of words that came before are not made again."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.keys = np.zeros(REMEMBERED, np.uint64)
        self.rank = np.zeros((REMEMBERED, samples), np.float32)
        self.code = np.zeros((REMEMBERED, samples), np.uint16)
        self.steps = mix(np.arange(1, 2 * samples + 1, dtype=np.uint64)).reshape(2, samples)

    def draw(self, words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (logarithms) and codes of weighted words: words x samples."""

        def uniform(h: np.ndarray, shift: int, bits: int) -> np.ndarray:
            part = (h >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            return (part.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-bits)

        one, two = mix(words[:, None] ^ self.steps[0]), mix(words[:, None] ^ self.steps[1])
        r = -np.log(uniform(one, 40, 24) * uniform(one, 16, 24))  # Gamma(2, 1)
        c = -np.log(uniform(two, 43, 21) * uniform(two, 22, 21))  # Gamma(2, 1)
        beta = uniform(two, 0, 22)
        level = np.floor(np.log(weights.astype(np.float32))[:, None] / r + beta)
        rank = np.log(c) - r * (level - beta + 1)
        code = (one & np.uint64(0xFFFF)).astype(np.uint16) + level.astype(np.int32).astype(np.uint16) * np.uint16(40503)
        return rank, code

    def recall(self, words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``draw``; each weighted word has one slot, which holds the draws of the last word that used it."""
        keys = mix(words + weights.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
        slots = (keys >> np.uint64(64 - (REMEMBERED - 1).bit_length())).astype(np.int64)
        new = np.flatnonzero(self.keys[slots] != keys)
        rank, code = self.rank[slots], self.code[slots]
        if len(new):
            rank[new], code[new] = self.draw(words[new], weights[new])
            at = slots[new]
            self.keys[at], self.rank[at], self.code[at] = keys[new], rank[new], code[new]
        return rank, code

    def fingerprints(self, texts: list[bytes]) -> list[bytes]:
        """Two bytes a sample; empty for a text without words."""
        out, each = [], np.arange(self.samples)
        with np.errstate(over="ignore"):
            for words, weights in word_counts(texts):
                ranks, codes = [], []
                for lo in range(0, len(words), AT_ONCE):
                    rank, code = self.recall(words[lo : lo + AT_ONCE], weights[lo : lo + AT_ONCE])
                    best = rank.argmin(axis=0)
                    ranks.append(rank[best, each])
                    codes.append(code[best, each])
                out.append(np.array(codes)[np.argmin(ranks, axis=0), each].astype("<u2").tobytes() if ranks else b"")
        return out


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal samples; two empty fingerprints are alike, an empty and another are not."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def edited(text: str, after: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first code points of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _place(docs: DataFrame, key: str) -> Callable[[Column], Column]:
    """A number that rises with the key: the key itself, or of a string the seven bytes after what all keys begin with."""
    if not isinstance(docs.schema[key].dataType, StringType):
        return lambda value: value
    least, most = docs.agg(F.min(key), F.max(key)).first()
    common = len(os.path.commonprefix([(least or "").encode(), (most or "").encode()]))
    return lambda value: F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), common + 1, 7)), 14, "0"), 16, 10).cast("long")


def _in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (part, guest, key, same, text) with parts in key order; each part ends with the guest rows that follow its
    last one: the rows of the next part's smallest key (after the last part, of the first)."""
    parts = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = _place(docs, key)
    cuts = docs.agg(F.percentile_approx(place(F.col(key)), [i / parts for i in range(1, parts)], 100_000)).first()[0] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    part = F.when(F.col("key").isNull(), 0).otherwise(F.size(F.filter(cuts, lambda c: c <= place(F.col("key")))))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "part", part.cast("int"))
    heads = rows.groupBy("part").agg(F.min(F.struct(F.col("key").isNotNull().alias("has"), "key")).alias("head")).orderBy(
        "part").collect()  # one row a part
    if not heads:
        return rows.select("part", F.lit(0).alias("guest"), "key", F.lit(0).cast("long").alias("same"), "text")
    previous = [heads[i - 1]["part"] for i in range(len(heads))]
    kind = docs.schema[key].dataType.simpleString()
    visits = docs.sparkSession.createDataFrame(
        [(h["head"]["key"], p) for h, p in zip(heads, previous, strict=True)], f"head {kind}, visited int")
    same = F.xxhash64("text").alias("same")
    own = rows.select("part", F.lit(0).alias("guest"), "key", same, "text")
    guests = rows.join(F.broadcast(visits), rows["key"].eqNullSafe(visits["head"])).select(
        F.col("visited").alias("part"), F.lit(1).alias("guest"), "key", same, "text")
    dealt = own.unionByName(guests).repartition("part")
    return dealt.sortWithinPartitions("part", "guest", F.col("key").asc_nulls_first(), "same", "text")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``docs``: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after it by key (null keys first; rows that repeat a key by a hash of their text), after
    the last the first; a single row follows itself. A null text counts as empty; a text without words has an empty
    fingerprint. Equal texts have equal fingerprints. An empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, last, key_type = Sampler(samples), None, None
        for batch in batches:
            key_type = batch.schema.field(2).type
            for lo in range(0, len(batch), 256):
                some = batch.slice(lo, 256)
                texts = some.column(4).to_pylist()
                prints = sampler.fingerprints([t.encode() for t in texts])
                pairs = []
                for row in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), some.column(2).to_pylist(), texts,
                               prints, strict=True):
                    if last is not None and last[0] == row[0] and last[1] == 0:
                        pairs.append((last, row))
                    last = row
                yield out(pairs, sampler, key_type)

    def out(pairs: list, sampler: Sampler, key_type) -> pa.RecordBatch:
        texts = [edited(a[3], b[3]).encode() for a, b in pairs]
        prints = sampler.fingerprints(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([a[2] for a, _ in pairs], key_type), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
             pa.array([a[4].hex() for a, _ in pairs], pa.string()), pa.array([x.hex() for x in prints], pa.string()),
             pa.array([likeness(a[4], x) for (a, _), x in zip(pairs, prints, strict=True)], pa.float64()),
             pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64())],
            ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return _in_order(docs, key, text).mapInArrow(
        tidy(walk), f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double").withColumnRenamed("key", key)
