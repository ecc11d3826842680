"""Weighted rendezvous hashing of record keys over shards, and gapless slots inside each shard. DataFrame code only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areapanel.session import write_scratch

#: Numbering buckets of a shard: slots are counted per bucket, so no task sorts a whole shard.
BUCKETS = 256
#: Bytes a record takes besides its text.
RECORD_BYTES = 16


def _score(key: Column, shard: Column, weight: Column) -> Column:
    """``-weight / ln(u)`` with ``u`` uniform in (0, 1) from the hash of key and shard: the shard with the largest score
    gets the key, in proportion to the weights, whatever other shards there are."""
    u = (F.shiftrightunsigned(F.xxhash64(key, shard), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -weight / F.log(u)


def with_shard(docs: DataFrame, key: str, weights: Sequence[float], shard: str = "shard",
               grown: str | None = "grown_shard", grown_weight: float = 1.0) -> DataFrame:
    """``docs`` with the shard (0 .. len(weights) - 1) of each row's key and, in ``grown``, its shard when one more of
    ``grown_weight`` is added: either the same or the new one."""
    text = F.col(key).cast("string")
    scores = F.transform(F.array(*[F.lit(float(w)) for w in weights]), lambda w, j: F.struct(
        _score(text, j, w).alias("score"), (-j).alias("order")))
    best = F.array_max(scores)
    out = docs.withColumn(shard, best)
    if grown:
        new = _score(text, F.lit(len(weights)), F.lit(float(grown_weight)))
        out = out.withColumn(grown, F.when(new > F.col(f"{shard}.score"), F.lit(len(weights))).otherwise(
            -F.col(f"{shard}.order")).cast("int"))
    return out.withColumn(shard, (-F.col(f"{shard}.order")).cast("int"))


def with_slot(rows: DataFrame, order: Sequence[str], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``rows`` with a gapless number from 0 inside each shard.

    Rows are dealt evenly over ``BUCKETS`` numbered buckets a shard, whatever their keys, and the dealing is written
    before it is counted. A bucket's rows are numbered by ``order`` after all rows of the shard's earlier buckets. The
    table of counts has ``shards * BUCKETS`` rows at most.
    """
    dealt = write_scratch(rows.withColumn("_bucket", F.pmod(F.monotonically_increasing_id(), F.lit(BUCKETS)).cast("int")),
                          "dealt")
    counts = dealt.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*order)) - 1
    return dealt.withColumn("_place", place).join(starts, [shard, "_bucket"]).withColumn(
        slot, (F.col("_start") + F.col("_place")).cast("long")).drop("_bucket", "_place", "_start")


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40,
                    weights: Sequence[float] | None = None) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law (``key``), shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus ``RECORD_BYTES``; a null text has none and the checksum of an empty one.
    The shard depends on the key and the weights alone, so rows that repeat a key, a null key included, share a shard;
    they get slots of their own. An empty table gives an empty result. Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), (F.octet_length(body).cast("long") + RECORD_BYTES).alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = with_shard(rows, "_key", weights or [1.0] * shards)
    return with_slot(placed, ["_key", "text_crc32", "size"]).select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
