"""Packing of token sequences into windows by non-negative least squares over the histogram of lengths.

A document's ids are cut into whole windows and a rest. For the rests, combinations of two to four lengths that fill a
window exactly are enumerated; non-negative least squares finds how often to repeat each so that together they use up
the histogram; the counts are rounded and cut to what there is. Rests are numbered within their length, and a range of
numbers of each length goes to each combination, so the plan is a small table whatever the number of documents. What
the plan leaves is packed greedily, a stretch of rests a task: a rest that doesn't fit is cut where the window is full.

A cut falls on a multiple of ``GRID`` ids of its rest: checksums of the rest up to each such place travel with it, and the
checksum of any stretch between two of them follows from theirs, so ids are read once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.llm.bpe import encoder_of, read_tokenizer
from areapanel.llm.sharding import with_slot
from areapanel.session import write_scratch

#: Ids between two places where a rest may be cut; sweeps of the least squares; windows a greedy task should fill.
GRID, SWEEPS, WINDOWS_A_TASK = 16, 25, 2000

_POLYNOMIAL = 0xEDB88320


def _times(matrix: list[int], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


def _zero_bytes() -> list[list[int]]:
    """Matrices over bits that advance a CRC-32 by 1, 2, 4, ... zero bytes."""
    step = [_POLYNOMIAL] + [1 << i for i in range(31)]  # one zero bit
    out = []
    for k in range(40):
        step = [_times(step, x) for x in step]
        if k >= 2:
            out.append(step)
    return out


_ZEROS = _zero_bytes()


def crc_between(before: int, whole: int, size: int) -> int:
    """CRC-32 of the last ``size`` bytes of data with CRC ``whole`` whose earlier part has CRC ``before``."""
    for matrix in _ZEROS:
        if not size:
            break
        if size & 1:
            before = _times(matrix, before)
        size >>= 1
    return before ^ whole


def combinations(window: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths (ascending) that sum to ``window``: all pairs, and for every length some
    triples and fours, spread over the lengths that can go with it."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    found: set[tuple[int, ...]] = set()
    for a in present.tolist():
        if 2 * a <= window and have[window - a]:
            found.add((a, window - a))
        for depth in (3, 4):
            rest = window - a
            for share in range(1, 7):
                b = max(1, rest * share // (7 * (depth - 1) // 2 + 1))
                if depth == 3:
                    parts = (a, b, rest - b)
                else:
                    parts = (a, b, (rest - b) // 2, rest - b - (rest - b) // 2)
                if min(parts) > 0 and have[list(parts)].all():
                    found.add(tuple(sorted(parts)))
    return sorted(found)


def solve_counts(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, times), never more of a length than there is: non-negative least squares by coordinate descent,
    rounded, then filled up in the order of the solution."""
    lengths = np.array(sorted(length for length in histogram if 0 < length < window), np.int64)
    sets = combinations(window, lengths)
    target = np.zeros(window + 1)
    target[lengths] = [histogram[int(i)] for i in lengths]
    columns = []
    for c in sets:
        values, times = np.unique(c, return_counts=True)
        columns.append((values.tolist(), times.tolist(), float((times * times).sum())))
    x, left = [0.0] * len(sets), target.tolist()
    for _ in range(SWEEPS):
        for k, (values, times, norm) in enumerate(columns):
            slope = sum(left[v] * t for v, t in zip(values, times, strict=True)) / norm
            new = max(0.0, x[k] + slope)
            if new != x[k]:
                for v, t in zip(values, times, strict=True):
                    left[v] -= (new - x[k]) * t
                x[k] = new
    remain = {int(i): int(target[i]) for i in lengths}
    counts = [0] * len(sets)
    order = sorted(range(len(sets)), key=lambda k: (-x[k], sets[k]))
    for most in (x, None):
        for k in order:
            values, times, _ = columns[k]
            n = min(remain[v] // t for v, t in zip(values, times, strict=True))
            n = min(n, round(most[k])) if most is not None else n
            if n > 0:
                counts[k] += n
                for v, t in zip(values, times, strict=True):
                    remain[v] -= n * t
    return [(c, n) for c, n in zip(sets, counts, strict=True) if n]


def _cut_documents(docs: DataFrame, tokenizer: str, key: str, text: str, window: int, end_id: int) -> DataFrame:
    """Rows (row, key, start, length, crc, doc_tokens, marks): whole windows, and the rest with its checksums at every
    ``GRID`` ids (uint32 after uint32)."""
    kind = docs.schema[key].dataType.simpleString()
    shared = read_tokenizer(docs, tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            source, rows = [], []
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                data = np.append(ids, end_id).astype("<u4").tobytes()
                n = len(data) // 4
                for start in range(0, n, window):
                    part = memoryview(data)[4 * start : 4 * min(n, start + window)]
                    marks, crc = b"", 0
                    if len(part) < 4 * window:
                        seen = [0]
                        for at in range(0, len(part) - 4 * GRID + 1, 4 * GRID):
                            crc = zlib.crc32(part[at : at + 4 * GRID], crc)
                            seen.append(crc)
                        crc = zlib.crc32(part[4 * GRID * (len(seen) - 1) :], crc)
                        marks = np.array(seen, "<u4").tobytes()
                    else:
                        crc = zlib.crc32(part)
                    source.append(i)
                    rows.append((start, len(part) // 4, crc, n, marks))
            start, length, crc, total, marks = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())),
                 *(pa.array(c, pa.int64()) for c in (start, length, crc, total)), pa.array(marks, pa.binary())],
                ["key", "start", "length", "crc", "doc_tokens", "marks"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).mapInArrow(
        tidy(cut), f"key {kind}, start long, length long, crc long, doc_tokens long, marks binary")
    return rows.withColumn("row", F.monotonically_increasing_id())


def _greedy(window: int, kind: str):
    """Packs a stream of rests one after the other; a rest that doesn't fit is cut at the last ``GRID`` ids that do."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, used = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            source, rows = [], []
            columns = [batch.column(n).to_pylist() for n in ("start", "length", "crc", "marks")]
            for i, (start, length, crc, marks) in enumerate(zip(*columns, strict=True)):
                seen = np.frombuffer(marks, "<u4")
                at, before = 0, 0
                while at < length:
                    room = window - used
                    size = length - at if length - at <= room else room // GRID * GRID
                    if not size:
                        sequence, used = sequence + 1, 0
                        continue
                    now = crc if at + size == length else int(seen[(at + size) // GRID])
                    source.append(i)
                    rows.append((start + at, size, crc_between(before, now, 4 * size), sequence, used))
                    at, before, used = at + size, now, used + size
            start, size, crc, place, offset = zip(*rows, strict=True) if rows else ((),) * 5
            at = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(at), *(pa.array(c, pa.int64()) for c in (start, size, crc)),
                 batch.column("doc_tokens").take(at), pa.array(place, pa.int64()), pa.array(offset, pa.int64())],
                ["key", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"])

    return pack, f"key {kind}, start long, length long, crc long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = 2048,
                   end_id: int = 1) -> DataFrame:
    """One row per piece of a document: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids by the byte-level BPE file ``tokenizer`` and then ``end_id``, so a null or empty text is that id
    alone. Every id lies in one piece; pieces of a sequence follow each other without gaps and hold at most ``window`` ids
    together. Rows that repeat, null keys included, are documents of their own. An empty table gives an empty result; other
    columns are not read.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    cut = write_scratch(_cut_documents(docs, tokenizer, key, text, window, end_id), "cut")
    whole = cut.where(F.col("length") == window).select(
        "key", "start", "length", "crc", "doc_tokens", (F.col("row") + (1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rests = write_scratch(with_slot(cut.where(F.col("length") < window).withColumn("size", F.col("length").cast("int")),
                                    ["row"], shard="size", slot="number"), "rests")
    histogram = {r["size"]: r["n"] for r in rests.groupBy("size").agg(F.count("*").alias("n")).collect()}  # < window rows
    plan, used, sequences = [], dict.fromkeys(histogram, 0), 0
    for lengths, times in solve_counts(histogram, window):
        offset = 0
        for size in lengths:
            plan.append((size, used[size], used[size] + times, sequences - used[size], offset))
            used[size] += times
            offset += size
        sequences += times
    table = spark.createDataFrame(plan, "size int, low long, high long, shift long, offset long")
    inside = (rests["size"] == table["size"]) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    placed = rests.join(F.broadcast(table), inside, "left").drop(table["size"])
    planned = placed.where("offset IS NOT NULL").select(
        "key", "start", "length", "crc", "doc_tokens", (F.col("number") + F.col("shift")).alias("sequence_id"), "offset")
    spare = sum(size * (n - used[size]) for size, n in histogram.items())
    tasks = max(1, min(-(-spare // (WINDOWS_A_TASK * window)), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    pack, schema = _greedy(window, kind)
    rest = placed.where("offset IS NULL").select("row", "key", "start", "length", "crc", "doc_tokens", "marks")
    greedy = rest.repartition(tasks, F.xxhash64("row")).sortWithinPartitions("row").select(
        "key", "start", "length", "crc", "doc_tokens", "marks").mapInArrow(tidy(pack), schema).withColumn(
        "sequence_id", F.col("sequence_id") + (1 << 61))
    return planned.unionByName(greedy).unionByName(whole).select(
        F.col("key").alias(key), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
