"""Alignment of the tokens of two tokenizers over whole texts, by ``merge_asof`` on byte offsets, keyed by document.

Side A is a byte-level BPE file, side B a sentencepiece model; both encode a space and the text. Every token covers a range
of bytes. The start of each token finds the token of the other side that covers it; two tokens overlap exactly when the
later of their starts lies in the other one, so the union of both directions is all overlaps, each once. Overlaps whose
ranges end together are the links, and their ends cut both token sequences into groups.

Corpus-wide counts of linked id pairs never leave the cluster and are never copied to every task. Documents are aligned in
blocks of ``BLOCK`` bytes; a block is one row with its documents, its distinct pairs and, packed link by link, which of
those it is. Only the distinct pairs of a block meet the counts, by a join on the pair, and come back to their block.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.llm.bpe import ChunkEncoder, Decoder, read_tokenizer
from areapanel.llm.shingles import text_blocks
from areapanel.session import write_scratch

#: Bytes of text and number of documents in a block; one longer text is a block of its own.
BLOCK, DOCUMENTS = 1 << 20, 1 << 13
#: Rows and bytes aligned at a time.
ROWS, BYTES = 64, 1 << 17


class PlainEncoder(ChunkEncoder):
    """Ids by a byte-level BPE file that takes the strings of special tokens as plain text."""

    def __init__(self, tokenizer_json: str):
        super().__init__(tokenizer_json)
        self.special = []

    @functools.cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.source)
        found.no_truncation()
        found.no_padding()
        found.encode_special_tokens = True
        return found


def _texts_of(ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. ids - 1, each with room for a mark after it: bytes, first byte and size by id."""
    written = [b"%d," % i for i in range(ids)]
    sizes = np.array(list(map(len, written)))
    return np.frombuffer(b"".join(written), np.uint8), np.cumsum(sizes) - sizes, sizes


class Aligner:
    """Both tokenizers, and the tables that their ids index."""

    def __init__(self, tokenizer_json: str, model: bytes):
        import sentencepiece

        self.a = PlainEncoder(tokenizer_json)
        self.a_sizes = Decoder(tokenizer_json).sizes
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in pieces]
        self.b_sizes = np.array(list(map(len, self.b_bytes)))
        self.digits, self.first, self.width = _texts_of(max(len(self.a_sizes), len(self.b_sizes)))

    def tokens(self, texts: list[bytes | None]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Tokens of each side: doc (place in ``texts``), index in its document, id, and start and end in the bytes of all
        documents put one after the other. Documents without tokens have no rows."""
        whole = [b" " + t if t else b"" for t in texts]
        a_ids = list(self.a.encode(whole))
        b_ids = self.b.encode([t.decode() for t in (x or b"" for x in texts)], num_threads=1)
        for i, t in enumerate(whole):
            if int(self.a_sizes[a_ids[i]].sum()) != len(t) or b"".join(map(self.b_bytes.__getitem__, b_ids[i])) != t:
                a_ids[i], b_ids[i] = a_ids[i][:0], []
        return _frame(a_ids, self.a_sizes), _frame([np.array(x, np.int64) for x in b_ids], self.b_sizes)

    def overlaps(self, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        """Places (in ``a`` and ``b``) of all pairs of tokens of one document whose byte ranges overlap."""
        ours = pd.DataFrame({"start": a["start"], "doc": a["doc"], "a": np.arange(len(a))})
        theirs = pd.DataFrame({"start": b["start"], "doc": b["doc"], "b": np.arange(len(b))})
        by_a = pd.merge_asof(ours, theirs, on="start", by="doc")
        by_b = pd.merge_asof(theirs, ours, on="start", by="doc")
        later = b["start"].to_numpy() > a["start"].to_numpy()[by_b["a"]]  # with equal starts, the pair is in by_a
        return pd.concat([by_a[["a", "b"]], by_b.loc[later, ["a", "b"]]])

    def groups(self, a: pd.DataFrame, b: pd.DataFrame, docs: int) -> tuple[pd.DataFrame, list[str]]:
        """Links (places in ``a`` and ``b``, in the order of their ends) and the digest of each document's groups."""
        pairs = self.overlaps(a, b)
        together = a["end"].to_numpy()[pairs["a"]] == b["end"].to_numpy()[pairs["b"]]
        links = pairs[together].sort_values("a", kind="stable")
        return links, self._digests(a, b, links, docs)

    def _digests(self, a: pd.DataFrame, b: pd.DataFrame, links: pd.DataFrame, docs: int) -> list[str]:
        if not len(a):
            return [""] * docs
        last_a, last_b = links["a"].to_numpy(), links["b"].to_numpy()
        # A token of one side is written after the tokens of the other side that belong to groups up to its own.
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]
        place_b = np.arange(len(b)) + (last_a + 1)[group_b]
        ids = np.empty(len(a) + len(b), np.int64)
        ids[place_a], ids[place_b] = a["id"], b["id"]
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
        size = self.width[ids]
        ends = np.cumsum(size)
        text = self.digits[np.arange(ends[-1]) + np.repeat(self.first[ids] - (ends - size), size)]
        text[ends - 1] = mark
        tokens = np.bincount(a["doc"], minlength=docs) + np.bincount(b["doc"], minlength=docs)
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(tokens)])]
        return [hashlib.sha256(text[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cut[:-1], cut[1:], strict=True)]


def _frame(ids: list[np.ndarray], sizes: np.ndarray) -> pd.DataFrame:
    counts = np.array(list(map(len, ids)), np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
    ends = np.cumsum(sizes[flat])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), counts), "id": flat, "start": ends - sizes[flat], "end": ends,
                         "index": np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)})


@functools.lru_cache(1)
def _aligner(tokenizer_json: str, model: bytes) -> Aligner:
    """The tokenizers of this worker process, kept from task to task."""
    return Aligner(tokenizer_json, model)


def _shared(docs: DataFrame, tokenizer: str, model: str):
    """Both files as broadcasts (of fixed size, whatever the input)."""
    with open(model, "rb") as f:
        return read_tokenizer(docs, tokenizer), docs.sparkSession.sparkContext.broadcast(f.read())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Keys and texts, some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for block in text_blocks(texts, BYTES):
                yield keys[: len(block)], block
                keys = keys[len(block) :]


def _inputs(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))


def token_overlaps(docs: DataFrame, tokenizer: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All overlaps: key, a_index, b_index, a_id, b_id, start and end (the shared bytes of space and text), linked (the
    ranges end together). Documents without tokens (see ``align_tokens``) have no rows."""
    kind = docs.schema[key].dataType.simpleString()
    json_text, proto = _shared(docs, tokenizer, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(json_text.value, proto.value)
        for keys, texts in _rows(batches):
            a, b = aligner.tokens(texts)
            base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
            used = np.isin(np.arange(len(texts)), a["doc"])
            base = np.concatenate([[0], np.cumsum(np.diff(base) * used)])
            found = aligner.overlaps(a, b).sort_values(["a", "b"])
            x, y = a.iloc[found["a"]].reset_index(drop=True), b.iloc[found["b"]].reset_index(drop=True)
            doc = x["doc"].to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[i] for i in doc], out_kind), pa.array(x["index"], pa.int64()), pa.array(y["index"], pa.int64()),
                pa.array(x["id"], pa.int64()), pa.array(y["id"], pa.int64()),
                pa.array(np.maximum(x["start"], y["start"]) - base[doc], pa.int64()),
                pa.array(np.minimum(x["end"], y["end"]) - base[doc], pa.int64()), pa.array(x["end"] == y["end"], pa.bool_()),
            ], ["key", "a_index", "b_index", "a_id", "b_id", "start", "end", "linked"])

    out_kind = _arrow_type(docs, key)
    return _inputs(docs, key, text).mapInArrow(tidy(run), (
        f"key {kind}, a_index long, b_index long, a_id long, b_id long, start long, end long, linked boolean"
    )).withColumnRenamed("key", key)


def _arrow_type(docs: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[key].dataType)


def _packed(places: np.ndarray) -> bytes:
    """Numbers from 0 on, compressed: outside of tasks in Python a block's links are one short value, not millions."""
    narrow = places.astype("<u2" if not len(places) or places.max() < 1 << 16 else "<u4")
    return bytes([narrow.itemsize]) + pa.Codec("zstd").compress(narrow, asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_packed``."""
    size = packed[0]
    return np.frombuffer(pa.Codec("zstd").decompress(packed[1:], n * size, asbytes=True), f"<u{size}")


def aligned_blocks(docs: DataFrame, tokenizer: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per block: block, keys, n_a, n_b, n_links, digests (one entry a document), pairs (distinct linked id pairs,
    ``a * 2**32 + b``), counts (links of each), links (the place in ``pairs`` of every link, document after document, as of
    ``_packed``)."""
    kind = docs.schema[key].dataType.simpleString()
    out_kind = _arrow_type(docs, key)
    json_text, proto = _shared(docs, tokenizer, model)
    names = ["block", "keys", "n_a", "n_b", "n_links", "digests", "pairs", "counts", "links"]

    def row(number: int, held: list[tuple]) -> pa.RecordBatch:
        keys, n_a, n_b, n_links, digests, codes = zip(*held, strict=True)
        pairs, place, counts = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
        columns = [pa.array([x for k in keys for x in k], out_kind), *[pa.array(np.concatenate(x), pa.int64()) for x in (
            n_a, n_b, n_links)], pa.array([x for d in digests for x in d], pa.string()), pa.array(pairs, pa.int64()),
            pa.array(counts, pa.int64())]
        block = pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64())
        return pa.RecordBatch.from_arrays([block, *[pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
                                                    for c in columns], pa.array([_packed(place)], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(json_text.value, proto.value)
        held, size, rows, number = [], 0, 0, 0
        for keys, texts in _rows(batches):
            if held and (size + sum(map(len, texts)) > BLOCK or rows + len(texts) > DOCUMENTS):
                yield row(number, held)
                held, size, rows, number = [], 0, 0, number + 1
            a, b = aligner.tokens(texts)
            links, digests = aligner.groups(a, b, len(texts))
            of = a["doc"].to_numpy()[links["a"]]
            codes = (a["id"].to_numpy()[links["a"]] << 32) + b["id"].to_numpy()[links["b"]]
            held.append((keys, np.bincount(a["doc"], minlength=len(texts)), np.bincount(b["doc"], minlength=len(texts)),
                         np.bincount(of, minlength=len(texts)), digests, codes))
            size, rows = size + sum(map(len, texts)), rows + len(texts)
        if held:
            yield row(number, held)

    lists = ", ".join(f"{n} array<{t}>" for n, t in zip(names[1:-1], [kind, "long", "long", "long", "string", "long", "long"],
                                                        strict=True))
    return _inputs(docs, key, text).mapInArrow(tidy(run), f"block long, {lists}, links binary")


def align_tokens(docs: DataFrame, tokenizer: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    An id pair's count is the number of links that hold it in all of ``docs``; a link is one of the best if no other pair
    with its B id has a higher count. A text that is null or empty, or whose tokens of one side do not give its bytes back
    (that side's normaliser changed them), has no tokens: zeros and an empty digest. Rows that repeat a key or a text count
    each for itself. An empty table gives an empty result; other columns are not read, so clashing names do no harm.
    """
    blocks = write_scratch(aligned_blocks(docs, tokenizer, model, key, text), "aligned")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "counts"))).select(
        "block", F.col("pos").alias("place"), F.col("col.pairs").alias("pair"), F.col("col.counts").alias("n"))
    totals = entries.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    highest = totals.groupBy("b").agg(F.max("total").alias("most"))
    known = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    counted = entries.select("block", "place", "pair").join(known, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    kind = docs.schema[key].dataType.simpleString()

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right["place"].to_numpy()
        total[at], best[at] = right["total"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        one = {n: left[n].combine_chunks().flatten() for n in left.column_names if n not in ("block", "links")}
        n_links = one["n_links"].to_numpy()
        ends = np.cumsum(n_links)
        links = _unpacked(left["links"][0].as_py(), int(ends[-1]))
        sums = [np.concatenate([[0], np.cumsum(x[links])]) for x in (best, total)]
        found = [pa.array(s[ends] - s[ends - n_links], pa.int64()) for s in sums]
        return pa.table([one["keys"], one["n_a"], one["n_b"], one["n_links"], one["n_links"], *found, one["digests"]], [
            "key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    rows = blocks.select("block", "keys", "n_a", "n_b", "n_links", "digests", "links")
    return rows.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(finish, (
        f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )).withColumnRenamed("key", key)
