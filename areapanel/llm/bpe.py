"""Byte-level BPE encoding and decoding of whole texts, with content-defined chunks encoded once.

A rolling hash over the last ``WINDOW`` bytes cuts texts into chunks, so texts that share a passage share its chunks, and a
task encodes each chunk it meets once. A cut falls anywhere, also inside a word, so the ends of chunks are not encoded with
them: a chunk's own ids cover its bytes from the first to the last sure break, and at each join the piece across the cut,
from the last sure break before it to the first after it, is encoded again as a whole. A sure break is a space, or either
side of a line feed, that stands alone between two characters that are no white space: byte-level pre-tokenisers always
start a token there and look no further back, so ids of pieces between sure breaks, put together, are exactly those of the
whole text. New chunks go through the library, or through a faster one of the same vocabulary, merges and pattern where
all their characters are of alphabets on which both agree.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.llm.shingles import _power_tables, mix, text_blocks

#: Bytes the rolling hash sees, and the mean size of a chunk as a power of two.
WINDOW, CHUNK_BITS = 16, 9
#: Ids in chunks that a worker remembers; it starts anew beyond.
IDS = 2 << 20

#: The pattern of byte-level pre-tokenisers, a fixed value of their format.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: UTF-8 with lead bytes up to that of U+04FF only: Latin, Greek, Cyrillic.
_SETTLED = re.compile(rb"[\x00-\x7F\x80-\xBF\xC2-\xD3]*")


def _byte_kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By byte value: may stand before a sure break as ASCII; after one; second or third byte from the end before one."""
    b = np.arange(256)
    plain = (b < 128) & (b > 32) & (b != 127)
    # Lead bytes of characters that are never white space: U+00C0-U+07FF, and U+4000 on.
    two, three = (b >= 0xC3) & (b <= 0xDF), (b >= 0xE4) & (b <= 0xEF)
    return plain, plain | two | three | ((b >= 0xF0) & (b <= 0xF4)), two, three


_BEFORE, _AFTER, _TWO, _THREE = _byte_kinds()


def sure_breaks(data: np.ndarray) -> np.ndarray:
    """Positions at which a token is sure to start, whatever stands around the characters beside them."""
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[(at > 2) & (at < len(data) - 1)]
    rest = (data[at - 1] & 0xC0) == 0x80
    before = _BEFORE[data[at - 1]] | rest & (_TWO[data[at - 2]] | _THREE[data[at - 3]] & ((data[at - 2] & 0xC0) == 0x80))
    at = at[before & _AFTER[data[at + 1]]]
    return np.concatenate([at, at[data[at] == 10] + 1])


def hash_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions where the hash of the ``WINDOW`` bytes before them, all of one text, has ``CHUNK_BITS`` leading zeros."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    rolled = mix((sums[WINDOW:] - sums[:-WINDOW]) * inverse[: n - WINDOW + 1])
    cuts = np.flatnonzero(rolled >> np.uint64(64 - CHUNK_BITS) == 0) + WINDOW
    return cuts[cuts - starts[np.searchsorted(starts, cuts, side="right") - 1] >= WINDOW]


def _fast_encoding(model: dict):
    """An encoding with the vocabulary and merges of a tokenizer file, or None if it isn't plain byte-level BPE."""
    import tiktoken

    before, bpe = model.get("pre_tokenizer") or {}, model["model"]
    if (model.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
            or not before.get("use_regex", True) or bpe.get("ignore_merges") or bpe.get("dropout")):
        return None
    byte = _byte_names()
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in bpe["merges"]]
    if [bpe["vocab"][m] for m in merged] != list(range(len(byte), len(byte) + len(merged))):
        return None  # merges are ranked by id there
    added = {t["content"] for t in model.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): i for token, i in bpe["vocab"].items() if token not in added}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_names() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Ids of many texts by one tokenizer (the JSON text of its file)."""

    def __init__(self, tokenizer_json: str):
        self.source = tokenizer_json
        self.special = [t["content"].encode() for t in json.loads(tokenizer_json).get("added_tokens", [])]
        self.fast = _fast_encoding(json.loads(tokenizer_json))
        self.chunks: dict[bytes, np.ndarray] = {}
        self.held = 0

    @functools.cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.source)
        found.no_truncation()
        found.no_padding()
        return found

    def _learn(self, chunk: bytes) -> np.ndarray:
        if self.fast and _SETTLED.fullmatch(chunk) and not any(t in chunk for t in self.special):
            return self.fast.encode_to_numpy(chunk.decode(), disallowed_special=())
        return np.array(self.library.encode(chunk.decode(), add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Ids (uint32) of each whole text (UTF-8); null counts as empty."""
        with np.errstate(over="ignore"):
            for block in text_blocks(texts):
                if self.held > IDS:
                    self.chunks.clear()
                    self.held = 0
                yield from self._block(block)

    def _block(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        lengths = np.array(list(map(len, texts)))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        whole = b"".join(texts)
        data = np.frombuffer(whole, np.uint8)
        edges = np.unique(np.concatenate([starts, ends]))
        mark = np.zeros(len(data) + 1, bool)
        mark[edges] = True
        mark[sure_breaks(data)] = True
        breaks = np.flatnonzero(mark)
        cuts = hash_cuts(data, edges)
        after = np.searchsorted(breaks, cuts, side="right")
        mark[:] = False
        mark[edges] = True
        mark[breaks[after - 1]] = True  # the piece across a cut is a unit, and so is what lies between two of them
        mark[breaks[np.minimum(after, len(breaks) - 1)]] = True
        bounds = np.flatnonzero(mark)
        places = bounds.tolist()
        units = [whole[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
        for u in units:
            if u not in self.chunks:
                self.chunks[u] = self._learn(u)
                self.held += len(self.chunks[u]) + 64
        found = [self.chunks[u] for u in units]
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        cut = np.concatenate([[0], np.cumsum(list(map(len, found)), dtype=np.int64)])
        of = np.searchsorted(bounds, np.concatenate([starts, ends]))
        for a, b in zip(of[: len(texts)].tolist(), of[len(texts) :].tolist(), strict=True):
            yield ids[cut[a] : cut[b]]


class Decoder:
    """Text of ids: the bytes of each token, put together and read as UTF-8, invalid bytes replaced."""

    def __init__(self, tokenizer_json: str):
        model = json.loads(tokenizer_json)
        byte = _byte_names()
        tokens = model["model"]["vocab"] | {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        table = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            table[i] = bytes(byte[c] for c in token)
        self.sizes = np.array(list(map(len, table)))
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[ids] - (ends - sizes), sizes)
        return self.data[at].tobytes().decode("utf-8", errors="replace")


@functools.lru_cache(1)
def encoder_of(tokenizer_json: str) -> ChunkEncoder:
    """The encoder of this worker process: what one task has learned serves the next."""
    return ChunkEncoder(tokenizer_json)


def read_tokenizer(docs: DataFrame, path: str):
    """The tokenizer file at ``path`` as a broadcast (a file of fixed size, whatever the input)."""
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode_and_decode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, ids_sha256 (ids as little-endian uint32), decoded_sha256 (UTF-8).

    ``tokenizer`` is the path of a byte-level BPE file. A null text counts as empty: no ids, digests of nothing. Rows that
    repeat give the same. An empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = read_tokenizer(docs, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = encoder_of(shared.value), Decoder(shared.value)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for ids in encoder.encode(batch.column(1).to_pylist()):
                counts.append(len(ids))
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decoder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                                              pa.array(decoded, pa.string())], ["key", "n", "ids", "decoded"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), f"key {kind}, n long, ids string, decoded string").toDF(
        key, "n_tokens", "ids_sha256", "decoded_sha256")
