"""Letters of whole texts as bytes, for hashed features computed with numpy over a block of documents."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa



def _numbers() -> str:
    """Characters that Python counts as word characters though their Unicode category is no letter: as ranges of a class."""
    found = [i for i in range(128, sys.maxunicode + 1) if chr(i).isalnum() and unicodedata.category(chr(i))[0] != "L"]
    starts = [i for i, x in enumerate(found) if i == 0 or x != found[i - 1] + 1]
    return "".join(f"{chr(found[a])}-{chr(found[b - 1])}" for a, b in zip(starts, [*starts[1:], len(found)], strict=True))


#: Runs of anything but letters (Unicode categories L*).
_OTHER = re.compile(rf"[\W\d_{_numbers()}]+")
BLOCK = 1 << 17


def letter_words(text: str | None) -> bytes:
    """Lower-case runs of letters, one space around each; empty if the text has no letter."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} ".encode() if words else b""


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, start of each document) of consecutive texts, a bounded number of bytes at a time."""
    held, size = [], 0
    for t in map(letter_words, texts):
        if held and size + len(t) > BLOCK:
            yield _joined(held)
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield _joined(held)


def _joined(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum([0, *map(len, held)])
    return np.frombuffer(b"".join(held), np.uint8), starts


def grams(data: np.ndarray, starts: np.ndarray, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte ``size``-grams that have a space at their ends only, and the document of each."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    inner = np.ones(n, bool)
    for k in range(size):
        part = data[k : k + n]
        code = code * np.uint64(257) + part
        if 0 < k < size - 1:
            inner &= part != 32
    code *= np.uint64(0x9E3779B97F4A7C15)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(inner)
    doc = np.searchsorted(starts, at, side="right") - 1
    whole = at + size <= starts[doc + 1]
    at, doc = at[whole], doc[whole]
    return (code[at] >> np.uint64(64 - (buckets - 1).bit_length())).astype(np.int64), doc


def list_views(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The numbers of each row of a list column, without copies."""
    out = []
    for chunk in column.chunks:
        values, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out
