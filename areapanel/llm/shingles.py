"""Word shingles of whole texts, hashed with numpy a batch of documents at a time.

A word is a run of bytes outside the ASCII white space ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z. A shingle is
``width`` consecutive words; a text with fewer words has its whole sequence as one shingle, and a text without words has
none. Shingles are 64-bit hashes, so equality of two shingles is equality of the hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: For bags of words: ASCII punctuation parts words as white space does.
PUNCTUATION = _SPACE.copy()
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Bytes hashed at once; documents longer than this are hashed alone.
BLOCK = 1 << 17

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each. A text is hashed whole: with its
    sums that takes about 50 bytes of memory a byte of text beyond ``BLOCK``, and the tables (16 bytes a byte) stay."""
    size = max(BLOCK, 1 << (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        steps = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        for s in steps:
            s[0] = 1
        _powers[size] = np.cumprod(steps[0]), np.cumprod(steps[1])
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes over the whole word (finaliser of a splitmix generator)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def _block_words(texts: list[bytes], space: np.ndarray = _SPACE) -> tuple[np.ndarray, list[int], list[int]]:
    """Hashes of the words of all texts in order, and where each text's words begin and end."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), [0] * len(texts), [0] * len(texts)
    low = _LOWER[data]
    word = ~space[data]
    ends_doc = np.cumsum(lengths)
    starts_doc = ends_doc - lengths
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    full = lengths > 0
    begins[starts_doc[full]] = word[starts_doc[full]]
    stops[ends_doc[full] - 1] = word[ends_doc[full] - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    hashes = mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
    return hashes, np.searchsorted(start, starts_doc).tolist(), np.searchsorted(start, ends_doc).tolist()


def _block_shingles(texts: list[bytes], width: int, classes: np.ndarray | None = None) -> Iterator:
    hashes, first, last = _block_words(texts)
    rolled = hashes.copy()
    for k in range(1, width):
        ahead = np.zeros_like(hashes)
        ahead[: max(0, len(hashes) - k)] = hashes[k:]
        rolled = mix(rolled * np.uint64(_BASE) + ahead)
    sums = None if classes is None else np.cumsum(np.concatenate([[0], classes[word_cells(hashes, len(classes))]]))
    for a, b in zip(first, last, strict=True):
        if b - a >= width:
            found = rolled[a : b - width + 1]
            if sums is None:
                yield np.unique(found)
            else:
                found, at = np.unique(found, return_index=True)
                yield found, sums[a + at + width] - sums[a + at]
        else:
            h = np.uint64([b - a] if b > a else [])
            for x in hashes[a:b]:
                h = mix(h * np.uint64(_BASE) + x)
            yield h if sums is None else (h, np.full(len(h), sums[b] - sums[a]))


def text_blocks(texts: list[bytes | None], most: int = BLOCK) -> Iterator[list[bytes]]:
    """Consecutive texts, at most ``most`` bytes or a single text at a time; a null text counts as empty."""
    block: list[bytes] = []
    size = 0
    for t in texts:
        t = t or b""
        if block and size + len(t) > most:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def shingle_sets(texts: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text, in order."""
    with np.errstate(over="ignore"):
        for block in text_blocks(texts):
            yield from _block_shingles(block, width)


def scored_sets(texts: list[bytes | None], width: int, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets of ``shingle_sets``, and for each shingle the sum of ``classes`` (by ``word_cells``) of its words."""
    with np.errstate(over="ignore"):
        for block in text_blocks(texts):
            yield from _block_shingles(block, width, classes)


def word_cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each word, of ``cells`` (a power of two)."""
    return (hashes & np.uint64(cells - 1)).astype(np.int64)


def words_by_cell(texts: list[bytes | None], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells that have words, and how many, some texts at a time."""
    with np.errstate(over="ignore"):
        for block in text_blocks(texts):
            yield np.unique(word_cells(_block_words(block)[0], cells), return_counts=True)


def word_counts(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashes of each text's words (white space and ASCII punctuation part them) and how often each occurs."""
    with np.errstate(over="ignore"):
        for block in text_blocks(texts):
            hashes, first, last = _block_words(block, PUNCTUATION)
            for a, b in zip(first, last, strict=True):
                yield np.unique(hashes[a:b], return_counts=True)
