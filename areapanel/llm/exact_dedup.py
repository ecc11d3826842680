"""Exact duplicates by Patricia tries: partitions by length and content hash hold whole byte strings in radix tries whose
terminal nodes own the smallest key of their text.

Each task first drops its own repeats (so a text that a third of all rows share reaches its partition once per task and
block of rows), then distinct texts are dealt by byte length and hash, and every partition inserts them into one trie.
Only full equality of the bytes makes two texts the same. A trie over its budget spills its largest subtree to an
anonymous temporary file and goes on; the file is read back as a trie of its own, with the same budget.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy, unused

#: Bytes of edge labels a trie holds before it spills a subtree; bytes of texts a task remembers to drop its repeats.
TRIE_BYTES, SEEN_BYTES = 64 << 20, 16 << 20

_SPACES = b" \t\n\r\x0b\x0c"


def normalise(text: bytes | None) -> bytes:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    if not text:
        return b""
    words = b" ".join(text.split())
    if not words:
        return b" "
    return (b" " if text[0] in _SPACES else b"") + words + (b" " if text[-1] in _SPACES else b"")


def lower(a, b):
    """The smaller of two keys; null is the largest."""
    return b if a is None else a if b is None else min(a, b)


class _Node:
    __slots__ = ("label", "children", "owner", "file")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.file = label, {}, None, None


class Trie:
    """Compressed radix trie from byte strings to owners ``[smallest key, copies, tag]``."""

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.held = _Node(b""), budget, 0

    def insert(self, text: bytes, key, copies: int, tag) -> None:
        node, at = self.root, 0
        while node.file is None and at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = _Node(text[at:])
                self.held += len(text) - at
            elif not text.startswith(child.label, at):
                child = self._cut(node, child, text, at)
            node, at = child, at + len(child.label)
        if node.file is not None:
            pickle.dump((text[at:], key, copies, tag), node.file, pickle.HIGHEST_PROTOCOL)
        elif node.owner is None:
            node.owner = [key, copies, tag]
        else:
            node.owner[0] = lower(node.owner[0], key)
            node.owner[1] += copies
        if self.held > self.budget:
            self._spill()

    def _cut(self, parent: _Node, child: _Node, text: bytes, at: int) -> _Node:
        """Split the edge to ``child`` where ``text`` leaves it."""
        size = min(len(child.label), len(text) - at)
        a = np.frombuffer(child.label, np.uint8, size)
        b = np.frombuffer(text, np.uint8, size, at)
        apart = np.flatnonzero(a != b)
        size = int(apart[0]) if len(apart) else size
        fork = _Node(child.label[:size])
        child.label = child.label[size:]
        fork.children[child.label[0]] = child
        parent.children[fork.label[0]] = fork
        return fork

    @staticmethod
    def _walk(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, _Node]]:
        todo = [(prefix, node)]
        while todo:
            before, node = todo.pop()
            yield before, node
            todo.extend((before + x.label, x) for x in node.children.values())

    def _weight(self, node: _Node) -> int:
        return sum(len(x.label) for _, x in self._walk(node, b""))

    def _spill(self) -> None:
        node = self.root
        while len(node.children) == 1 and node.file is None:
            node = next(iter(node.children.values()))
        if node.children:
            node = max(node.children.values(), key=self._weight)
        file, freed = tempfile.TemporaryFile(), self._weight(node) - len(node.label)
        for rest, x in list(self._walk(node, b"")):
            if x.owner is not None:
                pickle.dump((rest, *x.owner), file, pickle.HIGHEST_PROTOCOL)
            if x.file is not None:
                for more, *owner in self._read(x.file):
                    pickle.dump((rest + more, *owner), file, pickle.HIGHEST_PROTOCOL)
        node.children, node.owner, node.file = {}, None, file
        self.held -= freed
        if freed == 0:  # one edge over the budget by itself: nothing below it can go
            self.budget = max(self.budget, 2 * self.held)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                file.close()
                return

    def owners(self) -> Iterator[list]:
        """All ``[smallest key, copies, tag]``; empties the trie."""
        files = []
        for _, node in self._walk(self.root, b""):
            if node.owner is not None:
                yield node.owner
            if node.file is not None:
                files.append(node.file)
        self.root = _Node(b"")
        for file in files:
            below = Trie(self.budget)
            for record in self._read(file):
                below.insert(*record)
            yield from below.owners()


def _owners(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (text_sha256, n_bytes, keep_id, group_size), one per distinct normalised text."""
    kind = docs.schema[key].dataType.simpleString()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}
        held = 0

        def out() -> pa.RecordBatch:
            texts = list(seen)
            return pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in seen.values()], key_type), pa.array([v[1] for v in seen.values()], pa.int64()),
                 pa.array(list(map(len, texts)), pa.int64()), pa.array(texts, pa.binary())],
                ["key", "copies", "n_bytes", "text"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                t = normalise(t)
                known = seen.get(t)
                if known is None:
                    seen[t] = [k, 1]
                    held += len(t) + 64
                    if held > SEEN_BYTES:
                        yield out()
                        seen.clear()
                        held = 0
                else:
                    known[0] = lower(known[0], k)
                    known[1] += 1
        if seen:
            yield out()

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, key_type = Trie(), None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, copies, n, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                trie.insert(t, k, copies, (hashlib.sha256(t).hexdigest(), n))
        block = []
        for owner in trie.owners():
            block.append(owner)
            if len(block) == 10_000:
                yield rows(block, key_type)
                block = []
        if block:
            yield rows(block, key_type)

    def rows(block: list, key_type) -> pa.RecordBatch:
        keys, copies, tags = zip(*block, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([t[0] for t in tags]), pa.array([t[1] for t in tags], pa.int64()), pa.array(keys, key_type),
             pa.array(copies, pa.int64())], ["text_sha256", "n_bytes", "keep_id", "group_size"])

    body = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    distinct = body.mapInArrow(tidy(own), f"key {kind}, copies long, n_bytes long, text binary")
    dealt = distinct.repartition("n_bytes", F.xxhash64("text"))
    return dealt.mapInArrow(tidy(insert), f"text_sha256 string, n_bytes long, keep_id {kind}, group_size long")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, keep_id (smallest key of the equal texts), group_size, kept, text_sha256.

    Texts are equal when they are the same bytes once each run of ``[\\x20\\x09-\\x0D]`` is one space; null counts as
    empty. ``kept`` says that the row has its group's smallest key; rows that repeat key and text are kept alike (see
    ``keep_first`` for one row). A null key is the largest: a group of null keys only has a null keep_id and keeps all its
    rows. Other columns are not read. An empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(map(normalise, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], ["key", "text_sha256", "n_bytes"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).mapInArrow(
        tidy(digest), f"key {kind}, text_sha256 string, n_bytes long")
    found = rows.join(_owners(docs, key, text), ["text_sha256", "n_bytes"])
    return found.select(F.col("key").alias(key), "keep_id", "group_size",
                        F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: one with the smallest key.

    Equal is what ``exact_groups`` calls equal; null and empty texts are one group. Of rows that repeat the smallest key, or
    of a group with null keys only, any one stays. All columns stay as they are; an empty table stays empty.
    """
    digest, name = unused(docs, "_sha256"), unused(docs, "_name")
    owners = _owners(docs, key, text).select(
        F.col("text_sha256").alias(digest), F.coalesce(F.col("keep_id").cast("string"), F.lit("")).alias(name))
    spaces = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    named = docs.withColumns({digest: F.sha2(spaces.cast("binary"), 256),
                              name: F.coalesce(F.col(key).cast("string"), F.lit(""))})
    return named.join(owners, [digest, name]).dropDuplicates([digest, name]).select(*docs.columns)
