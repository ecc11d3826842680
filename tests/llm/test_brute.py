"""Operators without SQL on all of a small table, against plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest
import xxhash

from areapanel.llm import fingerprints, sharding

WORDS = re.compile(rb"[^\x00-\x20!-/:-@\[-`{-~]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").cache()


def uniform(key, shard):
    first = xxhash.xxh64_intdigest(str(key).encode(), 42)
    return ((xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), first) >> 11) + 0.5) / (1 << 53)


def test_sharding(spark, docs):
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = sharding.shard_documents(docs, shards=40).collect()
    slots = Counter()
    for r in got:
        body = (rows[r.doc_id] or "").encode()
        score = [-1 / math.log(uniform(r.doc_id, j)) for j in range(41)]
        best = max(range(40), key=lambda j: score[j])
        assert (r.size, r.text_crc32, r.shard) == (len(body) + 16, zlib.crc32(body), best)
        assert r.grown_shard == (40 if score[40] > score[best] else best)
        slots[r.shard, r.slot] += 1
    sizes = Counter(s for s, _ in slots)
    assert len(got) == len(rows) and set(slots) == {(s, i) for s, n in sizes.items() for i in range(n)}


def test_fingerprints_are_near_generalised_jaccard(spark, docs):
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    texts = dict(rows)
    bags = {k: Counter(WORDS.findall(t.encode().lower())) for k, t in rows}
    after = {a[0]: b for a, b in zip(rows, rows[1:] + rows[:1])}

    def jaccard(a, b):
        both = a.keys() | b.keys()
        return sum(min(a[w], b[w]) for w in both) / max(1, sum(max(a[w], b[w]) for w in both))

    off = []
    for r in fingerprints.fingerprint_documents(docs).collect():
        text, (key, following) = texts[r.doc_id], after[r.doc_id]
        changed = Counter(WORDS.findall(fingerprints.edited(text, following).encode().lower()))
        assert r.n_chars == len(text)
        off += [abs(r.near_edited - jaccard(bags[r.doc_id], changed)), abs(r.near_next - jaccard(bags[r.doc_id], bags[key]))]
    assert sum(off) / len(off) < 0.06 and max(off) < 0.4
