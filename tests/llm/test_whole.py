"""What operators used to leave out, against plain Python."""

import random
from collections import Counter

import pytest

from areapanel.llm import jaccard_join
from areapanel.llm.shingles import shingle_sets


@pytest.mark.parametrize(("width", "percent", "leaf", "block"), [(3, 90, 64, 1024), (3, 80, 2, 7), (2, 60, 2, 1024)])
def test_jaccard_links(spark, odd, none, monkeypatch, width, percent, leaf, block):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", block)
    random.seed(7)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    bases = [[f"{chr(97 + b)}{random.randrange(40)}" for _ in range(50)] for b in range(2)]
    for i in range(160):  # a hot group of near copies, some of them equal, and a smaller one that shares a passage
        words = bases[i % 8 == 0] + bases[0][:9]
        for _ in range(i % 4):
            words[random.randrange(len(words))] = f"w{random.randrange(6)}"
        rows.append((100 + i, " ".join(words)))
    sets = [set(s.tolist()) for s in shingle_sets([(t or "").encode() for _, t in rows], width)]
    want = Counter()
    for i, a in enumerate(sets):
        n = sum(1 for j, b in enumerate(sets) if i != j and a & b and 100 * len(a & b) >= percent * len(a | b))
        want[rows[i][0], len(a), n] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.jaccard_join(docs, width=width, percent=percent, links=True).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in found) == want
    assert max(r.n_links for r in found) > 30
    assert jaccard_join.jaccard_join(none, links=True).count() == 0
