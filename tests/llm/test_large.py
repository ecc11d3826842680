"""Pairs that would grow faster than the input, seen on small tables."""

import random

import pytest

from areapanel.llm import jaccard_join


def invented(n, words, seed, few=12):
    """Texts, as lists of words, of ``few`` common words and many rare ones."""
    rng = random.Random(seed)
    common, rare = [f"w{i}" for i in range(few)], [f"x{i}" for i in range(100_000)]
    return [[rng.choice(common) if rng.random() < 0.8 else rng.choice(rare) for _ in range(words)] for _ in range(n)]


@pytest.mark.parametrize(("width", "percent", "few"), [(3, 90, 12), (5, 80, 5)])
def test_shingles_that_meet_by_chance_give_no_pairs(spark, monkeypatch, width, percent, few):
    monkeypatch.setattr(jaccard_join, "ORDER_SAMPLE", 150)  # a shingle of a few tens of documents is not seen to be common
    texts = invented(2000, 60, width, few)
    texts += [texts[0][:59] + ["end"], texts[1] + ["end"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    met, members = [], jaccard_join._Join.members

    def counted(self):
        found = members(self)
        met.append(found.where("k > 4").count())
        return found

    monkeypatch.setattr(jaccard_join._Join, "members", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_join(docs, width=width, percent=percent).collect()
    least = {r.doc_id: r.component_id for r in got}
    assert least[2000] == 0 and least[2001] == 1 and sum(k != v for k, v in least.items()) == 2
    assert met[0] < 100


def test_word_classes_order_by_what_is_rare(spark):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(invented(300, 40, 1))], "doc_id long, text string")
    _, classes = jaccard_join._order(docs, "doc_id", "text", 3)
    sets = list(jaccard_join.shingle_sets([b"w1 w2 w3", b"w1 never w3", b""], 3))
    found = list(jaccard_join.scored_sets([b"w1 w2 w3", b"w1 never w3", b""], 3, classes))
    assert [x.tolist() for x, _ in found] == [s.tolist() for s in sets]
    assert found[0][1][0] > found[1][1][0] and len(found[2][1]) == 0
