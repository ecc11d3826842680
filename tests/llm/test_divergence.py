"""Source divergence against plain Python with unbounded integers."""

import re
from collections import Counter

import pytest

from areapanel.llm import divergence

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def expected(rows, least, top):
    counts, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        counts.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        share = {}
        for s in [*sources, None]:
            c = {t: sum(counts[lang, x, t] for x in (sources if s is None else [s])) for t in kept}
            whole = sum(c.values()) + 5 * len(kept)
            share[s] = {t: 1 + 10**9 * (n + 5) // whole for t, n in c.items()}
        for s in sources:
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(share[s][t] - share[None][t], t) for t in kept if counts[lang, s, t] and share[s][t] > share[None][t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


ROWS = ([("en", f"s{i % 4}", f"The cat{'s' * (i % 3)} and É{i % 5} x9y don't THE naïve") for i in range(40)]
        + [("en", "s1", "the the the"), ("en", None, None), ("en", "lone", "!!! 12"), (None, "s0", "the cat"), (None, None, "the"),
           ("de", "only", "der der die"), ("en", "s2", "w " * 30_000 + "z" * 50_000), ("fr", "a", ""), ("fr", "b", None)])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, source string, text string, n int, term string, g int")


@pytest.mark.parametrize("least, top, postings", [(2, 50, 1 << 17), (1, 2, 3), (100, 50, 5)])
def test_divergence(spark, monkeypatch, least, top, postings):
    monkeypatch.setattr(divergence, "POSTINGS", postings)  # few postings a block: sums over many blocks
    monkeypatch.setattr(divergence, "ENTRIES", 10)
    monkeypatch.setattr(divergence, "SUMS", 3)
    got = divergence.source_divergence(frame(spark, ROWS).repartition(4), least, top)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected(ROWS, least, top)


def test_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, whole = 10**12 + 7, 3 * 10**13 + 1
    got = spark.createDataFrame([(n, whole, 11)], "n long, w long, v long").select(divergence._share(
        F.col("n"), F.col("w"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (whole + 55)


def test_empty(spark, none):
    assert divergence.source_divergence(none).count() == 0
