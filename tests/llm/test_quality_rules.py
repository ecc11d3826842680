"""Quality measures against plain Python; cutoffs against exact binomial sums."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from areapanel.llm import quality_rules as Q


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered))


def test_measures(spark, odd, none):
    random.seed(3)
    parts = ["a", "b", "c", "É#", "x|y", " ", "\n", "  ", "\t", "\x0b", "😀", "A"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 80)))) for i in range(400)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.quality_verdicts(spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string"), labels)
    for r in got.collect():
        want = measured(rows[r.doc_id][1])
        assert tuple(r)[1:6] == want, rows[r.doc_id]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    whole = Q.quality_verdicts(odd, labels).collect()
    assert Counter((r[0], *tuple(r)[1:6]) for r in whole) == Counter((r.doc_id, *measured(r.text)) for r in odd.collect())
    assert Q.quality_verdicts(none, labels).count() == 0


@pytest.mark.parametrize("n, share", [(0, 0.01), (5, 0.3), (400, 0.007), (3000, 0.01)])
def test_tail(spark, n, share):
    rows = [(k, n) for k in {0, 1, n // 100, n // 200, int(n * share), n} if k <= n]
    got = spark.createDataFrame(rows, "k long, n long").select("k", Q.tail(F.col("k"), F.col("n"), share).alias("p")).collect()
    p = Fraction(share)
    for r in got:
        want = 1.0 if r.k > n * share else float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(r.k + 1)))
        assert r.p == pytest.approx(want, rel=1e-9)


def plain_choice(rows, rules, alpha, delta):
    """The cutoffs by the docstring's words: rows of (stratum, good, {rule: value})."""
    strata = {s for s, _, _ in rows}
    chosen = {}
    for s in strata:
        for rule, cutoffs in rules.items():
            good = [v[rule] for x, g, v in rows if x == s and g]
            bad = [v[rule] for x, g, v in rows if x == s and not g]
            best = None
            for c in sorted(cutoffs, reverse=True):
                k, share = sum(v >= c for v in good), Fraction(alpha / len(rules))
                p = sum(comb(len(good), i) * share**i * (1 - share) ** (len(good) - i) for i in range(k + 1))
                if k > len(good) * share or p > delta / (len(rules) * len(strata)):
                    break
                gain = Fraction(sum(v >= c for v in bad), max(len(bad), 1)) - Fraction(k, max(len(good), 1))
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, c
            if best:
                chosen[s, rule] = best[1]
    return chosen


def test_certified_cutoffs(spark):
    random.seed(11)
    rules = (Q.Rule("x", lambda: F.col("x"), (1.0, 2.0, 3.0, 4.0)), Q.Rule("y", lambda: -F.col("y"), (-3.0, -2.0, -1.0)))
    rows = []
    for stratum, n in (("en", 900), ("de", 500), (None, 60)):
        for _ in range(n):
            good = random.random() < 0.7
            rows.append((stratum, good, {"x": random.choice([0.0, 0.5, 1.0] if good else [0.0, 2.0, 3.5]),
                                         "y": random.choice([2.5, 4.0, 5.0] if good and random.random() < 0.99 else [0.5, 2.0, 5.0])}))
    df = spark.createDataFrame([(s, g, v["x"], v["y"]) for s, g, v in rows], "stratum string, good boolean, x double, y double")
    found = Q.certify(df, rules, 0.1, 0.05).collect()
    got = {(r.stratum, r.rule): r.cutoff for r in found if r.chosen}
    plain = plain_choice([(s, g, {"x": v["x"], "y": -v["y"]}) for s, g, v in rows], {r.name: r.cutoffs for r in rules}, 0.1, 0.05)
    assert got == plain and got
    assert Counter((r.stratum, r.rule) for r in found if r.chosen).most_common(1)[0][1] == 1


def test_verdicts_follow_the_cutoffs(spark):
    good = [(i, " ".join(f"word{i}x{j}" for j in range(60)), "en", 1) for i in range(2000)]
    bad = [(5000 + i, " ".join(f"w{i}{j}###" for j in range(60)), "en", 0) for i in range(300)]
    rare = [(9000, " ".join(f"q{j}###" for j in range(60)), "xx", None)]
    rows = good + bad + rare
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in rows] + [(0, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = defaultdict(Counter)
    for r in Q.quality_verdicts(docs, labels).collect():
        got["good" if r.doc_id < 5000 else "bad" if r.doc_id < 9000 else "rare"][r.kept, r.failed_rules] += 1
    assert got["good"] == {(True, ""): 2000}
    assert sum(n for (kept, _), n in got["bad"].items() if not kept) == 300 and all("symbols" in k[1] for k in got["bad"])
    assert got["rare"] == {(True, ""): 1}  # no labels in its stratum
