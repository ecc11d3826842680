"""Quality rules with risk-controlled cutoffs, with DataFrame functions only.

Each rule rejects a document whose measure reaches a cutoff. Which cutoffs may be used is decided on labelled documents,
stratum by stratum: with ``n`` good documents of which a cutoff rejects ``k``, it is certified if so few rejections would
have a binomial probability of at most the allowed error, were the true share of good documents rejected ``ALPHA`` divided
by the number of rules. The error ``DELTA`` is shared among all rules and strata (Bonferroni); the cutoffs of a rule are
tested from the most lenient to the strictest and testing ends at the first failure, which needs no further share. So with
probability 1 - DELTA no stratum loses more than ALPHA of its good documents to the rules. Among certified cutoffs each rule
takes the one with the largest share of bad documents less the share of good ones, the most lenient of equals; without a
gain, or without a certified cutoff, the rule rejects nothing in that stratum. Bounds are one-sided and exact.

Documents that fail the base limits (fewer than ``MIN_WORDS`` words, or more than half the words in repeated windows) go
first; the labelled holdout is what the base limits keep.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areapanel.llm import unused
from areapanel.session import write_scratch

#: Share of a stratum's good documents that all rules together may reject; probability that a guarantee fails.
ALPHA, DELTA = 0.05, 0.05
#: Base limits: least number of words, largest share of words in repeated windows (percent).
MIN_WORDS, MAX_REPEATED = 50, 50
#: Characters that word measures split at, and those counted as symbols.
_SPACE, _SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``measure`` of a row of ``measures`` rejects from one of ``cutoffs`` (ascending: lenient ones last) upwards."""

    name: str
    measure: Callable[[], Column]
    cutoffs: tuple[float, ...]


def _per(part: str, whole: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


RULES = (
    Rule("symbols", _per("n_symbols", "word_chars"), (0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2)),
    Rule("upper_case", _per("n_upper", "word_chars"), (0.05, 0.08, 0.12, 0.2, 0.3, 0.5)),
    Rule("duplicate_lines", _per("n_dup_lines", "n_lines"), (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6)),
    Rule("repeated_words", _per("n_repeat_words", "n_words"), (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4)),
    Rule("long_words", _per("word_chars", "n_words"), (5.5, 6.0, 6.5, 7.0, 8.0, 10.0, 15.0)),
    Rule("short_words", lambda: -_per("word_chars", "n_words")(), (-4.5, -4.0, -3.5, -3.0, -2.5)),
    Rule("few_words", lambda: -F.col("n_words").cast("double"), (-200.0, -150.0, -100.0, -80.0, -60.0)),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(words: Column) -> Column:
    """Hashes of all windows of three words, in order."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _covered(words: Column, hashes: Column) -> Column:
    """Words in windows that occur twice or more. Windows sort by hash, then by their words, so equal ones are neighbours
    whatever the hash does; the places of all that have an equal neighbour are then laid over the words."""
    rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(
        h.alias("h"), F.get(words, i).alias("x"), F.get(words, i + 1).alias("y"), F.get(words, i + 2).alias("z"),
        i.alias("i"))))

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (a["x"] == b["x"]) & (a["y"] == b["y"]) & (a["z"] == b["z"]), F.lit(False))

    def places(s: Column) -> Column:
        both = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(equal(a, b), F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))

    def laid(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(
            F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda t, x: t + x)

    return _let(rows, lambda s: _let(places(s), laid))


def _word_measures(words: Column) -> Column:
    n = F.size(words)
    repeated = _let(_windows(words), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), _covered(words, h)).otherwise(F.lit(0).cast("long")))
    return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                    repeated.alias("n_repeat_words"))


def _line_measures(lines: Column) -> Column:
    n = F.size(lines)
    return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text`` and with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word),
    n_upper (upper-case letters) of its whole text; a null text counts as empty. Columns of those names are replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = _let(F.filter(F.split(t, _SPACE), lambda w: w != ""), _word_measures)
    lines = _let(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), _line_measures)
    new = {"n_symbols": F.regexp_count(t, F.lit(_SYMBOLS)).cast("long"), "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast(
        "long")}
    w, x = unused(df, "words"), unused(df, "lines")
    out = df.withColumns(new | {w: words, x: lines})
    parts = {n: F.col(f"`{w}`.{n}") for n in ("n_words", "word_chars", "n_repeat_words")} | {
        n: F.col(f"`{x}`.{n}") for n in ("n_lines", "n_dup_lines")}
    return out.withColumns(parts).drop(w, x, text)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def tail(k: Column, n: Column, share: float) -> Column:
    """P(X <= k) of a binomial X of ``n`` trials with probability ``share``; 1 where k is above its mean (the exact value
    is of no use to a test there). Terms follow from one another by logarithms."""
    step = math.log(share) - math.log1p(-share)
    start = F.struct((n * math.log1p(-share)).alias("log"), F.exp(n * math.log1p(-share)).alias("sum"))

    def add(state: Column, i: Column) -> Column:
        log = state["log"] + F.log((n - i + 1) / i) + step
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"))

    terms = F.filter(F.sequence(F.lit(0).cast("long"), k.cast("long")), lambda i: i > 0)
    return F.when(k > n * share, F.lit(1.0)).otherwise(F.aggregate(terms, start, add, lambda s: F.least(s["sum"], F.lit(1.0))))


def certify(labelled: DataFrame, rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every cutoff of every rule in every stratum: stratum, rule, cutoff, good, bad (documents), good_rejected,
    bad_rejected, p (the binomial probability), certified, chosen.

    ``labelled`` has stratum, good (boolean) and the measures. A rule whose cutoffs have no good documents gets none.
    """
    levels = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.size(F.filter(F.array(*map(F.lit, r.cutoffs)), _reached(
        r.measure()))).alias("level")) for r in rules])
    met = labelled.select("stratum", "good", F.inline(levels)).groupBy("stratum", "rule", "level").agg(
        F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad"))
    grid = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.transform(F.array(*map(F.lit, r.cutoffs)), lambda c, i: F.struct(
        (i + 1).alias("level"), c.alias("cutoff"))))])
    # A cutoff rejects every document whose level is at least its own.
    counts = met.groupBy("stratum", "rule").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"),
        F.collect_list(F.struct("level", F.col("good").alias("g"), F.col("bad").alias("b"))).alias("met"))
    each = counts.select("stratum", "rule", "good", "bad", "met", F.inline(F.element_at(grid, F.col("rule"))))

    def rejected(what: str) -> Column:
        return F.aggregate("met", F.lit(0).cast("long"), lambda t, m: t + F.when(
            m["level"] >= F.col("level"), m[what]).otherwise(0))

    tried = each.select("stratum", "rule", "level", "cutoff", "good", "bad", rejected("g").alias("good_rejected"),
                        rejected("b").alias("bad_rejected"))
    p = tail(F.col("good_rejected"), F.col("good"), alpha / len(rules))
    tested = tried.withColumns({"p": p, "strata": F.count("*").over(Window.partitionBy("rule", "level"))})
    lenient = Window.partitionBy("stratum", "rule").orderBy(F.desc("level"))
    passed = F.min(F.col("p") <= delta / (len(rules) * F.col("strata"))).over(lenient)
    gain = F.coalesce(F.try_divide("bad_rejected", "bad"), F.lit(0.0)) - F.try_divide("good_rejected", "good")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("certified"), F.desc("gain"), F.desc("level"))
    return tested.withColumns({"certified": passed, "gain": gain}).withColumn("chosen", (
        F.col("certified") & (F.col("gain") > 0) & (F.row_number().over(best) == 1))).drop("strata", "level", "gain")


def _reached(value: Column) -> Callable[[Column], Column]:
    return lambda cutoff: value >= cutoff


def quality_verdicts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
                     label: str = "quality", rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA,
                     delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    failed_rules (comma-joined names in their order; empty if none).

    ``labels`` has ``key`` and ``label`` (1 good, 0 bad); a key labelled both ways is bad, null labels and keys are
    ignored. A null text counts as empty and fails the base limits. A null stratum is a stratum of its own. Without labels,
    in a stratum without certified cutoffs and in one that has no labels only the base limits reject. Rows that repeat get
    the same verdict. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text"))
    found = write_scratch(measures(rows).withColumn("base_failed", base_failed()), "quality")
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg((F.min(label) == 1).alias("good"))
    cutoffs = certify(found.where(~F.col("base_failed")).join(known, "key"), rules, alpha, delta).where("chosen")
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    judged = found.join(by_stratum.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left")
    failed = F.concat_ws(",", *[F.when(r.measure() >= F.element_at("limits", r.name), F.lit(r.name)) for r in rules])
    return judged.withColumn("failed_rules", F.when(F.col("base_failed"), F.lit("")).otherwise(failed)).select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules")
