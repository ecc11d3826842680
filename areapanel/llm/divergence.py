"""Term divergence between the sources of a language, by row accumulation over a term-major index.

Every (language, source) group is a row of term probabilities, most of them the baseline of a term that the group lacks.
The index holds, term by term, the groups that have the term. A row scatters its terms through the index into one dense
accumulator over all its peers, as in Gustavson's sparse matrix product; no pair of postings is ever a row of a table. What
the accumulator adds up is the difference from two baselines, corrected where one or both sides have the term:

    sum |p - q| over all terms = terms * |z - w|                     both have their baselines z and w
                               + sum over the row's terms   of |p - w| - |z - w|
                               + sum over the peer's terms  of |z - q| - |z - w|
                               + sum over shared terms      of |p - q| - |p - w| - |z - q| + |z - w|

The index is cut into blocks of whole terms, so a language that holds most rows is spread over many tasks; blocks add up.
Everything is integer arithmetic; what passes through floating point stays below 2**53.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.session import write_scratch

#: Fixed values of the audit: parts that make up probability one, occurrences added to every term.
ONE, PRIOR = 1_000_000_000, 5
#: Distinct (group, term) entries a task counts before it hands them on; postings in a block of the index; accumulated sums
#: that a task holds before it hands them on.
ENTRIES, POSTINGS, SUMS = 100_000, 1 << 17, 1 << 20

#: ASCII letters in lower case and all bytes of other characters; everything else parts terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group of the task's rows; the empty term stands for the group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, source, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if (lang, source) not in held:
                    held[lang, source] = Counter({b"": 0}), Counter()
                occurs, docs = held[lang, source]
                size -= len(occurs)
                terms = text.translate(_TERMS).split()
                occurs.update(terms)
                docs.update(set(terms))
                size += len(occurs)
            if size > ENTRIES:
                yield from _entries(held)
                held, size = {}, 0
    yield from _entries(held)


def _entries(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (occurs, docs) in held.items():
        occurs[b""] = 0
        n = len(occurs)
        terms = list(occurs)
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(terms, pa.binary()).cast(
                pa.string()), pa.array(occurs.values(), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
            ["lang", "source", "term", "n", "d"])


def term_index(docs: DataFrame, least: int, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Term-major index: lang, term, total and postings (source, n) of the terms in at least ``least`` documents of their
    language; the empty term has every group of the language with n = 0. Nulls count as empty."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in (
        (lang, "lang"), (source, "source"))], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    counts = rows.mapInArrow(tidy(_count_terms), "lang string, source string, term string, n long, d long")
    by_group = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"))
    index = by_group.groupBy("lang", "term").agg(
        F.sum("d").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings"))
    return index.where((F.col("docs") >= least) | (F.col("term") == "")).drop("docs")


def _share(n: Column, all_terms: Column, terms: Column) -> Column:
    """1 + floor(ONE * (n + PRIOR) / (all_terms + PRIOR * terms)), exactly; null without terms."""
    wide = "decimal(38,0)"
    count = (n + PRIOR).cast("decimal(27,0)") * F.lit(ONE).cast("decimal(10,0)")
    return F.call_function("div", count.cast(wide), F.nullif(
        all_terms + PRIOR * terms, F.lit(0)).cast(wide)) + F.lit(1)


def _accumulate(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block of the index: for every row that has terms in it, what the block adds to its distance to each peer. The
    first block of a language also adds the distance of the baselines, for every row. Rows without a term are the peers."""
    table = pa.Table.from_batches(batches)
    named = table["term"].combine_chunks().dictionary_encode().indices
    group, share = table["g"].to_numpy(), table["p"].to_numpy()
    peers = np.flatnonzero(named.is_null())
    peers = peers[np.argsort(group[peers])]
    z, groups = share[peers], len(peers)
    lang, block, terms = key[0].as_py(), key[1].as_py(), table["terms"][peers[0]].as_py()

    kept = np.flatnonzero(named.is_valid())
    of = named.drop_null().to_numpy(zero_copy_only=False)
    by_term = np.argsort(of, kind="stable")
    at, group, p = of[by_term], group[kept][by_term], share[kept][by_term]
    sizes = np.bincount(at, minlength=1)
    starts = np.cumsum(sizes) - sizes
    by_row = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[by_row], np.arange(groups + 1))
    rows, sums = [], []
    for i in range(groups):
        mine = by_row[bounds[i] : bounds[i + 1]]
        if not len(mine) and block:
            continue
        apart = np.abs(z[i] - z)
        added = np.where(np.arange(groups) > i, terms * apart, 0) if block == 0 else np.zeros(groups, np.int64)
        if len(mine):
            low = np.sort(p[mine])
            upto = np.concatenate([[0], np.cumsum(low)])
            below = np.searchsorted(low, z)
            added += z * below - upto[below] + (upto[-1] - upto[below]) - z * (len(low) - below) - len(low) * apart
            lengths = sizes[at[mine]]
            ends = np.cumsum(lengths)
            posting = np.arange(ends[-1]) + np.repeat(starts[at[mine]] - (ends - lengths), lengths)
            own, q, peer = np.repeat(p[mine], lengths), p[posting], group[posting]
            shared = np.abs(own - q) - np.abs(own - z[peer]) - np.abs(z[i] - q) + np.abs(z[i] - z[peer])
            later = peer > i  # the two directions of a pair share this sum
            added += np.bincount(peer[later], shared[later], groups).astype(np.int64)
        rows.append(i)
        sums.append(added)
        if len(rows) * groups > SUMS:
            yield _dense(lang, rows, sums)
            rows, sums = [], []
    if rows:
        yield _dense(lang, rows, sums)


def _dense(lang: str, rows: list[int], sums: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, sums)])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sums), pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(rows, pa.int32()), lists],
                                      ["lang", "g", "sums"])


def source_divergence(docs: DataFrame, least: int = 30, top: int = 50, text: str = "text", lang: str = "lang",
                      source: str = "source") -> DataFrame:
    """Rows lang, source, part, item, value, rank for every occurring (lang, source) group.

    Part ``pair``: each other source of the language with the summed distance over the language's kept terms. Part
    ``term``: the ``top`` terms that the group has and favours most against its language. Ranks go by value descending, then
    item ascending by its bytes. Null text, lang or source count as empty strings. A language without kept terms gives
    pairs of value 0 and no terms; one with a single source gives no pairs. Rows that repeat count each. An empty table
    gives an empty result; other columns are not read, so clashing names do no harm.
    """
    index = write_scratch(term_index(docs, least, text, lang, source), "terms")
    langs = index.groupBy("lang").agg(F.count(F.when(F.col("term") != "", 1)).alias("terms"), F.sum("total").alias("all"),
                                      F.sum(F.size("postings").cast("long")).alias("entries"))
    entries = index.select("lang", "term", "total", F.inline("postings"))
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("mine")).join(langs, "lang")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = write_scratch(sums.select(
        "lang", "source", "mine", "terms", "all", number.alias("g"), F.coalesce(_share(F.lit(0), F.col("mine"), F.col(
            "terms")), F.lit(0)).alias("z"), F.ceil(F.col("entries") / POSTINGS).cast("int").alias("blocks")), "groups")
    shares = write_scratch(entries.where(F.col("term") != "").join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "g", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
        _share(F.col("n"), F.col("mine"), F.col("terms")).alias("p"),
        _share(F.col("total"), F.col("all"), F.col("terms")).alias("q")), "shares")

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (
        F.col("p") - F.col("q")).alias("value")).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    peers = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          F.lit(None).cast("string").alias("term"), "g", F.col("z").alias("p"), "terms")
    postings = shares.select("lang", "block", "term", "g", "p", F.lit(None).cast("long").alias("terms"))
    rows = postings.unionByName(peers).groupBy("lang", "block").applyInArrow(
        _accumulate, "lang string, g int, sums array<long>")
    pairs = rows.select("lang", "g", F.posexplode("sums").alias("peer", "value")).where("g != peer").groupBy(
        "lang", F.least("g", "peer").alias("g"), F.greatest("g", "peer").alias("peer")).agg(F.sum("value").alias("value"))
    both = pairs.select("lang", "value", F.inline(F.array(F.struct("g", "peer"), F.struct(
        F.col("peer").alias("g"), F.col("g").alias("peer")))))
    named = both.join(groups.select("lang", "g", "source"), ["lang", "g"]).join(
        groups.select("lang", F.col("g").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(ranked))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", F.col("value").cast("long"), "rank")
