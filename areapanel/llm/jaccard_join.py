"""Exact Jaccard join of documents on word shingles, by pivots, regions and triangle-inequality windows.

Jaccard distance ``d`` is a metric on shingle sets. A function ``f`` with ``|f(x) - f(y)| <= d(x, y)`` works as a pivot:
documents within radius ``r`` of each other differ by at most ``r`` in ``f``, so a document only has to be copied to the
regions whose window of width ``r`` (or ``2 r`` between two nearest pivots) it lies in. Two kinds are used:

1. Shingle pivots split the whole table. Shingles get one global order, rare ones first. For a shingle ``s`` of ``x``,
   ``f_s(x)`` is the share of ``x`` that comes before ``s`` in that order. A document's own region is that of its first
   shingle (``f_s = 0``); its window reaches the other regions with ``f_s(x) <= r``. Two documents with
   ``d <= r`` meet in the region of their first common shingle, so no link is lost, whatever the order. The order only
   decides how full regions get; it is taken from a sample of documents. Shingles that recur there come last. A sample
   can't tell a shingle of one document from one of hundreds, but it tells how often words occur: all other shingles go
   by the sum of their words' classes, about the logarithm of how often they would meet by chance.
2. Document pivots work on regions that are still large. Links to a few member documents join members at once, and a
   region whose members are all joined is done. If the pairs not joined yet are at most ``DIRECT`` a member, they are
   compared. Else exact distances to the pivots give each member a nearest pivot (Voronoi region) and copy it to every
   other region with ``d(x, p) <= d(x, nearest) + 2 r``, and these regions are joined in the same way. Where the windows
   would copy a region almost whole (all members equally far from all pivots), its pairs are compared, cut by the windows
   of all its pivots.

Small regions are joined exactly. Candidates are checked against size, position and a folded bitmap (none can refute a
true link), and the survivors by the exact size of the intersection. Documents with equal sets are one class and are
compared once; components over classes come from ``components.connected_components``.

Components need few links of a group, its number of links needs them all: where asked for, members of the large regions
are dealt over blocks, and each pair of blocks is one group that counts its links in a matrix of exact intersections. A
pair that meets in several regions counts in the lowest one, so no list of pairs is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy
from areapanel.llm.components import connected_components
from areapanel.llm.shingles import scored_sets, shingle_sets, words_by_cell
from areapanel.session import drop_scratch, write_scratch

#: Documents, at least, and share of them whose shingles and words give the order of rarity; the number of sampled
#: documents that makes a shingle common; cells in which words are counted (a byte each is sent to the tasks).
ORDER_SAMPLE, ORDER_SHARE, COMMON, WORD_CELLS = 10_000, 1 / 64, 3, 1 << 20
#: Most shingles told apart as common in the order (8 bytes each are sent to the tasks).
ORDER_SIZE = 500_000
#: Members up to which a region is joined directly; pivots for a larger one; comparisons a member that need no split.
LEAF, PIVOTS, DIRECT = 64, 16, 1024
#: Bits of the filter that tells rows whose sets are needed.
FILTER_BITS = 1 << 23
#: Members and shingles of a block of a large region, about; columns of a matrix; share of full cells that makes a column
#: one of a matrix.
BLOCK_MEMBERS, BLOCK_SHINGLES, COLUMNS, DENSE = 1024, 1 << 19, 2048, 0.02


def _order(docs: DataFrame, key: str, text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a sample of documents: common shingles, the most frequent first (they come last in the global order), and the
    class of each cell of words by how often they occur (the sums over its words order all other shingles)."""
    total = docs.count()
    share = min(1.0, max(ORDER_SAMPLE / max(1, total), ORDER_SHARE))
    part = F.pmod(F.xxhash64(key, F.octet_length(text)), F.lit(1 << 20))
    sample = docs.where(part < round(share * (1 << 20))).select(F.col(text).cast("binary").alias("text"))

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            sets = list(shingle_sets(texts, width))
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            found = [(False, values.view(np.int64), counts), *((True, *x) for x in words_by_cell(texts, WORD_CELLS))]
            for word, item, n in found:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), word)), pa.array(item), pa.array(n)],
                                                 ["word", "item", "n"])

    found = sample.mapInArrow(tidy(items), "word boolean, item long, n long").groupBy("word", "item").agg(
        F.sum("n").alias("n"))
    found = write_scratch(found.where((F.col("n") >= COMMON) | F.col("word")), "order")
    common = found.where("not word").orderBy(F.desc("n"), "item").limit(ORDER_SIZE).select("item").toArrow()
    words = found.where("word").select(F.col("item").cast("int"), F.round(4 * F.log2(F.col("n") + 1)).cast("int").alias("c")).toArrow()
    drop_scratch(found)
    classes = np.zeros(WORD_CELLS, np.uint8)
    classes[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return common.column(0).to_numpy().view(np.uint64), classes


def _bitmap(s: np.ndarray) -> np.ndarray:
    """Parity of the set's shingles in two to four times as many buckets, 64 to a long: two sets differ in at least as
    many elements as their bitmaps differ in bits."""
    bits = max(64, 1 << max(0, 2 * len(s) - 1).bit_length())
    cells = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8), bitorder="little").view(np.int64)


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([np.zeros(0, np.int64), *(a.view(np.int64) for a in arrays)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _summaries(docs: DataFrame, key: str, text: str, width: int, percent: int, common: np.ndarray,
               classes: np.ndarray) -> DataFrame:
    """Per row: key, set size, 128-bit signature of the set, the first shingles in the global order, the bitmap."""
    by_value = np.argsort(common)
    values, ranks = common[by_value], (len(common) - by_value).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((values, ranks, classes))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, ranks, classes = shared.value
        for batch in batches:
            sizes, signatures, firsts, bitmaps = [], [], [], []
            for s, score in scored_sets(batch.column(1).to_pylist(), width, classes):
                n = len(s)
                sizes.append(n)
                signatures.append(_signature(s))
                reach = n - (percent * n + 99) // 100 + 1 if n else 0
                at = np.searchsorted(values, s)
                at[at == len(values)] = 0
                rank = np.where(values[at] == s, ranks[at], 0) if len(values) else np.zeros(n, np.int64)
                firsts.append(s[np.lexsort((s, score, rank))[:reach]].view(np.int64))
                bitmaps.append(_bitmap(s))
            first, bitmap = _lists(firsts), _lists(bitmaps)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), first, bitmap],
                ["key", "n", "signature", "first", "bitmap"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).mapInArrow(
        tidy(summarise), f"key {kind}, n long, signature binary, first array<long>, bitmap array<long>")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Size and position bound: the common shingle stands at ``pos`` in both, so at most this many are common."""
    common = (1 + F.least(f"{a}.pos", f"{b}.pos")
              + F.least(F.expr(f"{a}.n - {a}.pos - 1"), F.expr(f"{b}.n - {b}.pos - 1")))
    return common * (100 + percent) >= F.lit(percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _unrefuted(a: str, b: str, percent: int) -> Column:
    """Whether sizes and bitmaps of two sets allow a link: the bitmaps differ in no more bits than the sets may in
    elements. A longer bitmap is folded once; sizes further apart than that link at low ``percent`` only, unfiltered."""

    def fold(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))

    def apart(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, n: t + n)

    x, y = F.col(f"{a}.bitmap"), F.col(f"{b}.bitmap")
    differ = F.when(F.size(x) == F.size(y), apart(x, y)).when(F.size(x) == 2 * F.size(y), apart(fold(x), y)).when(
        2 * F.size(x) == F.size(y), apart(x, fold(y))).otherwise(0)
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the row of each."""
    one = pa.concat_arrays(lists.chunks)
    sizes = one.value_lengths().to_numpy()
    return one.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


def _common(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], rows: int, columns: int) -> np.ndarray:
    """Sizes of the intersections of ``rows`` sets with ``columns`` sets, both as of ``_flat``."""
    shared = np.intersect1d(x[0], y[0])
    sides = []
    for values, owner in (x, y):
        at = np.searchsorted(shared, values)
        held = shared[np.minimum(at, len(shared) - 1)] == values if len(shared) else np.zeros(len(values), bool)
        by = np.argsort(at[held], kind="stable")
        sides.append((at[held][by], owner[held][by]))
    (at, a), (bt, b) = sides
    n, m = np.bincount(at, minlength=len(shared)), np.bincount(bt, minlength=len(shared))
    out = np.zeros(rows * columns, np.int64)
    dense = n * m > DENSE * rows * columns
    place = np.cumsum(dense) - 1
    in_a, in_b = dense[at], dense[bt]
    for low in range(0, int(dense.sum()), COLUMNS):
        parts = []
        for t, owner, part, size in ((at, a, in_a, rows), (bt, b, in_b, columns)):
            p = place[t[part]]
            here = slice(*np.searchsorted(p, (low, low + COLUMNS)))
            parts.append(np.zeros((size, COLUMNS), np.float32))
            parts[-1][owner[part][here], p[here] - low] = 1
        out += (parts[0] @ parts[1].T).astype(np.int64).ravel()
    at, a, first = at[~in_a], a[~in_a], np.cumsum(m) - m
    ends = np.cumsum(m[at])
    low = 0
    while low < len(at):  # at least one entry, about a million pairs at a time
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (1 << 20))))
        times = m[at[low:high]]
        begins = np.cumsum(times) - times
        partner = np.arange(int(times.sum())) - np.repeat(begins - first[at[low:high]], times)
        out += np.bincount(np.repeat(a[low:high], times) * columns + b[partner], minlength=rows * columns)
        low = high
    return out.reshape(rows, columns)


def _links_of_blocks(found: pa.Table, percent: int) -> pa.Table:
    """Rows (cid, links): links of one pair of blocks of a region, weighted by the rows of the other class, without pairs
    that also meet in a lower region."""
    region, i, j = (found.column(c)[0].as_py() for c in ("region", "i", "j"))
    block = found.column("block").to_numpy()
    sides = [found.filter(pa.array(block == x)) for x in ((i,) if i == j else (i, j))]
    x, y = sides[0], sides[-1]
    if not len(x) or not len(y):
        return pa.table({"cid": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})

    def lower(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values, owner = _flat(side.column("held"))
        return values[values < region], owner[values < region]

    common = _common(_flat(x.column("s")), _flat(y.column("s")), len(x), len(y))
    both = x.column("n").to_numpy()[:, None] + y.column("n").to_numpy()[None, :] - common
    near = (common * 100 >= both * percent) & (_common(lower(x), lower(y), len(x), len(y)) == 0)
    if i == j:
        np.fill_diagonal(near, False)
    cids, links = [x.column("cid").to_numpy()], [near @ y.column("m").to_numpy()]
    if i != j:
        cids.append(y.column("cid").to_numpy())
        links.append(near.T @ x.column("m").to_numpy())
    cid, n = np.concatenate(cids), np.concatenate(links)
    return pa.table({"cid": cid[n > 0], "links": n[n > 0].astype(np.int64)})


class _Join:
    """One join over the class table: its members in regions, the sets that any comparison needs, and the links found."""

    def __init__(self, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int):
        self.classes, self.docs, self.key, self.text, self.width, self.percent = classes, docs, key, text, width, percent
        self.links: list[DataFrame] = []
        self.tables: list[DataFrame] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(write_scratch(df, name))
        return self.tables[-1]

    def members(self) -> DataFrame:
        """Rows (region, k, cid, n, pos): the regions of shingle pivots in which at least two classes meet."""
        rows = self.classes.select("cid", "n", F.posexplode("first").alias("pos", "region"))
        full = rows.groupBy("region").agg(F.count("*").alias("k")).where("k > 1")
        return self.write(rows.join(full, "region"), "members")

    def sets(self, cids: DataFrame) -> DataFrame:
        """Sets (cid, s) of the classes in ``cids``, from the whole text of one row of each.

        A filter of fixed size over the hashes of the wanted keys spares most other rows the work; rows that pass by
        chance, and other rows of a wanted key, fail the join on the signature."""
        wanted = self.write(self.classes.join(cids.distinct(), "cid").select(
            "cid", "signature", F.pmod(F.xxhash64("owner"), F.lit(FILTER_BITS)).alias("bit")), "wanted")
        words = wanted.groupBy(F.shiftright("bit", 3).alias("at")).agg(
            F.expr("bit_or(shiftleft(1, cast(bit % 8 AS int)))").alias("bits")).toArrow()
        filled = np.zeros(FILTER_BITS // 8, np.uint8)
        filled[words["at"].to_numpy()] = words["bits"].to_numpy().astype(np.uint8)
        docs, width = self.docs, self.width
        shared = docs.sparkSession.sparkContext.broadcast(filled)

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bit = batch.column(0).to_numpy()
                passed = (shared.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                found = list(shingle_sets(batch.column(1).filter(pa.array(passed)).to_pylist(), width))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signature(s) for s in found], pa.binary()), _lists(found)], ["signature", "s"])

        rows = docs.select(F.pmod(F.xxhash64(self.key), F.lit(FILTER_BITS)).alias("bit"),
                           F.col(self.text).cast("binary").alias("text"))
        found = rows.mapInArrow(tidy(hashed), "signature binary, s array<long>")
        return self.write(found.join(wanted.select("cid", "signature"), "signature").groupBy("signature").agg(
            F.first("cid").alias("cid"), F.first("s").alias("s")).select("cid", "s"), "sets")

    def unrefuted(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that their bitmaps do not rule out."""
        bits = self.classes.select("cid", "n", "bitmap")
        x, y = bits.alias("x"), bits.alias("y")
        return pairs.join(x, F.col("a") == F.col("x.cid")).join(
            y, (F.col("b") == F.col("y.cid")) & _unrefuted("x", "y", self.percent)).select("a", "b")

    def link(self, pairs: DataFrame) -> None:
        """Adds the pairs (a, b) that link to the links, by the exact sizes of intersection and union."""
        if pairs.isEmpty():
            return
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")))
        sized = pairs.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b").select(
            "a", "b", F.size(F.array_intersect("s_a", "s_b")).alias("common"), (F.size("s_a") + F.size("s_b")).alias("both"))
        near = F.col("common") * 100 >= (F.col("both") - F.col("common")) * self.percent
        self.links.append(self.write(sized.where(near).select(F.col("a").alias("u"), F.col("b").alias("v")), "links"))

    def roots(self) -> DataFrame:
        edges = self.classes.select(F.col("cid").alias("u"), F.col("cid").alias("v")).limit(0)
        for more in self.links:
            edges = edges.unionByName(more)
        return connected_components(edges)

    def still_open(self, regions: DataFrame) -> DataFrame:
        """``regions`` (region, cid, n, bitmap, home) with each member's ``root`` so far, the region's members ``k`` and
        ``cross``, its pairs that are not joined; without the regions that have none."""
        named = regions.join(self.roots().withColumnRenamed("node", "cid"), "cid", "left").withColumn(
            "root", F.coalesce("root", "cid"))
        counts = named.groupBy("region", "root").agg(F.count("*").alias("c")).groupBy("region").agg(
            F.sum("c").alias("k"), F.sum(F.col("c") * F.col("c")).alias("joined"))
        cross = ((F.col("k") * F.col("k") - F.col("joined")) / 2).alias("cross")
        return self.write(named.join(counts.select("region", "k", cross).where("cross > 0"), "region"), "regions")

    def pivots(self, regions: DataFrame, level: int) -> DataFrame:
        """Rows (region, pivots): up to ``PIVOTS`` members of each region, with cid, size and bitmap."""
        drawn = F.xxhash64(F.lit(level), "cid")
        few = regions.groupBy("region", F.pmod(drawn, F.lit(4 * PIVOTS)).alias("salt")).agg(
            F.min(F.struct(drawn.alias("h"), "cid", "n")).alias("m"))
        named = few.select("region", "m.*").join(self.classes.select("cid", "bitmap"), "cid")
        return named.groupBy("region").agg(F.slice(F.array_sort(F.collect_list(F.struct("h", "cid", "n", "bitmap"))),
                                                   1, PIVOTS).alias("pivots"))  # of 4 * PIVOTS rows

    def to_pivots(self, regions: DataFrame, pivots: DataFrame) -> DataFrame:
        """Pairs of members and pivots of their region that may link."""
        near = regions.join(pivots, "region").select(F.struct("cid", "n", "bitmap").alias("x"),
                                                     F.explode("pivots").alias("y"))
        return near.where((F.col("x.cid") != F.col("y.cid")) & _unrefuted("x", "y", self.percent)).select(
            F.col("y.cid").alias("a"), F.col("x.cid").alias("b")).distinct()

    def distances(self, regions: DataFrame, pivots: DataFrame) -> DataFrame:
        """``regions`` without the pivots, with ``near``: (pivot, exact distance) of each pivot of the region."""
        sets = self.sets(regions.select("cid"))
        held = pivots.select("region", F.explode("pivots.cid").alias("cid")).join(sets, "cid").groupBy("region").agg(
            F.sort_array(F.collect_list(F.struct(F.col("cid").alias("p"), "s"))).alias("held"))  # PIVOTS rows

        def distance(p: Column) -> Column:
            common = F.size(F.array_intersect(p["s"], F.col("s")))
            return F.struct(p["p"].alias("p"), (1.0 - common / (F.size(p["s"]) + F.size("s") - common)).alias("d"))

        here = regions.join(sets, "cid").join(held, "region")
        return self.write(here.where(~F.exists("held", lambda p: p["p"] == F.col("cid"))).withColumn(
            "near", F.transform("held", distance)).drop("held", "s"), "near")

    def voronoi(self, members: DataFrame) -> DataFrame:
        """Members copied to their nearest pivot's region (home) and to those whose window they lie in; ``shrunk`` says
        that the parts of a region hold at most half of its pairs."""
        window = 2 * (100 - self.percent) / 100 + 1e-9
        least = F.array_min(F.transform("near", lambda x: F.struct(x["d"], x["p"])))
        parts = members.withColumn("least", least).select("*", F.explode("near").alias("to")).where(
            F.col("to.d") <= F.col("least.d") + window).select(
            F.col("region").alias("parent"), F.xxhash64("region", "to.p").alias("region"), "cid", "n", "bitmap", "root",
            "near", F.col("k").alias("whole"), (F.col("to.p") == F.col("least.p")).alias("home"))
        sizes = parts.groupBy("parent", "region", "whole").agg(F.count("*").alias("k"))
        halves = sizes.groupBy("parent").agg(
            (F.sum(F.col("k") * F.col("k")) * 2 <= F.max(F.col("whole") * F.col("whole"))).alias("shrunk"))
        return self.write(parts.join(sizes.select("region", "k"), "region").join(halves, "parent"), "parts")

    def pairs(self, regions: DataFrame) -> DataFrame:
        """Pairs of a region's members that are not joined yet, at least one of them at home there, and that neither
        sizes nor bitmaps nor distances to pivots (where known) rule out."""
        if "near" not in regions.columns:
            regions = regions.withColumn("near", F.array().cast("array<struct<p:long,d:double>>"))
        a, b = regions.alias("a"), regions.alias("b")
        radius = (100 - self.percent) / 100 + 1e-9
        windows = F.forall(F.arrays_zip(F.col("a.near").alias("x"), F.col("b.near").alias("y")),
                           lambda z: F.abs(z["x"]["d"] - z["y"]["d"]) <= radius)
        return a.join(b, (F.col("a.region") == F.col("b.region")) & (F.col("a.cid") < F.col("b.cid"))
                      & (F.col("a.root") != F.col("b.root")) & (F.col("a.home") | F.col("b.home")) & windows
                      & _unrefuted("a", "b", self.percent)).select(
            F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()

    def counts(self) -> DataFrame:
        """After ``run``: rows (cid, links) of the classes that link with any other: the rows of those, each once."""
        held = self.large.groupBy("cid").agg(F.sort_array(F.collect_set("region")).alias("held"))
        here = self.classes.select("cid", "n", "m").join(held, "cid").join(self.sets(self.large.select("cid")), "cid")
        sizes = self.large.groupBy("region").agg(F.greatest(
            F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("blocks")).cast("int")
        dealt = self.large.select("region", "cid").join(sizes, "region").withColumn("block", block).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        percent = self.percent
        blocks = dealt.join(here, "cid").select(
            "region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "n", "m",
            "held", "s")
        hot = blocks.groupBy("region", "i", "j").applyInArrow(
            lambda found: _links_of_blocks(found, percent), "cid long, links long")

        # Links of small regions: those between classes that share no large one.
        pairs = self.classes.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0)
        for more in self.links:
            pairs = pairs.unionByName(more.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")))
        pairs = pairs.distinct().join(held.toDF("a", "held_a"), "a", "left").join(held.toDF("b", "held_b"), "b", "left").where(
            ~F.coalesce(F.arrays_overlap("held_a", "held_b"), F.lit(False))).select("a", "b")
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        cold = both.join(self.classes.select(F.col("cid").alias("b"), F.col("m").alias("links")), "b").select(
            F.col("a").alias("cid"), "links")
        return self.write(hot.unionByName(cold).groupBy("cid").agg(F.sum("links").alias("links")), "counts")

    def run(self) -> DataFrame:
        """Rows (node, root) of the classes that link with any other."""
        members = self.members()
        small, large = members.where(F.col("k") <= LEAF), members.where(F.col("k") > LEAF)
        a, b = small.alias("a"), small.alias("b")
        met = a.join(b, (F.col("a.region") == F.col("b.region")) & (F.col("a.cid") < F.col("b.cid"))
                     & _may_link("a", "b", self.percent)).select(
            F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()
        # Regions with the same lowest member overlap almost wholly: one region, with every member once.
        lead = large.groupBy("region").agg(F.min_by("cid", F.xxhash64("cid")).alias("lead"))
        merged = large.join(lead, "region").select(F.col("lead").alias("region"), "cid").distinct()
        regions = self.write(merged.join(self.classes.select("cid", "n", "bitmap"), "cid").withColumn(
            "home", F.lit(True)), "regions")
        self.large = regions
        found, level = self.unrefuted(met), 0
        while True:
            pivots = self.write(self.pivots(regions, level), "pivots")
            self.link(self.write(found.unionByName(self.to_pivots(regions, pivots)).distinct(), "pairs"))
            if regions.isEmpty():
                return self.roots()
            left = self.still_open(regions)
            few = F.col("cross") <= F.col("k") * DIRECT
            found, regions = self.pairs(left.where(few)), left.where(~few)
            if not regions.isEmpty():
                near = self.distances(regions, pivots)
                parts = self.voronoi(near)
                whole = parts.where(~F.col("shrunk")).select(F.col("parent").alias("region")).distinct()
                found = found.unionByName(self.pairs(near.join(whole, "region", "left_semi"))).unionByName(
                    self.pairs(parts.where(F.col("shrunk") & (F.col("k") <= LEAF))))
                regions = parts.where(F.col("shrunk") & (F.col("k") > LEAF)).select("region", "cid", "n", "bitmap", "home")
            regions, level = self.write(regions.select("region", "cid", "n", "bitmap", "home"), "regions"), level + 1


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3,
                 percent: int = 90, links: bool = False) -> DataFrame:
    """Components of documents whose ``width``-word shingle sets link: ``100 * common >= percent * union``.

    Returns one row per row of ``docs``: the key column, n_shingles (size of its set), component_id (smallest key that
    it reaches by links, its own included); with ``links`` also n_links (the other rows that it links with). Other columns
    of ``docs`` are not read, whatever their names.

    * Null and empty texts, and texts of white space only, have no shingles and link with nothing: their component is
      their own key. A text with fewer than ``width`` words has its whole word sequence as one shingle.
    * Rows with equal sets always link. Rows that repeat a key are rows of their own; each keeps its own size.
    * A null key is never the smallest one; a component of null keys only has a null component_id.
    * An empty table gives an empty result.
    """
    common, word_classes = _order(docs, key, text, width)
    all_rows = write_scratch(_summaries(docs, key, text, width, percent, common, word_classes), "rows")
    found = all_rows.where("n > 0").groupBy("signature").agg(
        F.min("key").alias("owner"), F.count("*").alias("m"), *(F.first(c).alias(c) for c in ("n", "first", "bitmap")))
    classes = write_scratch(found.withColumn("cid", F.monotonically_increasing_id()), "classes")
    rows = write_scratch(all_rows.select("key", "n", "signature"), "rows")
    drop_scratch(all_rows)
    join = _Join(classes, docs, key, text, width, percent)
    roots = join.run()
    lowest = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "root", F.coalesce("root", "cid"))
    if links:
        lowest = lowest.join(join.counts(), "cid", "left")
    n_links = [(F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links")] if links else []
    lowest = lowest.select("signature", "root", "owner", *n_links)
    least = lowest.groupBy("root").agg(F.min("owner").alias("component_id"))
    named = write_scratch(lowest.join(least, "root").drop("root", "owner"), "named")
    out = rows.join(named, "signature", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.when(F.col("n") == 0, F.col("key"))).alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if links else []))
    drop_scratch(*join.tables, classes)
    return out


def one_of_each(docs: DataFrame, components: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay when each component of ``jaccard_join`` keeps its smallest key.

    Rows with a null key stay, and so does every row of a key that heads a component.
    """
    heads = F.col(key) == F.col("component_id")
    keys = components.groupBy(F.col(key).alias("_key")).agg(F.max(heads.cast("int")).alias("_head"))
    gone = keys.where("_head = 0").select("_key")
    return docs.join(gone, docs[key] == gone["_key"], "left_anti")
