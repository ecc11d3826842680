"""Stand-ins that map the driver's test tables onto the area-panel data model.

* area  = nation; its code is ``'S' || lpad(nationkey, 8, '0')`` (Scottish-style codes)
* crime-style rows = orders joined to their customer's nation
* panel = orders per customer nation and month: ``(area_code, date, count, value)``
* second panel = lineitem per supplier nation and ship month: ``(area_code, date, qty, gross)``
* names = nation names, ``(area_code, area_name)``

Every stand-in is a lazy DataFrame over the whole tables, so its work grows
with the data. The same definitions are written in SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table as a DataFrame. File listing and footer reads are done once
    per session and path (the tables are read-only); the DataFrame stays lazy."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over the shuffle partitions: a file read by one task holds few bytes but gives many vertices."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def area_code(nationkey: Column | str) -> Column:
    nationkey = F.col(nationkey) if isinstance(nationkey, str) else nationkey
    return F.concat(F.lit("S"), F.lpad(nationkey.cast("string"), 8, "0"))


def month_of(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(ts.cast("date"), "MM")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer's nation (the "crime row" stand-in)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).drop("c_custkey")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer nation and month: ``(area_code, date, count, value)``."""
    return (order_rows(spark, sf_dir)
            .groupBy(area_code("c_nationkey").alias("area_code"), month_of("o_orderdate").alias("date"))
            .agg(F.count(F.lit(1)).alias("count"), F.round(F.sum("o_totalprice"), 2).alias("value")))


def supply_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem per supplier nation and ship month: ``(area_code, date, qty, gross)``."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                                                 "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(sup, li.l_suppkey == sup.s_suppkey)
            .groupBy(area_code("s_nationkey").alias("area_code"), month_of("l_shipdate").alias("date"))
            .agg(F.round(F.sum("l_quantity"), 2).alias("qty"),
                 F.round(F.sum("l_extendedprice"), 2).alias("gross")))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(area_code("n_nationkey").alias("area_code"),
                                                 F.col("n_name").alias("area_name"))


def anchors(panel_df: DataFrame, value_col: str) -> DataFrame:
    """First and last month of each area with their values (census-style anchors), in one pass over the panel."""
    row = F.struct("date", F.col(value_col))
    ends = panel_df.groupBy("area_code").agg(F.min_by(row, "date").alias("first"), F.max_by(row, "date").alias("last"))
    both = F.array_distinct(F.array("first", "last"))
    return ends.select("area_code", F.explode(both).alias("r")).select("area_code", "r.*")


def squares(df: DataFrame, key: str, width: float, code_prefix: str, cols: int = 10, step: float = 1.0,
            code: Column | None = None) -> DataFrame:
    """Axis-aligned square per key as a vertex table (counter-clockwise outer ring):
    lower-left corner at ``((k % cols) * step, (k // cols) * step)``; the area code is
    ``code_prefix || k`` unless ``code`` is given."""
    k = F.col(key).cast("long")
    code = code if code is not None else F.concat(F.lit(code_prefix), k.cast("string"))
    x0 = (k % cols).cast("double") * step
    y0 = F.floor(k / cols).cast("double") * step
    corners = F.array(
        F.struct(F.lit(0).alias("seq"), x0.alias("x"), y0.alias("y")),
        F.struct(F.lit(1).alias("seq"), (x0 + width).alias("x"), y0.alias("y")),
        F.struct(F.lit(2).alias("seq"), (x0 + width).alias("x"), (y0 + width).alias("y")),
        F.struct(F.lit(3).alias("seq"), x0.alias("x"), (y0 + width).alias("y")),
    )
    return (df.select(code.alias("area_code"), F.explode(corners).alias("v"))
            .select("area_code", F.lit(0).alias("part"), F.lit(0).alias("ring"), "v.seq", "v.x", "v.y"))


def supplier_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source layer ("old boundaries"): unit squares on a 10-wide grid, code ``P<suppkey>``."""
    return squares(table(spark, sf_dir, "supplier"), "s_suppkey", 1.0, "P", cols=10, step=1.0)


def nation_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target layer ("new boundaries"): 2.5-wide squares on a 4-wide grid, nation area codes."""
    return squares(table(spark, sf_dir, "nation"), "n_nationkey", 2.5, "", cols=4, step=2.5,
                   code=area_code("n_nationkey"))


def nation_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target layer of the overlap queries: one rectangle per nation, 5 by 5, that together cover every supplier square.
    They are 2.04 wide, and as tall as a fifth of the supplier grid, so the layer grows with the source layer."""
    rows = table(spark, sf_dir, "supplier").agg(F.floor(F.max("s_suppkey") / 10).alias("r")).scalar()
    h = (rows + 1.5) / 5
    k = F.col("n_nationkey").cast("long")
    x0, y0 = (k % 5).cast("double") * 2.04, F.floor(k / 5).cast("double") * F.col("h")
    x1, y1 = (k % 5 + 1).cast("double") * 2.04, (F.floor(k / 5) + 1).cast("double") * F.col("h")
    corners = F.array(*[F.struct(F.lit(i).alias("seq"), x.alias("x"), y.alias("y"))
                        for i, (x, y) in enumerate([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])])
    return (table(spark, sf_dir, "nation").withColumn("h", h)
            .select(area_code("n_nationkey").alias("area_code"), F.explode(corners).alias("v"))
            .select("area_code", F.lit(0).alias("part"), F.lit(0).alias("ring"), "v.seq", "v.x", "v.y"))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concave pentagon per part (a rectangle with a V-notch in its top edge):
    ``w = 1 + p_size / 50``, ``h = 1 + (p_retailprice % 100) / 100``, area ``0.65 w h``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("long")
    x0 = (k % 50).cast("double")
    y0 = F.floor(k / 50).cast("double")
    w = 1 + F.col("p_size") / 50.0
    h = 1 + (F.col("p_retailprice") % 100) / 100.0
    pts = [(x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0 + 0.5 * w, y0 + 0.3 * h), (x0, y0 + h)]
    arr = F.array(*[F.struct(F.lit(i).alias("seq"), x.alias("x"), y.alias("y")) for i, (x, y) in enumerate(pts)])
    return (p.select(F.concat(F.lit("Q"), k.cast("string")).alias("area_code"), F.explode(arr).alias("v"))
            .select("area_code", F.lit(0).alias("part"), F.lit(0).alias("ring"), "v.seq", "v.x", "v.y"))


def jagged_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell of a 50-wide grid per part, with borders of eight edges that both neighbours trace alike, each from its own
    corner and in its own direction. A border bulges by 0.2 to either side, or not at all, and every vertex on it is off by
    up to 0.002; all of it follows from the border's place."""
    k = F.col("p_partkey").cast("long")
    part = dealt(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")
    cells = part.select(F.concat(F.lit("Q"), k.cast("string")).alias("area_code"),
                        (k % 50).alias("c"), F.floor(k / 50).alias("r"))

    def side(first: int, across: int, dc: int, dr: int, back: bool) -> Column:
        """Vertices ``first ..`` of the border at (c + dc, r + dr), without its last one in ring order."""
        steps = [8 - s if back else s for s in range(8)]
        return F.array(*[F.struct(F.lit(first + i).alias("seq"), F.lit(across).alias("across"), (F.col("c") + dc).alias("i"),
                                  (F.col("r") + dr).alias("j"), F.lit(s).alias("s")) for i, s in enumerate(steps)])

    ring = F.concat(side(0, 0, 0, 0, False), side(8, 1, 1, 0, False), side(16, 0, 0, 1, True), side(24, 1, 0, 0, True))
    v = cells.select("area_code", F.inline(ring))
    t = F.col("s") / 8.0
    bulge = ((F.col("i") * 7 + F.col("j") * 13 + F.col("across")) % 3 - 1) * 0.2
    off = ((F.col("i") * 31 + F.col("j") * 17 + F.col("s") * 11) % 5 - 2) * 0.001
    d = F.when(F.col("s").isin(0, 8), 0.0).otherwise(bulge * (1 - F.abs(2 * t - 1)) + off)
    flat = F.col("across") == 0
    return v.select("area_code", F.lit(0).alias("part"), F.lit(0).alias("ring"), "seq",
                    F.when(flat, F.col("i") + t).otherwise(F.col("i") + d).alias("x"),
                    F.when(flat, F.col("j") + d).otherwise(F.col("j") + t).alias("y"))
