"""Table sinks (K1-K4).

Tables are replaced whole, as in the reference, but written as parquet
partitioned by the year of their month column so that history queries prune
partitions. Write errors propagate (the reference swallowed them, X16).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import Gate, require_columns
from ..session import hadoop_path

YEAR_PARTITION = "date_year"
#: Partition column of tables clustered by area; the number of parts follows in its name.
AREA_PARTITION = "area_part_"
AREA_PARTS = 8


def area_part(code: Column, parts: int) -> Column:
    """The part of a clustered table that holds an area's rows."""
    return F.pmod(F.xxhash64(code), F.lit(parts)).cast("int")


def area_partition(columns: Iterable[str]) -> tuple[str, int] | None:
    """Name and number of parts of a clustered table's area partition column."""
    return next(((c, int(c.removeprefix(AREA_PARTITION))) for c in columns if c.startswith(AREA_PARTITION)), None)


def cluster_table(df: DataFrame, path: str, area_col: str, date_col: str = "date", parts: int = AREA_PARTS) -> str:
    """K1 for tables that are asked for by area: files are partitioned by year and by a hash of the area, rows inside them
    sorted by area and date, with a Parquet bloom filter on the area. A lookup of one area opens one part a year, and reads
    the row groups and pages with its code. Rows are ranged on all of these and a hash of the row, so a year or an area
    with many rows is spread over many tasks."""
    part = f"{AREA_PARTITION}{parts}"
    spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    order = [F.col(YEAR_PARTITION), F.col(part), F.col(f"`{area_col}`"), F.col(f"`{date_col}`")]
    rows = df.withColumns({YEAR_PARTITION: F.year(F.col(f"`{date_col}`")), part: area_part(F.col(f"`{area_col}`"), parts)})
    rows = rows.repartitionByRange(*order[:3], spread).sortWithinPartitions(*order)
    rows.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{area_col}", "true").partitionBy(
        YEAR_PARTITION, part).parquet(path)
    return path


def bucket_panel(df: DataFrame, name: str, path: str, key: str = "area_code", date_col: str = "date",
                 buckets: int | None = None) -> DataFrame:
    """A panel published as a table in buckets of its areas, each sorted by area and month. Panels with the same number of
    buckets (the session's shuffle partitions by default) join on area and month, and feed windows by area, without an
    exchange: see ``relational.join_bucketed``."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(buckets, F.col(f"`{key}`"))
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, date_col).option("path", path).saveAsTable(name)
    return spark.table(name)


def replace_table(df: DataFrame, path: str, date_col: str | None = "date", fmt: str = "parquet") -> str:
    """K1/K2: overwrite the table at ``path``. With ``date_col`` the files are
    partitioned by its year (column ``date_year``). Rows are first ranged on the year and
    a hash of the row: a task holds one or few years, so there are about as many files as
    tasks and years together, and a year with many rows is spread over many tasks."""
    writer_df = df
    if date_col and date_col in df.columns:
        spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
        writer_df = (df.withColumn(YEAR_PARTITION, F.year(F.col(date_col)))
                     .repartitionByRange(F.col(YEAR_PARTITION), spread))
        writer_df.write.mode("overwrite").partitionBy(YEAR_PARTITION).format(fmt).save(path)
    else:
        writer_df.write.mode("overwrite").format(fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", keep_year: bool = False) -> DataFrame:
    """Read a table written by ``replace_table`` or ``cluster_table``. The partition columns are dropped unless
    ``keep_year``; filters on them read only their files, and the history views set them for a bound date or area."""
    df = spark.read.format(fmt).load(path)
    return df if keep_year else drop_partitions(df)


def drop_partitions(df: DataFrame) -> DataFrame:
    """``df`` without the partition columns that tables are written with."""
    return df.drop(*[c for c in df.columns if c == YEAR_PARTITION or c.startswith(AREA_PARTITION)])


def gated_replace(df: DataFrame, path: str, required: Iterable[str], date_col: str | None = "date") -> str:
    """K3: refuse to write unless every required column exists, then replace."""
    require_columns(df, list(required))
    return replace_table(df, path, date_col)


def publish(df: DataFrame, path: str, gate: Gate, parts: int = 1) -> dict:
    """K3 with Q1-Q4: writes ``df`` beside ``path`` and gathers the gate's metrics in that same job; only a clean table then
    takes the place of the old one. A table that fails is removed, the error raised, and the old one stays as it is.

    The table is clustered by year and area like ``cluster_table``; each folder is one task's work, which suits panels (at
    most twelve rows an area and year). Returns the gate's report. Between the two renames at the end a reader can find no
    table; the old one is beside it until the new one is in place.
    """
    spark, token = df.sparkSession, uuid.uuid4().hex[:12]
    staged, old = f"{path.rstrip('/')}-staged-{token}", f"{path.rstrip('/')}-old-{token}"
    part, key, date = f"{AREA_PARTITION}{parts}", F.col(f"`{gate.key}`"), F.col(f"`{gate.date_col}`")
    rows = gate.attach(df).withColumns({YEAR_PARTITION: F.year(date), part: area_part(key, parts)})
    rows = rows.repartition(F.col(YEAR_PARTITION), F.col(part)).sortWithinPartitions(YEAR_PARTITION, part, key, date)
    (target, fs), (new, _), (past, _) = (hadoop_path(spark, p) for p in (path, staged, old))
    try:
        rows.write.option(f"parquet.bloom.filter.enabled#{gate.key}", "true").partitionBy(YEAR_PARTITION, part).parquet(staged)
        report = gate.verify()
    except Exception:
        fs.delete(new, True)
        raise
    if fs.exists(target) and not fs.rename(target, past):
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(new, target):
        fs.rename(past, target)
        raise OSError(f"{staged} can't take the place of {path}")
    fs.delete(past, True)
    return report


def boundary_features(vertices: DataFrame, key: str = "area_code", props: DataFrame | None = None) -> DataFrame:
    """K4: one GeoJSON ``Feature`` per area from a vertex table
    ``(key, part, ring, seq, x, y)``: rings ordered by ``seq``, polygons by ``ring``,
    parts by ``part`` → ``MultiPolygon``. Output ``(key, feature)`` with the feature
    as JSON text; ``props`` columns (joined on key) go to ``properties``.

    Grouping is per ring, then per part, then per area, so no step holds more than
    one area's outline.
    """
    require_columns(vertices, [key, "part", "ring", "seq", "x", "y"])
    rings = (vertices.groupBy(key, "part", "ring")
             .agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("pts"))
             .select(key, "part", "ring",
                     F.transform("pts", lambda p: F.array(p["x"], p["y"])).alias("coords")))
    # GeoJSON rings are closed: repeat the first position at the end when needed.
    closed = F.when(F.element_at("coords", 1) == F.element_at("coords", -1), F.col("coords")) \
        .otherwise(F.concat("coords", F.array(F.element_at("coords", 1))))
    polys = (rings.select(key, "part", "ring", closed.alias("coords"))
             .groupBy(key, "part")
             .agg(F.array_sort(F.collect_list(F.struct("ring", "coords"))).alias("rs"))
             .select(key, "part", F.transform("rs", lambda r: r["coords"]).alias("poly")))
    areas = (polys.groupBy(key)
             .agg(F.array_sort(F.collect_list(F.struct("part", "poly"))).alias("ps"))
             .select(key, F.transform("ps", lambda p: p["poly"]).alias("coordinates")))
    if props is not None:
        areas = areas.join(props, key, "left")
        prop_cols = [c for c in props.columns if c != key]
    else:
        prop_cols = []
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.col(key).alias("id"),
        F.struct(F.col(key).alias(key), *[F.col(c) for c in prop_cols]).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.col("coordinates")).alias("geometry"),
    )
    return areas.select(key, F.to_json(feature).alias("feature"))
