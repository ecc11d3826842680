"""File sources.

* ``read_trimmed_csv`` (A1): CSV files with preamble and trailer lines, of any size:
  files are read by block, and lines numbered from per-block counts.
* ``read_csv`` (A2): plain headered CSV with an explicit schema.
* ``pick_sheet`` (A3): a workbook held as a table with a sheet-name column.
* ``read_many`` (A4): one read over many files, keyed by a part of the path.
* ``read_raw_rows`` + ``promote_header`` (B9): header found by content.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null
from ..operators.columns import q
from ..session import write_scratch


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files with their place: ``(_file, _row, _n, _line)``, ``_row`` from 0 and ``_n`` the lines of the file
    without empty ones at its end. Lines end with a line feed; a carriage return before it is dropped.

    Files are read by block, so a large file is many tasks. Row ids count up inside a partition, and a block's lines follow
    one another there; so a first pass needs one row a block (its first id and number of lines) for a line's number to be its
    id less the first one, plus the lines of earlier blocks. No line is shuffled or sorted.
    """
    row_id = F.monotonically_increasing_id()
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), row_id.alias("_id"),
        F.regexp_replace("value", "\r$", "").alias("_line")).withColumn("_part", F.shiftright("_id", 33))
    blocks = raw.groupBy("_file", "_block", "_part").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_lines"), F.max(F.when(F.col("_line") != "", F.col("_id"))).alias("_last"))
    order = Window.partitionBy("_file").orderBy("_block")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("_lines").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_base", before).withColumn(
        "_n", F.coalesce(F.max(F.col("_base") + F.col("_last") - F.col("_first") + 1).over(whole), F.lit(0)))
    blocks = write_scratch(blocks.drop("_lines", "_last"), "line-blocks")
    placed = raw.join(blocks, ["_file", "_block", "_part"], "left")
    # Both passes cut files alike; were they ever not to, that must not lose lines.
    first = F.coalesce("_first", F.raise_error(F.lit("the files changed while they were read")).cast("long"))
    return placed.select("_file", (F.col("_id") - first + F.col("_base")).alias("_row"), "_n", "_line")


def _parse_header(line: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep))


def read_trimmed_csv(spark: SparkSession, paths: str | Sequence[str], skiprows: int = 0, skipfooter: int = 0,
                     schema: Mapping[str, str] | None = None, sep: str = ",", keep_file: bool = False
                     ) -> DataFrame:
    """A1: skip ``skiprows`` leading and ``skipfooter`` trailing lines of every
    file; the next non-blank line is the header; blank lines are skipped.

    Columns are strings unless ``schema`` (name → SQL type) casts them (ANSI:
    bad text raises, like ``pd.read_csv`` with a dtype). Files with different
    headers are stacked by name, in one pass over all files. The distinct header
    lines are collected: they are the result's columns.
    """
    lines = numbered_lines(spark, paths).where(
        (F.col("_row") >= skiprows) & (F.col("_row") < F.col("_n") - skipfooter) & (F.trim("_line") != ""))
    tops = write_scratch(lines.groupBy("_file").agg(F.min_by("_line", "_row").alias("_header"), F.min("_row").alias("_top")), "headers")
    headers = {r["_header"]: _parse_header(r["_header"], sep) for r in tops.select("_header").distinct().orderBy("_header").collect()}
    if not headers:
        raise ValueError(f"no header line found in {paths!r}")
    ddl = ", ".join(f"`_c{i}` STRING" for i in range(max(map(len, headers.values()))))
    rows = lines.join(tops, "_file").where(F.col("_row") > F.col("_top")).select(
        "_file", "_header", F.from_csv("_line", ddl, {"sep": sep, "mode": "PERMISSIVE"}).alias("_r"))

    def value(name: str) -> Column:
        """The cell under ``name``, by the header of the row's file; null where that has no such column."""
        at = {h: names.index(name) for h, names in headers.items() if name in names}
        if len(at) == len(headers) and len(set(at.values())) == 1:
            return F.col("_r").getField(f"_c{min(at.values())}")
        return F.coalesce(*[F.when(F.col("_header") == h, F.col("_r").getField(f"_c{i}")) for h, i in at.items()])

    order = list(dict.fromkeys(n for names in headers.values() for n in names))
    out = rows.select(*(["_file"] if keep_file else []), *[value(n).alias(n) for n in order])
    return _apply_schema(out, schema)


def _apply_schema(df: DataFrame, schema: Mapping[str, str] | None) -> DataFrame:
    if not schema:
        return df
    return without_nan(df.withColumns({c: q(c).cast(t) for c, t in schema.items() if c in df.columns}))


def without_nan(df: DataFrame) -> DataFrame:
    """The rule at every source: a floating NaN is NULL, so only one kind of missing value exists."""
    floats = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")]
    return df.withColumns({c: nan_to_null(q(c)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None, sep: str = ",",
             header: bool = True) -> DataFrame:
    """A2: headered CSV. Pass a DDL schema on large inputs to avoid an inference pass."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "FAILFAST")
    if schema:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return without_nan(reader.csv(paths))


def pick_sheet(df: DataFrame, sheet: str, sheet_col: str = "sheet", drop_sheet_col: bool = True) -> DataFrame:
    """A3: the rows of one sheet; ``KeyError`` naming the sheets present when absent.

    The presence test is a ``limit(1)`` job; the list of sheets is computed only
    on the error path.
    """
    picked = df.where(q(sheet_col) == F.lit(sheet))
    if picked.limit(1).count() == 0:
        sheets = sorted(r[0] for r in df.select(sheet_col).distinct().collect())
        raise KeyError(f"no sheet {sheet!r}; the sheets are {sheets}")
    return picked.drop(sheet_col) if drop_sheet_col else picked


def read_many(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", key_pattern: str | None = None,
              key_col: str = "source_key", schema: str | None = None, options: Mapping[str, str] | None = None
              ) -> DataFrame:
    """A4: one read over all files below ``path``; ``key_col`` is the first group of
    ``key_pattern`` matched against each file's path (the whole path without a pattern).
    Every file is cleaned by the same plan instead of a per-file loop."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    file_path = F.col("_metadata.file_path")
    key = F.regexp_extract(file_path, key_pattern, 1) if key_pattern else file_path
    return without_nan(df.select(key.alias(key_col), "*"))


def read_raw_rows(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", n_cols: int | None = None
                  ) -> DataFrame:
    """Row-indexed raw cells of text tables: ``(_file, _row, _c0 … _c{n-1})`` (all strings).

    ``_row`` is the 0-based line number in its file, so positional rules (header
    search) become explicit order. ``n_cols`` defaults to the widest line (one
    small aggregate job).
    """
    lines = numbered_lines(spark, paths).where(F.col("_row") < F.col("_n")).drop("_n")
    if n_cols is None:
        n_cols = lines.agg(F.max(F.size(F.split("_line", sep)))).first()[0] or 1
    ddl = ", ".join(f"`_c{i}` STRING" for i in range(n_cols))
    parsed = lines.select("_file", "_row", F.from_csv("_line", ddl, {"sep": sep}).alias("_r"))
    return parsed.select("_file", "_row", *[F.col("_r").getField(f"_c{i}").alias(f"_c{i}") for i in range(n_cols)])


def promote_header(df: DataFrame, regex: str, row_col: str = "_row", file_col: str = "_file") -> DataFrame:
    """In each file the first row (by ``row_col``) with any cell matching ``regex`` is the
    header; it and the rows above it are dropped. Files must agree on the header, and one
    without it, among others that have it, is an error. No match at all leaves ``df`` unchanged.

    Two small jobs over one row a file: how many files have a header, and the distinct headers.
    """
    cells = [c for c in df.columns if c not in (row_col, file_col)]
    files = [file_col] if file_col in df.columns else []
    hit = reduce(lambda a, b: a | b, [F.coalesce(q(c).rlike(regex), F.lit(False)) for c in cells])
    tops = df.groupBy(*files).agg(F.min_by(F.struct(row_col, *[q(c) for c in cells]), F.when(hit, F.col(row_col))).alias("_top"))
    headers = tops.select(F.struct(*[F.col("_top").getField(c).alias(c) for c in cells]).alias("h"),
                          F.col("_top").isNotNull().alias("found")).distinct().limit(3).collect()
    if not any(r["found"] for r in headers):
        return df
    if len(headers) > 1:
        raise ValueError(f"the files do not share one header: {[tuple(r['h']) if r['found'] else None for r in headers]}")
    names = [headers[0]["h"][c] if headers[0]["h"][c] is not None else c for c in cells]
    starts = tops.select(*files, F.col("_top").getField(row_col).alias("_start"))
    body = df.join(starts, files) if files else df.crossJoin(starts)
    return body.where(F.col(row_col) > F.col("_start")).select(*[q(c).alias(n) for c, n in zip(cells, names)])
