"""Column gates and data-quality checks.

Every check is ``DataFrame -> violations DataFrame`` so it runs distributed and
can be written out, counted, or enforced. ``enforce`` raises on the first
check with violations, like the reference's run-time test functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PipelineCheckError(Exception):
    """A data check failed; ``violations`` holds a few offending rows."""

    def __init__(self, check: str, message: str, violations: list | None = None):
        super().__init__(f"{check}: {message}")
        self.check = check
        self.violations = violations or []


def _as_list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def missing_columns(df: DataFrame, cols: str | Iterable[str]) -> list[str]:
    """Names (exact, case-sensitive) that are not columns of ``df``."""
    have = set(df.columns)
    return [c for c in _as_list(cols) if c not in have]


def require_columns(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Raise ``ValueError`` when any named column is missing; else return ``df``.

    Checked on the driver from the schema (no job). Spark resolves names without
    case, so the check is exact on purpose (N9, N10).
    """
    missing = missing_columns(df, cols)
    if missing:
        raise ValueError(f"the table lacks these columns: {missing}")
    return df


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def check_columns(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Q1: one row per expected column that is absent: ``(column)``."""
    missing = missing_columns(df, cols)
    return _spark(df).createDataFrame([(c,) for c in missing], "column string")


def column_report(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Q1 + Q2 as one table: ``(column, present, null_count)`` for each expected
    column; null counts for all present columns come from one aggregate pass."""
    cols = _as_list(cols)
    have = [c for c in cols if c in set(df.columns)]
    rows = [F.struct(F.lit(c).alias("column"), F.lit(True).alias("present"),
                     F.count_if(F.col(f"`{c}`").isNull()).cast("bigint").alias("null_count")) for c in have]
    missing = [F.struct(F.lit(c).alias("column"), F.lit(False).alias("present"),
                        F.lit(None).cast("bigint").alias("null_count")) for c in cols if c not in have]
    return df.agg(F.array(*rows, *missing).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def check_nulls(df: DataFrame, cols: str | Iterable[str] | None = None) -> DataFrame:
    """Q2: ``(column, null_count)`` for each named column with nulls, in one pass."""
    cols = df.columns if cols is None else _as_list(cols)
    require_columns(df, cols)
    if not cols:
        return _spark(df).createDataFrame([], "column string, null_count bigint")
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("bigint").alias("null_count"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return stacked.where(F.col("null_count") > 0)


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Q3: ``(column, problem)`` rows: missing column, wrong type, or nulls in a
    non-nullable field (one pass for all null counts)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append((f.name, "missing"))
        elif have[f.name] != f.dataType:
            problems.append((f.name, f"type {have[f.name].simpleString()} != {f.dataType.simpleString()}"))
    static = _spark(df).createDataFrame(problems, "column string, problem string")
    not_null = [f.name for f in schema.fields if not f.nullable and f.name in have]
    if not not_null:
        return static
    nulls = check_nulls(df, not_null).select(
        "column", F.concat(F.lit("nulls: "), F.col("null_count").cast("string")).alias("problem"))
    return static.unionByName(nulls)


def check_month_series(df: DataFrame, key: str, date_col: str = "date", start: str | None = None,
                       end: str | None = None) -> DataFrame:
    """Per key, rows ordered by date must be start, start+1 month, ...

    Returns the first break per key: ``(key, expected, found, position)``. With
    ``start`` every key must begin there; without it each key's first month is its
    start. With ``end`` a key whose last month differs is reported too.
    """
    require_columns(df, [key, date_col])
    w = Window.partitionBy(key).orderBy(date_col)
    first = F.lit(start).cast("date") if start else F.first(date_col).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rn = F.row_number().over(w)
    marked = (df.select(key, F.col(date_col).cast("date").alias("found"), rn.alias("position"),
                        first.alias("_start"))
              .withColumn("expected", F.add_months("_start", F.col("position") - 1)))
    breaks = (marked.where(~F.col("found").eqNullSafe(F.col("expected")))
              .groupBy(key).agg(F.min_by(F.struct("expected", "found", "position"), "position").alias("b"))
              .select(key, "b.expected", "b.found", "b.position"))
    if end is None:
        return breaks
    last = (df.groupBy(key).agg(F.max(F.col(date_col).cast("date")).alias("found"),
                                (F.count(F.lit(1)) + 1).cast("int").alias("position"))
            .where(F.col("found") != F.lit(end).cast("date"))
            .select(key, F.lit(end).cast("date").alias("expected"), "found", "position"))
    return breaks.unionByName(last.join(breaks.select(key), key, "left_anti"))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Duplicate key combinations with their multiplicity."""
    require_columns(df, keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def enforce(df: DataFrame, checks: dict[str, Callable[[DataFrame], DataFrame]], sample: int = 5) -> DataFrame:
    """Run each check; raise ``PipelineCheckError`` with a few offending rows on failure."""
    for name, check in checks.items():
        rows = check(df).take(sample)
        if rows:
            raise PipelineCheckError(name, f"{len(rows)}+ violations, e.g. {rows[0]}", rows)
    return df


class Gate:
    """Q1-Q4 for a panel, found out by the job that writes it.

    ``attach`` compares the schema (no job) and returns the frame with metrics on it: rows, nulls of every non-nullable
    column, months out of line, repeated months, areas of a single row. They are gathered while any one action runs over
    the whole frame, such as a write; ``verify`` then raises, or leaves them in ``report``. A series must be its first month
    (``start``, if given), the month after, and so on. Areas with a single row are no series: they are counted, not faulted.
    """

    def __init__(self, schema: T.StructType, key: str, date_col: str = "date", start: str | None = None):
        self.schema, self.key, self.date_col, self.start = schema, key, date_col, start
        self.report: dict = {}
        self._seen: Observation | None = None

    def attach(self, df: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in df.schema.fields}
        for f in self.schema.fields:
            if have.get(f.name) != f.dataType:
                found = have[f.name].simpleString() if f.name in have else "no column"
                raise PipelineCheckError("schema", f"{f.name}: {found} instead of {f.dataType.simpleString()}")
        date = F.col(f"`{self.date_col}`").cast("date")
        area = Window.partitionBy(F.col(f"`{self.key}`"))
        w = area.orderBy(date)
        first = F.lit(self.start).cast("date") if self.start else F.first(date).over(w)
        alone = F.count(F.lit(1)).over(area) == 1
        out = ~date.eqNullSafe(F.add_months(first, F.row_number().over(w) - 1)) & ~alone
        marked = df.withColumns({"_gate_out": out, "_gate_again": F.coalesce(F.lag(date).over(w) == date, F.lit(False)),
                                 "_gate_alone": alone})
        self._not_null = [f.name for f in self.schema.fields if not f.nullable]
        self._seen = Observation()
        first_out = F.min(F.when(F.col("_gate_out"), F.struct(F.col(f"`{self.key}`").cast("string").alias("k"), date.alias("d"))))
        seen = marked.observe(
            self._seen, F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(self._not_null)],
            F.count_if("_gate_out").alias("out_of_line"), F.count_if("_gate_again").alias("repeated"),
            F.count_if("_gate_alone").alias("single"), first_out["k"].alias("out_key"), first_out["d"].alias("out_date"))
        return seen.drop("_gate_out", "_gate_again", "_gate_alone")

    def verify(self) -> dict:
        """The metrics of the action that ran; raises ``PipelineCheckError`` if they show a fault."""
        got = self._seen.get
        self.report = {"rows": got["rows"], "single": got["single"], "out_of_line": got["out_of_line"], "repeated": got["repeated"],
                       "nulls": {c: got[f"null_{i}"] for i, c in enumerate(self._not_null) if got[f"null_{i}"]}}
        if self.report["nulls"]:
            raise PipelineCheckError("nulls", str(self.report["nulls"]))
        if got["repeated"]:
            raise PipelineCheckError("unique", f"{got['repeated']} months repeated")
        if got["out_of_line"]:
            raise PipelineCheckError("timeseries", f"{got['out_of_line']} months out of line, first {got['out_key']} {got['out_date']}")
        return self.report
