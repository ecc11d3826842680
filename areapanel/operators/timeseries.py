"""Monthly panels: densification, linear fill, resampling, lags and rolling
means (E4, F1-F3, G1-G3, G6).

All steps work per area with ``Window.partitionBy(key)``. They run on panels
(one row per area and month), so a window partition holds at most the number of
months in the calendar span (a few hundred rows), however large the raw input
was: the raw-to-panel step is a grouped aggregate with map-side partial sums.
Row generation uses ``explode(sequence(...))`` fused into the same stage as the
window that found the neighbouring anchor, so a densify costs one exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import months_elapsed
from .checks import require_columns
from .columns import q
from .relational import range_stretches


def _as_list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _w(key: str | Sequence[str], order: str) -> Window:
    return Window.partitionBy(*[q(k) for k in _as_list(key)]).orderBy(q(order))


def _step_date(anchor: Column, i: Column) -> Column:
    """Month ``i`` after an anchor: the anchor itself for ``i = 0``, otherwise the
    first day of the i-th following month (a mid-month anchor steps to the next
    first of month)."""
    return F.when(i == 0, anchor.cast("date")).otherwise(F.add_months(F.trunc(anchor.cast("date"), "MM"), i))


def expand_months(df: DataFrame, key: str, date_col: str = "date") -> DataFrame:
    """G1: between consecutive rows of a key, add one row per month with only the
    key and date filled. Gaps of 0 or 1 month add nothing; a key with one row
    keeps it (the reference needs exactly two rows; with two it is equal)."""
    require_columns(df, [key, date_col])
    others = [c for c in df.columns if c not in (key, date_col)]
    w = _w(key, date_col)
    nxt = F.lead(q(date_col)).over(w)
    n = F.coalesce(months_elapsed(nxt, q(date_col)), F.lit(1))
    base = df.select("*", n.alias("_n"))
    steps = base.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0)))).alias("_i"))
    i = F.col("_i")
    return steps.select(
        q(key),
        _step_date(q(date_col), i).alias(date_col),
        *[F.when(i == 0, q(c)).alias(c) for c in others],
    ).select(*[q(c) for c in df.columns])


def densify_linear(df: DataFrame, key: str, date_col: str, value_cols: str | Sequence[str],
                   carry_cols: Sequence[str] | None = None) -> DataFrame:
    """Monthly rows between consecutive anchors of each key with values on the
    straight line between them (position i of n: ``v + (v1 - v) * i / n``).

    Fused form of G1 followed by F3: one window finds the next anchor, one
    ``explode`` makes the months. ``carry_cols`` are copied from the earlier
    anchor (other columns are NULL on generated rows, as in G1). A NULL anchor
    value on either side gives NULL in between except that a NULL next value
    holds the earlier one, like the positional fill.
    """
    value_cols = _as_list(value_cols)
    carry_cols = list(carry_cols or [])
    require_columns(df, [key, date_col, *value_cols, *carry_cols])
    others = [c for c in df.columns if c not in (key, date_col, *value_cols, *carry_cols)]
    w = _w(key, date_col)
    nxt_date = F.lead(q(date_col)).over(w)
    n = months_elapsed(nxt_date, q(date_col))
    base = df.select(
        "*",
        F.coalesce(n, F.lit(1)).alias("_n"),
        *[F.lead(q(v)).over(w).alias(f"_next_{j}") for j, v in enumerate(value_cols)],
    )
    steps = base.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0)))).alias("_i"))
    i = F.col("_i")
    n_c = F.col("_n")
    values = {}
    for j, v in enumerate(value_cols):
        v0 = q(v).cast("double")
        v1 = F.col(f"_next_{j}").cast("double")
        line = v0 + F.try_divide((v1 - v0) * i, n_c.cast("double"))
        values[v] = F.when(i == 0, v0).otherwise(F.coalesce(line, v0))
    return steps.select(
        q(key),
        _step_date(q(date_col), i).alias(date_col),
        *[values[v].alias(v) for v in value_cols],
        *[q(c) for c in carry_cols],
        *[F.when(i == 0, q(c)).alias(c) for c in others],
    ).select(*[q(c) for c in df.columns])


def extend_flat(df: DataFrame, key: str, date_col: str, end_date: str) -> DataFrame:
    """After each key's last row add monthly rows up to ``end_date`` that
    copy the last row's values (the reference's forward "interpolation" holds
    the last value). Months are first-of-month; the final row is ``end_date``."""
    require_columns(df, [key, date_col])
    others = [c for c in df.columns if c not in (key, date_col)]
    end = F.lit(end_date).cast("date")
    last = (df.groupBy(q(key))
            .agg(F.max_by(F.struct(q(date_col).alias("_d"), *[q(c) for c in others]), q(date_col)).alias("_r"))
            .select(q(key), "_r.*"))
    n = months_elapsed(end, F.col("_d"))
    ext = last.where(n >= 1).select("*", F.explode(F.sequence(F.lit(1), n)).alias("_i"))
    new_date = F.when(F.col("_i") == n, end).otherwise(F.add_months(F.trunc("_d", "MM"), F.col("_i")))
    new_rows = ext.select(q(key), new_date.alias(date_col), *[q(c) for c in others])
    return df.unionByName(new_rows.select(*[q(c) for c in df.columns]))


def interpolate_linear(df: DataFrame, key: str | Sequence[str] | None, order: str,
                       cols: str | Sequence[str]) -> DataFrame:
    """positional linear fill per key: leading NULLs stay, inner NULLs lie on
    the line between the neighbouring values, trailing NULLs hold the last value.

    With ``key=None`` the whole frame is one series, as the reference fills it
    (X9); that path is a distributed scan (``_interpolate_series``), not a
    single-partition window.
    """
    cols = _as_list(cols)
    keys = _as_list(key) if key is not None else []
    require_columns(df, [*keys, order, *cols])
    if not keys:
        return _interpolate_series(df, order, cols)
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(q(order))
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    pos = F.row_number().over(w)
    staged = df.withColumn("_pos", pos)
    fills = {}
    for c in cols:
        v = q(c).cast("double")
        y0 = F.last(v, ignorenulls=True).over(before)
        i0 = F.last(F.when(v.isNotNull(), F.col("_pos")), ignorenulls=True).over(before)
        y1 = F.first(v, ignorenulls=True).over(after)
        i1 = F.first(F.when(v.isNotNull(), F.col("_pos")), ignorenulls=True).over(after)
        line = y0 + F.try_divide(y1 - y0, (i1 - i0).cast("double")) * (F.col("_pos") - i0)
        fills[c] = F.coalesce(line, y0)
    return staged.withColumns(fills).drop("_pos")


def _interpolate_series(df: DataFrame, order: str, cols: list[str]) -> DataFrame:
    """F3 over one series spread across many tasks.

    The frame is range-partitioned on ``order``, so every task holds one
    contiguous stretch of the series. Within a stretch, positions and the
    neighbouring non-null values come from windows partitioned by the stretch.
    A summary of one row per stretch (row count, first and last non-null value
    and position) gives each stretch its position offset and the non-null values
    just outside it; that table is bounded by the number of partitions, so it is
    broadcast. The stretches are checkpointed (``range_stretches``), so the
    summary and the fill see the same numbering of rows tied on ``order``.
    """
    staged = range_stretches(df, [order])
    # Later windows order by the position itself, so rows tied on ``order`` keep it.
    wi = Window.partitionBy("_part").orderBy("_i")
    before = wi.rowsBetween(Window.unboundedPreceding, 0)
    after = wi.rowsBetween(0, Window.unboundedFollowing)
    vals = {c: q(c).cast("double") for c in cols}

    # One row per stretch: size, and per column the first/last non-null (local position, value).
    aggs = [F.count(F.lit(1)).alias("_n")]
    for k, (c, v) in enumerate(vals.items()):
        at = F.when(v.isNotNull(), F.col("_i"))
        aggs += [F.min(at).alias(f"_fi{k}"), F.min_by(v, at).alias(f"_fv{k}"),
                 F.max(at).alias(f"_li{k}"), F.max_by(v, at).alias(f"_lv{k}")]
    summary = staged.groupBy("_part").agg(*aggs)
    sw = Window.orderBy("_part")
    prior = sw.rowsBetween(Window.unboundedPreceding, -1)
    later = sw.rowsBetween(1, Window.unboundedFollowing)
    off = F.coalesce(F.sum("_n").over(prior), F.lit(0))
    summary = summary.withColumn("_off", off)
    edges = [F.col("_part"), F.col("_off")]
    for k in range(len(cols)):
        # Non-null neighbours outside the stretch, with global positions.
        edges += [F.last(F.col(f"_li{k}") + F.col("_off"), ignorenulls=True).over(prior).alias(f"_pi{k}"),
                  F.last(f"_lv{k}", ignorenulls=True).over(prior).alias(f"_pv{k}"),
                  F.first(F.col(f"_fi{k}") + F.col("_off"), ignorenulls=True).over(later).alias(f"_ni{k}"),
                  F.first(f"_fv{k}", ignorenulls=True).over(later).alias(f"_nv{k}")]
    # At most spark.sql.shuffle.partitions rows: a proven broadcast bound.
    edge_table = F.broadcast(summary.select(*edges))

    joined = staged.join(edge_table, "_part").withColumn("_pos", F.col("_i") + F.col("_off"))
    fills = {}
    for k, (c, v) in enumerate(vals.items()):
        at = F.when(v.isNotNull(), F.col("_pos"))
        y0 = F.coalesce(F.last(v, ignorenulls=True).over(before), F.col(f"_pv{k}"))
        i0 = F.coalesce(F.last(at, ignorenulls=True).over(before), F.col(f"_pi{k}"))
        y1 = F.coalesce(F.first(v, ignorenulls=True).over(after), F.col(f"_nv{k}"))
        i1 = F.coalesce(F.first(at, ignorenulls=True).over(after), F.col(f"_ni{k}"))
        line = y0 + F.try_divide(y1 - y0, (i1 - i0).cast("double")) * (F.col("_pos") - i0)
        fills[c] = F.coalesce(line, y0)
    return joined.withColumns(fills).select(*[q(c) for c in df.columns])


def resample_monthly(df: DataFrame, key: str, date_col: str, value_col: str) -> DataFrame:
    """Mean per (key, month), then every month between a key's first and last
    month filled on the straight line (within the key, X9).

    Output ``(key, date, value_col)``; ``date`` is the first of the month.
    """
    require_columns(df, [key, date_col, value_col])
    monthly = (df.where(q(key).isNotNull())
               .groupBy(q(key), F.trunc(q(date_col).cast("date"), "MM").alias(date_col))
               .agg(F.avg(q(value_col)).alias(value_col)))
    return interpolate_linear(expand_months(monthly, key, date_col), key, date_col, value_col)


def sheets_to_monthly(df: DataFrame, sheet_col: str, key: str, value_col: str, date_col: str = "date"
                      ) -> DataFrame:
    """Rows tagged with a sheet name; digit-only sheets are years → 1 January
    of that year → E4 (mean per month, linear fill)."""
    require_columns(df, [sheet_col, key, value_col])
    years = df.where(q(sheet_col).rlike(r"^\d+$")).withColumn(
        date_col, F.make_date(q(sheet_col).try_cast("int"), F.lit(1), F.lit(1)))
    return resample_monthly(years, key, date_col, value_col)


def fill_calendar(df: DataFrame, key: str, date_col: str, col: str, fill=0) -> DataFrame:
    """Insert the missing months between a key's first and last row (G1) with ``col``
    set to ``fill`` (an area-month without events has no row in a count panel)."""
    out = expand_months(df, key, date_col)
    return out.withColumn(col, F.coalesce(q(col), F.lit(fill).cast(df.schema[col].dataType)))


def lag_features(df: DataFrame, key: str, order: str, col: str, lags: Sequence[int] = (1, 2, 3),
                 names: Sequence[str] | None = None, dropna: bool = True, calendar: bool = False) -> DataFrame:
    """lagged copies of ``col`` per key in ``order``; rows lacking the deepest lag
    are dropped when ``dropna``.

    By default lags are by row, as in the reference (a month without a row is
    skipped); ``calendar=True`` first inserts missing months with ``col = 0``, so a
    lag of 1 is always the previous calendar month.
    """
    require_columns(df, [key, order, col])
    if calendar:
        df = fill_calendar(df, key, order, col)
    names = list(names) if names else [f"{col}_lag{k}" for k in lags]
    w = _w(key, order)
    out = df.withColumns({n: F.lag(q(col), k).over(w) for n, k in zip(names, lags)})
    return out.na.drop(subset=[names[list(lags).index(max(lags))]]) if dropna else out


def rolling_mean(df: DataFrame, key: str, order: str, col: str, periods: int = 3, name: str | None = None
                 ) -> DataFrame:
    """mean of the ``periods`` previous rows (current excluded); NULL unless
    all of them are present."""
    require_columns(df, [key, order, col])
    w = _w(key, order).rowsBetween(-periods, -1)
    name = name or f"{col}_{periods}_mean"
    return df.withColumn(name, F.when(F.count(q(col)).over(w) == periods, F.avg(q(col)).over(w)))
