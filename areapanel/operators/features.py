"""Model features on area panels (M1-M3, H5).

All areas are handled at once: per-area windows and grouped ``regr_*``
aggregates replace the reference's one-area-at-a-time pandas code. Windows and
the grouped aggregate share one exchange on the area key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .checks import require_columns
from .columns import q
from .relational import join_panels, latest_row
from .timeseries import lag_features, rolling_mean

# FIXED VALUES: feature names and their order as the scoring model expects them.
LAG_NAMES = ["crime_last_month", "crime_last_two_months", "crime_last_three_months"]
ROLLING_NAME = "crime_3month_avg"
DENSITY_LOG = "pop_density_log"
MODEL_FEATURES = ["pop_with_qual", "pop_without_qual", "unemployed_adults", "long_term_sick_or_disabled",
                  "caring_for_family", "crime_last_month", "crime_last_two_months", "crime_last_three_months",
                  "crime_3month_avg", "pop_density_log"]


def _numeric(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def trend_forecast(df: DataFrame, key: str = "area_code", date_col: str = "date", target: str = "count",
                   cols: Sequence[str] | None = None) -> DataFrame:
    """M1: next month's row per area. Each numeric column (except ``target``, left
    NULL) is the least-squares line over row positions 0..n-1 read at n; the date
    moves one month on; other columns copy the area's last row.

    One point gives a flat line (slope 0, intercept = the value), like a fit of one sample.
    """
    require_columns(df, [key, date_col, target])
    cols = list(cols) if cols is not None else _numeric(df, [target])
    others = [c for c in df.columns if c not in {key, date_col, target, *cols}]
    w = Window.partitionBy(q(key)).orderBy(q(date_col))
    pos = (F.row_number().over(w) - 1).cast("double")
    staged = df.withColumn("_x", pos)
    aggs = [F.count(F.lit(1)).alias("_n"), F.max(q(date_col)).alias("_last")]
    for i, c in enumerate(cols):
        y = q(c).cast("double")
        aggs += [F.regr_slope(y, F.col("_x")).alias(f"_s{i}"), F.regr_intercept(y, F.col("_x")).alias(f"_i{i}"),
                 F.avg(y).alias(f"_m{i}")]
    if others:
        aggs.append(F.max_by(F.struct(*[q(c) for c in others]), q(date_col)).alias("_o"))
    g = staged.groupBy(q(key)).agg(*aggs)
    n = F.col("_n").cast("double")
    preds = {c: (F.coalesce(F.col(f"_i{i}"), F.col(f"_m{i}")) + F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) * n)
             for i, c in enumerate(cols)}
    target_type = df.schema[target].dataType
    out_cols = []
    for c in df.columns:
        if c == key:
            out_cols.append(q(key))
        elif c == date_col:
            out_cols.append(F.add_months(F.col("_last"), 1).alias(date_col))
        elif c == target:
            out_cols.append(F.lit(None).cast(target_type).alias(target))
        elif c in preds:
            out_cols.append(preds[c].cast(df.schema[c].dataType if isinstance(df.schema[c].dataType, T.DoubleType)
                                          else "double").alias(c))
        else:
            out_cols.append(F.col("_o").getField(c).alias(c))
    return g.select(*out_cols)


def trend_lines(df: DataFrame, key: str = "area_code", date_col: str = "date", target: str = "count",
                cols: Sequence[str] | None = None) -> DataFrame:
    """The lines behind ``trend_forecast``, one row per area: ``_n`` rows, ``_last`` date, and for every column c the value
    ``_start_c`` at position 0 and the slope ``_slope_c`` per row."""
    cols = list(cols) if cols is not None else _numeric(df, [target])
    w = Window.partitionBy(q(key)).orderBy(q(date_col))
    staged = df.withColumn("_x", (F.row_number().over(w) - 1).cast("double"))
    aggs = [F.count(F.lit(1)).cast("double").alias("_n"), F.max(q(date_col)).alias("_last")]
    for c in cols:
        y = q(c).cast("double")
        aggs += [F.coalesce(F.regr_intercept(y, F.col("_x")), F.avg(y)).alias(f"_start_{c}"),
                 F.coalesce(F.regr_slope(y, F.col("_x")), F.lit(0.0)).alias(f"_slope_{c}")]
    return staged.groupBy(q(key)).agg(*aggs)


def add_crime_features(df: DataFrame, key: str = "area_code", date_col: str = "date", target: str = "count",
                       density_col: str | None = "population_density", dropna: bool = True) -> DataFrame:
    """F1 + F2 + H5: three lags and the mean of the three previous values of
    ``target``; ``log1p`` of the density replaces the density; rows lacking the
    third lag are dropped."""
    out = lag_features(df, key, date_col, target, (1, 2, 3), LAG_NAMES, dropna=False)
    out = rolling_mean(out, key, date_col, target, 3, ROLLING_NAME)
    if density_col is not None and density_col in out.columns:
        out = out.withColumn(DENSITY_LOG, F.log1p(q(density_col))).drop(density_col)
    return out.na.drop(subset=[LAG_NAMES[-1]]) if dropna else out


def prediction_features(history: DataFrame, key: str = "area_code", date_col: str = "date", target: str = "count",
                        density_col: str | None = "population_density", trend_cols: Sequence[str] | None = None
                        ) -> DataFrame:
    """M2: history ∪ trend row (M1) → crime features → the newest row per area
    (the month to predict)."""
    nxt = trend_forecast(history, key, date_col, target, trend_cols)
    extended = history.unionByName(nxt)
    feats = add_crime_features(extended, key, date_col, target, density_col)
    return latest_row(feats, key, date_col)


def training_features(panels: Sequence[DataFrame], key: str = "area_code", date_col: str = "date",
                      target: str = "count", density_col: str | None = "population_density",
                      names: DataFrame | None = None, drop: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """M3: join the panels on (area, month), add crime features, and list the
    feature columns: every column except name columns, the target, key, date and
    raw density (text columns are never features, X2)."""
    joined = join_panels(panels, (key, date_col), names=names)
    feats = add_crime_features(joined, key, date_col, target, density_col)
    excluded = {key, date_col, target, *(density_col and [density_col] or []), *drop}
    feature_cols = [f.name for f in feats.schema.fields
                    if f.name not in excluded and isinstance(f.dataType, T.NumericType)]
    return feats, feature_cols
