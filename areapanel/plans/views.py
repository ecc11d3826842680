"""Served views (V1-V7): the reference's HTTP/database queries as lazy Spark
queries over the published tables. The server itself is not built; a caller
collects or writes these results.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checks import require_columns
from ..sinks.tables import YEAR_PARTITION, area_part, area_partition, drop_partitions
from ..sources.sql import param_sql

# V4 response shapes: column → type, in response order.
CRIME_SHAPE = {"count": "bigint", "ward_code": "string", "date": "date"}
NAME_SHAPE = {"ward_code": "string", "ward_name": "string"}
EDUCATION_SHAPE = {"ward_code": "string", "pop_with_qual": "double", "pop_without_qual": "double", "date": "date"}
EMPLOYMENT_SHAPE = {"ward_code": "string", "date": "date", "unemployed_adults": "double",
                    "long_term_sick_or_disabled": "double", "caring_for_family": "double"}
DENSITY_SHAPE = {"ward_code": "string", "population_density": "double", "date": "date"}


def typed_projection(df: DataFrame, shape: Mapping[str, str]) -> DataFrame:
    """V4: keep the response columns in order and cast them (timestamps narrow to dates)."""
    require_columns(df, list(shape))
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in shape.items()])


def history_crime(crime: DataFrame, ward_code: str | None = None, date: dt.date | str | None = None,
                  code_col: str = "ward_code", date_col: str = "date") -> DataFrame:
    """V1: ``code = COALESCE(:code, code) AND date = COALESCE(:date, date)``.

    Rows with a NULL code or date are never returned, even without filters (the
    reference's semantics). On a table read with its year partition column a bound date
    reads that year only, on one clustered by area a bound code its part only; partition columns are not returned."""
    if isinstance(date, str):
        date = dt.date.fromisoformat(date)
    sql = (f"SELECT * FROM {{t}} WHERE `{code_col}` = COALESCE(:code, `{code_col}`) "
           f"AND `{date_col}` = COALESCE(:d, `{date_col}`)")
    if YEAR_PARTITION in crime.columns and date is not None:
        sql += f" AND `{YEAR_PARTITION}` = year(:d)"
    found = param_sql(crime.sparkSession, sql, {"code": ward_code, "d": date}, {"t": _part_of(crime, ward_code)})
    return drop_partitions(found)


def _part_of(table: DataFrame, ward_code: str | None) -> DataFrame:
    """The part of a table clustered by area that holds the code's rows; all of it without a code."""
    clustered = area_partition(table.columns)
    if ward_code is None or clustered is None:
        return table
    name, parts = clustered
    return table.where(F.col(name) == area_part(F.lit(ward_code), parts))


def history_optional(table: DataFrame, ward_code: str | None = None, code_col: str = "ward_code") -> DataFrame:
    """V2: ``(:code IS NULL OR code = :code)``: without a code every row comes back,
    NULL codes included."""
    sql = f"SELECT * FROM {{t}} WHERE (:code IS NULL OR `{code_col}` = :code)"
    return drop_partitions(param_sql(table.sparkSession, sql, {"code": ward_code}, {"t": _part_of(table, ward_code)}))


def area_names(names: DataFrame) -> DataFrame:
    """V3: the name list in response shape."""
    return typed_projection(names, NAME_SHAPE)


def map_slice(panel: DataFrame, names: DataFrame, date: str, key: str = "area_code", value: str = "count"
              ) -> DataFrame:
    """V5: one month of the panel with names (inner join) and ``ln(value)`` for a
    log colour scale (NULL for 0, where pandas gives -inf)."""
    month = panel.where(F.col("date") == F.lit(date).cast("date"))
    return (month.join(names, key, "inner")
            .withColumn(f"log_{value}", F.ln(F.col(value))))


def area_series(crime: DataFrame, ward_code: str | None = None, code_col: str = "ward_code") -> DataFrame:
    """V6: V1 for one area (all areas when None), in date order."""
    return history_crime(crime, ward_code, None, code_col).orderBy(code_col, "date")


def prediction_for(predictions: DataFrame, ward_code: str | Column, code_col: str = "area_code") -> DataFrame:
    """V7: ``{crime_prediction}`` for one area from the scored table."""
    return predictions.where(F.col(code_col) == ward_code).select("crime_prediction")
