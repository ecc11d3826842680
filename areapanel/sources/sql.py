"""Parametrised SQL over registered tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def temp_view(df: DataFrame, prefix: str = "ap") -> str:
    """Register ``df`` under a fresh session-local view name and return it."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def param_sql(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None,
              tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A10: run ``sql`` with named parameter markers (``:name``; ``None`` binds NULL).

    ``tables`` maps placeholder names used as ``{name}`` in the text to DataFrames;
    each is registered as a temporary view. The result stays lazy: Catalyst folds
    NULL parameters (``COALESCE(:p, col)`` → ``isnotnull(col)``) and pushes the
    remaining predicates into the scan.
    """
    views = {k: temp_view(v, k) for k, v in (tables or {}).items()}
    text = sql
    for k, view in views.items():
        text = text.replace("{" + k + "}", view)
    return spark.sql(text, args=dict(args or {}))
