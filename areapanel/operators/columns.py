"""Column-level DataFrame steps.

Each step is ``DataFrame -> DataFrame`` and can be chained with
``df.transform(step, ...)``. Name checks run on the driver from the schema,
exactly (case-sensitive), before any job is started.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric as N
from ..functions.dates import date_literal
from ..functions.text import disambiguate as _disambiguate_expr
from ..functions.text import normalise_column_name, value_edits as _value_edits_expr
from .checks import require_columns


def q(name: str) -> Column:
    """Column by exact name, safe for dots and spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# --- projections ------------------------------------------------------------------------------

def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True) -> DataFrame:
    """B1: rename by map. ``strict`` requires every key to exist (exact case)."""
    if strict:
        require_columns(df, list(mapping))
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.select(*[q(c).alias(present.get(c, c)) for c in df.columns])


def subset_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """B2: keep exactly these columns, in this order."""
    cols = _as_list(cols)
    require_columns(df, cols)
    return df.select(*[q(c) for c in cols])


def drop_columns(df: DataFrame, cols: str | Iterable[str] | None = None,
                 contains: str | None = None, keep_only: Iterable[str] | None = None) -> DataFrame:
    """Drop named columns (must exist), columns whose name contains a text,
    or every column not in ``keep_only``."""
    names = _as_list(cols) if cols is not None else []
    require_columns(df, names)
    drop = set(names)
    if contains is not None:
        drop |= {c for c in df.columns if contains in c}
    if keep_only is not None:
        keep = set(keep_only)
        drop |= {c for c in df.columns if c not in keep}
    return df.select(*[q(c) for c in df.columns if c not in drop])


def select_by_suffix(df: DataFrame, suffix: str, key: str = "ward_code") -> DataFrame:
    """Keep the key and the columns ending with ``suffix``; the suffix
    (a regex, removed wherever it occurs, as the reference does) leaves the names."""
    keep = [c for c in df.columns if c.endswith(suffix) or c == key]
    return df.select(*[q(c).alias(re.sub(suffix, "", c)) for c in keep])


def normalise_column_names(df: DataFrame) -> DataFrame:
    """B11 on every column name."""
    return df.toDF(*[normalise_column_name(c) for c in df.columns])


def find_column(df: DataFrame, text: str) -> str:
    """The single column whose name contains ``text``; error on none or many."""
    hits = [c for c in df.columns if text in c]
    if len(hits) != 1:
        raise ValueError(f"expected exactly one column containing {text!r}, found {hits}")
    return hits[0]


def set_date(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant DATE column."""
    return df.withColumn(name, date_literal(value))


def extract_lookup(df: DataFrame, code: str, name: str, name_fn: Callable[[Column], Column] | None = None,
                   dedupe: bool = True) -> DataFrame:
    """The ``(code, name)`` pair as a lookup table, optionally with a name
    function; one row per code when ``dedupe`` (vertex tables repeat codes)."""
    require_columns(df, [code, name])
    name_col = name_fn(q(name)) if name_fn else q(name)
    out = df.select(q(code).alias(code), name_col.alias(name))
    return out.dropDuplicates([code]) if dedupe else out


def exclude_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Drop rows whose value is in ``values``; NULL rows are kept."""
    require_columns(df, col)
    values = list(values)
    if not values:
        return df
    return df.where(q(col).isNull() | ~q(col).isin(values))


def contains_all(df: DataFrame, col: str, patterns: str | Iterable[str]) -> DataFrame:
    """Keep rows whose text matches every regex, any case, anywhere. NULL rows drop."""
    require_columns(df, col)
    cond = F.lit(True)
    for p in _as_list(patterns):
        cond = cond & q(col).rlike("(?i)" + p)
    return df.where(cond)


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Keep rows whose value starts with ``prefix``."""
    require_columns(df, col)
    return df.where(q(col).startswith(prefix))


def split_rows(df: DataFrame, col: str, value) -> tuple[DataFrame, DataFrame]:
    """``(equal, not_equal)``; NULL goes to ``not_equal``."""
    require_columns(df, col)
    eq = F.coalesce(q(col) == F.lit(value), F.lit(False))
    return df.where(eq), df.where(~eq)


def drop_null_rows(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL in any named column."""
    cols = _as_list(cols)
    require_columns(df, cols)
    return df.na.drop(subset=cols)


# --- arithmetic -------------------------------------------------------------------------------

def ratio_column(df: DataFrame, new: str, num: str, den: str) -> DataFrame:
    """``new = num / den`` (NULL on zero division, N6)."""
    require_columns(df, [num, den])
    return df.withColumn(new, N.ratio(q(num), q(den)))


def fractions(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """For each ``{num: den}`` in order, overwrite ``num`` by ``num / den``.

    Later pairs see earlier results, as in the reference. When no denominator is
    also a numerator all pairs are applied in one projection.
    """
    require_columns(df, list(pairs) + list(pairs.values()))
    if not set(pairs) & set(pairs.values()):
        return df.withColumns({n: N.ratio(q(n), q(d)) for n, d in pairs.items()})
    for n, d in pairs.items():
        df = df.withColumn(n, N.ratio(q(n), q(d)))
    return df


def row_sum_column(df: DataFrame, new: str, cols: Iterable[str]) -> DataFrame:
    """C4: ``new`` = row sum with NULL as 0."""
    cols = _as_list(cols)
    require_columns(df, cols)
    return df.withColumn(new, N.row_sum([q(c) for c in cols]))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def apply_weight(df: DataFrame, weight: str, cols: Iterable[str] | None = None,
                 square_weight: bool = False) -> DataFrame:
    """Multiply each column by ``weight`` in one projection.

    ``cols`` defaults to every numeric column except the weight. The reference
    passes the weight column too and multiplies it by itself last; set
    ``square_weight`` to reproduce that.
    """
    require_columns(df, weight)
    cols = [c for c in (numeric_columns(df) if cols is None else _as_list(cols)) if c != weight]
    require_columns(df, cols)
    out = df.withColumns({c: q(c) * q(weight) for c in cols})
    if square_weight:
        out = out.withColumn(weight, q(weight) * q(weight))
    return out


def scale_column(df: DataFrame, col: str, factor: float) -> DataFrame:
    """``col * factor`` in place."""
    require_columns(df, col)
    return df.withColumn(col, N.scale(q(col), factor))


def transform_column(df: DataFrame, col: str, fn: Callable[[Column], Column]) -> DataFrame:
    """H6: apply a ``Column -> Column`` function to one column in place.

    Pass a native expression builder; a vectorised ``pandas_udf`` also fits
    this signature when no native expression exists.
    """
    require_columns(df, col)
    return df.withColumn(col, fn(q(col)))


def value_edits(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """H2: exact-match replacement by dict on one column."""
    require_columns(df, col)
    return df.withColumn(col, _value_edits_expr(q(col), mapping))


def disambiguate(df: DataFrame, code: str, name: str, mapping: Mapping[str, str]) -> DataFrame:
    """H3: replace the name for listed codes."""
    require_columns(df, [code, name])
    return df.withColumn(name, _disambiguate_expr(q(code), q(name), mapping))
