"""Row arithmetic as column expressions.

Null rules differ from pandas on purpose in one place: division by zero gives
NULL (pandas gives +-inf / NaN); see README "Divergences".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or either side is NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def row_sum(cols: list[Column | str]) -> Column:
    """C4: sum across columns with NULL counted as 0; all-NULL gives 0.0."""
    if not cols:
        return F.lit(0.0)
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])


def scale(c: Column | str, factor: float) -> Column:
    """Multiply by a constant (``1e-6`` turns m² into km²)."""
    return _c(c) * F.lit(factor)


def nan_to_null(c: Column | str) -> Column:
    """Source rule: floating NaN becomes NULL, so only one kind of missing value exists."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str, strict: bool = True, dtype: str = "double") -> Column:
    """H4: parse text to a number. ``strict`` raises on bad text (ANSI cast);
    otherwise bad text becomes NULL."""
    c = _c(c)
    return c.cast(dtype) if strict else c.try_cast(dtype)


def log1p_value(c: Column | str) -> Column:
    """H5: ``ln(1 + x)``; NULL at and below -1 (pandas: -inf / NaN)."""
    return F.log1p(_c(c))


def ln_value(c: Column | str) -> Column:
    """H5: natural log; NULL at and below 0 (pandas: -inf / NaN)."""
    return F.ln(_c(c))
