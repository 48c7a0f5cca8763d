"""Percentage price differences (H7, H8, H9) and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions._util import as_col
from vitrine.schema import NOT_AVAILABLE


def diff_signed(a, b, matched=None) -> Column:
    """H7: ``(a - b) / b * 100`` when matched and b is non-zero, else null."""
    a, b = as_col(a), as_col(b)
    ok = b.isNotNull() & (b != 0)
    if matched is not None:
        ok = ok & as_col(matched)
    return F.when(ok, (a - b) / b * 100)


def diff_symmetric(a, b) -> Column:
    """H8: ``abs(a - b) / ((a + b) / 2) * 100``; null when either is 0 or null."""
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    return F.when((a != 0) & (b != 0), F.abs(a - b) / ((a + b) / 2) * 100)


def diff_zero_filled(a, b) -> Column:
    """H9: ``(a - b) / b * 100`` with a missing target, a zero target or a
    NaN result read as 0."""
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    ratio = F.try_divide(a - b, b)
    return F.coalesce(F.when(~F.isnan(ratio), ratio), F.lit(0.0)) * 100


def percent_text(x, exclusive=None) -> Column:
    """Two decimals and a percent sign, rounded on the exact binary
    value like Python's ``f"{x:.2f}%"``; exclusive or null -> ``N/A``."""
    x = as_col(x)
    text = F.concat(F.call_function("format_number", x, F.lit("0.00")), F.lit("%"))
    out = F.when(x.isNull(), F.lit(NOT_AVAILABLE))
    if exclusive is not None:
        out = F.when(as_col(exclusive), F.lit(NOT_AVAILABLE)).when(x.isNull(), F.lit(NOT_AVAILABLE))
    return out.otherwise(text)
