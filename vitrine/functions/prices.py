"""Price text -> double (H1, H2, H3), all as JVM-side Column expressions.

Every parser guards the final cast with a strict numeric pattern: Spark's
``try_cast`` accepts forms such as ``'12d'`` or ``'NaN'`` that a plain
decimal reading must reject, so those give the parser's failure value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions._util import as_col

# The "unavailable" marker and the strict decimal shape.
UNAVAILABLE = "indisponível"
_DECIMAL = r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"
_SIGNED_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _guarded_double(text: Column, pattern: str, failure: Column) -> Column:
    return F.when(text.rlike(pattern), text.try_cast("double")).otherwise(failure)


def price_nullable(col) -> Column:
    """H1: empty/null/"indisponível" -> null; drop R, $, whitespace and dots;
    comma becomes the decimal point; anything else unparsable -> null."""
    c = as_col(col).cast("string")
    cleaned = F.replace(F.regexp_replace(c, r"(?U)[R$\s.]", ""), F.lit(","), F.lit("."))
    unavailable = F.lower(c).contains(UNAVAILABLE)
    return (
        F.when(c.isNull() | (c == "") | unavailable, F.lit(None).cast("double"))
        .otherwise(_guarded_double(cleaned, _SIGNED_DECIMAL, F.lit(None).cast("double")))
    )


def price_digits(col) -> Column:
    """H2: keep digits, commas and dots; drop every dot; commas become dots;
    when several dots remain the last one is the decimal point; failure -> 0.0.
    So ``"123.45"`` reads 12345.0."""
    c = as_col(col).cast("string")
    kept = F.regexp_replace(c, r"[^0-9,.]", "")
    dotted = F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    last_dot = F.regexp_replace(dotted, r"\.(?=.*\.)", "")
    return F.coalesce(_guarded_double(last_dot, _DECIMAL, F.lit(0.0)), F.lit(0.0))


def price_first_token(col) -> Column:
    """H3: the first number-like token of the text.

    With a comma, dots are thousands separators and the comma is the decimal
    point (``"R$ 6.599,00"`` -> 6599.0); without a comma several dots are
    thousands separators, a single dot is the decimal point (``"123.45"`` ->
    123.45). Empty, null or no number -> 0.0.
    """
    c = as_col(col).cast("string")
    token = F.regexp_extract(c, r"[0-9][0-9.,]*", 0)
    n_dots = F.length(token) - F.length(F.replace(token, F.lit("."), F.lit("")))
    normal = (
        F.when(token.contains(","), F.replace(F.replace(token, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(n_dots > 1, F.replace(token, F.lit("."), F.lit("")))
        .otherwise(token)
    )
    return F.coalesce(_guarded_double(normal, _DECIMAL, F.lit(0.0)), F.lit(0.0))


def parse_price(col, style: str = "first_token") -> Column:
    """Dispatch on parser style: ``nullable`` (H1), ``digits`` (H2) or
    ``first_token`` (H3)."""
    if style == "nullable":
        return price_nullable(col)
    if style == "digits":
        return price_digits(col)
    if style == "first_token":
        return price_first_token(col)
    raise ValueError(f"unknown price style {style!r}")


def clean_double(col) -> Column:
    """NaN -> null so pandas-born NaN never passes an ``isNotNull`` filter."""
    c = as_col(col).cast("double")
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
