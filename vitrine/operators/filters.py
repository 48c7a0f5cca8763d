"""Listing filters (B2-B7) as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.prices import clean_double
from vitrine.sources.pages import listing_valid

PLAIN_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def keep_priced(df: DataFrame, price_col: str = "price") -> DataFrame:
    """B2: price read as double (unparsable -> null, NaN -> null; text that
    is no plain decimal, such as ``12d`` or ``1e5``, is unparsable), rows
    without a price dropped."""
    c = F.col(price_col)
    plain = F.when(F.trim(c.cast("string")).rlike(PLAIN_DECIMAL), c.try_cast("double"))
    as_double = clean_double(c) if dict(df.dtypes)[price_col] != "string" else clean_double(plain)
    return df.withColumn(price_col, as_double).where(F.col(price_col).isNotNull())


def require_title_and_price(df: DataFrame, title_col: str = "title", price_col: str = "price") -> DataFrame:
    """``price IS NOT NULL AND title IS NOT NULL``."""
    return df.where(F.col(price_col).isNotNull() & F.col(title_col).isNotNull())


def drop_untitled(df: DataFrame, title_col: str = "title") -> DataFrame:
    """Rows without a title dropped."""
    return df.dropna(subset=[title_col])


def valid_listings(df: DataFrame, mode: str = "strict", title_col: str = "title", price_col: str = "price",
                   link_col: str = "url") -> DataFrame:
    """B5 (``strict``: title, price > 0, link), B6 (``lenient``: title and
    link) and B7 (``tag``: title and link present, price may be missing)."""
    price = F.col(price_col) if price_col in df.columns else F.lit(None).cast("double")
    return df.where(listing_valid(F.col(title_col), price, F.col(link_col), mode))
