"""Scalar functions: every one returns a JVM-side ``Column`` (no Python UDF)."""

from vitrine.functions.diffs import diff_signed, diff_symmetric, diff_zero_filled, percent_text
from vitrine.functions.html import tag_text, unescape
from vitrine.functions.labels import (
    advantage,
    category_from_title,
    marketplace_from_match,
    normalise_flag,
    price_band,
    similarity_level,
)
from vitrine.functions.prices import clean_double, parse_price, price_digits, price_first_token, price_nullable
from vitrine.functions.urls import url_absolute, url_prefix, url_relative
from vitrine.functions.vectors import cosine, dot, norm, normalise

__all__ = [
    "advantage",
    "category_from_title",
    "clean_double",
    "cosine",
    "diff_signed",
    "diff_symmetric",
    "diff_zero_filled",
    "dot",
    "marketplace_from_match",
    "norm",
    "normalise",
    "normalise_flag",
    "parse_price",
    "percent_text",
    "price_band",
    "price_digits",
    "price_first_token",
    "price_nullable",
    "similarity_level",
    "tag_text",
    "unescape",
    "url_absolute",
    "url_prefix",
    "url_relative",
]
