"""Link joining (H4, H5, H6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions._util import as_col


def url_prefix(href, base: str) -> Column:
    """H4: always prefix the base."""
    return F.concat(F.lit(base), as_col(href))


def url_relative(href, domain: str | None) -> Column:
    """H5: prefix the domain only for root-relative links when a domain is
    set; a missing link stays null."""
    h = as_col(href)
    if not domain:
        return h
    return F.when(h.startswith("/"), F.concat(F.lit(domain), h)).otherwise(h)


def url_absolute(url, base: str) -> Column:
    """H6: prefix the base unless the link already starts with ``http``;
    ``""`` becomes the base. A null link stays null."""
    u = as_col(url)
    return F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(base), u))
