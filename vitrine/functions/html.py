"""HTML text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions._util import as_col

# The named entities decoded after tag removal (``&amp;`` last
# so that ``&amp;lt;`` reads ``&lt;``).
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]
NBSP = ("&nbsp;", "\u00a0")


def unescape(col) -> Column:
    c = as_col(col)
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def tag_text(inner_html) -> Column:
    """Text of an element with each text piece stripped and the pieces
    joined without separator (``get_text(strip=True)``)."""
    # a no-break space is whitespace to strip, so it is decoded first
    spaced = F.replace(as_col(inner_html), F.lit(NBSP[0]), F.lit(NBSP[1]))
    no_tags = F.regexp_replace(spaced, r"(?U)\s*<[^>]*>\s*", "")
    return F.regexp_replace(unescape(no_tags), r"(?U)^\s+|\s+$", "")
