"""Listings from stored web pages.

Fetching is not done here: pages arrive as a table ``(page_id, url, html)``
and extraction is a per-row regex over the whole document, JVM-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.html import tag_text
from vitrine.functions.urls import url_relative

# The anchor pattern that delimits a card's link and text.
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
TITLE = r"(?s)<title>(.*?)</title>"


def extract_links(pages: DataFrame, pattern: str = ANCHOR, html_col: str = "html",
                  keep=("page_id",)) -> DataFrame:
    """One row per matched card: position (1-based), raw link and the
    card text (H18). Both capture groups come from the same matches, so
    zipping them keeps each link with its own text."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1)
    inner = F.regexp_extract_all(F.col(html_col), F.lit(pattern), 2)
    z = pages.select(*keep, F.arrays_zip(hrefs.alias("href"), inner.alias("inner")).alias("z"))
    return z.select(*keep, F.posexplode("z").alias("pos0", "c")).select(
        *keep, (F.col("pos0") + 1).alias("pos"), F.col("c.href").alias("href"), tag_text(F.col("c.inner")).alias("title")
    )


def page_title(html_col: str = "html"):
    return tag_text(F.regexp_extract(F.col(html_col), TITLE, 1))


def listing_valid(title, price, link, mode: str = "strict"):
    """B5 / B6 / B7 validity: ``strict`` title, price > 0 and link;
    ``lenient`` title and link (empty strings count as missing); ``tag``
    the title and link exist (may be empty; price may be missing)."""
    def present(c):
        return c.isNotNull() & (c.cast("string") != "")

    if mode == "tag":
        return title.isNotNull() & link.isNotNull()
    ok = present(title) & present(link)
    if mode == "strict":
        # Spark orders NaN above every number, so NaN > 0 would pass
        ok = ok & F.coalesce((price > 0) & ~F.isnan(price), F.lit(False))
    elif mode not in ("lenient", "tag"):
        raise ValueError(f"unknown validity mode {mode!r}")
    return ok


def crawl_plan(categories: DataFrame, template_col: str = "template", pages_col: str = "max_pages") -> DataFrame:
    """One row per (category, page) with the page URL (``{}`` in the
    template is the page number)."""
    # sequence(1, 0) would count down: a category without pages has no row
    some = categories.where(F.col(pages_col) >= 1)
    return some.withColumn("page", F.explode(F.sequence(F.lit(1), F.col(pages_col)))).withColumn(
        "page_url", F.replace(F.col(template_col), F.lit("{}"), F.col("page").cast("string"))
    )


def crawl_cut(page_stats: DataFrame, category_col: str = "category", page_col: str = "page",
              cards_col: str = "n_cards", failed_col: str | None = None) -> DataFrame:
    """A category stops at its first page without cards (or
    its first failed page); pages from there on are dropped. The cut is a
    per-category aggregate joined back (never a window over a category,
    which would put a large category into one task). Pages without a category
    are a category of their own; pages without a number have no place in the order and stay."""
    stop = F.col(cards_col) == 0
    if failed_col:
        stop = stop | F.col(failed_col)
    cuts = page_stats.groupBy(F.col(category_col).alias("_of")).agg(F.min(F.when(stop, F.col(page_col))).alias("_cut"))
    joined = page_stats.join(cuts, F.col(category_col).eqNullSafe(F.col("_of")))
    kept = F.col("_cut").isNull() | F.col(page_col).isNull() | (F.col(page_col) < F.col("_cut"))
    return joined.where(kept).drop("_cut", "_of")


def ingest_pages(pages: DataFrame, path: str, category_col: str = "category", domain: str | None = None,
                 price_col: str | None = None, stop_on_empty: bool = True) -> DataFrame:
    """K6: stored pages -> cards -> (first empty page cut) -> prices ->
    per-category sink -> one table again.

    ``pages`` carries ``page_id``, ``html``, the category and ``page``
    (its number within the category). The documents are scanned and
    regex-parsed once: the per-page link arrays are materialised in the
    checkpoint folder (far smaller than the HTML), and the cut (B16) and the
    card rows are both taken from them. With ``price_col`` the card's price
    text is read with H1 and cards without a price are dropped (B2). The
    sink replaces only the categories present (A7); the returned DataFrame
    reads every category back (U1)."""
    from vitrine.functions.prices import price_nullable
    from vitrine.session import cut_lineage
    from vitrine.sources.sinks import save_by_category

    hrefs = F.regexp_extract_all(F.col("html"), F.lit(ANCHOR), 1)
    inner = F.regexp_extract_all(F.col("html"), F.lit(ANCHOR), 2)
    parsed = pages.select(
        "page_id", category_col, "page", F.arrays_zip(hrefs.alias("href"), inner.alias("inner")).alias("z")
    )
    parsed = cut_lineage(parsed.withColumn("n_cards", F.greatest(F.size("z"), F.lit(0))), "pages")
    if stop_on_empty:
        parsed = crawl_cut(parsed, category_col=category_col)
    cards = parsed.select("page_id", category_col, F.posexplode("z").alias("pos0", "c")).select(
        "page_id", category_col, (F.col("pos0") + 1).alias("pos"), F.col("c.href").alias("href"),
        tag_text(F.col("c.inner")).alias("title"),
    )
    cards = cards.withColumn("url", url_relative("href", domain))
    if price_col:
        cards = cards.withColumn("price", price_nullable(price_col)).where(F.col("price").isNotNull())
    save_by_category(cards, path, category_col)
    return pages.sparkSession.read.parquet(path)
