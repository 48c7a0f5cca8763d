"""Composite jobs a user calls (K1-K9), each one lazy DataFrame plan.

The best-match table is the only expensive part; pass it in (``best=``)
when several reports share one run, so it is computed once (persist or
checkpoint it on the caller's side as needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.diffs import diff_signed, diff_zero_filled, percent_text
from vitrine.functions.labels import marketplace_from_match, normalise_flag, similarity_level
from vitrine.functions.prices import clean_double, parse_price
from vitrine.operators.dedupe import keep_cheapest, pair_difference
from vitrine.operators.match import attach_match, best_match, pair_rows, unmatched_sources, unmatched_targets
from vitrine.session import cut_lineage
from vitrine.schema import (
    BENCHMARK_HIDDEN,
    BENCHMARK_VISIBLE,
    DEFAULT_MATCH_THRESHOLD,
    NO,
    NOT_AVAILABLE,
    YES,
    Labels,
    Levels,
)


def prepare_catalog(df: DataFrame, marketplace: str, price_style: str = "first_token") -> DataFrame:
    """B8 + B9: drop rows without a vector, stamp the marketplace, read the
    price (text is parsed with ``price_style``, numbers pass unchanged)."""
    price_type = dict(df.dtypes).get("price")
    price = clean_double("price") if price_type not in (None, "string") else parse_price("price", price_style)
    out = df.where(F.col("embedding").isNotNull()).withColumn("marketplace", F.lit(marketplace))
    return out.withColumn("price", price) if price_type is not None else out


def analytical_report(source: DataFrame, target: DataFrame, threshold: float = DEFAULT_MATCH_THRESHOLD,
                      best: DataFrame | None = None, ordered: bool = True, **match_opts) -> DataFrame:
    """K1: one row per source product with its best target (filled only at
    or above the threshold), the real best score, the signed guarded diff
    (H7) and the exclusive flag; by similarity descending (S1)."""
    best = best if best is not None else best_match(source, target, **match_opts)
    m = attach_match(source, target, best, threshold)
    out = m.select(
        "source_id", "source_title", "target_id", "target_title", "similarity", "source_price", "target_price",
        diff_signed("source_price", "target_price", "matched").alias("diff_pct"),
        "source_url", (~F.col("matched")).alias("is_exclusive"),
    )
    return out.orderBy(F.desc("similarity"), "source_id") if ordered else out


def business_report(analytical: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """K2: a matched product becomes two rows (target price with an empty
    url, then the source row), an exclusive one row; both carry the source
    title; the diff as text (H10)."""
    matched = ~F.col("is_exclusive")
    text = percent_text("diff_pct")
    row = lambda side, mk, price, url, flag, txt: F.struct(
        F.lit(side).alias("side"), F.lit(mk).alias("marketplace"), price.alias("price"), url.alias("url"),
        F.lit(flag).alias("exclusivity"), txt.alias("diff_pct_text"),
    )
    tgt = row(0, labels.target, F.col("target_price"), F.lit(""), NO, text)
    src = row(1, labels.source, F.col("source_price"), F.col("source_url"), NO, text)
    alone = row(1, labels.source, F.col("source_price"), F.col("source_url"), YES, F.lit(NOT_AVAILABLE))
    rows = F.when(matched, F.array(tgt, src)).otherwise(F.array(alone))
    return analytical.select("source_id", F.col("source_title").alias("title"), F.explode(rows).alias("r")).select(
        "source_id", "r.side", "title", "r.marketplace", "r.price", "r.url", "r.exclusivity", "r.diff_pct_text"
    )


def match_report(source: DataFrame, target: DataFrame, threshold: float = DEFAULT_MATCH_THRESHOLD,
                 labels: Labels = Labels(), best: DataFrame | None = None, ordered: bool = True,
                 **match_opts) -> DataFrame:
    """K3: source rows (a title is required on both sides) with the matched target, the
    zero-filled diff (H9), the flag and the marketplace from match presence
    (H16); empty target -> all exclusive with similarity 0 and diff 0 (C7).
    By title, then price with nulls last (S2)."""
    source, target = (d.where(F.col("title").isNotNull()) for d in (source, target))
    best = best if best is not None else best_match(source, target, **match_opts)
    m = attach_match(source, target, best, threshold)
    out = m.select(
        "source_id",
        F.col("source_title").alias("title"),
        F.col("source_price").alias("price"),
        F.col("source_url").alias("url"),
        "target_id", "target_title", "target_price", "target_url", "similarity",
        F.when(F.col("matched"), F.lit(NO)).otherwise(F.lit(YES)).alias("exclusivity"),
        diff_zero_filled("source_price", "target_price").alias("diff_pct"),
        marketplace_from_match("target_title", labels).alias("marketplace"),
    )
    return out.orderBy(F.asc("title"), F.asc_nulls_last("price"), "source_id") if ordered else out


def finish_benchmark(rows: DataFrame, levels: Levels = Levels(), ordered: bool = True,
                     keys=("title", "marketplace")) -> DataFrame:
    """E1 -> H11 -> S3 on pair/exclusive rows."""
    kept = keep_cheapest(rows, keys=keys)
    out = kept.withColumn("similarity_level", similarity_level("similarity", levels))
    cols = BENCHMARK_VISIBLE + BENCHMARK_HIDDEN + [c for c in ("pair_id", "product_id", "partner_price") if c in kept.columns]
    out = out.select(*cols)
    if ordered:
        out = out.orderBy(F.desc(normalise_flag("exclusivity") == YES), "title", "marketplace", "price")
    return out


def benchmark_table(source: DataFrame, target: DataFrame, labels: Labels = Labels(), levels: Levels = Levels(),
                    best: DataFrame | None = None, ordered: bool = True, price_style: str = "first_token",
                    materialize: bool = True, pair_threshold: float | None = None, **match_opts) -> DataFrame:
    """K4: prepare both catalogs (B8), best match (C1), two rows per pair
    with the pair's symmetric diff (C4, E3 on intact pairs), never-chosen
    targets appended as exclusives (C5, U2), cheapest row per (title,
    marketplace) (E1), similarity level (H11), exclusives first (S3).

    The match feeds two joins keyed differently (pairs by source, exclusives
    by target), which would run the match twice; unless a ``best`` table is
    given it is materialised once as a table in the session's checkpoint
    folder, which also keeps an executor loss from re-running it.

    With ``pair_threshold`` only pairs that reach it are pairs; products of
    either side that are then in no pair are exclusive rows of their marketplace (C6)."""
    s = prepare_catalog(source, labels.source, price_style)
    t = prepare_catalog(target, labels.target, price_style)
    if best is None:
        best = best_match(s, t, **match_opts)
        best = cut_lineage(best, "best-match") if materialize else best
    if pair_threshold is not None:
        best = best.where(F.col("similarity") >= pair_threshold)
    rows = pair_rows(s, t, best, labels).unionByName(unmatched_targets(t, best, labels))
    if pair_threshold is not None:
        rows = rows.unionByName(unmatched_sources(s, best, labels))
    return finish_benchmark(rows, levels, ordered)


def final_cleanup(df: DataFrame, levels: Levels = Levels(), pair_col: str | None = None,
                  ordered: bool = True) -> DataFrame:
    """K5: the clean-up stage alone. With a pair key the pair diff (E3) is
    computed first; without one an existing ``diff_pct`` is kept (else
    null). Missing columns are added as nulls, so an empty frame gives an
    empty result with every output column."""
    need = {"title": "string", "marketplace": "string", "price": "double", "url": "string",
            "exclusivity": "string", "similarity": "double", "diff_pct": "double"}
    for c, typ in need.items():
        if c not in df.columns and not (c == "diff_pct" and pair_col):
            df = df.withColumn(c, F.lit(None).cast(typ))
    if pair_col:
        df = pair_difference(df, pair_col)
    order_cols = [c for c in ("pair_id", "side", "product_id") if c in df.columns]
    kept = keep_cheapest(df, order=order_cols or ("title",))
    out = kept.withColumn("similarity_level", similarity_level("similarity", levels))
    if ordered:
        out = out.orderBy(F.desc(normalise_flag("exclusivity") == YES), "title", "marketplace", "price")
    return out


def report_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(visible, hidden) columns of a report; hidden are similarity,
    level and diff."""
    hidden = [c for c in df.columns if c in BENCHMARK_HIDDEN]
    return [c for c in df.columns if c not in hidden], hidden


def exclusives_listing(report: DataFrame) -> DataFrame:
    """B10 (+H15): exclusive rows, ``title, price, url``."""
    return report.where(normalise_flag("exclusivity") == YES).select("title", "price", "url")


def exclusives_count(report: DataFrame) -> DataFrame:
    """D3: number of exclusive rows."""
    return report.agg(F.count_if(F.coalesce(normalise_flag("exclusivity") == YES, F.lit(False))).alias("n_exclusive"))


def source_exclusives(analytical: DataFrame) -> DataFrame:
    """Source products without an equivalent at the threshold."""
    return analytical.where(F.col("is_exclusive"))


def top_by(df: DataFrame, col: str, n: int = 10, descending: bool = True, tie=("pair_id",)) -> DataFrame:
    """Top ``n`` rows by a column (ties by ``tie``), with a rank.
    ``orderBy().limit()`` plans a per-partition top-k, never a full sort."""
    from pyspark.sql import Window

    order = [F.desc_nulls_last(col) if descending else F.asc_nulls_last(col)] + [F.asc(t) for t in tie]
    top = df.where(F.col(col).isNotNull()).orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def exclusives_summary(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K7: (count, listing) of the exclusive rows of a report."""
    return exclusives_count(report), exclusives_listing(report)


def slice_benchmark(bench: DataFrame, marketplace: str | None = None, levels=None, band: str | None = None,
                    category: str | None = None, category_col: str = "category") -> DataFrame:
    """The dashboard slicers as one parameterised filter (marketplace,
    similarity levels, price band, category drill-down); ``None`` = all."""
    from vitrine.functions.labels import price_band

    out = bench
    if marketplace is not None:
        out = out.where(F.col("marketplace") == marketplace)
    if levels:
        out = out.where(F.col("similarity_level").isin(list(levels)))
    if band is not None:
        out = out.where(price_band("price") == band)
    if category is not None:
        out = out.where(F.col(category_col) == category)
    return out


def pair_analysis(pairs: DataFrame, labels: Labels = Labels(), key: str = "pair_id",
                  levels: Levels = Levels()) -> DataFrame:
    """K9: one row per pair (D11) with the advantage label (H14) and the
    target price band (H13). From ``match.matched_pairs`` every pair is there
    with both titles, the level and the category of the target's title
    (H12); a stored table of paired rows is pivoted instead."""
    from vitrine.functions.labels import category_from_title, price_band
    from vitrine.operators.metrics import pair_table, pair_view

    if "target_title" not in pairs.columns:
        return pair_table(pairs, labels, key).withColumn("price_band", price_band("target_price"))
    return pair_view(pairs, labels, levels).withColumn("category", category_from_title("target_title")).withColumn(
        "price_band", price_band("target_price"))


def very_similar_by_price(spark, view: str):
    """B11 + S4: the published query over the benchmark view; equal prices by title, marketplace, url."""
    return spark.sql(
        f"SELECT title, marketplace, price, url, exclusivity, similarity_level FROM {view} "
        "WHERE similarity_level = 'muito similar' ORDER BY price DESC, title, marketplace, url"
    )


def exclusives_by_price(spark, view: str):
    """B12 + S4: the published query over the benchmark view; equal prices by title, marketplace, url."""
    return spark.sql(
        f"SELECT title, marketplace, price, url, exclusivity FROM {view} WHERE exclusivity = 'sim' ORDER BY price DESC, title, marketplace, url"
    )
