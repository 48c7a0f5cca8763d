"""Aggregations for reports and the dashboard.

Counts are single global aggregates of ``count_if``/``avg(when(...))``:
one partial row per partition, one final row, no grouping shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.labels import advantage, normalise_flag, similarity_level
from vitrine.schema import LEVEL_EXCLUSIVE, LEVEL_LOW, LEVEL_MODERATE, LEVEL_VERY, NO, YES, Labels, Levels


def _count_if(cond):
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _share(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def input_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row count of each input in one job (a union, one aggregate)."""
    tagged = source.select(F.lit(0).alias("_side")).unionByName(target.select(F.lit(1).alias("_side")))
    return tagged.agg(
        _count_if(F.col("_side") == 0).alias("source_rows"),
        _count_if(F.col("_side") == 1).alias("target_rows"),
    )


def report_statistics(bench: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """D2 (+D4): total, per marketplace, paired rows (``não``), exclusive
    rows, rows per similarity level. Zero rows in -> zeros out."""
    ex = normalise_flag("exclusivity")
    lv = F.col("similarity_level")
    mk = F.col("marketplace")
    return bench.agg(
        F.count(F.lit(1)).alias("total_products"),
        _count_if(mk == labels.source).alias("source_products"),
        _count_if(mk == labels.target).alias("target_products"),
        _count_if(ex == NO).alias("paired_products"),
        _count_if(ex == YES).alias("exclusive_products"),
        _count_if(lv == LEVEL_VERY).alias("very_similar"),
        _count_if(lv == LEVEL_MODERATE).alias("moderately_similar"),
        _count_if(lv == LEVEL_LOW).alias("little_similar"),
        _count_if(lv == LEVEL_EXCLUSIVE).alias("exclusive_level"),
    )


def with_partner_price(bench: DataFrame, labels: Labels = Labels(), pair_col: str = "pair_id",
                       id_col: str = "product_id") -> DataFrame:
    """Each paired row gets its partner's price (window over the pair;
    rows without a pair key are their own partition, so exclusives never
    gather in one task)."""
    key2 = F.when(F.col(pair_col).isNull(), F.col(id_col))
    w = Window.partitionBy(F.col(pair_col), key2)
    mk = F.col("marketplace")
    src = F.max(F.when(mk == labels.source, F.col("price"))).over(w)
    tgt = F.max(F.when(mk == labels.target, F.col("price"))).over(w)
    partner = F.when(mk == labels.target, src).when(mk == labels.source, tgt)
    return bench.withColumn("partner_price", F.when(F.col(pair_col).isNotNull(), partner))


def kpi_row(bench: DataFrame, labels: Labels = Labels(), pair_col: str = "pair_id",
            analytical: DataFrame | None = None, very: float = Levels().very) -> DataFrame:
    """K8: the dashboard KPIs in one aggregate over the benchmark table.

    D4 totals, D5 exclusives per marketplace, D6 pairs (= paired rows / 2),
    D7 mean price per marketplace, D8 mean diff over paired rows, D9
    cheaper-side counts and shares and their difference, D10 relative gap of
    the mean prices, D2 rows per level, D20 mean diff where the target is
    cheaper. With the analytical report (K1) also D14 coverage, D15 quality
    and D16 opportunities: its rows join the same aggregate by a union.

    The partner's price is the one that ``pair_rows`` carries; a table
    without it is looked up in itself (C8)."""
    b = bench if "partner_price" in bench.columns else with_partner_price(bench, labels, pair_col)
    need = ["marketplace", "exclusivity", "price", "partner_price", "similarity_level", "diff_pct"]
    b = b.select(*need, F.lit(True).alias("_row"))
    if analytical is not None:
        b = b.unionByName(analytical.select("is_exclusive", F.col("similarity").alias("_score")), allowMissingColumns=True)
    mk, ex = F.col("marketplace"), normalise_flag("exclusivity")
    paired = ex == NO
    tgt_paired = (mk == labels.target) & paired
    pairs = _count_if(paired) / 2
    tgt_cheaper = _count_if(tgt_paired & (F.col("price") < F.col("partner_price")))
    src_cheaper = _count_if(tgt_paired & (F.col("price") > F.col("partner_price")))
    avg_src = F.avg(F.when(mk == labels.source, F.col("price")))
    avg_tgt = F.avg(F.when(mk == labels.target, F.col("price")))
    out = b.agg(
        _count_if(F.col("_row")).alias("total_products"),
        _count_if(mk == labels.target).alias("total_target"),
        _count_if(mk == labels.source).alias("total_source"),
        _count_if((mk == labels.target) & (ex == YES)).alias("exclusive_target"),
        _count_if((mk == labels.source) & (ex == YES)).alias("exclusive_source"),
        pairs.alias("paired_products"),
        avg_tgt.alias("avg_price_target"),
        avg_src.alias("avg_price_source"),
        F.avg(F.when(paired, F.col("diff_pct"))).alias("avg_diff_pct"),
        tgt_cheaper.alias("target_cheaper"),
        src_cheaper.alias("source_cheaper"),
        _share(tgt_cheaper, pairs).alias("share_target_cheaper"),
        _share(src_cheaper, pairs).alias("share_source_cheaper"),
        F.coalesce(F.try_divide(avg_src - avg_tgt, avg_tgt), F.lit(0.0)).alias("avg_price_gap"),
        _count_if(paired).alias("paired_rows"),
        _count_if(ex == YES).alias("exclusive_rows"),
        _count_if(F.col("similarity_level") == LEVEL_VERY).alias("very_similar"),
        _count_if(F.col("similarity_level") == LEVEL_MODERATE).alias("moderately_similar"),
        _count_if(F.col("similarity_level") == LEVEL_LOW).alias("little_similar"),
        F.avg(F.when(tgt_paired & (F.col("price") < F.col("partner_price")), F.col("diff_pct"))).alias("favourable_gap"),
        *(_quality(very) if analytical is not None else []),
    )
    return out.withColumn("target_advantage", F.col("share_target_cheaper") - F.col("share_source_cheaper"))


def price_by_marketplace(bench: DataFrame) -> DataFrame:
    """D7 per marketplace as rows."""
    return bench.groupBy("marketplace").agg(F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("n"))


def _quality(very: float, score: str = "_score") -> list:
    """D14, D15, D16 as aggregates; rows without a flag are not rows of the report."""
    excl = F.col("is_exclusive")
    high = F.when(excl.isNotNull(), F.coalesce(F.col(score) > very, F.lit(False)).cast("double"))
    return [
        F.coalesce(F.avg((~excl).cast("double")), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.avg(high), F.lit(0.0)).alias("quality"),
        _count_if(excl).alias("opportunities"),
    ]


def match_quality(analytical: DataFrame, very: float = Levels().very) -> DataFrame:
    """D14 coverage (share of source products with an equivalent), D15
    quality (share with similarity > very), D16 opportunities (source
    products without an equivalent)."""
    return analytical.agg(*_quality(very, "similarity"))


def pair_table(bench: DataFrame, labels: Labels = Labels(), key: str = "pair_id") -> DataFrame:
    """D11 for a stored table of paired rows: pivoted to one row per pair key:
    price, url, score and level of each side (first by row position). A
    side that is not in the table gives nulls (``pair_view`` has none). Then
    H14 the advantage label (K9)."""
    paired = bench.where(normalise_flag("exclusivity") == NO)
    mk = F.col("marketplace")
    rank = F.struct(F.col("side"), F.col("product_id")) if "side" in bench.columns else F.col("product_id")

    def first(col, label):
        return F.min_by(F.when(mk == label, F.col(col)), F.when(mk == label, rank))

    t = paired.groupBy(key).agg(
        first("price", labels.target).alias("target_price"),
        first("price", labels.source).alias("source_price"),
        first("url", labels.target).alias("target_url"),
        first("url", labels.source).alias("source_url"),
        first("similarity", labels.target).alias("similarity"),
        first("similarity_level", labels.target).alias("similarity_level"),
        first("diff_pct", labels.target).alias("diff_pct"),
    )
    return t.withColumn("advantage", advantage("source_price", "target_price", labels))


def pair_view(pairs: DataFrame, labels: Labels = Labels(), levels: Levels = Levels()) -> DataFrame:
    """D11 without a pivot: ``match.matched_pairs`` with the level (H11) and
    the advantage label (H14). One row per pair, whatever de-duplication
    does to the members' rows."""
    return pairs.withColumn("similarity_level", similarity_level("similarity", levels)).withColumn(
        "advantage", advantage("source_price", "target_price", labels))


def advantage_split(pairs: DataFrame) -> DataFrame:
    """Number of pairs per advantage label."""
    return pairs.groupBy("advantage").agg(F.count(F.lit(1)).alias("n_pairs"))


def favourable_gap(pairs: DataFrame) -> DataFrame:
    """Mean diff over pairs where the own (target) side is cheaper."""
    return pairs.agg(
        F.avg(F.when(F.col("target_price") < F.col("source_price"), F.col("diff_pct"))).alias("favourable_gap")
    )


def level_distribution(bench: DataFrame) -> DataFrame:
    """Rows per similarity level."""
    return bench.groupBy("similarity_level").agg(F.count(F.lit(1)).alias("n"))


def level_category_rollup(bench: DataFrame, category_col: str = "category") -> DataFrame:
    """D12 drill-down: rows per (category, level) with category subtotals
    and a grand total (ROLLUP)."""
    return bench.rollup(category_col, "similarity_level").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level_of_detail")
    )


def dimension(bench: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return bench.select(col).distinct()


def scatter_points(pairs: DataFrame) -> DataFrame:
    """One (similarity, diff) point per pair."""
    return pairs.select("pair_id", "similarity", "diff_pct")


def trend(history: DataFrame, ts_col: str, value_col: str, period: str = "1 day", by=()) -> DataFrame:
    """Mean value and number of rows per time bucket (and ``by``)."""
    return history.groupBy(F.window(ts_col, period).start.alias("period_start"), *by).agg(
        F.avg(value_col).alias("avg_value"), F.count(F.lit(1)).alias("n")
    )
