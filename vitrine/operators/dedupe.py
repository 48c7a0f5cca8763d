"""Duplicate removal and pair differences.

De-duplication is an aggregation, not a window: ``min_by`` over the whole
row combines map-side, so a title holding a third of all rows costs one
partial row per input partition instead of one giant window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.diffs import diff_symmetric
from vitrine.operators.match import TIE_DECIMALS

DEFAULT_KEYS = ("title", "marketplace")
DEFAULT_ORDER = ("pair_id", "side", "product_id")


def _row_order(df: DataFrame, price_col: str, order) -> list:
    """Sort key ``price asc nulls last`` then the tie-break columns (nulls
    last), then every other column so the pick never depends on row order."""
    keys = [F.col(price_col).isNull(), F.col(price_col)]
    types = dict(df.dtypes)
    used = {price_col}
    for c in [c for c in order if c in df.columns] + sorted(df.columns):
        if c in used or c.startswith("_") or "map<" in types[c]:  # maps are not orderable
            continue
        used.add(c)
        keys += [F.col(c).isNull(), F.col(c)]
    return keys


def keep_cheapest(df: DataFrame, keys=DEFAULT_KEYS, price_col: str = "price", order=DEFAULT_ORDER) -> DataFrame:
    """One row per ``keys`` group, the cheapest; price ties go to the
    first row by ``order`` (the pair position when present)."""
    cols = df.columns
    if not cols:
        return df
    row = F.struct(*[F.col(c) for c in cols])
    rank = F.struct(*_row_order(df, price_col, order))
    picked = df.groupBy(*[F.col(k) for k in keys]).agg(F.min_by(row, rank).alias("_row"))
    return picked.select(*[F.col(f"_row.{c}").alias(c) for c in cols])


def keep_cheapest_exact(
    df: DataFrame,
    keys=DEFAULT_KEYS,
    price_col: str = "price",
    similarity_col: str = "similarity",
    order=DEFAULT_ORDER,
) -> DataFrame:
    """Like E1 but only rows whose similarity is 1.0 collapse; every other
    row survives. Computed cosines are compared at ``TIE_DECIMALS`` decimals,
    as the match compares them.

    Only the exact rows are shuffled; the others pass through a second
    branch, so ``df`` is read twice: give a scan or a materialised table
    (``session.cut_lineage``), not an expensive plan such as the match."""
    exact = F.round(similarity_col, TIE_DECIMALS) == 1.0
    collapsed = keep_cheapest(df.where(exact), keys, price_col, order)
    return collapsed.unionByName(df.where(~exact | F.col(similarity_col).isNull()))


def pair_difference(df: DataFrame, pair_col: str = "pair_id", price_col: str = "price",
                    out_col: str = "diff_pct") -> DataFrame:
    """Symmetric % difference (H8) between the two members of each pair,
    written on both rows; rows outside a complete pair get null. Groups hold
    two rows by construction, so the window never concentrates data; rows
    without a pair key (exclusives) bypass the window instead of forming
    one null-keyed partition. That bypass is a second branch over ``df``:
    give a scan or a materialised table, not an expensive plan."""
    w = Window.partitionBy(pair_col)
    # a pair that lacks a price has no difference: count prices, not rows
    lo, hi, n = F.min(price_col).over(w), F.max(price_col).over(w), F.count(price_col).over(w)
    paired = df.where(F.col(pair_col).isNotNull()).withColumn(
        out_col, F.when(n == 2, diff_symmetric(lo, hi))
    )
    alone = df.where(F.col(pair_col).isNull()).withColumn(out_col, F.lit(None).cast("double"))
    return paired.unionByName(alone)
