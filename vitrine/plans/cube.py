"""One cube for the dashboard's slicers and KPIs.

Every slicer filters the benchmark table by marketplace, level, price band or category, and every
card is a sum, a count or a quotient of two. The cube holds the sums and counts of all
combinations of these dimensions (grouping sets in one pass over the table), a few thousand rows
whatever the table's size, so a dashboard reads those instead of the table. All measures add up: cubes
of parts of a table, or of several snapshots, merge by summing. A pair stands in the table
with up to two rows; its price comparison is counted on its target row only, as in the KPIs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.labels import normalise_flag, price_band
from vitrine.schema import LEVEL_LOW, LEVEL_MODERATE, LEVEL_VERY, NO, YES, Labels

DIMENSIONS = ("marketplace", "similarity_level", "price_band", "category")
COUNTS = ("rows", "exclusive", "paired_rows", "priced", "diffs", "target_pairs", "target_cheaper", "source_cheaper", "favourable")
SUMS = ("price_sum", "diff_sum", "favourable_sum")


def _measures(labels: Labels) -> list:
    mk, ex = F.col("marketplace"), normalise_flag("exclusivity")
    price, partner, diff = (F.col(c) for c in ("price", "partner_price", "diff_pct"))
    paired = ex == NO
    on_target = (mk == labels.target) & paired
    cheaper, dearer = on_target & (price < partner), on_target & (price > partner)
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return [
        F.count(F.lit(1)).alias("rows"), count(ex == YES).alias("exclusive"), count(paired).alias("paired_rows"),
        F.count("price").alias("priced"), count(paired & diff.isNotNull()).alias("diffs"), count(on_target).alias("target_pairs"),
        count(cheaper).alias("target_cheaper"), count(dearer).alias("source_cheaper"), count(cheaper & diff.isNotNull()).alias("favourable"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("price_sum"), F.coalesce(F.sum(F.when(paired, diff)), F.lit(0.0)).alias("diff_sum"),
        F.coalesce(F.sum(F.when(cheaper, diff)), F.lit(0.0)).alias("favourable_sum"),
    ]


def build_cube(bench: DataFrame, labels: Labels = Labels(), band=None) -> DataFrame:
    """The cube of a benchmark table that has ``category`` (and
    ``partner_price``): one row per combination of values, for every subset of the
    dimensions. ``over`` has a bit per dimension (marketplace 8, level 4, band 2, category 1) that is
    summed over and null; a null value of a dimension that is not summed over is a value."""
    rows = bench.withColumn("price_band", price_band("price") if band is None else band)
    return rows.cube(*DIMENSIONS).agg(F.grouping_id().cast("int").alias("over"), *_measures(labels))


def merge_cubes(cubes: DataFrame, *keep: str) -> DataFrame:
    """Cubes as one: of several parts, or (without ``keep``) of all snapshots."""
    return cubes.groupBy(*keep, *DIMENSIONS, "over").agg(*[F.sum(c).alias(c) for c in (*COUNTS, *SUMS)])


def append_cube(cube: DataFrame, path: str, snapshot_day: str, run_id: str = "") -> None:
    """Add a snapshot's cube to the history; a repeated run replaces its own rows."""
    out = cube.withColumns({"snapshot_day": F.lit(snapshot_day).cast("date"), "run_id": F.lit(run_id or "run")})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_day", "run_id").parquet(path)


def slice_cube(cube: DataFrame, by=(), **picked) -> DataFrame:
    """The cube's rows for a slicer setting: dimensions in ``by`` stay apart, those in
    ``picked`` have a value or a list of values, all others are summed over. Reads
    the one grouping set that has these dimensions."""
    used = set(by) | set(picked)
    if unknown := used - set(DIMENSIONS):
        raise ValueError(f"no dimension {sorted(unknown)}")
    over = sum(1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS) if d not in used)
    out = cube.where(F.col("over") == over)
    for d, value in picked.items():
        values = list(value) if isinstance(value, (list, tuple, set)) else [value]
        out = out.where(reduce(lambda a, b: a | b, [F.col(d).eqNullSafe(F.lit(v)) for v in values], F.lit(False)))
    return out.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*COUNTS, *SUMS)])


def cube_cards(sliced: DataFrame) -> DataFrame:
    """Averages of slices: ``avg_price``, ``avg_diff_pct``, ``favourable_gap``, ``pairs``."""
    return sliced.withColumns({
        "avg_price": F.try_divide("price_sum", "priced"), "avg_diff_pct": F.try_divide("diff_sum", "diffs"),
        "favourable_gap": F.try_divide("favourable_sum", "favourable"), "pairs": F.col("paired_rows") / 2})


def cube_kpis(cube: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """The KPI row (K8, without the report's own figures) from a cube."""
    cells = slice_cube(cube, by=("marketplace", "similarity_level"))

    def total(c, where=F.lit(True)):
        return F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0))

    tgt, src, level = F.col("marketplace") == labels.target, F.col("marketplace") == labels.source, F.col("similarity_level")
    pairs = total("paired_rows") / 2
    share = lambda c: F.coalesce(F.try_divide(total(c).cast("double"), pairs), F.lit(0.0))
    avg_t, avg_s = (F.try_divide(total("price_sum", w), total("priced", w)) for w in (tgt, src))
    out = cells.agg(
        total("rows").alias("total_products"), total("rows", tgt).alias("total_target"), total("rows", src).alias("total_source"),
        total("exclusive", tgt).alias("exclusive_target"), total("exclusive", src).alias("exclusive_source"), pairs.alias("paired_products"),
        avg_t.alias("avg_price_target"), avg_s.alias("avg_price_source"), F.try_divide(total("diff_sum"), total("diffs")).alias("avg_diff_pct"),
        total("target_cheaper").alias("target_cheaper"), total("source_cheaper").alias("source_cheaper"),
        share("target_cheaper").alias("share_target_cheaper"), share("source_cheaper").alias("share_source_cheaper"),
        F.coalesce(F.try_divide(avg_s - avg_t, avg_t), F.lit(0.0)).alias("avg_price_gap"),
        total("paired_rows").alias("paired_rows"), total("exclusive").alias("exclusive_rows"),
        total("rows", level == LEVEL_VERY).alias("very_similar"), total("rows", level == LEVEL_MODERATE).alias("moderately_similar"),
        total("rows", level == LEVEL_LOW).alias("little_similar"), F.try_divide(total("favourable_sum"), total("favourable")).alias("favourable_gap"))
    return out.withColumn("target_advantage", F.col("share_target_cheaper") - F.col("share_source_cheaper"))
