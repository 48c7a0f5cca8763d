"""Every slicer setting and the KPIs from the cube equal the scan of the table."""

import itertools

import pytest
from pyspark.sql import functions as F

from vitrine.functions.labels import price_band
from vitrine.operators import metrics as M
from vitrine.plans import cube as C
from vitrine.plans import registry as RG

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bench(spark):
    cat, _, _ = RG._catalogs(spark, SF)
    b = RG._benchmark(spark, SF).join(cat.select("product_id", F.substring("category", 1, 5).alias("category")), "product_id")
    odd = b.limit(9).withColumns({"category": F.lit(None).cast("string"), "price": F.lit(None).cast("double"), "similarity_level": F.lit(None).cast("string")})
    return RG.cut_lineage(b.unionByName(odd), "bench")


def rounded(df, cols):
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.select(*cols).collect())


def test_slices_equal_the_scan(spark, bench):
    cube = C.build_cube(bench, RG.LABELS).cache()
    table = bench.withColumn("price_band", price_band("price"))
    values = {d: [r[0] for r in table.select(d).distinct().orderBy(F.col(d).asc_nulls_first()).limit(2).collect()] for d in C.DIMENSIONS}
    for n in range(3):
        for dims in itertools.combinations(C.DIMENSIONS, n):
            picked = {d: values[d] for d in dims[:1]} | {d: values[d][0] for d in dims[1:]}
            rows = table
            for d, v in picked.items():
                vs = v if isinstance(v, list) else [v]
                keep = F.lit(False)
                for x in vs:
                    keep = keep | F.col(d).eqNullSafe(F.lit(x))
                rows = rows.where(keep)
            by = [d for d in C.DIMENSIONS if d not in dims][:1]
            want = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(F.col("exclusivity") == "sim").alias("exclusive"), F.avg("price").alias("avg_price"),
                                         F.avg(F.when(F.col("exclusivity") == "não", F.col("diff_pct"))).alias("avg_diff_pct"),
                                         (F.count_if(F.col("exclusivity") == "não") / 2).alias("pairs"))
            cols = [*by, "rows", "exclusive", "avg_price", "avg_diff_pct", "pairs"]
            assert rounded(C.cube_cards(C.slice_cube(cube, by=by, **picked)), cols) == rounded(want, cols), (dims, by)
    with pytest.raises(ValueError):
        C.slice_cube(cube, by=("colour",))


def test_kpis_and_merging(spark, bench):
    want = M.kpi_row(bench, RG.LABELS)
    cube = C.build_cube(bench, RG.LABELS)
    assert rounded(C.cube_kpis(cube, RG.LABELS), want.columns) == rounded(want, want.columns)
    parts = [C.build_cube(bench.where(F.pmod(F.xxhash64("product_id"), F.lit(2)) == k), RG.LABELS) for k in (0, 1)]
    merged = C.merge_cubes(parts[0].unionByName(parts[1]))
    assert merged.count() == cube.count() and rounded(C.cube_kpis(merged, RG.LABELS), want.columns) == rounded(want, want.columns)
    empty = C.build_cube(bench.limit(0), RG.LABELS)
    assert rounded(C.cube_kpis(empty, RG.LABELS), want.columns) == rounded(M.kpi_row(bench.limit(0), RG.LABELS), want.columns)


def test_history_of_cubes(spark, bench, tmp_path):
    cube, path = C.build_cube(bench, RG.LABELS), str(tmp_path / "cubes")
    C.append_cube(cube, path, "2024-01-01", "a")
    C.append_cube(cube, path, "2024-01-02", "a")
    C.append_cube(cube, path, "2024-01-02", "a")  # repeated
    both = C.merge_cubes(spark.read.parquet(path))
    n = bench.count()
    assert C.slice_cube(both).first()["rows"] == 2 * n
    per_day = C.merge_cubes(spark.read.parquet(path), "snapshot_day")
    assert {r["rows"] for r in per_day.where("over = 15").collect()} == {n}
