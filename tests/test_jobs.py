"""End-to-end runs: the comparison run (K1, K2, K7 with sinks) and the
benchmark run (K4, export, view, statistics) on the sf0.001 tables, checked
against the same reports built directly."""

from pyspark.sql import functions as F

from vitrine.plans import registry as RG
from vitrine.plans.jobs import benchmark_catalogs, compare_catalogs
from vitrine.plans.reports import analytical_report, benchmark_table, business_report
from vitrine.schema import Labels
from vitrine.sources.sinks import read_report
from vitrine.sources.tables import products, split_catalogs

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=repr)


def _catalogs(spark):
    return split_catalogs(products(spark, SF, RG.LABELS), RG.LABELS)


def test_comparison_run(spark, tmp_path):
    s, t = _catalogs(spark)
    run = compare_catalogs(s, t, str(tmp_path / "out"), threshold=RG.THRESHOLD, labels=RG.LABELS)
    direct = analytical_report(s, t, RG.THRESHOLD, ordered=False)
    cols = direct.columns
    assert _rows(run.analytical, cols) == _rows(direct, cols)
    bcols = ["source_id", "side", "marketplace", "price", "exclusivity", "diff_pct_text"]
    assert _rows(run.business, bcols) == _rows(business_report(direct, RG.LABELS), bcols)
    n_excl = run.business.where(F.col("exclusivity") == "sim").count()
    assert run.exclusives_count.first().n_exclusive == n_excl == run.exclusives.count() > 0
    back = spark.read.option("header", True).csv(run.exports["analytical"])
    assert back.count() == s.count() and set(back.columns) == set(cols)
    assert spark.read.option("header", True).csv(run.exports["business"]).count() == run.business.count()


def test_comparison_run_encodes_titles_without_vectors(spark, tmp_path):
    s, t = _catalogs(spark)
    run = compare_catalogs(s.drop("embedding"), t.drop("embedding"), str(tmp_path / "enc"), threshold=0.5,
                           labels=RG.LABELS)
    got = run.analytical.collect()
    assert len(got) == s.count() and all(0.0 <= r.similarity <= 1.0 + 1e-9 for r in got)


def test_benchmark_run(spark, tmp_path):
    s, t = _catalogs(spark)
    run = benchmark_catalogs(s, t, str(tmp_path / "bench"), RG.LABELS, RG.LEVELS, view="bench_run_view")
    direct = benchmark_table(s, t, RG.LABELS, RG.LEVELS, ordered=False)
    cols = direct.columns
    assert _rows(run.benchmark, cols) == _rows(direct, cols)
    n = run.benchmark.count()
    assert spark.sql(f"SELECT count(*) AS n FROM {run.view}").first().n == n
    assert run.statistics.first().total_products == n
    exported = read_report(spark, run.export_path)
    assert exported.count() == n and exported.columns == ["title", "marketplace", "price", "url", "exclusivity"]
    # the view reads the written table: no Python match stage under it
    plan = spark.sql(f"SELECT * FROM {run.view}")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan


def test_command_line_runs(spark, tmp_path):
    """``python -m vitrine compare|benchmark`` over parquet catalogs."""
    from vitrine.__main__ import main

    s, t = _catalogs(spark)
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    s.select("product_id", "title", "price", "url", "embedding").write.parquet(src)
    t.select("product_id", "title", "price", "url", "embedding").write.parquet(tgt)
    out = main(["compare", src, tgt, str(tmp_path / "cmp"), "--threshold", str(RG.THRESHOLD)], spark)
    assert spark.read.parquet(out["analytical"]).count() == s.count()
    out = main(["benchmark", src, tgt, str(tmp_path / "bm"), "--very", "0.45", "--moderate", "0.35",
                "--view", "cli_bench"], spark)
    direct = benchmark_table(s, t, Labels(), RG.LEVELS, ordered=False)
    assert spark.sql("SELECT count(*) AS n FROM cli_bench").first().n == direct.count()


def test_a_job_leaves_no_intermediate_tables(spark, tmp_path):
    import os

    from vitrine.session import ensure_checkpoint_dir, scratch_tables

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    s, t = _catalogs(spark)
    before = set(os.listdir(folder))
    run = benchmark_catalogs(s.drop("embedding"), t.drop("embedding"), str(tmp_path / "b"), RG.LABELS, RG.LEVELS, view="clean_view")
    assert set(os.listdir(folder)) == before and run.benchmark.count() == spark.table("clean_view").count() > 0
    try:
        with scratch_tables(spark):
            RG.cut_lineage(spark.range(3))
            assert len(os.listdir(folder)) == len(before) + 1
            raise RuntimeError
    except RuntimeError:
        pass
    assert set(os.listdir(folder)) == before
    benchmark_catalogs(s, t, str(tmp_path / "b"), RG.LABELS, RG.LEVELS, view="clean_view")  # a second run: the next version
    assert spark.table("clean_view").count() > 0 and run.benchmark.count() > 0
