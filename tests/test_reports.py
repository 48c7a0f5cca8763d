"""Reports, statistics, views, export and pages (K1-K9, D*, A*, B10-B17)."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import metrics as M
from vitrine.plans import reports as R
from vitrine.schema import Labels, Levels
from vitrine.session import ensure_checkpoint_dir
from vitrine.sources import pages as P
from vitrine.sources import sinks as SK

CAT = "product_id long, title string, price double, url string, embedding array<float>"
BENCH = ("title string, marketplace string, price double, url string, exclusivity string, similarity double, "
         "similarity_level string, diff_pct double")


def test_statistics_t25_t26(spark):
    df = spark.createDataFrame(
        [("produto1", "competitor", 100.0, "u", "não", 0.9, "muito similar", None),
         ("produto2", "own", 150.0, "u", "não", 0.7, "moderadamente similar", None),
         ("produto3", "competitor", 200.0, "u", "sim", -1.0, "exclusivo", None)], BENCH)
    s = M.report_statistics(df, Labels()).first()
    assert (s.total_products, s.source_products, s.target_products) == (3, 2, 1)
    assert (s.exclusive_products, s.paired_products) == (1, 2)
    assert (s.very_similar, s.moderately_similar, s.exclusive_level) == (1, 1, 1)
    e = M.report_statistics(spark.createDataFrame([], BENCH), Labels()).first()
    assert (e.total_products, e.source_products, e.target_products) == (0, 0, 0)


def test_statistics_and_export_t27_t30(spark, tmp_path):
    df = spark.createDataFrame(
        [("Smartphone Samsung", "competitor", 1299.0, "http://competitor.example/1", "não", 0.92, "muito similar", 8.5),
         ("Smartphone iPhone", "own", 1350.0, "http://own.example/1", "não", 0.92, "muito similar", 8.5)], BENCH)
    s = M.report_statistics(df, Labels()).first()
    assert (s.total_products, s.paired_products, s.very_similar) == (2, 2, 2)
    path = SK.export_report(df, str(tmp_path / "report"))
    back = SK.read_report(spark, path)
    assert back.columns == ["title", "marketplace", "price", "url", "exclusivity"]
    assert sorted(back.collect()) == sorted(df.select(*back.columns).collect())


def test_report_columns_t28_and_view_t29(spark):
    df = spark.createDataFrame([("produto1", 100, "http://test.com", 0.8, "muito similar", 10.5)],
                               "title string, price long, url string, similarity double, similarity_level string, "
                               "diff_pct double")
    visible, hidden = R.report_columns(df)
    assert visible == ["title", "price", "url"] and hidden == ["similarity", "similarity_level", "diff_pct"]
    assert SK.register_view(df, "tempview_test") == "tempview_test"
    assert spark.sql("SELECT count(*) AS n FROM tempview_test").first().n == 1


def test_analytical_business_match_reports(spark):
    a = spark.createDataFrame([(0, "a", 110.0, "/a", [1.0, 0.0]), (1, "b", 50.0, "/b", [0.0, 1.0])], CAT)
    b = spark.createDataFrame([(5, "c", 100.0, "/c", [1.0, 0.05])], CAT)
    k1 = R.analytical_report(a, b, 0.8).collect()
    assert [r.source_id for r in k1] == [0, 1]  # by similarity descending
    assert k1[0].diff_pct == pytest.approx(10.0) and not k1[0].is_exclusive
    assert k1[1].is_exclusive and k1[1].target_title is None and k1[1].diff_pct is None
    k2 = R.business_report(R.analytical_report(a, b, 0.8, ordered=False), Labels()).collect()
    assert len(k2) == 3
    tgt = [r for r in k2 if r.marketplace == "own"][0]
    assert tgt.url == "" and tgt.title == "a" and tgt.price == 100.0 and tgt.diff_pct_text == "10.00%"
    assert [r.diff_pct_text for r in k2 if r.exclusivity == "sim"] == ["N/A"]
    k3 = {r.source_id: r for r in R.match_report(a, b, 0.8, Labels()).collect()}
    assert k3[0].marketplace == "own" and k3[0].diff_pct == pytest.approx(10.0)
    assert k3[1].marketplace == "competitor" and k3[1].diff_pct == 0.0 and k3[1].exclusivity == "sim"
    ex = R.exclusives_listing(R.business_report(R.analytical_report(a, b, 0.8, ordered=False))).collect()
    assert [(r.title, r.price, r.url) for r in ex] == [("b", 50.0, "/b")]


def test_benchmark_and_kpis(spark):
    lab = Labels()
    a = spark.createDataFrame([(0, "x", 100.0, "/x", [1.0, 0.0]), (2, "y", 300.0, "/y", [0.0, 1.0])], CAT)
    b = spark.createDataFrame([(1, "x2", 90.0, "/x2", [1.0, 0.1]), (3, "z", 10.0, "/z", [-1.0, 0.0]),
                               (5, "w", 400.0, "/w", [0.0, 1.0])], CAT)
    bench = R.benchmark_table(a, b, lab, Levels(0.9, 0.5)).collect()
    assert bench[0].exclusivity == "sim" and bench[0].similarity == -1.0  # exclusives first
    assert len(bench) == 5
    bdf = R.benchmark_table(a, b, lab, Levels(0.9, 0.5), ordered=False)
    k = M.kpi_row(bdf, lab).first()
    assert k.paired_products == 2.0 and k.target_cheaper == 1 and k.source_cheaper == 1
    assert k.share_target_cheaper == 0.5 and k.target_advantage == 0.0
    pt = M.pair_table(bdf, lab).collect()
    assert sorted(r.advantage for r in pt) == ["competitor Mais Barata", "own Mais Barata"]


def test_extract_links_and_cut(spark):
    pages = spark.createDataFrame(
        [(1, '<a href="/p1"> Foo <b>Bar</b></a><a class="c" href="http://x/p2">Baz</a>')], "page_id long, html string")
    links = P.extract_links(pages).orderBy("pos").collect()
    assert [(r.pos, r.href, r.title) for r in links] == [(1, "/p1", "FooBar"), (2, "http://x/p2", "Baz")]
    stats = spark.createDataFrame([("c1", 1, 3, False), ("c1", 2, 0, False), ("c1", 3, 5, False),
                                   ("c2", 1, 2, False), ("c2", 2, 4, True), ("c3", 1, 1, False)],
                                  "category string, page int, n_cards int, failed boolean")
    kept = sorted((r.category, r.page) for r in P.crawl_cut(stats, failed_col="failed").collect())
    assert kept == [("c1", 1), ("c2", 1), ("c3", 1)]
    plan = spark.createDataFrame([("tv", "https://s/tv?page={}", 3)], "category string, template string, max_pages int")
    urls = [r.page_url for r in P.crawl_plan(plan).orderBy("page").collect()]
    assert urls == ["https://s/tv?page=1", "https://s/tv?page=2", "https://s/tv?page=3"]


def test_listing_validity(spark):
    df = spark.createDataFrame([("t", 1.0, "/l"), ("t", 0.0, "/l"), ("", 1.0, "/l"), ("t", None, None)],
                               "title string, price double, link string")
    rows = df.select(P.listing_valid(F.col("title"), F.col("price"), F.col("link"), "strict").alias("s"),
                     P.listing_valid(F.col("title"), F.col("price"), F.col("link"), "lenient").alias("l")).collect()
    assert [(r.s, r.l) for r in rows] == [(True, True), (False, True), (False, False), (False, False)]


def test_sink_by_category_keeps_absent_categories(spark):
    path = ensure_checkpoint_dir(spark) + "/bronze-test"
    SK.save_by_category(spark.createDataFrame([("a", "tv"), ("b", "pc")], "title string, category string"), path)
    SK.save_by_category(spark.createDataFrame([("c", "tv")], "title string, category string"), path)
    got = sorted((r.title, r.category) for r in spark.read.parquet(path).collect())
    assert got == [("b", "pc"), ("c", "tv")]


def test_drop_empty_rows(spark):
    df = spark.createDataFrame([("", None), (" ", "x"), (None, None)], "a string, b string")
    assert SK.drop_empty_rows(df).count() == 1


def test_validate_run(spark):
    from vitrine.operators.checks import validate_run

    ok = spark.createDataFrame([], CAT)
    validate_run(ok, ok, 0.8)
    with pytest.raises(ValueError):
        validate_run(ok.drop("url"), ok, 0.8)
    with pytest.raises(ValueError):
        validate_run(ok, ok, 1.5)
    with pytest.raises(ValueError):
        validate_run(ok, ok, 0.8, Levels(very=0.4, moderate=0.6))


def test_slicers_and_pair_analysis(spark):
    df = spark.createDataFrame(
        [("x", "own", 90.0, "u", "não", 0.9, "muito similar", 5.0),
         ("y", "competitor", 95.0, "u", "não", 0.9, "muito similar", 5.0),
         ("z", "own", 900.0, "u", "sim", -1.0, "exclusivo", None)], BENCH)
    assert R.slice_benchmark(df, marketplace="own", levels=["muito similar"], band="Até R$ 100").count() == 1
    assert R.slice_benchmark(df).count() == 3
    bench = df.withColumn("pair_id", F.when(F.col("exclusivity") == "não", F.lit(7)).cast("long")).withColumn(
        "product_id", F.monotonically_increasing_id())
    pa = R.pair_analysis(bench, Labels()).collect()
    assert len(pa) == 1 and pa[0].advantage == "own Mais Barata" and pa[0].price_band == "Até R$ 100"


def test_ingest_pages_job(spark):
    pages = spark.createDataFrame(
        [(1, "tv", 1, '<a href="/a">A</a><a href="/b">B</a>'), (2, "tv", 2, "<p>none</p>"),
         (3, "tv", 3, '<a href="/c">C</a>'), (4, "pc", 1, '<a href="http://x/d">D</a>')],
        "page_id long, category string, page int, html string")
    path = ensure_checkpoint_dir(spark) + "/ingest-test"
    got = sorted((r.category, r.title, r.url) for r in P.ingest_pages(pages, path, domain="https://s").collect())
    assert got == [("pc", "D", "http://x/d"), ("tv", "A", "https://s/a"), ("tv", "B", "https://s/b")]


def test_orders_with_ties(spark):
    """The stated order, ties included, whatever order the rows come in."""
    rows = [(3, "b", 5.0, "/3", [1.0, 0.0]), (1, "b", None, "/1", [1.0, 0.0]), (2, "a", 7.0, "/2", [0.6, 0.8]), (4, "b", 5.0, "/4", [1.0, 0.0])]
    tgt = spark.createDataFrame([(9, "t", 1.0, "/t", [1.0, 0.0])], CAT)
    for order in (rows, rows[::-1]):
        src = spark.createDataFrame(order, CAT).repartition(3)
        assert [r.source_id for r in R.analytical_report(src, tgt, 0.5).collect()] == [1, 3, 4, 2]
        assert [r.source_id for r in R.match_report(src, tgt, 0.5).collect()] == [2, 3, 4, 1]
    bench = [("b", "own", 5.0, "u2", "sim", -1.0, "muito similar", None), ("a", "own", 5.0, "u9", "sim", -1.0, "muito similar", None),
             ("b", "own", 5.0, "u1", "sim", -1.0, "muito similar", None), ("z", "own", 9.0, "u", "sim", -1.0, "muito similar", None),
             ("c", "competitor", None, "u", "sim", -1.0, "muito similar", None)]
    for order in (bench, bench[::-1]):
        view = SK.register_view(spark.createDataFrame(order, BENCH).repartition(3), "ties")
        want = [("z", "u"), ("a", "u9"), ("b", "u1"), ("b", "u2"), ("c", "u")]
        assert [(r.title, r.url) for r in R.very_similar_by_price(spark, view).collect()] == want
        assert [(r.title, r.url) for r in R.exclusives_by_price(spark, view).collect()] == want
