"""Inputs that earlier lost rows or changed values."""

import pytest

from vitrine.operators.dedupe import keep_cheapest_exact, pair_difference
from vitrine.operators.filters import keep_priced
from vitrine.operators.match import best_match
from vitrine.plans.jobs import compare_catalogs
from vitrine.sources.pages import crawl_cut, crawl_plan, extract_links
from vitrine.sources.sinks import export_report, read_report
from vitrine.sources.tables import products, read_table


def test_csv_keeps_quotes_line_breaks_and_blanks(spark, tmp_path):
    rows = [('TV 55"', "A", 1.5, " u ", "sim"), ("two\nlines, one", "B", None, None, "não"), ("  lead", "A", 2.0, 'say "hi"', "não")]
    df = spark.createDataFrame(rows, "title string, marketplace string, price double, url string, exclusivity string")
    back = read_report(spark, export_report(df, str(tmp_path / "csv"), hidden=[]))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_crawl_plan_and_cut(spark):
    plan = crawl_plan(spark.createDataFrame([("a", "x{}", 0), ("b", "y{}", 2)], "category string, template string, max_pages int"))
    assert [(r.category, r.page_url) for r in plan.orderBy("page").collect()] == [("b", "y1"), ("b", "y2")]
    rows = [(None, 1, 3), (None, 2, 0), (None, 3, 4), ("a", 1, 2), ("a", None, 5), ("a", 2, 0)]
    kept = crawl_cut(spark.createDataFrame(rows, "category string, page int, n_cards int")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(None, 1, 3), ("a", 1, 2), ("a", None, 5)], key=repr)


def test_links_in_any_quotes_and_case(spark):
    html = "<a href='/one'>One</a><A class=x HREF=\"/two\">Two</A><a data-href=\"/no\" href=\"/three\">Three</a><a data-href=\"/no\">None</a>"
    got = extract_links(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("pos").collect()
    assert [(r.href, r.title) for r in got] == [("/one", "One"), ("/two", "Two"), ("/three", "Three")]


def test_prices_that_are_no_plain_decimals(spark):
    df = spark.createDataFrame([(t,) for t in ("12d", "1e5", " 7.5 ", "NaN", "-3", None)], "price string")
    assert sorted(r.price for r in keep_priced(df).collect()) == [-3.0, 7.5]


def test_vectors_that_are_no_vectors(spark):
    nan = float("nan")
    s = spark.createDataFrame([(1, [1.0, 0.0]), (2, [nan, 1.0]), (3, None), (4, [])], "product_id long, embedding array<double>")
    t = spark.createDataFrame([(10, [nan, 0.0]), (11, [1.0, 0.1]), (12, [None, 1.0])], "product_id long, embedding array<double>")
    assert [(r.source_id, r.target_id) for r in best_match(s, t).collect()] == [(1, 11)]


def test_pair_without_a_price_has_no_difference(spark):
    df = spark.createDataFrame([(1, 10.0), (1, None), (2, 10.0), (2, 30.0)], "pair_id long, price double")
    assert {(r.pair_id, r.diff_pct) for r in pair_difference(df).collect()} == {(1, None), (2, 100.0)}


def test_computed_scores_of_one_collapse(spark):
    df = spark.createDataFrame([("t", "A", 2.0, 0.9999999999999998), ("t", "A", 1.0, 1.0), ("t", "A", 0.5, 0.99)],
                               "title string, marketplace string, price double, similarity double")
    assert sorted(r.price for r in keep_cheapest_exact(df).collect()) == [0.5, 1.0]


def test_products_hold_every_part_and_vector(spark):
    sf = "/root/testdata/sf0.001"
    ids = {r[0] for r in read_table(spark, sf, "part").select("p_partkey").collect()} | {
        r[0] for r in read_table(spark, sf, "embeddings").select("vec_id").collect()}
    got = [r.product_id for r in products(spark, sf).select("product_id").collect()]
    assert len(got) == len(ids) and set(got) == ids


def test_comparison_run_fails_early(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "1", "u")], "product_id long, title string, price string, url string")
    with pytest.raises(ValueError):
        compare_catalogs(df, df, str(tmp_path), threshold=2.0)
    with pytest.raises(ValueError):
        compare_catalogs(df.drop("url"), df, str(tmp_path))
