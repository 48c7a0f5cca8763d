"""De-duplication, pair differences, clean-up, preparation
on the reference's fixtures T5-T24."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from vitrine.operators.dedupe import keep_cheapest, keep_cheapest_exact, pair_difference
from vitrine.plans.reports import final_cleanup, prepare_catalog

TM = "title string, marketplace string, price long"
TMS = TM + ", similarity double"
FULL = "title string, marketplace string, price long, exclusivity string, similarity double"
CAT = "product_id long, title string, price double, url string"


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _prices(df, title=None, mk=None):
    rows = df.collect()
    return sorted(r.price for r in rows if (title is None or r.title == title) and (mk is None or r.marketplace == mk))


def test_dedupe_basic_t8(spark):
    df = _df(spark, [("produto1", "competitor", 100), ("produto1", "competitor", 90), ("produto2", "own", 150),
                     ("produto3", "competitor", 200)], TM)
    out = keep_cheapest(df)
    assert out.count() == 3 and _prices(out, "produto1") == [90]


@pytest.mark.parametrize("rows,n", [
    ([("produto1", "competitor", 100), ("produto1", "own", 150), ("produto2", "competitor", 200)], 3),
    ([("produto1", "competitor", 100), ("produto2", "own", 150), ("produto3", "competitor", 200)], 3),
    ([("Produto Único", "competitor", 100)], 1),
    ([("Produto Igual", "competitor", 100), ("Produto Igual", "competitor", 100)], 1),
])
def test_dedupe_counts_t9_t10_t14_t16(spark, rows, n):
    assert keep_cheapest(_df(spark, rows, TM)).count() == n


def test_dedupe_keeps_cheapest_t11_t12_t13(spark):
    g = _df(spark, [("Smartphone Galaxy", "competitor", 1200), ("Smartphone Galaxy", "competitor", 1100),
                    ("Smartphone Galaxy", "own", 1300)], TM)
    out = keep_cheapest(g)
    assert out.count() == 2 and _prices(out, mk="competitor") == [1100]
    m = _df(spark, [("Produto A", "competitor", 100), ("Produto A", "competitor", 80), ("Produto A", "own", 120),
                    ("Produto B", "competitor", 200), ("Produto B", "own", 180)], TM)
    out = keep_cheapest(m)
    assert out.count() == 4 and _prices(out, "Produto A", "competitor") == [80]
    o = keep_cheapest(_df(spark, [("Produto Teste", "competitor", p) for p in (500, 300, 400)], TM))
    assert [r.price for r in o.collect()] == [300]


def test_dedupe_empty_t15(spark):
    out = keep_cheapest(_df(spark, [], TM))
    assert out.count() == 0 and out.columns == ["title", "marketplace", "price"]


def test_dedupe_exact_similarity_t17_to_t20(spark):
    t17 = _df(spark, [("Produto Identico", "competitor", 100, 1.0), ("Produto Identico", "competitor", 80, 1.0),
                      ("Produto Diferente", "own", 150, 0.8)], TMS)
    out = keep_cheapest_exact(t17)
    assert out.count() == 2 and _prices(out, mk="competitor") == [80]
    t18 = _df(spark, [("Produto Identico", "competitor", 100, 1.0), ("Produto Identico", "own", 120, 1.0),
                      ("Produto Outro", "competitor", 200, 0.8)], TMS)
    assert keep_cheapest_exact(t18).count() == 3
    t19 = _df(spark, [("Produto Similar", "competitor", 100, 0.99), ("Produto Similar", "competitor", 80, 0.99),
                      ("Produto Outro", "own", 150, 0.8)], TMS)
    assert keep_cheapest_exact(t19).count() == 3
    t20 = _df(spark, [("Produto A", "competitor", 100, 1.0), ("Produto A", "competitor", 80, 1.0),
                      ("Produto B", "competitor", 200, 0.99), ("Produto B", "own", 180, 0.99),
                      ("Produto C", "competitor", 300, 0.8)], TMS)
    out = keep_cheapest_exact(t20)
    assert out.count() == 4 and _prices(out, "Produto A", "competitor") == [80] and len(_prices(out, "Produto B")) == 2


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["M", "B"]),
                          st.integers(1, 5)), max_size=12))
def test_dedupe_idempotent(spark, rows):
    df = _df(spark, rows, TM)
    once = keep_cheapest(df)
    assert sorted(once.collect()) == sorted(keep_cheapest(once).collect())
    assert once.count() == len({(t, m) for t, m, _ in rows})


def test_pair_difference_t7(spark):
    df = _df(spark, [(0, 100, 0.9), (0, 110, 0.9), (1, 200, 0.8), (1, 180, 0.8), (None, 50, -1.0)],
             "pair_id long, price long, similarity double")
    got = {(r.pair_id, r.price): r.diff_pct for r in pair_difference(df).collect()}
    assert got[(0, 100)] == pytest.approx(9.5238095, abs=1e-6) == got[(0, 110)]
    assert got[(1, 200)] == pytest.approx(10.526315789473685, abs=1e-9)
    assert got[(None, 50)] is None


def test_final_cleanup_t21(spark):
    df = _df(spark, [("produto1", "competitor", 100, "não", 0.8), ("produto1", "competitor", 90, "não", 0.8),
                     ("produto2", "own", 150, "não", 0.9), ("produto3", "competitor", 200, "sim", -1.0)], FULL)
    out = final_cleanup(df).collect()
    assert len(out) == 3
    assert out[0].exclusivity == "sim" and out[0].similarity_level == "exclusivo"
    assert "diff_pct" in out[0].asDict() and "similarity_level" in out[0].asDict()


def test_final_cleanup_empty_t22(spark):
    out = final_cleanup(spark.createDataFrame([], T.StructType([])))
    assert out.count() == 0 and {"similarity_level", "diff_pct"} <= set(out.columns)


def test_final_cleanup_t23_t24(spark):
    t23 = _df(spark, [("Produto Identico", "competitor", 100, "não", 1.0), ("Produto Identico", "competitor", 80, "não", 1.0),
                      ("Produto Diferente", "own", 150, "não", 0.8)], FULL)
    out = final_cleanup(t23)
    assert out.count() == 2 and _prices(out, mk="competitor") == [80]
    t24 = _df(spark, [("Produto Identico", "competitor", 100, "não", 1.0), ("Produto Identico", "own", 120, "não", 1.0),
                      ("Produto Outro", "competitor", 200, "sim", -1.0)], FULL)
    out = final_cleanup(t24)
    assert out.count() == 3 and len(_prices(out, mk="competitor")) == 2


def test_prepare_catalog_t5_t6(spark):
    df = _df(spark, [("produto1", "R$ 100,00", [1, 2, 3]), ("produto2", "R$ 200,00", [4, 5, 6])],
             "title string, price string, embedding array<long>")
    out = prepare_catalog(df, "competitor").orderBy("title").collect()
    assert len(out) == 2 and out[0].marketplace == "competitor" and out[0].price == 100.0
    df6 = _df(spark, [("produto1", "R$ 100,00", [1, 2, 3]), ("produto2", "R$ 200,00", None)],
              "title string, price string, embedding array<long>")
    out6 = prepare_catalog(df6, "own").collect()
    assert len(out6) == 1 and out6[0].marketplace == "own"
    num = _df(spark, [("x", 1299.0, [1.0])], "title string, price double, embedding array<double>")
    assert prepare_catalog(num, "A").first().price == 1299.0


def test_dedupe_with_map_and_array_columns(spark):
    df = spark.createDataFrame([("a", "M", 2, {"k": 1}, [1.0]), ("a", "M", 1, {"k": 2}, [2.0])],
                               "title string, marketplace string, price long, props map<string,int>, v array<double>")
    out = keep_cheapest(df).collect()
    assert len(out) == 1 and out[0].price == 1 and out[0].props == {"k": 2}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_title_collapses_map_side(spark):
    """A third of all rows share one (title, marketplace): the pick is still
    the cheapest (lowest id on a price tie), and the plan aggregates
    partially before the shuffle, so the hot group leaves each input
    partition as one row instead of gathering in one task."""
    from pyspark.sql import functions as F

    n = 3000
    df = spark.range(n).repartition(8).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("title"),
        F.lit("A").alias("marketplace"),
        (F.lit(5000) - F.col("id") % 1000).alias("price"),
    )
    out = keep_cheapest(df, order=("product_id",))
    rows = {r.title: r for r in out.collect()}
    assert len(rows) == 1 + 2 * n // 3
    # hot rows are ids 0, 3, ..., 2997: price 4001 is the lowest, first at id 999
    assert (rows["hot"].price, rows["hot"].product_id) == (4001, 999)
    plan = _plan(out)
    assert "partial_min_by" in plan and plan.index("partial_min_by") > plan.index("Exchange")  # below it


def test_unpaired_rows_bypass_the_pair_window(spark):
    """A third of the rows carry no pair key: they get a null diff without
    passing through the window, and pairs keep their symmetric diff."""
    from pyspark.sql import functions as F

    from vitrine.operators.metrics import with_partner_price
    from vitrine.schema import Labels

    lab = Labels("A", "B")
    n = 900
    df = spark.range(n).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") / 3 * 3 + F.when(F.col("id") % 3 == 2, -1).otherwise(0)).cast("long").alias("pair_id"),
        F.when(F.col("id") % 3 == 2, F.lit("B")).otherwise(F.lit("A")).alias("marketplace"),
        F.lit("sim").alias("exclusivity"),
        (F.col("id") % 3 * 50 + 100).cast("double").alias("price"),
    )
    diffs = pair_difference(df)
    got = diffs.collect()
    assert len(got) == n
    assert all(r.diff_pct is None for r in got if r.pair_id is None)
    paired = [r for r in got if r.pair_id is not None]
    assert len(paired) == 2 * n // 3
    assert all(r.diff_pct == pytest.approx(50 / 175 * 100) for r in paired)  # 150 vs 200
    partner = {r.product_id: r.partner_price for r in with_partner_price(df, lab).collect()}
    assert all(partner[i] is None for i in range(0, n, 3))
    assert all(partner[i] == 200.0 and partner[i + 1] == 150.0 for i in range(1, n, 3))
    # one window, in the branch of the pair rows; unpaired rows are the
    # other branch of the union
    final = _plan(diffs).split("== Initial Plan ==")[0]
    assert final.count("Window [") == 1 and "Union" in final


def test_pairs_stay_whole_when_a_member_is_dropped(spark):
    from vitrine.operators import metrics as M
    from vitrine.operators.match import matched_pairs, pair_rows

    a = spark.createDataFrame([(0, "TV", 100.0, "/a"), (2, "TV", 90.0, "/b"), (4, None, None, None)], CAT)
    b = spark.createDataFrame([(1, "TV LG", 80.0, "/c"), (3, "TV LG", None, "/d")], CAT)
    best = spark.createDataFrame([(0, 1, 0.9), (2, 1, 0.8), (4, 3, 0.7)], "source_id long, target_id long, similarity double")
    view = {r.pair_id: r for r in M.pair_view(matched_pairs(a, b, best)).collect()}
    assert set(view) == {0, 2, 4} and (view[2].source_price, view[2].target_price) == (90.0, 80.0)
    assert view[4].target_title == "TV LG" and view[4].advantage is None
    kept = {r.product_id: r for r in keep_cheapest(pair_rows(a, b, best)).collect()}
    # product 0 is gone as the dearer "TV"; the target of its pair still knows its price
    assert set(kept) == {1, 2, 4} and kept[1].partner_price == 100.0 and kept[2].partner_price == 80.0


def test_cheapest_keeps_maps_and_hidden_columns(spark):
    rows = [("t", "m", 2.0, {"k": 1}, 7), ("t", "m", 1.0, {"k": 2}, 8), (None, "m", None, None, None)]
    df = spark.createDataFrame(rows, "title string, marketplace string, price double, extra map<string,int>, _tag int")
    got = {r.title: (r.price, r.extra, r._tag) for r in keep_cheapest(df).collect()}
    assert got == {"t": (1.0, {"k": 2}, 8), None: (None, None, None)}
    got = {r["title"]: (r["price"], r["_tag"]) for r in keep_cheapest(df.drop("extra")).collect()}
    assert got == {"t": (1.0, 8), None: (None, None)}


def test_kpi_row_takes_the_report_into_one_aggregate(spark):
    from vitrine.operators import metrics as M
    from vitrine.schema import Labels

    lab = Labels()
    bench = spark.createDataFrame(
        [(lab.source, "não", 10.0, 8.0, "muito similar", 20.0), (lab.target, "não", 8.0, 10.0, "muito similar", 20.0),
         (lab.target, "sim", 5.0, None, "exclusivo", None)],
        "marketplace string, exclusivity string, price double, partner_price double, similarity_level string, diff_pct double")
    report = spark.createDataFrame([(True, 0.0), (False, 0.9), (False, 0.5), (False, 0.95)], "is_exclusive boolean, similarity double")
    k = M.kpi_row(bench, lab, analytical=report, very=0.85).first()
    assert (k.total_products, k.paired_rows, k.exclusive_rows, k.very_similar, k.favourable_gap) == (3, 2, 1, 2, 20.0)
    assert (k.coverage, k.quality, k.opportunities, k.target_cheaper) == (0.75, 0.5, 1, 1)
    empty = M.kpi_row(bench.limit(0), lab, analytical=report.limit(0)).first()
    assert (empty.total_products, empty.coverage, empty.opportunities) == (0, 0.0, 0)
