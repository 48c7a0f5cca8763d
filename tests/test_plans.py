"""Plan checks: scalar queries stay in the JVM, nothing plans a cartesian
product, scans read only the columns they need."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF")
SCALAR_ONLY = ["price_parse_nullable", "price_parse_digits", "price_parse_first_token", "url_prefix",
               "url_relative", "url_absolute", "page_links", "category_from_title", "price_band",
               "catalog_filter", "catalog_prepare", "crawl_plan", "first_empty_page", "gap_trend",
               "dedupe_cheapest", "encode_titles", "catalog_union", "input_counts"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SCALAR_ONLY)
def test_scalar_queries_have_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not [n for n in PYTHON_NODES if n in plan], plan


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_product_and_match_runs_once(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a query that needs the match twice reads it from a written table
    assert plan.count("MapInPandas ") <= 1, plan


def test_match_is_one_python_stage_and_scans_are_pruned(spark):
    df = E.queries()["best_match"](spark, SF)
    plan = _plan(df)
    assert plan.count("MapInPandas") == 1
    # both sides share one shuffle that places block pairs directly
    placed = plan.count("shufflepartitionidpassthrough") + plan.count("Exchange SinglePartition, REPARTITION_BY_NUM")
    assert placed == 1 and "hashpartitioning(sb" not in plan
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in df._jdf.queryExecution().toString() or \
        "struct<vec_id:bigint,embedding:array<float>>" in plan
    assert "p_name" not in plan and "p_retailprice" not in plan  # part is read for the join key only
