"""A keyword table equals the chain of conditions, rule by rule."""

import time

import numpy as np
import pytest

from vitrine.functions.labels import CATEGORY_RULES, category_from_title
from vitrine.operators import keywords as K

RULES = "keyword string, category string, priority long"


def table(spark, rules):
    return spark.createDataFrame([(k, c, i) for i, (k, c) in enumerate(rules)], RULES)


@pytest.mark.parametrize("slice_rules", [1, 3, 100])
def test_table_equals_chain(spark, slice_rules):
    rng = np.random.default_rng(10)
    letters = list("abcAé ")
    rules = [("".join(rng.choice(letters, rng.integers(1, 4))), f"c{i % 5}") for i in range(12)] + CATEGORY_RULES
    titles = ["".join(rng.choice(letters, rng.integers(0, 9))) for _ in range(200)] + [None, "", "Suporte TV Notebook", "geladeira", "Geladeira"]
    df = spark.createDataFrame([(i, t, "other") for i, t in enumerate(titles)], "id long, title string, category string")
    got = K.categorise(df, table(spark, rules), out_col="found", slice_rules=slice_rules)
    assert got.columns == ["id", "title", "category", "found"]
    want = df.withColumn("found", category_from_title("title", rules))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id long, title string")
    odd = spark.createDataFrame([(None, "x", 0), ("", "any", 5), ("b", "late", 9), ("b", "early", 3), ("b", "equal", 3)], RULES)
    assert [r.category for r in K.categorise(df, odd).orderBy("id").collect()] == ["early", "Outros", "any"]
    none = spark.createDataFrame([], RULES)
    assert {r.category for r in K.categorise(df, none).collect()} == {"Outros"}


def test_many_rules_cost_a_title_no_more():
    """One pass over a title, whether there are a hundred rules or a hundred thousand."""
    titles = [f"produto {i} marca {i % 97} modelo {i * 7919 % 100_000:05d}x" for i in range(3000)]

    def seconds(n):
        a, empty = K.automaton([(f"{i:05d}x", i) for i in range(n)])
        t0 = time.process_time()
        found = [K.first_rule(t, a, empty) for t in titles]
        return time.process_time() - t0, found

    few, _ = seconds(100)
    many, found = seconds(100_000)
    assert found[:3] == [0, 7919, 15838] and many < 20 * few + 0.2  # a thousand times the rules
