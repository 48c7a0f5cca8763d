"""A refreshed match equals a full run, with products for the changes only."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators.incremental import refresh_match
from vitrine.operators.match import WINNER_SCHEMA, best_match
from vitrine.plans import registry as RG
from vitrine.plans.jobs import refresh_benchmark
from vitrine.plans.reports import benchmark_table
from vitrine.sources.tables import products

SCHEMA = "product_id long, embedding array<double>"


def frame(spark, catalog):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in catalog.items()], SCHEMA)


def rows(df):
    return sorted((r.source_id, r.target_id, round(r.similarity, 9), r["rank"]) for r in df.collect())


def change(rng, catalog, first, removed, changed, added, vector):
    """The catalog a day later."""
    ids = list(catalog)
    out = dict(catalog)
    for i in rng.choice(ids, removed, replace=False):
        del out[int(i)]
    for i in rng.choice(list(out), changed, replace=False):
        out[int(i)] = vector()
    out.update({first + i: vector() for i in range(added)})
    return out


@pytest.mark.parametrize("vectors", ["integers", "wide"])
def test_days_in_a_row_equal_full_runs(spark, vectors):
    """Small integers make ties and copies; None is a row without a vector."""
    rng = np.random.default_rng(6)

    def vector():
        if rng.random() < 0.05:
            return None
        return rng.integers(-1, 2, 3) if vectors == "integers" else rng.normal(size=12)

    s, t = {i: vector() for i in range(80)}, {1000 + i: vector() for i in range(60)}
    none = spark.createDataFrame([], SCHEMA)
    got = refresh_match(spark.createDataFrame([], WINNER_SCHEMA), none, frame(spark, s), none, frame(spark, t))
    for day in range(3):
        assert rows(got.best) == rows(best_match(frame(spark, s), frame(spark, t), with_rank=True))
        s2, t2 = change(rng, s, 100 * (day + 1), 3, 4, 5, vector), change(rng, t, 5000 * (day + 1), 4, 3, 4, vector)
        got = refresh_match(got.best, frame(spark, s), frame(spark, s2), frame(spark, t), frame(spark, t2), target_blocks=2)
        s, t = s2, t2
    assert rows(got.best) == rows(best_match(frame(spark, s), frame(spark, t), with_rank=True))
    if vectors == "wide":
        assert got.products < 0.5 * got.products_of_a_full_run


def test_work_follows_the_change(spark):
    rng = np.random.default_rng(8)
    s, t = {i: rng.normal(size=8) for i in range(200)}, {1000 + i: rng.normal(size=8) for i in range(100)}
    state = best_match(frame(spark, s), frame(spark, t), with_rank=True)
    same = refresh_match(state, frame(spark, s), frame(spark, s), frame(spark, t), frame(spark, t))
    assert same.products == 0 and rows(same.best) == rows(state)
    more = {**t, 9000: rng.normal(size=8)}
    one = refresh_match(state, frame(spark, s), frame(spark, s), frame(spark, t), frame(spark, more))
    assert one.products == 200 and rows(one.best) == rows(best_match(frame(spark, s), frame(spark, more), with_rank=True))
    empty = refresh_match(state, frame(spark, s), frame(spark, s), frame(spark, t), frame(spark, {}))
    assert rows(empty.best) == [] and empty.products == 0
    back = refresh_match(empty.best, frame(spark, s), frame(spark, s), frame(spark, {}), frame(spark, t))
    assert rows(back.best) == rows(state)


def test_benchmark_of_two_days(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    s, t = (products(spark, sf, RG.LABELS, parity=k) for k in (0, 1))
    out = str(tmp_path / "days")
    refresh_benchmark(s.where("product_id % 9 <> 0"), t.where("product_id % 9 <> 0"), out, RG.LABELS, RG.LEVELS, view="day_one")
    run, match = refresh_benchmark(s, t, out, RG.LABELS, RG.LEVELS, view="day_two")
    want = benchmark_table(s, t, RG.LABELS, RG.LEVELS, ordered=False)
    assert sorted(map(repr, run.benchmark.collect())) == sorted(map(repr, want.select(run.benchmark.columns).collect()))
    assert 0 < match.products < 0.5 * match.products_of_a_full_run
    assert spark.table("day_two").count() == run.benchmark.count()
    assert run.benchmark.where(F.col("exclusivity") == "sim").count() > 0
