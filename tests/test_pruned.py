"""The pruned match gives the rows of the plain one, with fewer products on clustered vectors."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitrine.operators import pruned
from vitrine.operators.match import best_match, similarity_pairs

SCHEMA = "product_id long, embedding array<double>"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], SCHEMA)


def rows(df):
    return sorted((r.source_id, r.target_id, round(r.similarity, 9)) for r in df.collect())


def clustered(rng, n, centres, noise):
    return centres[rng.integers(0, len(centres), n)] + rng.normal(0, noise, (n, centres.shape[1]))


def test_clusters_are_skipped(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32))
    s, t = frame(spark, clustered(rng, 1500, centres, 0.02)), frame(spark, clustered(rng, 3000, centres, 0.02))
    got = pruned.match_pruned(s, t, rows_per_block=40)
    assert got.pruned and got.skipped > 0.9
    assert rows(got.best) == rows(best_match(s, t))


def test_even_vectors_fall_back_or_agree(spark):
    rng = np.random.default_rng(2)
    s, t = frame(spark, rng.normal(size=(300, 24))), frame(spark, rng.normal(size=(400, 24)))
    want = rows(best_match(s, t))
    plain = pruned.match_pruned(s, t)
    assert not plain.pruned and rows(plain.best) == want
    forced = pruned.match_pruned(s, t, max_share=2.0)
    assert forced.pruned and rows(forced.best) == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.integers(1, 4), st.integers(1, 6))
def test_small_integer_vectors_with_ties_zeros_and_copies(spark, seed, dim, pivots):
    rng = np.random.default_rng(seed)
    s = [None if rng.random() < 0.05 else rng.integers(-2, 3, dim) for _ in range(25)]
    t = [None if rng.random() < 0.05 else rng.integers(-2, 3, dim) * rng.integers(1, 3) for _ in range(30)]
    s, t = frame(spark, s), frame(spark, t, 100)
    assert rows(pruned.best_match_pruned(s, t, pivots=pivots, max_share=9.0, rows_per_block=7)) == rows(best_match(s, t))


def test_edge_catalogs(spark):
    some, none = frame(spark, [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], None, [float("nan"), 1.0]]), frame(spark, [])
    assert rows(pruned.best_match_pruned(none, some)) == rows(pruned.best_match_pruned(some, none)) == []
    only_zero = frame(spark, [[0.0, 0.0], [0.0, 0.0]], 5)
    assert rows(pruned.best_match_pruned(some, only_zero)) == rows(best_match(some, only_zero)) == [(0, 5, 0.0), (1, 5, 0.0), (2, 5, 0.0)]


@pytest.mark.parametrize("blocks", [{}, {"source_blocks": 2, "target_blocks": 3}])
def test_vectors_meet_those_of_their_length(spark, blocks):
    s = frame(spark, [[1, 0], [1, 0, 0], [0, 0], [1, 1, 1, 1], None])
    t = frame(spark, [[0, 1], [1, 1], [0, 0, 1], [1, 0, 0.5], []], 10)
    half, near = round(0.5**0.5, 9), round(1 / 1.25**0.5, 9)
    assert rows(best_match(s, t, **blocks)) == [(0, 11, half), (1, 13, near), (2, 10, 0.0)]
    assert rows(pruned.best_match_pruned(s, t)) == rows(best_match(s, t))
    assert rows(similarity_pairs(s, t, 0.5, **blocks)) == [(0, 11, half), (1, 13, near)]


def test_ties_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(4)
    s, t = frame(spark, rng.integers(-3, 4, (60, 3))), frame(spark, rng.integers(-3, 4, (90, 3)))
    want = rows(best_match(s, t, source_blocks=1, target_blocks=1))
    for ns, nt in ((1, 4), (3, 1), (5, 7)):
        assert rows(best_match(s, t, source_blocks=ns, target_blocks=nt)) == want
