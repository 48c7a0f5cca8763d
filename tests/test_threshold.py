"""Pairs from inverted lists equal the plain thresholded matrix."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitrine.operators import threshold as TH
from vitrine.operators.match import similarity_pairs

SCHEMA = "product_id long, embedding array<double>"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], SCHEMA)


def rows(df):
    return sorted((r.source_id, r.target_id, round(r.similarity, 9)) for r in df.collect())


def sparse(rng, n, dims, filled, hot=False):
    m = np.zeros((n, dims))
    for row in m:
        row[rng.choice(dims, filled, replace=False)] = rng.normal(size=filled)
        if hot:
            row[0] = 0.5
    return m


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
def test_lists_find_the_pairs_of_the_matrix(spark, threshold):
    rng = np.random.default_rng(3)
    a = sparse(rng, 300, 400, 6, hot=True)
    b = np.concatenate([sparse(rng, 300, 400, 6, hot=True), a[:80] + rng.normal(0, 0.05, (80, 400)) * (a[:80] != 0)])
    s, t = frame(spark, a), frame(spark, b, 1000)
    got = TH.pairs_bounded(s, t, threshold, rows_per_block=32)
    want = rows(similarity_pairs(s, t, threshold))
    assert rows(got.pairs) == want and len(want) > 50
    if threshold > 0.5:  # the dimension that every vector has is last in the order and in few prefixes
        assert got.bounded and got.listed < 0.2 * got.products


def test_a_dimension_of_most_vectors_is_split(spark):
    rng = np.random.default_rng(5)
    a = sparse(rng, 200, 30, 2)
    a[:, 7] = 3.0
    s, t = frame(spark, a), frame(spark, a, 500)
    got = TH.pairs_bounded(s, t, 0.95, rows_per_block=16, max_share=9.0)
    assert got.bounded and rows(got.pairs) == rows(similarity_pairs(s, t, 0.95))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.sampled_from([0.2, 0.5, 0.7071, 1.0]))
def test_small_integer_vectors(spark, seed, threshold):
    rng = np.random.default_rng(seed)
    vec = lambda: None if rng.random() < 0.1 else rng.integers(-1, 2, 5)
    s, t = frame(spark, [vec() for _ in range(20)]), frame(spark, [vec() for _ in range(20)], 50)
    assert rows(TH.similarity_pairs_bounded(s, t, threshold, max_share=9.0, rows_per_block=6)) == rows(similarity_pairs(s, t, threshold))


def test_kernel_multiplies_only_what_the_norms_allow():
    order = np.arange(3)
    unit = np.array([[0.1, 0.995, 0.0], [0.9, 0.0, 0.436]])
    assert TH.prefixes(unit / np.linalg.norm(unit, axis=1)[:, None], order, 0.95) == [[0, 1], [0]]
    assert np.allclose(TH.remaining(np.array([[0.6, 0.0, 0.8]]), order), [[1.0, 0.8, 0.8]])


def test_plain_version_where_bounds_do_not_help(spark):
    s, t = frame(spark, [[1, 1], [0, 0], [1]]), frame(spark, [[1, 0.9], [2]], 10)
    for threshold in (-1.0, 0.0, 0.9):
        got = TH.pairs_bounded(s, t, threshold)
        assert not got.bounded and rows(got.pairs) == rows(similarity_pairs(s, t, threshold))
    assert rows(TH.similarity_pairs_bounded(frame(spark, []), t, 0.5)) == []


def test_copies_are_compared_once(spark):
    rng = np.random.default_rng(8)
    a = sparse(rng, 30, 50, 4)
    a[10:] = a[0]
    s, t = frame(spark, a), frame(spark, a[::-1], 100)
    got = TH.pairs_bounded(s, t, 0.8)
    assert got.bounded and got.listed <= 11 * 11 * 4 and rows(got.pairs) == rows(similarity_pairs(s, t, 0.8))


@pytest.mark.parametrize("options", [{}, {"max_share": 0.0}])
def test_copies_are_not_multiplied_out(spark, options):
    """k copies on both sides give k rows and not k * k; the pairs of all rows follow from them."""
    rng = np.random.default_rng(9)
    a = sparse(rng, 300, 50, 4)
    a[10:] = a[0]
    a[20:120] = a[1]
    near = a + rng.normal(0, 0.02, a.shape) * (np.arange(300)[:, None] % 150 == 3)
    s, t = frame(spark, [None, *a]), frame(spark, [*near, None], 1000)
    got = [r.asDict() for r in TH.class_pair_rows(s, t, 0.8, **options).collect()]
    pairs = [r for r in got if r["kind"] == "pair"]
    of = {k: [(r["class_id"], r[f"{k}_id"]) for r in got if r["kind"] == k] for k in ("source", "target")}
    assert sorted(i for _, i in of["source"]) == [*range(1, 301)] and sorted(i for _, i in of["target"]) == [*range(1000, 1300)]
    assert all(c == min(i for c2, i in m if c2 == c) for m in of.values() for c, _ in m)
    assert 10 <= len(pairs) <= 12 * 12 and len(got) == len(pairs) + 600
    whole = sorted((x, y, round(p["similarity"], 9)) for p in pairs for c, x in of["source"] if c == p["source_id"]
                   for d, y in of["target"] if d == p["target_id"])
    want = rows(similarity_pairs(s, t, 0.8))
    assert whole == want == rows(TH.similarity_pairs_bounded(s, t, 0.8, **options)) and len(want) > 40_000


def write_parts(spark, folder, titles):
    part = [(i, t, "Brand#1", "SMALL", 1.0) for i, t in enumerate(titles)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")


def test_class_rows_grow_with_their_products(spark, tmp_path):
    """Each title on 40 parts more: the pairs of classes stay, a product more is a row more."""
    from vitrine.plans.registry import ENCODED_THRESHOLD, _encoded

    titles = ["red bolt", "red bolts", "blue ring", None]
    kinds = []
    for copies in (2, 42):
        d = tmp_path / str(copies)
        write_parts(spark, d, [titles[i // 2 % 4] for i in range(8 * copies)])
        out = TH.class_pair_rows(*_encoded(spark, str(d)), ENCODED_THRESHOLD, max_share=float("inf"))
        kinds.append({r["kind"]: r["count"] for r in out.groupBy("kind").count().collect()})
    assert kinds[0]["pair"] == kinds[1]["pair"] and kinds[0]["source"] == 8 and kinds[1]["source"] == kinds[1]["target"] == 168


def test_query_returns_the_pairs_of_all_products(spark, tmp_path):
    """Products of one title are products all the same: each of them is in a row with every product near it."""
    import duckdb

    from vitrine.plans.oracle import ORACLE
    from vitrine.plans.registry import QUERIES

    titles = ["red bolt", "red bolts", "blue ring", None]
    write_parts(spark, tmp_path, [titles[i // 2 % 4] for i in range(8 * 5)])
    out = QUERIES["similarity_pairs_bounded"](spark, str(tmp_path))
    assert out.columns == ["source_id", "target_id", "similarity"]
    got = rows(out)
    same = {(x, y) for x in range(0, 40, 2) for y in range(1, 40, 2) if x // 2 % 4 == y // 2 % 4 != 3}
    assert same <= {(x, y) for x, y, _ in got} and len(same) == 3 * 5 * 5
    con = duckdb.connect()
    for t in ("part", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    sql = con.sql(ORACLE["similarity_pairs_bounded"])
    assert sql.columns == out.columns and got == sorted(sql.fetchall())


@pytest.mark.parametrize("options", [{}, {"max_share": 0.0}])
def test_an_id_of_several_vectors(spark, options):
    """Ids may repeat: the rows of one vector do not get the pairs of another that has the same least id."""
    s = spark.createDataFrame([(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (7, [1.0, 0.0, 0.0])], SCHEMA)
    t = spark.createDataFrame([(1, [0.0, 1.0, 0.0]), (2, [1.0, 0.0, 0.1]), (1, [0.0, 0.0, 1.0]), (1, [0.0, 0.0, 1.0])], SCHEMA)
    want = rows(similarity_pairs(s, t, 0.8))
    assert [x[:2] for x in want] == [(5, 1), (5, 2), (7, 2), (7, 2)]
    assert rows(TH.similarity_pairs_bounded(s, t, 0.8, **options)) == want


def test_many_copies_meet_their_pairs_in_blocks(spark, monkeypatch):
    """A class of 91 copies is 13 groups, and every pair is there once."""
    rng = np.random.default_rng(12)
    a = sparse(rng, 120, 50, 4)
    a[30:] = a[0]
    near = a + rng.normal(0, 0.02, a.shape) * (np.arange(120)[:, None] % 40 == 3)
    s, t = frame(spark, a), frame(spark, near, 1000)
    want = rows(similarity_pairs(s, t, 0.8))
    monkeypatch.setattr(TH, "_COPIES", 7)
    assert rows(TH.similarity_pairs_bounded(s, t, 0.8)) == want and len(want) > 7_000
    of = TH.class_pairs(s, t, 0.8).of_source
    assert of.most == 91
    groups = TH._expanded(spark.createDataFrame([(r["class"], 1) for r in of.rows.collect()], "source_id long, target_id long"), "source_id", of)
    assert sorted(r.source_id for r in groups.collect()) == [*range(120)]
