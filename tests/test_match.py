"""Top-1 match (C1-C8): fixtures from the reference tests plus brute-force
checks of the blocked join on vectors with exact ties and zero vectors."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine.operators.match import (
    attach_match,
    best_match,
    block_winners,
    pair_rows,
    partner_prices,
    similarity_pairs,
    unmatched_targets,
)
from vitrine.schema import Labels

CAT = "product_id long, title string, price double, url string, embedding array<float>"


def _cat(spark, rows):
    return spark.createDataFrame(rows, CAT)


def _brute(S, T, sid, tid):
    out = {}
    for i, s in enumerate(S):
        best = None
        for j, t in enumerate(T):
            ns, nt = np.linalg.norm(s), np.linalg.norm(t)
            sim = 0.0 if ns == 0 or nt == 0 else float(np.dot(s, t) / (ns * nt))
            key = (round(sim, 12), -tid[j])
            if best is None or key > best[0]:
                best = (key, tid[j], sim)
        out[sid[i]] = (best[1], best[2])
    return out


def test_reference_fixture_t1(spark):
    a = _cat(spark, [(0, "produto1", 100.0, "/produto1", [1.0, 0.0, 0.0]),
                     (1, "produto2", 200.0, "/produto2", [0.0, 1.0, 0.0])])
    b = _cat(spark, [(10, "produto3", 150.0, "/produto3", [0.5, 0.5, 0.0]),
                     (11, "produto4", 250.0, "/produto4", [0.0, 0.5, 0.5])])
    got = {r.source_id: (r.target_id, r.similarity) for r in best_match(a, b).collect()}
    # row 2 ties at 0.7071 against both targets: the first (lowest id) wins
    assert got[0][0] == 10 and got[0][1] == pytest.approx(0.70710678, abs=1e-8)
    assert got[1][0] == 10 and got[1][1] == pytest.approx(0.70710678, abs=1e-8)
    assert all(0 <= s <= 1 for _, s in got.values())


def test_empty_inputs_give_empty_match(spark):
    e = _cat(spark, [])
    assert best_match(e, e).count() == 0


def test_block_winners_ties_and_zero_vectors():
    import pandas as pd

    s = pd.DataFrame({"source_id": [1, 2, 3], "vec": [np.array([1, 0], "f4"), np.array([0, 0], "f4"),
                                                       np.array([1, 1], "f4")]})
    t = pd.DataFrame({"target_id": [9, 7, 8], "vec": [np.array([1, 1], "f4"), np.array([1, 1], "f4"),
                                                       np.array([1, 0], "f4")]})
    got = block_winners(s, t).set_index("source_id")
    assert got.loc[1, "target_id"] == 8
    assert got.loc[2, "target_id"] == 7 and got.loc[2, "similarity"] == 0.0  # zero vector: lowest id
    assert got.loc[3, "target_id"] == 7  # copies 7 and 9 tie: lowest id


@settings(max_examples=10, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.integers(1, 9), st.integers(1, 7))
def test_blocked_equals_brute_force(spark, seed, ns, nt):
    """Up to 63 block pairs: several per task (rows streamed in block-pair
    order) and many blocks empty on one side."""
    rng = np.random.default_rng(seed)
    S = rng.integers(-2, 3, size=(30, 4)).astype("float32")
    T = rng.integers(-2, 3, size=(25, 4)).astype("float32")
    T[5] = T[3]  # exact copies at different ids
    S[7] = 0  # zero source vector
    sid = list(range(100, 130))
    tid = list(rng.permutation(np.arange(500, 525)))
    a = _cat(spark, [(sid[i], "s", 1.0, "/s", S[i].tolist()) for i in range(len(S))])
    b = _cat(spark, [(int(tid[j]), "t", 1.0, "/t", T[j].tolist()) for j in range(len(T))])
    got = {r.source_id: (r.target_id, r.similarity) for r in
           best_match(a, b, source_blocks=ns, target_blocks=nt).collect()}
    want = _brute(S.astype("f8"), T.astype("f8"), sid, [int(x) for x in tid])
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0], k
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-12)


def test_result_independent_of_blocks_on_data(spark):
    from vitrine.sources.tables import products, split_catalogs

    lab = Labels("A", "B")
    s, t = split_catalogs(products(spark, "/root/testdata/sf0.001", lab), lab)
    one = sorted(best_match(s, t).collect())
    many = sorted(best_match(s, t, source_blocks=4, target_blocks=3).collect())
    assert [(r.source_id, r.target_id) for r in one] == [(r.source_id, r.target_id) for r in many]
    assert all(abs(x.similarity - y.similarity) < 1e-12 for x, y in zip(one, many))


@pytest.mark.parametrize("ns,nt", [(1, 1), (3, 2), (9, 7)])
def test_block_pairs_spanning_many_arrow_batches(spark, ns, nt):
    """Batches of 7 rows: block pairs arrive in pieces and batch edges fall
    inside pairs; the stream must still hand each whole pair to the kernel."""
    rng = np.random.default_rng(11)
    S = rng.normal(size=(60, 3)).astype("float32")
    T = rng.normal(size=(45, 3)).astype("float32")
    sid, tid = list(range(60)), [1000 + j for j in range(45)]
    a = _cat(spark, [(sid[i], "s", 1.0, "/s", S[i].tolist()) for i in range(len(S))])
    b = _cat(spark, [(tid[j], "t", 1.0, "/t", T[j].tolist()) for j in range(len(T))])
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.source_id: (r.target_id, r.similarity)
               for r in best_match(a, b, source_blocks=ns, target_blocks=nt).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = _brute(S.astype("f8"), T.astype("f8"), sid, tid)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in want)


def test_similarity_pairs_on_a_wide_grid_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    S = rng.normal(size=(40, 3)).astype("float32")
    T = rng.normal(size=(35, 3)).astype("float32")
    a = _cat(spark, [(i, "s", 1.0, "/s", S[i].tolist()) for i in range(len(S))])
    b = _cat(spark, [(1000 + j, "t", 1.0, "/t", T[j].tolist()) for j in range(len(T))])
    got = sorted((r.source_id, r.target_id) for r in similarity_pairs(a, b, 0.5, source_blocks=8, target_blocks=6).collect())
    Su = S.astype("f8") / np.linalg.norm(S.astype("f8"), axis=1)[:, None]
    Tu = T.astype("f8") / np.linalg.norm(T.astype("f8"), axis=1)[:, None]
    want = sorted((i, 1000 + j) for i, j in zip(*np.nonzero(Su @ Tu.T >= 0.5)))
    assert got == want and len(want) > 100


def test_similarity_pairs_threshold(spark):
    a = _cat(spark, [(0, "a", 1.0, "/a", [1.0, 0.0]), (1, "b", 1.0, "/b", [0.0, 1.0])])
    b = _cat(spark, [(5, "c", 1.0, "/c", [1.0, 1.0]), (6, "d", 1.0, "/d", [1.0, 0.0])])
    got = sorted((r.source_id, r.target_id) for r in similarity_pairs(a, b, 0.7, target_blocks=2).collect())
    assert got == [(0, 5), (0, 6), (1, 5)]


def test_threshold_attach_and_empty_target(spark):
    a = _cat(spark, [(0, "a", 10.0, "/a", [1.0, 0.0]), (1, "b", 20.0, "/b", [0.0, 1.0])])
    b = _cat(spark, [(5, "c", 8.0, "/c", [1.0, 0.1])])
    m = {r.source_id: r for r in attach_match(a, b, best_match(a, b), 0.8).collect()}
    assert m[0].matched and m[0].target_title == "c" and m[0].target_id == 5
    assert not m[1].matched and m[1].target_title is None and m[1].similarity == pytest.approx(0.0995, abs=1e-3)
    empty = b.where(F.lit(False))
    m2 = attach_match(a, empty, best_match(a, empty), 0.8).collect()
    assert len(m2) == 2 and all((not r.matched) and r.similarity == 0.0 for r in m2)


def test_pairs_fixture_t3(spark):
    lab = Labels()
    a = _cat(spark, [(0, "produto1", 100.0, "/produto1", [1.0, 0.0]), (1, "produto2", 200.0, "/produto2", [0.0, 1.0])])
    b = _cat(spark, [(10, "produto3", 150.0, "/produto3", [1.0, 0.1]), (11, "produto4", 250.0, "/produto4", [0.1, 1.0])])
    best = best_match(a, b)
    rows = pair_rows(a, b, best, lab).orderBy("pair_id", "side").collect()
    assert len(rows) == 4
    assert rows[0].title == "produto1" and rows[0].marketplace == "competitor"
    assert rows[1].title == "produto3" and rows[1].marketplace == "own"
    assert rows[0].similarity == rows[1].similarity
    assert rows[0].url.startswith("https://www.competitor.example")
    assert rows[1].url.startswith("https://www.own.example")
    assert rows[0].diff_pct == pytest.approx(abs(100 - 150) / 125 * 100)
    assert unmatched_targets(b, best, lab).count() == 0
    pp = partner_prices(pair_rows(a, b, best, lab), lab).collect()
    assert sorted((r.source_price, r.target_price) for r in pp) == [(100.0, 150.0), (200.0, 250.0)]


def test_unmatched_targets_are_exclusive(spark):
    lab = Labels()
    a = _cat(spark, [(0, "a", 1.0, "/a", [1.0, 0.0])])
    b = _cat(spark, [(5, "c", 2.0, "/c", [1.0, 0.0]), (6, "d", 3.0, "http://x/d", [0.0, 1.0])])
    ex = unmatched_targets(b, best_match(a, b), lab).collect()
    assert [(r.product_id, r.exclusivity, r.similarity, r.url) for r in ex] == [(6, "sim", -1.0, "http://x/d")]


def test_no_cartesian_product_in_match_plan(spark):
    a = _cat(spark, [(0, "a", 1.0, "/a", [1.0, 0.0])])
    plan = best_match(a, a, source_blocks=2, target_blocks=2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "MapInPandas" in plan


@pytest.mark.parametrize("ns,nt,wide", [(4, 2, 8), (5, 3, 8), (7, 11, 8), (1, 1, 8), (40, 20, 8)])
def test_block_pairs_spread_evenly_over_tasks(spark, ns, nt, wide):
    """Every block pair lands in exactly one task, tasks differ by at most
    one block pair, and a task's rows come ordered by block pair."""
    from pyspark.sql import functions as F
    from vitrine.operators.match import _block_pairs

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(wide))
    try:
        s = spark.range(300).selectExpr("id AS source_id", "array(1.0f) AS vec")
        t = spark.range(200).selectExpr("id AS target_id", "array(1.0f) AS vec")
        rows = _block_pairs(s, t, ns, nt).withColumn("task", F.spark_partition_id())
        got = rows.groupBy("task", "bp").agg(F.count_if(F.col("side") == 0).alias("s"),
                                             F.count_if(F.col("side") == 1).alias("t")).collect()
        per_task = {}
        for r in got:
            per_task.setdefault(r.task, set()).add(r.bp)
        assert sorted(bp for v in per_task.values() for bp in v) == list(range(ns * nt))
        loads = [len(v) for v in per_task.values()]
        assert max(loads) - min(loads) <= 1 and max(loads) <= 16
        assert sum(r.s for r in got) == 300 * nt and sum(r.t for r in got) == 200 * ns
        ordered = rows.rdd.mapPartitions(lambda it: [[r.bp for r in it]]).collect()
        assert all(b == sorted(b) for b in ordered)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _ids_vecs(spark, n, name, dim=2, copies=0):
    """``n`` rows of ``(name, vec)``; the first ``copies`` rows share one vector."""
    vec = f"array_repeat(CAST(IF(id < {copies}, -1, id) AS FLOAT), {dim})"
    return spark.range(n).selectExpr(f"id AS {name}", f"{vec} AS vec")


def test_block_counts_fill_the_cluster(spark):
    from vitrine.operators.match import _block_counts

    big = _ids_vecs(spark, 40_000, "source_id")
    small = _ids_vecs(spark, 3_000, "target_id")
    ns, nt = _block_counts(big, small, 50_000, None, None)
    slots = spark.sparkContext.defaultParallelism
    assert nt == 1 and ns == min(slots, 40)
    ns2, nt2 = _block_counts(big, _ids_vecs(spark, 40_000, "target_id"), 10_000, None, None)
    assert nt2 == 4 and ns2 >= 4
    assert _block_counts(small, small, 10, 3, 5) == (3, 5)


def test_block_counts_size_by_distinct_vectors_and_bytes(spark):
    from vitrine.operators.match import _block_counts

    src = _ids_vecs(spark, 100, "source_id")
    # 3000 targets, 2000 of them copies of one vector: 1001 distinct
    tgt = _ids_vecs(spark, 3_000, "target_id", copies=2_000)
    assert _block_counts(src, tgt, 400, None, None)[1] == 8  # every row counts
    assert _block_counts(src, tgt, 400, None, None, distinct_target=True)[1] == 3
    # rows without a usable vector need no room
    from vitrine.operators.match import usable_vectors

    raw = spark.range(40_000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN array(1.0D, cast(id as double)) END AS vec")
    assert _block_counts(usable_vectors(raw, "id", "vec", "source_id"), tgt, 100, None, None)[0] == 4
    # 4-dim float64 vectors, 32 000 bytes a block: at most 1000 rows
    wide = _ids_vecs(spark, 3_000, "target_id", dim=4)
    assert _block_counts(src, wide, 50_000, None, None, block_bytes=32_000)[1] == 3


def test_on_empty_error(spark):
    a = _cat(spark, [(0, "a", 1.0, "/a", [1.0, 0.0])])
    e = _cat(spark, [])
    with pytest.raises(ValueError):
        best_match(a, e, on_empty="error")
    with pytest.raises(ValueError):
        best_match(e, a, source_blocks=1, target_blocks=1, on_empty="error")
    assert best_match(a, a, on_empty="error").count() == 1


def test_hot_target_and_copies(spark):
    """A third of the targets are copies of one vector and every source
    picks it: the lowest copy id wins, pairs and exclusives stay whole."""
    lab = Labels()
    n = 60
    src = _cat(spark, [(i, f"s{i}", 10.0 + i, f"/s{i}", [1.0, 0.01 * (i % 3)]) for i in range(n)])
    tgt_rows = [(1000 + j, "hot", 9.0, f"/t{j}", [1.0, 0.0]) for j in range(20)]
    tgt_rows += [(2000 + j, f"t{j}", 5.0, f"/u{j}", [0.0, 1.0 + j]) for j in range(40)]
    tgt = _cat(spark, tgt_rows)
    best = best_match(src, tgt, source_blocks=3, target_blocks=2)
    got = best.collect()
    assert len(got) == n and {r.target_id for r in got} == {1000}
    pairs = pair_rows(src, tgt, best, lab)
    assert pairs.count() == 2 * n
    assert unmatched_targets(tgt, best, lab).count() == 59


@pytest.mark.parametrize("batch", [700, 30_000])
def test_sources_of_a_block_pair_pass_in_pieces(batch):
    """A worker holds the targets of one block pair and a bounded number of its sources, whatever the block's size."""
    from vitrine.operators import match as M

    rng = np.random.default_rng(4)
    make = lambda bp, side, n: pd.DataFrame({
        "side": side, "id": np.arange(n) + 100_000 * bp, "vec": list(rng.integers(0, 3, (n, 4)).astype(np.float32)), "bp": bp})
    blocks = {bp: (make(bp, 1, n_t), make(bp, 0, n_s)) for bp, (n_t, n_s) in enumerate([(50, 25_000), (0, 30), (40, 0), (60, 31)])}
    stream = pd.concat([d for pair in blocks.values() for d in pair], ignore_index=True)
    seen = []

    def kernel(sdf, tdf):
        seen.append((len(sdf), len(tdf)))
        return M.block_winners(sdf, tdf)

    got = pd.concat(M._per_block_pair((stream.iloc[a:a + batch] for a in range(0, len(stream), batch)), kernel))
    want = pd.concat(M.block_winners(s.rename(columns={"id": "source_id"}), t.rename(columns={"id": "target_id"})) for t, s in blocks.values())
    order = lambda d: d.sort_values("source_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
    assert max(n for n, _ in seen) < 2 * M._SOURCE_ROWS and {t for _, t in seen} == {50, 60}


def test_targets_come_before_the_sources_of_their_block_pair(spark):
    from vitrine.operators import match as M

    s, t = (spark.range(60).selectExpr(f"id AS {n}", "array(1.0D, CAST(id AS DOUBLE)) AS vec") for n in ("source_id", "target_id"))
    for ns, nt in ((1, 1), (3, 2), (40, 40)):
        tasks = M._block_pairs(s, t, ns, nt).rdd.glom().map(lambda rows: [(r.bp, -r.side) for r in rows]).collect()
        assert all(x == sorted(x) for x in tasks) and sum(map(len, tasks)) == 60 * (ns + nt)
