"""Unequal inclusion chances of the mix, repeated rows of the exact dedup, segments of the SimHash search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import simhash
from vitrine.llm.exact_dedup import exact_dedup
from vitrine.llm.mixing import mix, mix_report


def test_chances_follow_size_and_add_up(make):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(n)), "abc"[i % 3]) for i, n in enumerate(rng.integers(0, 60, 600))] + [(900, "w " * 900, "a"), (901, "w " * 700, "b")]
    got = mix_report(make(rows)).collect()
    for s in "abc":
        of = [r for r, (_, _, x) in zip(sorted(got, key=lambda r: r.doc_id), sorted(rows)) if x == s]
        words = sum(r.size for r in of)
        rest = of[0].target - int(of[0].target // words) * words
        if rest < 1e-6:
            assert all(r.chance == 0 for r in of)
            continue
        assert sum(r.chance * r.size for r in of) == pytest.approx(rest, rel=1e-9)
        free = [r.chance / r.size for r in of if r.size and r.chance < 1]
        assert max(free) == pytest.approx(min(free), rel=1e-9) and all(r.chance == pytest.approx(min(1, free[0] * r.size)) for r in of)
        taken = [r.copies > of[0].target // words for r in of]
        # the sample is a prefix of the Pareto order, and what is certain is in it
        order = sorted((r.pareto, not t) for r, t in zip(of, taken) if r.size)
        assert [t for _, t in order] == sorted(t for _, t in order)
        assert all(t for r, t in zip(of, taken) if r.chance == 1)
        assert abs(sum(r.taken for r in of) - of[0].target) <= 60
    mixed = mix(make(rows).withColumn("k", F.lit("x")).withColumn("cutoff", F.lit("y"))).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {r.doc_id: r.copies for r in got if r.copies}


def test_larger_documents_are_drawn_more_often(make):
    """Over many seeds a document's share of draws is its chance."""
    rows = [(i, "w " * (5 + 10 * (i % 4)), "only") for i in range(40)] + [(100 + i, "w " * 20, "other") for i in range(8)]
    docs, drawn, chance = make(rows).cache(), {}, {}
    for seed in range(25):
        for r in mix_report(docs, seed=f"s{seed}").collect():
            if 0 < r.chance < 1:
                drawn.setdefault((r.doc_id >= 100, r.size), []).append(r.copies - int(r.target // r.source_size))
                chance[r.doc_id >= 100, r.size] = r.chance
    assert len(drawn) >= 4
    for key, times in drawn.items():
        assert abs(np.mean(times) - chance[key]) < 4 * 0.5 / np.sqrt(len(times)) + 0.03, key


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_of_repeated_rows_one_stays(make, keep):
    rows = [(5, "Same"), (5, "same"), (5, "same"), (3, "SAME"), (None, "same"), (None, "alone"), (None, "alone"), (8, "x"), (8, "x"), (8, "y")]
    docs = make([(i, t, "a") for i, t in rows])
    for fn in ({}, {"hash_fn": lambda c: F.lit(b"one hash")}):
        got = exact_dedup(docs, keep=keep, **fn).collect()
        kept = sorted((repr(r.doc_id), r.group_size) for r in got if r.kept)
        assert kept == sorted([(repr(5 if keep == "largest" else 3), 5), ("None", 2), ("8", 2), ("8", 1)])
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("max_bits", [1, 4])
def test_pairs_do_not_depend_on_the_segments(spark, max_bits):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63 - 1, 60)
    near = [int(np.int64(b)) ^ int(sum(1 << int(i) for i in rng.choice(63, rng.integers(1, 6), replace=False))) for b in base for _ in range(3)]
    fps = sorted({*map(int, base), *near})
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin((a ^ b) & (2**64 - 1)).count("1") <= max_bits}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for parts in (2, 3):
        assert {tuple(r) for r in simhash.near_pairs(df, max_bits, parts).collect()} == want


def test_candidates_per_fingerprint_stay_flat():
    """Values of a probed segment hold one fingerprint or so, at any number of them."""
    for n in (1 << 16, 1 << 20, 1 << 24, 1 << 28, 1 << 32):
        met = 0
        for _, width, radius in simhash.segments(4, simhash.segment_count(n)):
            met += len(simhash.ball(width, radius)) * n / 2**width
        assert met <= 600
    assert simhash.segment_count(10) == 3 and simhash.segment_count(1 << 30) == 2


def test_simhash_dedup_passes_columns_of_any_name(make):
    docs = make([(i, f"text number {i // 2} with some words in it", "a") for i in range(8)]).withColumn("__key", F.lit("k")).withColumn("n", F.lit(1)).withColumn("key", F.lit(2))
    got = simhash.simhash_dedup(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect())[0] == 0 and {r["__key"] for r in got.collect()} == {"k"}
