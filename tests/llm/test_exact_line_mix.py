"""Native operators and line de-duplication: odd inputs, ties, collisions, against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vitrine.llm.exact_dedup import exact_dedup
from vitrine.llm.line_dedup import line_dedup, spread_lines
from vitrine.llm.mixing import mix, mix_report, mixing_plan, targets
from tests_llm_odd import ODD

FOLD = {i: i + 32 for i in range(65, 91)}


def norm(t):
    return (t or "").translate(FOLD)


def expected_exact(rows, keep=max):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[norm(t)].append(i)
    out, stayed = [], set()
    for i, t, _ in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        k = keep(ids) if ids else None
        stays = i == k and norm(t) not in stayed  # of repeated rows one stays
        stayed |= {norm(t)} if stays else set()
        out.append((i, k, len(groups[norm(t)]), stays, hashlib.sha256(norm(t).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hash_fn", [None, lambda c: F.unhex(F.substring(F.md5(c), 1, 2))])
def test_exact_dedup_with_and_without_collisions(make, hash_fn):
    rows = ODD + [(100 + i, f"text {i % 40}", "z") for i in range(400)]
    got = exact_dedup(make(rows), **({"hash_fn": hash_fn} if hash_fn else {}))
    assert Counter(tuple(r) for r in got.collect()) == expected_exact(rows)
    assert Counter(tuple(r) for r in exact_dedup(make(rows), keep="smallest").collect()) == expected_exact(rows, min)


def test_exact_dedup_empty_and_clashing_names(make):
    assert exact_dedup(make([])).count() == 0
    extra = make([(1, "x", "a"), (2, "X", "a")]).withColumn("keep_id", F.lit("mine")).withColumn("h", F.lit(1)).withColumn("t", F.lit(2))
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup(extra).collect()) == [(1, 2), (2, 2)]


def brute_lines(rows, limit):
    sites, first = defaultdict(set), {}
    key = lambda line: line.strip(" \t\r\x0b\x0c")
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n")):
            if key(line):
                if s is not None:
                    sites[key(line)].add(s)
                place = (i is None, i or 0, p)
                first[key(line)] = min(first.get(key(line), place), place)
    out = []
    for i, t, s in rows:
        lines = (t or "").split("\n")
        kept = [x for p, x in enumerate(lines) if not key(x) or len(sites[key(x)]) < limit or first[key(x)] == (i is None, i or 0, p)]
        out.append((i, t if len(kept) == len(lines) else "\n".join(kept), s))
    return Counter(out)


def test_line_dedup_against_brute_force(make):
    rows = ODD + [(50 + i, f"only {i}\n  Share this \nseen by {i % 3}\n\nnear", f"site{i}") for i in range(12)]
    rows += [(90 + i, "near\nonly here", f"site{i % 9}") for i in range(30)]
    for limit in (3, 10, 12):
        got = line_dedup(make(rows).withColumn("key", F.lit("clash")).withColumn("pos", F.lit(1)), min_sites=limit)
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "pos"]
        assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == brute_lines(rows, limit)
    assert line_dedup(make([])).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(bytes([k]), f"s{i}") for k, n in ((1, 9), (2, 10), (3, 11), (4, 500)) for i in range(n) for _ in range(3)]
    got = spread_lines(spark.createDataFrame(rows, "key binary, site string"), 10, log_k=6)
    assert sorted(bytes(r.key) for r in got.collect()) == [b"\x02", b"\x03", b"\x04"]


def words(t):
    return len(re.findall("[^\x20\x09-\x0D]+", t or ""))


def test_mix_targets_whole_copies_and_reruns(make):
    rows = ODD + [(200 + i, "w " * (1 + i * 7 % 50), f"s{i % 7}") for i in range(700)]
    a = mix_report(make(rows), bucket_rows=5).collect()
    assert sorted(map(str, a)) == sorted(map(str, mix_report(make(rows).repartition(3), bucket_rows=5000).collect()))
    size, taken, target, largest = Counter(), Counter(), {}, Counter()
    by_id = {}
    for i, t, s in rows:
        by_id.setdefault(i, s)
        size[s] += words(t)
        largest[s] = max(largest[s], words(t))
    sources = {by_id[r.doc_id]: (r.source_size, r.target) for r in a if r.doc_id is not None}.values()
    assert sum(t for _, t in sources) == pytest.approx(1.5 * sum(size.values()))
    assert all(t <= 2 * n + 1e-9 for n, t in sources) and all(0 <= r.taken <= 2 * r.size for r in a)
    for r in a:
        if r.doc_id is not None and r.doc_id >= 200:
            taken[by_id[r.doc_id]] += r.taken
            target[by_id[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    mixed = mix(make(rows).withColumn("cutoff", F.lit("clash")))
    assert mixed.columns[-1] == "cutoff"
    want = Counter({k: sum(r.copies for r in a if r.doc_id == k) for k in {r.doc_id for r in a}})
    assert Counter(r.doc_id for r in mixed.collect()) == +want


def test_mix_empty_and_wordless(make):
    assert mix_report(make([])).count() == 0 and mix(make([])).count() == 0
    assert [r.taken for r in mix_report(make([(1, "", "a"), (2, None, None)])).collect()] == [0, 0]


def test_excess_is_reshared_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), ("c", 990, 1)], "source string, source_size long, n long")
    got = {r.source: r.target for r in targets(sizes).collect()}
    assert got["a"] == 20 and got["b"] == pytest.approx((3000 - 20) * 2 / 3) and got["c"] == pytest.approx((3000 - 20) / 3)
    assert mixing_plan(spark.createDataFrame([], "source string, size long, r long")).count() == 0
