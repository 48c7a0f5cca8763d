"""The quality classifier's counts, weights, keys and selection, each computed again row by row."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from vitrine.llm import quality as Q
from vitrine.llm.bytescan import MIX, token_hashes

BITS = 8


def mix(h):
    for _ in range(2):
        h = (h ^ (h >> 32)) * MIX % 2**64
    return h ^ (h >> 32)


def grams(text):
    """Buckets of a text's unigrams and bigrams."""
    raw = text.encode()
    hashes = [int(h) for h in token_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]]
    pairs = [Q.REPEAT if a == b else mix((a * 3 + b) % 2**64) for a, b in zip(hashes, hashes[1:])]
    return [h >> (64 - BITS) for h in hashes + pairs]


def test_every_figure_of_a_report(spark, make, label):
    rng = np.random.default_rng(8)
    good, bad = ["river", "house", "walks", "under", "tree"], ["zxq", "qqq", "!!", "win", "$$"]
    docs = [(i, " ".join(rng.choice(bad if i % 3 == 0 else good, rng.integers(1, 25))) + (" win win win" if i % 6 == 0 else ""), f"s{i % 4}") for i in range(90)]
    docs += [(200, None, "a"), (201, "", "a"), (3, docs[3][1], "b"), (None, "river river", "c")]
    labels = [(i, int(i % 3 != 0), 0) for i in range(0, 60)] + [(7, 0, 0), (999, 1, 0)]
    got = Q.quality_report(make(docs), label(labels), limit=30, bits=BITS).collect()

    lowest = {}
    for i, q, _ in labels:
        lowest[i] = min(q, lowest.get(i, 1))
    order = {r.id: (r.h, r.id) for r in spark.createDataFrame([(i,) for i in lowest], "id long").select("id", F.xxhash64("id").alias("h")).collect()}
    target = set(sorted((i for i, q in lowest.items() if q == 1), key=order.get)[:30])
    raw, aim = Counter(), Counter()
    for i, t, _ in docs:
        raw.update(grams(t or ""))
        if i in target:
            aim.update(grams(t or ""))
    n = 1 << BITS
    p_raw = [(raw[b] + 0.5) / (sum(raw.values()) + 0.5 * n) for b in range(n)]
    p_aim = [(aim[b] + 0.5) / (sum(aim.values()) + 0.5 * n) for b in range(n)]
    share = sum(q for _, q, _ in labels) / len(labels)
    p_rest = [max(r - share * a, r * 1e-3) for r, a in zip(p_raw, p_aim)]
    scale = sum(p_rest)
    noise = {(r.doc_id, r.text): r.u for r in make(docs).select("doc_id", "text", F.xxhash64(
        F.lit("gumbel"), F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("u")).collect()}
    want, expected = [], 0.0
    for i, t, _ in docs:
        weight = sum(math.log(p_aim[b] / p_raw[b]) for b in grams(t or ""))
        odds = math.log(share / (1 - share)) + sum(math.log(p_aim[b] / (p_rest[b] / scale)) for b in grams(t or ""))
        expected += 1 / (1 + math.exp(-max(-50, min(50, odds))))
        u = ((noise[i, t] % 2**64 >> 11) + 0.5) / 2**53
        want.append((i, weight, weight - math.log(-math.log(u))))
    least = sorted((k for *_, k in want), reverse=True)[round(expected) - 1]
    key = lambda r: (str(r[0]), round(r[2], 6))
    for (i, w, k), r in zip(sorted(want, key=key), sorted(map(tuple, got), key=key), strict=True):
        assert i == r[0] and abs(w - r[1]) < 1e-8 and abs(k - r[2]) < 1e-8 and r[3] == (k >= least - 1e-9)
