"""Line de-duplication: column names, very long texts; toxicity: what is learnt from and by which formula."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import toxicity as X
from vitrine.llm.line_dedup import line_dedup


def test_columns_of_any_name_pass(make):
    rows = [(i, f"own {i}\nthe same line\nend {i}", f"s{i}") for i in range(12)] + [(50, None, "a"), (51, "", "b"), (None, "x\n\ny", None)]
    names = ["__key", "key", "drop", "lines", "d", "__", "row", "first", "__drop", "__row"]
    docs = make(rows).select("*", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])
    got = line_dedup(docs, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    for r in got.collect():
        assert all(r[n] == f"{n} {'none' if r.doc_id is None else r.doc_id}" for n in names)
        if r.doc_id is not None and r.doc_id < 12:
            assert r.text == (f"own {r.doc_id}\nthe same line\nend {r.doc_id}" if r.doc_id == 0 else f"own {r.doc_id}\nend {r.doc_id}")
            assert (r.n_lines, r.n_removed) == (3, int(r.doc_id > 0))
    by = {r.doc_id: (r.text, r.n_lines) for r in got.collect()}
    assert by[50] == (None, 0) and by[51] == ("", 0) and by[None] == ("x\n\ny", 3)


def test_a_text_of_many_dropped_lines_takes_linear_time(make):
    lines = [f"line {i}" for i in range(40_000)]
    rows = [(i, "\n".join(lines), f"s{i}") for i in range(10)]
    t0 = time.time()
    got = {r.doc_id: r.text for r in line_dedup(make(rows)).collect()}
    assert got[0] == "\n".join(lines) and all(got[i] == "" for i in range(1, 10)) and time.time() - t0 < 60


BAD = "worthless stupid moron idiot"


def long_corpus(n, words, seed=4):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(["the", "house", "green", "walks", "river", "under", "seven"], words))
        if i % 2:
            text[rng.integers(0, words)] = BAD
        docs.append((i, " ".join(text), "s"))
        labels.append((i, 1, i % 2))
    return docs, labels


def test_long_labelled_texts_are_learnt_from(make, label):
    docs, labels = long_corpus(80, 1900)
    assert min(len(t) for _, t, _ in docs) > 8_000
    by = {r.doc_id: r for r in X.toxicity(make(docs), label(labels)).collect()}
    held = [i for i in by if by[i].held_out]
    assert len(held) > 8 and all(by[i].predicted == i % 2 for i in held)


def test_the_sample_is_bounded_and_the_same_in_every_run(make, label, monkeypatch):
    docs, labels = long_corpus(200, 40)
    docs = docs + [(i, f"other text of {i}", "t") for i, *_ in docs] + docs[:50]
    monkeypatch.setattr(X, "TRAIN_TOXIC", 60)
    monkeypatch.setattr(X, "TOXIC_BYTES", 5_000)
    monkeypatch.setattr(X, "CLEAN_BYTES", 3_000)
    runs = [sorted(map(tuple, X.sample(make(rows).repartition(n), label(labels), "doc_id", "text", "toxic")))
            for rows, n in ((docs, 1), (docs[::-1], 7))]
    assert runs[0] == runs[1] and len(set(runs[0])) == len(runs[0])
    for y, most in ((1, 5_000), (0, 3_000)):
        size = sum(len(t.encode()) for _, t, k in runs[0] if k == y)
        assert most / 2 < size <= most
    scores = [sorted(map(tuple, X.toxicity(make(rows), label(labels)).collect())) for rows in (docs, docs[::-1])]
    assert scores[0] == scores[1]


def test_a_score_is_the_mean_weight_of_a_segments_ngrams(make, label):
    docs, labels = long_corpus(120, 12)
    model = X.train([t.encode() for _, t, _ in docs], np.array([y for *_, y in labels]))
    text = "a extraordinarily b stupid"

    def bucket(gram):
        value = int.from_bytes(gram, "little") + len(gram)
        return value * X.MIX % 2**64 >> (64 - X.BUCKET_BITS)

    words, best = text.split(), -1e9
    for i in range(len(words)):
        grams = []
        for w in words[i: i + X.SEGMENT]:
            padded = f" {w} ".encode()
            grams += [padded[k: k + n] for n in X.LENGTHS for k in range(len(padded) - n + 1)]
        best = max(best, np.mean([model.weights[bucket(g)] for g in grams]))
    want = 1 / (1 + np.exp(-(model.slope * best + model.offset)))
    raw = text.encode()
    assert model.scores(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0] == pytest.approx(want, rel=1e-6)
