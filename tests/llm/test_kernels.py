"""Operators that SQL cannot express, against brute force, round trips and held-out labels."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests_llm_odd import ODD
from vitrine.llm import bpe, bytescan, html_extract, simhash, toxicity, vafile
from vitrine.llm.components import components
from vitrine.llm.quality import kth_largest, quality_filter, quality_report
from vitrine.llm.suffix_array import suffix_array
from vitrine.llm.suffix_dedup import suffix_dedup

PATH = public_tokenizers.path("word_bpe_49k.json")


# --- suffix arrays --------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=120), st.integers(1, 4), st.sampled_from([0, 8192]))
def test_suffix_array_equals_sorted_suffixes(letters, repeat, small):
    t = letters * repeat + [0]
    assert suffix_array(np.array(t, np.uint16), 5, small).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def brute_repeats(texts, length):
    seen = Counter(t[i: i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i: i + length]] > 1:
                mark[i: i + length] = b"\1" * length
        kept = bytes(c for c, m in zip(t, mark) if not m)
        runs = len(re.findall(b"\1+", bytes(mark)))
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"group_rows": 2, "shard_bytes": 100}])
def test_suffix_dedup_against_brute_force(make, options):
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdé "), 900))
    rows = ODD + [(100, base, "a"), (101, base[:400] + "X" + base[400:], "a"), (102, "Q" + base[200:500], "b"), (103, "ab" * 200, "b"),
                  (104, "zz" + "ab" * 150 + "yy", "b"), (105, base[300:480], "b"), (106, "x" * 300 + base[100:300], "c")]
    rows += [(200 + i, f"{i:04d}" * 3 + base[50:170] + f"{i * 7:05d}" + base[:90], "c") for i in range(30)]
    for length in (200, 64):
        got = suffix_dedup(make(rows), length=length, **options).collect()
        want = brute_repeats([(t or "").encode() for _, t, _ in rows], length)
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(
            (i, *w) for (i, _, _), w in zip(rows, want))
    assert suffix_dedup(make([])).count() == 0


def test_contexts_of_an_anchor_meet_in_one_task(spark, make):
    """Equal passages in different surroundings, many shuffle partitions, none of them merged."""
    rng = np.random.default_rng(11)
    word = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    passages = [word(230) for _ in range(25)]
    rows = [(i, word(120) + passages[i % 25] + word(120), "a") for i in range(75)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "61")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for options in ({}, {"group_rows": 2}):
            got = suffix_dedup(make(rows), **options).collect()
            want = brute_repeats([t.encode() for _, t, _ in rows], 200)
            assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(
                (i, *w) for (i, _, _), w in zip(rows, want))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_a_doubled_gram_hides_no_repeat(make):
    """One text repeats a phrase of the passage that it shares with another."""
    rng = np.random.default_rng(23)
    word = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    rows = []
    for i in range(40):
        passage, at = word(200), int(rng.integers(0, 168))
        quoted = passage + word(int(rng.integers(1, 30))) + passage[at: at + int(rng.integers(32, 90))]
        rows += [(4 * i, word(150) + passage + word(150), "a"), (4 * i + 1, word(150) + quoted + word(150), "b")]
        if i % 2:  # the doubled gram in a class of two
            same = word(400) + quoted + word(400)
            rows += [(4 * i + 2, "1" + same, "c"), (4 * i + 3, "2" + same, "c")]
    for options in ({}, {"shard_bytes": 100}):
        got = suffix_dedup(make(rows), **options).collect()
        want = brute_repeats([t.encode() for _, t, _ in rows], 200)
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(
            (i, *w) for (i, _, _), w in zip(rows, want))


# --- SimHash ---------------------------------------------------------------------


def brute_fingerprint(t, k):
    w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    grams = [" ".join(w[i: i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_segments_cover_every_pair_within_reach():
    for bits, parts in itertools.product(range(0, 8), range(1, 6)):
        segs = simhash.segments(bits, parts)
        assert sum(r + 1 for _, _, r in segs) == bits + 1 and sum(w for _, w, _ in segs) == 64


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_near_pairs_are_all_pairs_within_reach(spark, parts):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2**63, 12)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False)) for c in centres for _ in range(12)}
    got = simhash.near_pairs(spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits=4, parts=parts).collect()
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5), (7, 6)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_report_and_dedup(make):
    text = " ".join(f"w{i}" for i in range(300))
    rows = ODD + [(50 + i, text.replace(f"w{i * 9} ", "changed "), "s") for i in range(12)] + [(80, "w " * 9, "s"), (81, "other words here now", "s")]
    got = simhash.simhash_report(make(rows)).collect()
    fp = [brute_fingerprint(t, 4) for _, t, _ in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{f:016x}") for (i, _, _), f in zip(rows, fp))
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= 4:
            a, b = root[i], root[j]
            root = [min(a, b) if x in (a, b) else x for x in root]
    groups = defaultdict(list)
    for (i, _, _), r in zip(rows, root):
        groups[r].append(i)
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, least[r]) for (i, _, _), r in zip(rows, root))
    kept = simhash.simhash_dedup(make(rows).withColumn("fp", F.lit("clash")))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(least.values(), key=str) and kept.columns[-1] == "fp"
    assert simhash.simhash_report(make([])).count() == 0 and simhash.simhash_dedup(make([])).count() == 0


# --- exact search ------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 60), st.integers(1, 6), st.integers(1, 7), st.sampled_from([3, 300, 2**40]), st.randoms())
def test_block_search_is_exact(n, dim, k, scale, random):
    x = np.array([[random.randint(-scale, scale) for _ in range(dim)] for _ in range(n)], np.int64)
    ids, m = np.arange(n) * 3, min(5, n)
    score = [[sum(int(a) * int(b) for a, b in zip(x[q], x[j])) for j in range(n)] for q in range(m)]
    lists = [pa.array([x[i].tolist() for i in rows], pa.list_(pa.int64())) for rows in (np.repeat(np.arange(m), n), np.tile(np.arange(n), m))]
    assert vafile.inner_products(*lists).tolist() == [min(max(v, -(2**63)), 2**63 - 1) for row in score for v in row]
    if scale == 2**40:
        return  # beyond float64: every row is read
    code, low, width = vafile.cells(x, 2)
    i, at, lower, upper = vafile.candidates(ids[:m], x[:m].astype(float), ids, code.astype(float), low.astype(float), width.astype(float), k)
    for q, j, a, b in zip(i, at, lower, upper):
        assert q != j and a <= score[q][j] <= b
    for q in range(m):
        best = sorted((-score[q][j], int(ids[j])) for j in range(n) if j != q)[:k]
        near = {int(ids[j]) for j in at[i == q]}
        assert {r for v, r in best if v < best[-1][0]} <= near and all(r in near for _, r in best)


def test_few_exact_vectors_are_read(spark):
    """The scan sees cells only; of 4,000 vectors a query reads a few dozen, whatever the blocks."""
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(0, 40, (4000, 32))).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), 32) for i, v in enumerate(x)], "id long, v array<long>, dim int").repartition(3)
    asked = df.where("id % 100 = 0")
    for size in (500, 4000):
        top, reads = vafile.search(df, asked, 5, query_rows=16, block_rows=size)
        per_query = reads.groupBy("query_id").count().collect()
        assert len(per_query) == 40 and max(r["count"] for r in per_query) < 200 and np.mean([r["count"] for r in per_query]) < 60
        got = defaultdict(list)
        for r in sorted(top.collect(), key=lambda r: r["rank"]):
            got[r.query_id].append((r.vec_id, r.score))
        scores = x @ x[::100].T
        for q in range(0, 4000, 100):
            s = sorted((-scores[j, q // 100], j) for j in range(4000) if j != q)[:5]
            assert got[q] == [(j, -v) for v, j in s]


def test_queries_that_share_an_id(spark):
    """The smallest vector asks; the others are candidates of no one with their id."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.5]), (2, [0.5, 1.0]), (2, [0.5, 1.0])]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<float>")
        got = sorted(tuple(r) for r in vafile.vector_top_k(df, df.where("vec_id = 0"), k=3).collect())
        assert got == [(0, 1, 2, 65536), (0, 2, 2, 65536), (0, 3, 1, 32768)]


def test_vector_top_k_odd_rows_and_blocks(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float((i * 7 + j * 3) % 5) / 4 for j in range(4)]) for i in range(60)]
    rows += [(100, None), (150, [nan, 1.0, 1.0, 1.0]), (200, [1.0, None, 1.0, 1.0]), (250, [inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (300, [1.0, 2.0]), (350, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("dim", F.lit(1))
    fine = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i is not None and i < 60}
    for size in (7, 1000):
        got = vafile.vector_top_k(df, df.where("vec_id % 50 = 0"), block_rows=size, query_rows=1)
        found = defaultdict(list)
        for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
            found[r.query_id].append((r.vec_id, r.score))
        for q in (0, 50):
            s = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q)[:5]
            assert found[q] == [(i, -v) for v, i in s]
        assert set(found) == {0, 50}
    assert vafile.vector_top_k(df.limit(0), df.limit(0)).count() == 0


# --- tokens --------------------------------------------------------------------------

TRICKY = ["", " ", "a", "\n\nx", "<|endoftext|>", "a<|endoftext|>b <|startoftext|> ΣΑΣ Σ", "İstanbul ǅ ﬁ é é ́x \u0085y z", "日本語 テキスト", "x" * 3000,
          "it's we'll I'D 'S 12345 ½ ²", "\x1cab\x1fcd \x00 e", "a b c", "ÀÉ'S don't"]


def lib(texts):
    t = Tokenizer.from_file(PATH)
    return [(np.array((e := t.encode(x, add_special_tokens=False).ids), "<u4").tobytes(), t.decode(e, skip_special_tokens=False).encode()) for x in texts]


def encoded(texts, codec):
    return [p for _, _, pairs in bpe.encode_column(pa.array(texts, pa.string()), codec) for p in pairs]


CODEC = bpe.Codec(open(PATH, encoding="utf-8").read())


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbé ß.\n'sS1İΣ́<|"), max_size=200), max_size=5))
def test_encoding_agrees_with_the_library(texts):
    assert encoded(texts, CODEC) == lib(texts)


def test_cuts_anywhere_change_nothing(monkeypatch):
    text = " ".join(TRICKY) + " the quick brown fox. " * 30
    want = lib([text, text[5:]])
    for bits in (1, 2, 4):
        at = bpe.cuts
        monkeypatch.setattr(bpe, "cuts", lambda d, o, bits=bits: at(d, o, 4, bits))
        small = bpe.Codec(open(PATH, encoding="utf-8").read())
        small.chunks.limit = small.words.limit = 5  # memories that forget at once
        assert encoded([text, text[5:]], small) == want
        monkeypatch.undo()


def test_bpe_digests_and_round_trip(make):
    rows = ODD + [(100 + i, t, "s") for i, t in enumerate(TRICKY)]
    want = lib([t or "" for _, t, _ in rows])
    got = bpe.bpe_digests(make(rows).withColumn("__ids", F.lit(1)), PATH).collect()
    assert Counter(tuple(r) for r in got) == Counter(
        (i, len(a) // 4, hashlib.sha256(a).hexdigest(), hashlib.sha256(b).hexdigest()) for (i, _, _), (a, b) in zip(rows, want))
    back = bpe.bpe_decode(bpe.bpe_encode(make(rows), PATH), PATH).collect()
    assert Counter((r.doc_id, r.decoded) for r in back) == Counter((i, b.decode()) for (i, _, _), (_, b) in zip(rows, want))
    assert bpe.bpe_digests(make([]), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.Codec(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


# --- classifiers -------------------------------------------------------------------------


def corpus(n=240):
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("ran", "tel", "mis", "por")]
    bad = ["idiot", "moron", "worthless", "stupid"]
    docs, labels = [], []
    for i in range(n):
        w = rng.choice(vocabulary, rng.integers(5, 400)).tolist()
        if i % 4 == 0:
            for _ in range(2):
                w.insert(rng.integers(0, len(w)), bad[rng.integers(0, 4)])
        if i % 5 == 0:
            w = [x + "!!" for x in w]
        docs.append((i, " ".join(w), f"s{i % 3}"))
        labels.append((i, int(i % 5 != 0), int(i % 4 == 0)))
    return docs, labels


def test_toxicity_on_held_out_rows_and_misspellings(make, label):
    docs, labels = corpus(600)
    odd = [(None if i is None else 10_000 + i, t, s) for i, t, s in ODD] + [(20_001, "you are worthles and stupidd", "a"), (20_002, "badran betel", "a")]
    got = toxicity.toxicity(make(docs + odd).withColumn("y", F.lit(3)), label(labels)).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    held = [i for i, *_ in docs if by[i].held_out]
    assert 60 < len(held) < 180 and np.mean([by[i].predicted == (i % 4 == 0) for i in held]) > 0.95
    assert by[20_001].predicted == 1 and by[20_002].predicted == 0 and by[10_001].score < 0.1
    assert {r.score for r in toxicity.toxicity(make(docs[:3]), label([])).collect()} == {0.0}
    assert toxicity.toxicity(make([]), label(labels)).count() == 0


def test_scores_do_not_depend_on_the_batch():
    docs, labels = corpus(120)
    model = toxicity.train([t.encode() for _, t, _ in docs], np.array([y for *_, y in labels]))
    texts = [t.encode() for _, t, _ in docs]
    all_ = model.scores(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
    one = [model.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(all_, one)


def test_quality_keeps_clean_and_rejects_junk(make, label):
    docs, labels = corpus()
    odd = [(None if i is None else 10_000 + i, t, s) for i, t, s in ODD]
    table = make(docs + odd).withColumn("target", F.lit("clash")).withColumn("l", F.lit(0))
    got = quality_report(table, label(labels)).collect()
    chosen = {r.doc_id for r in got if r.selected}
    assert len(got) == len(docs) + len(odd) and all(i in chosen for i in range(240) if i % 5)
    assert sum(i not in chosen for i in range(0, 240, 5)) > 40
    kept = quality_filter(table, label(labels))
    assert kept.columns == table.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.selected)
    assert quality_filter(make(docs), label([])).count() == len(docs) and quality_report(make([]), label(labels)).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "__key double")
    for k in {1, (len(values) + 1) // 2, len(values)}:
        assert kth_largest(df, k, bins=4, small=3) == sorted(values, reverse=True)[k - 1]


def test_tokens_do_not_depend_on_pieces():
    texts = [b"", b"one two", b"Three!! four \xc3\xa9t", b"x" * 500, b"a b " * 200]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    whole = bytescan.token_hashes(data, off)
    for limit in (7, 64, 300):
        part = bytescan.token_hashes(data, off, limit)
        assert (part[0] == whole[0]).all() and (part[1] == whole[1]).all()


# --- pages -----------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T &amp; x</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body class="with-sidebar"><header><p>Site</p></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article class="post"><header><h1>Head &eacute;&#8211; {n}</h1></header><p>First   para\n{n}<br>line &lt;two&gt;<p>Second <b>bold <i>word</p>
<p>Follow us on everything</p><div class="ad-slot">Buy!</div><aside>More</aside><form><p>Mail</p></form><section id="comments"><p>Reader {n}</p></section>
<ul><li>point {n}</li></ul></article></main><footer>&copy; x</footer></body></html>"""


def page_text(n, template=True):
    rest = [] if template else ["Follow us on everything"]
    return "\n\n".join([f"Head é– {n}", f"First para {n} line <two>", "Second bold word", *rest, f"point {n}"])


def test_pages_template_and_elements(spark):
    rows = [(i, f"http://big.example/{i}", PAGE.format(n=i)) for i in range(8)] + [(8, "http://small.example/", PAGE.format(n=8)), (9, None, None), (10, "x", ""),
            (11, "http://t.example", "just text &amp; more"), (12, "http://u.example/1", "<p>unclosed <div><a href='"), (None, "http://big.example/1", PAGE.format(n=1)),
            (13, "http://v.example/", "<div id=content><p>Body</p></div><div class='sidebar'>no</div><p>out</p>"),
            (14, "http://w.example/", "<article><p>A</p><article class=comment><p>reply</p></article></article><p>rest</p>")]
    rows += [(20 + i, "http://copy.example/", "<article><p>same text</p><p>again</p></article>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit(0))
    got = html_extract.extract_pages(df).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    # the constant block of the large host belongs to its template ("Second bold word" too: it never changes)
    for i in range(8):
        assert by[i].text == "\n\n".join([f"Head é– {i}", f"First para {i} line <two>", f"point {i}"])
    assert by[8].text == page_text(8, template=False)
    assert (by[9].text, by[10].text, by[11].text, by[12].text) == ("", "", "just text & more", "unclosed")
    assert by[13].text == "Body" and by[14].text == "A" and by[20].text == "same text\n\nagain"
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def test_copies_of_an_article_keep_it(spark):
    """Mirrors with other menus, parts under one title, and edited copies are no template."""
    page = "<html><body><nav><p>menu {n}</p></nav><article><h1>{title}</h1>{body}</article><div>advert {n}</div><footer><p>all rights</p></footer></body></html>"
    body = "".join(f"<p>paragraph {k} of the long story</p>" for k in range(5))
    rows = [(i, f"http://mirror.example/{i}", page.format(n=i, title="One story", body=body)) for i in range(3)]
    rows += [(10 + i, f"http://mirror.example/o{i}", page.format(n=10 + i, title=f"Other {i}", body=f"<p>text {i}</p>")) for i in range(5)]
    rows += [(20 + i, f"http://parts.example/{i}", page.format(n=i, title="Long read", body=f"<p>The lead</p><p>part {i} goes on at some length</p>")) for i in range(4)]
    rows += [(30 + i, f"http://edits.example/{i}", page.format(n=i, title=f"Title {i}", body=body + f"<p>edit {i}</p>")) for i in range(4)]
    by = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    story = [f"paragraph {k} of the long story" for k in range(5)]
    assert all(by[i] == "\n\n".join(["One story", *story]) for i in range(3))
    assert all(by[10 + i] == f"Other {i}\n\ntext {i}" for i in range(5))
    assert all(by[20 + i] == f"Long read\n\nThe lead\n\npart {i} goes on at some length" for i in range(4))
    assert all(by[30 + i] == "\n\n".join([f"Title {i}", *story, f"edit {i}"]) for i in range(4))


def test_a_word_alone_does_not_spoil_a_section_of_an_article():
    text = lambda inner: html_extract.main_text(html_extract.parse(f"<article><p>start</p>{inner}</article>")[0], set())
    for name in ("id='related-work'", "id='search'", "id='social-history'", "class='table-widget'", "id='relatedWork'"):
        assert text(f"<section {name}><p>kept</p></section>") == "start\n\nkept"
        assert text(f"<section {name}><p><a href=x>only a link</a></p></section>") == "start"
    for name in ("id='comments'", "class='ad-slot'", "class='related-posts'", "class='shareButtons'", "class='x sidebar'"):
        assert text(f"<div {name}><p>gone</p></div>") == "start"
