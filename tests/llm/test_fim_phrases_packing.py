"""Fill-in-middle, phrases and packing against brute force, the tokenizers library and round trips."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests_llm_odd import ODD
from vitrine.llm import collocation, fim, packing
from vitrine.llm.bpe import Memory

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- fill in the middle -----------------------------------------------------------


def fim_by_hand(doc_id, text):
    text = text or ""
    n, d = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i: 8 * i + 8], 16) for i in range(4)]
    p, q = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b, c = text[:p], text[p:q], text[q:]
    if h[3] % 100 < 20:
        return n, "spm", p, q - p, f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", p, q - p, f"<P>{a}<S>{c}<M>{b}"


def test_fill_in_middle_equals_cutting_by_hand(spark, make):
    rng = np.random.default_rng(5)
    shared = "".join(rng.choice(list("añ€😀 \n<P"), 4000))
    rows = ODD + [(100 + i, shared[: 40 * i] + str(i), "a") for i in range(80)]
    rows += [(300, "x<P>y", "a"), (301, "a<S", "a"), (302, "<M>", "a"), (303, "<" * 50, "a"), (-4, "négatif", "a"), (304, "x" * 600 + "<S>" + "y" * 600, "b")]
    docs = make(rows).withColumn("n", F.lit(9)).withColumn("output", F.lit("other")).withColumn("form", F.lit("psm"))
    got = fim.fill_in_middle(docs).withColumn("back", fim.restored()).collect()
    want = sorted((repr(i), *map(repr, fim_by_hand(i, t)), repr(t or "")) for i, t, _ in rows)
    assert sorted(tuple(map(repr, r)) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(make([])).count() == 0
    one = fim.fim_digests(make([(7, "abc", "a")])).first()
    assert one.restored_sha256 == hashlib.sha256(b"abc").hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab<PSM>é😀 "), max_size=60), min_size=1, max_size=8), st.integers(1, 4))
def test_chunk_summaries_give_counts_markers_and_places(texts, bits):
    """Chunks of about 2 to 16 bytes: cuts fall inside code points and markers."""
    raw = [t.encode() for t in texts] * 2
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    c = fim.Chunks(np.frombuffer(b"".join(raw), np.uint8), off, Memory(500), bits)
    assert c.counts.tolist() == [len(t) for t in texts * 2]
    assert c.marked().tolist() == [any(m in t for m in ("<P>", "<S>", "<M>")) for t in texts * 2]
    for i, t in enumerate(texts * 2):
        at = np.arange(len(t) + 1)
        assert c.place(np.full(len(at), i), at).tolist() == [len(t[:k].encode()) for k in at]


# --- phrases -------------------------------------------------------------------------


def phrases_by_hand(rows, least, top=2000):
    f, n, first = defaultdict(Counter), Counter(), {}
    for i, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            ws = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(ws)
            for k in range(1, 5):
                for j in range(len(ws) - k + 1):
                    p = tuple(ws[j: j + k])
                    f[lang][p] += 1
                    if i is not None:
                        first[lang, p] = min(i, first.get((lang, p), i))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[j: j + len(p)] == p for j in range(len(q))) for q, b in cand.items()):
                continue
            score, cut = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]], first.get((lang, p))))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s, i) for r, (s, a, p, x, y, i) in enumerate(sorted(rows, key=lambda r: r[:3])[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"bits": 7}, {"group": 64, "bits": 9}])
def test_collocations_equal_brute_force(spark, options):
    """Also with fingerprints of a few bits, which collide all the time, and with texts cut into parts."""
    rng = np.random.default_rng(7)
    vocabulary = np.array(["new", "york", "city", "Hall", "été", "und", "a", "of", "über", "x y", "."])
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 40))) for _ in range(120)]
    rows = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [(None, "new  york\tcity hall, new york", "en"), (500, None, "en"), (501, "", None), (502, " \t\n", "fr"), (503, "w" * 300 + " " + "q r s t " * 200, "de"),
             (503, "q r s t " * 3, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("phrase", F.lit("other")).withColumn("f", F.lit(1))
    got = collocation.collocations(docs, min_count=6, **options).collect()
    assert sorted(map(tuple, got), key=repr) == phrases_by_hand(rows, 6)
    few = collocation.collocations(docs, min_count=6, top=3, **options).collect()
    assert sorted(map(tuple, few), key=repr) == phrases_by_hand(rows, 6, 3)


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocation.collocations(none).count() == 0
    assert collocation.collocations(spark.createDataFrame([(1, None, None)], none.schema)).count() == 0


# --- packing -------------------------------------------------------------------------


def test_encoder_gives_the_ids_of_the_tokenizers_library():
    with open(BYTES, encoding="utf-8") as f:
        config = f.read()
    whole, fast = Tokenizer.from_str(config), packing.encoder(config)
    texts = [t or "" for _, t, _ in ODD] + ["a" * 9000, " " * 900 + "x", "I'm here  1a²", "<|endoftext|><|endoftext|", "é" * 700, "\x85 ᠎​"]
    texts += list(whole.get_vocab())  # each entry of the vocabulary
    for text, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert fast(text).tolist() == want.ids
    with open(WORDS, encoding="utf-8") as f:
        assert packing.encoder(config := f.read())("Hi  there").tolist() == Tokenizer.from_str(config).encode("Hi  there", add_special_tokens=False).ids


def check_packed(rows, got, window):
    tok = Tokenizer.from_file(BYTES)
    want = Counter()
    for i, t, _ in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[repr(i), ids.tobytes()] += 1
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0, *[n for _, n in s[:-1]]]).tolist() and sum(n for _, n in s) <= window and min(n for _, n in s) > 0
    # pieces of each id: their checksums rebuild its documents' ids, each once
    by_id = defaultdict(Counter)
    for r in got:
        by_id[repr(r.doc_id)][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    for (i, raw), copies in want.items():
        ids, at = np.frombuffer(raw, "<u4"), [0] * copies
        for k in range(copies):
            while at[k] < len(ids):
                fits = [p for p in by_id[i] if p[0] == at[k] and p[3] == len(ids) and zlib.crc32(ids[p[0]: p[0] + p[1]].tobytes()) == p[2]]
                assert fits, (i, at[k])
                by_id[i][fits[0]] -= 1
                by_id[i] += Counter()
                at[k] += fits[0][1]
    assert not any(c.total() for c in by_id.values())
    return sequences


@pytest.mark.parametrize("options", [{"window": 64, "shard_tokens": 700}, {}])
def test_packing_holds_each_id_once(make, options):
    rng = np.random.default_rng(11)
    rows = ODD + [(100 + i, " ".join(rng.choice(["red", "green", "blue", "cyan", "été"], rng.integers(1, 150))), "a") for i in range(150)]
    rows += [(400, "the same words " * 30, "b")] * 60
    docs = make(rows).withColumn("length", F.lit("x")).withColumn("ids", F.lit("x")).withColumn("low", F.lit(0))
    got = packing.pack(docs, BYTES, **options).collect()
    window = options.get("window", 2048)
    sequences = check_packed(rows, got, window)
    total = sum(n for s in sequences.values() for _, n in s)
    short = sum(sum(n for _, n in s) < window for s in sequences.values())
    assert short <= 1 + total // options.get("shard_tokens", 1 << 21) * 2  # about one padded window a shard
    again = packing.pack(docs, BYTES, **options).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert packing.pack(make([]), BYTES).count() == 0


def test_neighbours_are_those_of_bm25():
    """A window is filled by the unused units of highest score, computed here unit by unit."""
    rng = np.random.default_rng(2)
    units = [np.append(rng.integers(10 * (i % 3), 10 * (i % 3) + 14, rng.integers(3, 30)), 1).astype(np.uint16) for i in range(60)]
    df = Counter(t for u in units for t in set(u.tolist()))
    idf = np.zeros(64)
    for t in range(64):
        idf[t] = np.log1p((60 - df[t] + 0.5) / (df[t] + 0.5))
    mean = float(np.mean([len(u) for u in units]))

    def score(u, v):
        tf = Counter(units[v].tolist())
        return sum(idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(units[v]) / mean)) for t in set(units[u].tolist()) if t in tf)

    used, windows = set(), defaultdict(list)
    for s, _, u, a, b in packing.fill(units, idf, mean, 50):
        windows[s].append((u, a, b))
    assert sorted(windows) == list(range(len(windows)))
    for s in sorted(windows):
        seed = windows[s][0][0]
        used.add(seed)
        for u, a, _ in windows[s][1:]:
            best = max(score(seed, v) for v in range(60) if v not in used)
            assert a == 0 and u not in used and score(seed, u) == pytest.approx(best, rel=1e-5)
            used.add(u)
    assert used == set(range(60))
    assert [sum(b - a for _, a, b in windows[s]) for s in sorted(windows)][:-1] == [50] * (len(windows) - 1)


def test_queries_of_the_new_operators(spark):
    import __spark_entry__ as E

    for name, n in (("op11_fim", 200), ("op13_packing", None)):
        got = E.queries()[name](spark, "/root/testdata/sf0.001")
        assert n is None or got.count() == n
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()
    check_packed([tuple(r) for r in docs], E.queries()["op13_packing"](spark, "/root/testdata/sf0.001").collect(), 2048)
