"""The pipeline's stages, each on its predecessor's whole output, against plain Python where one exists."""

import importlib.util
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from vitrine.llm.common import written
from vitrine.llm.line_dedup import line_dedup
from vitrine.llm.mixing import mix_report
from vitrine.llm.quality import quality_report
from vitrine.llm.simhash import simhash_report

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = []
    for _, stage in C.STAGES:
        outs.append(written(stage(spark, outs[-1] if outs else docs, SF), "test-stage"))
    assert all(o.columns == docs.columns for o in outs[:-1])
    quality, lines, near, mixed, tokens = outs
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(quality) == ids(quality_report(docs, labels).where("selected"))
    assert {(r.doc_id, r.text) for r in lines.collect()} == {(r.doc_id, r.text) for r in line_dedup(quality).collect()}
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    assert set(ids(near)) == {r.component_id for r in simhash_report(lines).collect()}
    assert ids(mixed) == +Counter({r.doc_id: r.copies for r in mix_report(near).collect()})
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in tokens.collect():
        assert r.token_ids == t.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)
    assert ids(tokens) == ids(mixed)
    assert ids(E.queries()["pipeline"](spark, SF)) == ids(tokens)


def test_an_empty_corpus_passes_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), "test-empty")
    assert docs.count() == 0 and np.asarray(docs.columns).size == 3


def test_one_query_per_operator():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert importlib.util.find_spec("vitrine.llm") is not None
