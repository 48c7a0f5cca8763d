"""Encoders (J1) and the embed-a-table job."""

import numpy as np
import pytest

from vitrine.functions.encoder import embed_table, encode_titles, model_encoder, trigram_vector
from vitrine.operators.match import best_match


def test_default_encoder_unit_norm_and_nulls(spark):
    df = spark.createDataFrame([(1, "Geladeira Frost Free"), (2, None), (3, "")], "id long, title string")
    rows = {r.id: r.embedding for r in encode_titles(df, "title", dim=32).collect()}
    assert len(rows[1]) == 32 and sum(x * x for x in rows[1]) == pytest.approx(1.0, abs=1e-6)
    assert rows[2] is None and set(rows[3]) == {0.0}


def test_sql_trigram_vector_matches_its_definition(spark):
    df = spark.createDataFrame([("abcd",)], "t string")
    v = df.select(trigram_vector("t", 16).alias("v")).first().v
    assert sum(x * x for x in v) == pytest.approx(1.0, abs=1e-6) and sum(1 for x in v if x > 0) <= 4


def test_similar_titles_match_each_other(spark):
    a = spark.createDataFrame([(0, "Geladeira Brastemp 375L"), (2, "Smartphone Samsung Galaxy A54")],
                              "product_id long, title string")
    b = spark.createDataFrame([(1, "Smartphone Galaxy A54 Samsung 128GB"), (3, "Geladeira Brastemp Frost Free 375 L")],
                              "product_id long, title string")
    got = {r.source_id: r.target_id for r in best_match(encode_titles(a), encode_titles(b)).collect()}
    assert got == {0: 3, 2: 1}


def test_model_encoder_hook(spark):
    def _len_encoder():  # nested: shipped to workers by value
        def encode(texts):
            return np.array([[len(t), t.count("a") + 1.0] for t in texts])

        return encode

    df = spark.createDataFrame([(1, "aaa"), (2, None), (3, "bb")], "id long, title string")
    out = {r.id: r.embedding for r in encode_titles(df, "title", encoder=model_encoder(_len_encoder)).collect()}
    assert out[1] == [3.0, 4.0] and out[2] is None and out[3] == [2.0, 1.0]


def test_embed_table_job(spark):
    spark.createDataFrame([("TV 50", "R$ 2.000,00", "/tv", "Tv_e_Video")],
                          "title string, price string, url string, categoria string").createOrReplaceTempView("bronze_x")
    name = embed_table(spark, "bronze_x", "silver_embeddings_x", dim=16)
    row = spark.table(name).first()
    assert row.title == "TV 50" and len(row.embedding) == 16


def test_both_forms_of_the_default_encoder_agree(spark):
    texts = ["Smart TV 55", "Geladeira  Frost-Free", "", "a", "Fogão 4 bocas", "tv 📺 40", "x\ny", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    got = encode_titles(df, "title", dim=32).select("title", "embedding", trigram_vector("title", 32).alias("v")).collect()
    for r in got:
        assert (r.embedding is None) == (r.v is None) == (r.title is None)
        assert r.embedding is None or r.embedding == pytest.approx(r.v, abs=1e-7)
