"""The fitted encoder: deterministic, close to the best projection, better on noisy titles."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.functions import fitted_encoder as FE
from vitrine.functions.encoder import encode_titles
from vitrine.operators.match import best_match

WORDS = ("geladeira fogão lavadora smartphone notebook televisor cafeteira micro-ondas ventilador aspirador samsung brastemp consul philips electrolux "
         "branco preto inox prata digital automático frost free 220v 110v").split()


def catalog(rng, n):
    return [" ".join(rng.choice(WORDS, 4)) + f" modelo {rng.integers(10, 99)}{chr(65 + rng.integers(0, 26))}{rng.integers(100, 999)}" for _ in range(n)]


def noisy(rng, title):
    """Shop text around it, words in another order, letters missing."""
    words = list(rng.permutation(title.split()))
    words = ["".join(c for c in w if rng.random() > 0.06) for w in words]
    extra = list(rng.choice(["oferta", "frete grátis", "em até 10x sem juros", "promoção", "original com nota fiscal", "garantia"], 3))
    return " ".join([extra[0], *words, *extra[1:]])


def matrix(model, titles):
    row, feature, value = model.rows(titles)
    out = np.zeros((len(titles), len(model.weight)))
    out[row, feature] = value
    return out


def test_same_corpus_and_seed_give_the_same_encoder(spark):
    rng = np.random.default_rng(1)
    titles = [*catalog(rng, 150), None, "", "a"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    one, two = FE.fit_encoder(df, dim=12, features=512), FE.fit_encoder(df.repartition(5), dim=12, features=512)
    assert np.array_equal(one.weight, two.weight) and np.array_equal(one.directions, two.directions)
    other = FE.fit_encoder(df, dim=12, features=512, seed=5)
    assert not np.array_equal(one.directions, other.directions)
    assert np.allclose(one.directions.T @ one.directions, np.eye(12), atol=1e-8)
    got = {r.title: r.embedding for r in FE.encode_fitted(df, one).collect()}
    assert got[None] is None and len(got["a"]) == 12 and sum(x * x for x in got[titles[0]]) == pytest.approx(1, abs=1e-5)
    empty = FE.fit_encoder(df.limit(0), dim=4, features=64)
    assert not empty.encode(["abc"]).any()


def test_projection_is_close_to_the_best_one(spark):
    """The found directions keep nearly as much of the matrix as the first singular vectors."""
    rng = np.random.default_rng(2)
    titles = catalog(rng, 200)
    model = FE.fit_encoder(spark.createDataFrame([(t,) for t in titles], "title string"), dim=10, features=400, passes=4)
    a = matrix(model, titles)
    singular = np.linalg.svd(a, compute_uv=False)
    kept = np.linalg.norm(a @ model.directions) ** 2
    assert kept <= (singular[:10] ** 2).sum() * (1 + 1e-6) and kept > 0.97 * (singular[:10] ** 2).sum()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), max_size=20), st.integers(0, 99))
def test_encoding_is_the_projection_of_the_rows(texts, seed):
    """Lengths never grow, and a vector is its row times the directions, normalised."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(64, 6)))[0]
    model = FE.FittedEncoder(rng.random(64) + 0.5, q)
    a, got = matrix(model, texts), model.encode(texts)
    assert np.allclose(np.linalg.norm(a, axis=1)[[bool(t and len(t) > 0) for t in texts]], 1) if texts else True
    y = a @ q
    norm = np.linalg.norm(y, axis=1)
    assert (norm <= 1 + 1e-9).all()
    assert np.allclose(got, y / np.where(norm > 1e-9, norm, 1)[:, None], atol=1e-5)


def test_recall_on_noisy_titles_beats_the_default(spark):
    rng = np.random.default_rng(3)
    titles = catalog(rng, 400)
    own = spark.createDataFrame(list(enumerate(titles)), "product_id long, title string")
    shop = spark.createDataFrame([(i, noisy(rng, t)) for i, t in enumerate(titles)], "product_id long, title string")
    model = FE.fit_encoder(own.unionByName(shop), dim=64)
    recall = lambda a, b: sum(r.source_id == r.target_id for r in best_match(a, b).collect()) / len(titles)
    fitted = recall(FE.encode_fitted(shop, model), FE.encode_fitted(own, model))
    default = recall(encode_titles(shop, dim=64), encode_titles(own, dim=64))
    assert fitted > default + 0.1 and fitted > 0.8, (fitted, default)
