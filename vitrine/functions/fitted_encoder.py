"""A title encoder fitted to the corpus.

The default encoder adds all trigrams of a title into a few buckets, frequent and rare ones alike. This
one looks at the titles first:

1. document frequencies of ``FEATURES`` trigram buckets, one aggregate over the corpus;
2. a randomised range finder on the matrix of weighted trigrams (titles x features):
   a random projection, then ``passes`` rounds of multiplying by the transposed matrix and back. A
   task multiplies its titles with a small matrix (features x ``dim + EXTRA``) and adds up their
   contributions; the driver orthogonalises the sum. No title leaves its task, no matrix grows with the corpus;
3. titles are projected to the ``dim`` strongest directions of what was found.

Contributions are added as whole numbers, so the sum does not depend on how the
titles are dealt or in which order tasks end: equal corpora and seeds give equal encoders.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = 1 << 13
#: Directions kept beside the ``dim`` wanted ones while fitting.
EXTRA = 8
#: One in the whole numbers that contributions are added in.
_UNIT = float(1 << 24)
_ROWS = 2_048


def trigrams(texts, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the character trigrams of ``' ' + text + ' '`` in lower case, in order of row and bucket."""
    rows, buckets = [], []
    for i, text in enumerate(texts):
        if text is None:
            continue
        padded = f" {text.lower()} "
        found = [zlib.crc32(padded[k: k + 3].encode()) % features for k in range(len(padded) - 2)]
        rows += [i] * len(found)
        buckets += found
    key, count = np.unique(np.array(rows, np.int64) * features + np.array(buckets, np.int64), return_counts=True)
    return key // features, key % features, count


def _product(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by row."""
    out = np.zeros((n, values.shape[1]))
    if len(row):
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


@dataclass(frozen=True)
class FittedEncoder:
    weight: np.ndarray  #: of each feature (inverse document frequency)
    directions: np.ndarray  #: features x dim, orthonormal columns

    def rows(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) of the weighted unit rows of the matrix."""
        row, feature, count = trigrams(texts, len(self.weight))
        value = (1 + np.log(count)) * self.weight[feature]
        norm = np.sqrt(_product(row, value[:, None] ** 2, len(texts)))[:, 0]
        return row, feature, value / np.where(norm[row] > 0, norm[row], 1)

    def encode(self, texts) -> np.ndarray:
        """Unit vectors; zeros for a text without a known trigram."""
        out = []
        for a in range(0, len(texts), _ROWS):
            part = texts[a: a + _ROWS]
            row, feature, value = self.rows(part)
            y = _product(row, value[:, None] * self.directions[feature], len(part))
            norm = np.sqrt((y * y).sum(axis=1))
            out.append(y / np.where(norm > 1e-9, norm, 1)[:, None])
        return np.concatenate(out).astype(np.float32) if out else np.zeros((0, self.directions.shape[1]), np.float32)


def _frequencies(features: int):
    def run(batches):
        for b in batches:
            _, bucket, _ = trigrams(b["text"], features)
            n = np.bincount(bucket, minlength=features)
            yield pd.DataFrame({"feature": np.append(np.flatnonzero(n), -1), "n": np.append(n[n > 0], b["text"].notna().sum())})

    return run


def _contributions(model: FittedEncoder, right: np.ndarray):
    """For each feature, the sum of value * (row times ``right``) over the task's titles, as whole numbers."""
    names = [f"c{k}" for k in range(right.shape[1])]

    def run(batches):
        total = np.zeros((len(model.weight), right.shape[1]), np.int64)
        for b in batches:
            texts = b["text"].to_numpy()
            for a in range(0, len(texts), _ROWS):
                part = texts[a: a + _ROWS]
                row, feature, value = model.rows(part)
                y = _product(row, value[:, None] * right[feature], len(part))
                np.add.at(total, feature, np.rint(value[:, None] * y[row] * _UNIT).astype(np.int64))
        used = np.flatnonzero(total.any(axis=1))
        if len(used):
            yield pd.DataFrame(total[used], columns=names).assign(feature=used)

    return run


def fit_encoder(titles: DataFrame, text_col: str = "title", dim: int = 64, seed: int = 11, passes: int = 3,
                features: int = FEATURES) -> FittedEncoder:
    """An encoder for the titles of a corpus, read ``passes + 1`` times.

    The driver holds matrices of ``features`` x ``dim + EXTRA`` numbers (5 MB with the defaults), whatever the
    corpus. Null titles take no part. Without titles the encoder gives zeros."""
    texts = titles.select(F.col(text_col).cast("string").alias("text"))
    df = texts.mapInPandas(_frequencies(features), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    at, n = df.column("feature").to_numpy(), df.column("n").to_numpy()
    total = int(n[at < 0].sum())
    weight = np.zeros(features)
    weight[at[at >= 0]] = np.log((1 + total) / (1 + n[at >= 0])) + 1
    rng = np.random.default_rng(seed)
    k = min(dim + EXTRA, features)
    model = FittedEncoder(weight, np.zeros((features, dim)))
    basis, schema = rng.normal(size=(features, k)) / np.sqrt(k), "feature long, " + ", ".join(f"c{i} long" for i in range(k))
    strength = np.zeros(k)
    for _ in range(passes):
        parts = texts.mapInPandas(_contributions(model, basis), schema[schema.index(",") + 2:] + ", feature long")
        sums = parts.groupBy("feature").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]).toArrow()
        product = np.zeros((features, k))
        product[sums.column("feature").to_numpy()] = np.stack([sums.column(f"c{i}").to_numpy() for i in range(k)], axis=1) / _UNIT
        basis, strength, _ = np.linalg.svd(product, full_matrices=False)  # strongest first
    basis[:, strength < 1e-6 * max(strength.max(initial=0), 1e-9)] = 0  # fewer directions than asked for
    return FittedEncoder(weight, np.ascontiguousarray(np.pad(basis, ((0, 0), (0, max(0, dim - k))))[:, :dim]))


def encode_fitted(df: DataFrame, encoder: FittedEncoder, text_col: str = "title", out_col: str = "embedding") -> DataFrame:
    """``df`` with the vector of ``text_col`` in ``out_col``; a null text has a null vector."""
    shared = df.sparkSession.sparkContext.broadcast(encoder)  # features x dim numbers

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        values = texts.to_numpy()
        return pd.Series([None if t is None else v for t, v in zip(values, shared.value.encode(values))], dtype=object)

    return df.withColumn(out_col, vectors(F.col(text_col)))
