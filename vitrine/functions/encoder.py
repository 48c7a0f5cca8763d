"""Title -> vector encoders (J1) and the embed-a-table job.

The default encoder is a hashed character-trigram term frequency,
L2-normalised, written entirely in Spark SQL expressions (no Python in the
hot path). A language model can be plugged in through
``model_encoder``: an iterator Pandas UDF that builds the model once per
Python worker and encodes Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions._util import as_col
from vitrine.functions.vectors import normalise


def _chars(text) -> Column:
    """The characters of ``' ' + lower(text) + ' '``; none for a null text."""
    padded = F.concat(F.lit(" "), F.lower(as_col(text)), F.lit(" "))
    return F.coalesce(F.regexp_extract_all(padded, F.lit("(?s)."), 0), F.array().cast("array<string>"))


def _bucket(gram, dim: int) -> Column:
    """The bucket of a gram (its characters joined by spaces): the first 32
    bits of its MD5, which any SQL engine can compute, modulo ``dim``."""
    return F.conv(F.substring(F.md5(gram), 1, 8), 16, 10).cast("long") % F.lit(dim)


def trigram_vector(text, dim: int = 64) -> Column:
    """Column form of the default encoder: character trigrams counted into
    ``dim`` buckets, L2-normalised; null text -> null vector, a text without
    a trigram -> zeros. Usable inside any expression; ``encode_titles`` gives
    the same vectors without interpreted counting."""
    chars = _chars(text)
    gram = lambda i: F.concat_ws(" ", F.get(chars, i), F.get(chars, i + 1), F.get(chars, i + 2))
    starts = F.when(F.size(chars) >= 3, F.sequence(F.lit(0), F.size(chars) - 3)).otherwise(F.array().cast("array<int>"))
    # counts accumulate bucket by bucket (a lambda variable is bound once,
    # so every gram is hashed once per row)
    counts = F.aggregate(
        F.transform(starts, lambda i: _bucket(gram(i), dim)),
        F.array_repeat(F.lit(0.0), dim),
        lambda acc, b: F.transform(acc, lambda x, i: x + F.when(i == b, F.lit(1.0)).otherwise(F.lit(0.0))),
    )
    vec = F.transform(normalise(counts), lambda x: x.cast("float"))
    return F.when(as_col(text).isNull(), F.lit(None)).otherwise(vec)


def _trigram_pipeline(df: DataFrame, text_col: str, dim: int, out_col: str) -> DataFrame:
    """Default encoder with Spark ML feature transformers (JVM loops): characters
    -> NGram(3) -> bucket numbers -> counts over the ``dim`` numbers ->
    Normalizer(L2) -> array<float>."""
    from pyspark.ml.feature import CountVectorizerModel, NGram, Normalizer
    from pyspark.ml.functions import vector_to_array

    tmp = [f"__{out_col}_{k}" for k in ("chars", "grams", "buckets", "tf", "unit")]
    staged = NGram(n=3, inputCol=tmp[0], outputCol=tmp[1]).transform(df.withColumn(tmp[0], _chars(F.col(text_col))))
    staged = staged.withColumn(tmp[2], F.transform(tmp[1], lambda g: _bucket(g, dim).cast("string")))
    count = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol=tmp[2], outputCol=tmp[3])
    staged = Normalizer(p=2.0, inputCol=tmp[3], outputCol=tmp[4]).transform(count.transform(staged))
    vec = F.when(F.col(text_col).isNull(), F.lit(None)).otherwise(vector_to_array(F.col(tmp[4]), "float32"))
    return staged.withColumn(out_col, vec).drop(*tmp)


def encode_titles(df: DataFrame, text_col: str = "title", dim: int = 64, out_col: str = "embedding",
                  encoder: Callable | None = None) -> DataFrame:
    """Add a vector column computed from ``text_col`` (default: hashed
    character trigrams as in ``trigram_vector``; or ``encoder(column)``, e.g. ``model_encoder``)."""
    if encoder is None:
        return _trigram_pipeline(df, text_col, dim, out_col)
    return df.withColumn(out_col, encoder(F.col(text_col)))


def model_encoder(factory: Callable[[], Callable[[list[str]], np.ndarray]]):
    """J1 with a model: ``factory()`` returns ``encode(list[str]) -> ndarray``
    and is called once per Python worker; batches follow
    ``spark.sql.execution.arrow.maxRecordsPerBatch``."""

    @F.pandas_udf("array<float>")
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for texts in batches:
            mask = texts.notna().to_numpy()
            out = [None] * len(texts)
            if mask.any():
                vecs = np.asarray(encode(texts[mask].astype(str).tolist()), dtype=np.float32)
                for k, v in zip(np.nonzero(mask)[0], vecs):
                    out[k] = v
            yield pd.Series(out, dtype=object)

    return _encode


def embed_table(spark: SparkSession, source_table: str, target_table: str, dim: int = 64,
                encoder: Callable | None = None, fmt: str = "parquet") -> str:
    """``title, price, url, categoria`` of a table plus the title vector,
    written over ``target_table``; returns its name."""
    from vitrine.sources.tables import scan_for_embedding

    df = scan_for_embedding(spark, source_table)
    out = encode_titles(df, "title", dim, encoder=encoder)
    out.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(target_table)
    return target_table
