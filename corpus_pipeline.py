"""A corpus pipeline: each stage reads all that the stage before it kept.

The last stage returns token ids; all others return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm.bpe import bpe_encode
from vitrine.llm.common import written
from vitrine.llm.line_dedup import line_dedup
from vitrine.llm.mixing import mix
from vitrine.llm.quality import quality_filter
from vitrine.llm.queries import tokenizer_path
from vitrine.llm.simhash import simhash_dedup
from vitrine.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample keeps."""
    return quality_filter(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; ``n_chars`` follows the text."""
    out = line_dedup(docs)
    return out.selectExpr(*[
        "cast(char_length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in out.columns
    ])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text."""
    return bpe_encode(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("source mixing", mixture),
    ("bpe encoding", tokens),
]

#: SQL cannot express the classifier and the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read again as the next stage's input."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage-" + name.replace(" ", "-"))
    return docs
