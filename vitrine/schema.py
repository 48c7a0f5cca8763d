"""Canonical schemas, labels and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Flag spellings, similarity level names, default thresholds.
# ---------------------------------------------------------------------------
YES = "sim"
NO = "não"
LEVEL_EXCLUSIVE = "exclusivo"
LEVEL_VERY = "muito similar"
LEVEL_MODERATE = "moderadamente similar"
LEVEL_LOW = "pouco similar"
EXCLUSIVE_SIMILARITY = -1.0
DEFAULT_MATCH_THRESHOLD = 0.80
DEFAULT_VERY_SIMILAR = 0.85
DEFAULT_MODERATE = 0.50
NOT_AVAILABLE = "N/A"


@dataclass(frozen=True)
class Labels:
    """Marketplace names of the two catalogs (source = competitor side)."""

    source: str = "competitor"
    target: str = "own"
    source_base_url: str = "https://www.competitor.example"
    target_base_url: str = "https://www.own.example"


@dataclass(frozen=True)
class Levels:
    """Similarity level cuts: ``> very`` is very similar, ``>= moderate`` moderate."""

    very: float = DEFAULT_VERY_SIMILAR
    moderate: float = DEFAULT_MODERATE


CATALOG = T.StructType(
    [
        T.StructField("product_id", T.LongType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("marketplace", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("embedding", T.ArrayType(T.FloatType()), True),
    ]
)

BENCHMARK = T.StructType(
    [
        T.StructField("title", T.StringType(), True),
        T.StructField("marketplace", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("exclusivity", T.StringType(), True),
        T.StructField("similarity", T.DoubleType(), True),
        T.StructField("similarity_level", T.StringType(), True),
        T.StructField("diff_pct", T.DoubleType(), True),
    ]
)

BENCHMARK_VISIBLE = ["title", "marketplace", "price", "url", "exclusivity"]
BENCHMARK_HIDDEN = ["similarity", "similarity_level", "diff_pct"]
