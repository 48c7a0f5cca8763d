"""Label functions (H11-H16): similarity level, category, price band,
competitive advantage, flag normalisation, marketplace from match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions._util import as_col
from vitrine.schema import (
    EXCLUSIVE_SIMILARITY,
    LEVEL_EXCLUSIVE,
    LEVEL_LOW,
    LEVEL_MODERATE,
    LEVEL_VERY,
    Labels,
    Levels,
)

# ---------------------------------------------------------------------------
# Fixed values from the dashboard specification (keyword order matters: the
# first keyword found decides), price band edges and names, advantage text.
# ---------------------------------------------------------------------------
CATEGORY_RULES = [
    ("Geladeira", "Eletrodomésticos"),
    ("Fogão", "Eletrodomésticos"),
    ("Máquina", "Eletrodomésticos"),
    ("Smartphone", "Eletrônicos"),
    ("Notebook", "Eletrônicos"),
    ("TV", "Eletrônicos"),
]
CATEGORY_OTHER = "Outros"
PRICE_BANDS = [
    (100, "Até R$ 100"),
    (500, "R$ 100 - R$ 500"),
    (1000, "R$ 500 - R$ 1.000"),
    (5000, "R$ 1.000 - R$ 5.000"),
]
PRICE_BAND_TOP = "Acima de R$ 5.000"
CHEAPER_SUFFIX = "Mais Barata"
EQUAL_PRICES = "Preços Iguais"


def similarity_level(sim, levels: Levels = Levels()) -> Column:
    """-1 -> exclusivo; > very -> muito similar; >= moderate ->
    moderadamente similar; otherwise pouco similar. Null stays null."""
    s = as_col(sim)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s == EXCLUSIVE_SIMILARITY, F.lit(LEVEL_EXCLUSIVE))
        .when(s > levels.very, F.lit(LEVEL_VERY))
        .when(s >= levels.moderate, F.lit(LEVEL_MODERATE))
        .otherwise(F.lit(LEVEL_LOW))
    )


def category_from_title(title, rules=CATEGORY_RULES, other: str = CATEGORY_OTHER) -> Column:
    """Category of the first keyword contained in the title
    (case-sensitive); none -> ``Outros``."""
    t = as_col(title)
    out = None
    for keyword, category in rules:
        cond = t.contains(keyword)
        out = F.when(cond, F.lit(category)) if out is None else out.when(cond, F.lit(category))
    return out.otherwise(F.lit(other))


def price_band(price, bands=PRICE_BANDS, top: str = PRICE_BAND_TOP) -> Column:
    """First band whose upper edge (inclusive) holds the price."""
    p = as_col(price)
    out = F.when(p.isNull(), F.lit(None).cast("string"))
    for edge, name in bands:
        out = out.when(p <= edge, F.lit(name))
    return out.otherwise(F.lit(top))


def advantage(source_price, target_price, labels: Labels = Labels()) -> Column:
    """Which side is cheaper; any null -> null."""
    a, b = as_col(source_price), as_col(target_price)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("string"))
        .when(b < a, F.lit(f"{labels.target} {CHEAPER_SUFFIX}"))
        .when(b > a, F.lit(f"{labels.source} {CHEAPER_SUFFIX}"))
        .otherwise(F.lit(EQUAL_PRICES))
    )


def normalise_flag(flag) -> Column:
    """``Sim``/``Não`` and ``sim``/``não`` compare equal after this."""
    return F.lower(F.trim(as_col(flag)))


def marketplace_from_match(target_title, labels: Labels = Labels()) -> Column:
    """The target label when a target exists, else the source label."""
    return F.when(as_col(target_title).isNotNull(), F.lit(labels.target)).otherwise(F.lit(labels.source))
