"""Categories by a keyword table of any size.

``functions.category_from_title`` is a chain of ``when(contains)``: fine for the seven
fixed keywords, but every title is searched once per rule. Here a rule table (keyword,
category, priority) becomes one Aho-Corasick automaton, so a title is read once whatever the
number of rules: the automaton reports every keyword that stands in it, and the rule of least
priority wins, as the first one of the chain does.

An automaton is built once per worker from a broadcast of a bounded number of rules. A
larger table is used in slices by priority: titles that an earlier slice has
labelled are not searched again.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.labels import CATEGORY_OTHER

#: Rules of one automaton (about 100 MB in a worker for keywords of a dozen letters).
SLICE = 200_000
_AUTOMATA: dict[str, tuple] = {}


def automaton(rules: list[tuple[str, int]]):
    """(automaton, least number of an empty keyword or None) of (keyword, number) rules."""
    import ahocorasick

    a, empty = ahocorasick.Automaton(), None
    for keyword, number in rules:
        if keyword == "":  # stands in every title
            empty = number if empty is None else min(empty, number)
        elif number < a.get(keyword, number + 1):
            a.add_word(keyword, number)
    a.make_automaton()
    return a, empty


def first_rule(title: str | None, a, empty: int | None) -> int | None:
    """The least number of a rule whose keyword stands in the title."""
    if title is None:
        return None
    found = [] if empty is None else [empty]
    if len(a):
        found += [n for _, n in a.iter(title)]
    return min(found, default=None)


def _label(rules, key: str):
    @F.pandas_udf("long")
    def number(titles: pd.Series) -> pd.Series:
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = automaton(rules.value)
        a, empty = _AUTOMATA[key]
        return pd.Series([first_rule(t, a, empty) for t in titles], dtype="Int64")

    return number


def categorise(df: DataFrame, rules: DataFrame, title_col: str = "title", out_col: str = "category", default: str = CATEGORY_OTHER,
               slice_rules: int = SLICE) -> DataFrame:
    """``df`` with ``out_col``: the category of the rule of least ``priority`` whose
    ``keyword`` stands in the title (case-sensitive), else ``default``.

    ``rules`` has the columns ``keyword``, ``category``, ``priority``. A null keyword
    matches nothing, an empty one every title; equal priorities go by keyword, then category. A null title is ``default``."""
    spark = df.sparkSession
    wanted = rules.where(F.col("keyword").isNotNull()).orderBy("priority", "keyword", "category").select("keyword", "category")
    out = df.withColumn(out_col, F.lit(None).cast("string"))
    part: list = []

    def apply(out, part):
        kept = spark.sparkContext.broadcast([(r.keyword, i) for i, r in enumerate(part)])  # at most slice_rules
        names = spark.sparkContext.broadcast([r.category for r in part])
        number = _label(kept, uuid.uuid4().hex)

        @F.pandas_udf("string")
        def name(numbers: pd.Series) -> pd.Series:
            return numbers.map(lambda n: None if pd.isna(n) else names.value[int(n)])

        # one search per title: later slices only see titles without a category
        return out.withColumn(out_col, F.coalesce(F.col(out_col), name(number(F.when(F.col(out_col).isNull(), F.col(title_col))))))

    for rule in wanted.toLocalIterator():
        part.append(rule)
        if len(part) == slice_rules:
            out, part = apply(out, part), []
    if part:
        out = apply(out, part)
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(default)))
