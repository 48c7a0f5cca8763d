"""Refreshing a match after both catalogs changed (C1, C4, C5 day by day).

The winners of the last run are kept (``best_match(..., with_rank=True)``). A
winner stays valid while its source and its target keep their vectors, except
against targets that were not there before. So, of the rows with a usable vector:

- sources that are new, changed, or whose winner vanished (removed, or its vector
  changed) are matched with the whole target catalog;
- every other source is matched with new and changed targets only, and keeps
  the better of that and its old winner (ties, as ever, to the lowest target id);
- sources that are gone lose their row.

The rows are those of a full run; the products are
``open * targets + settled * new targets`` instead of ``sources * targets``.
Everything else is equi-joins by id. A target that many sources had chosen and that
vanished is one hot key of a left anti-join, whose large side Spark splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.match import best_match, best_of, usable_vectors
from vitrine.session import cut_lineage


@dataclass(frozen=True)
class RefreshedMatch:
    best: DataFrame  #: source_id, target_id, similarity, rank: the state of the next run
    open_sources: int  #: matched with all targets
    settled_sources: int  #: matched with new targets only
    targets: int
    new_targets: int

    @property
    def products(self) -> int:
        return self.open_sources * self.targets + self.settled_sources * self.new_targets

    @property
    def products_of_a_full_run(self) -> int:
        return (self.open_sources + self.settled_sources) * self.targets


def changes(before: DataFrame, now: DataFrame, name: str) -> DataFrame:
    """Rows of either state by id: ``name``, ``vec`` (now), ``was`` and
    ``stays`` (had a usable vector before; has the same one now)."""
    b = before.select(name, F.col("vec").alias("__before"))
    both = now.join(b, name, "full")
    return both.select(name, "vec", F.col("__before").isNotNull().alias("was"),
                       F.coalesce(F.col("vec") == F.col("__before"), F.lit(False)).alias("stays"))


def refresh_match(state: DataFrame, source_before: DataFrame, source: DataFrame, target_before: DataFrame, target: DataFrame,
                  *, id_col: str = "product_id", vector_col: str = "embedding", **options) -> RefreshedMatch:
    """The match of ``source`` and ``target``, given ``state``, the match (with
    ``rank``) of the catalogs as they were before. Ids are unique within a catalog.

    Rows without a usable vector count as absent, in either state; a first run has
    an empty state and empty catalogs before. ``options`` go to ``best_match``."""
    def vectors(df, name):
        return usable_vectors(df, id_col, vector_col, name)

    s = cut_lineage(changes(vectors(source_before, "source_id"), vectors(source, "source_id"), "source_id"), "changed-sources")
    t = cut_lineage(changes(vectors(target_before, "target_id"), vectors(target, "target_id"), "target_id"), "changed-targets")
    vanished = t.where("was AND NOT stays").select("target_id")
    kept = state.select("source_id", "target_id", "similarity", "rank").join(
        s.where("stays").select("source_id"), "source_id", "left_semi").join(vanished, "target_id", "left_anti")
    kept = cut_lineage(kept.select("source_id", "target_id", "similarity", "rank"), "kept-winners")
    now = s.where(F.col("vec").isNotNull()).select("source_id", "vec")
    known = kept.select("source_id")
    todo = cut_lineage(now.join(known, "source_id", "left_anti"), "open-sources")
    rest = now.join(known, "source_id", "left_semi")
    targets = t.where(F.col("vec").isNotNull())
    new = targets.where(~F.col("stays"))

    n = t.agg(F.count_if(F.col("vec").isNotNull()).alias("all"), F.count_if(F.col("vec").isNotNull() & ~F.col("stays")).alias("new")).first()
    n_open, n_kept = todo.count(), kept.count()

    def match(a, b):
        return best_match(a.withColumnsRenamed({"source_id": id_col, "vec": vector_col}),
                          b.select(F.col("target_id").alias(id_col), F.col("vec").alias(vector_col)),
                          id_col=id_col, vector_col=vector_col, with_rank=True, **options)

    best = kept
    if n["new"] and n_kept:
        best = best_of(kept.unionByName(match(rest, new)))
    if n_open and n["all"]:
        best = best.unionByName(match(todo, targets))
    return RefreshedMatch(cut_lineage(best, "best-match"), n_open, n_kept, n["all"], n["new"])
