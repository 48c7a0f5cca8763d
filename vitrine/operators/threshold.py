"""Exact thresholded similarity pairs by inverted lists (C2 on sparse vectors).

``match.similarity_pairs`` multiplies every pair. Most pairs of sparse vectors
(hashed trigrams of titles, for instance) share little, and a high threshold needs much
in common. All dimensions get one order, rarest first. Of a unit vector only
the **prefix** is listed: its dimensions, in that order, up to the one after which
the norm of what remains falls below the threshold. By Cauchy-Schwarz two vectors
whose prefixes share no dimension score below the threshold, so every
qualifying pair meets in the list of some dimension:

- a list holds the vectors with that dimension in their prefix, both sides;
- of a pair's shared dimensions the first in the order is responsible, and
  there the score is at most the product of the two norms from that dimension on:
  lists are sorted by that norm, and pairs below the threshold are not multiplied;
- the rest are multiplied and, where they reach it, re-scored exactly as the plain
  version does, so the rows are the same.

Copies of a vector are compared once: they are one **class**. ``class_pairs`` gives the pairs of classes and
who is in each; ``pairs_bounded`` gives every pair of all rows that hold them (k copies on both sides are
k * k rows): a class meets its pairs in blocks of at most about ``_COPIES`` rows, so that many copies are many small groups.

Each dimension is a group of block pairs (``match.match_by_key``); a dimension
that most vectors have is cut into many. Where the lists hold more pairs than ``max_share`` of
all (dense vectors, low thresholds), the plain version runs instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.match import (
    _CHUNK_ELEMS,
    _TOL,
    BLOCK_BYTES,
    _exact_scores,
    _unit_matrix,
    match_by_key,
    rescored_at_once,
    similarity_pairs,
    usable_vectors,
)
from vitrine.session import cut_lineage

_ROWS = 4_096  # rows that a kernel looks at together
_COPIES = 1_000  # rows of a class that meet its pairs as one group


@dataclass(frozen=True)
class Classes:
    """The classes of one side. A class has a number of its own, as an id may have several vectors."""

    rows: DataFrame  #: class, least (id), copies, vec
    members: DataFrame  #: class, copies and the id: every row with a usable vector
    most: int  #: copies of the largest class


@dataclass(frozen=True)
class ClassPairs:
    pairs: DataFrame  #: source_id, target_id (classes), similarity
    of_source: Classes
    of_target: Classes
    products: int  #: pairs of all rows
    listed: int  #: pairs of different vectors that meet in a list: at most so many are multiplied
    bounded: bool  #: False: the plain version ran, on one row per class


@dataclass(frozen=True)
class BoundedPairs:
    pairs: DataFrame  #: source_id, target_id, similarity
    products: int  #: pairs of the plain version
    listed: int  #: pairs of different vectors that meet in a list: at most so many are multiplied
    bounded: bool  #: False: the plain version ran


def _nonzero(batches):
    """Rows that have each dimension, one row per dimension and batch."""
    for b in batches:
        if len(b):
            n = np.count_nonzero(_unit_matrix(b["vec"]), axis=0)
            yield pd.DataFrame({"dim": np.flatnonzero(n), "n": n[n > 0]})


def remaining(unit: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Norm of each row from each position of the order on."""
    squares = unit[:, order] ** 2
    return np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])


def prefixes(unit: np.ndarray, order: np.ndarray, threshold: float) -> list[list[int]]:
    """Positions (in the order) of each row's prefix."""
    listed = (remaining(unit, order) >= threshold - _TOL) & (unit[:, order] != 0)
    return [np.flatnonzero(row).tolist() for row in listed]


def _prefix_rows(order: np.ndarray, threshold: float):
    def run(batches):
        for b in batches:
            for a in range(0, len(b), _ROWS):
                part = b.iloc[a: a + _ROWS]
                yield part.assign(keys=prefixes(_unit_matrix(part["vec"]), order, threshold))

    return run


def list_pairs(order: np.ndarray, threshold: float):
    """The kernel of one dimension: pairs that first meet there and reach the threshold."""
    def kernel(sdf: pd.DataFrame, tdf: pd.DataFrame):
        if not len(sdf) or not len(tdf):
            return
        at = int(sdf["key"].iloc[0])
        S, T = _unit_matrix(sdf["vec"]), _unit_matrix(tdf["vec"])
        sid, tid = sdf["source_id"].to_numpy(), tdf["target_id"].to_numpy()
        ns, nt = (np.sqrt((m[:, order[at:]] ** 2).sum(axis=1)) for m in (S, T))
        so, to = np.argsort(-ns, kind="stable"), np.argsort(-nt, kind="stable")
        S, sid, ns, T, tid, nt = S[so], sid[so], ns[so], T[to], tid[to], nt[to]
        earlier = order[:at]
        step, at_once = max(1, _CHUNK_ELEMS // len(tid)), rescored_at_once(S)
        for i in range(0, len(sid), step):
            # the chunk's greatest norm: targets from here on cannot reach the threshold with any of its rows
            stop = int(np.searchsorted(-nt, -(threshold - _TOL) / max(ns[i], _TOL), side="right"))
            if not stop:
                return
            r, c = np.nonzero(S[i: i + step] @ T[:stop].T >= threshold - _TOL)
            for k in range(0, len(r), at_once):
                a, b = i + r[k: k + at_once], c[k: k + at_once]
                here = ~((S[a][:, earlier] != 0) & (T[b][:, earlier] != 0)).any(axis=1)
                a, b = a[here], b[here]
                exact = _exact_scores(S, T, a, b)
                ok = exact >= threshold
                if ok.any():
                    yield pd.DataFrame({"source_id": sid[a[ok]], "target_id": tid[b[ok]], "similarity": exact[ok]})

    return kernel


def _classes(rows: DataFrame, name: str) -> Classes:
    """One row per different vector, and the rows behind each."""
    found = rows.groupBy("vec").agg(F.min(name).alias("least"), F.count("*").alias("copies"))
    one = cut_lineage(found.withColumn("class", F.monotonically_increasing_id()), "list-vectors")
    most = one.agg(F.max("copies").alias("n")).first().n or 0
    members = rows.join(one, "vec") if most > 1 else one.withColumnRenamed("least", name)
    return Classes(one, members.select("class", "copies", name), most)


def _expanded(pairs: DataFrame, name: str, classes: Classes) -> DataFrame:
    """Pairs of classes as pairs of all rows that hold them, on one side."""
    other = [c for c in pairs.columns if c != name]
    pairs, members, keys = pairs.withColumnRenamed(name, "class"), classes.members, ["class"]
    if classes.most > _COPIES:
        blocks = F.ceil(F.col("copies") / _COPIES)
        large = classes.rows.where(F.col("copies") > _COPIES).select("class", blocks.alias("blocks"))
        last = F.coalesce("blocks", F.lit(1).cast("long")) - 1
        pairs = pairs.join(large, "class", "left").select("class", *other, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
        members = members.withColumn("block", F.pmod(F.xxhash64(name), blocks))
        keys = ["class", "block"]
    return pairs.join(members, keys).select(name, *other)


def class_pairs(source: DataFrame, target: DataFrame, threshold: float, *, id_col: str = "product_id",
                vector_col: str = "embedding", rows_per_block: int = 50_000, block_bytes: int = BLOCK_BYTES,
                max_share: float = 0.5) -> ClassPairs:
    """The pairs of ``similarity_pairs`` between different vectors, and the rows that hold each vector.

    Thresholds of 0 or less bound nothing, and catalogs with several vector lengths have no common
    dimensions: the plain version runs. A zero vector scores 0 and is in no list."""
    s = cut_lineage(usable_vectors(source, id_col, vector_col, "source_id"), "list-sources")
    t = cut_lineage(usable_vectors(target, id_col, vector_col, "target_id"), "list-targets")
    size = [d.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b")).first() for d in (s, t)]
    total = size[0].n * size[1].n
    of_s, of_t = _classes(s, "source_id"), _classes(t, "target_id")
    s1, t1 = (c.rows.select(F.col("class").alias(name), "vec") for c, name in ((of_s, "source_id"), (of_t, "target_id")))
    classes = {"of_source": of_s, "of_target": of_t, "products": total}

    def plain(listed):
        names = {"vec": vector_col}
        pairs = similarity_pairs(s1.withColumnsRenamed({"source_id": id_col, **names}), t1.withColumnsRenamed({"target_id": id_col, **names}),
                                 threshold, id_col=id_col, vector_col=vector_col, rows_per_block=rows_per_block, block_bytes=block_bytes)
        return ClassPairs(pairs, **classes, listed=listed, bounded=False)

    if threshold <= 0 or not total or len({r[k] for r in size for k in ("a", "b")}) > 1:
        return plain(total)
    dims = size[0].a
    vectors = s1.select("vec").unionByName(t1.select("vec"))
    # one row per dimension
    n = {r.dim: r.n for r in vectors.mapInPandas(_nonzero, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    order = np.array(sorted(range(dims), key=lambda d: (n.get(d, 0), d)), np.int64)

    def listed(df, name):
        schema = f"{name} long, vec {dict(df.dtypes)['vec']}, keys array<long>"
        return cut_lineage(df.select(name, "vec").mapInPandas(_prefix_rows(order, threshold), schema), "list-prefixes")

    ls, lt = listed(s1, "source_id"), listed(t1, "target_id")
    counts = [{r.key: r.n for r in d.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).collect()}
              for d in (ls, lt)]
    met = sum(k * counts[1].get(key, 0) for key, k in counts[0].items())
    if met > max_share * total:
        return plain(met)
    rows = max(1, min(rows_per_block, block_bytes // (8 * dims)))
    rest = [d.select(name, "vec", F.explode("keys").alias("key")) for d, name in ((ls, "source_id"), (lt, "target_id"))]
    pairs = match_by_key(*rest, *counts, rows, list_pairs(order, threshold))
    return ClassPairs(pairs.select("source_id", "target_id", "similarity"), **classes, listed=met, bounded=True)


def pairs_bounded(source: DataFrame, target: DataFrame, threshold: float, **options) -> BoundedPairs:
    """The rows of ``similarity_pairs`` and how many pairs the lists hold; see ``class_pairs``."""
    got = class_pairs(source, target, threshold, **options)
    pairs = _expanded(_expanded(got.pairs, "source_id", got.of_source), "target_id", got.of_target)
    return BoundedPairs(pairs.select("source_id", "target_id", "similarity"), got.products, got.listed, got.bounded)


def similarity_pairs_bounded(source: DataFrame, target: DataFrame, threshold: float, **options) -> DataFrame:
    """``source_id, target_id, similarity`` as ``similarity_pairs`` gives them; see ``pairs_bounded``."""
    return pairs_bounded(source, target, threshold, **options).pairs


def class_pair_rows(source: DataFrame, target: DataFrame, threshold: float, **options) -> DataFrame:
    """The same pairs as ``similarity_pairs_bounded``, copies not multiplied out: rows of ``kind`` ``pair``
    (``source_id`` and ``target_id`` are class ids, with their ``similarity``), ``source`` and ``target``
    (a row's id and its ``class_id``). A class id is the least id of its class. Where no id has several vectors,
    joining the members to both ends of the pairs gives every pair."""
    got = class_pairs(source, target, threshold, **options)
    none = F.lit(None)

    def kind(df, name, **columns):
        return df.select(F.lit(name).alias("kind"), *[columns.get(k, none).cast(t).alias(k) for k, t in (
            ("source_id", "long"), ("target_id", "long"), ("class_id", "long"), ("similarity", "double"))])

    def least(df, classes, name):
        return df.join(classes.rows.select(F.col("class").alias(name), F.col("least").alias("least_" + name)), name)

    col = F.col
    pairs = least(least(got.pairs, got.of_source, "source_id"), got.of_target, "target_id")
    s, t = (c.members.join(c.rows.select("class", "least"), "class") for c in (got.of_source, got.of_target))
    return kind(pairs, "pair", source_id=col("least_source_id"), target_id=col("least_target_id"), similarity=col("similarity")).unionByName(
        kind(s, "source", source_id=col("source_id"), class_id=col("least"))).unionByName(
        kind(t, "target", target_id=col("target_id"), class_id=col("least")))
