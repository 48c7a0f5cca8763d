"""Exact top-1 match that skips what cannot win (C1 on clustered catalogs).

``match.best_match`` multiplies every source with every target. Vectors of real
titles lie in clusters, and most clusters are too far from a source to hold its
best target. Here the target is indexed by **pivots** (targets spread out over a bounded
sample): each target belongs to its nearest pivot and, by its distance to it, to a
band around it, its *cell*. Between unit vectors cosine and Euclidean distance
are one-to-one (d*d = 2 - 2cos), and distance obeys the triangle inequality: a
target in a band [lo, hi] around a pivot is no closer to a source at distance D from the
pivot than max(D - hi, lo - D, 0).

Three passes, none of which loses a possible winner:

1. a source's best pivot (a target itself) gives a first score;
2. the exact kernel of ``match`` on the cell with the smallest bound raises it;
3. the exact kernel on every other cell whose bound does not rule it out. A
   margin far above rounding keeps all ties, so the rows are those of
   ``best_match``.

Where pruning does not pay (the bounds leave more than ``max_share`` of all
products, as with vectors spread evenly in many dimensions), the plain blocked match runs
instead; up to there, a source has cost ``pivots`` products and one cell.

What is shipped: neighbouring cells make a bin of about one block of targets. A source goes
once to every bin that holds a cell it needs, with one bit per cell; the kernel
multiplies it with the targets of those cells only (or, where they are most of a block, the block). So rows that the bounds cannot help move as
often as in the plain match, not once per cell. Large cells, and bins
that many sources need, are cut into blocks by id hash.

The driver holds ``pivots`` vectors of the sample and one row per cell
(``pivots`` times the number of bands, whatever the catalogs' size).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.match import (
    BLOCK_BYTES,
    WINNER_SCHEMA,
    _collapse_copies,
    _unit_matrix,
    best_match,
    best_of,
    match_by_key,
    usable_vectors,
    winners_of,
)
from vitrine.session import cut_lineage

PIVOTS = 64
SAMPLE = 2_048  # targets that pivots are chosen from
BAND = 0.05  # width of a band of distances (they run from 0 to 2)
BANDS = math.ceil(2 / BAND) + 1
_ROWS = 1_024  # rows that a kernel scores against all cells at once
_SCORE_MARGIN = 1e-9  # scores this close are re-scored exactly, as in match
_DISTANCE_MARGIN = 1e-7  # the root of a rounding error of 1e-16 is 1e-8


@dataclass(frozen=True)
class PrunedMatch:
    best: DataFrame  #: source_id, target_id, similarity
    products: int  #: vector products of the plain match
    multiplied: int  #: products that the bounds do not rule out (a block of which that is most is multiplied whole)
    pruned: bool  #: False: the plain match ran

    @property
    def skipped(self) -> float:
        """Share of the products that the bounds saved."""
        return 1 - self.multiplied / self.products if self.products else 0.0


def spread(unit: np.ndarray, k: int) -> np.ndarray:
    """Rows far from each other: each next one is the furthest from those chosen (first row first)."""
    chosen, near = [], np.full(len(unit), np.inf)
    at = 0
    while len(chosen) < min(k, len(unit)) and near[at] > 1e-12:
        chosen.append(at)
        near = np.minimum(near, 2 - 2 * unit @ unit[at])
        at = int(near.argmax())
    return np.array(chosen, np.int64)


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * unit @ pivots.T, 0))


def _some(batches):
    """Frames of at most ``_ROWS`` rows: a kernel holds a score per row and cell."""
    for b in batches:
        for a in range(0, len(b), _ROWS):
            yield b.iloc[a: a + _ROWS].reset_index(drop=True)


def _cells(pivots: np.ndarray):
    """Adds each target's cell and its distance to its pivot. A zero vector has cell -1."""
    def run(batches):
        for b in _some(batches):
            unit = _unit_matrix(b["vec"])
            d = _distances(unit, pivots)
            near = d.argmin(axis=1)
            r = d[np.arange(len(d)), near]
            cell = near * BANDS + np.minimum((r / BAND).astype(np.int64), BANDS - 1)
            live = unit.any(axis=1)
            yield b.assign(cell=np.where(live, cell, -1), r=np.where(live, r, 0.0))

    return run


@dataclass(frozen=True)
class _Index:
    pivots: np.ndarray
    cell: np.ndarray  # cells that hold targets, ascending: a cell's place in here is its bit
    low: np.ndarray  # least and greatest distance to the pivot
    high: np.ndarray
    count: np.ndarray
    bin: np.ndarray  # bin of each cell

    def bounds(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance to each pivot, least distance to anything in each cell)."""
        d = _distances(unit, self.pivots)
        to = d[:, self.cell // BANDS]
        return d, np.maximum(np.maximum(to - self.high, self.low - to), 0)

    def needed(self, keep: np.ndarray) -> dict:
        """Columns of sources that need the cells of ``keep``: bits, bins, products."""
        bits = np.packbits(keep, axis=1, bitorder="little")
        return {"bits": [row.tobytes() for row in bits], "keys": [np.unique(self.bin[row]).tolist() for row in keep],
                "work": keep @ self.count}


def bins(counts: np.ndarray, rows: int) -> np.ndarray:
    """A bin for each cell, in order: cells of about ``rows`` targets together, or one larger cell."""
    out, held, number = np.zeros(len(counts), np.int64), 0, 0
    for i, n in enumerate(counts.tolist()):
        if held and held + n > rows:
            number, held = number + 1, 0
        out[i] = number
        held += n
    return out


def _first_scores(index: _Index):
    """Per source: the score of its best pivot, and the cell with the least bound (-1: a zero vector)."""
    def run(batches):
        for b in _some(batches):
            unit = _unit_matrix(b["vec"])
            live = unit.any(axis=1)
            d, bound = index.bounds(unit)
            # of cells that may hold an equal vector, the one around the nearest pivot
            home = (bound + d[:, index.cell // BANDS] * 1e-3).argmin(axis=1)
            keep = (np.arange(len(index.cell)) == home[:, None]) & live[:, None]
            yield b.assign(score=1 - d.min(axis=1) ** 2 / 2, home=np.where(live, home, -1), **index.needed(keep))

    return run


def _survivors(index: _Index):
    """Per source: the cells other than its first that its best score so far does not rule out."""
    def run(batches):
        for b in _some(batches):
            unit = _unit_matrix(b["vec"])
            _, bound = index.bounds(unit)
            reach = np.sqrt(np.maximum(2 - 2 * (b["score"].to_numpy() - _SCORE_MARGIN), 0)) + _DISTANCE_MARGIN
            keep = (bound <= reach[:, None]) & (np.arange(len(index.cell)) != b["home"].to_numpy()[:, None])
            yield b[["source_id", "vec"]].assign(**index.needed(keep))

    return run


def cell_winners(sdf: pd.DataFrame, tdf: pd.DataFrame) -> pd.DataFrame:
    """Best target of each source among the cells whose bits it has."""
    none = {"source_id": np.zeros(0, np.int64), "target_id": np.zeros(0, np.int64), "similarity": np.zeros(0), "rank": np.zeros(0, np.int64)}
    parts = [none]
    if len(sdf) and len(tdf):
        S, sid = _unit_matrix(sdf["vec"]), sdf["source_id"].to_numpy(dtype=np.int64)
        T, tid, at = _unit_matrix(tdf["vec"]), tdf["target_id"].to_numpy(dtype=np.int64), tdf["pos"].to_numpy(dtype=np.int64)
        bits = np.frombuffer(b"".join(sdf["bits"]), np.uint8).reshape(len(sdf), -1)
        cells, count = np.unique(at, return_counts=True)
        needs = bits[:, cells >> 3] >> (cells & 7).astype(np.uint8) & 1
        if 2 * int((needs @ count).sum()) > len(sid) * len(tid):  # most of the block: one product
            parts.append(winners_of(S, sid, *_collapse_copies(T, tid)))
        else:
            order = np.argsort(at, kind="stable")
            for i, rows in enumerate(np.split(order, np.cumsum(count)[:-1])):
                need = np.flatnonzero(needs[:, i])
                if len(need):
                    parts.append(winners_of(S[need], sid[need], *_collapse_copies(T[rows], tid[rows])))
    out = {k: np.concatenate([p[k] for p in parts]) for k in none}
    first = np.lexsort((out["target_id"], -out["rank"], out["source_id"]))
    sid = out["source_id"][first]
    first = first[np.append(True, sid[1:] != sid[:-1])] if len(sid) else first
    return pd.DataFrame({k: v[first] for k, v in out.items()})


def match_pruned(source: DataFrame, target: DataFrame, *, id_col: str = "product_id", vector_col: str = "embedding",
                 pivots: int = PIVOTS, rows_per_block: int = 50_000, block_bytes: int = BLOCK_BYTES,
                 max_share: float = 0.5) -> PrunedMatch:
    """The rows of ``best_match`` (C1, E4) and how many products they took.

    Vectors of one length only are pruned; a target catalog with several lengths, and one without vectors,
    go to the plain match. Copies of a target vector count once. Zero vectors score 0
    against everything: a zero source takes the lowest target id, a zero target wins only
    where every other score is below 0. Ids are unique on either side."""
    spark = source.sparkSession
    plain = {"id_col": id_col, "vector_col": vector_col, "rows_per_block": rows_per_block, "block_bytes": block_bytes}
    s = cut_lineage(usable_vectors(source, id_col, vector_col, "source_id"), "match-sources")
    t = cut_lineage(usable_vectors(target, id_col, vector_col, "target_id").groupBy("vec").agg(
        F.min("target_id").alias("target_id")), "match-targets")
    n_s = s.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b")).first()
    n_t = t.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b"),
                F.min("target_id").alias("first")).first()
    total = n_s.n * n_t.n
    sides = dict(source=s.withColumnsRenamed({"source_id": id_col, "vec": vector_col}),
                 target=t.withColumnsRenamed({"target_id": id_col, "vec": vector_col}))
    if not total or len({n_s.a, n_s.b, n_t.a, n_t.b}) > 1:
        return PrunedMatch(best_match(**sides, **plain), total, total, False)

    sample = t.orderBy(F.xxhash64("target_id"), "target_id").limit(SAMPLE).toPandas()
    unit = _unit_matrix(sample["vec"])
    unit = unit[unit.any(axis=1)]
    if not len(unit):
        return PrunedMatch(best_match(**sides, **plain), total, total, False)
    centres = unit[spread(unit, pivots)]
    vec = f"vec {dict(t.dtypes)['vec']}"
    targets = cut_lineage(t.mapInPandas(_cells(centres), f"{vec}, target_id long, cell long, r double"), "match-cells")
    # at most one row per pivot and band
    stats = targets.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"),
                                        F.min("target_id").alias("first")).orderBy("cell").collect()
    zero = [r.first for r in stats if r.cell < 0]
    stats = [r for r in stats if r.cell >= 0]
    rows = max(1, min(rows_per_block, block_bytes // (8 * n_t.b)))
    count = np.array([r.n for r in stats])
    index = _Index(centres, *[np.array([r[k] for r in stats]) for k in ("cell", "lo", "hi")], count, bins(count, rows))

    held = {int(k): int(count[index.bin == k].sum()) for k in np.unique(index.bin)}
    places = [(int(c), i, int(k)) for i, (c, k) in enumerate(zip(index.cell, index.bin))]
    place = spark.createDataFrame(places, "cell long, pos long, key long")
    in_bins = targets.join(place, "cell").select("target_id", "vec", "key", F.lit(None).cast("binary").alias("bits"), "pos")

    def by_cell(sources):
        """Winners among the needed cells; each source goes to the bins that hold them."""
        wanted = {r.key: r.n for r in sources.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).collect()}
        sent = sources.select("source_id", "vec", F.explode("keys").alias("key"), "bits", F.lit(None).cast("long").alias("pos"))
        return match_by_key(sent, in_bins, wanted, held, rows, cell_winners, WINNER_SCHEMA, ("bits", "pos"))

    columns = "bits binary, keys array<long>, work long"
    first = cut_lineage(s.mapInPandas(_first_scores(index), f"source_id long, {vec}, score double, home long, {columns}"), "match-first")
    one = cut_lineage(by_cell(first), "match-one")
    raised = first.where("home >= 0").join(best_of(one).select("source_id", "similarity"), "source_id").withColumn(
        "score", F.greatest("score", "similarity"))
    left = cut_lineage(raised.select("source_id", "vec", "score", "home").mapInPandas(
        _survivors(index), f"source_id long, {vec}, {columns}"), "match-left")
    work = n_s.n * len(centres) + sum(int(d.agg(F.sum("work")).first()[0] or 0) for d in (first, left))
    if work > max_share * total:
        return PrunedMatch(best_match(**sides, **plain), total, work, False)
    winners = one.unionByName(by_cell(left))
    none = F.lit(0).cast("long").alias("rank")
    if zero:
        winners = winners.unionByName(s.select("source_id", F.lit(zero[0]).cast("long").alias("target_id"), F.lit(0.0).alias("similarity"), none))
    if first.where("home < 0").limit(1).count():
        winners = winners.unionByName(first.where("home < 0").select(
            "source_id", F.lit(n_t["first"]).cast("long").alias("target_id"), F.lit(0.0).alias("similarity"), none))
    return PrunedMatch(best_of(winners).drop("rank"), total, work, True)


def best_match_pruned(source: DataFrame, target: DataFrame, **options) -> DataFrame:
    """``source_id, target_id, similarity`` as ``best_match`` gives them; see ``match_pruned``."""
    return match_pruned(source, target, **options).best
