"""Exact nearest-neighbour matching between two catalogs.

Top-1 cosine join at scale
--------------------------
Both sides are cut into blocks by a hash of their id, and every source block
meets every target block exactly once: each row is copied to the block pairs
of its block, ``bp = source_block * target_blocks + target_block``. Both
sides go through ONE shuffle that places block pairs directly
(``repartitionById``): task ``k`` gets block pairs ``k, k + parts, ...``, so
tasks carry equal numbers of block pairs (hash placement would leave some
tasks with several pairs and others idle; on a 1000-slot cluster that makes
the stage about five times longer than needed). A ``mapInPandas`` streams
the rows of a task and multiplies one block pair at a time with one BLAS
call (in bounded chunks), emitting only the block-local winner of each
source row. When the target fits one block (the usual "small own catalog"
case) there is no further shuffle; otherwise a ``max_by`` over the
per-block winners picks the global one.

Nothing is broadcast, collected or cross-joined; a Python worker holds at
most one source block and one target block (``rows_per_block`` rows and at
most ``block_bytes`` of vectors each, so wide model vectors get shorter
blocks), whatever the skew of the data: blocks come from id hashes, not from
data keys. Of a block pair the targets come first and are held; the sources
pass by ``_SOURCE_ROWS`` at a time.

Exactness: BLAS scores are not bit-stable across block shapes, so every
candidate within ``_TOL`` of the block best is re-scored with a
position-independent sum, and ties go to the lowest target id. Identical
target vectors are collapsed to their lowest id before the product, which
keeps the candidate set small even when one vector has many copies. The
kernel rounds a score once, to a whole number of 1e-12 (``rank``); within a
block and across blocks winners are compared by that number alone.

A cosine is defined between vectors of the same length: where a catalog holds
several lengths, a row is compared with the other side's rows of its length,
and has no match if there are none.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.diffs import diff_symmetric
from vitrine.functions.urls import url_absolute
from vitrine.schema import EXCLUSIVE_SIMILARITY, NO, YES, Labels
from vitrine.session import task_slots

MATCH_SCHEMA = "source_id long, target_id long, similarity double"
WINNER_SCHEMA = MATCH_SCHEMA + ", rank long"
# Scores equal to 12 decimals are a tie (lowest target id wins): cosines that
# are equal in exact arithmetic can differ in the last bit depending on how
# the sum was formed, so "highest score" alone is not well defined.
TIE_DECIMALS = 12
_TOL = 1e-9  # far above BLAS error for unit vectors, far below real gaps
_CHUNK_ELEMS = 4_000_000  # score-matrix elements per chunk (32 MB)
_RESCORE_ELEMS = 1_000_000  # vector elements of either side re-scored per slice (8 MB)
_UNIT_ROWS = 4_096  # vectors brought to unit length together
_SOURCE_ROWS = 10_000  # sources of a block pair that the kernel gets at once
_MIN_SOURCE_BLOCK = 1_000  # smallest source block worth a task
BLOCK_BYTES = 128 << 20  # float64 vectors of one block side in a task
_MAX_PAIRS_PER_TASK = 16  # block pairs one match task streams (sorted by pair)
_HLL_RSD = 0.05  # relative error of the distinct-vector estimate (sizing only;
# a finer sketch costs more to compile than the count saves)


# ---------------------------------------------------------------------------
# numpy kernels (run inside mapInPandas tasks, one block pair at a time)
# ---------------------------------------------------------------------------


def _unit_matrix(vectors: pd.Series) -> np.ndarray:
    if len(vectors) == 0:
        return np.zeros((0, 0))
    vectors = vectors.to_numpy()
    m = np.empty((len(vectors), len(vectors[0])))
    for a in range(0, len(m), _UNIT_ROWS):
        part = m[a : a + _UNIT_ROWS]
        np.stack(vectors[a : a + _UNIT_ROWS], out=part, casting="same_kind")
        n = np.sqrt((part * part).sum(axis=1))
        n[n == 0] = 1.0
        part /= n[:, None]
    return m


def rescored_at_once(m: np.ndarray) -> int:
    """Pairs of rows of ``m`` that are re-scored together."""
    return max(1, _RESCORE_ELEMS // max(1, m.shape[1]))


def _exact_scores(S: np.ndarray, T: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Dot products summed the same way for every pair, whatever its position."""
    out = np.empty(len(rows))
    step = rescored_at_once(S)
    for k in range(0, len(rows), step):
        r, c = rows[k : k + step], cols[k : k + step]
        out[k : k + step] = (S[r] * T[c]).sum(axis=1)
    return out


def _collapse_copies(T: np.ndarray, tid: np.ndarray):
    order = np.argsort(tid, kind="stable")
    T, tid = T[order], tid[order]
    _, first = np.unique(T, axis=0, return_index=True)
    first.sort()
    return T[first], tid[first]


def _ranks(scores: np.ndarray) -> np.ndarray:
    """Scores as whole numbers of 10**-TIE_DECIMALS: equal numbers are ties."""
    return np.rint(scores * 10.0**TIE_DECIMALS).astype(np.int64)


def _by_length(sdf: pd.DataFrame, tdf: pd.DataFrame):
    """The rows of both sides for each vector length that both have."""
    sl, tl = sdf["vec"].map(len), tdf["vec"].map(len)
    lengths = np.intersect1d(sl, tl)
    if len(lengths) == 1 and sl.nunique() == 1 and tl.nunique() == 1:
        yield sdf, tdf
    else:
        for n in lengths:
            yield sdf[sl == n], tdf[tl == n]


def block_winners(sdf: pd.DataFrame, tdf: pd.DataFrame) -> pd.DataFrame:
    """Best target of every source row of one block pair (pure numpy)."""
    parts = [_winners(s, t) for s, t in _by_length(sdf, tdf)]
    if not parts:
        return pd.DataFrame({"source_id": pd.Series([], dtype="int64"), "target_id": pd.Series([], dtype="int64"),
                             "similarity": pd.Series([], dtype="float64"), "rank": pd.Series([], dtype="int64")})
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


def _winners(sdf: pd.DataFrame, tdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(winners_of(
        _unit_matrix(sdf["vec"]), sdf["source_id"].to_numpy(dtype=np.int64),
        *_collapse_copies(_unit_matrix(tdf["vec"]), tdf["target_id"].to_numpy(dtype=np.int64))))


def winners_of(S: np.ndarray, sid: np.ndarray, T: np.ndarray, tid: np.ndarray) -> dict[str, np.ndarray]:
    """The best row of ``T`` (different unit vectors, by id) for every row of ``S``."""
    zero_src = ~S.any(axis=1)
    chunk = max(1, _CHUNK_ELEMS // max(1, len(tid)))
    parts = []
    for i0 in range(0, len(sid), chunk):
        Sc = S[i0 : i0 + chunk]
        live = ~zero_src[i0 : i0 + chunk]
        if live.any():
            rows_live = np.nonzero(live)[0]
            G = Sc[rows_live] @ T.T
            best = G.max(axis=1)
            r, c = np.nonzero(G >= (best - _TOL)[:, None])
            r = rows_live[r]
            exact = _exact_scores(Sc, T, r, c)
            rank = _ranks(exact)
            o = np.lexsort((tid[c], -rank, r))
            rs = r[o]
            keep = o[np.r_[True, rs[1:] != rs[:-1]]]
            parts.append((sid[i0 + r[keep]], tid[c[keep]], exact[keep], rank[keep]))
        if (~live).any():
            # a zero vector scores 0 against every target: lowest id wins
            z = np.nonzero(~live)[0]
            parts.append((sid[i0 + z], np.full(len(z), tid[0], dtype=np.int64), np.zeros(len(z)), np.zeros(len(z), dtype=np.int64)))
    return {k: np.concatenate([p[i] for p in parts]) for i, k in enumerate(("source_id", "target_id", "similarity", "rank"))}


def block_pairs_above(sdf: pd.DataFrame, tdf: pd.DataFrame, threshold: float):
    """Every (source, target) pair of one block pair scoring >= threshold,
    yielded per score chunk: a low threshold can let every pair through,
    so the output is never gathered for the whole block pair."""
    for s, t in _by_length(sdf, tdf):
        yield from _above(s, t, threshold)


def _above(sdf: pd.DataFrame, tdf: pd.DataFrame, threshold: float):
    S = _unit_matrix(sdf["vec"])
    T = _unit_matrix(tdf["vec"])
    sid = sdf["source_id"].to_numpy(dtype=np.int64)
    tid = tdf["target_id"].to_numpy(dtype=np.int64)
    chunk = max(1, _CHUNK_ELEMS // max(1, len(tid)))
    for i0 in range(0, len(sid), chunk):
        Sc = S[i0 : i0 + chunk]
        G = Sc @ T.T
        r, c = np.nonzero(G >= threshold - _TOL)
        exact = _exact_scores(Sc, T, r, c)
        ok = exact >= threshold
        if ok.any():
            yield pd.DataFrame({"source_id": sid[i0 + r[ok]], "target_id": tid[c[ok]], "similarity": exact[ok]})


# ---------------------------------------------------------------------------
# Spark plans
# ---------------------------------------------------------------------------


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, name: str) -> DataFrame:
    """``name``, ``vec``: rows with a usable vector. One that is null, empty, or holds a null,
    NaN or infinite element counts as missing (a cosine is not defined)."""
    # NaN is above infinity in Spark's order, so one comparison serves
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return df.select(F.col(id_col).cast("long").alias(name), F.col(vector_col).alias("vec")).where(
        F.col("vec").isNotNull() & (F.size("vec") > 0) & finite
    )


def _block_counts(s: DataFrame, t: DataFrame, rows_per_block: int, ns: int | None, nt: int | None,
                  on_empty: str = "empty", distinct_target: bool = False, block_bytes: int = BLOCK_BYTES):
    """Blocks per side so that a block holds about ``rows_per_block`` rows
    and at most ``block_bytes`` of float64 vectors.

    One aggregate over both sides sizes the grid (pass explicit block
    counts to skip it): the source count, the target count and the widest
    vector. For the top-1 match the target count is the number of
    *distinct* vectors (copies are collapsed before the product), estimated
    by HyperLogLog over the vector hash, so sizing shuffles only per-task
    sketches, never the vectors. Rows without a usable vector count on
    neither side. Block counts change the speed, not the
    result, which is exact for any layout. Source blocks are added until
    the block grid can occupy ``defaultParallelism`` task slots (each source
    block keeps at least ``_MIN_SOURCE_BLOCK`` rows)."""
    if ns and nt and on_empty != "error":
        return ns, nt
    # a count of the rows that have a vector (of a Parquet source, their null flags and lengths)
    src_side = s.select(F.lit(True).alias("_src"), F.lit(None).cast(dict(t.dtypes)["vec"]).alias("vec"))
    tagged = src_side.unionByName(t.select(F.lit(False).alias("_src"), "vec"))
    src, vec = F.col("_src"), F.col("vec")
    n_t = F.approx_count_distinct(F.when(~src, F.xxhash64(vec)), _HLL_RSD) if distinct_target else F.count_if(~src)
    n = tagged.agg(F.count_if(src).alias("s"), n_t.alias("t"), F.max(F.size(vec)).alias("dim")).first()
    if on_empty == "error" and not (n.s and n.t):
        raise ValueError("cannot match: a catalog has no rows with a vector")
    rows = max(1, min(rows_per_block, block_bytes // (8 * max(1, n.dim or 1))))
    size = lambda k: max(1, math.ceil((k or 0) / rows))
    nt = nt or size(n.t)
    if not ns:
        # enough block pairs to occupy the cluster: more source blocks only
        # replicate the (bounded) target block, never the source rows
        slots = task_slots(s.sparkSession)
        ns = max(size(n.s), min(math.ceil(slots / nt), math.ceil((n.s or 0) / _MIN_SOURCE_BLOCK)))
        ns = max(1, ns)
    return ns, nt


def _block_pairs(s: DataFrame, t: DataFrame, ns: int, nt: int):
    """Rows of both sides, each copied to the block pairs of its block and
    placed by block pair: one shuffle, equal numbers of block pairs per
    task, rows of a task ordered by block pair, targets first.
    Columns ``side`` (0 source, 1 target), ``id``, ``vec``, ``bp``."""
    pairs = ns * nt
    if pairs >= 2**31:
        raise ValueError(f"{ns} x {nt} block pairs: raise rows_per_block")
    spark = s.sparkSession
    wide = max(3 * task_slots(spark), int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    # a task holds at most _MAX_PAIRS_PER_TASK block pairs (each at most
    # block_bytes of vectors): huge grids get more tasks, not bigger sorts
    per_task = min(math.ceil(pairs / wide), _MAX_PAIRS_PER_TASK)
    parts = math.ceil(pairs / per_task)  # every task gets per_task or per_task - 1 pairs
    src = s.select(
        F.lit(0).alias("side"), F.col("source_id").alias("id"), "vec",
        F.pmod(F.xxhash64("source_id"), F.lit(ns)).cast("int").alias("sb"),
    ).withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(nt - 1))))
    tgt = t.select(
        F.lit(1).alias("side"), F.col("target_id").alias("id"), "vec",
        F.pmod(F.xxhash64("target_id"), F.lit(nt)).cast("int").alias("tb"),
    ).withColumn("sb", F.explode(F.sequence(F.lit(0), F.lit(ns - 1))))
    rows = src.unionByName(tgt).select("side", "id", "vec", (F.col("sb") * nt + F.col("tb")).alias("bp"))
    rows = rows.repartitionById(parts, "bp")  # partition = bp mod parts
    return rows.sortWithinPartitions("bp", F.desc("side"))


def _per_block_pair(batches, kernel, extra=()):
    """Run ``kernel(source_frame, target_frame)`` over each block pair of a
    task's row stream (ordered by ``bp``, targets first): the targets of one block
    pair are held, its sources go through the kernel ``_SOURCE_ROWS`` at a time. The
    frames have the id, the vector and the ``extra`` columns."""
    cols = ["id", "vec", *extra]
    targets, sources, held, current = [], [], 0, None

    def flush():
        nonlocal targets, sources, held
        waiting, sources, held = sources, [], 0
        if not waiting or not targets:
            return
        if len(targets) > 1:
            targets = [pd.concat(targets, ignore_index=True)]
        out = kernel(pd.concat(waiting, ignore_index=True), targets[0])
        # a kernel returns one frame or yields several (bounded chunks)
        yield from (o for o in ([out] if isinstance(out, pd.DataFrame) else out) if len(o))

    for b in batches:
        if len(b) == 0:
            continue
        bp, side = b["bp"].to_numpy(), b["side"].to_numpy()
        cuts = np.flatnonzero((bp[1:] != bp[:-1]) | (side[1:] != side[:-1])) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(b)]):
            if current is None or bp[lo] != current:
                yield from flush()
                targets, current = [], bp[lo]
            if side[lo] == 1:
                targets.append(b.iloc[lo:hi][cols].rename(columns={"id": "target_id"}).reset_index(drop=True))
                continue
            for k in range(lo, hi, _SOURCE_ROWS):
                part = b.iloc[k : min(hi, k + _SOURCE_ROWS)][cols]
                sources.append(part.rename(columns={"id": "source_id"}))
                held += len(part)
                if held >= _SOURCE_ROWS:
                    yield from flush()
    yield from flush()


def _match_blocks(s: DataFrame, t: DataFrame, ns: int, nt: int, kernel, schema: str = MATCH_SCHEMA) -> DataFrame:
    rows = _block_pairs(s, t, ns, nt)
    return rows.mapInPandas(lambda it: _per_block_pair(it, kernel), schema=schema)


def match_by_key(sources: DataFrame, targets: DataFrame, wanted: dict[int, int], held: dict[int, int], rows: int,
                 kernel, schema: str = MATCH_SCHEMA, extra: tuple = ()) -> DataFrame:
    """``kernel`` on the sources and targets of each ``key`` (columns
    ``source_id``/``target_id``, ``vec``, ``key``), given how many rows of either
    side a key has (``wanted``, ``held``). A key's rows are cut into blocks of about
    ``rows`` rows by id hash, so a key that most rows share is many block pairs; pairs are
    numbered and placed as in the plain match, small ones several to a task. The kernel also
    gets the ``extra`` columns (those of both sides)."""
    spark = sources.sparkSession
    grid, pairs, moved = [], 0, 0
    for key, n in sorted(wanted.items()):
        ns, nt = math.ceil(n / rows), math.ceil(held.get(key, 0) / rows)
        if ns and nt:
            grid.append((key, pairs, ns, nt))
            pairs += ns * nt
            moved += n * nt + held[key] * ns
    if not grid:
        return spark.createDataFrame([], schema)
    if pairs >= 2**31:
        raise ValueError(f"{pairs} block pairs: raise rows_per_block")
    table = spark.createDataFrame(grid, "key long, base long, ns long, nt long")

    def side(df, k, name, own, other):
        block = F.pmod(F.xxhash64(name), F.col(own))
        out = df.join(table, "key").select(
            F.lit(k).alias("side"), F.col(name).alias("id"), "vec", "key", *extra, "base", "nt", block.alias(own[1] + "b"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[1] + "b"))
        return out.select("side", "id", "vec", "key", *extra, (F.col("base") + F.col("sb") * F.col("nt") + F.col("tb")).cast("int").alias("bp"))

    both = side(sources, 0, "source_id", "ns", "nt").unionByName(side(targets, 1, "target_id", "nt", "ns"))
    wide = max(3 * task_slots(spark), int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    parts = min(pairs, max(wide, math.ceil(moved / (2 * rows))))  # a task gets a few blocks' rows at most
    placed = both.repartitionById(parts, "bp").sortWithinPartitions("bp", F.desc("side"))
    return placed.mapInPandas(lambda it: _per_block_pair(it, kernel, ("key", *extra)), schema=schema)


def best_of(winners: DataFrame) -> DataFrame:
    """The best of several winners per source: highest rank, then lowest target id."""
    pick = F.max_by(F.struct("target_id", "similarity", "rank"), F.struct("rank", -F.col("target_id")))
    return winners.groupBy("source_id").agg(pick.alias("m")).select("source_id", "m.target_id", "m.similarity", "m.rank")


def best_match(
    source: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "product_id",
    vector_col: str = "embedding",
    rows_per_block: int = 50_000,
    source_blocks: int | None = None,
    target_blocks: int | None = None,
    on_empty: str = "empty",
    block_bytes: int = BLOCK_BYTES,
    with_rank: bool = False,
) -> DataFrame:
    """C1 + E4: for each source row with a vector, the target with the
    highest cosine (H17); ties (equal to ``TIE_DECIMALS`` decimals) go to the
    lowest target id.

    Returns ``source_id, target_id, similarity`` (and ``rank``, the score that
    ties are decided by, if asked for). Sources get no row when the
    target side is empty (callers left-join, see C7); ``on_empty="error"``
    raises instead, as the pairing stage of the reference does.

    Block sizing reads both sides' vectors once
    before the match reads them again: pass tables, or materialise computed
    vectors first (``embed_table``, ``session.cut_lineage``) so an encoder
    does not run twice.
    """
    s = usable_vectors(source, id_col, vector_col, "source_id")
    t_all = usable_vectors(target, id_col, vector_col, "target_id")
    ns, nt = _block_counts(s, t_all, rows_per_block, source_blocks, target_blocks, on_empty,
                           distinct_target=True, block_bytes=block_bytes)
    # identical target vectors can only tie, and the lowest id wins a tie:
    # keep one row per distinct vector before replication (partial
    # aggregation collapses a vector with millions of copies map-side)
    t = t_all.groupBy("vec").agg(F.min("target_id").alias("target_id"))
    winners = _match_blocks(s, t, ns, nt, block_winners, WINNER_SCHEMA)
    # with one target block every source has one winner already
    winners = winners if nt == 1 else best_of(winners)
    return winners if with_rank else winners.drop("rank")


def similarity_pairs(
    source: DataFrame,
    target: DataFrame,
    threshold: float,
    *,
    id_col: str = "product_id",
    vector_col: str = "embedding",
    rows_per_block: int = 50_000,
    source_blocks: int | None = None,
    target_blocks: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The similarity matrix restricted to scores ``>= threshold``, as
    rows ``source_id, target_id, similarity`` (never a dense matrix).

    Blocks are those of the top-1 match. A task hands its pairs over in
    chunks, so its memory does not grow with them; the result does: up to
    source rows times target rows when the threshold lets everything
    through. Give a threshold that few pairs reach, or aggregate the rows."""
    s = usable_vectors(source, id_col, vector_col, "source_id")
    t = usable_vectors(target, id_col, vector_col, "target_id")
    ns, nt = _block_counts(s, t, rows_per_block, source_blocks, target_blocks, block_bytes=block_bytes)
    return _match_blocks(s, t, ns, nt, lambda a, b: block_pairs_above(a, b, threshold))


def _prefixed(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def attach_match(
    source: DataFrame,
    target: DataFrame,
    best: DataFrame,
    threshold: float,
    cols=("title", "price", "url"),
) -> DataFrame:
    """C3 (and C7): every source row kept; the best target's columns filled
    only when ``similarity >= threshold``. A source without any candidate
    (empty target) gets similarity 0.

    Columns: ``source_id, source_<c>..., target_id, target_<c>...,
    similarity, matched``.
    """
    s = _prefixed(source, "source", ("product_id",) + tuple(cols)).withColumnRenamed(
        "source_product_id", "source_id"
    )
    t = _prefixed(target, "target", ("product_id",) + tuple(cols)).withColumnRenamed(
        "target_product_id", "best_target_id"
    )
    b = best.withColumnRenamed("target_id", "best_target_id")
    joined = s.join(b, "source_id", "left").join(t, "best_target_id", "left")
    sim = F.coalesce(F.col("similarity"), F.lit(0.0))
    matched = F.col("similarity").isNotNull() & (F.col("similarity") >= threshold)
    out = [F.col("source_id")] + [F.col(f"source_{c}") for c in cols]
    out += [F.when(matched, F.col("best_target_id")).alias("target_id")]
    out += [F.when(matched, F.col(f"target_{c}")).alias(f"target_{c}") for c in cols]
    out += [sim.alias("similarity"), matched.alias("matched")]
    return joined.select(*out)


def matched_pairs(source: DataFrame, target: DataFrame, best: DataFrame, labels: Labels = Labels(),
                  absolute_urls: bool = True) -> DataFrame:
    """C4 and C8 as one row per pair, both members side by side, no
    threshold: ``pair_id`` (= source id), ``target_id``, title, price and url
    of each side, ``similarity`` and the symmetric difference (H8).

    De-duplication may later drop either member's row; what describes pairs
    (D11, D18-D20, S5, S6, K9) reads this table and sees all of them."""
    cols = ("product_id", "title", "price", "url")
    s, t = _prefixed(source, "source", cols), _prefixed(target, "target", cols)
    p = best.join(s, best.source_id == s.source_product_id).join(t, best.target_id == t.target_product_id)
    s_url = url_absolute("source_url", labels.source_base_url) if absolute_urls else F.col("source_url")
    t_url = url_absolute("target_url", labels.target_base_url) if absolute_urls else F.col("target_url")
    return p.select(
        F.col("source_id").alias("pair_id"), "target_id", "source_title", "target_title", "source_price", "target_price",
        s_url.alias("source_url"), t_url.alias("target_url"), "similarity",
        diff_symmetric("source_price", "target_price").alias("diff_pct"),
    )


def pair_rows(source: DataFrame, target: DataFrame, best: DataFrame, labels: Labels = Labels(),
              absolute_urls: bool = True) -> DataFrame:
    """C4: every source row paired with its best target, no threshold; two
    output rows per pair (source side first) sharing ``pair_id`` (= source
    id). ``diff_pct`` is the symmetric difference (H8) of the intact pair and
    ``partner_price`` the other member's price (C8), so both outlive the
    removal of that member's row.
    """
    def side(k, pid, own, mk, other):
        return F.struct(
            F.lit(k).alias("side"), F.col(pid).alias("product_id"), F.col(f"{own}_title").alias("title"),
            F.lit(mk).alias("marketplace"), F.col(f"{own}_price").alias("price"), F.col(f"{own}_url").alias("url"),
            F.col(f"{other}_price").alias("partner_price"),
        )

    both = F.array(side(0, "pair_id", "source", labels.source, "target"),
                   side(1, "target_id", "target", labels.target, "source"))
    return matched_pairs(source, target, best, labels, absolute_urls).select(
        "pair_id", "similarity", "diff_pct", F.explode(both).alias("r")
    ).select(
        "pair_id", "r.side", "r.product_id", "r.title", "r.marketplace", "r.price", "r.url",
        F.lit(NO).alias("exclusivity"), "similarity", "diff_pct", "r.partner_price",
    )


def _exclusive_rows(rest: DataFrame, marketplace: str, base_url: str, absolute_urls: bool) -> DataFrame:
    """Rows without a partner: flag ``sim``, similarity -1, no pair."""
    url = url_absolute("url", base_url) if absolute_urls else F.col("url")
    return rest.select(
        F.lit(None).cast("long").alias("pair_id"), F.lit(2).alias("side"), "product_id", "title",
        F.lit(marketplace).alias("marketplace"), "price", url.alias("url"), F.lit(YES).alias("exclusivity"),
        F.lit(EXCLUSIVE_SIMILARITY).alias("similarity"), F.lit(None).cast("double").alias("diff_pct"),
        F.lit(None).cast("double").alias("partner_price"),
    )


def unmatched_targets(target: DataFrame, best: DataFrame, labels: Labels = Labels(),
                      absolute_urls: bool = True) -> DataFrame:
    """Target rows no source chose, as exclusive rows (similarity -1).

    The chosen ids are made distinct first: a target that is the best match
    of a third of all sources collapses map-side to one row per partition
    before the anti-join shuffle."""
    chosen = best.select(F.col("target_id").alias("product_id")).distinct()
    rest = target.join(chosen, "product_id", "left_anti")
    return _exclusive_rows(rest, labels.target, labels.target_base_url, absolute_urls)


def unmatched_sources(source: DataFrame, best: DataFrame, labels: Labels = Labels(),
                      absolute_urls: bool = True) -> DataFrame:
    """C6 as benchmark rows: source rows that ``best`` pairs with nothing, as
    exclusive rows of the source marketplace (similarity -1)."""
    rest = source.join(best.select(F.col("source_id").alias("product_id")), "product_id", "left_anti")
    return _exclusive_rows(rest, labels.source, labels.source_base_url, absolute_urls)


def partner_prices(pairs: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """One row per pair with both members' prices side by side (self
    equi-join on ``pair_id``, each side chosen by marketplace)."""
    a = pairs.where(F.col("marketplace") == labels.source).select(
        "pair_id", F.col("price").alias("source_price"), F.col("title").alias("source_title")
    )
    b = pairs.where(F.col("marketplace") == labels.target).select(
        "pair_id", F.col("price").alias("target_price"), F.col("title").alias("target_title")
    )
    return a.join(b, "pair_id")
