"""Exact top-k search over vector-approximation files.

1. The approximation file: every vector as one cell number per component, a block of vectors with its
   grid to a row, written once.
2. The scan: blocks of queries meet blocks of cells (never exact vectors). A cell gives bounds of
   the score; of each query, the rows leave that its block's bounds do not rule out, with their bounds.
   The kth largest lower bound of all blocks rules out most of these.
3. Reading: the exact vectors of what is left are fetched in the order of their bounds, first a few per query, then
   those that could still reach the kth score found so far. Then the kth result is certain.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.llm.common import written

#: Bits of a quantised cell. Rows of a block: bounds the memory of one block pair.
CELL_BITS = 6
QUERY_ROWS = 1024
BLOCK_ROWS = 8192
#: Scores below this magnitude are exact in float64.
EXACT = 2**53


def cells(x: np.ndarray, bits: int = CELL_BITS):
    """Approximation of integer vectors: a cell number per component, and the
    components' least value and cell width in this block."""
    low = x.min(axis=0)
    width = np.maximum(1, -(-(x.max(axis=0) - low + 1) // (1 << bits)))
    return ((x - low) // width).astype(np.uint16), low, width


def bounds(q: np.ndarray, code: np.ndarray, low: np.ndarray, width: np.ndarray):
    """Lower and upper bounds of each inner product q . x from x's cell: the
    cell's middle, and half its width times |q|."""
    half = (width - 1) / 2.0
    middle = q @ (code * width + low + half).T
    reach = np.abs(q) @ half
    # half a unit of slack: sums of halves are exact, the bound stays safe anyway
    return middle - reach[:, None] - 0.5, middle + reach[:, None] + 0.5


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of ``dim`` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


BLOCK = "block long, dim int, peak long, ids array<long>, rids array<long>, code binary, low array<long>, width array<long>"


def _approximate(bits: int, block_rows: int):
    """Blocks of the approximation file: vectors of one length."""
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                of = batch.filter(pa.array(dims == dim))
                for a in range(0, len(of), block_rows):
                    part = of.slice(a, block_rows)
                    x = _matrix(part.column("v"), dim)
                    code, low, width = cells(x, bits)
                    peak = int(np.minimum(np.abs(x.astype(np.float64)).max(initial=0), 2.0**62))
                    yield pa.RecordBatch.from_pylist([{
                        "block": part.column("rid")[0].as_py(), "dim": dim, "peak": peak, "ids": part.column("id").to_pylist(),
                        "rids": part.column("rid").to_pylist(), "code": code.astype(np.uint8).tobytes(), "low": low.tolist(), "width": width.tolist()}],
                        schema=_BLOCK)

    return run


_LONGS = pa.list_(pa.int64())
_BLOCK = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("peak", pa.int64()), ("ids", _LONGS), ("rids", _LONGS), ("code", pa.binary()),
                    ("low", _LONGS), ("width", _LONGS)])


def candidates(q_ids, q, ids, code, low, width, k: int):
    """(query place, row place, lower, upper) of the rows of one block that its
    bounds do not rule out: at least as high as the kth best lower bound. Own rows are left out."""
    lower, upper = bounds(q, code, low, width)
    out = []
    for i, own in enumerate(q_ids):
        others = np.flatnonzero(ids != own)
        if not len(others):
            continue
        n = min(k, len(others))
        least = np.partition(lower[i, others], len(others) - n)[len(others) - n]
        near = others[upper[i, others] >= least]
        out.append((np.full(len(near), i), near, lower[i, near], upper[i, near]))
    if not out:
        return [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2
    return [np.concatenate(c) for c in zip(*out)]


def _scan(k: int):
    def run(key, queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        dim, found = key[2], []
        q_ids = queries["id"].to_numpy(np.int64)
        q = np.array(queries["v"].tolist(), np.float64).reshape(len(queries), dim)
        for b in blocks.itertuples(index=False) if len(queries) else ():
            ids, rids = np.asarray(b.ids, np.int64), np.asarray(b.rids, np.int64)
            if float(np.abs(q).max(initial=0)) * max(float(b.peak), 1.0) * max(1, dim) >= EXACT:  # beyond float64 no bound is safe
                at = np.tile(np.arange(len(ids)), len(q_ids))
                i = np.repeat(np.arange(len(q_ids)), len(ids))
                i, at = i[q_ids[i] != ids[at]], at[q_ids[i] != ids[at]]
                lower, upper = np.full(len(i), -np.inf), np.full(len(i), np.inf)
            else:
                code = np.frombuffer(b.code, np.uint8).reshape(len(ids), dim).astype(np.float64)
                i, at, lower, upper = candidates(q_ids, q, ids, code, np.asarray(b.low, np.float64), np.asarray(b.width, np.float64), k)
            found.append(pd.DataFrame({"query_id": q_ids[i], "rid": rids[at], "lower": lower, "upper": upper}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "rid": pd.Series([], dtype="int64"),
                                                            "lower": pd.Series([], dtype="float64"), "upper": pd.Series([], dtype="float64")})

    return run


def inner_products(q: pa.ListArray, x: pa.ListArray) -> np.ndarray:
    """Row by row, exact; beyond 64 bits they saturate."""
    a, b = (c.flatten().to_numpy(zero_copy_only=False) for c in (q, x))
    ends = np.concatenate(([0], np.cumsum(pa.compute.list_value_length(q).to_numpy(zero_copy_only=False)))).astype(np.int64)
    widest = int(np.diff(ends).max(initial=0))
    if int(np.abs(a.astype(np.float64)).max(initial=0)) * int(np.abs(b.astype(np.float64)).max(initial=0)) * max(1, widest) < 2**62:
        sums = np.concatenate(([0], np.cumsum(a * b)))  # wraps around, and so do the differences
        return sums[ends[1:]] - sums[ends[:-1]]
    whole = (sum(int(m) * int(n) for m, n in zip(a[s:e], b[s:e])) for s, e in zip(ends[:-1], ends[1:]))
    return np.array([min(max(v, -(2**63)), 2**63 - 1) for v in whole], np.int64)


def _score(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), batch.column("rid"), pa.array(
            inner_products(batch.column("q"), batch.column("v")))], ["query_id", "vec_id", "rid", "score"])


def _kth(rows: DataFrame, col: str, k: int) -> DataFrame:
    """``query_id, kth``: the kth largest value of each query; none for a query with fewer rows."""
    order = Window.partitionBy("query_id").orderBy(F.col(col).desc())
    first = rows.select("query_id", col).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    return first.groupBy("query_id").agg(F.min(col).alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select("query_id", "kth")


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
                 scale: float = 256.0, bits: int = CELL_BITS, query_rows: int = QUERY_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its k
    rows of ``vectors`` with the largest inner product of floor(scale * x),
    the row of its own id left out, ties to the smaller id. Exact.

    Of exact vectors, the queries' own and those that the bounds leave are shuffled; the scan
    ships cells, one byte a component. Nothing is broadcast by hand.

    Vectors that are null or hold a null, NaN or infinite component take no
    part, nor do rows with a null id; vectors of different lengths are not
    compared. Of rows repeated with an id, each is a candidate of its own; of query rows
    that share an id, the one with the smallest vector is answered. Components beyond 64
    bits saturate; so do scores. Empty tables give an empty result."""

    def ready(df):
        v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
        fine = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
            F.col(vector_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
        return df.where(fine).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(vector_col).alias("dim"))

    return search(ready(vectors), ready(queries), k, bits, query_rows, block_rows)[0]


def search(vectors: DataFrame, queries: DataFrame, k: int, bits: int = CELL_BITS, query_rows: int = QUERY_ROWS,
           block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(results, ``query_id, rid`` of every exact vector that was read) for
    rows of ``id``, ``v`` (whole numbers) and ``dim``."""
    rows = written(vectors.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    asked = written(queries.groupBy("id").agg(F.min(F.struct("dim", "v")).alias("m")).select("id", "m.dim", "m.v"), "queries")
    file = written(rows.mapInArrow(_approximate(bits, block_rows), BLOCK), "approximations")
    nv = max(1, math.ceil(rows.count() / block_rows))
    nq = max(1, math.ceil(asked.count() / query_rows))

    def dealt(df, by, own, own_n, other, other_n):
        return df.withColumn(own, F.pmod(F.xxhash64(by), F.lit(own_n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long"))))

    keys = ["qb", "vb", "dim"]
    q, x = dealt(asked, "id", "qb", nq, "vb", nv), dealt(file, "block", "vb", nv, "qb", nq)
    found = written(q.groupBy(keys).cogroup(x.groupBy(keys)).applyInPandas(
        _scan(k), "query_id long, rid long, lower double, upper double"), "candidates")
    limit = _kth(found, "lower", k).withColumnRenamed("query_id", "_q")
    order = Window.partitionBy("query_id").orderBy(F.col("upper").desc(), "rid")
    near = found.join(limit, F.col("query_id") == F.col("_q"), "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth")))
    near = written(near.select("query_id", "rid", "upper").withColumn("place", F.row_number().over(order)), "near")

    def read(some):
        exact = some.join(rows.select("rid", "id", "v"), "rid").join(
            asked.select(F.col("id").alias("_q"), F.col("v").alias("q")), F.col("query_id") == F.col("_q"))
        return exact.select("query_id", "id", "rid", "q", "v").mapInArrow(_score, "query_id long, vec_id long, rid long, score long")

    step = max(4 * k, 16)
    first = written(read(near.where(F.col("place") <= step)), "first-scores")
    reached = _kth(first, "score", k).withColumnRenamed("query_id", "_k")
    rest = near.where(F.col("place") > step).join(reached, F.col("query_id") == F.col("_k"), "left").where(
        F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).select("query_id", "rid")
    scores = written(first.unionByName(read(rest)), "scores")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    top = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return top, scores.select("query_id", "rid")
