"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bytescan import mixed, token_hashes
from vitrine.llm.common import row_groups, text_buffer, text_or_empty, written

#: log2 of the n-gram buckets: bounds the models and what a task sends.
BUCKET_BITS = 14
#: At most so many labelled rows (smallest hashed ids) make the target model.
TARGET_ROWS = 20_000
#: Added to each bucket's share of the counts.
SMOOTH = 0.5
GROUP = 1 << 20
#: Hash of the bigram of any token that follows itself.
REPEAT = 0x5851F42D4C957F2D


def features(data, offsets, bits: int = BUCKET_BITS):
    """(bucket, row) of each unigram and bigram of tokens. A token that
    follows itself makes the same bigram whatever the token, so that
    stuttering text is known by words that no labelled row holds."""
    h, row = token_hashes(data, offsets)
    inside = row[1:] == row[:-1]
    pair = np.where(h[1:] == h[:-1], np.uint64(REPEAT), mixed(h[:-1] * np.uint64(3) + h[1:]))[inside]
    grams = np.concatenate((h, pair))
    return (grams >> np.uint64(64 - bits)).astype(np.int64), np.concatenate((row, row[:-1][inside]))


def _counts(bits: int):
    """A partition's counts of each bucket, in all rows and in target rows."""

    def run(batches):
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            data, off = text_buffer(batch.column("text"))
            is_target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in row_groups(off, GROUP):
                bucket, row = features(data[off[a]: off[b]], off[a: b + 1] - off[a], bits)
                raw += np.bincount(bucket, minlength=len(raw))
                target += np.bincount(bucket[is_target[a:b][row]], minlength=len(raw))
        at = np.flatnonzero(raw)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    return run


def target_rows(labels: DataFrame, id_col: str, label_col: str, limit: int = TARGET_ROWS) -> DataFrame:
    """Ids of at most ``limit`` rows labelled 1 (the smallest hashed ids); conflicting labels count as 0."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("l")).where("l = 1")
    return good.select("_id").orderBy(F.xxhash64("_id"), "_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        limit: int = TARGET_ROWS, bits: int = BUCKET_BITS):
    """(log target/raw, log target/rest) per bucket, or None without a row labelled 1.

    The raw model counts every document; the target model the labelled ones
    of a bounded sample. Only the 2**bits summed counts reach the driver."""
    share = labels.where(F.col(label_col).isNotNull()).agg(F.avg((F.col(label_col) == 1).cast("double"))).first()[0]
    if not share:
        return None
    chosen = target_rows(labels, id_col, label_col, limit).withColumn("_hit", F.lit(True))
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("_id"), "left")  # at most ``limit`` ids
    counted = rows.select("text", F.coalesce("_hit", F.lit(False)).alias("target")).mapInArrow(_counts(bits), "bucket long, raw long, target long")
    raw, target = np.full(1 << bits, 0.0), np.full(1 << bits, 0.0)
    for r in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return None
    p_raw = (raw + SMOOTH) / (raw + SMOOTH).sum()
    p_target = (target + SMOOTH) / (target + SMOOTH).sum()
    # what is left of the raw text when the target's share is taken out
    p_rest = np.maximum(p_raw - share * p_target, p_raw * 1e-3)
    return np.log(p_target / p_raw), np.log(p_target / (p_rest / p_rest.sum())), float(np.log(share / max(1e-9, 1 - share)))


def _scores(model, bits: int, keep: list[str], text_col: str):
    ratio, rest, prior = model

    def run(batches):
        for batch in batches:
            data, off = text_buffer(batch.column(text_col))
            weight, chance = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for a, b in row_groups(off, GROUP):
                bucket, row = features(data[off[a]: off[b]], off[a: b + 1] - off[a], bits)
                weight[a:b] = np.bincount(row, ratio[bucket], minlength=b - a)
                s = prior + np.bincount(row, rest[bucket], minlength=b - a)
                chance[a:b] = 1 / (1 + np.exp(-np.clip(s, -50, 50)))
            # a uniform number from the hashed row makes the Gumbel noise, so reruns agree
            u = (batch.column("__noise").to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(11)).astype(float)
            key = weight - np.log(-np.log((u + 0.5) / 2**53))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(weight), pa.array(key), pa.array(chance)], [*keep, "__weight", "__key", "__chance"])

    return run


def scored(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", bits: int = BUCKET_BITS) -> DataFrame:
    """All columns of ``docs`` with ``__weight`` (log importance), ``__key``
    (with Gumbel noise) and ``__chance`` (of being target text)."""
    t = text_or_empty(text_col)
    wide = docs.withColumn("__noise", F.xxhash64(F.lit("gumbel"), F.col(id_col).cast("string"), t))
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.DoubleType()) for c in ("__weight", "__key", "__chance")]])
    return wide.mapInArrow(_scores(model, bits, docs.columns, text_col), schema)


def kth_largest(keys: DataFrame, k: int, col: str = "__key", bins: int = 4096, small: int = 10_000) -> float:
    """The k-th largest value of a double column (1 <= k <= rows), exactly,
    without a global sort: histograms of ``bins`` counts narrow the range
    until few values are left."""
    low, high = keys.agg(F.min(col), F.max(col)).first()
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return high
        inside = keys.where(F.col(col).between(low, high))
        at = F.least(F.floor((F.col(col) - low) / width), F.lit(bins - 1))
        rows = inside.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["bin"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        low, high = r["lo"], r["hi"]
        if low == high:
            return high
        if r["n"] <= small:
            values = sorted((x[0] for x in keys.where(F.col(col).between(low, high)).select(col).collect()), reverse=True)
            return values[k - 1]


def limit_of(docs: DataFrame, model, id_col: str, text_col: str, bits: int = BUCKET_BITS) -> tuple[DataFrame, float]:
    """(the narrow table of scores, the smallest Gumbel key that is sampled).
    The sample's size is the expected number of target documents."""
    narrow = written(scored(docs.select(id_col, text_col), model, id_col, text_col, bits).drop(text_col), "quality-scores")
    n, expected = narrow.agg(F.count(F.lit(1)), F.sum("__chance")).first()
    k = min(n, round(expected or 0))
    return narrow, (kth_largest(narrow, k) if k else float("inf"))


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   limit: int = TARGET_ROWS, bits: int = BUCKET_BITS) -> DataFrame:
    """One row per row of ``docs``: id, ``log_weight``, ``gumbel_key`` and
    ``selected`` (among the k largest Gumbel keys).

    Null text is empty (log weight 0). Rows that share id and text have one
    key, and are selected or left together; a null id is a value like any
    other. Without a row labelled 1 nothing can be judged: all weights are 0
    and all rows selected. An empty table gives an empty result. Other
    columns are not read; labels of unknown ids are ignored."""
    model = fit(docs, labels, id_col, text_col, label_col, limit, bits)
    if model is None:
        zero = F.lit(0.0)
        return docs.select(id_col, zero.alias("log_weight"), zero.alias("gumbel_key"), F.lit(True).alias("selected"))
    narrow, least = limit_of(docs, model, id_col, text_col, bits)
    return narrow.select(id_col, F.col("__weight").alias("log_weight"), F.col("__key").alias("gumbel_key"), (F.col("__key") >= least).alias("selected"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   limit: int = TARGET_ROWS, bits: int = BUCKET_BITS) -> DataFrame:
    """The selected rows of ``docs``, columns unchanged. The scores are
    computed again beside the rows instead of joined to them: cheaper than a
    shuffle of all texts."""
    model = fit(docs, labels, id_col, text_col, label_col, limit, bits)
    if model is None:
        return docs
    _, least = limit_of(docs, model, id_col, text_col, bits)
    return scored(docs, model, id_col, text_col, bits).where(F.col("__key") >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
