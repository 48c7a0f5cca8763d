"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bytescan import CLASS, FOLD, MIX
from vitrine.llm.common import row_groups, text_buffer, text_or_empty

#: Lengths of the character n-grams (bytes of the lower-cased text; a word begins and ends with a space).
LENGTHS = (3, 4, 5)
BUCKET_BITS = 18
DIM = 8
#: Words of a segment, the unit whose embeddings are averaged.
SEGMENT = 3
#: The bounded sample: labelled rows of each class, bytes of all their texts, and bytes of one text that can be learnt from.
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 2000
TOXIC_BYTES, CLEAN_BYTES, TEXT_BYTES = 12_000_000, 16_000_000, 1_000_000
ROUNDS, STEPS, TOP = 2, 40, 2
#: Share of a bag's n-grams that a training step leaves out, so that part of a word must do (misspellings).
DROP = 0.3
GROUP = 1 << 20


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for judging: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows one after another in lower case, every byte outside words a
    space, one space around each row; and where each row starts."""
    words = np.where(CLASS[data] == 1, FOLD[data], np.uint8(32))
    starts = offsets + np.arange(len(offsets)) + 1
    buf = np.full(len(data) + len(offsets), 32, np.uint8)
    inside = np.ones(len(buf), bool)
    inside[starts - 1] = False
    buf[inside] = words
    return buf, starts


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = buf == 32
    return np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1


def gram_buckets(buf: np.ndarray, bits: int = BUCKET_BITS):
    """(valid, bucket) at each byte for each n-gram length: an n-gram holds no
    space inside, only as its first or last byte."""
    space = np.concatenate(([0], np.cumsum(buf == 32, dtype=np.int32)))
    packed = buf.astype(np.uint64)
    grams, have = packed, 1
    for n in LENGTHS:
        m = len(buf) - n + 1
        if m <= 0:
            return
        while have < n:
            grams = grams[: len(buf) - have] | (packed[have:] << np.uint64(8 * have))
            have += 1
        valid = space[n - 1: n - 1 + m] == space[1: m + 1]
        h = (grams + np.uint64(n)) * np.uint64(MIX)
        yield n, valid, (h >> np.uint64(64 - bits)).astype(np.int32)


def word_sums(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the weights, number) of the n-grams of each word. With a linear
    softmax the average of embeddings times the output weights is the average of these scalars."""
    sums, counts = np.zeros(len(buf) + 1), np.zeros(len(buf) + 1, np.int32)
    for _, valid, bucket in gram_buckets(buf):
        m = len(valid)
        sums[1: m + 1] += np.where(valid, weights[bucket], 0)
        counts[1: m + 1] += valid
    np.cumsum(sums, out=sums)
    np.cumsum(counts, out=counts)
    # n-grams of the word start at the space before it or inside it
    return sums[ends] - sums[starts - 1], counts[ends] - counts[starts - 1]


def segment_logits(data, offsets, weights):
    """Logits of all segments (the mean weight of all their n-grams, as in
    training), and the index of each row's first segment."""
    buf, row_starts = padded(data, offsets)
    starts, ends = word_spans(buf)
    s, n = word_sums(buf, starts, ends, weights)
    row = np.searchsorted(row_starts, starts, side="right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)))
    # a segment is the window of SEGMENT words that starts at a word and stays in its row
    c, k = np.concatenate(([0.0], np.cumsum(s))), np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
    stop = np.minimum(np.arange(len(s)) + SEGMENT, first[row + 1]) if len(s) else np.zeros(0, np.int64)
    mean = (c[stop] - c[: len(s)]) / np.maximum(k[stop] - k[: len(s)], 1)
    return mean, first, (buf, starts, ends, stop)


def row_maxima(mean: np.ndarray, first: np.ndarray, empty: float) -> np.ndarray:
    """The largest segment logit of each row."""
    out = np.full(len(first) - 1, empty)
    has = first[1:] > first[:-1]
    if has.any():
        out[has] = np.maximum.reduceat(mean, first[:-1][has])
    return out


class Model:
    """Scalar weight per n-gram bucket, and the logistic of the largest segment."""

    def __init__(self, weights: np.ndarray, slope: float, offset: float):
        self.weights, self.slope, self.offset = weights, slope, offset

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        for a, b in row_groups(offsets, GROUP):
            mean, first, _ = segment_logits(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], self.weights)
            z = self.slope * row_maxima(mean, first, 0.0) + self.offset
            # a text without words has nothing to judge
            z[first[1:] == first[:-1]] = -20.0
            out.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        return np.concatenate(out)


def _bags(data, offsets, label, weights, top: int):
    """Bags of n-gram buckets of each row's ``top`` strongest segments and, of
    clean rows, one more anywhere: (buckets, bag of each, label of each bag)."""
    out, bag, labels = [], [], []
    for r in range(len(offsets) - 1):
        text = data[offsets[r]: offsets[r + 1]]
        mean, _, (buf, starts, ends, stop) = segment_logits(text, np.array([0, len(text)]), weights)
        buckets = {n: (valid, bucket) for n, valid, bucket in gram_buckets(buf)}
        a, b = 0, len(mean)
        if a == b:
            continue
        strong = a + np.argsort(-mean[a:b], kind="stable")[: top]
        for w in {*strong.tolist(), *([] if label[r] else [int(a + (b - a) * 0.618)])}:
            lo, hi = starts[w] - 1, ends[stop[w] - 1]
            got = [bucket[lo:min(hi, len(valid))][valid[lo:min(hi, len(valid))]] for valid, bucket in buckets.values()]
            got = np.concatenate(got) if got else np.zeros(0, np.int32)
            if len(got):
                out.append(got)
                bag.append(np.full(len(got), len(labels)))
                labels.append(label[r])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(out).astype(np.int64), np.concatenate(bag), np.array(labels, float)


def _first_guess(data, offsets, label) -> np.ndarray:
    """Log odds of each bucket's document frequency: finds the first segments to learn from."""
    size = 1 << BUCKET_BITS
    df = np.zeros((2, size))
    for r in range(len(label)):
        buf, _ = padded(data[offsets[r]: offsets[r + 1]], np.array([0, offsets[r + 1] - offsets[r]]))
        grams = [bucket[valid] for _, valid, bucket in gram_buckets(buf)]
        if grams:
            df[int(label[r]), np.unique(np.concatenate(grams))] += 1
    n = np.bincount(label.astype(int), minlength=2)
    return np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))


def train(texts: list[bytes], label: np.ndarray, seed: int = 7) -> Model | None:
    """Embeddings and softmax, jointly, by Adam on the segments that the
    model so far finds strongest in each text; then the logistic of the
    strongest segment. None if a class is missing."""
    label = np.asarray(label, float)
    if len(label) == 0 or label.min() == label.max():
        return None
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    rng = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    weights = _first_guess(data, offsets, label)
    table, soft = np.zeros((size, DIM)), np.zeros((DIM, 2))
    table[:] = rng.normal(0, 0.1, table.shape)
    soft[:] = rng.normal(0, 0.3, soft.shape)
    bias = np.zeros(2)
    for _ in range(ROUNDS):
        buckets, bag, y = _bags(data, offsets, label, weights, TOP)
        if len(y) == 0 or y.min() == y.max():
            return None
        used, at_all = np.unique(buckets, return_inverse=True)
        emb, bag_all = table[used].copy(), bag
        want = np.stack((1 - y, y), axis=1)
        cost = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))[:, None]
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emb, soft, bias)]
        for step in range(1, STEPS + 1):
            left = rng.random(len(at_all)) >= DROP
            at, bag = at_all[left], bag_all[left]
            n = np.maximum(np.bincount(bag, minlength=len(y)), 1).astype(float)
            rows = emb[at]
            mean = np.stack([np.bincount(bag, rows[:, d], minlength=len(y)) for d in range(DIM)], axis=1) / n[:, None]
            z = mean @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - want) * cost
            back = (g @ soft.T / n[:, None])[bag]
            grads = (np.stack([np.bincount(at, back[:, d], minlength=len(used)) for d in range(DIM)], axis=1) + 1e-7 * emb,
                     mean.T @ g + 1e-4 * soft, g.sum(axis=0))
            for param, grad, (m, v) in zip((emb, soft, bias), grads, state):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        table[:] = 0  # buckets that no segment holds say nothing
        table[used] = emb
        weights = table @ (soft[:, 1] - soft[:, 0]) + (bias[1] - bias[0])
    x = np.concatenate([row_maxima(*segment_logits(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], weights)[:2], 0.0)
                        for a, b in row_groups(offsets, GROUP)])
    return Model(weights.astype(np.float32), *_logistic(x, label))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of y by x, damped Newton steps with a little ridge."""
    mid, spread = x.mean(), x.std() + 1e-9
    design = np.stack(((x - mid) / spread, np.ones_like(x)), axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        w -= np.clip(np.linalg.solve(h, design.T @ (p - y) + 0.1 * w), -2, 2)
    return float(w[0] / spread), float(w[1] - w[0] * mid / spread)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list:
    """The training rows: labelled, not held out, with a text of 1 to ``TEXT_BYTES`` bytes; of
    those, by smallest hashed id, at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN``, and whole texts up to
    ``TOXIC_BYTES`` and ``CLEAN_BYTES`` in all. Rows that repeat id and text count once."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("y"))
    known = known.withColumnRenamed("_id", id_col).where(~held_out(id_col)).withColumnRenamed(id_col, "_id")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # only ids, sizes and hashes meet the labels: texts do not move
    narrow = rows.select("id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("h")).where(F.col("size").between(1, TEXT_BYTES))
    keys = narrow.join(known, F.col("id") == F.col("_id")).select(F.xxhash64("id").alias("place"), "id", "h", "y", "size")
    chosen = []
    for y, rows_most, bytes_most in ((1, TRAIN_TOXIC, TOXIC_BYTES), (0, TRAIN_CLEAN, CLEAN_BYTES)):
        total = 0
        # sorted by all that they hold: the same rows in every run
        for r in keys.where(F.col("y") == y).distinct().orderBy("place", "id", "h").limit(rows_most).collect():
            if (total := total + r["size"]) > bytes_most:
                break
            chosen.append((r["id"], r["h"], y))
    if not chosen:
        return []
    types = [T.StructField("_id", rows.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("y", T.IntegerType())]
    picked = docs.sparkSession.createDataFrame(chosen, T.StructType(types))
    # at most TRAIN_TOXIC + TRAIN_CLEAN ids
    found = rows.join(F.broadcast(picked), (F.col("id") == F.col("_id")) & (F.xxhash64("text") == F.col("h")))
    return found.select("id", "text", "y").distinct().collect()


def _score(model: Model, keep: list[str]):
    def run(batches):
        for batch in batches:
            data, off = text_buffer(batch.column("__text"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(model.scores(data, off), pa.float64())], [*keep, "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1) and
    ``predicted`` (1 if score >= 0.5).

    Every word is the average of its n-gram embeddings, a segment the average
    of its words, the softmax is linear, and a text's score is that of its
    strongest segment, so a long clean text does not hide a toxic line.
    A misspelling shares most n-grams with the word it comes from.

    The model is fitted on the driver with a bounded sample of labelled rows
    that are not held out; every text is scored whole. Texts without words
    (null, empty, symbols only) score near 0. Without rows of both labels
    all scores are 0. Null ids are scored and not held out; conflicting labels
    count as toxic; repeated rows score alike; an empty table gives an empty result."""
    rows = sample(docs, labels, id_col, text_col, label_col)
    rows.sort(key=lambda r: (r["id"], r["text"]))
    model = train([r["text"].encode() for r in rows], np.array([r["y"] for r in rows]))
    base = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("__text"))
    if model is None:
        scored = base.withColumn("score", F.lit(0.0))
    else:
        schema = T.StructType([f for f in base.schema.fields if f.name != "__text"] + [T.StructField("score", T.DoubleType())])
        scored = base.mapInArrow(_score(model, [id_col, "held_out"]), schema)
    return scored.select(id_col, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
