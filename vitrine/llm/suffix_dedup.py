"""Removal of repeated substrings by suffix arrays over shards of the corpus."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import anchors as A
from vitrine.llm.common import row_groups, text_buffer, text_or_empty, written
from vitrine.llm.suffix_array import common_prefixes, suffix_array

#: Bytes of a string whose repeats go.
LENGTH = 200
#: Bytes of contexts that make a shard, and contexts of one anchor that a shard takes.
SHARD_BYTES, GROUP_ROWS = 1 << 20, 8192
GROUP = 1 << 20


def _anchor_rows(length: int):
    """Per row: 128 bits of its text's hash, its size, the hash and its anchors."""

    def run(batches):
        for batch in batches:
            data, off = text_buffer(batch.column("text"))
            sha = [hashlib.sha256(data[off[i]: off[i + 1]]).digest() for i in range(batch.num_rows)]
            at, hashes, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
            for a, b in row_groups(off, GROUP):
                o = off[a: b + 1] - off[a]
                p, h = A.anchors(data[off[a]: off[b]], o, length)
                row = np.searchsorted(o, p, side="right") - 1
                sizes.append(np.bincount(row, minlength=b - a))
                at.append((p - o[row]).astype(np.int32))
                hashes.append(h.view(np.int64))
            ends = pa.array(np.concatenate(([0], np.cumsum(np.concatenate([[0][:0], *sizes])))).astype(np.int32))
            key = np.frombuffer(b"".join(s[:16] for s in sha), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(np.diff(off)), pa.array([s.hex() for s in sha], pa.string()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(at))), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(hashes)))],
                ["id", "k1", "k2", "n_bytes", "sha", "at", "hash"])

    return run


def _packed(batches):
    """Texts by key, compressed: they are shuffled, once per use."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        data, off = text_buffer(batch.column("text"))
        rows = [data[off[i]: off[i + 1]].tobytes() for i in range(batch.num_rows)]
        key = np.frombuffer(b"".join(hashlib.sha256(r).digest()[:16] for r in rows), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array([pack(r) for r in rows], pa.binary())], ["k1", "k2", "z"])


def packed_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """Each distinct text once: k1, k2, z."""
    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(_packed, "k1 long, k2 long, z binary")
    return rows.groupBy("k1", "k2").agg(F.first("z").alias("z"))


def _contexts(length: int):
    """Per candidate anchor its context: the strings in which it is the
    smallest gram, laid over one another. A context that a batch has shown
    before is named by its hash only."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("hash", "c1", "c2", "k1", "k2", "start", "size", "anchor", "context")}
            shown = set()
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for i, (z, at, hashes) in enumerate(zip(batch.column("z").to_pylist(), batch.column("at").to_pylist(), batch.column("hashes").to_pylist())):
                text = unpack(z)
                # tied anchors of one string can share their context: it lies there once
                spans = zip(hashes, *A.reach(np.frombuffer(text, np.uint8), np.array(at), length))
                for (h, lo, hi), p in dict(zip(spans, at)).items():
                    context = text[lo:hi]
                    c = xxhash.xxh3_128_digest(context)
                    new = (h, c) not in shown
                    shown.add((h, c))
                    for name, v in (("hash", h), ("c1", int.from_bytes(c[:8], "big", signed=True)), ("c2", int.from_bytes(c[8:], "big", signed=True)),
                                    ("k1", k1[i]), ("k2", k2[i]), ("start", lo), ("size", hi - lo), ("anchor", p - lo), ("context", context if new else None)):
                        out[name].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[c], pa.binary() if c == "context" else pa.int32() if c in ("start", "size", "anchor") else pa.int64()) for c in out], list(out))

    return run


def repeated_starts(contexts: list[bytes], many: np.ndarray, text: np.ndarray, start: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context the offsets whose ``length``-byte string also starts
    elsewhere: in a context of ``many`` occurrences, or at another place
    (``text``, ``start`` + offset). Equal strings are neighbours in the suffix array."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    t = np.ones(int(sizes.sum()) + len(sizes) + 1, np.uint16)  # 1 ends a context, 0 ends all
    t[-1] = 0
    at = np.arange(len(t) - 1)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = at - begin[owner]
    t[:-1][inside < sizes[owner]] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + 2
    starts = np.append(inside + length <= sizes[owner], False)
    if not starts.any():
        return [np.zeros(0, np.int64) for _ in contexts]
    order = suffix_array(t, 258)
    order = order[starts[order]].astype(np.int64)
    # letters are bytes + 2: the low 8 bits tell bytes apart, and no separator lies in reach
    equal = common_prefixes(t, order, length)[order] >= length
    first = np.flatnonzero(~np.append(False, equal[1:]))
    place = (text[owner[order]] << 32) + start[owner[order]] + inside[order]
    group = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
    hit = (np.maximum.reduceat(place, first) != np.minimum.reduceat(place, first)) | np.logical_or.reduceat(many[owner[order]], first)
    repeated = np.sort(order[hit[group]])
    where = np.searchsorted(repeated, np.append(begin, len(t)))
    return [repeated[where[i]: where[i + 1]] - begin[i] for i in range(len(contexts))]


def _spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs that the strings at sorted ``starts`` cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist()))


def _shards(length: int, shard_bytes: int):
    """Suffix arrays over shards of whole anchor groups (rows come sorted by
    hash): spans of the contexts that lie at one place only."""

    half = (length - A.GRAM) // 2

    def sides(r):
        """What a string of another context of the anchor must share: half of
        what it has besides the anchor, before or behind it. None where the
        anchor's gram stands twice: a copy may lie around either of them."""
        c, p = r["context"], r["anchor"]
        gram = c[p: p + A.GRAM]
        if c.find(gram) != p or c.find(gram, p + 1) >= 0:
            return None
        return (r["hash"], c[p - half: p + A.GRAM] if p >= half else b""), (r["hash"], c[p: p + A.GRAM + half] if p + A.GRAM + half <= len(c) else b"")

    def solve(rows):
        pairs = [sides(r) for r in rows]
        left, right = Counter(p[0] for p in pairs if p), Counter(p[1] for p in pairs if p)
        # a context with the gram twice has no sides to compare: all contexts of its anchor stay
        open_ = {r["hash"] for r, p in zip(rows, pairs) if not p}
        rows = [r for r, p in zip(rows, pairs) if r["hash"] in open_ or p[0][1] and left[p[0]] > 1 or p[1][1] and right[p[1]] > 1]
        if not rows:
            return
        keys = {k: i for i, k in enumerate(dict.fromkeys((r["k1"], r["k2"]) for r in rows))}
        found = repeated_starts([r["context"] for r in rows], np.array([r["n"] > 1 for r in rows]),
                                np.array([keys[r["k1"], r["k2"]] for r in rows], np.int64), np.array([r["start"] for r in rows], np.int64), length)
        for r, s in zip(rows, found):
            if r["n"] == 1:
                for lo, hi in _spans(s, length):
                    yield r["k1"], r["k2"], r["start"] + lo, r["start"] + hi

    def run(batches):
        rows, size, group = [], 0, []

        def close():
            # an anchor with one context has no more to compare, nor one whose contexts all repeat
            nonlocal size
            if len(group) > 1 and any(r["n"] == 1 for r in group):
                rows.extend(group)
                size += sum(len(r["context"]) for r in group)
            group.clear()

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if group and r["hash"] != group[0]["hash"]:
                    close()
                    if size >= shard_bytes:
                        out += solve(rows)
                        rows, size = [], 0
                group.append(r)
            yield _span_batch(out)
        close()
        if rows:
            yield _span_batch(solve(rows))

    return run


def _span_batch(rows):
    cols = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 2 else pa.int32()) for i, c in enumerate(cols)], ["k1", "k2", "lo", "hi"])


def _windows(length: int):
    """128-bit hashes of all strings of a context."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                c = r["context"]
                for i in range(len(c) - length + 1):
                    d = xxhash.xxh3_128_digest(c[i: i + length])
                    out.append((int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), r["n"] > 1, r["k1"], r["k2"], r["start"] + i))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["w1", "w2", "many", "k1", "k2", "lo"])

    return run


def repeated_spans(docs: DataFrame, rows: DataFrame, text_col: str, length: int, shard_bytes: int, group_rows: int) -> DataFrame:
    """k1, k2, lo, hi: bytes of each distinct text that a repeated string
    covers (spans may overlap). ``rows`` is the written table of anchors."""
    each = rows.select("k1", "k2", F.explode(F.arrays_zip("at", "hash")).alias("a")).select("k1", "k2", F.col("a.at").alias("at"), F.col("a.hash").alias("hash"))
    # a hash at two places at least; copies of a text are one place
    place = F.xxhash64("k1", "k2", "at")
    twice = each.groupBy("hash").agg(F.min(place).alias("x"), F.max(place).alias("y")).where("x <> y").select("hash")
    cand = each.join(twice, "hash", "left_semi").groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "hash")).alias("a"))
    cand = cand.select("k1", "k2", F.transform("a", lambda x: x["at"]).alias("at"), F.transform("a", lambda x: x["hash"]).alias("hashes"))
    texts = packed_texts(docs, text_col).join(cand, ["k1", "k2"])
    found = written(texts.mapInArrow(
        _contexts(length), "hash long, c1 long, c2 long, k1 long, k2 long, start int, size int, anchor int, context binary"), "contexts")

    narrow = found.drop("anchor", "context")
    classes = narrow.groupBy("hash", "c1", "c2").agg(F.count(F.lit(1)).alias("n"))
    many = classes.where("n > 1").select("hash", "c1", "c2")
    spans = narrow.join(many, ["hash", "c1", "c2"], "left_semi").select("k1", "k2", F.col("start").alias("lo"), (F.col("start") + F.col("size")).alias("hi"))

    # an anchor's contexts meet in one task: dealt by an explicit repartition, which adaptive execution neither splits nor reads locally
    known = found.groupBy("hash", "c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.min("k1").alias("k1"), F.min("k2").alias("k2"), F.min("start").alias("start"), F.min("anchor").alias("anchor"), F.first("context", ignorenulls=True).alias("context"))
    groups = classes.groupBy("hash").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
    large = written(groups.where(F.col("classes") > group_rows).select("hash", "least"), "hot-anchors")
    hot_anchors = large.limit(1).count() > 0
    fits = known.join(large, "hash", "left_anti") if hot_anchors else known
    fits = fits.select("hash", "n", "k1", "k2", "start", "anchor", "context").repartition("hash").sortWithinPartitions("hash")
    single = fits.mapInArrow(_shards(length, shard_bytes), "k1 long, k2 long, lo int, hi int")
    spans = spans.unionByName(single)

    # anchors with more contexts than a shard takes: strings meet by their hash, spread over all tasks
    if hot_anchors:
        hot = written(known.join(large.where("least = 1"), "hash", "left_semi").select("n", "k1", "k2", "start", "context").mapInArrow(
            _windows(length), "w1 long, w2 long, many boolean, k1 long, k2 long, lo int"), "hot-strings")
        place = F.xxhash64("k1", "k2", "lo")
        again = hot.groupBy("w1", "w2").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.max("many").alias("m")).where("x <> y or m").select("w1", "w2")
        spans = spans.unionByName(hot.where("not many").join(again, ["w1", "w2"], "left_semi").select("k1", "k2", "lo", (F.col("lo") + length).alias("hi")))
    return spans


def _remove(keep_bytes: bool):
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for z, spans in zip(batch.column("z").to_pylist(), batch.column("spans").to_pylist()):
                text, merged = unpack(z), []
                for s in sorted((s["lo"], s["hi"]) for s in spans):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append([*s])
                kept, at = [], 0
                for lo, hi in merged:
                    kept.append(text[at:lo])
                    at = hi
                kept = b"".join([*kept, text[at:]])
                out.append((len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            cols = list(zip(*out)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             ["k1", "k2", "removed", "spans", "kept_sha", "kept"])

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                 group_rows: int = GROUP_ROWS, keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs) and ``kept_sha256``; with ``keep_bytes`` also the
    ``kept`` bytes (null where nothing goes).

    Every byte goes that a ``length``-byte string covers which also starts
    anywhere else, in this text or another; matches never cross texts.
    ``length`` is a multiple of 8, at least 40.

    Equal strings hold an equal anchor, so the corpus is cut into shards by
    anchors: around each anchor that lies at two places or more stands its
    context, equal contexts are counted before they are shuffled, and a suffix array by induced
    sorting over each shard with its permuted common prefixes finds the equal strings of different contexts. A text
    that has an exact copy goes whole if it is long enough. An anchor with
    more contexts than ``group_rows`` has its strings compared by 128-bit hashes, spread over all tasks.

    Null text is empty; shorter texts lose nothing; null and repeated ids are
    passed through, repeated rows count as copies; an empty table gives an
    empty result; other columns are not read."""
    if length % 8 or length < A.GRAM + 8:
        raise ValueError("length must be a multiple of 8, and 40 at least")
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    rows = written(source.mapInArrow(
        _anchor_rows(length), f"id {kind}, k1 long, k2 long, n_bytes long, sha string, at array<int>, hash array<long>"), "anchors")
    counts = rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
    spans = repeated_spans(docs, rows, text_col, length, shard_bytes, group_rows)
    by_text = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    # a text with a copy goes whole: its bytes are not needed again
    part = by_text.join(counts.where("copies = 1"), ["k1", "k2"], "left_semi")
    cut = packed_texts(docs, text_col).join(part, ["k1", "k2"]).mapInArrow(
        _remove(keep_bytes), "k1 long, k2 long, removed long, spans long, kept_sha string, kept binary")
    texts = written(counts.join(cut, ["k1", "k2"], "left"), "cut-texts")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    done = rows.drop("at", "hash").join(texts, ["k1", "k2"])
    out = [
        F.col("id").alias(id_col), "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    ]
    return done.select(*out, *([F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if keep_bytes else []))
