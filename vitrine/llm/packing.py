"""Packing by lexical retrieval.

Texts become token ids; whole windows of a long text stand alone, what is
left of it is a unit. Units are dealt to shards of bounded size by the
smallest hashes of their tokens, so related units meet, and copies, however
many, spread over as many shards as they fill. Each shard has a BM25 inverted
index (with the document frequencies of all units); the unused neighbours that
it returns for a seed fill the seed's window in order of score. The one that does not
fit is cut, and its rest seeds the next window, so a shard pads its last window only.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bpe import byte_letters
from vitrine.llm.bytescan import mixed
from vitrine.llm.common import text_or_empty, written

#: Fixed values of the contract: tokens of a sequence, the id that ends a document.
WINDOW, END = 2048, 1
#: Tokens of a shard, texts handled at once, BM25's usual parameters.
SHARD_TOKENS, TEXTS = 1 << 20, 256
K1, B = 1.2, 0.75
#: The words of byte-level vocabularies: a fixed value of that format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(config: str):
    """A function from a text to its ids, as the ``tokenizers`` library gives
    them without special tokens added. For a plain byte-level vocabulary whose merges are in id
    order, the same ids come from ``tiktoken``, several times faster."""
    shape = json.loads(config)
    model, pre = shape["model"], shape.get("pre_tokenizer") or {}
    letters = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in shape["added_tokens"]}
    plain = (shape["normalizer"] is None and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True)
             and model["type"] == "BPE" and not any(model.get(k) for k in (
                 "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and all(set(t) <= letters.keys() for t in model["vocab"] if t not in special)
             and not any(t[k] for t in shape["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if plain:
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        made = [model["vocab"][t] for t in joined]
        plain = made == sorted(made) and len(made) + 256 == len([t for t in model["vocab"] if t not in special])
    if not plain:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(config)
        whole.no_truncation()
        whole.no_padding()
        return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: fast.encode_to_numpy(text, allowed_special="all")


_ENCODERS: dict[int, object] = {}


def worker_encoder(config: str):
    key = hash(config)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = encoder(config)
    return _ENCODERS[key]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


PIECE = ["start", "length", "ids_crc32", "doc_tokens"]


def _tokens(config: str, size: int, window: int, id_type: str):
    """Pieces of each text: its whole windows, and what is left as a unit
    with its ids and two smallest token hashes. One more row per task (length 0) counts the units that hold each token."""
    def run(batches):
        encode = worker_encoder(config)
        order = [mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(2 * s + 3)) >> np.uint64(1) for s in (0, 1)]
        held, schema = np.zeros(size, np.int64), None
        for batch in batches:
            schema = batch.schema.field(0)
            for a in range(0, len(batch), TEXTS):
                rows, out = [], {k: [] for k in [*PIECE, "ids", "low", "next"]}

                def add(*values):
                    for k, v in zip(out, values):
                        out[k].append(v)

                for i, text in enumerate(batch.column(1).slice(a, TEXTS).to_pylist(), a):
                    ids = np.append(encode(text), np.uint32(END))
                    n = len(ids)
                    for start in range(0, n - window + 1, window):
                        rows.append(i)
                        add(start, window, crc(ids[start: start + window]), n, None, None, None)
                    rest = ids[n - n % window:]
                    if len(rest):
                        terms = np.sort(rest)
                        terms = terms[np.append(True, terms[1:] != terms[:-1])]
                        held[terms] += 1
                        rows.append(i)
                        add(n - n % window, len(rest), crc(rest), n, rest.astype(id_type).tobytes(),
                            int(order[0][terms].min()), int(order[1][terms].min()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(out[k], pa.int64()) for k in PIECE],
                     pa.array(out["ids"], pa.binary()), pa.array(out["low"], pa.int64()), pa.array(out["next"], pa.int64()),
                     pa.nulls(len(rows), pa.list_(pa.int64()))], [schema.name, *PIECE, "ids", "low", "next", "held"])
        if held.any():
            none = [pa.nulls(1, t) for t in (pa.binary(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, schema.type), *[pa.array([0], pa.int64()) for _ in PIECE], *none,
                                              pa.array([held], pa.list_(pa.int64()))], [schema.name, *PIECE, "ids", "low", "next", "held"])

    return run


class Index:
    """A BM25 inverted index over the units of a shard."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean: float):
        size = np.array([len(u) for u in units], np.int64)
        vocabulary = len(idf)
        held, tf = np.unique(np.repeat(np.arange(len(units)), size) * vocabulary + np.concatenate(units), return_counts=True)
        unit, self.terms = held // vocabulary, held % vocabulary
        self.first = np.searchsorted(unit, np.arange(len(units) + 1))
        weight = idf[self.terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[unit] / mean))
        by = np.argsort(self.terms, kind="stable")
        self.term, self.unit, self.weight = self.terms[by], unit[by], weight[by]
        self.n, self.vocabulary = len(units), vocabulary
        self._point()

    def _point(self):
        self.at = np.searchsorted(self.term, np.arange(self.vocabulary + 1)).tolist()

    def drop(self, used: np.ndarray):
        """Forgets used units; the others' scores stay."""
        live = ~used[self.unit]
        self.term, self.unit, self.weight = self.term[live], self.unit[live], self.weight[live]
        self._point()

    def scores(self, u: int) -> np.ndarray:
        """The score of every unit still held, for the terms of ``u``: its lists, added up."""
        at = self.at
        lists = [slice(at[t], at[t + 1]) for t in self.terms[self.first[u]: self.first[u + 1]].tolist()]
        return np.bincount(np.concatenate([self.unit[x] for x in lists]), np.concatenate([self.weight[x] for x in lists]), self.n)


def fill(units: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW):
    """(sequence, offset, unit, from, to) of each piece; all windows but the last are full."""
    index, size = Index(units, idf, mean), [len(u) for u in units]
    used, left, held = np.zeros(len(units), bool), len(units), len(units)
    seed, sequence, rest = 0, 0, None
    while rest or left:
        if not rest:
            while used[seed]:
                seed += 1
            used[seed], left, rest = True, left - 1, (seed, 0)
        u, start = rest
        yield sequence, 0, u, start, size[u]
        at, rest = size[u] - start, None
        if at < window and left:
            if 2 * left < held:
                index.drop(used)
                held = left
            scores = index.scores(u)
            scores[used] = -1
            while at < window and left:
                v = int(scores.argmax())  # ties: the first
                used[v], scores[v], left = True, -1, left - 1
                take = min(size[v], window - at)
                yield sequence, at, v, 0, take
                at += take
                if take < size[v]:
                    rest = (v, take)
        sequence += 1


def _shard(idf: np.ndarray, mean: float, window: int, id_type: str):
    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        del held
        name = rows.schema.names[0]
        rows = rows.sort_by([(k, "ascending") for k in ("low", "next", name, "start", "ids_crc32")])
        units = [np.frombuffer(v, id_type) for v in rows.column("ids").to_pylist()]
        start, total = rows.column("start").to_numpy(), rows.column("doc_tokens").to_numpy()
        shard = TaskContext.get().partitionId() << 33
        pieces = fill(units, idf, mean, window)
        while True:
            some = [p for _, p in zip(range(10_000), pieces)]
            if not some:
                return
            sequence, at, unit, a, b = np.array(some, np.int64).T
            crcs = [crc(units[u][x:y]) for u, x, y in zip(unit.tolist(), a.tolist(), b.tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(unit)).combine_chunks(), pa.array(start[unit] + a), pa.array(b - a), pa.array(crcs, pa.int64()),
                 pa.array(total[unit]), pa.array((sequence + shard) * 2 + 1), pa.array(at)],
                [name, *PIECE, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of all texts, packed into sequences of ``window`` tokens: id,
    ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Every id of every text, the closing one included, lies in one piece. Null and empty
    texts are one token (the closing id); special tokens that stand in a text keep their ids;
    null and repeated ids and repeated rows are packed each; an empty table gives an empty
    result; other columns are not read. Equal scores go to the unit that sorts first by token
    hashes, id, start and checksum. A shard holds ``shard_tokens`` tokens on average, so it is
    bounded whatever the input; units of other shards are not candidates."""
    with open(path, encoding="utf-8") as f:  # a vocabulary file of the driver; its text travels with the tasks
        config = f.read()
    shape = json.loads(config)
    size = 1 + max([END, *shape["model"]["vocab"].values(), *[t["id"] for t in shape["added_tokens"]]])
    id_type = "<u2" if size <= 1 << 16 else "<u4"
    rows = docs.select(id_col, text_or_empty(text_col).alias("__text"))
    long = T.LongType()
    schema = T.StructType([rows.schema[0], *[T.StructField(k, long) for k in PIECE], T.StructField("ids", T.BinaryType()),
                           T.StructField("low", long), T.StructField("next", long), T.StructField("held", T.ArrayType(long))])
    pieces = written(rows.mapInArrow(_tokens(config, size, window, id_type), schema), "pieces")
    units = pieces.where(F.col("ids").isNotNull())
    total = units.agg(F.count("*").alias("n"), F.sum("length").alias("tokens")).first()
    # at most one row per id of the vocabulary
    held = pieces.where(F.col("held").isNotNull()).select(F.posexplode("held").alias("t", "n")).where("n > 0").groupBy("t").agg(
        F.sum("n").alias("n")).toArrow()
    df = np.zeros(size)
    df[held.column("t").to_numpy()] = held.column("n").to_numpy()
    idf = np.log1p((total.n - df + 0.5) / (df + 0.5))
    shards = max(1, math.ceil((total.tokens or 0) / shard_tokens))
    dealt = units.select(id_col, *PIECE, "ids", "low", "next").repartitionByRange(
        shards, "low", "next", F.xxhash64(id_col, "start", "ids_crc32"))
    out = T.StructType([rows.schema[0], *[T.StructField(k, long) for k in [*PIECE, "sequence_id", "offset"]]])
    packed = dealt.mapInArrow(_shard(idf, (total.tokens or 1) / max(total.n, 1), window, id_type), out)
    whole = pieces.where(F.col("ids").isNull() & (F.col("length") > 0)).select(
        id_col, *PIECE, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)
