"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut by a rolling hash of its bytes, so equal passages give equal
chunks wherever they stand. A chunk's inside (what lies between its first
and last white space) is encoded once and kept for every document that
holds the chunk. A cut may split a word: the two loose ends at each join are
put together and encoded anew. Merges never reach over white space, so the
result agrees with encoding the whole text at once.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bytescan import byte_values, powers, table_size
from vitrine.llm.common import row_groups, text_buffer, text_or_empty

#: Bytes that the rolling hash looks at, and log2 of the mean chunk length.
WINDOW, CHUNK_BITS = 16, 9
#: Bounds of the memories of a worker: bytes of chunks with their ids, and words.
CHUNK_MEMORY, WORD_MEMORY = 8 << 20, 50_000
#: Bytes of texts handled at once.
GROUP = 1 << 20
assert sys.byteorder == "little" and array("I").itemsize == 4  # ids are written as little-endian 32-bit integers


def cuts(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, bits: int = CHUNK_BITS) -> np.ndarray:
    """Chunk ends inside rows: where the hash of the last ``window`` bytes has
    ``bits`` zeros. Depends on those bytes alone."""
    if len(data) < window:
        return np.zeros(0, np.int64)
    up, down = powers(table_size(len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * up[: len(data)], out=sums[1:])
    h = (sums[window:] - sums[:-window]) * down[: len(data) - window + 1]
    return np.flatnonzero(h >> np.uint64(64 - bits) == 0) + window


class Memory:
    """A dictionary of bounded weight: the older half is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.weight, self.young, self.old = limit, 0, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value, weight: int = 1):
        if self.weight > self.limit:
            self.old, self.young, self.weight = self.young, {}, 0
        self.young[key] = value
        self.weight += weight


#: Fixed value: the normaliser of the tokenizers that this operator serves (white space is dropped later).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
#: Words of these characters only are normalised here: each is its own NFC form and lower-cases alone.
PLAIN = regex.compile("[\x21-\x7e\u00c0-\u012f\u0131-\u017e]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself
    where it is printable, else the next letter from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Codec:
    """Encodes words by the tokenizer's own merges; remembers words, their pieces and chunks.

    Serves tokenizers whose pieces never hold white space; others are refused."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer

        shape = json.loads(config)
        steps = (shape.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split, level = steps[0], steps[-1]
        if shape["normalizer"] != NORMALIZER or len(steps) != 2 or (split.get("behavior"), split.get("invert")) != ("Removed", True) or (
                level.get("type"), level.get("add_prefix_space"), level.get("use_regex")) != ("ByteLevel", False, False) or shape["decoder"]:
            raise ValueError("this tokenizer keeps white space in its tokens or normalises otherwise")
        self.tokenizer = Tokenizer.from_str(config)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        self.letters = byte_letters()
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.names = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.chunks, self.parts = Memory(WORD_MEMORY), Memory(CHUNK_MEMORY), Memory(WORD_MEMORY)

    def _word(self, word: bytes) -> tuple[bytes, bytes]:
        """(ids, decoded text): without a decoder, decoding joins the tokens by spaces."""
        text = word.decode()
        if not PLAIN.fullmatch(text) or any(a in text for a in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes(), b" ".join([self.names[i] for i in ids])
        found = [self.parts.get(p) or self._part(p) for p in self.pieces(text.lower())]
        return found[0] if len(found) == 1 else (b"".join([f[0] for f in found]), b" ".join([f[1] for f in found]))

    def _part(self, piece: str) -> tuple[bytes, bytes]:
        letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = [t.id for t in self.merge(letters)]
        known = array("I", ids).tobytes(), b" ".join([self.names[i] for i in ids])
        self.parts.put(piece, known)
        return known

    def learn(self, words) -> dict:
        """(ids, decoded) of each distinct word."""
        found, get, put = {}, self.words.get, self.words.put
        for w in words:
            known = get(w)
            if known is None:
                put(w, known := self._word(w))
            found[w] = known
        return found

    def encode(self, texts: list[bytes], ends: list[list[int]]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded) of each text, given the ends of its chunks."""
        plan, fresh, need = [], {}, set()
        for text, stops in zip(texts, ends):
            steps, loose, at = [], b"", 0
            for stop in stops:
                chunk, at = text[at:stop], stop
                inside = self._cut(chunk)
                if inside is None:  # no white space: all of it is part of one word
                    loose += chunk
                    continue
                head, tail = inside
                if loose or head:
                    word = loose + chunk[:head]
                    need.add(word)
                    steps.append((word, None))
                middle = chunk[head:tail]
                if self.chunks.get(middle) is None and middle not in fresh:
                    fresh[middle] = middle.split()
                    need.update(fresh[middle])
                steps.append((None, middle))
                loose = chunk[tail:]
            if loose:
                need.add(loose)
                steps.append((loose, None))
            plan.append(steps)
        known = self.learn(need)
        done = {}
        for middle, words in fresh.items():
            pairs = [known[w] for w in words]
            done[middle] = (b"".join([p[0] for p in pairs]), b" ".join([p[1] for p in pairs if p[1]]))
            self.chunks.put(middle, done[middle], len(middle) + len(done[middle][0]) + len(done[middle][1]))
        out = []
        for steps in plan:
            got = [known[w] if w is not None else done.get(m) or self.chunks.get(m) or self._again(m) for w, m in steps]
            out.append((b"".join([g[0] for g in got]), b" ".join([g[1] for g in got if g[1]])))
        return out

    def _again(self, middle: bytes) -> tuple[bytes, bytes]:
        """A chunk forgotten between planning and use."""
        words = middle.split()
        known = self.learn(set(words))
        return b"".join([known[w][0] for w in words]), b" ".join([known[w][1] for w in words if known[w][1]])

    @staticmethod
    def _cut(chunk: bytes) -> tuple[int, int] | None:
        """Bytes of a chunk before its first and up to after its last white space."""
        first = chunk.split(None, 1)[0] if chunk.strip() else b""
        if not chunk[:1].strip():
            head = 0
        else:
            head = len(first)
            if head == len(chunk):
                return None
        tail = len(chunk) if not chunk[-1:].strip() else len(chunk) - len(chunk.rsplit(None, 1)[-1])
        return head, tail


_CODECS: dict[int, Codec] = {}


def codec(config: str) -> Codec:
    """The worker's codec: its memories serve all tasks that the worker runs."""
    key = hash(config)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(config)
    return _CODECS[key]


def encode_column(column: pa.Array, c: Codec):
    """(first row, end row, (ids, decoded) of each) of bounded groups of rows."""
    data, off = text_buffer(column)
    for a, b in row_groups(off, GROUP):
        part, o = data[off[a]: off[b]], off[a: b + 1] - off[a]
        at = np.union1d(cuts(part, o), o)
        raw, texts, ends = part.tobytes(), [], []
        for i in range(b - a):
            lo, hi = int(o[i]), int(o[i + 1])
            texts.append(raw[lo:hi])
            inside = at[np.searchsorted(at, lo, side="right"): np.searchsorted(at, hi, side="right")]
            ends.append((inside - lo).tolist() if hi > lo else [])
        yield a, b, c.encode(texts, ends)


def _run(config: str, keep: list[str], digest: bool):
    def run(batches):
        c = codec(config)
        for batch in batches:
            # groups leave one by one: neither side ever holds the ids of a whole batch
            for a, b, pairs in encode_column(batch.column("__text"), c):
                n = np.array([len(i) // 4 for i, _ in pairs], np.int64)
                if digest:
                    more = [pa.array([hashlib.sha256(p[k]).hexdigest() for p in pairs], pa.string()) for k in (0, 1)]
                    names = ["ids_sha256", "decoded_sha256"]
                else:
                    ids = pa.array(np.frombuffer(b"".join([i for i, _ in pairs]), "<i4"))
                    more = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), ids)]
                    names = ["token_ids"]
                rest = [batch.column(k).slice(a, b - a) for k in keep]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(n), *more], [*keep, "n_tokens", *names])

    return run


def _apply(docs: DataFrame, path: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    with open(path, encoding="utf-8") as f:  # a vocabulary file of the driver; its text travels with the tasks
        config = f.read()
    rows = docs.select(id_col, text_or_empty(text_col).alias("__text"))
    more = [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] if digest else [
        T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()), *more])
    return rows.mapInArrow(_run(config, [id_col], digest), schema)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens`` and ``token_ids`` of every whole text, in row order.

    Null and empty texts have no tokens; special tokens that stand in a text
    keep their ids; repeated rows encode alike; null ids pass through; an empty
    table gives an empty result; other columns are not read."""
    return _apply(docs, path, id_col, text_col, digest=False)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens``, ``ids_sha256`` (ids as little-endian 32-bit integers)
    and ``decoded_sha256`` (of the text that the ids decode to). Cases as in ``bpe_encode``."""
    return _apply(docs, path, id_col, text_col, digest=True)


def bpe_decode(rows: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids: tokens joined by spaces, special
    tokens included. Null ids give a null text; unknown ids an empty token."""
    with open(path, encoding="utf-8") as f:
        config = f.read()

    def run(batches):
        names = codec(config).names
        for batch in batches:
            texts = [None if v is None else b" ".join([names[i] if 0 <= i < len(names) else b"" for i in v]).decode()
                     for v in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))
