"""Fill-in-middle transformation over content-defined chunks.

A rolling hash of its bytes cuts each text into chunks, so passages that
documents share give the same chunks. A worker keeps a summary of each chunk
it has met (found by the chunk's bytes, so a hit is equal content): how many
code points begin in it, whether it holds a marker, whether one may begin in
its last bytes. Adding the counts of a text's chunks gives its code points and
the chunk in which a cut lies; only that chunk is looked into.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.bpe import Memory, cuts
from vitrine.llm.common import row_groups, text_buffer, text_or_empty

#: Fixed values of the contract: the markers, and of 100 texts how many are transformed, and how many of those suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
FIM_RATE, SPM_RATE = 90, 20
FORMS = ("plain", "psm", "spm")
#: Bytes of chunks that a worker remembers, log2 of the mean chunk length, bytes of texts handled at once.
CHUNK_MEMORY, CHUNK_BITS = 16 << 20, 9
GROUP = 1 << 20
#: What a summary says besides its count.
HOLDS, OPENS = 1, 2


def summary(chunk: bytes) -> tuple[int, int]:
    """(code points that begin in the chunk, flags)."""
    raw = np.frombuffer(chunk, np.uint8)
    points = int(np.count_nonzero((raw & 0xC0) != 0x80))
    flags = (HOLDS if b"<" in chunk and any(m in chunk for m in MARKERS) else 0) | (OPENS if b"<" in chunk[-2:] else 0)
    return points, flags


class Chunks:
    """Chunks of a group of texts with the summaries of their contents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, memory: Memory, bits: int = CHUNK_BITS):
        self.raw, self.offsets = data.tobytes(), offsets
        at = np.union1d(cuts(data, offsets, bits=bits), offsets)
        self.at = at
        points, flags = np.zeros(len(at), np.int64), np.zeros(len(at), np.uint8)
        edges, get, raw = at.tolist(), memory.get, self.raw
        for i in range(len(edges) - 1):
            chunk = raw[edges[i]: edges[i + 1]]
            known = get(chunk)
            if known is None:
                memory.put(chunk, known := summary(chunk), len(chunk) + 200)
            points[i + 1], flags[i + 1] = known
        #: Code points before each chunk edge, and chunks before each row's first.
        self.before = np.cumsum(points)
        self.first = np.searchsorted(at, offsets)
        self.flags = flags[1:]
        self.counts = self.before[self.first[1:]] - self.before[self.first[:-1]]

    def marked(self) -> np.ndarray:
        """Whether each text holds a marker, inside a chunk or over a join."""
        rows = np.searchsorted(self.offsets, self.at[:-1], side="right") - 1
        out = np.zeros(len(self.offsets) - 1, bool)
        out[rows[(self.flags & HOLDS) > 0]] = True
        for i in np.flatnonzero(self.flags & OPENS).tolist():
            join, end = int(self.at[i + 1]), int(self.offsets[rows[i] + 1])
            near = self.raw[max(join - 2, int(self.offsets[rows[i]])): min(join + 2, end)]
            if any(m in near for m in MARKERS):
                out[rows[i]] = True
        return out

    def place(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Byte (in its text) at which the code point ``points`` of each row begins, its end if there is none."""
        target = self.before[self.first[rows]] + points
        chunk = np.searchsorted(self.before, target, side="right") - 1
        out = self.offsets[rows + 1] - self.offsets[rows]
        for i in np.flatnonzero(points < self.counts[rows]).tolist():
            lo, hi = int(self.at[chunk[i]]), int(self.at[chunk[i] + 1])
            starts = np.flatnonzero((np.frombuffer(self.raw, np.uint8, hi - lo, lo) & 0xC0) != 0x80)
            out[i] = lo + int(starts[target[i] - self.before[chunk[i]]]) - self.offsets[rows[i]]
        return out


def transform(data: np.ndarray, offsets: np.ndarray, h: list[np.ndarray], memory: Memory, fim_rate: int = FIM_RATE,
              spm_rate: int = SPM_RATE, bits: int = CHUNK_BITS):
    """(n, form, prefix points, middle points, output) of each text; the points are -1 where the form is plain."""
    c = Chunks(data, offsets, memory, bits)
    n = c.counts
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    first, last = np.minimum(a, b), np.maximum(a, b)
    plain = (n == 0) | (h[2] % 100 >= fim_rate) | c.marked()
    form = np.where(plain, 0, np.where(h[3] % 100 < spm_rate, 2, 1))
    rows = np.flatnonzero(~plain)
    one, two = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    one[rows], two[rows] = c.place(rows, first[rows]), c.place(rows, last[rows])
    out, edges = [], offsets.tolist()
    for i, (f, x, y) in enumerate(zip(form.tolist(), one.tolist(), two.tolist())):
        text = c.raw[edges[i]: edges[i + 1]]
        if f:
            head, middle, tail = text[:x], text[x:y], text[y:]
            text = b"".join((PREFIX, head, SUFFIX, tail, MIDDLE, middle) if f == 1 else (SUFFIX, tail, PREFIX, head, MIDDLE, middle))
        out.append(text)
    return n, form, np.where(plain, -1, first), np.where(plain, -1, last - first), out


def strings(values: list[bytes]) -> pa.Array:
    """UTF-8 byte strings as an Arrow string column."""
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values], dtype=np.int64))).astype(np.int64)
    joined = pa.LargeStringArray.from_buffers(len(values), pa.py_buffer(ends), pa.py_buffer(b"".join(values)))
    return joined.cast(pa.string())


_MEMORY: list[Memory] = []


def _run(fim_rate: int, spm_rate: int):
    def run(batches):
        if not _MEMORY:
            _MEMORY.append(Memory(CHUNK_MEMORY))
        for batch in batches:
            data, off = text_buffer(batch.column("__text"))
            h = [batch.column(f"__h{k}").to_numpy(zero_copy_only=False) for k in range(4)]
            for a, b in row_groups(off, GROUP):  # outputs leave group by group
                n, form, first, middle, out = transform(data[off[a]: off[b]], off[a: b + 1] - off[a], [x[a:b] for x in h],
                                                        _MEMORY[0], fim_rate, spm_rate)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array([FORMS[f] for f in form.tolist()], pa.string()),
                     pa.array(first, mask=form == 0), pa.array(middle, mask=form == 0), strings(out)],
                    [batch.schema.names[0], "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_rate: int = FIM_RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """id, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text of every row.

    Both cuts, the form and the order come from the sha256 of ``1:`` and the
    id, so reruns agree and a row does not depend on others. Null texts count as
    empty; empty texts and texts that hold a marker stay plain (null
    ``prefix_chars`` and ``middle_chars``); a null id counts as an empty string; repeated rows give
    repeated results; an empty table gives an empty result; other columns are not
    read. A text is never shortened, whatever its length."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(id_col, text_or_empty(text_col).alias("__text"), digest.alias("__digest"))
    part = [F.conv(F.substring("__digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"__h{k}") for k in range(4)]
    schema = T.StructType([rows.schema[0], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType())])
    return rows.select(rows.columns[0], "__text", *part).mapInArrow(_run(fim_rate, spm_rate), schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of that form was made from. The text holds no
    marker, so each of the three stands in the output once."""
    out = F.col(output)
    p, s, m = (x.decode() for x in MARKERS)
    before, middle = F.substring_index(out, m, 1), F.substring_index(out, m, -1)
    psm = F.concat(F.replace(F.substring_index(before, s, 1), F.lit(p), F.lit("")), middle, F.substring_index(before, s, -1))
    spm = F.concat(F.substring_index(before, p, -1), middle, F.replace(F.substring_index(before, p, 1), F.lit(s), F.lit("")))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)


def fim_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``fill_in_middle`` with the sha256 of the output and of the text rebuilt from output and form alone."""
    out = fill_in_middle(docs, id_col, text_col)
    return out.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))
