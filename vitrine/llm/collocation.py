"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials over the bytes give each word a hash, prefix polynomials
over those give each run of up to four words a fingerprint, all in numpy. The
shuffle adds the counts of equal fingerprints. Lengths are counted one
after the other: a phrase can be frequent only if both phrases that it
holds, one word shorter, are, so a longer one is fingerprinted only where both were.
What is known of a length travels as one bit per fingerprint, in a bitmap of
fixed size; a bit too many costs work, never a result. A last pass goes back to
the text: windows whose fingerprints agree are compared word by word, each group's
first position points at the words to write, and the shuffle adds counts and keeps a pointer (the
first document) by the phrase itself, so equal fingerprints of different phrases do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vitrine.llm.bytescan import FOLD, mixed, powers, span_hashes, table_size, token_spans
from vitrine.llm.common import row_groups, text_buffer, text_or_empty, written

#: Fixed values of the contract: longest phrase, least count, scale of the score, share (in %) at which a longer phrase replaces one, report length.
MAX_WORDS, MIN_COUNT, SCALE, COVERED, TOP = 4, 30, 2_000_000, 80, 2000
NO_LANG = "und"
#: log2 of the bits of a length's bitmap (8 MB, whatever the input), bytes of texts handled at once (a little less
#: than the tables of powers hold).
BITMAP_BITS, GROUP = 26, 1_000_000
#: 1 for bytes of words, 0 for the blanks and marks between them; the marks that end a piece.
WORD = np.ones(256, np.uint8)
MARKS = np.zeros(256, bool)
MARKS[list(b".,;:!?\n\x0b\x0c\r")] = True
WORD[MARKS] = 0
WORD[[0x20, 0x09]] = 0


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int):
    """(first row, bytes, offsets, bytes whose words count) of at most about
    ``limit`` bytes. A longer row is cut between words; a part then also holds the
    ``MAX_WORDS - 1`` words after its end, for the phrases that begin in it."""
    for a, b in row_groups(offsets, limit):
        lo, hi = int(offsets[a]), int(offsets[b])
        while hi - lo > limit:
            cut = _gap(data, lo + limit, hi)
            end = cut
            for _ in range(MAX_WORDS - 1):
                end = _gap(data, _word(data, end, hi), hi)
            yield a, data[lo:end], np.array([0, end - lo]), cut - lo
            lo, b = cut, a + 1
            if lo >= hi:
                break
        if hi > lo:
            yield a, data[lo:hi], (offsets[a: b + 1] - lo if lo == offsets[a] else np.array([0, hi - lo])), hi - lo


def _first(data: np.ndarray, lo: int, hi: int, word: int) -> int:
    step = 1 << 12
    while lo < hi:
        found = np.flatnonzero(WORD[data[lo: min(lo + step, hi)]] == word)
        if len(found):
            return lo + int(found[0])
        lo, step = lo + step, step * 2
    return hi


def _gap(data, lo, hi):
    """First byte from ``lo`` on that is in no word."""
    return _first(data, lo, hi, 0)


def _word(data, lo, hi):
    return _first(data, lo, hi, 1)


class Words:
    """Words of a block with the fingerprints of all windows of up to four."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, own: int, seeds: np.ndarray, bits: int = 64):
        self.data = FOLD[data]
        self.starts, self.ends = token_spans(data, offsets, WORD)
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        marks = np.cumsum(MARKS[data], dtype=np.int32)
        #: Grows from piece to piece and from row to row.
        self.piece = marks[self.starts] + self.row
        self.own = self.starts < own
        n = len(self.starts)
        self.hash = span_hashes(self.data, self.starts, self.ends) if n else np.zeros(0, np.uint64)
        up, self.down = powers(table_size(n))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hash * up[:n], out=self.sums[1:])
        self.seeds, self.bits = seeds, bits

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, whether it lies in one piece) of the k words from each word on."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        fp = mixed((self.sums[k:] - self.sums[:-k]) * self.down[:n] ^ self.seeds[self.row[:n]])
        if self.bits < 64:
            fp = fp >> np.uint64(64 - self.bits) << np.uint64(64 - self.bits)
        return fp, self.piece[:n] == self.piece[k - 1:]

    def frequent(self, k: int, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, whether the window may be a frequent phrase)."""
        fp, whole = self.windows(k)
        at = (fp >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
        return fp, whole & ((bitmap[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)) > 0)

    def ids(self) -> np.ndarray:
        """A number for each different word of the block, by its bytes: words of one hash are compared."""
        _, first, same = np.unique(self.hash, return_index=True, return_inverse=True)
        rep = first[same]
        size = self.ends - self.starts
        equal = size == size[rep]
        if equal.all():
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            equal = self.data[step + np.repeat(self.starts, size)] == self.data[step + np.repeat(self.starts[rep], size)]
        if equal.all():
            return same
        known: dict[bytes, int] = {}
        raw = self.data.tobytes()
        return np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(self.starts.tolist(), self.ends.tolist())], np.int64)


def grouped(fp: np.ndarray, keys: list[np.ndarray], pointer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, count, least ``pointer``) of each group of equal ``keys``, found by fingerprint."""
    if not len(fp):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(fp, kind="stable")

    def changes(o):
        out = np.zeros(len(o) - 1, bool)
        for key in keys:
            out |= key[o[1:]] != key[o[:-1]]
        return out

    new = fp[order[1:]] != fp[order[:-1]]
    other = changes(order)
    if (other & ~new).any():  # one fingerprint, different words
        order = np.lexsort(keys[::-1])
        other = changes(order)
    starts = np.flatnonzero(np.append(True, other))
    return order[starts], np.diff(np.append(starts, len(order))), np.minimum.reduceat(pointer[order], starts)


def _parts(batch, limit: int, bits: int):
    """(words, row of the batch of their first) of a batch, block by block."""
    data, off = text_buffer(batch.column("__text"))
    seeds = mixed(batch.column("__seed").to_numpy().view(np.uint64))
    for a, part, o, own in blocks(data, off, limit):
        yield Words(part, o, own, seeds[a: a + len(o) - 1], bits), a


def _count(k: int, bitmap: np.ndarray | None, limit: int, bits: int):
    def run(batches):
        for batch in batches:
            for words, _ in _parts(batch, limit, bits):
                fp, ok = words.windows(k)
                if bitmap is not None:
                    _, shorter = words.frequent(k - 1, bitmap)
                    ok = ok & shorter[: len(fp)] & shorter[1: len(fp) + 1]
                found, n = np.unique(fp[ok & words.own[: len(fp)]], return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["fp", "n"])

    return run


def _bitmap(rows: DataFrame, least: int) -> np.ndarray:
    """One bit per fingerprint (by its leading bits) that occurs ``least`` times or
    more. The driver gets the bitmap's words, at most 2**(BITMAP_BITS - 6) of them, never the fingerprints."""
    at = F.shiftrightunsigned("fp", 64 - BITMAP_BITS)
    hit = rows.groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select(at.alias("at"))
    words = hit.select(F.shiftright("at", 6).alias("slot"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")).groupBy("slot").agg(
        F.expr("bit_or(bit)").alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[words.column("slot").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _phrases(bitmaps: list[np.ndarray], limit: int, bits: int):
    def run(batches):
        for batch in batches:
            lang, docs = batch.column("__lang").dictionary_encode(), batch.column("__id")
            of_row, by_id = lang.indices.to_numpy(zero_copy_only=False), pc.sort_indices(docs, null_placement="at_end").to_numpy()
            rank = np.empty(len(docs), np.int64)
            rank[by_id] = np.arange(len(docs))  # the least rank of a group is its first document
            for words, first_row in _parts(batch, limit, bits):
                row = words.row + first_row
                code, ids = of_row[row], words.ids() if len(row) else np.zeros(0, np.int64)
                raw, starts, ends = words.data.tobytes(), words.starts, words.ends
                for k in range(1, len(bitmaps) + 1):
                    fp, ok = words.frequent(k, bitmaps[k - 1])
                    at = np.flatnonzero(ok & words.own[: len(fp)])
                    first, n, least = grouped(fp[at], [code[at], *[ids[at + j] for j in range(k)]], rank[row[at]])
                    point = at[first]  # a position of each phrase: its words are read there
                    spans = [zip(starts[point + j].tolist(), ends[point + j].tolist()) for j in range(k)]
                    text = [b" ".join([raw[a:b] for a, b in part]).decode() for part in zip(*spans)]
                    yield _rows(lang.dictionary.take(pa.array(code[point])), k, text, n, docs.take(pa.array(by_id[least])))
                total = np.bincount(code[words.own], minlength=len(lang.dictionary))
                yield _rows(lang.dictionary, 0, [""] * len(total), total, pa.nulls(len(total), docs.type))

    return run


def _rows(lang, k, text, n, first) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(np.full(len(n), k, np.int32)), pa.array(text, pa.string()),
                                       pa.array(n.astype(np.int64)), first], ["lang", "k", "phrase", "f", "first_doc"])


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, group: int = GROUP, bits: int = 64) -> DataFrame:
    """``lang, k, phrase, f, first_doc``: every phrase of k = 1 to ``max_words`` words that
    occurs ``min_count`` times or more in its language, with the least id of a document that holds it (null
    if all are), and one row of k = 0 per language with the number of its words. ``docs`` is read ``max_words + 1`` times."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"), lang.alias("__lang"),
                       F.xxhash64(lang).alias("__seed"))
    bitmaps: list[np.ndarray] = []
    for k in range(1, max_words + 1):
        bitmaps.append(_bitmap(rows.select("__text", "__seed").mapInArrow(_count(k, bitmaps[-1] if bitmaps else None, group, bits), "fp long, n long"), min_count))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("k", T.IntegerType()), T.StructField("phrase", T.StringType()),
                           T.StructField("f", T.LongType()), T.StructField("first_doc", rows.schema["__id"].dataType)])
    found = rows.mapInArrow(_phrases(bitmaps, group, bits), schema)
    total = found.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"), F.min("first_doc").alias("first_doc"))
    return total.where((F.col("f") >= min_count) | (F.col("k") == 0))


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, group: int = GROUP, bits: int = 64) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score, first_doc``.

    A phrase of 2 to 4 words with a = f(phrase) >= ``min_count`` scores
    floor(2000000 a / (l + r)) at its lowest-scoring cut, l and r being the counts of the
    two parts there (the first such cut on ties). It is left out if a longer candidate
    holds its words and occurs at least 80 % as often. Order: score and a descending, phrase ascending.

    Null texts count as empty, a null language as ``und`` (an empty one stays); texts without
    words, languages without candidates and an empty table give no rows; repeated rows count each time; other
    columns are not read. A long text is handled part by part; a single word is held whole."""
    grams = written(frequent_phrases(docs, id_col, text_col, lang_col, min_count, group=group, bits=bits), "phrases")
    words = F.split("phrase", " ")
    cand = grams.where("k >= 2").select("lang", "k", "phrase", F.col("f").alias("a"), "first_doc", words.alias("words"))

    def part(start, size):
        return F.array_join(F.slice("words", start, size), " ")

    cuts = cand.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "first_doc", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    known = grams.where("k >= 1")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr(f"({SCALE} * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + r)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "first_doc").agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("best"))

    longer = cand.where("k >= 3").select("lang", "k", "a", "words", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")).select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start")).select(
        "lang", part(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("__longer"))
    covered = F.expr(f"100 * cast(__longer as decimal(20, 0)) >= {COVERED} * cast(a as decimal(20, 0))")
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("__longer").isNull() | ~covered)

    n = grams.where("k = 0").select("lang", F.col("f").alias("n"))
    flat = kept.select("lang", "phrase", "a", "first_doc", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc")
