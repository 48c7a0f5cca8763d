"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vitrine.llm.common import text_or_empty, written
from vitrine.llm.components import components

BITS = 64
#: The contract's shingle length and largest bit distance.
SHINGLE = 4
MAX_BITS = 4
#: Fingerprints are cut into three segments, which cost few probes, while so many or fewer differ; above, a segment's
#: values would each hold several of them, and two longer segments cost more probes but meet fewer.
FEW = 1 << 24
#: Shingle hashes that are counted at once.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included.
    Fewer words than ``shingle`` make one shingle; no words give 0."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    a, b = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(a), BLOCK):
        h = np.array([digest(joined[x:y], 42) for x, y in zip(a[i: i + BLOCK], b[i: i + BLOCK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(a), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            fp = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
            rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(np.array(fp, np.uint64).view(np.int64))], [*names, "fp"])

    return run


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(*keep, text_or_empty(text_col).alias("text"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "text"], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(_fingerprints(shingle), schema)


def segment_count(n: int) -> int:
    """Segments for ``n`` different fingerprints: their values have more bits than ``n``."""
    return 3 if n <= FEW else 2


def segments(max_bits: int = MAX_BITS, parts: int = 3, bits: int = BITS) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment. Radii r_i with
    sum(r_i + 1) = max_bits + 1: were every segment further apart than its
    radius, the fingerprints would differ in more than ``max_bits`` bits."""
    parts = min(parts, max_bits + 1)
    share = [(max_bits + 1) // parts + (i < (max_bits + 1) % parts) for i in range(parts)]
    width = [bits // parts + (i < bits % parts) for i in range(parts)]
    return [(sum(width[:i]), width[i], share[i] - 1) for i in range(parts)]


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS, parts: int = 3) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct longs ``fp`` that differ in
    at most ``max_bits`` bits, each once.

    Every fingerprint stands in one table per segment under that segment's
    exact value, and looks up the ball around its own value in each. A match
    is verified on all bits. A pair within reach in several segments is taken
    in the first of them, so no later ``distinct`` is needed. ``parts`` is 2
    at least; distinct fingerprints are never 0 bits apart."""
    if parts < 2:
        raise ValueError("parts must be 2 or more")
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    segs = segments(max_bits, parts)

    def value(col, shift, width):
        return F.shiftrightunsigned(F.col(col), shift).bitwiseAND(F.lit((1 << width) - 1))

    def key(i, v):
        return F.lit(i << 40).cast("long") + v

    index = fps.select(F.col("fp").alias("b"), F.explode(F.array(*[key(i, value("fp", s, w)) for i, (s, w, _) in enumerate(segs)])).alias("key"))
    probes = fps.select(F.col("fp").alias("a"), F.explode(F.array(*[
        key(i, value("fp", s, w).bitwiseXOR(F.lit(m).cast("long"))) for i, (s, w, r) in enumerate(segs) for m in ball(w, r)
    ])).alias("key"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    apart = [F.bit_count(F.shiftrightunsigned(diff, s).bitwiseAND(F.lit((1 << w) - 1))) > r for s, w, r in segs]
    table = F.shiftright(probes["key"], 40)
    first = F.lit(True)
    for i, _ in enumerate(segs):
        for far in apart[:i]:
            first = first & ((table != i) | far)
    return probes.join(index, (probes["key"] == index["key"]) & (F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_bits) & first).select("a", "b")


def near_classes(rows: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """``fp, root`` for each distinct ``fp`` of ``rows``: copies collapse to
    one fingerprint before any pair is made. Without ``parts`` their number decides it."""
    fps = written(rows.select("fp").distinct(), "fingerprints")
    roots = components(near_pairs(fps, max_bits, parts or segment_count(fps.count())))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most ``max_bits`` bits.

    Null text is empty; texts without words have fingerprint zero and link
    like any other. Null ids are ignored by ``component_id`` unless the
    component has no other (then it is null). Repeated rows fall into one
    component. An empty table gives an empty result; other columns are not read."""
    rows = written(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", shingle, ("id",)), "simhash-rows")
    classes = written(near_classes(rows, max_bits, parts), "simhash-classes")
    least = rows.groupBy("fp").agg(F.min("id").alias("least")).join(classes, "fp")
    # written, so that the last join has two plain exchanges and a hot fingerprint can be split
    named = least.groupBy("root").agg(F.min("least").alias("component_id")).join(classes, "root").select(F.col("fp").alias("_fp"), "component_id")
    named = written(named, "simhash-components")
    return rows.join(named, F.col("fp") == F.col("_fp")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null last;
    of equal ids, one row). All columns pass through unchanged."""
    t = text_or_empty(text_col)
    row_key = F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), t)))
    keyed = docs.select(F.col(id_col).alias("id"), row_key.alias("row"), t.alias("text"))
    rows = written(fingerprints(keyed, "text", shingle, ("id", "row")), "simhash-rows")
    classes = written(near_classes(rows, max_bits, parts), "simhash-classes")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    firsts = rows.groupBy("fp").agg(F.min(place).alias("p")).join(classes, "fp").groupBy("root").agg(F.min("p").alias("p"))
    stay = written(firsts.select(F.col("p.row").alias("__row")), "simhash-stay")
    # the caller's columns travel as one struct, so that no name of theirs meets one of ours
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    whole = docs.select(row_key.alias("key"), F.struct(*[F.col(f"`{c}`").alias(k) for c, k in names.items()]).alias("d"))
    kept = whole.join(stay, F.col("key") == F.col("__row"))
    one = kept.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("__row"))).where("n = 1")
    return one.select(*[F.col(f"d.{k}").alias(c) for c, k in names.items()])
