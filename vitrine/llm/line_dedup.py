"""Line de-duplication by distinct-site spread: HyperLogLog sketches per line hash."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import text_or_empty, written

#: A line on this many sites is boilerplate.
MIN_SITES = 10
#: log2 of the sketch's registers: a standard error of 1.04 / sqrt(4096) = 1.6 %.
LOG_K = 12


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    t = text_or_empty(text_col)
    # the row's key is made below the explode: beside it, it would be made anew for every line
    whole = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), _row_key(F.col(id_col), t).alias("row"), t.alias("t"))
    rows = whole.select("id", "site", "row", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    key = F.unhex(F.md5(F.btrim("line", F.lit(" \t\r\x0b\x0c"))))
    return rows.where(F.btrim("line", F.lit(" \t\r\x0b\x0c")) != "").select("id", "site", "row", "pos", key.alias("key"))


def _row_key(row_id, text):
    """128 bits that stand for (id, text)."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(row_id.cast("string"), F.lit("null")), text)))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """``key`` of each line that lies on ``min_sites`` sites or more.

    One sketch per line hash, merged map-side and then by the shuffle: a line
    on a third of all rows sends one sketch per task. Estimates further than
    4 standard errors (one site at least) from the limit decide; the lines
    nearer than that get an exact distinct count."""
    band = max(1.0, 4 * 1.04 / math.sqrt(2**log_k) * min_sites)
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("sites"),
        F.count("site").alias("n"),
    )
    # a line has no more sites than rows, so what is rarer needs neither a count nor a place in the scratch table
    likely = written(sketched.where((F.col("n") >= min_sites) & (F.col("sites") >= min_sites - band)), "line-spread")
    sure = likely.where(F.col("sites") > min_sites + band).select("key")
    near = likely.where(F.col("sites") <= min_sites + band).select("key")
    pairs = lines.where("site is not null").join(near, "key", "left_semi").select("key", "site").distinct()
    exact = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("key")
    return sure.unionByName(exact)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
               min_sites: int = MIN_SITES, log_k: int = LOG_K, counts: bool = False) -> DataFrame:
    """``docs`` with cross-site boilerplate lines taken out of the text.

    A line is what stands between line feeds; two lines are equal when
    identical after trimming white space. A line on ``min_sites`` distinct
    sites or more is boilerplate: its first occurrence in the corpus
    (smallest id, then position) stays, so no content is lost, and all others
    go. With ``counts``, ``n_lines`` and ``n_removed`` are added.

    Blank lines are never boilerplate and always stay. Null text is empty
    and stays as it is; a null site counts as no site; a null id orders last.
    Rows that share id and text are one document: they get the same result.
    A document whose lines all go keeps an empty text; it is not dropped.
    Extra columns pass through unchanged. An empty table gives an empty one."""
    lines = written(_lines(docs, id_col, text_col, site_col), "lines")
    spread = written(spread_lines(lines, min_sites, log_k), "spread-lines")
    hits = lines.join(spread, "key").select("key", "id", "row", "pos")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", "pos")
    # written, so that its size is known: broadcast where it is small, else a plain join whose hot line can be split
    first = written(hits.groupBy("key").agg(F.min(place).alias("first")), "line-firsts")
    # rows repeated with id and text have the same lines: distinct joins them
    gone = hits.join(first, "key").where((F.col("row") != F.col("first.row")) | (F.col("pos") != F.col("first.pos")))
    drops = gone.groupBy("row").agg(F.collect_set("pos").alias("drop"))
    # the caller's other columns travel as one struct, so that no name of theirs meets one of ours; the text
    # travels as its lines, so that they are split once, below the join, and then read by position
    rest = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text_col}
    t = F.col(f"`{text_col}`").cast("string")
    side = docs.select(F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(k) for c, k in rest.items()]).alias("d"), F.split(t, "\n").alias("lines"),
                       _row_key(F.col(f"`{id_col}`"), text_or_empty(t)).alias("key"))
    joined = side.join(drops.withColumnRenamed("row", "key"), "key", "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    text = F.array_join(F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.transform(kept, lambda i: F.get("lines", i))), "\n")
    out = [text.alias(c) if c == text_col else F.col(f"d.{rest[c]}").alias(c) for c in docs.columns]
    if counts:
        empty = F.col("lines").isNull() | ((F.size("lines") == 1) & (F.get("lines", F.lit(0)) == ""))
        out += [F.when(empty, 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_removed")]
    return joined.select(*out)
