"""Exact de-duplication (native): group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import lower_ascii, text_or_empty, written


def content_hash(col) -> Column:
    return F.unhex(F.md5(col))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                hash_fn=content_hash) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id`` (the row of its group
    that stays), ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z only. ``keep`` is
    the ``smallest`` or ``largest`` id of a group; ids must order stably.

    1. One scan writes (id, hash, sha256), a narrow table.
    2. Groups are aggregated by the 128-bit hash: long buffers, combined on
       the map side, so a group with a third of all rows stays small.
    3. Only texts of groups with several rows are read again, and grouped by
       (hash, text): that compares their bytes. Equal copies collapse on
       the map side.
    4. A hash with one text joins back by the hash alone. A hash with
       several texts (a collision) joins back by its texts' bytes.

    Null text is empty text. Null ids: ignored by ``keep_id`` unless the
    whole group has none, then ``keep_id`` is null. Of rows that share the staying id (or
    its lack) and text, one is marked kept. An empty
    table gives an empty result; columns other than id and text are not
    read. ``hash_fn`` can be replaced in tests to force collisions."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    best, of_best = (F.max, F.max_by) if keep == "largest" else (F.min, F.min_by)
    # the row that stays, by its number in the written table
    stays = F.coalesce(of_best("n", "id"), F.min("n")).alias("keep_n")
    texts = docs.select(F.col(id_col).alias("id"), lower_ascii(text_or_empty(text_col)).alias("t"))
    rows = written(texts.select("id", hash_fn(F.col("t")).alias("h"), F.unhex(F.sha2("t", 256)).alias("sha"), F.monotonically_increasing_id().alias("n")), "exact-rows")
    by_hash = rows.groupBy("h").agg(best("id").alias("keep_id"), stays, F.count(F.lit(1)).alias("group_size"))
    several = by_hash.where("group_size > 1").select("h")

    # bytes inside the groups: one row per (hash, text) of the groups with several rows
    suspects = texts.withColumn("h", hash_fn(F.col("t"))).join(several, "h", "left_semi")
    classes = written(
        suspects.groupBy("h", "t").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumn("sha", F.unhex(F.sha2("t", 256))).drop("t"), "exact-classes",
    )
    collided = classes.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h")

    one = by_hash.join(collided, "h", "left_anti")
    clean = rows.join(one, "h")
    # several texts under one hash: the sha256 of a class's bytes tells them apart
    several_texts = rows.join(collided, "h", "left_semi")
    first = several_texts.groupBy("h", "sha").agg(stays)
    mixed = several_texts.join(classes.join(collided, "h", "left_semi"), ["h", "sha"]).join(first, ["h", "sha"]).select(clean.columns)
    return clean.unionByName(mixed).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("n") == F.col("keep_n")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
