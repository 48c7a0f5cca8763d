"""Mixing sources to target weights (native): whole copies, then a Pareto order sample of the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import n_words, text_or_empty, written

#: Fixed values of the mix: weights by order of source, share of all words, most copies of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Random numbers have 52 bits, so they and their halves are exact doubles.
RANDOM = 2**52
#: Mean rows in a bucket of random numbers (a smaller one only means more rows of bucket sums).
BUCKET_ROWS = 2000


def random_number(id_col: str, text: Column, seed: str) -> Column:
    """52 random bits that depend on the seed, the id and the text alone: reruns agree."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def ranked(table: DataFrame, col: str, name: str) -> DataFrame:
    """``rank`` (from 0) of each row by ``col``, null last, without one task
    that sorts all rows: ranges are sorted apart and shifted by the rows before them."""
    by = F.col(col).asc_nulls_last()
    parts = written(table.orderBy(by).withColumn("_part", F.spark_partition_id()), name)
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(by)) - 1
    return parts.withColumn("_i", inside).join(before, "_part").withColumn("rank", F.col("_i") + F.col("_before")).drop(
        "_part", "_i", "_before"
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``target`` of each (source, source_size, n): ``share`` of all words
    by weight; targets stop at ``most`` times the source and the excess goes
    to the others by weight. A target is then min(cap, level * weight), and
    the level rises to its end in a few one-row aggregates."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = written(
        ranked(sizes, "source", "mix-ranks").withColumn("weight", w).withColumn("cap", F.col("source_size") * most), "mix-sources"
    )
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, F.col("cap") <= 0
    while True:
        row = table.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0)).alias("fixed"), F.sum(F.when(~capped, F.col("weight"))).alias("w")
        ).first()
        now = (total - (row["fixed"] or 0)) / row["w"] if row["w"] else level
        if now <= level:
            break
        level = now
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return table.withColumn("target", target).drop("rank", "cap")


def inclusion(k="k", size="size") -> Column:
    """A document's chance of one more copy: in proportion to its size, 1 at most."""
    return F.least(F.lit(1.0), F.col(k) * F.col(size))


def pareto(p: Column, r="r") -> Column:
    """The Pareto order: random odds over inclusion odds, q, as q / (1 + q), which lies between 0 and 1."""
    u = (F.col(r) + 0.5) / float(RANDOM)
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)


def _scale(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``k`` of each source with words to draw: the chances min(1, k * size)
    add up to the rest in words. Sizes are few: documents are counted by size, the largest sizes
    become certain one after the other until k times the next one is at most 1."""
    counts = rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("m"))
    given = counts.join(plan.select("_s", "rest"), F.col("source").eqNullSafe(F.col("_s")))
    words, squares = F.col("m") * F.col("size"), F.col("m") * F.col("size") * F.col("size")
    down = Window.partitionBy("_s").orderBy(F.desc("size"))
    certain = F.sum(words).over(down) - words
    below = F.sum(squares).over(Window.partitionBy("_s")) - F.sum(squares).over(down) + squares
    tried = given.select("_s", "size", ((F.col("rest") - certain) / below).alias("k"))
    return tried.where(F.col("k") * F.col("size") <= 1).groupBy("_s").agg(F.max_by("k", "size").alias("k"))


def mixing_plan(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source: ``source_size``, ``target``, ``whole`` (copies
    that every row gets), ``k`` (chance of one more by size) and ``cutoff`` (rows
    whose place in the Pareto order is not above it get one more).

    ``rows`` has (source, size, r); it is read a few times, so pass a written
    table. Of the words that the whole copies leave, a document is
    included with a chance in proportion to its size; the sample is the
    prefix of the Pareto order whose words come nearest to the rest. No source is
    gathered: sums by (source, bucket of the order) find
    the one bucket that holds the end of the prefix, and only its rows are
    sorted. About the end, where random and inclusion odds are equal, a bucket
    holds at most ``bucket_rows`` rows or so, whatever the chances."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = targets(sizes, weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(ratio))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = plan.withColumn("buckets", F.ceil(F.col("n") / bucket_rows)).withColumnRenamed("source", "_s")
    scale = _scale(rows, plan.where("rest > 0")).withColumnRenamed("_s", "_k")
    plan = written(plan.join(scale, F.col("_s").eqNullSafe(F.col("_k")), "left").withColumn("k", F.coalesce("k", F.lit(0.0))).drop("_k"), "mix-scales")

    dealt = rows.join(plan.select("_s", "buckets", "rest", "k"), F.col("source").eqNullSafe(F.col("_s"))).where("rest > 0")
    dealt = dealt.withColumn("g", pareto(inclusion())).withColumn("bucket", F.floor(F.col("g") * F.col("buckets")))
    sums = dealt.groupBy("_s", "bucket").agg(F.sum("size").alias("words"), F.min("rest").alias("rest"), F.min("g").alias("first"))
    upto = F.sum("words").over(Window.partitionBy("_s").orderBy("bucket"))
    ends = sums.withColumn("upto", upto).where("upto >= rest").groupBy("_s").agg(
        F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("base"), "rest", "first"), "bucket").alias("e")
    ).select("_s", "e.*")
    last = dealt.drop("_s", "rest").join(
        ends, F.col("source").eqNullSafe(F.col("_s")) & (dealt["bucket"] == ends["bucket"])
    )
    # rows of equal place are peers of a range frame: they are taken or left together
    total = F.col("base") + F.sum("size").over(
        Window.partitionBy("_s").orderBy("g").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.col("first") - F.col("first") * 2.0**-53  # the next smaller number
    choice = last.select("_s", "g", "rest", total.alias("total")).unionByName(
        ends.select("_s", F.when(F.col("first") > 0, before).otherwise(-1.0).alias("g"), "rest", F.col("base").alias("total"))
    )
    cut = choice.groupBy("_s").agg(
        F.min(F.struct(F.abs(F.col("total") - F.col("rest")), "total", "g")).alias("c")
    ).select(F.col("_s").alias("_c"), F.col("c.g").alias("cutoff"))
    return plan.join(cut, F.col("_s").eqNullSafe(F.col("_c")), "left").select(
        "_s", "source_size", "weight", "target", "whole", "k", F.coalesce("cutoff", F.lit(-1.0)).alias("cutoff")
    )


def copies(place: Column, cutoff="cutoff", whole="whole") -> Column:
    return F.col(whole) + (place <= F.col(cutoff)).cast("long")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    t = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(t).alias("size"),
                       random_number(id_col, t, seed).alias("r"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               seed: str = "mix", **plan) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (words), ``source_size``,
    ``target``, ``taken`` (words the mix takes, copies counted), ``copies``,
    ``chance`` (of one more copy) and ``pareto`` (the place in the order of the draw; null without one).

    The text is scanned once, to a narrow table. Null text has size 0; a
    null source is a source of its own, ordered last; a null id takes part
    like any other. Rows that share id and text are taken or left together.
    An empty table gives an empty result. Other columns are not read."""
    rows = written(_sized(docs, id_col, text_col, source_col, seed), "mix-rows")
    # written, so that its size is known: broadcast where it is small, else a plain join whose hot source can be split
    by_source = written(mixing_plan(rows, **plan), "mix-plan")
    joined = rows.join(by_source, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("g", pareto(inclusion()))
    return joined.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (copies(F.col("g")) * F.col("size")).alias("taken"),
        copies(F.col("g")).alias("copies"), inclusion().alias("chance"), F.when(F.col("k") > 0, F.col("g")).alias("pareto"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = "mix", **plan) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it
    (0 to ``most`` times), all columns unchanged. The rows are not shuffled
    by source: the small plan is joined to them, and Spark splits a hot
    source where it does not fit a broadcast. Defined cases as in
    ``mix_report``; a clashing column name of the plan is never visible."""
    rows = written(_sized(docs, id_col, text_col, source_col, seed).drop("id"), "mix-rows")
    by_source = written(mixing_plan(rows, **plan), "mix-plan").select("_s", "k", "whole", "cutoff")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    t = text_or_empty(text_col)
    whole = docs.select(F.struct(*[F.col(f"`{c}`").alias(k) for c, k in names.items()]).alias("d"), F.col(source_col).alias("source"),
                        n_words(t).alias("size"), random_number(id_col, t, seed).alias("r"))
    joined = whole.join(by_source, F.col("source").eqNullSafe(F.col("_s")), "left")
    n = copies(pareto(inclusion()))
    times = joined.withColumn("n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(0).cast("long"))))).where("n > 0")
    return times.select(*[F.col(f"d.{k}").alias(c) for c, k in names.items()])
