"""Quoted CSV read in parallel, line breaks inside fields included (A10).

Spark's ``multiLine`` reader gives a whole file to one task, because a task that
starts in the middle cannot know whether it stands inside a quoted field. It need
not know, only count: a position is inside quotes when an odd number of quote
characters comes before it (a doubled quote counts twice and changes nothing).

1. Every split of every file counts its quotes (one row per split).
2. A prefix sum over a file's splits gives the state in which each begins.
3. Each split joins its physical lines to records: a line that begins
   outside quotes begins a record. What a split holds before its first record and its unfinished
   last one leave as fragments, at most two per split.
4. Fragments are put together across splits in file order, and all records are
   parsed by Spark's own CSV parser.

Files are cut by ``spark.sql.files.maxPartitionBytes`` like any other text; a task holds
one record at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vitrine.session import cut_lineage

RECORD, HEAD, TAIL = 0, 1, 2
_BATCH = 4_096


def _records(quote: str):
    """Lines of whole splits, in order, with the state each split begins in -> records and fragments."""
    q = quote.encode()

    def run(batches):
        out: dict[str, list] = {k: [] for k in ("kind", "file", "split", "first", "text")}

        def put(kind, at, first, lines):
            for k, v in zip(out, (kind, *at, first, "\n".join(lines))):
                out[k].append(v)

        def full():
            rows = pa.RecordBatch.from_arrays(
                [pa.array(out["kind"], pa.int32()), pa.array(out["file"], pa.string()), pa.array(out["split"], pa.int64()),
                 pa.array(out["first"], pa.bool_()), pa.array(out["text"], pa.string())], list(out))
            for v in out.values():
                v.clear()
            return rows

        at, lines, inside, kind, first = None, [], False, RECORD, False

        def close():
            if at is not None and lines:
                put(TAIL if inside and kind != HEAD else kind, at, first, lines)

        for batch in batches:
            files, splits, starts, values = (batch.column(k).to_pylist() for k in ("file", "split", "inside", "value"))
            for f, s, start, line in zip(files, splits, starts, values):
                if (f, s) != at:
                    close()
                    at, lines, inside = (f, s), [], start
                    kind, first = (HEAD if start else RECORD), s == 0
                elif not inside and lines:
                    put(kind, at, first, lines)
                    lines, kind, first = [], RECORD, False
                lines.append(line)
                if line.encode().count(q) % 2:
                    inside = not inside
                if len(out["kind"]) >= _BATCH:
                    yield full()
        close()
        if out["kind"]:
            yield full()

    return run


def csv_records(spark: SparkSession, path, quote: str = '"') -> DataFrame:
    """``file, split, first, text``: one row per record, its line breaks kept;
    ``first`` marks the first record of a file. Blank lines are no records."""
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(quote), F.lit("")))
    odd = lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = odd.select("file", "split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # one row per split, written: its size is known, so that Spark joins it without moving the lines where it is small
    starts = cut_lineage(starts, "csv-splits")

    # a split is read by one task in order; the sort keeps that order if the join moves its lines
    ordered = lines.withColumn("line", F.monotonically_increasing_id()).join(starts, ["file", "split"]).sortWithinPartitions(
        "file", "split", "line").select("file", "split", "inside", "value")
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("split", T.LongType()),
                           T.StructField("first", T.BooleanType()), T.StructField("text", T.StringType())])
    found = ordered.mapInArrow(_records(quote), schema)
    whole = found.where(F.col("kind") == RECORD)
    loose = found.where(F.col("kind") != RECORD)
    # a tail opens a record; the heads of the splits after it continue it up to the next tail
    order = Window.partitionBy("file").orderBy("split", "kind")
    opened = loose.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("split", "kind", "text")))
    joined = opened.groupBy("file", "record").agg(
        F.min("split").alias("split"), F.max("first").alias("first"), F.array_join(parts["text"], "\n").alias("text"))
    out = whole.select("file", "split", "first", "text").unionByName(joined.select("file", "split", "first", "text"))
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("substr(text, 1, char_length(text) - 1)")).otherwise(F.col("text"))
    return out.withColumn("text", text).where(F.col("text") != "")


def read_csv(spark: SparkSession, path, schema: T.StructType, header: bool = True, quote: str = '"', **options) -> DataFrame:
    """The rows of quoted CSV files (quotes inside fields doubled), in no
    particular order, as Spark's ``multiLine`` reader gives them, except that line ends inside
    fields stay as they are. ``options`` are those of
    Spark's CSV parser; a malformed record is an error unless ``mode`` says otherwise."""
    records = csv_records(spark, path, quote)
    if header:
        records = records.where(~F.col("first"))
    settings = {"mode": "FAILFAST", **options, "quote": quote, "escape": quote}
    parsed = F.from_csv("text", F.lit(_ddl(schema)), {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in settings.items()})
    return records.select(parsed.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
