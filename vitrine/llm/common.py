"""Helpers shared by the corpus operators: text expressions, Arrow text buffers, scratch tables."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are runs of anything but these ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(col="text") -> Column:
    """The text as a string; null counts as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def lower_ascii(col) -> Column:
    """A-Z to a-z and nothing else. A text of one byte a character has no
    other letters, so the much faster ``lower`` serves there."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower())
    )


def n_words(col) -> Column:
    """Number of words, without building them: drop all but the first
    character of each word and count what is left."""
    return F.regexp_count(col, F.lit(WORD)).cast("long")


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the session's shared checkpoint folder,
    read back: it is computed once, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=list(partition_by) or None, compression="zstd")
    # the schema is given: an empty table may have no file to infer it from
    return spark.read.schema(df.schema).parquet(path)


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column as one uint8 array and the (n + 1)
    offsets of its rows, without a Python object per row. Null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset: arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def row_groups(offsets: np.ndarray, limit: int = 1 << 20):
    """Row ranges of at most ``limit`` bytes (or one longer row), so that a
    kernel's scratch arrays are bounded whatever the Arrow batch holds."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop
