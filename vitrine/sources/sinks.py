"""Sinks and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.schema import BENCHMARK, BENCHMARK_HIDDEN, BENCHMARK_VISIBLE
from vitrine.sources.csv_records import read_csv

VISIBLE_REPORT = T.StructType([f for f in BENCHMARK.fields if f.name in BENCHMARK_VISIBLE])


def save_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Full overwrite of a table, schema replaced."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def save_by_category(df: DataFrame, path: str, category_col: str = "category", fmt: str = "parquet") -> None:
    """One partition per category; only the categories present in this
    write are replaced (an empty category keeps its previous data)."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(category_col)
        .save(path)
    )


def register_view(df: DataFrame, name: str) -> str:
    """Expose a result to SQL; returns the view name."""
    df.createOrReplaceTempView(name)
    return name


#: CSV dialect of exported reports.
CSV_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV = {"quote": '"', "escape": '"', **CSV_BLANKS}


def export_report(df: DataFrame, path: str, hidden=None, fmt: str = "csv") -> str:
    """A9 (+B13): write the visible columns only (hidden defaults to
    similarity, level and diff); returns the path."""
    hidden = BENCHMARK_HIDDEN if hidden is None else hidden
    visible = [c for c in df.columns if c not in set(hidden)]
    w = df.select(*visible).write.mode("overwrite")
    if fmt == "csv":
        # quotes are doubled and blanks kept, as spreadsheet readers expect
        w.option("header", True).options(**CSV).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_report(spark: SparkSession, path: str, schema: T.StructType = VISIBLE_REPORT,
                fmt: str = "csv") -> DataFrame:
    """A10 (+B14): read an exported report back with typed columns (the
    exported, visible ones by default), rows whose every field is empty
    dropped."""
    if fmt == "csv":
        # a title may hold line breaks: records are cut by counting quotes, so large files are read by many tasks
        df = read_csv(spark, path, schema, **CSV_BLANKS)
    else:
        df = spark.read.format(fmt).load(path)
    return drop_empty_rows(df)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose every field is null or an empty string."""
    vals = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in df.columns]
    return df.where(F.coalesce(*vals).isNotNull()) if vals else df
