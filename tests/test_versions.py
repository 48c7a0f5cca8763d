"""Versioned result tables: commits are all or nothing."""

import pytest
from pyspark.sql import functions as F

from vitrine.sources.versions import VersionConflict, VersionedTables


def ids(df):
    return sorted(r[0] for r in df.collect())


def broken(spark):
    """Rows whose second task fails after the first has written its file."""
    return spark.range(0, 20, 1, 2).select(F.when(F.col("id") < 15, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))


def test_a_run_that_dies_leaves_the_old_version(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"))
    assert t.versions() == []
    with pytest.raises(LookupError):
        t.read("rows")
    assert t.commit(rows=spark.range(5), more=spark.range(2)) == 1
    pinned = t.read("rows")
    with pytest.raises(Exception, match="killed"):
        t.commit(rows=spark.range(9), more=broken(spark))  # the first table is complete, the second is not
    assert t.versions() == [1] and ids(t.read("rows")) == ids(pinned) == list(range(5)) and ids(t.read("more")) == [0, 1]
    assert t.commit(rows=spark.range(3).select(F.col("id").cast("string").alias("name"))) == 2
    assert t.read("rows").dtypes == [("name", "string")] and ids(t.read("rows")) == ["0", "1", "2"]
    assert ids(pinned) == ids(t.read("rows", 1)) == list(range(5))  # a reader stays with its version
    with pytest.raises(LookupError):
        t.read("more")


def test_empty_tables_keep_their_schema(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"))
    t.commit(rows=spark.createDataFrame([], "a long, b array<double>"))
    assert t.read("rows").dtypes == [("a", "bigint"), ("b", "array<double>")] and t.read("rows").count() == 0


def test_two_writers_conflict(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"))
    first = t.commit(rows=spark.range(1))
    t.commit(expected=first, rows=spark.range(2))
    with pytest.raises(VersionConflict):
        t.commit(expected=first, rows=spark.range(3))
    with pytest.raises(VersionConflict):
        t._publish(2, "{}")  # the number is taken: nothing is overwritten
    assert t.versions() == [1, 2] and t.read("rows").count() == 2


def test_retention(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"))
    for n in range(1, 5):
        t.commit(rows=spark.range(n))
    with pytest.raises(Exception, match="killed"):
        t.commit(rows=broken(spark))
    folders = lambda: len(list((tmp_path / "t" / "data").iterdir()))
    assert t.expire(keep=2) == [] and t.versions() == [1, 2, 3, 4] and folders() == 5  # within the grace period
    assert t.expire(keep=2, grace_seconds=-1) == [1, 2] and t.versions() == [3, 4] and folders() == 2
    assert t.read("rows").count() == 4 and t.read("rows", 3).count() == 3
    assert t.commit(rows=spark.range(7)) == 5
    with pytest.raises(ValueError):
        t.expire(keep=0)
