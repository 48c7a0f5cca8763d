"""D17 as a stream over an appended snapshot history."""

import datetime as dt

from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir
from vitrine.streaming import append_snapshot, trend_stream, write_trend

BENCH = ("title string, marketplace string, price double, url string, exclusivity string, similarity double, "
         "similarity_level string, diff_pct double")


def test_trend_stream_over_snapshots(spark):
    root = ensure_checkpoint_dir(spark) + "/history-test"
    rows = [("a", "A", 10.0, "u", "não", 0.9, "muito similar", 10.0),
            ("b", "B", 11.0, "u", "não", 0.9, "muito similar", 10.0),
            ("c", "B", 5.0, "u", "sim", -1.0, "exclusivo", None)]
    bench = spark.createDataFrame(rows, BENCH)
    append_snapshot(bench, root + "/h", dt.datetime(2024, 1, 1, 8))
    append_snapshot(bench.withColumn("diff_pct", F.col("diff_pct") * 2), root + "/h", dt.datetime(2024, 1, 2, 8))
    append_snapshot(bench, root + "/h", dt.datetime(2024, 1, 9, 8))  # moves the watermark past day 2
    schema = spark.read.parquet(root + "/h").drop("snapshot_day").schema
    q = (trend_stream(spark, root + "/h", schema).writeStream.format("memory").queryName("trend_test")
         .outputMode("append").option("checkpointLocation", root + "/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted((r.period_start.date().isoformat(), r.avg_diff_pct, r.pairs)
                 for r in spark.sql("SELECT * FROM trend_test").collect())
    assert got[:2] == [("2024-01-01", 10.0, 1.0), ("2024-01-02", 20.0, 1.0)]


def test_trend_to_parquet_resumes_from_its_checkpoint(spark):
    """Two scheduled runs over a growing history: the second resumes from
    the checkpoint and appends only the periods the new watermark closes."""
    root = ensure_checkpoint_dir(spark) + "/history-parquet"
    rows = [("a", "A", 10.0, "u", "não", 0.9, "muito similar", 10.0),
            ("b", "B", 11.0, "u", "não", 0.9, "muito similar", 10.0)]
    bench = spark.createDataFrame(rows, BENCH)
    append_snapshot(bench, root + "/h", dt.datetime(2024, 1, 1, 8))
    append_snapshot(bench, root + "/h", dt.datetime(2024, 1, 5, 8))  # closes day 1
    schema = spark.read.parquet(root + "/h").drop("snapshot_day").schema
    out = root + "/trend"
    write_trend(trend_stream(spark, root + "/h", schema), out).awaitTermination(120)
    first = sorted(r.period_start.date().isoformat() for r in spark.read.parquet(out).collect())
    append_snapshot(bench.withColumn("diff_pct", F.col("diff_pct") * 3), root + "/h", dt.datetime(2024, 1, 9, 8))
    write_trend(trend_stream(spark, root + "/h", schema), out).awaitTermination(120)
    got = sorted((r.period_start.date().isoformat(), r.avg_diff_pct, r.pairs) for r in spark.read.parquet(out).collect())
    assert first == ["2024-01-01"]
    assert got == [("2024-01-01", 10.0, 1.0), ("2024-01-05", 10.0, 1.0)]  # each period once


def test_a_repeated_run_replaces_its_snapshot(spark):
    import pytest

    path = ensure_checkpoint_dir(spark) + "/history-runs"
    bench = spark.createDataFrame([("a", "A", 10.0, "u", "não", 0.9, "muito similar", 10.0)], BENCH)
    day = dt.datetime(2024, 1, 1, 8)
    for run in ("r1", "r1", "r2"):
        append_snapshot(bench, path, day, run_id=run)
    assert sorted(r.run_id for r in spark.read.parquet(path).collect()) == ["r1", "r2"]
    with pytest.raises(ValueError):
        append_snapshot(bench, path, run_id="r3")
