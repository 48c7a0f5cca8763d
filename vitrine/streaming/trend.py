"""Snapshot history sink and the streaming trend aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.labels import normalise_flag
from vitrine.schema import NO


def append_snapshot(bench: DataFrame, path: str, snapshot_ts=None, run_id: str | None = None) -> None:
    """Append one benchmark table to the history folder, stamped with the
    run time (or ``snapshot_ts``) and partitioned by day.

    With ``run_id`` (and the run's ``snapshot_ts``) the day holds a folder
    per run, and a run that is repeated replaces its own rows instead of
    counting twice; use it for all runs of a history or for none. A stream
    that has read the first try reads the second too: start it after the run."""
    if run_id is not None:
        if snapshot_ts is None:
            raise ValueError("a run id needs the run's snapshot_ts: a repeat must fall on the same day")
        out = bench.withColumn("snapshot_ts", F.lit(snapshot_ts).cast("timestamp")).withColumns(
            {"snapshot_day": F.to_date("snapshot_ts"), "run_id": F.lit(run_id)})
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("snapshot_day", "run_id").parquet(path))
        return
    ts = F.current_timestamp() if snapshot_ts is None else F.lit(snapshot_ts).cast("timestamp")
    out = bench.withColumn("snapshot_ts", ts).withColumn("snapshot_day", F.to_date("snapshot_ts"))
    out.write.mode("append").partitionBy("snapshot_day").parquet(path)


def trend_stream(spark: SparkSession, path: str, schema: T.StructType, period: str = "1 day",
                 lateness: str = "2 days") -> DataFrame:
    """Streaming D17 over the history folder: per period, the mean diff of
    paired rows and the number of pairs (paired rows / 2). Append mode emits
    a period once the watermark passes it."""
    hist = spark.readStream.schema(schema).parquet(path)
    paired = normalise_flag("exclusivity") == NO
    return (
        hist.withWatermark("snapshot_ts", lateness)
        .groupBy(F.window("snapshot_ts", period).alias("period"))
        .agg(
            F.avg(F.when(paired, F.col("diff_pct"))).alias("avg_diff_pct"),
            (F.count_if(F.coalesce(paired, F.lit(False))) / 2).alias("pairs"),
        )
        .select(F.col("period.start").alias("period_start"), "avg_diff_pct", "pairs")
    )


def write_trend(trend: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True):
    """Run the streaming trend into a parquet folder. Progress (offsets and
    aggregation state) lives in ``checkpoint`` -- by default under the
    session's shared checkpoint folder, never on a machine-local disk -- so
    a restarted query resumes where it stopped and appends each period once.
    ``available_now`` processes what has arrived and stops (scheduled runs);
    otherwise the query keeps running. Returns the ``StreamingQuery``."""
    import hashlib

    from vitrine.session import ensure_checkpoint_dir

    spark = trend.sparkSession
    # the same output folder always maps to the same checkpoint (stable digest)
    key = hashlib.sha1(path.encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/trend-{key}"
    w = trend.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(path)
