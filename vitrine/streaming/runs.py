"""The trend over snapshots whose runs may be repeated.

``trend_stream`` counts what it reads: a run that failed halfway and was repeated, or whose
files were written again, counts twice. Here the state is kept per period, run and
part (titles are dealt into ``PARTS`` parts, so a large run is no single key): when rows of a later
attempt arrive, they replace what the part held of the earlier one. A part is
emitted once the watermark has passed its period, with its attempt; ``trend_of`` takes each run's
latest attempt, so a part in which the repeated run has no rows does not bring the old one back.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitrine.functions.labels import normalise_flag
from vitrine.schema import NO
from vitrine.streaming.crawl import write_changes

PARTS = 32


class RunParts(StatefulProcessor):
    """What one part of a run adds to its period, from the run's latest attempt."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "attempt timestamp, sum_diff double, n_diff long, paired long")

    def handleInputRows(self, key, rows, timerValues):
        held = self.held.get() if self.held.exists() else None
        if held is None:  # emitted when the watermark passes the end of the period
            self.handle.registerTimer(int(pd.Timestamp(key[3], tz="UTC").timestamp() * 1000))
        for frame in rows:
            for attempt, f in frame.groupby("attempt"):
                attempt = pd.Timestamp(attempt).to_pydatetime()
                if held is not None and attempt < held[0]:
                    continue  # of an attempt that was repeated
                if held is None or attempt > held[0]:
                    held = (attempt, 0.0, 0, 0)
                diff = f.loc[f["is_paired"], "diff_pct"].dropna()
                held = (attempt, held[1] + float(diff.sum()), held[2] + len(diff), held[3] + int(f["is_paired"].sum()))
        if held is not None:
            self.held.update(held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.held.exists():
            attempt, total, n, paired = self.held.get()
            self.held.clear()
            yield pd.DataFrame({"period_start": [key[0]], "run_id": [key[1]], "part": [key[2]], "attempt": [attempt],
                                "sum_diff": [total], "n_diff": [n], "paired": [paired]})

    def close(self) -> None:
        pass


def run_parts(history: DataFrame, period: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """The parts of all runs in a stream of benchmark rows with ``snapshot_ts``, ``run_id`` and
    ``attempt`` (one timestamp per try of a run, later for later tries). Rows later than
    ``lateness`` are dropped, as in any windowed stream; a part appears when its period is over."""
    rows = history.withWatermark("snapshot_ts", lateness).select(
        F.window("snapshot_ts", period).alias("w"), "snapshot_ts", "run_id", "attempt", "diff_pct",
        F.pmod(F.xxhash64("title"), F.lit(PARTS)).cast("int").alias("part"),
        F.coalesce(normalise_flag("exclusivity") == NO, F.lit(False)).alias("is_paired"))
    keyed = rows.select(F.col("w.start").alias("period_start"), F.coalesce("run_id", F.lit("")).alias("run_id"), "part",
                        F.col("w.end").alias("period_end"), "snapshot_ts", F.coalesce("attempt", F.timestamp_seconds(F.lit(0))).alias("attempt"),
                        "diff_pct", "is_paired")
    schema = T.StructType([T.StructField("period_start", T.TimestampType()), T.StructField("run_id", T.StringType()), T.StructField("part", T.IntegerType()),
                           T.StructField("attempt", T.TimestampType()), T.StructField("sum_diff", T.DoubleType()), T.StructField("n_diff", T.LongType()),
                           T.StructField("paired", T.LongType())])
    return keyed.groupBy("period_start", "run_id", "part", "period_end").transformWithStateInPandas(RunParts(), schema, "append", "eventtime")


def write_run_parts(parts: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Run the parts into a Parquet folder, state and progress in ``checkpoint``."""
    return write_changes(parts, path, checkpoint, available_now)


def trend_of(parts: DataFrame) -> DataFrame:
    """``period_start, avg_diff_pct, pairs`` from the parts of each run's latest attempt."""
    last = parts.groupBy("period_start", "run_id").agg(F.max("attempt").alias("attempt"))
    now = parts.join(last, ["period_start", "run_id", "attempt"])
    return now.groupBy("period_start").agg(
        F.try_divide(F.sum("sum_diff"), F.sum("n_diff")).alias("avg_diff_pct"), (F.sum("paired") / 2).alias("pairs"))
