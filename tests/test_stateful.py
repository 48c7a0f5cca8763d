"""Stateful streams: any order of arrival, and repeated runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir
from vitrine.sources.pages import crawl_cut
from vitrine.streaming import crawl, runs

STATS = "page_id long, category string, page int, n_cards int, failed boolean"


def stream(spark, batches, schema, root, per_trigger=1):
    """Each batch is one file, read in the order written."""
    import os

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        for f in os.scandir(f"{root}/in".removeprefix("file:")):
            if f.name.endswith(".parquet") and f.stat().st_mtime > 1_600_000_000:
                os.utime(f.path, (1_500_000_000 + i, 1_500_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{root}/in")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_batch_cut(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(1000 * c + p, f"k{c}", p, 0 if p in (7 + 3 * c, 15) else 4, p == 20 - 6 * c) for c in range(3) for p in range(1, 22)]
    rows += [(1, None, 1, 2, False), (2, None, 2, 0, False), (3, None, 3, 5, False), (9, "k0", None, 3, False), (1003, "k1", 3, 4, False)]
    rng.shuffle(rows)
    batches = [rows[i: i + 9] for i in range(0, len(rows), 9)]
    changes = crawl.crawl_changes(stream(spark, batches, STATS, str(tmp_path)))
    out, ckpt = str(tmp_path / "out"), f"{ensure_checkpoint_dir(spark)}/crawl-{seed}-{rng.random()}"
    crawl.write_changes(changes, out, ckpt).awaitTermination(300)
    log = spark.read.parquet(out)
    want = crawl_cut(spark.createDataFrame(rows, STATS), failed_col="failed").select(*crawl.PAGE)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(crawl.pages_of(log)) == key(want) and log.where("change < 0").count() > 0
    # a second run resumes: a lower stop takes back what the first had passed on
    more = [(5000, "k0", 3, 0, False), (5001, "k0", 2, 6, False)]
    changes = crawl.crawl_changes(stream(spark, [*[[] for _ in batches], more], STATS, str(tmp_path)))
    crawl.write_changes(changes, out, ckpt).awaitTermination(300)
    want = crawl_cut(spark.createDataFrame(rows + more, STATS), failed_col="failed").select(*crawl.PAGE)
    assert key(crawl.pages_of(spark.read.parquet(out))) == key(want)


BENCH = "title string, exclusivity string, diff_pct double, snapshot_ts timestamp, run_id string, attempt timestamp"


def test_a_repeated_run_replaces_its_part_of_the_day(spark, tmp_path):
    day, hour = dt.datetime(2024, 1, 1, 8), dt.timedelta(hours=1)

    def run(name, attempt, diffs, ts=day):
        return [(f"t{i}", "não", d, ts, name, ts + attempt * hour) for i, d in enumerate(diffs) for _ in (0, 1)] + [
            ("x", "sim", None, ts, name, ts + attempt * hour)]

    late = run("end", 1, [1.0], day + dt.timedelta(days=9))
    batches = [run("r1", 1, [10.0, 20.0, 30.0, None]), run("r2", 1, [4.0]), run("r1", 2, [50.0, 70.0]), run("r1", 1, [10.0]), run("r3", 1, [6.0], day + dt.timedelta(days=1)),
               run("r1", 2, []), late]
    parts = runs.run_parts(stream(spark, batches, BENCH, str(tmp_path)))
    out, ckpt = str(tmp_path / "out"), f"{ensure_checkpoint_dir(spark)}/runs-{random.random()}"
    runs.write_run_parts(parts, out, ckpt).awaitTermination(300)
    got = {r.period_start.day: (round(r.avg_diff_pct, 9), r.pairs) for r in runs.trend_of(spark.read.parquet(out)).collect()}
    assert got == {1: (round((50 + 70 + 4) / 3, 9), 3.0), 2: (6.0, 1.0)}
    assert spark.read.parquet(out).where(F.col("run_id") == "r1").select("attempt").distinct().count() >= 1
