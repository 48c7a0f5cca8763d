"""Task retries: a match task that fails on its first attempt is re-run from
its shuffle input (possibly in another row order) and the result is the
same. Runs in its own JVM, because only ``local[n, retries]`` retries tasks."""

import subprocess
import sys
import textwrap
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    import vitrine.operators.match as M
    from vitrine.sources.tables import products, split_catalogs
    from vitrine.schema import Labels

    lab = Labels("A", "B")
    s, t = split_catalogs(products(spark, "/root/testdata/sf0.001", lab), lab)
    clean = sorted(M.best_match(s, t, source_blocks=3, target_blocks=2).collect())

    def flaky(sdf, tdf):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            open({marks!r} + "/failed-" + str(ctx.partitionId()), "w").close()
            raise RuntimeError("injected task failure")
        return M.block_winners(sdf, tdf)

    winners = M._match_blocks(M.usable_vectors(s, "product_id", "embedding", "source_id"),
                              M.usable_vectors(t, "product_id", "embedding", "target_id")
                               .groupBy("vec").agg({{"target_id": "min"}}).withColumnRenamed("min(target_id)", "target_id"),
                              3, 2, flaky)
    from pyspark.sql import functions as F
    rank = F.struct(F.round("similarity", M.TIE_DECIMALS), -F.col("target_id"))
    retried = sorted(winners.groupBy("source_id").agg(F.max_by(F.struct("target_id", "similarity"), rank).alias("m"))
                     .select("source_id", "m.target_id", "m.similarity").collect())
    import os
    print("SAME" if clean == retried and len(clean) > 0 else "DIFF", len(clean), "FAILED", len(os.listdir({marks!r})))
""")


def test_match_survives_task_retries(tmp_path):
    script = tmp_path / "retry.py"
    marks = tmp_path / "marks"
    marks.mkdir()
    script.write_text(SCRIPT.format(repo=str(REPO), marks=str(marks)))
    out = subprocess.run([sys.executable, str(script)], cwd=REPO, capture_output=True, text=True, timeout=600)
    assert "SAME" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
    assert len(list(marks.iterdir())) >= 2  # tasks really failed once and were re-run
