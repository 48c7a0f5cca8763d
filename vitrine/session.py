"""Session helpers: a local session for tests/bench and a reliable checkpoint."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that ``cut_lineage`` wrote inside the innermost ``scratch_tables`` block.
_scratch: contextvars.ContextVar[list | None] = contextvars.ContextVar("scratch", default=None)


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "vitrine") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VITRINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="vitrine-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; a cluster session without it is an error (a machine-local folder
    would not survive an executor loss). Only a ``local[...]`` session with
    no setting (tests) gets a scratch folder."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    scratch = tempfile.mkdtemp(prefix="vitrine-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(scratch)
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def task_slots(spark: SparkSession) -> int:
    """Number of tasks the cluster runs at once (default parallelism)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", spark.conf.get("spark.sql.shuffle.partitions", "200")))


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from it: one job computes it exactly once (an eager RDD
    checkpoint would compute it a second time to write it), later stages and
    retries after an executor loss read the files instead of recomputing
    the lineage, and AQE sees the real size. Never a local checkpoint."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (open_block := _scratch.get()) is not None:
        open_block.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def scratch_tables(spark: SparkSession):
    """Deletes, when the block ends (also by an error), every table that
    ``cut_lineage`` wrote inside it. For whole runs: what leaves the block must not read them."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
