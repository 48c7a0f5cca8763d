"""Command line: the comparison or benchmark run over two catalogs.

    spark-submit --py-files vitrine.zip vitrine/__main__.py compare SOURCE TARGET OUT_DIR [options]
    python -m vitrine benchmark SOURCE TARGET OUT_DIR [options]

SOURCE and TARGET are table names, or parquet folders (anything with a
``/``), holding ``product_id, title, price, url`` and optionally
``embedding``. The session comes from ``spark-submit`` (cluster settings,
``spark.checkpoint.dir``); OUT_DIR must be reachable by every executor.
Prints one JSON line with the output locations.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from vitrine.plans.jobs import benchmark_catalogs, compare_catalogs
from vitrine.schema import DEFAULT_MATCH_THRESHOLD, DEFAULT_MODERATE, DEFAULT_VERY_SIMILAR, Labels, Levels


def _catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vitrine", description="Catalog comparison and price benchmark runs.")
    p.add_argument("run", choices=["compare", "benchmark"])
    p.add_argument("source", help="competitor catalog: table name or parquet folder")
    p.add_argument("target", help="own catalog: table name or parquet folder")
    p.add_argument("out_dir", help="output folder (shared storage on a cluster)")
    p.add_argument("--threshold", type=float, default=DEFAULT_MATCH_THRESHOLD, help="match threshold (compare)")
    p.add_argument("--very", type=float, default=DEFAULT_VERY_SIMILAR, help="'very similar' cut (benchmark)")
    p.add_argument("--moderate", type=float, default=DEFAULT_MODERATE, help="'moderately similar' cut (benchmark)")
    p.add_argument("--source-label", default=Labels().source)
    p.add_argument("--target-label", default=Labels().target)
    p.add_argument("--source-url", default=Labels().source_base_url, help="base of relative source links")
    p.add_argument("--target-url", default=Labels().target_base_url, help="base of relative target links")
    p.add_argument("--dim", type=int, default=64, help="vector size when titles must be encoded")
    p.add_argument("--view", default="benchmark_pairs", help="SQL view name (benchmark)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"vitrine-{args.run}").getOrCreate()
    labels = Labels(args.source_label, args.target_label, args.source_url, args.target_url)
    source, target = _catalog(spark, args.source), _catalog(spark, args.target)
    if args.run == "compare":
        run = compare_catalogs(source, target, args.out_dir, args.threshold, labels, dim=args.dim)
        out = {"run": "compare", "analytical": run.analytical_path, **{f"{k}_csv": v for k, v in run.exports.items()}}
    else:
        levels = Levels(very=args.very, moderate=args.moderate)
        run = benchmark_catalogs(source, target, args.out_dir, labels, levels, view=args.view, dim=args.dim)
        out = {"run": "benchmark", "benchmark": run.benchmark_path, "csv": run.export_path, "view": run.view}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
