"""End-to-end runs a user starts: the comparison run (vectors, match,
analytical and business reports, exports, exclusives summary) and the
benchmark run (benchmark table, export, SQL view, statistics).

Each step is a Spark job over the whole catalogs. The expensive results
(title vectors, the match, the result tables) are written once and every
later step reads the written table, so nothing is computed twice and a
lost executor does not send a later step back to the match. Intermediate tables are
deleted when a run ends; result tables are versions (``sources.versions``). Nothing is
collected; the caller gets DataFrames over the written tables. ``out_dir``
must be a folder every executor can reach on a cluster.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import parse_price
from vitrine.functions.encoder import encode_titles
from vitrine.operators.checks import validate_run
from vitrine.operators.incremental import RefreshedMatch, refresh_match
from vitrine.operators.match import WINNER_SCHEMA, best_match
from vitrine.operators.metrics import report_statistics
from vitrine.plans.reports import (
    analytical_report,
    benchmark_table,
    business_report,
    exclusives_summary,
    report_columns,
)
from vitrine.schema import DEFAULT_MATCH_THRESHOLD, Labels, Levels
from vitrine.session import cut_lineage, scratch_tables
from vitrine.sources.sinks import export_report, register_view
from vitrine.sources.versions import VersionedTables


@dataclass(frozen=True)
class ComparisonRun:
    analytical: DataFrame  # K1, read back from the result table
    business: DataFrame  # K2
    exclusives_count: DataFrame  # K7 / D3
    exclusives: DataFrame  # K7 / B10
    analytical_path: str  # the result table's folder (parquet) in this run's version
    exports: dict  # report name -> CSV folder


@dataclass(frozen=True)
class BenchmarkRun:
    benchmark: DataFrame  # K4, read back from the result table
    statistics: DataFrame  # D2
    view: str  # A8
    benchmark_path: str
    export_path: str  # A9: visible columns only


def _with_vectors(df: DataFrame, dim: int, encoder, name: str) -> DataFrame:
    """Keep a catalog's vectors, or compute them from the title (J1) and
    write them once: the match reads its inputs twice (sizing, products)."""
    if "embedding" in df.columns:
        return df
    return cut_lineage(encode_titles(df, "title", dim, encoder=encoder), name)


#: Columns that a catalog brings itself; vectors are computed where there are none.
CATALOG_COLUMNS = ("product_id", "title", "price", "url")


def _numeric_price(df: DataFrame) -> DataFrame:
    """Stored prices may be text (H3); numbers pass unchanged."""
    return df.withColumn("price", parse_price("price", "first_token")) if dict(df.dtypes)["price"] == "string" else df


def _clean(job):
    """A job whose intermediate tables are deleted when it is done: what it returns reads committed versions."""
    @functools.wraps(job)
    def run(source: DataFrame, *args, **options):
        with scratch_tables(source.sparkSession):
            return job(source, *args, **options)

    return run


def _save(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    """The result as the next version of its table; (rows, folder of that version)."""
    table = VersionedTables(df.sparkSession, path)
    number = table.commit(rows=df)
    return table.read("rows", number), table.location("rows", number)


@_clean
def compare_catalogs(source: DataFrame, target: DataFrame, out_dir: str,
                     threshold: float = DEFAULT_MATCH_THRESHOLD, labels: Labels = Labels(),
                     dim: int = 64, encoder=None) -> ComparisonRun:
    """The comparison run. Title vectors where a catalog has none (J1),
    the best match computed once (C1), the analytical report (K1) saved as
    the result table (A6), the business report (K2), both reports exported
    as CSV (A9; the analytical one by similarity, S1), and the exclusives
    summary (K7). Catalogs carry ``product_id, title, price, url`` and
    optionally ``embedding``. An empty result is a valid result: the
    tables are written with their columns and no rows."""
    validate_run(source, target, threshold, columns=CATALOG_COLUMNS)
    base = out_dir.rstrip("/")
    s = _with_vectors(_numeric_price(source), dim, encoder, "vectors-source")
    t = _with_vectors(_numeric_price(target), dim, encoder, "vectors-target")
    best = cut_lineage(best_match(s, t), "best-match")
    analytical, saved = _save(analytical_report(s, t, threshold, best=best, ordered=False), f"{base}/analytical")
    business = business_report(analytical, labels)
    exports = {
        "analytical": export_report(analytical.orderBy(F.desc("similarity"), "source_id"),
                                    f"{base}/analytical_csv", hidden=[]),
        "business": export_report(business.orderBy("source_id", "side"), f"{base}/business_csv", hidden=[]),
    }
    count, listing = exclusives_summary(business)
    return ComparisonRun(analytical, business, count, listing, saved, exports)


@_clean
def benchmark_catalogs(source: DataFrame, target: DataFrame, out_dir: str, labels: Labels = Labels(),
                       levels: Levels = Levels(), view: str = "benchmark_pairs", dim: int = 64,
                       encoder=None) -> BenchmarkRun:
    """The benchmark run. The benchmark table (K4) written once as the
    result table, then the report step: the visible columns exported (A9,
    B13), the SQL view registered over the written table (A8, so queries
    on it never re-run the match) and the statistics (D2)."""
    validate_run(source, target, DEFAULT_MATCH_THRESHOLD, levels, columns=CATALOG_COLUMNS)
    base = out_dir.rstrip("/")
    s = _with_vectors(source, dim, encoder, "vectors-source")
    t = _with_vectors(target, dim, encoder, "vectors-target")
    bench, saved = _save(benchmark_table(s, t, labels, levels, ordered=False), f"{base}/benchmark")
    return _report_benchmark(bench, saved, base, labels, view)


def _report_benchmark(bench: DataFrame, saved: str, base: str, labels: Labels, view: str) -> BenchmarkRun:
    visible, hidden = report_columns(bench.drop("pair_id", "product_id", "partner_price"))
    export = export_report(bench.select(*visible, *hidden), f"{base}/benchmark_csv", hidden=hidden)
    name = register_view(bench, view)
    return BenchmarkRun(bench, report_statistics(bench, labels), name, saved, export)


@_clean
def refresh_benchmark(source: DataFrame, target: DataFrame, out_dir: str, labels: Labels = Labels(), levels: Levels = Levels(),
                      view: str = "benchmark_pairs", dim: int = 64, encoder=None) -> tuple[BenchmarkRun, RefreshedMatch]:
    """The benchmark run of a day, from the match of the day before.

    ``<out_dir>/match`` holds, as one version, the winners and the vectors that they come
    from. The match is refreshed from the newest version (all of it is new in the first
    run), committed as the next, and the benchmark table built from it. A run that dies leaves
    the last version in place and the next one starts from that; two runs at once conflict."""
    validate_run(source, target, DEFAULT_MATCH_THRESHOLD, levels, columns=CATALOG_COLUMNS)
    base = out_dir.rstrip("/")
    s = _with_vectors(source, dim, encoder, "vectors-source")
    t = _with_vectors(target, dim, encoder, "vectors-target")
    kept = VersionedTables(source.sparkSession, f"{base}/match")
    last = max(kept.versions(), default=0)
    now = {"source": s.select("product_id", "embedding"), "target": t.select("product_id", "embedding")}
    before = {k: kept.read(k, last) if last else df.limit(0) for k, df in now.items()}
    winners = kept.read("winners", last) if last else source.sparkSession.createDataFrame([], WINNER_SCHEMA)
    match = refresh_match(winners, before["source"], now["source"], before["target"], now["target"])
    number = kept.commit(expected=last, winners=match.best, **now)
    best = kept.read("winners", number).drop("rank")
    bench, saved = _save(benchmark_table(s, t, labels, levels, best=best, ordered=False), f"{base}/benchmark")
    return _report_benchmark(bench, saved, base, labels, view), replace(match, best=kept.read("winners", number))
