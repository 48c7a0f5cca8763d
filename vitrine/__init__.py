"""vitrine — catalog matching and price benchmarking as Spark DataFrame jobs.

Two product catalogs go in (a competitor listing and an own feed); out come
best-match pairs, exclusive products, price gaps, a de-duplicated benchmark
table and the KPI / distribution tables a pricing dashboard reads.

Layout
------
- ``vitrine.functions``  Column -> Column scalars (prices, urls, diffs, labels,
  cosine, html text, the default title encoder).
- ``vitrine.sources``    readers and writers: catalog tables, stored pages,
  sinks and views.
- ``vitrine.operators``  match (exact top-1 cosine join), dedupe, filters,
  metrics.
- ``vitrine.plans``      composite jobs (reports, benchmark table, KPI row) and
  the end-to-end runs (``plans.jobs``; ``python -m vitrine`` on the command line).
- ``vitrine.streaming``  incremental snapshot history for the trend table.
"""

from vitrine.schema import Labels, Levels  # noqa: F401

__all__ = ["Labels", "Levels"]
