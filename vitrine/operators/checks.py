"""Run-parameter validation (B18): fail before any plan is built."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine.schema import Levels

MATCH_COLUMNS = ("product_id", "title", "price", "url", "embedding")


def validate_run(source: DataFrame, target: DataFrame, threshold: float, levels: Levels = Levels(),
                 columns=MATCH_COLUMNS) -> None:
    """Raise ``ValueError`` when a catalog lacks a required column, the
    threshold is not a cosine value, or the level cuts are out of order.
    Only schemas are inspected; no data is read."""
    for name, df in (("source", source), ("target", target)):
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{name} catalog lacks columns {missing}")
        vec = dict(df.dtypes).get("embedding", "array<" if "embedding" not in columns else "")
        if not vec.startswith("array<"):
            raise ValueError(f"{name} embedding must be an array column, got {vec!r}")
    if not -1.0 <= threshold <= 1.0:
        raise ValueError(f"threshold {threshold} outside [-1, 1]")
    if not -1.0 <= levels.moderate <= levels.very <= 1.0:
        raise ValueError(f"level cuts must satisfy -1 <= moderate <= very <= 1, got {levels}")
