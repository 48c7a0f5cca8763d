"""Incremental form of the trend table.

The reference keeps no history; its dashboard plots the trend "if history
exists". Each benchmark run can append a snapshot (``append_snapshot``), and
``trend_stream`` maintains the per-period mean gap and pair count over the
growing history with a watermark, so late snapshots still land in their
period while old state is dropped. ``write_trend`` runs it into a parquet
folder with its progress in the shared checkpoint folder.

``streaming.runs`` is the trend over a history whose runs may be repeated, and
``streaming.crawl`` the crawl cut over pages in any order of arrival; both keep their own state.
"""

from vitrine.streaming.trend import append_snapshot, trend_stream, write_trend

__all__ = ["append_snapshot", "trend_stream", "write_trend"]
