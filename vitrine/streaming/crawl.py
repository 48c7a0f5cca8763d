"""The crawl cut over pages that arrive one by one.

A category ends before its first page without cards or that failed to load. In a batch
that page is an aggregate; on a stream it may arrive after later pages were already passed on.
Per category the state holds the cut so far and the pages passed on; the output is a
change log: ``change`` is +1 for a page that counts and -1 for one that a new cut takes
back. Added up, the log is the batch result for any order of arrival. A cut only ever
moves to lower pages, so a page behind it needs no state.
"""

from __future__ import annotations

import contextlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PAGE = ["category", "page", "page_id", "n_cards"]
CHANGES = "category string, page int, page_id long, n_cards int, change int"
#: Map state, which grows page by page, lives in this store; a batch writes its changes, not the whole state anew, and
#: small stores take no disk space in advance.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


class CrawlCut(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cut = handle.getValueState("cut", "page int")
        # pages passed on, and how often each
        self.passed = handle.getMapState("passed", "page int, page_id long, n_cards int", "n int")

    def handleInputRows(self, key, rows, timerValues):
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        new = pd.concat(frames, ignore_index=True)
        old = self.cut.get()[0] if self.cut.exists() else None
        stops = new.loc[(new["n_cards"].fillna(0) == 0) | new["failed"].fillna(False).astype(bool), "page"].dropna()
        cut = min([int(p) for p in stops] + ([old] if old is not None else []), default=None)
        out = []
        if cut is not None and cut != old:
            self.cut.update((cut,))
            gone = [(k, v) for k, v in self.passed.iterator() if k[0] >= cut]
            for k, (n,) in gone:
                self.passed.removeKey(k)
                out += [(key[0], *k, -1)] * n
        for r in new.itertuples(index=False):
            page = None if pd.isna(r.page) else int(r.page)
            page_id, cards = int(r.page_id), None if pd.isna(r.n_cards) else int(r.n_cards)
            if page is None:  # a page without a number has no place in the order and stays
                out.append((key[0], None, page_id, cards, 1))
            elif cut is None or page < cut:
                k = (page, page_id, cards)
                n = self.passed.getValue(k)[0] if self.passed.containsKey(k) else 0
                self.passed.updateValue(k, (n + 1,))
                out.append((key[0], *k, 1))
        if out:
            frame = pd.DataFrame(out, columns=[*PAGE, "change"])
            yield frame.astype({"page": "Int32", "n_cards": "Int32"})

    def close(self) -> None:
        pass


def crawl_changes(pages: DataFrame) -> DataFrame:
    """The change log of a stream of ``category, page, page_id, n_cards, failed``.
    Pages without a category are a category of their own; ``page_id`` is not null."""
    rows = pages.select("category", F.col("page").cast("int"), F.col("page_id").cast("long"), F.col("n_cards").cast("int"), "failed")
    return rows.groupBy("category").transformWithStateInPandas(CrawlCut(), CHANGES, "append", "none")


@contextlib.contextmanager
def _rocksdb(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_changes(changes: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Run the change log into a Parquet folder; state and progress live in
    ``checkpoint``, a shared folder. Returns the ``StreamingQuery``."""
    with _rocksdb(changes.sparkSession):
        w = changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start(path)


def pages_of(changes: DataFrame) -> DataFrame:
    """The pages that count, after all changes so far."""
    net = changes.groupBy(*PAGE).agg(F.sum("change").cast("int").alias("n")).where("n > 0")
    return net.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n")))).select(*PAGE)
