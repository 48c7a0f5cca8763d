"""Versioned result tables with an atomic commit.

``overwrite`` deletes a table before its successor is complete: a run that dies
in between leaves nothing. Here a run writes new folders next to the old ones and
then publishes them all with one small file:

    <path>/data/<uuid>/<table>/part-...     the tables of one version
    <path>/versions/<number>.json           its manifest: folder and schemas

A version exists once its manifest does. The manifest is written under another name
and renamed, which a file system such as HDFS does at once and refuses if the number was taken in the
meantime, so readers see the old version or the new one, never a mixture, and of
two writers one fails. A reader pins a version by its number. Old versions
are removed by ``expire``, together with folders that no manifest names (runs that died),
once these are older than a grace period.

Spark writes and reads the data; only the manifests go through the Hadoop file
system interface, on whatever storage ``path`` is on.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionConflict(RuntimeError):
    """Another run committed first."""


class VersionedTables:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    # --- reading ---------------------------------------------------------------

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        folder = self._path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise LookupError(f"{self.path}: no version {version if version is not None else 'committed'}")
        stream = self._fs.open(self._path(self._manifest(known[-1] if version is None else version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def location(self, name: str, version: int | None = None) -> str:
        """The Parquet folder of a table in a version (the newest one by default)."""
        m = self.manifest(version)
        if name not in m["tables"]:
            raise LookupError(f"{self.path}: version {m['version']} has no table {name}")
        return f"{self.path}/data/{m['data']}/{name}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of a version. The DataFrame stays with that version, whatever is committed later."""
        m = self.manifest(version)
        if name not in m["tables"]:
            raise LookupError(f"{self.path}: version {m['version']} has no table {name}")
        schema = T.StructType.fromJson(m["tables"][name])
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{m['data']}/{name}")

    # --- writing ----------------------------------------------------------------

    def commit(self, expected: int | None = None, **tables: DataFrame) -> int:
        """Write all tables, then publish them as the next version; returns
        its number. Schemas may differ from the version before. Tables not given
        are not in the new version. With ``expected`` (the version that the run started from)
        a version committed since is a conflict; otherwise the last commit wins."""
        data = uuid.uuid4().hex
        for name, df in tables.items():
            df.write.parquet(f"{self.path}/data/{data}/{name}")
        known = self.versions()
        if expected is not None and expected != (known[-1] if known else 0):
            raise VersionConflict(f"{self.path}: version {known[-1] if known else 0} was committed since {expected}")
        number = (known[-1] if known else 0) + 1
        body = {"version": number, "data": data, "tables": {n: json.loads(d.schema.json()) for n, d in tables.items()}}
        self._publish(number, json.dumps(body))
        return number

    def _manifest(self, version: int) -> str:
        return f"{self.path}/versions/{version:020d}.json"

    def _publish(self, number: int, text: str) -> None:
        jvm = self.spark._jvm
        draft, final = self._path(f"{self.path}/versions/.draft-{uuid.uuid4().hex}"), self._path(self._manifest(number))
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # never over an existing file
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, final, options)
        except Exception as e:
            if self._fs.exists(final):
                raise VersionConflict(f"{self.path}: version {number} was committed by another run") from e
            raise

    # --- retention ----------------------------------------------------------------

    def expire(self, keep: int = 5, grace_seconds: float = 86_400) -> list[int]:
        """Remove all but the newest ``keep`` versions, and data folders
        that no remaining manifest names. What changed less than ``grace_seconds`` ago stays: a
        reader may still hold the version, a writer may be about to commit the folder."""
        if keep < 1:
            raise ValueError("keep at least one version")
        until = (time.time() - grace_seconds) * 1000
        gone, known = [], self.versions()
        for number in known[:-keep]:
            file = self._path(self._manifest(number))
            # a version ends when its successor is committed
            if self._fs.getFileStatus(self._path(self._manifest(known[known.index(number) + 1]))).getModificationTime() <= until:
                self._fs.delete(file, False)
                gone.append(number)
        named = {self.manifest(n)["data"] for n in self.versions()}
        folder = self._path(f"{self.path}/data")
        for status in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            if status.getPath().getName() not in named and self._newest(status) <= until:
                self._fs.delete(status.getPath(), True)
        return gone

    def _newest(self, status) -> int:
        inside = [s.getModificationTime() for s in self._fs.listStatus(status.getPath())]
        return max([status.getModificationTime(), *inside])
