"""A folder of numbered versions: each attempt writes files of its own, one small pointer file makes them current.

An attempt that dies leaves files that no pointer names. Two attempts that start from the same version can't disturb each
other: their folders are distinct, and only one of them can put the next pointer into place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Versions:
    """Pointer files ``_commits/<number>.json`` under ``path`` on any file system Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    def _names(self) -> list[str]:
        root = self._path(f"{self.path}/_commits")
        if not self._fs.exists(root):
            return []
        return sorted(n for f in self._fs.listStatus(root) if (n := f.getPath().getName()).endswith(".json"))

    def head(self) -> dict | None:
        """The manifest of the greatest committed version; None before the first."""
        names = self._names()
        if not names:
            return None
        stream = self._fs.open(self._path(f"{self.path}/_commits/{names[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def attempt(self) -> str:
        """Name of a folder that no other attempt uses, relative to ``path``."""
        return f"attempt-{uuid.uuid4().hex}"

    def commit(self, version: int, manifest: dict) -> None:
        """Make ``manifest`` version ``version``; fails if another attempt has committed that version."""
        work, final = self._path(f"{self.path}/_commits/{uuid.uuid4().hex}.tmp"), self._path(f"{self.path}/_commits/{version:012d}.json")
        stream = self._fs.create(work, False)
        stream.write(bytearray(json.dumps({**manifest, "version": version}).encode()))
        stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(work, final, none)  # never replaces a file that is there
        except Exception as e:
            self._fs.delete(work, False)
            if self._fs.exists(final):
                raise RuntimeError(f"version {version} was committed by another run") from e
            raise

    def delete_unused(self, keep: set[str]) -> int:
        """Delete attempt folders that ``keep`` doesn't name; only safe while no other attempt is running."""
        n = 0
        for f in self._fs.listStatus(self._path(self.path)):
            name = f.getPath().getName()
            if name.startswith("attempt-") and name not in keep:
                n += bool(self._fs.delete(f.getPath(), True))
        return n
