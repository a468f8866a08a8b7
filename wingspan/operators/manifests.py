"""Versions of a stored structure, each a JSON manifest that names its files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from wingspan.session import file_listing


class ManifestLog:
    """``manifests/<version>.json`` under ``path`` (shared storage).

    A version exists once its manifest does: it is written under another name
    and renamed, and the rename fails if the version is there already.
    """

    def __init__(self, spark: SparkSession, path: str, empty: dict):
        self.spark, self.path, self._empty = spark, path.rstrip("/"), empty

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        names = [p.rsplit("/", 1)[-1] for p, *_ in file_listing(self.spark, f"{self.path}/manifests")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """The given version (the latest one by default); the empty version 0 where there is none."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, **json.loads(json.dumps(self._empty))}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{version:012d}.json", wholetext=True).first()[0])

    def _commit(self, state: dict, step: Callable[[str], None]) -> None:
        temp, final = (f"{self.path}/manifests/{n}" for n in (f"_new-{uuid.uuid4().hex}", f"{state['version']:012d}.json"))
        fs, p = self._fs(temp)
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        step("manifest written")
        target = self._fs(final)[1]
        if fs.exists(target) or not fs.rename(p, target):
            raise RuntimeError(f"version {state['version']} of {self.path} was committed by another writer")
        step("committed")
