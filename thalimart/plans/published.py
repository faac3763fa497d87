"""Atomic refresh: versions of the warehouse and a published manifest.

A build never touches the tables that readers use. It writes a whole new version
under ``<base>/versions/<id>``, checks it, and then publishes it: a manifest that
names the version's folder is written under another name and renamed to
``<base>/manifest/<number>.json``. The rename is the only moment of change, so

* a build that stops anywhere before it leaves the published version as it was;
* a reader opens the manifest with the largest number and sees one version, all
  tables of it from the same build;
* frames opened before a refresh go on reading their own version until it is
  removed: ``keep`` versions before the newest stay.

A version is published only if its fact keys are unique and have their dimension
rows (``check``). Two refreshes at once do not overwrite each other: the rename
fails for the second, which then takes the next number; the last one wins.
Leftovers of stopped builds are removed by the next successful one, unless they
are younger than ``STALE_HOURS`` (they may be under way).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.staging import Staging
from . import quality
from .warehouse import Warehouse, build_warehouse, open_warehouse, remove

STALE_HOURS = 24


class _Files:
    """The few file operations a manifest needs, on any file system of Spark's."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> dict[str, int]:
        """Name -> time of change in milliseconds."""
        path = self._path(folder)
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(path)} if self.fs.exists(path) else {}

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Writes ``text`` aside and renames it; False if ``name`` is taken."""
        aside = f"manifest/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(aside))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.exists(self._path(name)) and self.fs.rename(self._path(aside), self._path(name)):
            return True
        self.fs.delete(self._path(aside), False)
        return False


def manifests(spark: SparkSession, base: str) -> list[str]:
    """The published manifests, oldest first."""
    return sorted(n for n in _Files(spark, base).names("manifest") if n.endswith(".json") and n[0] != ".")


def current(spark: SparkSession, base: str) -> str | None:
    """The folder of the newest published version."""
    names = manifests(spark, base)
    return f"{base.rstrip('/')}/{json.loads(_Files(spark, base).text(f'manifest/{names[-1]}'))['version']}" if names else None


def open_current(spark: SparkSession, base: str) -> Warehouse:
    """The published version; a folder without manifests is opened as it is."""
    return open_warehouse(spark, current(spark, base) or base.rstrip("/"))


def check(wh: Warehouse) -> None:
    """Raises if a key of the fact is repeated or has no dimension row."""
    orphans = {r[0]: r[1] for r in quality.fk_orphans(wh).collect()}
    repeated = {r[0]: r[1] for r in quality.unique_keys(wh).collect()}
    wrong = {name: n for name, n in (orphans | repeated).items() if n}
    if wrong:
        raise ValueError(f"not published, keys are wrong: {wrong}")


def refresh(spark: SparkSession, staging: Staging, base: str, keep: int = 1) -> Warehouse:
    """Builds a new version from ``staging``, checks it and publishes it."""
    version = f"versions/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    wh = build_warehouse(spark, staging, f"{base.rstrip('/')}/{version}")
    check(wh)
    rows = wh.orders.agg(F.count(F.lit(1))).first()[0]
    files = _Files(spark, base)
    while True:
        names = manifests(spark, base)
        number = int(names[-1].split(".")[0]) + 1 if names else 1
        if files.put(f"manifest/{number:012d}.json", json.dumps({"version": version, "orders": rows})):
            break
    clean(spark, base, keep)
    return wh


def clean(spark: SparkSession, base: str, keep: int = 1) -> None:
    """Removes versions older than the ``keep`` before the newest, and leftovers."""
    files = _Files(spark, base)
    names = manifests(spark, base)
    held = {json.loads(files.text(f"manifest/{n}"))["version"].split("/")[1] for n in names[-1 - keep:]}
    once = {json.loads(files.text(f"manifest/{n}"))["version"].split("/")[1] for n in names}
    limit = (time.time() - STALE_HOURS * 3600) * 1000
    for version, changed in files.names("versions").items():
        if version not in held and (version in once or changed < limit):
            remove(spark, f"{base.rstrip('/')}/versions/{version}")
    for n in names[:-1 - keep]:
        remove(spark, f"{base.rstrip('/')}/manifest/{n}")
