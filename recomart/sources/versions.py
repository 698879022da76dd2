"""Publish a mart by version.

A published name is a view over one folder of Parquet files, its current version.
``publish_version`` writes the mart to a folder of its own, and only when every
file is there is the name switched to it, by one alteration of the view in the
catalog. So readers see the old or the new version and never a part of one; a
write that fails leaves the old version readable under the name. Plans that are
already resolved keep reading the folder they were resolved to, which is why the
last ``keep`` versions stay; older ones are dropped after the switch.

Folders lie under ``<folder>/<name>.versions`` (``folder``: the location of the
current database unless given), named by a rising number and a random part, so that two
writers never share one; the one that switches last wins. A version is complete when Spark has
left its ``_SUCCESS`` file. A folder without it belongs to a write that runs or has died;
it is dropped once it is older than ``stale_hours``. All file access goes through
Hadoop's file systems, so the folder may be in any store that Spark can write.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_FOLDER = re.compile(r"v(\d{8})-[0-9a-f]{8}$")


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    complete: bool
    written_ms: int


class VersionStore:
    """The versions of published names of one session's catalog."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        if folder is None:
            folder = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
        self.folder = folder.rstrip("/")

    # -- files ------------------------------------------------------------------
    def _root(self, name: str) -> str:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"not a plain table name: {name!r}")
        return f"{self.folder}/{name}.versions"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def versions(self, name: str) -> list[Version]:
        """Versions in the store, oldest first; incomplete ones too."""
        fs, root = self._fs(self._root(name))
        if not fs.exists(root):
            return []
        found = []
        for s in fs.listStatus(root):
            m = _FOLDER.fullmatch(s.getPath().getName())
            if m and s.isDirectory():
                path = s.getPath().toString()
                done, mark = self._fs(f"{path}/_SUCCESS")
                found.append(Version(int(m[1]), path, done.exists(mark), s.getModificationTime()))
        return sorted(found, key=lambda v: (v.number, v.path))

    # -- the name ---------------------------------------------------------------
    def current(self, name: str) -> str | None:
        """Folder the name points at; None if it is not published."""
        self._root(name)  # checks the name
        if not self.spark.catalog.tableExists(name):
            return None
        text = [r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
                if r["col_name"] == "View Text"]
        m = re.fullmatch(r"SELECT \* FROM parquet\.`(.*)`", text[0]) if text else None
        if m is None:
            raise ValueError(f"{name} exists and was not published by version")
        return m[1]

    def switch(self, name: str, version: Version) -> None:
        """Point the name at a complete version: one change of the catalog."""
        if not version.complete:
            raise ValueError(f"{version.path} is not complete")
        now, text = self.current(name), f"SELECT * FROM parquet.`{version.path}`"  # a table of that name is an error
        if now is None:
            self.spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {text}")
        if now != version.path:  # one alteration; CREATE OR REPLACE would drop the name first
            self.spark.sql(f"ALTER VIEW {name} AS {text}")

    def publish(self, df: DataFrame, name: str, keep: int = 2, partition_by: list[str] | None = None,
                stale_hours: float = 24.0) -> DataFrame:
        """Write ``df`` as the next version, switch the name to it, drop all but the last ``keep`` versions."""
        if keep < 1:
            raise ValueError("keep at least the version that is published")
        self.current(name)
        number = max((v.number for v in self.versions(name)), default=0) + 1
        path = f"{self._root(name)}/v{number:08d}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("error")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.parquet(path)
        except Exception:
            self._delete(path)  # this write's own folder; the name was never switched
            raise
        mine = [v for v in self.versions(name) if v.path.endswith(path.rsplit("/", 1)[1])][0]
        self.switch(name, mine)
        self.drop_old(name, keep, stale_hours)
        return self.spark.table(name)

    def roll_back(self, name: str, number: int) -> DataFrame:
        """Point the name at an earlier version that is still kept."""
        found = [v for v in self.versions(name) if v.number == number and v.complete]
        if not found:
            raise ValueError(f"version {number} of {name} is not kept")
        self.switch(name, found[-1])
        return self.spark.table(name)

    def drop_old(self, name: str, keep: int, stale_hours: float = 24.0) -> None:
        """Drop complete versions beyond the last ``keep`` (never the current one) and stale incomplete ones."""
        now, current = self.current(name), time.time() * 1000
        found = self.versions(name)
        complete = [v for v in found if v.complete]
        old = complete[:-keep] + [v for v in found if not v.complete and v.written_ms < current - stale_hours * 3.6e6]
        for v in old:
            if v.path != now:
                self._delete(v.path)

    def unpublish(self, name: str) -> None:
        """Drop the name and all its versions."""
        if self.current(name) is not None:
            self.spark.sql(f"DROP VIEW {name}")
        self._delete(self._root(name))


def publish_version(df: DataFrame, name: str, keep: int = 2, folder: str | None = None,
                    partition_by: list[str] | None = None) -> DataFrame:
    """Publish ``df`` under ``name`` by version (see the module); returns the published rows."""
    return VersionStore(df.sparkSession, folder).publish(df, name, keep, partition_by)
