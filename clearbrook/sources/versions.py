"""A table as a row of immutable versions and a log that says which one counts.

Every version is a folder of its own that nothing changes once it is written.  What readers see is named by numbered
records: a record is created only if its number is free, which is the one step that publishes, takes back or loses a
race.  A writer that fails before it leaves a folder that no record names, and readers on the version before.  Rolling
back is a record that names an earlier folder again, so nothing is ever moved or deleted, and any version can be read as
of its number or its time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

HISTORY_SCHEMA = "version long, folder string, action string, at string, details map<string,string>"


class Conflict(RuntimeError):
    """Another writer has published since the version that this one was made from."""


class VersionedTable:
    """Versions below ``path``, on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # --- files ------------------------------------------------------------

    def _place(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._place("log").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _records(self) -> list[dict]:
        """Complete records by number.  One that is being written, or whose writer died, counts as none."""
        files, folder = self._files(), self._place("log")
        if not files.exists(folder):
            return []
        found = []
        for status in files.listStatus(folder):
            stream = files.open(status.getPath())
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                found.append(json.loads(text))
        return sorted(found, key=lambda r: r["version"])

    def _taken(self) -> int:
        """The largest number that any record has, complete or not."""
        files, folder = self._files(), self._place("log")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return max((int(n.split(".")[0]) for n in names), default=0)

    def _record(self, folder: str, action: str, details: Mapping[str, str] | None, expected: int | None) -> int:
        """Create the next record; with ``expected`` only if that is still the current version."""
        current = self.current()
        if expected is not None and current != expected:
            raise Conflict(f"version {current} is published, not {expected}")
        number = self._taken() + 1
        record = {
            "version": number, "folder": folder, "action": action,
            "at": datetime.now(timezone.utc).isoformat(timespec="microseconds"), "details": dict(details or {}),
        }
        try:
            stream = self._files().create(self._place(f"log/{number:012d}.json"), False)
        except Py4JJavaError as problem:
            if "exist" not in str(problem.java_exception):
                raise
            raise Conflict(f"version {number} was taken by another writer") from problem
        try:
            stream.write(bytearray((json.dumps(record) + "\n").encode("utf-8")))
        finally:
            stream.close()
        return number

    # --- what callers use ---------------------------------------------------

    def current(self) -> int:
        """The number of the version that readers get; 0 before the first."""
        return max((r["version"] for r in self._records()), default=0)

    def stage(self, df: DataFrame) -> str:
        """Write rows to a folder that no reader knows of yet, and return its name."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    def publish_staged(self, folder: str, details: Mapping[str, str] | None = None, expected: int | None = None) -> int:
        return self._record(folder, "publish", details, expected)

    def publish(self, df: DataFrame, details: Mapping[str, str] | None = None, expected: int | None = None) -> int:
        """Write a version and make it the current one; returns its number.

        ``expected`` is the version that the rows were derived from: when
        another one is current by now, :class:`Conflict` is raised and nothing
        is published.
        """
        return self.publish_staged(self.stage(df), details, expected)

    def read(self, version: int | None = None, as_of: str | None = None) -> DataFrame:
        """The current rows, those of a version, or those current at a time (ISO, UTC)."""
        records = self._records()
        if version is not None:
            records = [r for r in records if r["version"] == version]
        elif as_of is not None:
            records = [r for r in records if r["at"] <= as_of]
        if not records:
            raise LookupError(f"{self.path} has no such version")
        return self.spark.read.parquet(f"{self.path}/{records[-1]['folder']}")

    def rollback(self, version: int) -> int:
        """Make an earlier version current again, under a number of its own."""
        folder = next((r["folder"] for r in self._records() if r["version"] == version), None)
        if folder is None:
            raise LookupError(f"{self.path} has no version {version}")
        return self._record(folder, "rollback", {"to": str(version)}, None)

    def history(self) -> DataFrame:
        """One row per record."""
        rows = [(r["version"], r["folder"], r["action"], r["at"], r["details"]) for r in self._records()]
        return self.spark.createDataFrame(rows, HISTORY_SCHEMA)
