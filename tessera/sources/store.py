"""Persistent tables as snapshots with a pointer, and the ledger of the search budget.

A write makes a new snapshot folder and then a pointer file of the next number; readers take the pointer of the highest number, so
they see the old or the new snapshot, never a part and never none. The pointer before it stays with its snapshot for
readers that still hold it; older ones are deleted. One writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
import sqlite3
import uuid
from collections.abc import Callable
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession


class Store:
    """Snapshots of named tables under a folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _pointers(self, table: str) -> list[str]:
        """Names of a table's pointer files, the newest last."""
        return sorted(status.getPath().getName() for status in self.fs.globStatus(self._path(f"{table}.pointer-*.json")) or [])

    def _read(self, name: str) -> dict:
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def manifest(self, table: str) -> dict | None:
        """{snapshot, rows, written_at, ...} of a table, or None."""
        found = self._pointers(table)
        return self._read(found[-1]) if found else None

    def _point(self, table: str, manifest: dict) -> None:
        before = self._pointers(table)
        number = int(before[-1].split("-")[-1].split(".")[0]) + 1 if before else 0
        new = self._path(f".{table}-{uuid.uuid4().hex}")
        stream = self.fs.create(new, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not self.fs.rename(new, self._path(f"{table}.pointer-{number:012d}.json")):
            raise OSError(f"{table}: the new pointer could not be put in place")
        held = {manifest["snapshot"], *(self._read(name)["snapshot"] for name in before[-1:])}
        for name in before[:-1]:
            snapshot = self._read(name)["snapshot"]
            self.fs.delete(self._path(name), False)
            if snapshot not in held:
                self.fs.delete(self._path(snapshot), True)

    def replace(self, table: str, rows: DataFrame, check: Callable[[int], None] | None = None, **more) -> DataFrame:
        """rows as the table's new snapshot, if check(number of rows) does not raise."""
        name = f"{table}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{name}")
        written = self.spark.read.parquet(f"{self.folder}/{name}")
        n = written.count()
        try:
            if check:
                check(n)
        except Exception:
            self.fs.delete(self._path(name), True)
            raise
        self._point(table, {"snapshot": name, "rows": n, "written_at": dt.datetime.now(dt.UTC).isoformat(), **more})
        return written

    def load(self, table: str, schema: str) -> DataFrame:
        """The table, empty if it was never written."""
        found = self.manifest(table)
        if found is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.folder}/{found['snapshot']}")

    def count(self, table: str) -> int:
        return (self.manifest(table) or {}).get("rows", 0)

    def append(self, log: str, lines: list[str]) -> str:
        """Lines as a new file of a log; it shows whole or not at all. The file's name."""
        name = f"{log}/{uuid.uuid4().hex}.jsonl"
        new = self._path(f"{name}.new")
        stream = self.fs.create(new, True)
        stream.write(bytearray("".join(x + "\n" for x in lines).encode()))
        stream.close()
        self.fs.rename(new, self._path(name))
        return name

    def logged(self, log: str) -> dict[str, list[str]]:
        """The lines of each file of a log."""
        found = {}
        for status in self.fs.globStatus(self._path(f"{log}/*.jsonl")) or []:
            stream = self.fs.open(status.getPath())
            try:
                text = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
            finally:
                stream.close()
            found[f"{log}/{status.getPath().getName()}"] = text.split("\n")[:-1]
        return found

    def drop(self, names: list[str]) -> None:
        """Delete files of logs."""
        for name in names:
            self.fs.delete(self._path(name), False)

    def expire(self, table: str) -> None:
        """Forget when the table was written, so that it is no longer fresh."""
        found = self.manifest(table)
        if found is not None:
            self._point(table, {k: v for k, v in found.items() if k != "written_at"})

    def is_fresh(self, table: str, hours: float, now: dt.datetime | None = None) -> bool:
        found = self.manifest(table)
        if not found or not found["rows"]:
            return False
        try:
            written = dt.datetime.fromisoformat(found.get("written_at") or "")
        except ValueError:
            return False
        return (now or dt.datetime.now(dt.UTC)) - written <= dt.timedelta(hours=hours)


class Ledger:
    """Requests by day and model, in one file with one writer at a time: reserving is atomic across processes."""

    def __init__(self, path: str, zone: str, clock=lambda: dt.datetime.now(dt.UTC)):
        self.path, self.zone, self.clock = path, ZoneInfo(zone), clock
        with self._connect() as db:
            db.execute(
                "CREATE TABLE IF NOT EXISTS usage (usage_date TEXT, model TEXT, requests INTEGER, entities_sent INTEGER, successful_entities INTEGER, failed_requests INTEGER, PRIMARY KEY (usage_date, model))"
            )

    def _connect(self):
        return sqlite3.connect(self.path, timeout=30, isolation_level=None)

    def today(self) -> str:
        return self.clock().astimezone(self.zone).date().isoformat()

    def reserve(self, model: str, entities: int, limit: int) -> str | None:
        """The day a request is charged to, or None if its budget is spent."""
        day, db = self.today(), self._connect()
        try:
            db.execute("BEGIN IMMEDIATE")
            row = db.execute("SELECT requests FROM usage WHERE usage_date = ? AND model = ?", (day, model)).fetchone()
            if row and row[0] >= limit:
                db.execute("ROLLBACK")
                return None
            db.execute(
                "INSERT INTO usage VALUES (?, ?, 1, ?, 0, 0) ON CONFLICT (usage_date, model) DO UPDATE SET requests = requests + 1, entities_sent = entities_sent + excluded.entities_sent",
                (day, model, entities),
            )
            db.execute("COMMIT")
            return day
        finally:
            db.close()

    def complete(self, model: str, day: str, successful: int, failed: bool) -> None:
        with self._connect() as db:
            db.execute(
                "UPDATE usage SET successful_entities = successful_entities + ?, failed_requests = failed_requests + ? WHERE usage_date = ? AND model = ?", (max(successful, 0), int(failed), day, model)
            )

    def usage(self, model: str) -> dict:
        with self._connect() as db:
            row = db.execute("SELECT * FROM usage WHERE usage_date = ? AND model = ?", (self.today(), model)).fetchone()
        names = ("usage_date", "model", "requests", "entities_sent", "successful_entities", "failed_requests")
        return dict(zip(names, row or (self.today(), model, 0, 0, 0, 0)))

    def report(self, model: str, limit: int) -> str:
        u = self.usage(model)
        return f"{u['usage_date']} {u['model']}: {u['requests']}/{limit} requests, {u['entities_sent']} entities sent, {u['successful_entities']} returned, {u['failed_requests']} failed"
