"""The run ledger of a warehouse: which steps are finished, and what a broken-off one was about to publish.

Two kinds of small JSON files, each written under another name first and then renamed:

    open/<name>.json              a publication that has begun: staged partitions that are to replace a table's
    done/<unit>/<step>-<n>.json   a finished step of a unit of work (a day, a range of days); the highest n counts

A publication is written down before the table is touched and crossed out after its step is written down as finished. A
run that finds an open one completes it first. Moving staged partitions into a table can be repeated, so it
doesn't matter where the last run ended. One writer at a time, as for the tables themselves.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession


class NotReady(RuntimeError):
    """A step was asked for before the step it builds on is finished."""


class Folder:
    """Small files of a folder in any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._at().getFileSystem(self._conf)

    def names(self) -> list[str]:
        fs, at = self._fs(), self._at()
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def read(self, name: str) -> dict:
        stream = self._fs().open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, content: dict) -> None:
        """``content`` as a new file ``name``, whole or not at all."""
        fs, temp = self._fs(), self._at(f".{name}-{uuid.uuid4().hex}")
        stream = fs.create(temp)
        try:
            stream.write(bytearray(json.dumps(content, default=str).encode()))
        finally:
            stream.close()
        if not fs.rename(temp, self._at(name)):
            raise OSError(f"can't write {self.path}/{name}")

    def remove(self, name: str) -> None:
        self._fs().delete(self._at(name), True)


def files_token(spark: SparkSession, path: str) -> str:
    """What the files at ``path`` (a file, a folder or a pattern) are: a digest of their names, sizes and times."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    found, todo = [], list(fs.globStatus(at) or [])
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo.extend(fs.listStatus(status.getPath()))
        else:
            found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._open = Folder(spark, f"{self.path}/open")

    def _done(self, unit: str) -> Folder:
        return Folder(self.spark, f"{self.path}/done/{unit}")

    # finished steps ------------------------------------------------------------------------------------
    def finished(self, unit: str, step: str) -> dict | None:
        """{inputs, run, detail} of the last time that the step was finished."""
        folder = self._done(unit)
        mine = [n for n in folder.names() if n.startswith(f"{step}-") and n.endswith(".json")]
        return folder.read(mine[-1]) if mine else None

    def finish(self, unit: str, step: str, inputs: str, detail: dict | None = None, run: str | None = None) -> dict:
        folder = self._done(unit)
        mine = [n for n in folder.names() if n.startswith(f"{step}-") and n.endswith(".json")]
        record = {"inputs": inputs, "run": run or uuid.uuid4().hex, "detail": detail or {}}
        if mine and folder.read(mine[-1])["run"] == record["run"]:  # written down before the run was broken off
            return record
        n = int(mine[-1][len(step) + 1:-5]) + 1 if mine else 0
        folder.write(f"{step}-{n:06d}.json", record)
        for old in mine[:-1]:
            folder.remove(old)
        return record

    def require(self, unit: str, step: str, before: str) -> dict:
        got = self.finished(unit, step)
        if got is None:
            raise NotReady(f"{before} of {unit}: {step} isn't finished")
        return got

    # publications --------------------------------------------------------------------------------------
    def publish(self, publication: dict, done: dict | None = None) -> None:
        """Carry out ``publication`` (``tables.move_partitions``), then write ``done`` (unit, step, inputs, detail) down."""
        name = f"{uuid.uuid4().hex}.json"
        if done:
            done = {**done, "run": uuid.uuid4().hex}
        self._open.write(name, {"publication": publication, "done": done})
        self._complete(name)

    def _complete(self, name: str) -> None:
        from strata.sources.tables import move_partitions

        record = self._open.read(name)
        move_partitions(self.spark, record["publication"])
        if record["done"]:
            self.finish(**record["done"])
        self._open.remove(name)

    def recover(self) -> int:
        """Complete what a broken-off run has begun to publish; returns how much that was."""
        names = [n for n in self._open.names() if n.endswith(".json") and not n.startswith(".")]
        for name in names:
            self._complete(name)
        return len(names)
