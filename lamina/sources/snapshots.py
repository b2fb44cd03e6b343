"""Written tables that cut lineage, and snapshots of stages by which a run that was stopped goes on.

A snapshot is a folder of its own for each version of a stage: Parquet files, then a marker that is written last.
One without its marker is torn and does not count. The marker holds the key of what the stage has read, so a
stage whose input or parameters have changed runs again, and so do the stages behind it.
"""

from __future__ import annotations

import json
import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Name of the marker of a whole snapshot.
MARK = "_COMMITTED.json"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, and all runs in one process, below a local one."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that all of them see")
        top = "file://" + tempfile.mkdtemp(prefix="lamina-")
        spark.conf.set("spark.checkpoint.dir", top)
    return posixpath.join(top, uuid.uuid4().hex)


def written(df: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder: nothing above it is computed twice, and a lost executor costs a read."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def few_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send at most so many rows at once to Python workers: a worker holds a batch whole, however large its texts are."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Store:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def join(self, *parts: str) -> str:
        return posixpath.join(self.path, *parts)

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._at(self.join(*parts)))

    def list(self, *parts: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(self.join(*parts)))) if self.exists(*parts) else []

    def delete(self, *parts: str) -> None:
        self._fs.delete(self._at(self.join(*parts)), True)

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._at(self.join(old)), self._at(self.join(new)))

    def write(self, text: str, *parts: str) -> None:
        out = self._fs.create(self._at(self.join(*parts)), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, *parts: str) -> str:
        source = self._fs.open(self._at(self.join(*parts)))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


def content_key(*tables: DataFrame | str) -> str:
    """A key of rows and parameters: it depends on no order of rows, columns count by name. One pass over each table."""
    seen = sha256()
    for t in tables:
        if isinstance(t, str):
            seen.update(b"s" + t.encode() + b"\0")
            continue
        names = sorted(t.columns)
        row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in names]) if names else F.lit(0)
        n, total = t.agg(F.count("*"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0))).first()
        seen.update(f"t{names}{[t.schema[c].dataType.simpleString() for c in names]}{n},{total}\0".encode())
    return seen.hexdigest()


@dataclass
class Stage:
    """A named step: `run` takes what the stage before has left and returns a table."""

    name: str
    run: Callable[[DataFrame], DataFrame]
    version: str = "1"


@dataclass
class Run:
    """What a run has done: stages that ran and those whose snapshots were taken."""

    result: DataFrame
    ran: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)


class Snapshots:
    """Snapshots of named stages below one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.store = spark, Store(spark, folder)

    def markers(self, stage: str) -> list[dict]:
        """Markers of a stage's whole snapshots, oldest first."""
        found = [v for v in self.store.list(stage) if self.store.exists(stage, v, MARK)]
        return sorted((json.loads(self.store.read(stage, v, MARK)) | {"folder": v} for v in found), key=lambda m: m["number"])

    def read(self, stage: str, key: str | None = None) -> DataFrame | None:
        """The latest whole snapshot of a stage, or the latest with that key; none: null."""
        known = [m for m in self.markers(stage) if key in (None, m["key"])]
        if not known:
            return None
        schema = T.StructType.fromJson(json.loads(known[-1]["schema"]))
        return self.spark.read.schema(schema).parquet(self.store.join(stage, known[-1]["folder"], "rows"))

    def save(self, stage: str, df: DataFrame, key: str) -> DataFrame:
        """Writes a version; it counts from when its marker is there. Readers of earlier versions are not disturbed."""
        version = uuid.uuid4().hex
        df.write.parquet(self.store.join(stage, version, "rows"))
        number = 1 + max((m["number"] for m in self.markers(stage)), default=0)
        self.store.write(json.dumps({"stage": stage, "key": key, "number": number, "schema": df.schema.json()}), stage, version, MARK)
        return self.read(stage, key)

    def clean(self, stage: str, keep: int = 1) -> None:
        """Deletes torn snapshots and all whole ones but the latest `keep`."""
        last = {m["folder"] for m in self.markers(stage)[-keep:]} if keep else set()
        for version in self.store.list(stage):
            if version not in last:
                self.store.delete(stage, version)

    def run(self, source: DataFrame, stages: Iterable[Stage]) -> Run:
        """Runs the stages in turn; one whose snapshot has the key of its input is not run again.

        The key of the first stage's input is of its rows; that of a later one is made of the key before and of
        the name and version of each stage on the way, so nothing that is kept is read to find out.
        """
        key, current, out = content_key(source), source, Run(source)
        for stage in stages:
            key = sha256(f"{key}\0{stage.name}\0{stage.version}".encode()).hexdigest()
            found = self.read(stage.name, key)
            (out.ran if found is None else out.kept).append(stage.name)
            current = self.save(stage.name, stage.run(current), key) if found is None else found
        out.result = current
        return out


def swap(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Puts a table in the place of the one at `path`, which the plan may itself read.

    The new one is written beside it whole, the old one is moved aside, the new one takes its place, the old one
    goes. `recover` ends a swap that a crash has cut short; no moment is without a whole table.
    """
    folder, name = posixpath.split(path.rstrip("/"))
    store = Store(df.sparkSession, folder)
    recover(df.sparkSession, path)
    write(df, store.join(f"{name}.new"))
    if store.exists(name) and not store.rename(name, f"{name}.old"):
        raise OSError(f"{path} could not be moved aside; the new table is at {path}.new")
    if not store.rename(f"{name}.new", name):
        raise OSError(f"{path}.new is whole but could not take its place; the old table is at {path}.old")
    store.delete(f"{name}.old")


def recover(spark: SparkSession, path: str) -> None:
    """Ends a swap that was cut short: a table that was moved aside comes back unless a new one is in its place."""
    folder, name = posixpath.split(path.rstrip("/"))
    store = Store(spark, folder)
    if store.exists(f"{name}.old"):
        if store.exists(name):
            store.delete(f"{name}.old")
        elif store.exists(f"{name}.new", "_SUCCESS"):  # it was whole when the old one was moved
            store.rename(f"{name}.new", name)
            store.delete(f"{name}.old")
        else:
            store.rename(f"{name}.old", name)
    if store.exists(f"{name}.new"):
        store.delete(f"{name}.new")
