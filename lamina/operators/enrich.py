"""Enrichment of folders: rules in order, a cache table, and a pluggable client."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from lamina.sources.files import registry, save_registry
from lamina.sources.snapshots import written


def rule_based(df: DataFrame, text: str, name: str, rules: list[tuple[str, str]], default: str | None = None) -> DataFrame:
    """The label of the first rule whose pattern is found, else the default."""
    out = None
    for pattern, label in rules:
        hit = F.col(text).rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return df.withColumn(name, out.otherwise(default) if out is not None else F.lit(default))


def with_cache(wanted: DataFrame, cache: DataFrame, key: str, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Cached answers, and `ask` for keys without one; columns of `ask` and cache are equal."""
    keys = wanted.select(key).distinct()
    return cache.join(keys, key, "left_semi").unionByName(ask(keys.join(cache, key, "left_anti")))


class Cache:
    """A table of answers that is kept: each key is asked for once, over all runs.

    counts: keys that were wanted, that the table had, that were asked for, and whose answer has an error and is not kept.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str) -> None:
        self.spark, self.path, self.key, self.counts = spark, path, key, {}
        self.schema = StructType.fromDDL(schema)

    def rows(self) -> DataFrame:
        return registry(self.spark, self.path, self.schema)

    def answers(self, wanted: DataFrame, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Kept and new answers for the keys of `wanted`; `ask` answers in the columns of the cache, and may add `error`."""
        known = self.rows()
        keys = written(wanted.select(self.key).filter(F.col(self.key).isNotNull()).distinct())
        new = ask(keys.join(known, self.key, "left_anti"))
        new = written(new if "error" in new.columns else new.withColumn("error", F.lit(None).cast("string")))
        names = self.schema.names
        good = new.filter("error IS NULL").select(*names)
        n = new.agg(F.count("*").alias("asked"), F.count("error").alias("failed")).first()
        n_wanted = keys.count()
        self.counts = {"wanted": n_wanted, "known": n_wanted - n["asked"], "asked": n["asked"], "failed": n["failed"]}
        if n["asked"] > n["failed"]:
            save_registry(known.unionByName(good), self.path)
        return self.rows().join(keys, self.key, "left_semi")


@dataclass(frozen=True)
class Limits:
    """What a remote service bears: calls a minute of all tasks together, calls of one task at once, tries of a call, seconds before the second try."""

    per_minute: float = 60
    parallel: int = 5
    tries: int = 3
    pause: float = 1.0


class Busy(Exception):
    """An answer that says to ask again later: 429 or 503."""


class Bucket:
    """Tokens of one task: one each `interval` seconds, at most a minute's worth at once."""

    def __init__(self, per_minute: float) -> None:
        self.interval, self.next, self.lock = 60 / per_minute, 0.0, threading.Lock()

    def take(self) -> None:
        with self.lock:
            now = time.monotonic()
            self.next = max(self.next, now) + self.interval
            wait = self.next - self.interval - now
        if wait > 0:
            time.sleep(wait)


def answered(call: Callable[[str], dict], key: str, bucket: Bucket, limits: Limits) -> tuple[dict, int, str | None]:
    """(answer, calls, error): a call is tried again, each time after twice the pause, if the service is busy or cannot be reached; another error ends it."""
    pause = limits.pause
    for n in range(1, limits.tries + 1):
        bucket.take()
        try:
            return call(key) or {}, n, None
        except (Busy, OSError) as e:
            error = f"{type(e).__name__}: {e}"
            if n < limits.tries:
                time.sleep(pause)
                pause *= 2
        except Exception as e:  # noqa: BLE001  what a client raises is its own affair and ends no job
            return {}, n, f"{type(e).__name__}: {e}"
    return {}, limits.tries, error


class Answers:
    """Answers kept in a folder that all executors reach: a task that runs again asks nothing twice."""

    def __init__(self, folder: str) -> None:
        self.fs, self.at = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)

    def _file(self, key: str) -> str:
        name = sha256(key.encode()).hexdigest()
        return f"{self.at}/{name[:2]}/{name}.json"

    def get(self, key: str) -> dict | None:
        try:
            with self.fs.open_input_stream(self._file(key)) as f:
                return json.loads(f.read())["answer"]
        except (FileNotFoundError, ValueError, KeyError):
            return None

    def put(self, key: str, answer: dict) -> None:
        path = self._file(key)
        own = f"{path}.{uuid.uuid4().hex}"
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        with self.fs.open_output_stream(own) as f:
            f.write(json.dumps({"key": key, "answer": answer}).encode())
        self.fs.move(own, path)


def client(call: Callable[[str], dict], schema: str, key: str, limits: Limits = Limits(), tasks: int = 4, kept: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Wraps a call for one key as an operator: (key, columns of `schema`, calls, error) for each distinct key.

    Keys are dealt to `tasks` tasks, each with its part of the calls a minute and `parallel` calls at once. Answers are
    taken from and put into the folder `kept`; failures are not kept. Columns that an answer lacks are null, those of another type are an error.
    """
    fields = StructType.fromDDL(schema).fields
    arrow = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, store = Bucket(limits.per_minute / tasks), Answers(kept) if kept else None

        def one(k: str | None) -> tuple[dict, int, str | None]:
            if k is None:
                return {}, 0, None
            if store is not None and (known := store.get(k)) is not None:
                return known, 0, None
            answer, n, error = answered(call, k, bucket, limits)
            try:
                for f, t in zip(names, arrow, strict=True):
                    pa.array([answer.get(f)], t)
            except (pa.ArrowInvalid, pa.ArrowTypeError) as e:
                answer, error = {}, f"{f}: {e}"
            if store is not None and error is None:
                store.put(k, answer)
            return answer, n, error

        with ThreadPoolExecutor(limits.parallel) as pool:
            for batch in batches:
                got = list(pool.map(one, batch.column(0).to_pylist()))
                cells = [pa.array([g[0].get(f) for g in got], t) for f, t in zip(names, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cells, pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.string())], names=[key, *names, "calls", "error"])

    return lambda df: df.select(F.col(key).cast("string").alias(key)).distinct().repartition(tasks, key).mapInArrow(run, f"`{key}` string, {schema}, calls int, error string")
