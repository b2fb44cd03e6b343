"""Reports: lists of unlike length side by side, long tables of audits, deferred decisions, action logs filled while a stage runs."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lamina.operators.match import numbered

STAMP = "%Y%m%d_%H%M%S"


def stamp(at: datetime | None = None) -> str:
    """A time as the names of folders and reports have it."""
    return (at or datetime.now(timezone.utc)).strftime(STAMP)


def staging_folder(output: str, name: str, at: datetime | None = None) -> str:
    """The folder in which a run works before its files go to `output`."""
    return f"{output.rstrip('/')}_staging_{name}_{stamp(at)}"


def side_by_side(**lists: DataFrame) -> DataFrame:
    """(position, one column for each list): lists of unlike length in one table, short ones filled with nulls.

    Each list is a table of one column, put in its order. Positions are given by ranges of that order, so no list is gathered anywhere.
    """
    placed = [numbered(df.select(F.col(f"`{df.columns[0]}`").alias(name)), name).withColumnRenamed("rn", "position") for name, df in lists.items()]
    return reduce(lambda a, b: a.join(b, "position", "full_outer"), placed)


def long_report(**parts: DataFrame) -> DataFrame:
    """(part, name, n): tables of (name, n) under each other."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(p).alias("part"), F.col(df.columns[0]).cast("string").alias("name"), F.col(df.columns[1]).cast("long").alias("n")) for p, df in parts.items()])


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A report as CSV with a header, or as lines of JSON; an earlier one goes."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def deferred(decisions: DataFrame) -> DataFrame:
    """Decisions that are still open, as one JSON text each beside their type."""
    rest = [c for c in decisions.columns if c != "type"]
    return decisions.filter(F.col("outcome") == "defer").select("type", F.to_json(F.struct(*rest)).alias("request"))


class Log:
    """Typed actions of a run: counts come from the stages' own jobs, by `observe`, not from further passes."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self._open, self.rows = spark, [], []

    def watch(self, stage: str, df: DataFrame, **counts: Column) -> DataFrame:
        """The same rows; once a job has read them all, their number and each named count are known to the log."""
        seen = Observation(f"{stage}-{len(self._open)}")
        self._open.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])

    def note(self, stage: str, action: str, n: int | None = None, detail: str | None = None) -> None:
        self.rows.append((datetime.now(timezone.utc), stage, action, n, detail))

    def close(self) -> DataFrame:
        """(at, stage, action, n, detail) of all that was watched and noted. Waits for the jobs of watched tables that have not run."""
        for stage, seen in self._open:
            for action, n in seen.get.items():
                self.note(stage, action, n)
        self._open = []
        return self.spark.createDataFrame(self.rows, "at timestamp, stage string, action string, n long, detail string")
