"""Command lines: python -m lamina run|scan|audit|stats|merge|clean …; results are written as Parquet or shown.

Of all: --dry-run writes nothing and tells how many rows there would be; --backup keeps the table that the result
replaces, as <to>.backup; --strict ends with 1 where an audit finds a difference.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import patterns
from lamina.operators import audit, match, organize, registry, stats
from lamina.sources import files, snapshots


def whole_run(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    done = organize.organize(spark, a.folders, a.state, bool(a.review))
    print(f"stages that ran: {', '.join(done.ran) or 'none'}; taken from before: {', '.join(done.kept) or 'none'}")
    organize.stage(spark, done.result, a.staging, a.output, a.dry_run)
    return done.result.select("path", "target", "is_duplicate", "duplicate_of")


def scan(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    found = files.scan(spark, *a.folders)
    return found.select("*", patterns.extraction(F.col("path")).alias("extraction"))


def report(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    found = files.scan(spark, a.output)
    rel = patterns.relative(F.regexp_replace("path", "^file:/*", "/"), a.output)
    told = audit.registry_counts(main=spark.read.parquet(a.annotations), duplicate=spark.read.parquet(a.duplicates))
    return audit.discrepancies(audit.structure(found.withColumn("rel", rel)), told)


def statistics(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return stats.completeness(spark.read.parquet(a.annotations), a.columns)


def merge(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return match.merge_registries(spark.read.parquet(a.existing), spark.read.parquet(a.staged), a.key, {f.lstrip("+"): f.startswith("+") for f in a.fields})


def remove(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return registry.without(spark.read.parquet(a.hashes), spark.read.parquet(a.duplicates), a.key)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lamina")
    sub = top.add_subparsers(required=True)

    def command(name: str, run, **arguments: dict) -> None:
        p = sub.add_parser(name)
        for arg, options in arguments.items():
            p.add_argument(arg if options.get("nargs") else f"--{arg}", **({} if options.get("nargs") else {"required": "default" not in options}), **options)
        for flag in ("dry-run", "backup", "strict"):
            p.add_argument(f"--{flag}", action="store_true")
        p.add_argument("--to", help="folder for the result; without it the result is shown")
        p.set_defaults(run=run)

    command("run", whole_run, folders={"nargs": "+"}, state={}, staging={}, output={}, review={"default": "", "help": "anything: unknown pictures go to a folder for review"})
    command("scan", scan, folders={"nargs": "+"})
    command("audit", report, output={}, annotations={}, duplicates={})
    command("stats", statistics, annotations={}, columns={"nargs": "+"})
    command("merge", merge, existing={}, staged={}, key={"default": "uuid"}, fields={"nargs": "+", "help": "names; a + before one marks a comment"})
    command("clean", remove, hashes={}, duplicates={}, key={"default": "uuid"})
    return top


def main(arguments: Sequence[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("lamina").getOrCreate()
    out = a.run(spark, a)
    if a.dry_run:
        print(f"{out.count()} rows; nothing is written")
    elif a.to:
        if a.backup and snapshots.Store(spark, a.to).exists():
            files.save_registry(spark.read.parquet(a.to), f"{a.to.rstrip('/')}.backup")
        files.save_registry(out, a.to)
    else:
        out.show(50, truncate=False)
    wrong = F.col("difference") != 0 if "difference" in out.columns else F.lit(False)
    return 1 if a.strict and not out.filter(wrong).isEmpty() else 0


if __name__ == "__main__":
    raise SystemExit(main())
