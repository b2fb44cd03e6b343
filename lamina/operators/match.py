"""Matching of a staged batch against a registry, field merges, audits by anti-join."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.scalar import clean


def cascade(candidates: list[DataFrame], staged: str, found: str, order: str) -> DataFrame:
    """First match of each staged row: candidates in the order given, then by `order`.

    A minimum of structs combines before the shuffle, where a ranking window would not.
    """
    rows = None
    for k, c in enumerate(candidates):
        part = c.select(F.col(staged), F.struct(F.lit(k).alias("step"), F.col(order).alias("ordinal"), F.col(found).alias("found")).alias("m"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(staged).agg(F.min("m").alias("m")).select(staged, F.col("m.step").alias("step"), F.col("m.found").alias(found))


def merge_field(existing: Column, staged: Column, longer: bool = False) -> Column:
    """(value, is a conflict): gaps are filled; of comments the longer stays, the existing one on ties."""
    a, b = clean(existing), clean(staged)
    differ = a.isNotNull() & b.isNotNull() & (a != b)
    value = F.when(differ & F.lit(longer) & (F.length(b) > F.length(a)), b).otherwise(F.coalesce(a, b))
    return F.struct(value.alias("value"), (differ & F.lit(not longer)).alias("conflict"))


def merge_registries(existing: DataFrame, staged: DataFrame, key: str, fields: dict[str, bool], same: Callable[[Column], Column] | None = None, others: bool = False, skip: tuple[str, ...] = ()) -> DataFrame:
    """Full outer merge by key; fields: name to whether it is a comment. Rows carry where they come from and their conflicts.

    same: what is made of keys before they are compared (the existing one is kept as it is). others: further columns of either side stay, the existing
    value first, a side that lacks one filling nothing in, but for those in `skip`. Null keys match nothing. Keys are expected once on each side.
    """
    e, s = existing.alias("e"), staged.alias("s")
    norm = same or (lambda c: c)
    both = e.join(s, norm(F.col(f"e.{key}")) == norm(F.col(f"s.{key}")), "full_outer")
    merged = {f: merge_field(F.col(f"e.{f}").cast("string"), F.col(f"s.{f}").cast("string"), c) for f, c in fields.items()}
    origin = F.when(F.col(f"s.{key}").isNull(), "existing").when(F.col(f"e.{key}").isNull(), "new").otherwise("both")
    n = sum((F.coalesce(m["conflict"].cast("int"), F.lit(0)) for m in merged.values()), F.lit(0))
    more = [c for c in dict.fromkeys([*existing.columns, *staged.columns]) if c != key and c not in fields and c not in skip] if others else []
    of = lambda c: F.coalesce(*[F.col(f"{t}.{c}") for t, df in (("e", existing), ("s", staged)) if c in df.columns])
    return both.select(F.coalesce(f"e.{key}", f"s.{key}").alias(key), origin.alias("origin"), *[m["value"].alias(f) for f, m in merged.items()], n.alias("n_conflicts"), *[of(c).alias(c) for c in more])


def integrity(main: DataFrame, hashes: DataFrame, key: str) -> DataFrame:
    """Keys only in one of the two tables, with the side that lacks them."""
    a = main.join(hashes, key, "left_anti").select(key, F.lit("no_hash").alias("problem"))
    return a.unionByName(hashes.join(main, key, "left_anti").select(key, F.lit("no_row").alias("problem")))


def preservation(sources: dict[str, DataFrame], merged: DataFrame, key: str) -> DataFrame:
    """Whether a merge kept what its sources had: distinct keys, those missing, and those that are new."""
    tagged = None
    for df in sources.values():
        part = df.select(key)
        tagged = part if tagged is None else tagged.union(part)
    both = tagged.distinct().withColumn("a", F.lit(1)).join(merged.select(key).distinct().withColumn("b", F.lit(1)), key, "full_outer")
    out = both.agg(F.count("a").alias("n_sources"), F.count("b").alias("n_merged"), F.count_if(F.col("b").isNull()).alias("n_missing"), F.count_if(F.col("a").isNull()).alias("n_new"))
    return out.withColumn("preserved", F.col("n_missing") == 0)


def numbered(df: DataFrame, *order: Column | str, start: int = 0) -> DataFrame:
    """Row numbers (rn, from start + 1) in a total order, without gathering the rows in one task.

    Borders are taken once from a sample; rows are dealt to the ranges between
    them by their order only, so a count and a numbering that run at different times agree.
    Ranges have one task each; a tie never spans two. Rows that are equal in `order`
    are told apart by all their other columns; wholly equal rows take neighbouring numbers.
    """
    spark = df.sparkSession
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    lead = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_k", lead)
    spots = keyed.select("_k", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("_h"))
    # the rows with the least hashes are a sample of fixed size that every run draws alike
    sample = spots.orderBy("_h").limit(64 * parts).select("_k").distinct()
    ranks = sample.select("_k", F.row_number().over(W.orderBy("_k")).alias("_r"), F.count("*").over(W.partitionBy()).alias("_n"))  # 64 rows for each partition at most
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / parts))
    borders = ranks.filter(F.col("_r") % step == 0).agg(F.sort_array(F.collect_list("_k")).alias("_b"))
    # one row, beside each row of the table
    dealt = keyed.withColumn("_one", F.lit(1)).join(F.broadcast(borders.withColumn("_one", F.lit(1))), "_one")
    dealt = dealt.withColumn("_p", F.size(F.filter("_b", lambda x: x < F.col("_k")))).drop("_b", "_one")
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_c"))
    base = sizes.select("_p", (F.sum("_c").over(W.orderBy("_p")) - F.col("_c") + start).alias("_base"))  # one row for each range
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])
    inner = F.row_number().over(W.partitionBy("_p").orderBy("_k", rest))
    out = dealt.withColumn("_i", inner).join(F.broadcast(base), "_p")
    return out.withColumn("rn", F.col("_i") + F.col("_base")).select(*df.columns, "rn")


def unique_names(df: DataFrame, name: str, key: str, folder: str | None = None, taken: DataFrame | None = None, mark: str = "_") -> DataFrame:
    """(key, unique_name): names made unique within `folder` by <mark>1, <mark>2 … before the suffix, in the order of the key.

    taken: (folder and) names that are there already. A number is skipped where the
    name with it is itself in use: by `taken`, or by a row of that very name. Rows are
    numbered by ranges of their order, so a name that most rows have is dealt over many tasks.
    """
    at = [folder] if folder else []
    order = numbered(df.select(key, *at, name), *at, name, key)
    first = order.groupBy(*at, name).agg(F.min("rn").alias("_first"))
    o, f = order.alias("o"), first.alias("f")
    marked = o.join(f, reduce(lambda x, y: x & y, [F.col(f"o.{c}").eqNullSafe(F.col(f"f.{c}")) for c in [*at, name]])).select("o.*", (F.col("rn") - F.col("_first") + 1).alias("_k")).drop("rn")
    kept = marked.filter("_k = 1").select(*at, name)
    used = kept if taken is None else kept.unionByName(taken.select(*at, name))
    if taken is not None:  # the first of a taken name needs a number too
        there = taken.select(*at, name).distinct().withColumn("_taken", F.lit(True))
        marked = marked.join(there, [*at, name], "left").withColumn("_n", F.col("_k") - F.when(F.col("_taken"), 0).otherwise(1)).drop("_taken")
        used = used.distinct()
    else:
        marked = marked.withColumn("_n", F.col("_k") - 1)
    # names in use that look like <stem><mark><number><suffix> close that number for their stem
    shape = rf"^(.*){re.escape(mark)}([1-9][0-9]{{0,8}})(\.[^.]*)?$"
    closed = used.filter(F.col(name).rlike(shape)).select(*at, F.concat(F.regexp_extract(name, shape, 1), F.regexp_extract(name, shape, 3)).alias(name), F.regexp_extract(name, shape, 2).try_cast("long").alias("no"))
    closed = closed.groupBy(*at, name).agg(F.sort_array(F.collect_set("no")).alias("_closed"))
    rows = marked.join(closed, [*at, name], "left")
    # the n-th number that is open: each closed one that is not above moves it on by one
    moved = F.aggregate(F.coalesce("_closed", F.array().cast("array<bigint>")), F.col("_n").cast("long"), lambda n, c: F.when(c <= n, n + 1).otherwise(n))
    numbered_name = F.concat(F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1), F.lit(mark), moved.cast("string"), F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 2))
    return rows.select(key, *at, F.when(F.col("_n") > 0, numbered_name).otherwise(F.col(name)).alias("unique_name"))
