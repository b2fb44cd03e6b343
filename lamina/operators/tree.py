"""Trees of links and of folders: roots of chains, nearest listed ancestors, folders that a move leaves empty."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.scalar import parent
from lamina.sources.snapshots import written

#: Rows of a table of listed folders that are sent to every task, at most; beyond it they are shuffled.
MOST_SENT = 100_000


def roots(links: DataFrame, key: str, of: str) -> DataFrame:
    """(key, root, steps) of all rows with a link: where its chain of links ends, and how many links that is.

    Each key has one link at most; null links, links to itself and repeated ones do not count. Pointers are
    doubled: every round lets each row point where its target points, so a chain of n links takes log2(n) rounds.
    In a circle the least key is the root of all that leads into it, with steps of -1.
    """
    live = links.filter(F.col(key).isNotNull() & F.col(of).isNotNull() & (F.col(key) != F.col(of))).groupBy(key).agg(F.min(of).alias(of))
    live = written(live.select(key, F.col(of).alias("at"), F.lit(1).cast("long").alias("steps"), F.least(key, of).alias("low")))
    rounds = 2 + math.ceil(math.log2(max(2, live.count())))
    for _ in range(rounds):
        goes_on = live.select(F.col(key).alias("at"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("low").alias("_low"))
        step = live.join(goes_on, "at", "left")
        step = step.select(key, F.coalesce("_at", "at").alias("at"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), F.least("low", F.coalesce("_low", F.col("low"))).alias("low"), F.col("_at").isNotNull().alias("moved"))
        step = written(step)
        live = step.drop("moved")
        if step.filter("moved").isEmpty():
            return live.select(key, F.col("at").alias("root"), "steps")
    # what still moves leads into a circle; its pointer is on it, and that one's least key is the circle's
    circle = live.select(F.col(key).alias("at"), F.col("low").alias("_low"))
    out = live.join(circle, "at", "left")
    return out.select(key, F.coalesce("_low", "at").alias("root"), F.when(F.col("_low").isNull(), F.col("steps")).otherwise(-1).alias("steps"))


def ancestors(folder: Column) -> Column:
    """A folder and all above it, deepest first, with forward slashes; of /a/b: /a/b, /a and the root, an empty text."""
    parts = F.split(F.rtrim(F.replace(folder, F.lit("\\"), F.lit("/")), F.lit("/")), "/")
    up = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(F.element_at(up, -1) == "", up).otherwise(F.concat(up, F.array(F.lit(""))))


def depth(folder: Column) -> Column:
    return F.size(ancestors(folder)) - 1


def nearest(rows: DataFrame, folder: str, listed: DataFrame, at: str) -> DataFrame:
    """Rows with the columns of the nearest folder that is listed, itself or above it, and its depth as `_depth`; nulls without one.

    listed: one row for each folder `at` ("" stands for the root). Only distinct folders are
    matched with what is above them; rows then take what their folder has found. Up to `MOST_SENT` counted listed
    folders go to every task; more are shuffled, where a common ancestor's rows are split as Spark splits skewed joins.
    """
    known = listed.select(F.regexp_replace(F.replace(F.col(at), F.lit("\\"), F.lit("/")), "/+$", "").alias("_at"), F.struct(*[F.col(c) for c in listed.columns if c != at]).alias("_own"))
    small = known.limit(MOST_SENT + 1).count() <= MOST_SENT
    sent = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    places = rows.select(F.col(folder).alias("_f")).filter(F.col("_f").isNotNull()).distinct().select("_f", F.explode(ancestors(F.col("_f"))).alias("_at"))
    best = places.join(sent(known), "_at").groupBy("_f").agg(F.max_by(F.struct("_at", "_own"), F.length("_at")).alias("_best"))
    out = rows.join(best, rows[folder] == best["_f"], "left")
    more = [F.col(f"_best._own.`{c}`").alias(c) for c in listed.columns if c != at]
    return out.select(*[rows[c] for c in rows.columns], F.col("_best._at").alias("_nearest"), depth(F.col("_best._at")).alias("_depth"), *more)


def folder_sizes(files: DataFrame, path: str, root: str) -> DataFrame:
    """(folder, depth, own, below): files in each folder below `root` (itself included), and in all that it holds.

    Files are counted by folder before anything is said about the folders above, so a folder of many files is one row.
    """
    root = root.rstrip("/")
    inside = files.filter(F.col(path).startswith(root + "/"))
    own = inside.groupBy(parent(F.col(path)).alias("_f")).agg(F.count("*").alias("own"))
    cells = own.select(F.explode(ancestors(F.col("_f"))).alias("folder"), "own", "_f").filter((F.length("folder") >= len(root)) & F.col("folder").startswith(root))
    out = cells.groupBy("folder").agg(F.sum(F.when(F.col("folder") == F.col("_f"), F.col("own")).otherwise(0)).alias("own"), F.sum("own").alias("below"))
    return out.select("folder", depth(F.col("folder")).alias("depth"), "own", "below")


def emptied(files: DataFrame, moved: DataFrame, path: str, root: str) -> DataFrame:
    """(folder, depth, n) of folders below `root` in which no file is left once `moved` are gone, deepest first, then by name.

    In this order each folder can be removed when its turn comes: what it held has gone before it. `root` itself stays.
    """
    gone = moved.select(path).distinct().withColumn("_gone", F.lit(True))
    tagged = files.join(gone, path, "left")
    whole = folder_sizes(tagged, path, root).select("folder", "depth", F.col("below").alias("n"))
    left = folder_sizes(tagged.filter("_gone IS NULL"), path, root).select("folder", F.col("below").alias("_left"))
    out = whole.join(left, "folder", "left").filter(F.col("_left").isNull() & (F.col("folder") != root.rstrip("/")))
    return out.select("folder", "depth", "n").orderBy(F.desc("depth"), "folder")

