"""Patterns as data: applied to names, learned from samples of a folder's names, and refined where too few match."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.functions.scalar import clean, normalize_id
from lamina.sources.snapshots import written

#: Seconds that a pattern may take on one name.
SECONDS = 1.0
#: Names that a pattern is learned from; the share of names from which it is good enough; further attempts.
SAMPLES, ENOUGH, ATTEMPTS = 20, 0.7, 2
FIELD = "specimen_id"


@lru_cache(1 << 14)
def _compiled(pattern: str) -> regex.Pattern | str:
    try:
        return regex.compile(pattern, regex.IGNORECASE)
    except regex.error as e:
        return f"bad pattern: {e}"


def _one(pattern: str | None, name: str | None, field: str) -> tuple[bool, dict | None, str | None, str | None]:
    """(matched, named groups with a value, the field, error)."""
    if pattern is None or name is None:
        return False, None, None, None
    p = _compiled(pattern)
    if isinstance(p, str):
        return False, None, None, p
    try:
        m = p.search(name, timeout=SECONDS)
    except TimeoutError:
        return False, None, None, f"pattern took more than {SECONDS:g} s"
    if m is None:
        return False, None, None, None
    groups = {k: v for k, v in m.groupdict().items() if v}
    value = m.group(field) if field in p.groupindex else m.group(1) if p.groups else m.group(0)
    return True, groups, value, None


def apply(names: DataFrame, pattern: str, name: str, field: str = FIELD) -> DataFrame:
    """Names with matched, groups, value and error of the pattern that stands beside each.

    Patterns are in Python's syntax, whatever their case. value: the group `field`, if there is one, else the first group,
    else the whole match. A null pattern or name matches nothing; a broken pattern, or one that takes too long on a name, gives an
    error in that row and ends no job. A task compiles each pattern once.
    """
    fixed = ["matched", "groups", "value", "error"]
    rest = [c for c in names.columns if c not in fixed]
    whole = names.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.col(pattern).alias("_p"), F.col(name).alias("_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_one(p, n, field) for p, n in zip(batch.column("_p").to_pylist(), batch.column("_n").to_pylist(), strict=True)]
            cells = [[g[k] for g in got] for k in range(4)]
            groups = pa.array([None if g is None else list(g.items()) for g in cells[1]], pa.map_(pa.string(), pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(cells[0], pa.bool_()), groups, pa.array(cells[2], pa.string()), pa.array(cells[3], pa.string())], names=["_row", *fixed])

    out = whole.mapInArrow(run, f"_row {whole.schema['_row'].dataType.simpleString()}, matched boolean, groups map<string,string>, value string, error string")
    return out.select(*[F.col(f"_row.`{c}`") for c in rest], *fixed)


def stored(names: DataFrame, patterns: DataFrame, folder: str, name: str, field: str = FIELD) -> DataFrame:
    """Names with what the pattern of their folder finds in them; patterns: (folder, pattern), one for each folder."""
    return apply(names.join(patterns.select(folder, "pattern"), folder, "left"), "pattern", name, field).drop("pattern")


def normalized(rows: DataFrame) -> DataFrame:
    """Rows of `apply` with their value as an identifier PREFIX-NUMBER[-plate], put together from the groups where there is none, null if it has no number."""
    pick = lambda *names: F.coalesce(*[clean(F.try_element_at("groups", F.lit(n))) for n in names])
    parts = F.concat_ws("-", pick("prefix", "specimen_prefix", "collection"), pick("number", "numeric", "id", "specimen_number"), pick("plate", "p"))
    told = F.when(pick("prefix", "specimen_prefix", "collection").isNotNull() & pick("number", "numeric", "id", "specimen_number").isNotNull(), parts)
    return rows.withColumn("value", F.coalesce(normalize_id(F.col("value")), normalize_id(told)))


# --- learning

_RUNS = regex.compile(r"[^\W\d_]+|\d+|[\W_]")


def _signature(name: str) -> tuple[tuple[str, str], ...]:
    """Runs of letters (L) and digits (D), and other characters each for itself (S)."""
    kind = lambda t: "D" if t.isdigit() else "L" if t[0].isalpha() else "S"
    return tuple((kind(t), t) for t in _RUNS.findall(name))


def learn(names: list[str], loose: int = 0) -> str | None:
    """A pattern with the group specimen_id for names of one make; null without a name that has a digit.

    The commonest sequence of runs is written down position by position: what all such names have in common stays as it is, other runs become
    classes. The group reaches from the run of letters before the digits that differ most to a plate of one or two letters behind them. loose 1: letters and
    separators are classes whatever they have in common. loose 2: any letters, a separator and digits, anywhere in the name.
    """
    names = [n for n in names if n and any(c.isdigit() for c in n)]
    if not names:
        return None
    if loose >= 2:
        return rf"(?P<{FIELD}>(?:[^\W\d_]+[\s_\-#]*)?\d+)"
    made = [_signature(n) for n in names]
    shape, _ = Counter(tuple(k for k, _ in s) for s in made).most_common(1)[0]
    same = [s for s in made if tuple(k for k, _ in s) == shape]
    columns = [[s[i][1] for s in same] for i in range(len(shape))]
    digits = [i for i, k in enumerate(shape) if k == "D"]
    if not digits:
        return None
    number = max(digits, key=lambda i: (len(set(columns[i])), max(map(len, columns[i])), -i))
    first = number
    if number and shape[number - 1] == "L":
        first = number - 1
    elif number > 1 and shape[number - 1] == "S" and shape[number - 2] == "L" and set(columns[number - 1]) <= set(" _-#"):
        first = number - 2
    last = number
    for gap in (1, 2):
        at = number + gap
        if at < len(shape) and shape[at] == "L" and (gap == 1 or set(columns[at - 1]) <= set(" _-")) and max(map(len, columns[at])) <= 2:
            last = at
            break

    def written_as(i: int) -> str:
        kind, seen = shape[i], set(columns[i])
        if kind == "D":
            return r"\d+"
        if len(seen) == 1 and not loose:
            return regex.escape(columns[i][0], special_only=True)
        return r"[^\W\d_]+" if kind == "L" else r"[\W_]"

    parts = [written_as(i) for i in range(len(shape))]
    return "^" + "".join(parts[:first]) + f"(?P<{FIELD}>" + "".join(parts[first : last + 1]) + ")" + "".join(parts[last + 1 :]) + "$"


def _learned(samples: DataFrame, folder: str, loose: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([learn(n, loose) for n in batch.column(1).to_pylist()], pa.string())], names=[folder, "pattern"])

    kind = samples.schema[folder].dataType.simpleString()
    return samples.select(folder, "names").mapInArrow(run, f"`{folder}` {kind}, pattern string")


def _sampled(names: DataFrame, folder: str, name: str, *first: Column) -> DataFrame:
    """(folder, names): `SAMPLES` distinct names of each folder, `first` ones before others, then by hash."""
    order = W.partitionBy(folder).orderBy(*first, F.xxhash64(name), name)
    few = names.groupBy(folder, name).agg(F.max("matched").alias("matched")) if "matched" in names.columns else names.select(folder, name).distinct()
    # the limit is known to the plan, so no task sends more of a folder than it needs
    return few.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= SAMPLES).groupBy(folder).agg(F.sort_array(F.collect_list(name)).alias("names"))


def induce(names: DataFrame, folder: str, name: str) -> DataFrame:
    """(folder, pattern, attempt, n, n_matched, rate) of all folders: a pattern for each, from samples of its names, and the share of all its names that it matches.

    Where fewer than `ENOUGH` match, but some do, a looser one is learned from the names that did not, up to `ATTEMPTS` times;
    of all attempts the best stays, the first on ties. Names are looked at once for each attempt, in the folders that need one.
    """
    live, done = written(names.select(folder, name).filter(F.col(folder).isNotNull() & F.col(name).isNotNull())), None
    samples = _sampled(live, folder, name)
    for attempt in range(ATTEMPTS + 1):
        patterns = written(_learned(samples, folder, attempt))
        tried = apply(live.select(folder, name).join(patterns, folder), "pattern", name)
        tried = written(tried.select(folder, name, "pattern", "matched"))
        rates = written(tried.groupBy(folder).agg(F.min("pattern").alias("pattern"), F.lit(attempt).alias("attempt"), F.count("*").alias("n"), F.count_if("matched").alias("n_matched")))
        done = rates if done is None else done.unionByName(rates)
        # none at all matched: another attempt has nothing to go by, unless the pattern was too narrow to begin with
        again = rates.filter((F.col("n_matched") < ENOUGH * F.col("n")) & (F.col("n_matched") > 0))
        if attempt == ATTEMPTS or again.isEmpty():
            break
        live = written(tried.join(again.select(folder), folder, "left_semi"))
        samples = _sampled(live, folder, name, F.col("matched"))
    best = done.groupBy(folder).agg(F.max_by(F.struct("pattern", "attempt", "n", "n_matched"), F.struct("n_matched", -F.col("attempt"))).alias("b"))
    return best.select(folder, "b.*").withColumn("rate", F.col("n_matched") / F.col("n"))
