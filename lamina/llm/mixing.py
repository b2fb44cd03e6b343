"""Mixing sources to target weights by min-cost flow.

Documents are counted by membership pattern (the set of sources that hold them).
A flow network routes words from patterns, through one arc for each use of a
pattern with a cost that rises with the use, to the sources' quotas; its size
depends on patterns and sources only. Within a pattern, whole uses go to every
document and the rest to documents in the order of a seeded hash.

The order is never sorted whole: counts by the leading bits of the hash are
refined where the words left end until at most `leaf` documents are left, which the
driver fits one by one; then it goes on behind them with what still fits. So any
pattern may hold most of the corpus, and of a pattern's quota fewer words stay open
than its smallest document has that is left out.

Defined results: a null text has size 0; a null source is a source of its own
and comes last; documents with equal key and text are taken or left together at
the quota's end; an empty table gives an empty result; other columns are kept
with `keep` unless they clash with an output.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from itertools import cycle

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import WORD, Tables, materialize

#: Fixed by the contract.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Cost of a word's first, second … use: convex, so that nothing repeats while other words are left.
COSTS = (0, 1, 3, 7)
DIGIT, LEAF, MAX_PATTERNS = 9, 4096, 10_000
OUTPUTS = ("size", "source_size", "target", "taken")


def targets(sizes: dict, total: float, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict:
    """Targets by weight, each at most `most` times its source's size; what is cut off is shared again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = dict(zip(order, cycle(weights), strict=False))
    out, free, left = {}, list(order), share * total
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def min_cost_flow(capacity: dict, members: dict, quota: dict, uses: int = MOST) -> dict:
    """Words from each pattern to each source: as many as the quotas and `uses` of each pattern allow, at least cost.

    Successive shortest paths with potentials over whole numbers of words.
    """
    nodes: dict = {}
    node = lambda x: nodes.setdefault(x, len(nodes))
    source, sink = node("source"), node("sink")
    to, room, cost, arcs = [], [], [], {}

    def arc(a: int, b: int, c: int, w: int) -> int:
        for x, y, z, v in ((a, b, c, w), (b, a, 0, -w)):
            arcs.setdefault(x, []).append(len(to))
            to.append(y), room.append(z), cost.append(v)
        return len(to) - 2

    routes = {}
    for p in sorted(capacity):
        for k in range(uses):
            arc(source, node(("p", p)), capacity[p], COSTS[k])
        for s in members[p]:
            routes[p, s] = arc(node(("p", p)), node(("s", s)), uses * capacity[p], 0)
    for s, q in quota.items():
        arc(node(("s", s)), sink, q, 0)
    potential = [0] * len(nodes)
    while True:
        far, via = [float("inf")] * len(nodes), [-1] * len(nodes)
        far[source], heap = 0, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in arcs.get(a, ()):
                if room[e] > 0 and (x := d + cost[e] + potential[a] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], via[to[e]] = x, e
                    heapq.heappush(heap, (x, to[e]))
        if far[sink] == float("inf"):
            return {r: room[e ^ 1] for r, e in routes.items() if room[e ^ 1]}
        potential = [p + (d if d < float("inf") else 0) for p, d in zip(potential, far, strict=True)]
        path, a = [], sink
        while a != source:
            path.append(via[a])
            a = to[via[a] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


def _end(sized: DataFrame, quota: dict[str, int], leaf: int) -> tuple[dict[str, list], dict[str, list]]:
    """Per pattern: (first hash, last hash, most) where every document of at most that size is taken, and further (hash, size) that are.

    Documents are taken in the order of their hash if they fit in the words left, as
    if each was tried. A round counts those that may fit by one more digit of their
    hash: 2**DIGIT rows for each pattern at most come to the driver. Digits that fit
    are taken whole; the first other one is refined until `leaf` documents are left,
    which the driver tries. What is then left goes on behind them.
    """
    spark = sized.sparkSession
    spans, chosen, rest = ({p: [] for p in quota} for _ in range(3))
    over = dict(quota)
    state = {p: (0, 0, 63, q) for p, q in quota.items() if q > 0}  # first hash, prefix, bits below it, words left
    if not state:
        return spans, chosen
    groups = materialize(sized.filter("size > 0").groupBy("pattern", "hash", "size").agg(F.sum("size").alias("total")))

    def near(states: dict[str, tuple]) -> DataFrame:
        at = spark.createDataFrame([(p, *s) for p, s in states.items()], "pattern string, start long, prefix long, bits int, left long")
        return groups.join(F.broadcast(at), "pattern").filter(F.expr("size <= left AND hash >= start AND shiftright(hash, bits) = prefix"))

    def behind(p: str, prefix: int, bits: int, left: int) -> None:
        over[p] = left
        if left and (start := (prefix + 1) << bits) < 1 << 63:
            state[p] = (start, 0, 63, left)

    while state:
        digits = near(state).groupBy("pattern", F.expr(f"shiftright(hash, bits - {DIGIT}) - shiftleft(prefix, {DIGIT})").alias("digit")).agg(
            F.sum("total").alias("size"), F.count_if(F.expr("total <= left")).alias("n")
        )
        rows: dict[str, list] = {p: [] for p in state}
        for r in digits.collect():
            rows[r["pattern"]].append((r["digit"], r["size"], r["n"]))
        leaves = {}
        for p, found in rows.items():
            start, prefix, bits, left = at = state.pop(p)
            if 0 < sum(n for *_, n in found) <= leaf:
                leaves[p] = at
                continue
            most, run, low = left, False, bits - DIGIT
            for digit, size, n in sorted(found):
                inner = (prefix << DIGIT) + digit
                if size <= left:
                    first = spans[p].pop()[0] if run else max(start, inner << low)
                    spans[p].append((first, ((inner + 1) << low) - 1, most))
                    run, left = True, left - size
                elif n:
                    (leaves if n <= leaf or low < DIGIT else state)[p] = (start, inner, low, left)
                    break
                else:  # nothing in it fits
                    run = False
            else:
                behind(p, prefix, bits, left)
        if leaves:
            tried: dict[str, list] = {p: [] for p in leaves}
            for r in near(leaves).filter("total <= left").select("pattern", "hash", "size", "total").collect():
                tried[r["pattern"]].append((r["hash"], r["size"], r["total"]))
            for p, (_, prefix, bits, left) in leaves.items():
                for r in sorted(tried[p]):
                    (chosen if r[2] <= left else rest)[p].append(r)
                    left -= r[2] if r[2] <= left else 0
                behind(p, prefix, bits, left)
    return spans, {p: _exchange(chosen[p], rest[p], over[p]) for p in quota}


def _exchange(took: list[tuple], rest: list[tuple], left: int) -> list[tuple]:
    """Once exchanges one that was taken for another that was tried and fits better."""
    rest = sorted(rest, key=lambda r: r[2])
    lengths, best = [r[2] for r in rest], (0, None, None)
    for r in took:
        k = bisect_right(lengths, r[2] + left) - 1
        if k >= 0 and lengths[k] - r[2] > best[0]:
            best = (lengths[k] - r[2], r, rest[k])
    if best[1]:
        took = [r for r in took if r is not best[1]] + [best[2]]
    return [r[:2] for r in took]


def source_of(mark: str) -> str | None:
    """The source that a mark in a pattern stands for."""
    return None if mark == "~" else re.sub("\x02(.)", lambda m: "\x01" if m[1] == "-" else "\x02", mark[1:])


def mix(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, seed: int = 17, leaf: int = LEAF) -> DataFrame:
    """`key`, the columns `keep`, size, source_size, target (of the first source in its pattern) and taken.

    sources: an array of the sources that hold the document.
    """
    keep = [c for c in (keep or []) if c != key and c not in OUTPUTS]
    size = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    # all sources get an s in front, and marks of their own doubled; "~" stands for the null source and comes last
    marked = lambda x: F.concat(F.lit("s"), F.replace(F.replace(x, F.lit("\x02"), F.lit("\x02\x02")), F.lit("\x01"), F.lit("\x02-")))
    pattern = F.array_join(F.array_sort(F.array_distinct(F.transform(sources, lambda x: F.coalesce(marked(x), F.lit("~"))))), "\x01")
    # rows without a key, or of one key, are told apart by their texts
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{text}`")), 1)
    rows = docs.select(F.col(f"`{key}`").alias("key"), *[F.col(f"`{c}`").alias(f"_{c}") for c in keep], size.alias("size"), pattern.alias("pattern"), hashed.alias("hash"), F.monotonically_increasing_id().alias("at"))
    with Tables() as tables:
        sized = materialize(rows.select("key", "size", "pattern", "hash", "at"))
        again = materialize(sized.filter("size > 0").groupBy("pattern", "hash", "size").agg(F.count("*").alias("copies")).filter("copies > 1"))
        if not again.isEmpty():  # rows of equal key and text get places of their own, by where they stand
            tables.keep(again)
            apart = lambda df: df.join(again, ["pattern", "hash", "size"], "left").withColumn("hash", F.when(F.col("copies").isNull(), F.col("hash")).otherwise(F.shiftrightunsigned(F.xxhash64("hash", "at"), 1))).drop("copies")
            rows, sized = apart(rows), materialize(apart(sized))
        if not keep:  # rows with other columns are read again: they may hold the whole texts
            rows = tables.keep(sized)
        totals = sized.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
        if len(totals) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
        capacity = {r["pattern"]: r["size"] for r in totals}
        members = {p: [source_of(s) for s in p.split("\x01")] if p else [] for p in capacity}
        sizes: dict = {}
        for p, n in capacity.items():
            for s in members[p]:
                sizes[s] = sizes.get(s, 0) + n
        goal = targets(sizes, sum(capacity.values()))
        flow = min_cost_flow(capacity, members, {s: round(t) for s, t in goal.items()})
        words = {p: 0 for p in capacity}
        for (p, _), n in flow.items():
            words[p] += n
        whole = {p: words[p] // capacity[p] if capacity[p] else 0 for p in capacity}
        spans, chosen = _end(sized.select("size", "pattern", "hash"), {p: words[p] - whole[p] * capacity[p] for p in capacity}, leaf)
    planned = [(p, whole[p], spans[p], sizes[members[p][0]] if members[p] else None, goal[members[p][0]] if members[p] else None) for p in sorted(capacity)]
    plan = docs.sparkSession.createDataFrame(planned, "pattern string, whole long, spans array<struct<first:long,last:long,most:long>>, source_size long, target double")
    ends = docs.sparkSession.createDataFrame([(p, h, n) for p, c in chosen.items() for h, n in c], "pattern string, hash long, size long").distinct().withColumn("end", F.lit(1))
    # plan: one row for each pattern; ends: `leaf` rows for each pattern and end of a span at most
    out = rows.join(F.broadcast(plan), "pattern").join(F.broadcast(ends) if len(planned) <= 100 else ends, ["pattern", "hash", "size"], "left")
    inside = F.exists("spans", lambda s: F.col("hash").between(s["first"], s["last"]) & (F.col("size") <= s["most"]))
    taken = F.col("size") * (F.col("whole") + F.when(inside, 1).otherwise(F.coalesce("end", F.lit(0))))
    return out.select(F.col("key").alias(key), *[F.col(f"_{c}").alias(c) for c in keep], "size", "source_size", "target", taken.alias("taken"))
