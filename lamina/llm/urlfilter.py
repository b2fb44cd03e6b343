"""URL filters: dated list entries become validity intervals, which an as-of join holds against each capture.

1. Entries (list, verdict, pattern, at, listed) say that from `at` on a pattern is
   on a list or no longer on it. Their changes of state give intervals [since,
   until), which do not overlap for one pattern of one list.
2. A pattern is a host name, which covers its subdomains, or a host name with a
   path, which covers that path and all below it. A URL yields the keys that could
   be listed: its host, the parents of it, and its path prefixes, no longer than the
   longest pattern of the lists (longer keys cannot match).
3. Intervals are cut at the borders of PERIODS equal periods of the captures' times,
   so the as-of join is an equality of key and period with a comparison inside it.
   Intervals are broadcast if they are measured to be small. Otherwise keys of very
   many captures are split off and meet their own intervals by broadcast, if those
   are measured to be small; the rest shuffles.
4. Of the active entries of a capture the most specific decides: a path before a
   host, the longer pattern before the shorter, allow before block.

Everything is DataFrame functions. Defined results: a null or relative URL has a
null host and no entries; a null time is no time, at which nothing is active; entries
with a null field or without a host are ignored; of entries at one moment a removal
wins; repeated captures each get a row, repeated entries count once; empty tables
give no rows or no matches; an input column with a result's name gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.shared import materialize

#: The host of a URL, after any user name; and its path.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
#: Hosts without parents: addresses.
ADDRESS = r"^(\[.*|[0-9.]+)$"
#: Periods of the as-of join, and the measured bytes up to which intervals are broadcast.
PERIODS, BROADCAST_BYTES = 64, 32 << 20
#: Captures of a key from which it counts as hot, and the most keys that are split off.
HOT, MOST_HOT = 1_000_000, 1_000
#: Bytes of an interval besides its strings.
FIXED_BYTES = 96
RESULTS = ["host", "n_active", "lists", "rule", "rule_list", "blocked"]


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot, or null."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")
    return F.when(host != "", host)


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def normal(pattern: Column) -> Column:
    """host or host/path, as the keys of URLs are written."""
    host = F.regexp_replace(F.lower(F.split_part(pattern, F.lit("/"), F.lit(1))), r"\.$", "")
    return F.when(host != "", F.concat_ws("/", host, segments(F.regexp_extract(pattern, "^[^/]*(.*)$", 1))))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, key, since, until) for which a pattern is listed; until is null for those still listed."""
    rows = entries.select("list", F.lower("verdict").alias("verdict"), normal(F.col("pattern")).alias("key"), F.col("at").cast("timestamp").alias("at"), "listed")
    rows = rows.dropna().groupBy("list", "verdict", "key", "at").agg(F.min("listed").alias("listed"))
    turn = Window.partitionBy("list", "verdict", "key").orderBy("at")
    changes = rows.withColumn("was", F.coalesce(F.lag("listed").over(turn), F.lit(False))).filter(F.col("was") != F.col("listed"))
    return changes.withColumn("until", F.lead("at").over(turn)).filter("listed").select("list", "verdict", "key", F.col("at").alias("since"), "until")


def keys_of(host: Column, url: Column, labels: int, depth: int) -> Column:
    """All keys of a URL of at most that many host labels or path segments; the host itself is always one."""
    parts, path = F.split(host, r"\."), segments(F.regexp_extract(url, PATH, 1))
    n = F.when(host.rlike(ADDRESS), 1).otherwise(F.size(parts))
    deepest = F.least(F.size(path), F.lit(depth))
    # the least number of labels left away for a parent is what makes it as short as the longest pattern
    first = F.greatest(F.lit(1), n - labels)
    parents = F.when(first < n, F.transform(F.sequence(first, n - 1), lambda k: F.array_join(F.slice(parts, k + 1, F.size(parts)), "."))).otherwise(F.array())
    below = F.when(deepest > 0, F.transform(F.sequence(F.lit(1), deepest), lambda k: F.concat_ws("/", host, F.slice(path, F.lit(1), k)))).otherwise(F.array())
    return F.concat(F.array(host), parents, below)


def _bytes(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.octet_length("key") + F.octet_length("list") + F.octet_length("verdict") + FIXED_BYTES)).first()[0] or 0


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched", broadcast_bytes: int = BROADCAST_BYTES, hot: int = HOT) -> DataFrame:
    """The captures with host, n_active, lists (comma-joined), the deciding rule and its list, and blocked."""
    kept = [c for c in captures.columns if c not in RESULTS]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    link, time = F.col(f"`{url}`").cast("string"), F.unix_micros(F.col(f"`{at}`").cast("timestamp"))
    # numbered once, in a table, so that the number holds when a task runs again
    rows = materialize(captures.select(F.monotonically_increasing_id().alias("n"), row.alias("row"), host_of(link).alias("host"), link.alias("link"), time.alias("time")))
    low, high = rows.agg(F.min("time"), F.max("time")).first()
    active = materialize(intervals(entries))
    labels, depth = active.select(F.split_part("key", F.lit("/"), F.lit(1)).alias("h"), "key").agg(F.max(F.size(F.split("h", r"\."))), F.max(F.size(F.split("key", "/")) - 1)).first()
    low, high = low or 0, high or 0
    width = (high - low) // PERIODS + 1
    period = lambda t: F.floor((t - low) / width).cast("int")
    since, until = F.unix_micros("since"), F.coalesce(F.unix_micros("until"), F.lit(high + 1))
    active = active.select("list", "verdict", "key", since.alias("since"), until.alias("until")).filter((F.col("since") <= high) & (F.col("until") > low))
    spread = F.sequence(period(F.greatest("since", F.lit(low))), period(F.least(F.col("until") - 1, F.lit(high))))
    active = active.withColumn("period", F.explode(spread))

    asked = rows.filter("host IS NOT NULL AND time IS NOT NULL")
    asked = asked.select("n", "time", period(F.col("time")).alias("period"), F.explode(keys_of(F.col("host"), F.col("link"), labels or 0, depth or 0)).alias("key"))

    def meet(some: DataFrame, listed: DataFrame) -> DataFrame:
        return some.join(listed, ["key", "period"]).filter("since <= time AND time < until").select("n", "key", "list", "verdict")

    if _bytes(active) <= broadcast_bytes:
        met = meet(asked, F.broadcast(active))
    else:
        many = materialize(asked.groupBy("key").count().filter(F.col("count") >= hot).orderBy(F.desc("count"), "key").limit(MOST_HOT).select("key"))
        apart = active.join(F.broadcast(many), "key", "left_semi")
        if _bytes(apart) <= max(broadcast_bytes, BROADCAST_BYTES):
            cold = asked.join(F.broadcast(many), "key", "left_anti")
            met = meet(asked, F.broadcast(apart)).unionByName(meet(cold, active))
        else:
            met = meet(asked, active)
    order = F.struct(F.contains("key", F.lit("/")).alias("path"), F.length("key").alias("length"), (F.col("verdict") == "allow").alias("allow"), "list", "key", "verdict")
    found = met.groupBy("n").agg(F.count("*").alias("n_active"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.max(order).alias("top"))
    out = rows.join(found, "n", "left")
    return out.select(
        "row.*", "host", F.coalesce("n_active", F.lit(0)).alias("n_active"), F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("top.key").alias("rule"), F.col("top.list").alias("rule_list"), F.coalesce(F.col("top.verdict") == "block", F.lit(False)).alias("blocked"),
    )


# The tables hold no lists and no fetch times, so the query states both by rule: a page is fetched on day
# page_id mod 365 of 2024, and a hash of each host, parent domain and first path segment tells whether, when
# and for how long it is listed.


def _digit(name: str, at: int) -> Column:
    return F.conv(F.substring(F.md5(F.col(name)), at, 2), 16, 10).cast("int")


def fetched(page: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page, F.lit(365)).cast("int"))


def stated_entries(pages: DataFrame) -> DataFrame:
    """The dated entries of the query: as many patterns as the pages have hosts, domains and sections."""
    host, path = host_of(F.col("url")), segments(F.regexp_extract("url", PATH, 1))
    entry = lambda name, verdict, pattern: F.struct(F.lit(name).alias("list"), F.lit(verdict).alias("verdict"), pattern.alias("pattern"))
    names = F.array(
        entry("hosts", "block", host),
        entry("domains", "block", F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)),
        entry("sections", "allow", F.when(F.size(path) > 0, F.concat(host, F.lit("/"), path[0]))),
    )
    names = pages.select(F.explode(names).alias("e")).select("e.*").filter("pattern <> ''").distinct()
    v, start = _digit("pattern", 1), _digit("pattern", 3)
    stop = start + _digit("pattern", 5) + 1
    change = lambda day, listed, of: F.struct(day.alias("day"), F.lit(listed).alias("listed"), F.lit(of).alias("of"))
    rows = F.filter(F.array(change(start, True, 128), change(stop, False, 64), change(stop + 30, True, 24)), lambda e: v < e["of"])
    rows = names.select("list", "verdict", "pattern", F.explode(rows).alias("e"))
    return rows.select("list", "verdict", "pattern", F.date_add(F.lit("2024-01-01").cast("date"), F.col("e.day")).alias("at"), "e.listed")


def oracle_sql() -> str:
    hexed = lambda k: f"('0x' || substr(md5(pattern), {k}, 2))::INT"
    return rf"""WITH p AS (SELECT page_id, (page_id % 365)::INT AS day, nullif(regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '\.$', ''), '') AS host,
      list_filter(string_split(regexp_extract(url, '{PATH}', 1), '/'), lambda x: x <> '') AS path FROM pages),
    names AS (SELECT DISTINCT * FROM (SELECT 'hosts' AS list, 'block' AS verdict, host AS pattern FROM p
      UNION ALL SELECT 'domains', 'block', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM p
      UNION ALL SELECT 'sections', 'allow', host || '/' || path[1] FROM p WHERE len(path) > 0) WHERE pattern <> ''),
    e AS (SELECT *, {hexed(1)} AS v, {hexed(3)} AS a, {hexed(3)} + {hexed(5)} + 1 AS b FROM names),
    i AS (SELECT list, verdict, pattern, a AS since, CASE WHEN v < 64 THEN b ELSE 100000 END AS until FROM e WHERE v < 128
      UNION ALL SELECT list, verdict, pattern, b + 30, 100000 FROM e WHERE v < 24),
    m AS (SELECT p.page_id, i.* FROM p JOIN i ON i.since <= day AND day < i.until AND
      CASE WHEN contains(pattern, '/') THEN starts_with(host || '/' || array_to_string(path, '/') || '/', pattern || '/')
      ELSE host = pattern OR (ends_with(host, '.' || pattern) AND NOT regexp_matches(host, '{ADDRESS}')) END),
    t AS (SELECT page_id, count(*) AS n_active, array_to_string(list_sort(list_distinct(list(list))), ',') AS lists,
      max({{'a': contains(pattern, '/'), 'b': length(pattern), 'c': verdict = 'allow', 'd': list, 'e': pattern, 'f': verdict}}) AS top FROM m GROUP BY page_id)
    SELECT p.page_id, strftime(DATE '2024-01-01' + p.day, '%Y-%m-%d') AS fetched_on, host, coalesce(n_active, 0)::BIGINT AS n_active, coalesce(lists, '') AS lists,
      top.e AS rule, top.d AS rule_list, coalesce(top.f = 'block', false) AS blocked FROM p LEFT JOIN t USING (page_id)"""
