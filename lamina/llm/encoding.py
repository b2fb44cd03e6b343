"""Target encoding in the order of time: how often earlier lines of other folds with the same value were returned.

History is summed up in a cube of periods: whole hours before a line's own by cumulative sums over the cube, which
lines join by key and hour; what stands before the line in its own hour by running sums over its microseconds. Hours with more
than `MOST` lines are cut into minutes, those into seconds, milliseconds and microseconds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.shared import Tables, materialize, remainder

#: Microseconds of a period, each level cutting those before it.
LEVELS = (3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)
#: Fixed by the query contract.
FOLDS, WEIGHT, BASE, UNKNOWN = 5, 50, 500_000, -1
#: Lines of a key in a period that are put in order together; a period with more is cut. Sums up to it take so many bits that all folds stand side by side in one number.
BITS = 60 // FOLDS
MOST = (1 << BITS) - 1


def microseconds(at: Column) -> Column:
    """Microseconds since 1970 on the clock that a timestamp shows, without a zone."""
    seconds = (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")
    return F.unix_date(F.to_date(at)).cast("long") * 86_400_000_000 + (F.hour(at) * 60 + F.minute(at)).cast("long") * 60_000_000 + seconds


def fold_of(key: Column) -> Column:
    return remainder(key, FOLDS).cast("int")


def rate(n: Column, s: Column, prior: Column) -> Column:
    """Returned lines in a million, drawn to the prior as by `WEIGHT` lines; the prior itself without history."""
    return F.when(n < 1, prior).otherwise(F.call_function("div", s * 1_000_000 + prior * WEIGHT, n + WEIGHT)).cast("long")


def _period(level: int) -> Column:
    return F.call_function("div", F.col("t") - F.pmod("t", F.lit(LEVELS[level])), F.lit(LEVELS[level]))


def _before(window: W) -> list[Column]:
    """Sums of n and s of other folds that stand before a row in the order of the window; rows of equal order do not."""
    past = window.rangeBetween(W.unboundedPreceding, -1)
    of = lambda x, f: F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(x))).over(past), F.lit(0))
    return [reduce(lambda a, b: a + b, [F.when(F.col("fold") == f, 0).otherwise(of(x, f)) for f in range(FOLDS)]) for x in "ns"]


def _before_packed(window: W) -> list[Column]:
    """The same where all lines of a window are `MOST` at most: one sum for n and one for s."""
    past = window.rangeBetween(W.unboundedPreceding, -1)
    shift = F.col("fold") * BITS
    out = []
    for x in "ns":
        side_by_side = F.coalesce(F.sum(F.call_function("shiftleft", F.col(x), shift)).over(past), F.lit(0).cast("long"))
        fold = lambda f, all_of=side_by_side: F.shiftright(all_of, f * BITS).bitwiseAND(F.lit(MOST).cast("long"))
        out.append(reduce(lambda a, b: a + b, [F.when(F.col("fold") == f, 0).otherwise(fold(f)) for f in range(FOLDS)]))
    return out


def cube(lines: DataFrame, level: int) -> DataFrame:
    """(_k, _b, _f, _n, _s, size, flat): each key's periods of a level by fold, with the lines of other folds in earlier periods inside the period above (above the hours: in all).

    size: lines of the period; flat: all are of one moment. Lines are added up before they are shuffled, and windows
    see a row for each period and fold: as many as the period above has, or, for hours, as many as there are.
    """
    above = [_period(level - 1).alias("_a")] if level else []
    cells = lines.groupBy("_k", *above, _period(level).alias("_b"), "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    order = W.partitionBy("_k", *["_a"] * bool(level)).orderBy("_b")
    here = order.rangeBetween(0, 0)
    n, s = _before(order)
    return cells.select("_k", "_b", F.col("fold").alias("_f"), n.alias("_n"), s.alias("_s"), F.sum("n").over(here).alias("size"), (F.min("lo").over(here) == F.max("hi").over(here)).alias("flat"))


def history(rows: DataFrame, key: Column, name: str, most: int = MOST) -> DataFrame:
    """Rows (t in microseconds, fold, n lines, s of them returned, …) with <name>_n and <name>_s: lines and returned ones of other folds with the same key and an earlier t.

    Keys are not null; n and s are not negative. most: `MOST` or less. The result is a written table. A moment with any number of lines needs no order inside it, so it is joined only.
    """
    n_, s_ = f"{name}_n", f"{name}_s"
    live, parts = rows.withColumns({"_k": key, n_: F.lit(0).cast("long"), s_: F.lit(0).cast("long")}), []
    with Tables() as tables:
        for level in range(len(LEVELS)):
            closed = materialize(cube(live, level))
            at = live.withColumn("_b", _period(level))

            def joined(periods: DataFrame, at: DataFrame = at) -> DataFrame:
                # a period has a row for each fold at most, so a task holds its part of them and lines need no sorting
                p = periods.select(F.col("_k").alias("_pk"), F.col("_b").alias("_pb"), "_f", "_n", "_s").hint("shuffle_hash")
                # by key and period alone, so that what follows finds a period's lines together
                out = at.join(p, (F.col("_k") == F.col("_pk")) & (F.col("_b") == F.col("_pb")) & (F.col("_f") - F.col("fold") == 0))
                return out.withColumns({n_: F.col(n_) + F.col("_n"), s_: F.col(s_) + F.col("_s")}).drop("_pk", "_pb", "_f", "_n", "_s")

            parts.append(joined(closed.filter("flat")).select(*rows.columns, n_, s_))
            n, s = _before_packed(W.partitionBy("_k", "_b").orderBy("t"))
            parts.append(joined(closed.filter(~F.col("flat") & (F.col("size") <= most))).withColumns({n_: F.col(n_) + n, s_: F.col(s_) + s}).select(*rows.columns, n_, s_))
            dense = closed.filter(~F.col("flat") & (F.col("size") > most))
            if dense.isEmpty():  # at the last level every period is one moment
                break
            live = materialize(joined(dense).drop("_b"))
        return tables.keep(materialize(reduce(DataFrame.unionByName, parts)))


def _known(c: Column) -> Column:
    """A key that is never null: null has a value of its own."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def encode(sale_lines: DataFrame, sales: DataFrame, items: DataFrame, vendors: DataFrame, clients: DataFrame) -> DataFrame:
    """(sale_id, item_id, vendor_id, n_lines, n_returned, item_n, item_rate, vendor_n, vendor_rate, client_n, client_rate) as the contract defines them.

    Lines without a sale or a time of sale are dropped; null item_id and client_id become -1. A null vendor_id is one
    vendor, and stays null in the result. Null and unknown kinds, nations and segments are one value each. Repeated lines count, and so do repeated rows of a sale;
    a sale that is told with several clients or times gives a row for each. Of rows that repeat an id in items, vendors or clients the smallest label
    counts. Empty tables give no rows. Other columns are not looked at.
    """
    at = sales.filter("sale_id IS NOT NULL AND sold_at IS NOT NULL").select("sale_id", F.coalesce(F.col("client_id").cast("long"), F.lit(UNKNOWN)).alias("client_id"), microseconds(F.col("sold_at")).alias("t"))
    at = at.groupBy("sale_id", "client_id", "t").agg(F.count("*").alias("told")).withColumn("fold", fold_of(F.col("sale_id")))
    returned = F.when(F.col("flag") == "returned", 1).otherwise(0)
    label = lambda df, key, value, as_: df.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.min(value).alias(as_))
    with Tables() as tables:
        # what a sale's lines share: all history, the client's segment, the client
        own = sale_lines.groupBy("sale_id").agg(F.count("*").alias("n"), F.sum(returned).alias("s"))
        whole = own.join(at.hint("shuffle_hash"), "sale_id").withColumns({"n": F.col("n") * F.col("told"), "s": F.col("s") * F.col("told")})
        whole = materialize(whole.join(label(clients, "client_id", "segment", "segment").hint("shuffle_hash"), "client_id", "left").withColumn("segment", _known(F.col("segment"))))
        whole = history(whole, F.lit(0), "all").withColumn("base", rate(F.col("all_n"), F.col("all_s"), F.lit(BASE))).drop("all_n", "all_s")
        whole = history(whole, F.col("segment"), "segment").withColumn("segment_rate", rate(F.col("segment_n"), F.col("segment_s"), F.col("base"))).drop("segment", "segment_n", "segment_s")
        whole = history(whole, F.col("client_id"), "client")
        told = whole.select("sale_id", "client_id", "t", "fold", "told", "base", "client_n", rate(F.col("client_n"), F.col("client_s"), F.col("segment_rate")).alias("client_rate"))

        # lines are added up before they meet their sale: one with very many is spread by its items
        lines = sale_lines.select("sale_id", F.coalesce(F.col("item_id").cast("long"), F.lit(UNKNOWN)).alias("item_id"), F.col("vendor_id").cast("long").alias("vendor_id"), returned.alias("r"))
        lines = lines.groupBy("sale_id", "item_id", "vendor_id").agg(F.count("*").alias("n"), F.sum("r").alias("s"))
        rows = lines.join(told.hint("shuffle_hash"), "sale_id").withColumns({"n": F.col("n") * F.col("told"), "s": F.col("s") * F.col("told")}).drop("told")
        rows = rows.join(label(items, "item_id", "kind", "kind").hint("shuffle_hash"), "item_id", "left").withColumn("kind", _known(F.col("kind")))
        rows = materialize(rows.join(label(vendors, "vendor_id", "nation_id", "nation").hint("shuffle_hash"), "vendor_id", "left").withColumn("nation", _known(F.col("nation"))))
        rows = history(rows, F.col("kind"), "kind").withColumn("kind_rate", rate(F.col("kind_n"), F.col("kind_s"), F.col("base"))).drop("kind", "kind_n", "kind_s")
        rows = history(rows, F.col("item_id"), "item").withColumn("item_rate", rate(F.col("item_n"), F.col("item_s"), F.col("kind_rate"))).drop("item_s", "kind_rate")
        rows = history(rows, F.col("nation"), "nation").withColumn("nation_rate", rate(F.col("nation_n"), F.col("nation_s"), F.col("base"))).drop("nation", "nation_n", "nation_s", "base")
        rows = tables.keep(history(rows, _known(F.col("vendor_id")), "vendor"))
    rows = rows.withColumn("vendor_rate", rate(F.col("vendor_n"), F.col("vendor_s"), F.col("nation_rate")))
    return rows.select("sale_id", "item_id", "vendor_id", F.col("n").alias("n_lines"), F.col("s").alias("n_returned"), "item_n", "item_rate", "vendor_n", "vendor_rate", "client_n", "client_rate")


def oracle_sql() -> str:
    step = "list_reduce(list_concat([xor(c, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(sale_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, x: {step}), 4294967295)"
    keys = {"every": "0", "kind": "kind", "nation": "nation", "segment": "segment", "item": "item_id", "vendor": "vendor_id", "client": "client_id"}
    past = lambda x, k: f"coalesce(sum({x}) OVER (PARTITION BY {k} ORDER BY sold_at RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 0) - coalesce(sum({x}) OVER (PARTITION BY {k}, fold ORDER BY sold_at RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 0)"
    rate = lambda k, p: f"CASE WHEN {k}_n < 1 THEN {p} ELSE (1000000 * {k}_s + {WEIGHT} * ({p})) // ({k}_n + {WEIGHT}) END"
    return f"""
WITH sold AS (SELECT sale_id, coalesce(client_id, -1) AS client_id, sold_at, (({crc}) % {FOLDS})::INT AS fold FROM sales WHERE sold_at IS NOT NULL AND sale_id IS NOT NULL),
rows AS (SELECT sale_id, coalesce(item_id, -1) AS item_id, vendor_id, client_id, sold_at, fold, count(*) AS n, count_if(coalesce(flag = 'returned', false)) AS s FROM sale_lines JOIN sold USING (sale_id) GROUP BY ALL),
known AS (SELECT rows.*, kind, nation_id AS nation, segment FROM rows LEFT JOIN (SELECT item_id, min(kind) AS kind FROM items GROUP BY ALL) USING (item_id)
 LEFT JOIN (SELECT vendor_id, min(nation_id) AS nation_id FROM vendors GROUP BY ALL) USING (vendor_id) LEFT JOIN (SELECT client_id, min(segment) AS segment FROM clients GROUP BY ALL) USING (client_id)),
past AS (SELECT sale_id, item_id, vendor_id, n, s, {', '.join(f'({past(x, k)})::BIGINT AS {name}_{x}' for name, k in keys.items() for x in 'ns')} FROM known),
base AS (SELECT *, {rate('every', str(BASE))} AS p FROM past),
prior AS (SELECT *, {', '.join(f'{rate(k, "p")} AS {k}_p' for k in ('kind', 'nation', 'segment'))} FROM base)
SELECT sale_id, item_id, vendor_id, n AS n_lines, s AS n_returned, {', '.join(f'{k}_n, ({rate(k, f"{p}_p")})::BIGINT AS {k}_rate' for k, p in (('item', 'kind'), ('vendor', 'nation'), ('client', 'segment')))} FROM prior"""
