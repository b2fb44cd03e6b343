"""Which sources of a language use its words differently: distances between sources, and the words that mark each source."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.shared import Tables, materialize

#: Fixed by the query contract: words are letters A to Z and what is not ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, ascii_uppercase, ascii_lowercase), F.lit(TERM), F.lit(0))


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences, and documents that have the term.

    One pass over the texts: each document's terms stand beside its distinct ones, and both are counted before the shuffle.
    """
    words = docs.select("lang", "source", terms(F.col("text")).alias("words"))
    lists = words.select("lang", "source", F.posexplode(F.array("words", F.array_distinct("words"))).alias("once", "words"))
    rows = lists.select("lang", "source", "once", F.explode("words").alias("term"))
    return rows.groupBy("lang", "source", "term").agg(F.count_if(F.col("once") == 0).alias("n"), F.count_if(F.col("once") == 1).alias("df"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + the smoothed share of a term in billionths, rounded down; decimals, so it is exact at any size."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(F.lit(1_000_000_000)) * wide(n + 5), wide(total + 5 * kept)) + 1


def audit(docs: DataFrame, least: int = 30, first: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents (text, lang, source).

    A language keeps the terms that at least `least` of its documents have. Part `pair`: each other
    source of the language with the sum of differences of shares over all kept terms. Part `term`: the
    `first` kept terms whose share in the source is furthest above that in the language. Ranks start
    at 1, greatest value first, ties by the bytes of the item.

    Nulls in any of the three columns are empty strings; a row without words counts as a source
    of its language. Repeated rows count as often as they come. A language that keeps no term has pairs of
    value 0 and no terms; an only source has no pairs; without rows there is no result. Other columns are not looked at.

    Words are counted before they are shuffled, so no language or source gathers its texts anywhere. The vocabulary meets
    the sources by language and hash of the term: a language with most of the words is dealt over all tasks.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = docs.select("lang", "source").distinct()
    with Tables() as tables:
        counts = materialize(counted(docs))
        kept = materialize(counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("df").alias("df")).filter(F.col("df") >= least).drop("df"))
        present = counts.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n")
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("in_lang").alias("lang_total"))
        sizes = groups.join(langs, "lang", "left").join(present.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        sizes = tables.keep(materialize(sizes.na.fill(0, ["total", "kept", "lang_total"])))

        # every source with every kept term of its language
        deals = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        one = kept.withColumn("deal", F.pmod(F.xxhash64("term"), F.lit(deals)).cast("int"))
        other = sizes.filter("kept > 0").withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
        dense = one.join(other, ["lang", "deal"]).join(present, ["lang", "source", "term"], "left")
        n = F.coalesce("n", F.lit(0))
        dense = dense.select("lang", "source", "term", n.alias("n"), share(n, F.col("total"), F.col("kept")).alias("p"), share(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q"))
        dense = tables.keep(materialize(dense))

    a, b = dense.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa")), dense.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"))
    far = a.join(b, ["lang", "term"]).filter("a < b").groupBy("lang", "a", "b").agg(F.sum(F.abs(F.col("pa") - F.col("pb"))).alias("value"))
    bare = sizes.filter("kept = 0")  # of languages without kept terms
    nothing = bare.select("lang", F.col("source").alias("a")).join(bare.select("lang", F.col("source").alias("b")), "lang").filter("a < b").withColumn("value", F.lit(0).cast("long"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = far.unionByName(nothing).select("lang", both.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    marks = dense.filter("n > 0 AND p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(marks).filter(F.col("rank") <= first))


def oracle_sql(least: int = 30, first: int = 50) -> str:
    share = lambda n, total: f"1 + ((1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * kept))"
    return f"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d, translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}') AS text FROM documents),
words AS (SELECT lang, source, d, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS in_lang FROM words GROUP BY ALL HAVING count(DISTINCT d) >= {least}),
langs AS (SELECT lang, count(*) AS kept, sum(in_lang) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT g.lang, g.source, k.term, k.in_lang, coalesce(n, 0) AS n FROM groups AS g JOIN kept AS k ON k.lang = g.lang LEFT JOIN counts AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
dense AS (SELECT lang, source, term, n, {share("n", "total")} AS p, {share("in_lang", "lang_total")} AS q FROM cells JOIN totals USING (lang, source) JOIN langs USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM dense AS a JOIN dense AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
marks AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marks))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {first}"""
