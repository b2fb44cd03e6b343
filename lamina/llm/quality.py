"""Quality rules by weak supervision, in built-in expressions only.

Each rule votes good, votes bad or abstains. Expectation-maximisation over the
counts of vote patterns (3**rules at most, whatever the corpus) estimates how
each rule votes on good and on bad documents; the posterior of "good" under
those accuracies replaces a conjunction of thresholds.

Defined results: a null or empty text has no words and fails the base rules;
ties in the posterior keep the document; an empty table gives an empty result;
repeated rows are each judged; columns whose names clash with an output are
replaced, all others stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import WORD, materialize

#: Fixed by the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: (rule, votes bad if, votes good if); neither: it abstains. All are integers, so engines agree.
RULES = [
    ("symbols", "5 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    ("symbol_chars", "30 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    ("repeats", "10 * n_repeat_words > n_words", "n_repeat_words = 0"),
    ("lines", "n_dup_lines > 1 AND 20 * n_dup_lines > n_words", "n_dup_lines = 0"),
    ("word_length", "word_chars > 14 * n_words OR word_chars < 2 * n_words", "word_chars >= 3 * n_words AND word_chars <= 10 * n_words"),
    ("length", "n_words < 20", "n_words >= 50"),
]
#: EM: rounds; at the start, the share of good documents and how a rule votes (bad, abstains, good) on good and on bad ones.
ROUNDS, PRIOR, ON_GOOD, ON_BAD = 15, 0.85, (0.02, 0.28, 0.70), (0.40, 0.35, 0.25)
#: Counts added to each vote so that no probability is 0, and the bounds of the share of good documents.
SMOOTH, LEAST, MOST = 0.5, 0.5, 0.98


OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def once(value: Column, use) -> Column:
    """Binds a value to a lambda's name, so that it is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that the text holds twice or more: sorted windows meet their equals as neighbours."""

    def windows(w: Column) -> Column:
        last = (F.size(w) - WINDOW).cast("int")
        made = lambda h: F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        return F.when(last >= 0, once(F.transform(w, lambda x: F.xxhash64(x)), made)).otherwise(F.array().cast("array<bigint>"))

    def places(p: Column) -> Column:
        before = lambda x, k: (k > 0) & (F.get(p, k - 1)["h"] == x["h"])
        after = lambda x, k: F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(p, lambda x, k: before(x, k) | after(x, k)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long")

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(once(pairs, lambda p: once(places(p), covered)))

    return once(words, lambda w: once(windows(w), count))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The statistics of the contract over each whole text.

    They are made by a generator of one row, which no rule of the optimizer
    copies into filters or joins above it.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    made = once(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    df = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in OUTPUTS], F.inline(F.array(made)))
    return df.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def votes() -> Column:
    """One digit for each rule: 0 bad, 1 abstains, 2 good; in base 3."""
    digits = [F.expr(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END") for _, bad, good in RULES]
    return reduce(lambda a, d: a * 3 + d, reversed(digits), F.lit(0)).cast("int")


def _digit(pattern: Column, k: int | Column) -> Column:
    """Vote of rule k, the first rule being the lowest digit."""
    k = F.lit(k) if isinstance(k, int) else k
    return F.get(F.array(*[(F.floor(pattern / 3**i) % 3).cast("int") for i in range(len(RULES))]), k)


def posterior(pattern: Column, model: Column) -> Column:
    """Probability of good for a vote pattern, rules independent given the class."""
    good, bad = model["prior"], F.lit(1.0) - model["prior"]
    for k in range(len(RULES)):
        at = _digit(pattern, k) + 3 * k
        good, bad = good * F.get(model["good"], at), bad * F.get(model["bad"], at)
    return good / (good + bad)


def accuracies(patterns: DataFrame) -> DataFrame:
    """EM over (pattern, n), folded in one row: prior, and the votes of each rule on good and on bad documents.

    A null pattern (base rules failed) does not count. Patterns number 3**rules at most.
    """
    rows = patterns.agg(F.sort_array(F.collect_list(F.when(F.col("pattern").isNotNull(), F.struct("pattern", F.col("n").cast("double").alias("n"))))).alias("rows"))
    start = F.struct(F.lit(PRIOR).alias("prior"), *[F.array(*[F.lit(x) for x in p * len(RULES)]).alias(n) for n, p in (("good", ON_GOOD), ("bad", ON_BAD))])

    def step(model: Column, _: Column) -> Column:
        judged = F.transform(F.col("rows"), lambda r: F.struct(r["pattern"].alias("pattern"), r["n"].alias("n"), posterior(r["pattern"], model).alias("p")))

        def update(q: Column) -> Column:
            def votes_of(weight) -> Column:
                """Expected votes by rule and kind, as shares of each rule's."""
                zeros = F.array(*[F.lit(SMOOTH)] * (3 * len(RULES)))
                sums = F.aggregate(q, zeros, lambda a, r: F.transform(a, lambda x, j: x + F.when(_digit(r["pattern"], F.floor(j / 3).cast("int")) == j % 3, weight(r)).otherwise(F.lit(0.0))))
                of_rule = lambda a, j: F.get(a, j - j % 3) + F.get(a, j - j % 3 + 1) + F.get(a, j - j % 3 + 2)
                return once(sums, lambda a: F.transform(a, lambda x, j: x / of_rule(a, j)))

            total = lambda f: F.aggregate(q, F.lit(0.0), lambda a, r: a + f(r))
            share = (total(lambda r: r["n"] * r["p"]) + F.lit(1.0)) / (total(lambda r: r["n"]) + F.lit(2.0))
            prior = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), share))
            return F.struct(prior.alias("prior"), votes_of(lambda r: r["n"] * r["p"]).alias("good"), votes_of(lambda r: r["n"] * (F.lit(1.0) - r["p"])).alias("bad"))

        return once(judged, update)

    return rows.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("model"))


def score_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all) of `docs` with the statistics, base_failed, posterior and kept.

    Texts are read once: statistics go to a table in the shared folder, from
    which both the pattern counts and the verdicts are read. Only pattern counts
    are shuffled. The table of verdicts has 3**rules rows at most, which bounds
    its broadcast.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("posterior", "kept", *OUTPUTS)]
    seen = materialize(with_statistics(docs, text).select(*[F.col(f"`{c}`") for c in keep], *OUTPUTS, votes().alias("_pattern")))
    patterns = seen.groupBy(F.when(~F.col("base_failed"), F.col("_pattern")).alias("pattern")).agg(F.count("*").alias("n"))
    model = accuracies(patterns)
    verdicts = model.select("model", F.explode(F.sequence(F.lit(0), F.lit(3 ** len(RULES) - 1))).alias("_pattern"))
    verdicts = verdicts.select("_pattern", posterior(F.col("_pattern"), F.col("model")).alias("posterior"))
    out = seen.join(F.broadcast(verdicts), "_pattern", "left")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)).drop("_pattern")


def oracle_sql() -> str:
    """The same in DuckDB: statistics by unnesting, EM as one chain of common table expressions."""
    word = r"[^\x20\x09-\x0D]+"
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    ctes = [
        f"d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents)",
        f"g AS (SELECT r, i, list_aggregate(list_slice(w, i, i + {WINDOW - 1}), 'string_agg', ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}))",
        "h AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c > 1)",
        f"p AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n_repeat_words FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM h) GROUP BY r)",
        "l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)",
        f"m AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE length(translate(line, {ws}, '')) > 0 GROUP BY r)",
        f"s AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, {ws}, ''))::BIGINT AS word_chars, (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r))",
        f"b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, "
        + ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END AS v{k}" for k, (_, bad, good) in enumerate(RULES))
        + " FROM s)",
        f"c AS (SELECT {', '.join(f'v{k}' for k in range(len(RULES)))}, count(*)::DOUBLE AS n FROM b WHERE NOT base_failed GROUP BY ALL)",
        f"e0 AS (SELECT {PRIOR}::DOUBLE AS prior, {', '.join(f'{p[v]}::DOUBLE AS {c}{k}{v}' for c, p in (('g', ON_GOOD), ('b', ON_BAD)) for k in range(len(RULES)) for v in range(3))})",
    ]
    good, bad = (start + "".join(f" * CASE v{k} WHEN 0 THEN e.{c}{k}0 WHEN 1 THEN e.{c}{k}1 ELSE e.{c}{k}2 END" for k in range(len(RULES))) for c, start in (("g", "e.prior"), ("b", "(1 - e.prior)")))
    for i in range(ROUNDS):
        ctes.append(f"q{i} AS (SELECT c.*, ({good}) / (({good}) + ({bad})) AS p FROM c, e{i} AS e)")
        new = [f"(sum(CASE WHEN v{k} = {v} THEN n * {p} ELSE 0 END) + {SMOOTH}) / (sum(n * {p}) + {3 * SMOOTH}) AS {c}{k}{v}" for c, p in (("g", "p"), ("b", "(1 - p)")) for k in range(len(RULES)) for v in range(3)]
        ctes.append(f"e{i + 1} AS (SELECT greatest({LEAST}, least({MOST}, (sum(n * p) + 1) / (sum(n) + 2))) AS prior, {', '.join(new)} FROM q{i})")
    return f"WITH {', '.join(ctes)} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ({good}) / (({good}) + ({bad})) >= 0.5 AS kept FROM b, e{ROUNDS} AS e"
