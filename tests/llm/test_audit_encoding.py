"""Divergence of sources, paragraph fingerprints and time-ordered encoding against brute force."""

import datetime as dt
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from lamina.llm import divergence, encoding, multiset
from lamina.llm import queries as registered


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- divergence


def plain_audit(docs, least, first):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    words = [(d["lang"] or "", d["source"] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(d["text"] or ""))) for d in docs]
    df, count, in_lang = Counter(), Counter(), Counter()
    for lang, source, ws in words:
        df.update({(lang, w) for w in ws})
        count.update((lang, source, w) for w in ws)
        in_lang.update((lang, w) for w in ws)
    kept, sources = defaultdict(list), defaultdict(set)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    for lang, source, _ in words:
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        v = kept[lang]
        p = {}
        for s in own:
            total = sum(count[lang, s, w] for w in v)
            p[s] = {w: 1 + 1_000_000_000 * (count[lang, s, w] + 5) // (total + 5 * len(v)) for w in v}
        total = sum(in_lang[lang, w] for w in v)
        q = {w: 1 + 1_000_000_000 * (in_lang[lang, w] + 5) // (total + 5 * len(v)) for w in v}
        for s in own:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in v), o) for o in own if o != s]
            terms = [(p[s][w] - q[w], w) for w in v if count[lang, s, w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, first)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def audit_docs(n=120):
    rng = random.Random(5)
    vocabulary = ["Été", "été", "the", "The", "THE", "naïve", "x1y", "a_b", "Ωmega", "ωmega", "İ", "one", "two", "three", "日本", "日本語"]
    docs = [{"text": " ".join(rng.choices(vocabulary[: 4 + k % 13], k=rng.randint(0, 30))), "lang": rng.choice(["en", "fr", None, ""]), "source": rng.choice(["s1", "s2", "s3", None])} for k in range(n)]
    docs += [{"text": None, "lang": "en", "source": "silent"}, {"text": "", "lang": "xx", "source": "a"}, {"text": "rare", "lang": "xx", "source": "b"}, {"text": "12 34", "lang": "xx", "source": None}, {"text": "alone", "lang": "yy", "source": "a"}]
    docs += [docs[0]] * 5 + [{"text": "the " * 5000, "lang": "en", "source": "s1"}]
    return docs


@pytest.mark.parametrize("least, first", [(3, 4), (30, 50), (1, 2)])
def test_divergence_equals_brute_force(spark, least, first):
    docs = audit_docs()
    df = spark.createDataFrame([(d["lang"], d["source"], d["text"], 1, 2, 3) for d in docs], "lang string, source string, text string, term int, n int, rank int")
    assert rows_of(divergence.audit(df, least, first).select("lang", "source", "part", "item", "value", "rank")) == plain_audit(docs, least, first)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(df).collect() == []


def test_divergence_sql_equals_brute_force():
    docs = audit_docs()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(d["lang"], d["source"], d["text"]) for d in docs])
    got = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({divergence.oracle_sql(3, 4)})").fetchall()
    assert sorted(got) == plain_audit(docs, 3, 4)


# --- fingerprints


def test_fingerprint_is_a_sum_over_paragraphs():
    a, b, c = (multiset.vector(t) for t in (b"One line.\nAnother line", b"Another line\nOne line.", b"One line."))
    assert (a == b).all()
    assert (a - multiset.vector(b"Another line") == c).all()
    assert (c + multiset.vector(b"Another line") == a).all()
    assert not (multiset.vector(b"x\nx") == multiset.vector(b"x")).all()
    assert not multiset.vector(b"").any() and not multiset.vector(b"\n\n").any()


@pytest.mark.parametrize("n", [0, 1, 127, 128, 40_000, multiset.AT_ONCE * 2 + 1])
def test_packed_fingerprints_hold_any_multiplicity(n):
    v = multiset.vector(b"same\n" * n + b"other")
    assert (multiset.unpack(multiset.pack(v)) == v).all()
    assert multiset.likeness(v, v) == 1.0
    w = np.zeros(multiset.LANES, np.uint64)
    w[multiset.EXACT :] = np.uint64(2**64 - 2**40)
    assert (multiset.unpack(multiset.pack(w)) == w).all()


def test_likeness_estimates_the_shared_part():
    for shared in (0, 10, 50, 90, 100):
        a = [f"common {i}" for i in range(shared)] + [f"a {i}" for i in range(100 - shared)]
        b = [f"common {i}" for i in range(shared)] + [f"b {i}" for i in range(100 - shared)]
        assert abs(multiset.likeness(multiset.vector("\n".join(a).encode()), multiset.vector("\n".join(b).encode())) - shared / 100) < 0.2
    assert multiset.likeness(multiset.vector(b""), multiset.vector(b"")) == 1.0
    assert multiset.likeness(multiset.vector(b""), multiset.vector(b"a")) == 0.0


def plain_edits(docs):
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    out = []
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        mine, its, changed = (multiset.vector(t.encode()) for t in (text, after, new))
        out.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), multiset.pack(mine), multiset.pack(changed), multiset.likeness(mine, changed), multiset.likeness(mine, its)))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def edit_docs(n):
    rng = random.Random(n)
    words = ["alpha", "beta.", "größe", "日本.", "a\n", "end!", "why?", "x. y", "\n\n", "𝔘nicode", ". ", "..", "?!"]
    docs = [(k * 3, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for k in range(n)]
    return docs[:-4] + [(1_000_000, None), (1_000_001, ""), (1_000_002, "odd"), (None, "first of all. " * 9)] if n > 4 else docs


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 300])
def test_edits_equal_brute_force(spark, n):
    docs = edit_docs(n)
    rng = random.Random(1)
    df = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, text string").selectExpr("doc_id", "text", "1 AS _range", "2 AS fingerprint", "3 AS n_chars").repartition(5)
    got = sorted((tuple(r) for r in multiset.edited(df).select("doc_id", *multiset.RESULTS).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want = plain_edits(docs)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want]) if want else got == []


def test_edits_of_repeated_keys(spark):
    rng = random.Random(3)
    same = [(5, f"text {rng.random()}. More of it. And more {k}.") for k in range(200)] + [(5, "equal text. Twice.")] * 100 + [(4, "before"), (6, "after")]
    df = spark.createDataFrame(rng.sample(same, len(same)), "doc_id long, text string").repartition(7)
    got = multiset.edited(df).collect()
    assert sorted(Counter(r["fingerprint"] for r in got).values()) == sorted(Counter(multiset.pack(multiset.vector(t.encode())) for _, t in same).values())
    # each row is the next one of exactly one other: all edits of a hundred equal rows but one are the text itself
    own = [r for r in got if r["fingerprint"] == multiset.pack(multiset.vector(b"equal text. Twice."))]
    assert len(own) == 100 and sum(r["near_next"] == 1.0 for r in own) == 99


def test_edits_of_a_very_long_text(spark):
    docs = [(1, "word. " * 400_000), (2, "short"), (3, "x" * 3_000_000)]
    got = sorted(multiset.edited(spark.createDataFrame(docs, "doc_id long, text string")).collect(), key=lambda r: r["doc_id"])
    assert [tuple(r)[:5] for r in got] == [r[:5] for r in plain_edits(docs)]


def test_fingerprints_change_and_merge(spark):
    df = spark.createDataFrame([(1, "a\nb", "b", "c\nd"), (2, None, None, None), (1, "z" * 50, None, "a"), (None, "q", "q", "")], "g long, text string, del string, ins string")
    f = multiset.fingerprints(df)
    out = {(r["g"], r["text"]): r["fingerprint"] for r in multiset.changed(f, "fingerprint", "del", "ins").collect()}
    pack = lambda t: multiset.pack(multiset.vector(t.encode()))
    assert out == {(1, "a\nb"): pack("a\nc\nd"), (2, None): pack(""), (1, "z" * 50): pack("z" * 50 + "\na"), (None, "q"): pack("")}
    many = spark.range(3000).selectExpr("id % 3 AS g", "concat('p', id % 1000) AS text").repartition(6)
    merged = {r["g"]: r["fingerprint"] for r in multiset.merged(multiset.fingerprints(many), "g").collect()}
    assert merged == {g: multiset.pack(multiset.vector("\n".join(f"p{i % 1000}" for i in range(g, 3000, 3)).encode())) for g in range(3)}


# --- encoding

CONTRACT = ["sale_id", "item_id", "vendor_id", "n_lines", "n_returned", "item_n", "item_rate", "vendor_n", "vendor_rate", "client_n", "client_rate"]
EPOCH = dt.datetime(1970, 1, 1)


def shop(seed, n_sales):
    """Sales crowded into few moments of a few hours, with null and unknown ids, repeated and stray lines."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 31, 0, 59)
    sales = []
    for k in range(n_sales):
        at = start + dt.timedelta(microseconds=rng.choice([0, rng.randint(0, 40), rng.randint(0, 4000), rng.randint(0, 10**7), rng.randint(0, 10**10)]))
        sales.append((k, rng.choice([1, 1, 1, 2, 3, None, 99]), None if k % 17 == 5 else at))
    lines = [(rng.choice([rng.randrange(n_sales), n_sales + 5, None]), rng.choice([7, 7, 7, 8, 9, None, 77]), rng.choice([1, 1, 2, 3, 44, None]), rng.choice(["returned", "kept", None])) for _ in range(4 * n_sales)]
    lines += lines[:20]
    return lines, sales, [(7, "a"), (8, None), (9, "b"), (None, "c")], [(1, 10), (2, None), (3, 11)], [(1, "p"), (2, "q"), (3, None)]


def plain_encode(lines, sales, items, vendors, clients):
    sold = {s: (c if c is not None else -1, (t - EPOCH) // dt.timedelta(microseconds=1)) for s, c, t in sales if t is not None}
    kind, nation, segment = dict(items), dict(vendors), dict(clients)
    seen = []
    for s, i, v, flag in lines:
        if s in sold:
            c, t = sold[s]
            i = -1 if i is None else i
            seen.append((s, i, v, {"all": 0, "kind": kind.get(i), "nation": nation.get(v), "segment": segment.get(c), "item": i, "vendor": v, "client": c}, t, zlib.crc32(str(s).encode()) % 5, flag == "returned"))
    by = defaultdict(list)
    for line in seen:
        by[line[:3]].append(line)

    def past(line, column):
        h = [x for x in seen if x[5] != line[5] and x[4] < line[4] and x[3][column] == line[3][column]]
        return len(h), sum(x[6] for x in h)

    def rate(n, s, p):
        return p if n < 1 else (1_000_000 * s + 50 * p) // (n + 50)

    out = []
    for (s, i, v), own in by.items():
        row = [s, i, v, len(own), sum(x[6] for x in own)]
        base = rate(*past(own[0], "all"), 500_000)
        for column, above in (("item", "kind"), ("vendor", "nation"), ("client", "segment")):
            n, returned = past(own[0], column)
            row += [n, rate(n, returned, rate(*past(own[0], above), base))]
        out.append(tuple(row))
    return sorted(out, key=str)


def shop_tables(spark, lines, sales, items, vendors, clients):
    return (
        spark.createDataFrame(lines, "sale_id long, item_id long, vendor_id long, flag string").selectExpr("*", "1 AS n", "2 AS t", "3 AS fold"),
        spark.createDataFrame(sales, "sale_id long, client_id long, sold_at timestamp_ntz").selectExpr("*", "'x' AS flag", "4 AS item_n"),
        spark.createDataFrame(items, "item_id long, kind string"),
        spark.createDataFrame(vendors, "vendor_id long, nation_id int"),
        spark.createDataFrame(clients, "client_id long, segment string"),
    )


def test_encoding_equals_brute_force(spark):
    """Crowded moments, repeated lines, and every sale told twice: each line counts twice then."""
    lines, sales, *rest = shop(2, 120)
    got = encoding.encode(*shop_tables(spark, lines, sales + sales, *rest)).select(*CONTRACT).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_encode(lines + lines, sales, *rest)


def test_encoding_without_rows(spark):
    assert encoding.encode(*shop_tables(spark, *[[]] * 5)).collect() == []


@pytest.mark.parametrize("most", [1, 5, encoding.MOST])
def test_history_equals_brute_force_at_every_level(spark, most):
    rng = random.Random(most)
    rows = [(k, rng.choice(["a", "a", "b"]), rng.choice([0, rng.randint(0, 9), rng.randint(0, 3000), rng.randint(0, 10**7), rng.randint(-(10**10), 10**11)]), rng.randrange(5), rng.randint(1, 3), rng.randint(0, 1)) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, key string, t long, fold int, n long, s long")
    got = {r["id"]: (r["x_n"], r["x_s"]) for r in encoding.history(df, df["key"], "x", most).collect()}
    for k, key, t, fold, _, _ in rows:
        h = [r for r in rows if r[1] == key and r[2] < t and r[3] != fold]
        assert got[k] == (sum(r[4] for r in h), sum(r[5] for r in h))


def test_encoding_sql_equals_brute_force():
    lines, sales, items, vendors, clients = data = shop(6, 120)
    con = duckdb.connect()
    for name, columns, rows in (
        ("sale_lines", "sale_id BIGINT, item_id BIGINT, vendor_id BIGINT, flag VARCHAR", lines), ("sales", "sale_id BIGINT, client_id BIGINT, sold_at TIMESTAMP", sales),
        ("items", "item_id BIGINT, kind VARCHAR", items), ("vendors", "vendor_id BIGINT, nation_id INT", vendors), ("clients", "client_id BIGINT, segment VARCHAR", clients),
    ):
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    got = con.execute(f"SELECT {', '.join(CONTRACT)} FROM ({encoding.oracle_sql()})").fetchall()
    assert sorted(got, key=str) == plain_encode(*data)


# --- the registered queries


@pytest.mark.parametrize("name", ["op11_divergence", "op13_encoding"])
def test_registered_queries_agree_with_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "sale_lines", "sales", "items", "vendors", "clients"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = registered.queries()[name](spark, folder).select(*columns).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(want.fetchall(), key=str)


def test_registered_edits_equal_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in registered.queries()["op12_multiset"](spark, "/root/testdata/sf0.001").select("doc_id", *multiset.RESULTS).collect()), key=lambda r: r[0])
    assert [r[:5] for r in got] == [r[:5] for r in plain_edits(docs)]
