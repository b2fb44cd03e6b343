"""Scalars against tables of examples, operators against small registries, queries against SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lamina.functions import scalar as S
from lamina.operators import dedup, enrich, fingerprint, match, resolve, stats
from lamina.plans import curation, knowledge, merging  # noqa: F401  (they register their queries)
from lamina.plans import queries as q
from lamina.sources import files
from lamina.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def values(spark, expr, rows):
    """Results of an expression over the column x, in the order of `rows`."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_and_year(spark):
    assert values(spark, S.clean, [" a ", "", "NaN", None]) == ["a", None, None, None]
    assert values(spark, S.safe_year, ["2009", "2009.0", "1799", "x", None]) == [2009, 2009, None, None, None]


def test_identifiers(spark):
    assert values(spark, S.normalize_id, ["LH 12345a", "LH32560AB", "LH", "K-Bue 085", "LH-6120"]) == ["LH-12345-a", "LH-32560-ab", None, "K-BUE-085", "LH-6120"]
    assert values(spark, S.digits, ["a1b22", "abc"]) == ["122", "abc"]


def test_names_and_types(spark):
    assert values(spark, S.sanitize, ["Campaña (1)", "__a  b__"]) == ["Campaña_1", "a_b"]
    assert values(spark, S.file_type, ["a.JPG", "b.csv", "c", "d.xyz", "e.tar"]) == ["image", "text", "unknown", "other", "compressed"]


@pytest.mark.parametrize("a,b,d", [("ffffffffffffffff", "0000000000000001", 63), ("00000000000000ff", "0000000000000000", 8), ("zz", "0000000000000000", -1)])
def test_hamming(spark, a, b, d):
    assert spark.range(1).select(S.hamming(F.lit(a), F.lit(b)).alias("d")).first()["d"] == d


def test_near_pairs_equal_brute_force(spark):
    h = [(i, f"{(i * 0x9E3779B97F4A7C15 if i % 3 else 7 << (i % 5)) % 2**64:016x}") for i in range(60)]
    df = spark.createDataFrame(h, "k int, p string")
    got = {tuple(r) for r in fingerprint.near_pairs(df, df, 3, "k", "p", itself=True).select(F.least("a", "b"), F.greatest("a", "b"), "dist").collect()}
    want = {(i, j, d) for i, x in h for j, y in h if i < j and 0 < (d := (int(x, 16) ^ int(y, 16)).bit_count()) <= 3}
    assert got == want


def test_merge_rules(spark):
    rows = spark.createDataFrame([(None, None), (None, "1999"), ("LH", "LH"), ("From output", "From staging")], "a string, b string")
    got = rows.select(match.merge_field(F.col("a"), F.col("b")).alias("m"), match.merge_field(F.col("a"), F.col("b"), longer=True)["value"].alias("l")).collect()
    assert [(r.m.value, bool(r.m.conflict), r.l) for r in got] == [(None, False, None), ("1999", False, "1999"), ("LH", False, "LH"), ("From output", True, "From staging")]


def test_decisions(spark):
    c = spark.createDataFrame([("/a/1", "/a", "year"), ("/a/2", "/a", "year"), ("/b/1", "/b", "year")], "path string, folder string, field string")
    d = spark.createDataFrame([("/a/1", None, "year", "defer"), (None, "/a", "year", "staged")], "path string, folder string, field string, outcome string")
    got = {r.path: (r.outcome, r.needs_review) for r in resolve.decide(c, d, "keep").collect()}
    assert got == {"/a/1": ("defer", True), "/a/2": ("staged", False), "/b/1": ("keep", False)}


def test_duplicate_chain_has_root(spark):
    f = spark.createDataFrame([(1, "x", "p"), (2, "y", "p"), (3, "y", "q"), (4, "z", "r")], "k int, d string, h string")
    got = {r.k: (r.duplicate_of, r.duplicate_type, r.root) for r in dedup.mark_duplicates(f, "d", "h", "k").collect()}
    assert got == {1: (None, None, 1), 2: (1, "perceptual", 1), 3: (2, "exact", 1), 4: (None, None, 4)}


def test_numbered_is_a_total_order(spark):
    got = match.numbered(spark.range(100).select((99 - F.col("id")).alias("v")), "v").collect()
    assert sorted((r.v, r.rn) for r in got) == [(i, i + 1) for i in range(100)]


def test_scan_and_plan(spark, tmp_path):
    for p in ("a/x.jpg", "a/.hidden/y.jpg", "b/z.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(p)
    got = files.scan(spark, str(tmp_path), str(tmp_path / "none")).collect()
    assert sorted((r.name, r.type) for r in got) == [("x.jpg", "image"), ("z.txt", "text")]
    assert files.registry(spark, str(tmp_path / "none"), files.HASHES).count() == 0
    staged = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "rel string, digest string")
    kept = spark.createDataFrame([("y", "9"), ("k", "3")], "rel string, digest string")
    assert {r.rel: (r.action, r.new_rel) for r in files.copy_plan(staged, kept).collect()} == {"x": ("copy", None), "y": ("rename", "y_merged_1"), "z": ("duplicate", None)}


def test_enrichment_uses_the_cache(spark):
    wanted, cache = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", "old")], "k string, v string")
    got = enrich.with_cache(wanted, cache, "k", lambda keys: enrich.client(lambda k: {"v": f"new {k}"}, "v string", "k")(keys).select("k", "v")).collect()
    assert sorted(map(tuple, got)) == [("a", "old"), ("b", "new b")]


def test_incremental_batch(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, d string")
    known = spark.createDataFrame([(0, "b")], "k int, d string")
    assert [tuple(r) for r in incremental.dedup_batch(batch, known, "d", "k").select("k", "d").collect()] == [(1, "a")]


def test_flow_has_all_first_links_and_the_top_of_the_second(spark):
    rows = [("M", f"c{i % 12}", f"g{i:02d}") for i in range(30) for _ in range(31 - i)] + [("M", None, None), ("N", " ", "g00"), (None, "c1", None)]
    got = [tuple(r) for r in stats.flow_links(spark.createDataFrame(rows, "m string, c string, g string"), "m", "c", "g", 25).collect()]
    assert len(got) == len(set(got))
    assert {r[1:3] for r in got if r[0] == 1} == {("M", f"c{i}") for i in range(12)} | {("M", "Unknown (M)"), ("N", "Unknown (N)"), ("Unknown", "c1")}
    assert {r[2] for r in got if r[0] == 2} == {f"g{i:02d}" for i in range(25)}
    assert sum(r[3] for r in got if r[0] == 1) == len(rows) and (2, "c0", "g00", 31) in got and (2, "Unknown (N)", "g00", 1) in got
    links = q.QUERIES["taxonomy_links"](spark, SF).collect()
    assert len({r.child for r in links if r.level == 1}) == 25 and len({r.child for r in links if r.level == 2}) == 25


def test_whole_texts_reach_the_operators(spark, tmp_path):
    texts = {i: f"{'word, ' * 40}{i} tail (end)" for i in range(12)}
    spark.createDataFrame([(i, "s", "en", t) for i, t in texts.items()], "doc_id long, source string, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.safe_name for r in q.QUERIES["sanitize_texts"](spark, str(tmp_path)).collect()}
    assert got == {i: f"{'word_' * 40}{i}_tail_end" for i in texts}
    notes = {r.doc_id: r.note for r in q.QUERIES["registry_merge_texts"](spark, str(tmp_path)).collect()}
    # 2, 5, 8 and 11 are on both sides: equal, shortened, lengthened, and empty on the staged side; 0, 3, 6 and 9 are staged only
    assert notes == {i: t + " with an addition" if i in (0, 8) else t[19:].strip() if i == 9 else None if i == 3 else t for i, t in texts.items()}


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.sql(q.SQL[name])
    got = q.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    text = lambda rows, names: sorted(tuple(f"{r[names.index(n)]:.6g}" if isinstance(r[names.index(n)], float) else str(r[names.index(n)]) for n in sorted(names)) for r in rows)
    assert text([tuple(r) for r in got.collect()], got.columns) == text(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", ["doc_fingerprint", "near_pairs", "pair_kinds", "perceptual_groups", "mark_duplicates", "first_match_cascade", "merge_links", "merge_annotations", "merge_conflicts", "merge_summary", "merge_file_plan"])
def test_fingerprints_of_odd_texts_equal_sql(spark, tmp_path, name):
    """Texts without tokens have no fingerprint in SQL, which takes a vertical tab for a letter and lowers each letter by itself."""
    words = "one two three four five six seven eight nine ten"
    texts = [words, None, "", words + " \n", " \t\r\n ", None, "\x0b", "\x0b\x0b", f"{words}\x0bone", f"{words} one", f"ΟΔΟΣ {words}", f"οδοσ {words}", f"ΟΔΟΣ. {words}", "İstanbul", "istanbul", "a\u00a0b", "ÀÉ ß", "àé ß", words + " eleven", ""]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts * 2)]
    c = duckdb.connect()
    for table, df in {"documents": spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "labels": spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int")}.items():
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
        c.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want, got = c.sql(q.SQL[name]), q.QUERIES[name](spark, str(tmp_path))
    assert sorted(tuple(map(str, r)) for r in got.select(*want.columns).collect()) == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_tokens_are_hashed_in_parts(spark, tmp_path, monkeypatch):
    md5, log = fingerprint.md5, str(tmp_path / "hashed")

    def counted(t):
        with open(log, "a") as f:
            f.write("x")
        return md5(t)

    docs = spark.createDataFrame([(i, "same words here" if i % 9 else None) for i in range(40)], "doc_id long, text string").coalesce(1)
    want = sorted(fingerprint.simhash(docs).collect())
    monkeypatch.setattr(fingerprint, "md5", counted)
    monkeypatch.setattr(fingerprint, "TOKENS", 9, raising=False)
    assert sorted(fingerprint.simhash(docs).collect()) == want
    with open(log) as f:  # 35 texts of 3 tokens, 3 texts at most in a part
        assert len(f.read()) >= 36
