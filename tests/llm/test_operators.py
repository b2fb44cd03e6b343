"""The training-data operators against brute force, exact round trips and edge cases, on small tables."""

import io
import itertools
import re
import zlib
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lamina.llm import decontaminate, graph, langid, mixing, ngram_join, quality, suffix_dedup, tokens, toxicity, urlfilter, warc
from lamina.llm.queries import TOKENIZER

A = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion of odd herbs and old stones"
B = "pack my box with five dozen liquor jugs then sing a long song about rivers that never quite reach the distant sea"
TEXTS = [
    A, A, A + " and more words follow here", "prefix words first " + A, B, B + " x", None, "", "one", "one", "a b c", "a" * 200, "b" + "a" * 180,
    "aß " * 60, A[10:70], B[:49], B[:50], " ".join(f"w{i}" for i in range(5000)), " ".join(f"w{i}" for i in range(4990)), "é" * 40, "line\n" * 30,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_words string, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], "clash", "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup(docs, empty, hot):
    rows, first = [(i, (t or "").encode()) for i, t in enumerate(TEXTS)], {}
    for i, t in rows:
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    got = {r.doc_id: r for r in suffix_dedup.remove(docs, hot_rows=hot).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        hit = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                hit[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, h in zip(t, hit) if not h)
        want = (len(t), sum(hit), len(re.findall(b"\1+", bytes(hit))), sha256(kept).hexdigest(), kept)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256, bytes(got[i].kept)) == want, i
    assert suffix_dedup.remove(empty).count() == 0


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1])
def test_decontaminate(spark, docs, empty, block):
    items = [(1, A.upper()), (2, "one"), (3, None), (4, ""), (5, A), (6, "w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    got = {r.doc_id: r for r in decontaminate.find(docs, bench, block_bytes=block).collect()}
    for i, t in enumerate(TEXTS):
        words, hit, found = split(t), set(), set()
        for item, text in items:
            w = split(text)
            n = min(13, len(w))
            for k, j in itertools.product(range(len(w) - n + 1 if w else 0), range(max(0, len(words) - n + 1)) if n else ()):
                if words[j : j + n] == w[k : k + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
        assert (got[i].n_words, got[i].n_hit, got[i].items, got[i].contaminated) == (len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)), i
    assert decontaminate.find(empty, bench).count() == 0
    assert not decontaminate.find(docs, bench.limit(0)).filter("contaminated").count()
    raw = TEXTS[3].encode()
    assert [raw[s.start : s.end] for s in got[3].hit_spans] == [A.encode()]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1])
def test_decontaminate_reports_repeated_and_null_keys(spark, tmp_path, monkeypatch, block):
    rows = [(1, A, "en", "a"), (1, "clean words", "de", "b"), (1, "clean words", "de", "b"), (None, B, None, "a"), (None, "", "en", None), (None, None, "en", None), (2, A + " " + B, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    bench = spark.createDataFrame([(1, A), (2, B), (3, "stones")], "item_id long, text string")
    got = decontaminate.find(docs.select("*", F.struct("*").alias("_row")), bench, block_bytes=block, keep="_row").collect()
    found = lambda t: [i for i, w in (("1", A), ("2", B), ("3", "stones")) if w in (t or "")]
    order = lambda x: sorted(x, key=str)
    assert order((r.doc_id, tuple(r._row), r.n_words, r["items"], r.contaminated) for r in got) == order((r[0], r, len((r[1] or "").split()), found(r[1]), bool(found(r[1]))) for r in rows)
    import corpus_pipeline

    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    monkeypatch.setattr(decontaminate, "find", partial(decontaminate.find, block_bytes=block))
    kept = corpus_pipeline.benchmark_passages(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert order(map(tuple, kept.collect())) == order(r for r in rows if not found(r[1]))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 200])
def test_decontaminate_items_without_an_id(spark, block):
    bench = spark.createDataFrame([(None, "one two three"), ("None", "four five six"), (None, None), (None, "one two three")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "say one two three now"), (2, "four five six"), (3, "one two three four five six"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r["items"]) for r in decontaminate.find(docs, bench, block_bytes=block).collect()}
    assert got == {1: (3, 0, []), 2: (3, 1, ["None"]), 3: (6, 1, ["None"]), 4: (0, 0, [])}


def test_pipeline_keeps_whole_rows(spark, tmp_path):
    import corpus_pipeline as pipeline

    long = [f"The {a} house and the {b} garden of that town were built with care, and they have been loved by all since then." for a, b in itertools.product(("old", "new"), ("red", "big"))]
    texts = [(1, A), (2, A), (3, B), (3, B), (None, A), (None, A), (None, None), (4, ""), (5, long[0] * 3), (6, " ".join(long)), (None, "one")]
    rows = [(i, t, "en", [None, "a", "b"][k % 3], "clash", "clash", "clash", "clash") for k, (i, t) in enumerate(texts)]
    rows[3] = rows[2]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, size string, taken string, contaminated string")
    table.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs, given = spark.read.parquet(str(tmp_path / "documents.parquet")), sorted(rows, key=str)
    got = {}
    for stage in (pipeline.quality_rules, pipeline.near_duplicates, pipeline.mixture):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got[stage.__name__] = sorted(map(tuple, out.collect()), key=str)
    verdict = {r.text: r.kept for r in quality.score_quality(docs.select("text"), keep=["text"]).collect()}
    assert got["quality_rules"] == [r for r in given if verdict[r[1]]]
    # 2 and both rows without doc_id copy 1, and one of the rows 3 the other
    assert got["near_duplicates"] == [r for k, r in enumerate(given) if r[0] != 2 and (r[0], r[1]) != (None, A) and r not in given[:k]]
    assert got["mixture"] and all(r in given for r in got["mixture"])


def test_pipeline_keeps_unlike_texts_of_one_doc_id(spark, tmp_path):
    import corpus_pipeline as pipeline

    other, third = " ".join(f"v{k}" for k in range(60)), " ".join(f"u{k}" for k in range(60))
    rows = [(1, A + " " + B), (2, A + " " + B + " more"), (2, other), (5, other + " end"), (7, "x y z " * 9), (7, third)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())) == sorted([rows[0], rows[2], rows[4], rows[5]])
    assert pipeline.near_duplicates(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_pipeline_tokens_and_run(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    encode = Tokenizer.from_file(TOKENIZER).encode
    some = docs.limit(40).unionByName(spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", None, None, 0)], docs.schema))
    some.write.parquet(str(tmp_path / "some"))
    some = spark.read.parquet(str(tmp_path / "some"))
    ids = {r.doc_id: [*encode(r.text or "", add_special_tokens=False).ids, 0] for r in some.collect()}
    got = pipeline.token_ids(spark, some, str(tmp_path)).collect()
    starts = dict(zip(sorted(ids), itertools.accumulate([0, *(len(ids[k]) for k in sorted(ids))]), strict=False))
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == {k: (starts[k], len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for k, v in ids.items()}

    step = docs
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, step, "/root/testdata/sf0.001")
        out.write.parquet(str(tmp_path / f"stage{k}"))
        step = spark.read.parquet(str(tmp_path / f"stage{k}"))
    whole = pipeline.run(spark, "/root/testdata/sf0.001")
    cols = ["doc_id", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*cols).collect())) == sorted(map(tuple, step.select(*cols).collect()))


def test_profiles_of_many_letters_take_bounded_memory():
    import tracemalloc

    text = "".join(chr(0x4E00 + (k * 7919) % 20000) for k in range(700_000)).encode()  # 2 MB of letters, hardly any pair of them twice
    langid.vectors(np.arange(5))
    tracemalloc.start()
    got, letters = langid.profiles(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert letters.tolist() == [700_000] and peak < 400 << 20
    ids, _, _ = langid.ngrams(np.frombuffer(text, np.uint8)[:30_000], np.array([0, 30_000]))
    few, _ = langid.profiles(np.frombuffer(text, np.uint8)[:30_000], np.array([0, 30_000]))
    assert (few[0] == langid.vectors(ids).astype(np.int64).sum(axis=0)).all()


def test_mixing_of_rows_without_keys_and_of_equal_rows(spark):
    rows = [(None, " ".join([f"{s}{k}"] * 10), s) for s in "abc" for k in range(200)]
    goal = mixing.targets({s: 2000 for s in "abc"}, 6000)
    for docs in (rows, [(5, "w " * 10, s) for s in "abc" for _ in range(200)]):
        got = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3), F.array("source")).collect()
        assert len(got) == 600
        for s in "abc":
            own = [r for r in got if abs(r.target - goal[s]) < 1e-6]
            assert own and abs(sum(r.taken for r in got if r.target == own[0].target) / len({t for t in goal.values() if abs(t - goal[s]) < 1e-6}) - goal[s] * sum(abs(t - goal[s]) < 1e-6 for t in goal.values())) <= 10 * 3


def test_pipeline_links_from_five_words_and_four_fifths(spark, tmp_path):
    import corpus_pipeline as pipeline

    words = [f"w{k}" for k in range(404)]  # 400 shingles of five words
    change = lambda k: " ".join(words[: len(words) - k] + [f"x{i}" for i in range(k)])  # noqa: E731  (400 - k) / (400 + k) alike
    rows = [(1, change(0)), (2, change(44)), (3, "other " + change(0)[::-1]), (4, " ".join(f"y{k}" for k in range(404)))]
    rows += [(5, " ".join([f"y{k}" for k in range(404 - 45)] + [f"z{k}" for k in range(45)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in pipeline.near_duplicates(spark, docs, str(tmp_path)).orderBy("doc_id").collect()]
    assert 100 * (400 - 44) >= 80 * (400 + 44) and 100 * (400 - 45) < 80 * (400 + 45)
    assert kept == [1, 3, 4, 5]


def groups(texts):
    """Set size and component of each text."""

    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = [grams(t) for t in texts]
    comp = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((comp[i], comp[j]))
            comp = [a if c == b else c for c in comp]
    return {i: (len(s), comp[i]) for i, s in enumerate(sets)}


def test_ngram_join(docs, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    assert got == groups(TEXTS)
    assert ngram_join.join(empty).count() == 0


@pytest.mark.parametrize(("large", "cell"), [(2, 3), (2, 1000), (1000, 1)])
def test_ngram_join_of_near_copies(spark, monkeypatch, large, cell):
    """Copies of one text with words changed: some are linked, most are just not."""
    monkeypatch.setattr(ngram_join, "LARGE", large)
    monkeypatch.setattr(ngram_join, "CELL", cell)
    rng = np.random.default_rng(7)
    texts = []
    for k in range(60):
        words = [f"w{i}" for i in range(120 + k % 9)]
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(rows).collect()}
    want = groups(texts)
    assert got == want and len({c for _, c in want.values()}) > 5


def test_ngram_join_tells_long_patterned_words_apart(spark):
    """Thue-Morse words and their complements have equal polynomials modulo 2**64, whatever the base."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), word[:1024], word[1024:], "x" * 64, "x" * 65, "x" * 66, "y" * 3_000_000, "y" * 3_000_001, word, "z " * 5, None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, word), (None, "null key"), (None, word)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    want = groups(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert want[9] == (1, 0) and len({c for _, c in want.values()}) == len(texts) - 1
    assert all(r.component_id in (None, 0) for r in got if r.doc_id is None)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect() if r.node != r.component}
    assert got == {i: 1 for i in range(2, 41)} | {95: 90, 100: 90}


def test_langid(docs, empty):
    got = {r.doc_id: r for r in langid.identify(docs, docs).collect()}
    assert len(got) == len(TEXTS)
    assert got[6].lang_pred == got[7].lang_pred == "und" and got[6].score == 0
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(empty, docs).count() == 0


def test_langid_equals_plain_bundling(spark, monkeypatch):
    """Prototypes and scores against a plain computation, and languages of one script told apart."""
    monkeypatch.setattr(langid, "BLOCK", 64)
    monkeypatch.setattr(langid, "HELD", 50)
    texts = [
        (1, "the cat sat on the mat and the hat", "en"), (2, "der hund und die katze", "de"), (3, "The dog, the fox! 7 of them", "en"), (4, "это просто текст о том и этом", "ru"),
        (5, "це просто їжа і її ґанок та під'їзд", "uk"), (6, "один день и ещё один день", "ru"), (7, "ще її діти їдять", "uk"), (8, "語学 を 学ぶ", "ja"), (9, "123 -- 456", "none"),
    ]
    learn = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    letters = [np.roll(np.random.default_rng(5).integers(0, 2, (langid.SYMBOLS, langid.SIZE), dtype=np.int8) * 2 - 1, k, axis=1) for k in range(3)]

    def profile(text):
        code = [int(langid.symbols()[ord(c)]) for c in text + " "]
        code = [c for k, c in enumerate(code) if c or (k and code[k - 1])]
        return sum((letters[2][a] * letters[1][b] * letters[0][c] for a, b, c in zip(code, code[1:], code[2:])), np.zeros(langid.SIZE))

    total = {}
    for _, t, lang in texts:
        total[lang] = total.get(lang, 0) + profile(t)
    names, proto = langid.prototypes(langid.language_counts(learn, "text", "lang"))
    assert names == sorted(n for n in total if np.any(total[n]))
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    assert np.allclose(proto, [unit(total[n]) for n in names], atol=1e-6)
    new = [(10, "the end of the cat"), (10, "the end of the cat"), (11, "и это день"), (12, "її їжа"), (13, "学語"), (14, "9 9"), (15, "x " * 200_000), (16, None)]
    got = langid.predict(spark.createDataFrame(new, "doc_id long, text string").repartition(2), names, proto).collect()
    assert len(got) == len(new)
    for r in got:
        text = dict(new)[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            cos = [float(unit(profile(text)) @ unit(total[n])) for n in names]
            assert r.lang_pred == names[int(np.argmax(cos))] and abs(r.score - max(0, max(cos))) < 1e-4
    assert {r.doc_id: r.lang_pred for r in got}[11] == "ru" and {r.doc_id: r.lang_pred for r in got}[12] == "uk"


def test_toxicity(spark, docs, empty):
    train = spark.createDataFrame([(i, f"plain words number {i} " + ("vile scum" if i % 2 else "kind friend"), i % 2) for i in range(60)], "doc_id long, text string, toxic int")
    model = toxicity.learn(train, train.select("doc_id", "toxic"))
    new = spark.createDataFrame([(1, "you vile scum"), (2, "my kind friend"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(new, model).collect()}
    assert got[1] > 0.5 > got[2] and 0 <= got[3] <= 1
    assert {r.score for r in toxicity.score(docs, toxicity.learn(empty, train.select("doc_id", "toxic"))).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


def plain_features(text):
    """Distinct words, leading parts of longer ones, pairs of neighbours and pairs with a word between."""
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    out = {("word", w) for w in words} | {("stem", w[:k]) for w in words for k in toxicity.STEMS if len(w) > k}
    return out | {("pair", *p) for p in zip(words, words[1:])} | {("skip", *p) for p in zip(words, words[2:])} | {"bias"}


def plain_ftrl(rows):
    """Weights of a plain FTRL-proximal, one coordinate after another."""
    z, n = {}, {}

    def weight(f):
        zf, nf = z.get(f, 0.0), n.get(f, 0.0)
        return 0.0 if abs(zf) <= toxicity.L1 else -(zf - (1 if zf > 0 else -1) * toxicity.L1) / ((toxicity.BETA + nf**0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for found, label in rows:
            w = {f: weight(f) for f in found}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for f in found:
                nf = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - ((nf + g * g) ** 0.5 - nf**0.5) / toxicity.ALPHA * w[f]
                n[f] = nf + g * g
    return {f: weight(f) for f in z}


def test_toxicity_equals_a_plain_ftrl(spark):
    rng = np.random.default_rng(2)
    words = ["vile", "scum", "Kind", "friend", "ordinary", "words", "größe", "x9", "extraordinary", "of"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 30))), None) for i in range(80)]
    rows = [(i, t + (" vile scum" if i % 3 == 0 else ""), int(i % 3 == 0)) for i, t, _ in rows]
    rows += [(200, "long " * 300_000 + "scum", 1), (201, None, 0), (202, "", 0), (203, "no label", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").unionByName(spark.createDataFrame([(3, 0), (999, 1)], "doc_id long, toxic int"))  # told twice, and of no document
    order = [(r.doc_id, r.toxic) for r in labels.filter("toxic IS NOT NULL").select("*", F.xxhash64(F.lit(11), "doc_id").alias("o")).orderBy("o", "doc_id", "toxic").collect()]
    texts = {i: t for i, t, _ in rows}
    w = plain_ftrl([(plain_features(texts[i]), y) for i, y in order if i in texts])
    clash = df.selectExpr("doc_id", "text", "'x' AS score", "1 AS label", "2 AS places")
    got = toxicity.score(clash.unionByName(clash), toxicity.learn(clash, labels)).collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        assert abs(r.score - 1 / (1 + np.exp(-sum(w.get(f, 0.0) for f in plain_features(texts[r.doc_id]))))) < 1e-9


@pytest.mark.parametrize("name", ["op2_decontaminate", "op3_ngram_join", "op4_url_filters", "op8_warc", "op10_quality"])
def test_registered_queries_agree_with_their_sql(spark, name):
    import duckdb

    from lamina.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, "/root/testdata/sf0.001").select(*columns).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", ["op5_langid", "op6_toxicity"])
def test_registered_models_hold_out_their_rows(spark, name):
    from lamina.llm import queries

    n = {"op5_langid": (3, 1), "op6_toxicity": (5, 0)}[name]
    got = queries.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n[0] == n[1]) and 0 <= r.score <= 1 for r in got)
    if name == "op6_toxicity":
        assert all(r.predicted == int(r.score >= 0.5) for r in got)


def test_tokens_round_trip(docs, empty):
    from tokenizers import Tokenizer

    t, pos = Tokenizer.from_file(TOKENIZER), 0
    got = {r.doc_id: r for r in tokens.round_trip(docs, TOKENIZER).collect()}
    for i, text in enumerate(TEXTS):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids, got[i].ids_crc32) == (pos, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        pos += len(ids)
    assert tokens.round_trip(empty, TOKENIZER).count() == 0


ODD = [
    "a  b", " a", "a ", "a\n b", "a \nb", "a\n\n b \n c", "don't stop, I'll go! '1 ''s --'s 'tis l'été", "x  y", "1,2 3.4", "é, ü. ß! ×÷ a×b ª º", "a\0 b", "<|endoftext|> z", "tab\t x", "", None,
    "x\u00a0 y \u2003z \u3000 w\u1680 \u0085 q", "漢字 かな, 12½ x²", "end  ", "  start", "\x1c \x1d a\x7fb", "a" * 300 + " 5" * 300, "🙂 🙂🙂 a🙂b", "e\u0301 a\u0308, o", " \t \r\n  v\v\f", "|| ## ** a_b-c (d) [e]",
]


def test_pieces_equal_the_library(monkeypatch):
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("aB1,' \n\té×\u00a0漢\u2003.-"), rng.integers(1, 60))) for _ in range(3000)]
    for remember in (tokens.REMEMBER, 5):
        monkeypatch.setattr(tokens, "REMEMBER", remember)
        p = tokens.Pieces(TOKENIZER)
        assert p.splits
        for texts in (ODD, made[:1500], made[1500:], ODD, [], [None, ""]):
            ids, at = p.encode(pa.array(texts, pa.string()))
            want = [p.library.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert [ids[a:b].tolist() for a, b in itertools.pairwise(at)] == want


def test_words_go_past_the_pattern():
    """Finding the pattern's pieces in words took as long as merging them: the check found 418 CPU seconds a GB."""
    p = tokens.Pieces(TOKENIZER)
    library, asked = p.library, []

    class Watched:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

    p.library = Watched()
    texts = ["Words of letters été ÀÖ, 1234 signs --- and (these).", "other wor漢ds", None, "x" * 70 + " thonintiwh" * 3, " ", "12 a1 Ġ"]
    for _ in range(2):
        ids, at = p.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(at)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert asked and not any(word in " ".join(asked) for word in ("letters", "été", "ÀÖ", "1234", "---", "other", "thonintiwh", "xx"))


def test_words_are_one_piece_to_the_library():
    pattern = tokens.Pieces(TOKENIZER).library.pre_tokenizer
    rng = np.random.default_rng(5)
    for text in [*(t for t in ODD if t), *("".join(rng.choice(list("aB1,' \né×\u00a0漢.-"), 40)) for _ in range(300))]:
        data = np.frombuffer(text.encode(), np.uint8)
        at = tokens.stretches(data, np.array([0, len(data)]))
        for i in np.flatnonzero(tokens.words(data, at)).tolist():
            (piece, _), = pattern.pre_tokenize_str(data[at[i] : at[i + 1]].tobytes().decode())
            assert piece == data[at[i] : at[i + 1]].tobytes().decode("latin-1").translate(tokens.SPELLED)


@pytest.mark.parametrize("frame", [tokens.FRAME, 7, 1])
def test_tokens_of_repeated_and_null_keys_in_several_frames(spark, frame):
    rows = [(1, "one two three"), (1, None), (1, "one two three"), (None, "null key"), (None, ""), (2, "x " * 500), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    p = tokens.Pieces(TOKENIZER)
    got = sorted(tokens.round_trip(docs, TOKENIZER, frame=frame).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 1, 1, 2, 3]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    ids = lambda t: [*p.library.encode(t or "", add_special_tokens=False).ids, 0]
    assert sorted(((r.doc_id or 0, r.ids) for r in got)) == sorted(((k or 0, ids(t)) for k, t in rows))


def test_frames_go_to_workers_one_at_a_time(spark, monkeypatch):
    """A shard has the more frames the more it holds; JVM and worker held all of them at once."""
    frugal = tokens.frugal

    def watched(run):
        def alone(batches):
            for b in batches:
                assert "ids" not in b.schema.names or b.num_rows == 1, f"{b.num_rows} frames at once"
                yield b

        return frugal(lambda batches: run(alone(batches)))

    monkeypatch.setattr(tokens, "frugal", watched)
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    before = [spark.conf.get(f"spark.sql.{c}") for c in ("execution.arrow.maxRecordsPerBatch", "parquet.columnarReaderBatchSize")]
    assert tokens.round_trip(docs, TOKENIZER, frame=5).count() == 40
    assert before == [spark.conf.get(f"spark.sql.{c}") for c in ("execution.arrow.maxRecordsPerBatch", "parquet.columnarReaderBatchSize")]


def test_coding_of_long_and_damaged_frames():
    ids = np.random.default_rng(1).zipf(1.3, 200_001) % 5000
    table = tokens.Table(tokens.quantise(np.bincount(ids, minlength=5000)))
    raw = tokens.encode_frame(np.array([7]), np.array([1]), np.array([len(ids)]), ids, 3, table)

    def reader(data):
        at = iter([data[i : i + 4096] for i in range(0, len(data), 4096)])
        held = [b""]

        def read(n):
            held[0] = held[0] or next(at, b"")
            out, held[0] = held[0][:n], held[0][n:]
            return out

        return read

    (_, _, _, back, before), = tokens.read_frames(reader(raw), table)
    assert (back == ids).all() and before == 3 and len(raw) < 2 * len(ids)
    with pytest.raises(ValueError):
        list(tokens.read_frames(reader(raw[:-5000] + b"\0" * 5000), table))
    with pytest.raises(ValueError):
        list(tokens.read_frames(reader(raw[:-1]), table))


def test_warc(spark):
    body = "<p>" + "x" * 200
    rows = [(3, "http://a/", body), (1, None, body), (2, "http://b/\r\nX: y", body), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "é" * 99), (None, "v", body), (None, "w x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.select("*", F.lit("clash").alias("digest"), F.lit("clash").alias("first"))
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    none = [r for r in warc.round_trip(pages).collect() if r.page_id is None]
    assert sorted((r.url, r.record_type, r.refers_to, r.payload_bytes) for r in none) == [("v", "response", None, 203), ("w%20x", "response", None, 0)]
    del got[None]
    assert got[1].url == "urn:page:1" and got[2].url == "http://b/%0D%0AX:%20y"
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {i: ("revisit", 1) if i in (2, 3) else ("response", None) for i in range(1, 8)}
    for i, _, html in rows[:-2]:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), sha256(raw).hexdigest())
    assert warc.round_trip(pages.limit(0)).count() == 0
    member = warc.record(1, "u", b"abc", sha256(b"abc").hexdigest(), None, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member[:-3]).read))
    with pytest.raises(ValueError):
        warc.parse(zlib.decompress(member, 31).replace(b"abc", b"abd"))


def test_mixing(docs, empty, spark):
    for leaf in (mixing.LEAF, 1):
        got = mixing.mix(docs, F.array("source"), leaf=leaf).collect()
        size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(TEXTS)}
        assert {r.doc_id: r["size"] for r in got} == size
        assert all(0 <= r.taken <= 2 * r["size"] for r in got)
        assert sorted(got) == sorted(mixing.mix(docs, F.array("source"), leaf=leaf).collect())
        for t in {(r.source_size, r.target) for r in got}:
            assert sum(r.taken for r in got if (r.source_size, r.target) == t) <= t[1] + 1
    assert mixing.targets({"a": 100, "b": 100, None: 100}, 300) == {"a": 200.0, "b": 250 / 3, None: 500 / 3}
    flow = mixing.min_cost_flow({"x": 10, "y": 10}, {"x": ["a"], "y": ["a", "b"]}, {"a": 15, "b": 15})
    assert sum(flow.values()) == 30 and flow["x", "a"] >= 5
    assert mixing.mix(empty, F.array("source")).count() == 0


def test_mixing_of_marks_ties_and_overlapping_sources(spark):
    """Sources that hold the marks of patterns, repeated rows, and documents in several sources, against the definition of targets."""
    odd = ["\x01", "a\x01b", "\x02", "\x02-", "~", "s", "", None, "a", "b"]
    rows = [(k, odd[k % len(odd)], "w " * (1 + k % 7), "clash") for k in range(400)] + [(399, odd[9], "w " * 5, "clash")] * 2
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string, taken string"), F.array("source"), keep=["source", "taken"]).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    goal = mixing.targets(sizes, sum(sizes.values()))
    for s in odd:
        mine = [r for r in got if r.source == s]
        assert {(r.source_size, r.target) for r in mine} == {(sizes[s], goal[s])}
        assert abs(sum(r.taken for r in mine) - goal[s]) <= 8, s
    both = spark.createDataFrame([(k, ["x"] if k % 3 == 0 else ["x", "y"] if k % 3 == 1 else ["z"], "w " * 3) for k in range(300)], "doc_id long, sources array<string>, text string")
    got = mixing.mix(both, F.col("sources"), keep=["sources"]).collect()
    # x holds 600 words, y and z 300 each: 150 % of the 900 there are, by 3, 1, 2; x can take 600 of its own and 2 x 300 that it shares with y
    goal = mixing.targets({"x": 600, "y": 300, "z": 300}, 900)
    assert abs(sum(r.taken for r in got if "z" in r.sources) - goal["z"]) <= 6
    assert abs(sum(r.taken for r in got if "z" not in r.sources) - goal["x"] - goal["y"]) <= 6
    assert all(r.taken <= 2 * r["size"] for r in got)


@pytest.mark.parametrize("leaf", [mixing.LEAF, 8])
def test_mixing_goes_on_behind_documents_that_do_not_fit(spark, leaf):
    rows = [(k, f"s{s}", "w " * (600 if k % 100 == 7 else 2 + k % 13)) for s in range(12) for k in range(s * 1000, s * 1000 + 300)]
    rows += [(5000 + k // 30, "s5", "w " * 9) for k in range(300)]  # equal ones are taken or left together
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), F.array("source"), keep=["source"], leaf=leaf).collect()
    for source in {s for _, s, _ in rows}:
        mine = [r for r in got if r.source == source]
        least, left_out = min(r.taken // r["size"] for r in mine), {}
        for r in mine:
            if r.taken == least * r["size"]:
                left_out[r.doc_id, r["size"]] = left_out.get((r.doc_id, r["size"]), 0) + r["size"]
        short = mine[0].target - sum(r.taken for r in mine)
        assert -1 <= short < min(left_out.values()) + 1, source


def test_quality(docs, empty):
    got = {r.doc_id: r for r in quality.score_quality(docs).collect()}
    for i, t in enumerate(TEXTS):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)} if len(words) < 1000 else set()
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == want, i
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert got[i].base_failed == failed and not (failed and got[i].kept)
        assert got[i].source == [None, "a", "b", "c"][i % 4]
    assert quality.score_quality(empty).count() == 0


LISTED = [
    ("l1", "block", "bad.org", "2024-01-05", True), ("l1", "block", "bad.org", "2024-01-05", True), ("l1", "block", "bad.org", "2024-01-20", False),
    ("l1", "block", "Bad.org.", "2024-03-01", True), ("l2", "block", "x.bad.org", "2024-01-10", True), ("l3", "allow", "x.bad.org/ok/", "2024-01-01", True),
    ("l2", "block", "same.net", "2024-01-01", True), ("l2", "block", "same.net", "2024-01-01", False), ("l2", "block", None, "2024-01-01", True),
    ("l2", "block", "never.net", None, True), ("l2", "block", "0.0.1", "2023-01-01", True), ("l4", "allow", "bad.org", "2024-03-02", True),
]
CAPTURED = ["http://bad.org", "https://u:p@X.bad.org:8/ok//page?q#f", "http://x.bad.org/okay", "http://notbad.org/", "http://same.net/", "http://10.0.0.1/", None, "bad.org", "", "http://x.bad.org./" + "a/" * 5000]


@pytest.mark.parametrize(("limit", "hot"), [(urlfilter.BROADCAST_BYTES, 10**6), (0, 10**6), (0, 3)])
def test_url_filters(spark, limit, hot):
    entries = spark.createDataFrame(LISTED, "list string, verdict string, pattern string, at string, listed boolean")
    days = ["2024-01-04", "2024-01-05", "2024-01-15", "2024-01-20", "2024-03-01", "2024-03-03", None]
    rows = [(i, u, d, "clash", "clash") for i, (u, d) in enumerate(itertools.product(CAPTURED, days))]
    captures = spark.createDataFrame([*rows, rows[2]], "id long, url string, fetched string, host string, key string").repartition(3)
    got = urlfilter.judge(captures, entries, broadcast_bytes=limit, hot=hot).collect()
    assert len(got) == len(rows) + 1 and len([r for r in got if r.id == 2]) == 2
    plain = [("l1", "block", "bad.org", "2024-01-05", "2024-01-20"), ("l1", "block", "bad.org", "2024-03-01", "9"), ("l2", "block", "x.bad.org", "2024-01-10", "9"),
             ("l3", "allow", "x.bad.org/ok", "2024-01-01", "9"), ("l4", "allow", "bad.org", "2024-03-02", "9")]
    hosts = ["bad.org", "x.bad.org", "x.bad.org", "notbad.org", "same.net", "10.0.0.1", None, None, None, "x.bad.org"]
    for r in got:
        host, ok = hosts[CAPTURED.index(r.url)], r.url == CAPTURED[1]
        hits = [e for e in plain if host and r.fetched and e[3] <= r.fetched < e[4] and (("." + host).endswith("." + e[2]) or (ok and "/" in e[2]))]
        top = max(hits, key=lambda e: ("/" in e[2], len(e[2]), e[1] == "allow"), default=(None, None, None))
        want = (host, len(hits), ",".join(sorted({e[0] for e in hits})), top[2], top[0], top[1] == "block")
        assert (r.host, r.n_active, r.lists, r.rule, r.rule_list, r.blocked) == want, r
        assert r.key == "clash"
    assert urlfilter.judge(captures.limit(0), entries).count() == 0
    assert {r.n_active for r in urlfilter.judge(captures, entries.limit(0)).collect()} == {0}


def test_tokenizer_goes_from_a_worker_once_texts_are_encoded(spark):
    """One task after another in this process, as in a worker: what comes after the encoding holds no tokenizer."""
    tokens.pieces(TOKENIZER).encode(pa.array(["a text, and a text"]))
    assert tokens.pieces.cache_info().currsize == 1
    tokens.forget()
    assert tokens.pieces.cache_info().currsize == 0
    tokens.forget()
    docs = spark.createDataFrame([(1, "a text, and a text"), (2, None)], "doc_id long, text string")
    got = [tuple(r) for r in tokens.round_trip(docs, TOKENIZER, with_ids=False).select("doc_id", "start").orderBy("doc_id").collect()]
    assert got[0] == (1, 0) and got[1][1] > 1
