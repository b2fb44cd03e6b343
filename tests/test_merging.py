"""Merges, trees of links and folders, snapshots, intake streams, patterns as data, bounded calls, provenance and reports."""

import hashlib
import json
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lamina.operators import enrich, fingerprint, learned, match, merge, provenance, tree
from lamina.sources import files, reports, snapshots
from lamina.streaming import intake

# --- links and trees


def plain_roots(links):
    at = {}
    for k, of in links:
        if k is not None and of is not None and k != of:
            at[k] = min(of, at.get(k, of))
    out = {}
    for k in at:
        seen, now = [], k
        while now in at and now not in seen:
            seen.append(now)
            now = at[now]
        out[k] = (min(seen[seen.index(now) :]), -1) if now in at else (now, len(seen))
    return out


@pytest.mark.parametrize("links", [
    [], [("b", "a")], [("c", "b"), ("b", "a"), ("d", "c")], [("a", "a"), ("b", None), (None, "b")], [("a", "b"), ("b", "c"), ("c", "a"), ("x", "c"), ("w", "x")],
    [(f"k{i + 1:03d}", f"k{i:03d}") for i in range(70)], [(f"m{i}", "hub") for i in range(50)] + [("hub", "top"), ("hub", "zzz"), ("m1", "hub")],
])
def test_roots(spark, links):
    got = tree.roots(spark.createDataFrame(links, "k string, of string"), "k", "of").collect()
    assert {r.k: (r.root, r.steps) for r in got} == plain_roots(links)


def test_nearest_listed_folder(spark):
    listed = spark.createDataFrame([("/a", "A"), ("/a/b/c/", "C"), ("", "top"), ("x\\y", "Y")], "at string, label string")
    rows = spark.createDataFrame([("/a",), ("/a/b",), ("/a/b/c/d",), ("/ab",), ("x/y/z",), (None,), ("",), ("/",)], "folder string")
    got = {r.folder: (r.label, r._depth) for r in tree.nearest(rows, "folder", listed, "at").collect()}
    assert got == {"/a": ("A", 1), "/a/b": ("A", 1), "/a/b/c/d": ("C", 3), "/ab": ("top", 0), "x/y/z": ("Y", 2), None: (None, None), "": ("top", 0), "/": ("top", 0)}
    none = tree.nearest(rows, "folder", listed.limit(0), "at").collect()
    assert len(none) == 8 and all(r.label is None for r in none)


def test_nearest_is_the_same_when_listed_folders_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(tree, "MOST_SENT", 1)
    test_nearest_listed_folder(spark)


def test_emptied_folders_come_deepest_first(spark):
    every = ["/r/a/1", "/r/a/b/2", "/r/a/b/c/3", "/r/d/4", "/r/d/e/5", "/r/6", "/s/7"]
    rows = spark.createDataFrame([(p,) for p in every], "path string")
    gone = lambda *ps: [(r.folder, r.n) for r in tree.emptied(rows, spark.createDataFrame([(p,) for p in ps], "path string"), "path", "/r/").collect()]
    assert gone("/r/a/1", "/r/a/b/2", "/r/a/b/c/3", "/r/d/e/5") == [("/r/a/b/c", 1), ("/r/a/b", 2), ("/r/d/e", 1), ("/r/a", 3)]
    assert gone("/r/a/b/2") == [] and gone() == []
    assert [f for f, _ in gone(*every)] == ["/r/a/b/c", "/r/a/b", "/r/d/e", "/r/a", "/r/d"]


def test_unique_names_of_a_hot_name(spark):
    rows = spark.range(300).select(F.format_string("k%03d", "id").alias("k"), F.lit("IMG.jpg").alias("n"))
    got = {r.k: r.unique_name for r in match.unique_names(rows, "n", "k", taken=spark.createDataFrame([("IMG.jpg",), ("IMG_merged_2.jpg",)], "n string"), mark="_merged_").collect()}
    free = [i for i in range(1, 400) if i != 2]
    assert got == {f"k{i:03d}": f"IMG_merged_{free[i]}.jpg" for i in range(300)}


# --- merges

HASHES = "uuid string, phash string, md5_hash string, ordinal int"
NOTES = "uuid string, original_path string, class_label string, campaign_year string, comentarios string, created_at string, ordinal int"


def near(n):
    """A hash that is n bits away from that of nought."""
    return f"{(1 << n) - 1:016x}"


@pytest.fixture(scope="module")
def batch(spark):
    kept_hashes = [("k1", "f" * 16, "m1", 1), ("k2", "f" * 16, "m2", 2), ("k3", "0" * 16, "m3", 3), ("k4", None, "m4", 4), ("bare", "a" * 16, "m5", 5)]
    kept = [("k1", "/old/1", "Insecta", None, "short", "t", 1), ("k2", "/old/2", None, "2001", None, "t", 2), ("k3", "/old/3; /old/3b", None, None, None, "t", 3), ("k4", None, "", "nan", "", "t", 4)]
    staged_hashes = [
        ("s1", "f" * 16, "x1", 1),  # as k1, the first of its hash
        ("s2", near(2), "x2", 2),  # near k3
        ("s3", near(5), "x3", 3),  # near s2, not near k3: a chain of two links
        ("s4", near(8), "x4", 4),  # near s3: three links
        ("s5", None, "m4", 5),  # as k4 by digest
        ("s6", "a" * 16, "m5", 6),  # matches a row that has no annotation
        ("s7", "b" * 16, "y", 7), ("s8", "b" * 16, "z", 8), ("s9", "", "y", 9), ("lost", "c" * 16, "w", 10), ("", "d" * 16, "v", 11), ("s12", "f" * 16, "m4", 12),
    ]
    staged = [
        ("s1", "/new/1", "Arachnida", "1999", "a longer comment", "u", 1), ("s2", "/new/2", "Insecta", None, "two", "u", 2), ("s3", "/new/3; /old/3", "Aves", "2003", "three words", "u", 3),
        ("s4", "/deep/a/4", "Pisces", "2004", "4", "u", 4), ("s5", "/new/5", "Reptilia", "2005", None, "u", 5), ("s6", "/new/6", None, None, None, "u", 6), ("s7", "/new/7", None, "2007", None, "u", 7),
        ("s8", "/new/8; /new/7", "Mammalia", None, "m", "u", 8), ("s9", None, "Aves", "nan", None, "u", 9), ("s7", "/again", "Twice", None, None, "u", 99), ("nohash", "/x", "X", None, None, "u", 50), ("s12", "/new/12", "Arachnida", "2012", "short", "u", 12),
    ]
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    return make(staged, NOTES), make(kept, NOTES), make(staged_hashes, HASHES), make(kept_hashes, HASHES)


@pytest.fixture(scope="module")
def found(batch):
    staged, kept, staged_hashes, kept_hashes = batch
    return snapshots.written(merge.links(staged_hashes, kept_hashes, kept, most=3))


def test_links_reach_roots_through_the_batch(found):
    got = {r.uuid: (r["of"], r.how, r.inside, r.root, r.steps) for r in found.collect()}
    assert got == {
        "s1": ("k1", "perceptual", False, "k1", 1), "s2": ("k3", "near", False, "k3", 1), "s3": ("s2", "near", True, "k3", 2), "s4": ("s3", "near", True, "k3", 3), "s5": ("k4", "exact", False, "k4", 1),
        "s8": ("s7", "perceptual", True, "s7", 1), "s9": ("s7", "exact", True, "s7", 1), "s12": ("k1", "perceptual", False, "k1", 1),
    }


def test_merge_gathers_chains_at_their_roots(spark, batch, found):
    staged, kept, staged_hashes, kept_hashes = batch
    out = merge.merge(staged, kept, found, staged_hashes, kept_hashes)
    rows = {r.uuid: r for r in out.annotations.collect()}
    assert set(rows) == {"k1", "k2", "k3", "k4", "s6", "s7"} and {k for k, r in rows.items() if r.origin == "new"} == {"s6", "s7"}
    say = lambda k: tuple(rows[k][c] for c in ("original_path", "class_label", "campaign_year", "comentarios"))
    assert say("k1") == ("/old/1; /new/1; /new/12", "Insecta", "1999", "a longer comment")
    assert say("k3") == ("/old/3; /old/3b; /new/2; /new/3; /deep/a/4", "Insecta", "2003", "three words")
    assert say("k4") == ("/new/5", "Reptilia", "2005", None)
    assert say("s7") == ("/new/7; /new/8", "Mammalia", "2007", "m")
    assert say("k2") == ("/old/2", None, "2001", None)
    assert {r.uuid: (r.duplicate_of, r.root) for r in out.duplicates.collect()} == {"s1": ("k1", "k1"), "s2": ("k3", "k3"), "s3": ("s2", "k3"), "s4": ("s3", "k3"), "s5": ("k4", "k4"), "s8": ("s7", "s7"), "s9": ("s7", "s7"), "s12": ("k1", "k1")}
    assert {r.uuid for r in out.hashes.collect()} == {"k1", "k2", "k3", "k4", "bare", "s6", "s7"}
    assert {(r.uuid, r.field, r.existing, r.staged) for r in out.conflicts.collect()} == {
        ("s1", "class_label", "Insecta", "Arachnida"), ("s12", "class_label", "Insecta", "Arachnida"), ("s12", "campaign_year", "1999", "2012"), ("s3", "class_label", "Insecta", "Aves"), ("s4", "class_label", "Insecta", "Pisces"), ("s4", "campaign_year", "2003", "2004"), ("s9", "class_label", "Mammalia", "Aves"),
    }
    assert sum(r.n for r in merge.summary(out).collect() if r.part.startswith("conflicts_")) == 7


def test_decisions_of_the_nearest_folder_hold(spark, batch, found):
    staged, kept, staged_hashes, kept_hashes = batch
    decisions = spark.createDataFrame([("/new", "existing"), ("/deep", "staged"), ("/deep/b", "existing")], "folder string, choice string")
    out = merge.merge(staged, kept, found, staged_hashes, kept_hashes, decisions, default="staged")
    rows = {r.uuid: (r.class_label, r.campaign_year) for r in out.annotations.collect()}
    # s4 comes from /deep/a; s9 has no path, so the default holds for it
    assert rows["k3"] == ("Pisces", "2004") and rows["k1"] == ("Insecta", "1999") and rows["s7"] == ("Aves", "2007")


def test_merge_of_empty_tables(spark, batch):
    staged, kept, staged_hashes, kept_hashes = batch
    no = merge.links(staged_hashes.limit(0), kept_hashes, kept, most=3)
    out = merge.merge(staged.limit(0), kept, no, staged_hashes.limit(0), kept_hashes)
    assert out.annotations.count() == 4 and out.hashes.count() == 5 and out.duplicates.count() == 0 and out.conflicts.count() == 0
    first = merge.links(staged_hashes, kept_hashes.limit(0), kept.limit(0), most=3)
    out = merge.merge(staged, kept.limit(0), first, staged_hashes, kept_hashes.limit(0))
    assert {r.uuid for r in out.annotations.collect()} == {"s1", "s2", "s5", "s6", "s7"}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    hashes = [f"{rng.choice([0, 1 << 63, (1 << 40) - 1]) ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))):016x}" for _ in range(60)]
    rows = lambda mark: [(f"{mark}{i:02d}", rng.choice([*hashes, None, ""]), rng.choice(["d1", "d2", f"own{mark}{i}", None]), i) for i in range(60)]
    s, k = rows("s"), rows("k")
    notes = [(r[0],) for r in k if rng.random() < 0.7]
    far = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")

    def pick(row, others):
        for how, hit in (("perceptual", lambda o: row[1] and row[1] == o[1]), ("near", lambda o: row[1] and o[1] and 0 < far(row[1], o[1]) <= 3), ("exact", lambda o: row[2] and row[2] == o[2])):
            same = [o for o in others if hit(o)]
            if same:
                return min(same, key=lambda o: (o[3], o[0]))[0], how
        return None

    want = {}
    known = {r[0] for r in notes}
    for row in s:
        m = pick(row, k)
        if m is None or m[0] not in known:
            m = pick_first(row, s, far)
        if m is not None:
            want[row[0]] = m
    got = merge.links(spark.createDataFrame(s, HASHES), spark.createDataFrame(k, HASHES), spark.createDataFrame(notes, "uuid string"), most=3).collect()
    assert {r.uuid: (r["of"], r.how) for r in got} == want
    ends = plain_roots([(a, b[0]) for a, b in want.items()])
    assert {r.uuid: (r.root, r.steps) for r in got} == ends


def pick_first(row, batch, far):
    """The first row of the batch with the same hash, a near one or the same digest counts if it comes before."""
    tests = (("perceptual", lambda o: row[1] and row[1] == o[1]), ("near", lambda o: row[1] and o[1] and 0 < far(row[1], o[1]) <= 3), ("exact", lambda o: row[2] and row[2] == o[2]))
    for how, hit in tests:
        same = [o for o in batch if hit(o)]
        if same and (first := min(same, key=lambda o: (o[3], o[0])))[3] < row[3]:
            return first[0], how
    return None


def test_file_plan(spark, found):
    rel = {"s1": "a/x.jpg", "s2": "b/x.jpg", "s6": "a/new.jpg", "s7": "a/old.jpg", "s8": "c/x.jpg", "t1": "keep/old.jpg", "t2": "over/old.jpg", "t3": "both/old.jpg", "t4": "both/in/old.jpg"}
    staged = spark.createDataFrame(list(rel.items()), "uuid string, rel string")
    taken = spark.createDataFrame([(p,) for p in ("a/old.jpg", "keep/old.jpg", "over/old.jpg", "both/old.jpg", "both/in/old.jpg", "both/in/old_merged_1.jpg", "Duplicados/x.jpg", "Duplicados/x_2.jpg")], "rel string")
    decisions = spark.createDataFrame([("over", "overwrite"), ("both", "both")], "folder string, choice string")
    got = {r.uuid: (r.action, r.target) for r in merge.file_plan(staged, taken, found, decisions=decisions).collect()}
    assert got == {
        "s1": ("duplicate", "Duplicados/x_1.jpg"), "s2": ("duplicate", "Duplicados/x_3.jpg"), "s8": ("duplicate", "Duplicados/x_4.jpg"), "s6": ("copy", "a/new.jpg"), "s7": ("keep", None),
        "t1": ("keep", None), "t2": ("overwrite", "over/old.jpg"), "t3": ("merged", "both/old_merged_1.jpg"), "t4": ("merged", "both/in/old_merged_2.jpg"),
    }


def test_copy_plan_gives_each_file_a_name_of_its_own(spark):
    staged = spark.createDataFrame([("d/y.jpg", "1"), ("d/y.jpg", "2"), ("z.jpg", "3"), ("z.jpg", "4"), ("n", None), ("z.jpg", "4"), ("w.jpg", "9")], "rel string, digest string")
    kept = spark.createDataFrame([("d/y.jpg", "8"), ("d/y_merged_1.jpg", "7"), ("k", "9")], "rel string, digest string")
    got = {(r.rel, r.digest): (r.action, r.new_rel) for r in files.copy_plan(staged, kept).collect()}
    assert got == {("d/y.jpg", "1"): ("rename", "d/y_merged_2.jpg"), ("d/y.jpg", "2"): ("rename", "d/y_merged_3.jpg"), ("z.jpg", "3"): ("copy", None), ("z.jpg", "4"): ("rename", "z_merged_1.jpg"), ("n", None): ("copy", None), ("w.jpg", "9"): ("duplicate", None)}


def test_first_folders_of_a_root_with_odd_characters(spark):
    rows = spark.createDataFrame([("/a/b+c/x/1.jpg", "image"), ("/a/b+c/x/y/2.jpg", "image"), ("/a/b+c/z/3.txt", "text"), ("/a/b+c/4.jpg", "image"), ("/a/bbc/x/5.jpg", "image")], "path string, type string")
    assert [tuple(r) for r in files.top_folders(rows, "/a/b+c").collect()] == [("x", 2)]
    assert sorted(tuple(r) for r in files.top_folders(rows, "/a/b+c/", None).collect()) == [("x", 2), ("z", 1)]


# --- snapshots


class Killed(Exception):
    pass


def test_a_killed_run_goes_on_behind_its_last_stage(spark, tmp_path):
    ran, kill = [], ["third"]

    def step(name, f):
        def run(df):
            ran.append(name)
            if name in kill:
                raise Killed(name)
            return f(df)

        return snapshots.Stage(name, run)

    stages = [step("first", lambda d: d.withColumn("a", F.col("id") * 2)), step("second", lambda d: d.filter("a % 3 = 0")), step("third", lambda d: d.withColumn("b", F.col("a") + 1)), step("fourth", lambda d: d.agg(F.sum("b").alias("s")))]
    source, store = spark.range(50), snapshots.Snapshots(spark, str(tmp_path / "state"))
    with pytest.raises(Killed):
        store.run(source, stages)
    kill.clear()
    out = snapshots.Snapshots(spark, str(tmp_path / "state")).run(source.repartition(7), stages)
    assert (out.kept, out.ran) == (["first", "second"], ["third", "fourth"]) and ran == ["first", "second", "third", "third", "fourth"]
    assert [tuple(r) for r in out.result.collect()] == [(sum(2 * i + 1 for i in range(50) if 2 * i % 3 == 0),)]
    # nothing new: nothing runs; other rows, or another version of a stage: it and what stands behind it run
    assert store.run(source, stages).ran == []
    assert store.run(spark.range(51), stages).kept == []
    newer = [*stages[:2], snapshots.Stage("third", stages[2].run, "2"), stages[3]]
    again = store.run(source, newer)
    assert (again.kept, again.ran) == (["first", "second"], ["third", "fourth"])


def test_a_torn_snapshot_does_not_count(spark, tmp_path):
    store = snapshots.Snapshots(spark, str(tmp_path / "state"))
    store.save("one", spark.range(3), "k1")
    spark.range(99).write.parquet(str(tmp_path / "state" / "one" / "torn" / "rows"))
    assert store.read("one").count() == 3 and store.read("one", "k2") is None and store.read("two") is None
    store.save("one", spark.range(4), "k2")
    assert store.read("one").count() == 4 and store.read("one", "k1").count() == 3 and [m["number"] for m in store.markers("one")] == [1, 2]
    store.clean("one")
    assert store.read("one").count() == 4 and store.read("one", "k1") is None and len(list((tmp_path / "state" / "one").iterdir())) == 1


def test_content_key_depends_on_rows_and_not_on_their_order(spark):
    df = spark.createDataFrame([(1, "a", {"x": 1}), (2, None, None), (2, None, None)], "k int, v string, m map<string,int>")
    key = snapshots.content_key(df, "p")
    assert key == snapshots.content_key(df.repartition(3).orderBy(F.desc("k")).select("m", "v", "k"), "p")
    assert len({key, snapshots.content_key(df.limit(2), "p"), snapshots.content_key(df, "q"), snapshots.content_key(df.withColumnRenamed("v", "w"), "p"), snapshots.content_key(df.limit(0))}) == 5


@pytest.mark.parametrize("crash", ["before", "aside", "placed"])
def test_a_registry_survives_a_crash_while_it_is_saved(spark, tmp_path, crash):
    path = str(tmp_path / "reg")
    schema = spark.range(1).schema
    files.save_registry(spark.range(3), path)
    store = snapshots.Store(spark, str(tmp_path))
    spark.range(5).write.parquet(f"{path}.new")
    if crash in ("aside", "placed"):
        store.rename("reg", "reg.old")
    if crash == "placed":
        store.rename("reg.new", "reg")
    assert files.registry(spark, path, schema).count() == (3 if crash == "before" else 5)
    files.save_registry(files.registry(spark, path, schema).limit(2), path)  # from itself
    assert files.registry(spark, path, schema).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["reg"]


# --- intake


def put(folder, names):
    for name, text in names.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)


def take(spark, folder, registry, state, **more):
    intake.run(intake.arrivals(spark, str(folder)), str(registry), str(state), key="name", **more).awaitTermination()


def test_three_batches_equal_one(spark, tmp_path):
    batches = [{"LH 001a.jpg": "one", "b.txt": "two", "c.txt": "one"}, {"d.txt": "two", "e.txt": "three", ".hidden": "one"}, {"f.txt": "three", "g.txt": "four", "h.txt": "two"}]
    for k, names in enumerate(batches):
        put(tmp_path / "in", names)
        take(spark, tmp_path / "in", tmp_path / "by3", tmp_path / "s3", prepare=intake.described)
    put(tmp_path / "all", {n: t for names in batches for n, t in names.items()})
    take(spark, tmp_path / "all", tmp_path / "by1", tmp_path / "s1", prepare=intake.described)
    rows = lambda r: sorted((x.name, x.duplicate_of, x.how) for x in intake.taken_in(spark, str(tmp_path / r)).collect())
    want = [("LH 001a.jpg", None, None), ("b.txt", None, None), ("c.txt", "LH 001a.jpg", "digest"), ("d.txt", "b.txt", "digest"), ("e.txt", None, None), ("f.txt", "e.txt", "digest"), ("g.txt", None, None), ("h.txt", "b.txt", "digest")]
    assert rows("by3") == rows("by1") == want
    info = {x.name: x.info.specimen for x in intake.taken_in(spark, str(tmp_path / "by3")).collect()}
    assert info["LH 001a.jpg"].specimen_id == "LH-001-a" and info["b.txt"] is None


def test_a_batch_reads_the_buckets_it_touches_and_runs_twice_alike(spark, tmp_path):
    index = str(tmp_path / "index")
    df = spark.createDataFrame([(f"k{i}", f"v{i}", None if i % 2 else f"w{i % 4}") for i in range(40)], "k string, digest string, phash string")
    _, new = intake.match_batch(df, 0, index, "k", ["phash", "digest"])
    new.write.partitionBy("bucket").parquet(f"{index}/batch=0")
    one = intake.known(spark, index, 1, [r[0] for r in new.filter("kind = 1").select("bucket").limit(1).collect()])
    assert 0 < one.count() < 20
    later = spark.createDataFrame([("k99", "v3", "w2"), ("k98", "v5", ""), ("k97", None, None)], "k string, digest string, phash string")
    for _ in range(2):
        out, more = intake.match_batch(later, 1, index, "k", ["phash", "digest"])
        got = {r.k: (r.duplicate_of, r.how) for r in out.collect()}
        more.write.mode("overwrite").partitionBy("bucket").parquet(f"{index}/batch=1")
        assert got == {"k99": ("k10", "phash"), "k98": ("k5", "digest"), "k97": (None, None)}


def test_compacted_index_matches_as_before(spark, tmp_path):
    put(tmp_path / "in", {"a": "1", "b": "2"})
    take(spark, tmp_path / "in", tmp_path / "reg", tmp_path / "s")
    put(tmp_path / "in", {"c": "3"})
    take(spark, tmp_path / "in", tmp_path / "reg", tmp_path / "s")
    intake.compact(spark, str(tmp_path / "reg"))
    assert [p.name for p in (tmp_path / "reg" / "index").glob("batch=*")] == ["batch=1"]
    put(tmp_path / "in", {"d": "1", "e": "3"})
    take(spark, tmp_path / "in", tmp_path / "reg", tmp_path / "s")
    assert {x.name: x.duplicate_of for x in intake.taken_in(spark, str(tmp_path / "reg")).collect()} == {"a": None, "b": None, "c": None, "d": "a", "e": "c"}


# --- patterns as data


def test_patterns_of_all_kinds(spark):
    rows = [("named", r"(?P<prefix>[a-z]+)-(?P<specimen_id>\d+)", "lh-12"), ("first", r"([a-z]+)(\d+)?", "AB12"), ("whole", r"\d+", "x 34"), ("broken", r"(?P<a", "x"), ("slow", r"(a+)+$", "a" * 40 + "!"), ("none", None, "x"), ("noname", r"x", None), ("miss", r"\d", "x"), ("lazy", r"(?P<specimen_id>z)?\d", "5")]
    got = {r.k: r for r in learned.apply(spark.createDataFrame(rows, "k string, pattern string, name string").withColumn("error", F.lit("clash")), "pattern", "name").collect()}
    assert {k: r.value for k, r in got.items()} == {"named": "12", "first": "AB", "whole": "34", "broken": None, "slow": None, "none": None, "noname": None, "miss": None, "lazy": None}
    assert {k for k, r in got.items() if r.matched} == {"named", "first", "whole", "lazy"} and got["named"].groups == {"prefix": "lh", "specimen_id": "12"}
    assert got["broken"].error.startswith("bad pattern") and {k for k, r in got.items() if r.error} <= {"broken", "slow"}


def test_normalized_values(spark):
    rows = [("lh 12 B", {}), (None, {"prefix": "mup", "number": "7", "plate": "A"}), ("LH", {}), ("LH", {"collection": "k-bue", "id": "5"}), (None, None)]
    got = learned.normalized(spark.createDataFrame(rows, "value string, groups map<string,string>")).collect()
    assert [r.value for r in got] == ["LH-12-b", "MUP-7-a", None, "K-BUE-5", None]


@pytest.mark.parametrize("names, found", [
    (["LH 15083.jpg", "LH 15084.jpg", "LH 9.jpg"], "LH 15083"), (["LH-15083_a_x.jpg", "LH-15084_b_x.jpg"], "LH-15083_a"), (["DSC_0001.JPG", "DSC_0002.JPG"], "DSC_0001"),
    (["2009_MUP77b.png", "2009_MUP78a.png"], "MUP77b"), (["123.jpg"], "123"),
])
def test_learned_patterns_find_the_identifier(names, found):
    import regex

    pattern = learned.learn(names)
    assert regex.search(pattern, names[0]).group("specimen_id") == found
    assert all(regex.search(pattern, n) for n in names)
    assert all(regex.search(learned.learn(names, loose), n) for loose in (1, 2) for n in names)


def test_learned_patterns_of_nothing():
    assert learned.learn([]) is None and learned.learn(["", "abc"]) is None


def test_induction_refines_until_enough_match(spark):
    rows = [("even", f"LH {i}.jpg") for i in range(100)] + [("mixed", f"{'ABC'[i % 3] * (i % 3 + 1)}{'_- '[i % 3]}{i}{'x' * (i % 2)}.jpg") for i in range(90)] + [("bare", "none.jpg"), ("bare", "nothing.jpg"), (None, "LH 1"), ("even", None)]
    got = {r.folder: r for r in learned.induce(spark.createDataFrame(rows, "folder string, name string"), "folder", "name").collect()}
    assert (got["even"].attempt, got["even"].rate) == (0, 1.0)
    assert got["mixed"].attempt > 0 and got["mixed"].rate >= learned.ENOUGH
    assert got["bare"].pattern is None and got["bare"].n_matched == 0 and None not in got


# --- remote calls


def counting(folder, answer):
    def call(k):
        (folder / f"{time.time_ns()}-{random.random()}").write_text(k)
        return answer(k)

    return call


def asked(folder):
    out = defaultdict(int)
    for p in folder.iterdir():
        out[p.read_text()] += 1
    return dict(out)


def test_answers_are_kept_and_asked_for_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    ask = enrich.client(counting(calls, lambda k: {"n": len(k), "tags": [k, "t"]}), "n int, tags array<string>", "k", enrich.Limits(per_minute=1e6), kept=str(tmp_path / "kept"))
    keys = spark.createDataFrame([("a",), ("bb",), ("a",), (None,)], "k string")
    want = {("a", 1, ("a", "t")), ("bb", 2, ("bb", "t")), (None, None, None)}
    for _ in range(2):
        assert {(r.k, r.n, tuple(r.tags) if r.tags else None) for r in ask(keys).collect()} == want
    assert asked(calls) == {"a": 1, "bb": 1}


def test_calls_are_tried_again_only_where_that_helps(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def answer(k):
        if k == "busy":
            raise enrich.Busy(429)
        if k == "later" and sum(p.read_text() == k for p in calls.iterdir()) < 3:
            raise OSError("no route")
        if k == "bad":
            raise ValueError("no")
        return {"n": "text"} if k == "type" else {"n": 1}

    ask = enrich.client(counting(calls, answer), "n int", "k", enrich.Limits(per_minute=1e6, pause=0.01), tasks=2, kept=str(tmp_path / "kept"))
    got = {r.k: (r.n, r.calls, r.error) for r in ask(spark.createDataFrame([("busy",), ("later",), ("bad",), ("type",), ("ok",)], "k string")).collect()}
    assert got["ok"] == (1, 1, None) and got["later"] == (1, 3, None) and got["busy"] == (None, 3, "Busy: 429") and got["bad"] == (None, 1, "ValueError: no") and got["type"][0] is None and got["type"][2].startswith("n:")
    assert asked(calls) == {"busy": 3, "later": 3, "bad": 1, "type": 1, "ok": 1}


def test_a_bucket_keeps_its_rate():
    bucket = enrich.Bucket(60 / 0.02)
    began = time.monotonic()
    for _ in range(11):
        bucket.take()
    assert 0.19 <= time.monotonic() - began < 0.5


# --- provenance and reports


def test_provenance_of_two_steps(spark):
    rows = spark.createDataFrame([(1, "A", "B", " "), (2, None, "nan", "C"), (3, None, None, None)], "k int, p string, f string, l string")
    early = provenance.noted(specimen_id={"path_llm": F.col("p"), "filename_llm": F.col("f")}, free={"zz": F.col("f"), "aa": F.col("l")})
    late = provenance.noted(specimen_id={"pattern_extractor": F.col("l"), "filename_llm": F.col("p")})
    df = snapshots.written(rows.select("k", provenance.merged(early, late).alias("m")))
    got = {r.k: r for r in provenance.reconcile(df, "m", ["specimen_id", "free"]).collect()}
    assert [(got[k].specimen_id, got[k].free, got[k].n_conflicts) for k in (1, 2, 3)] == [("A", "B", 0), ("C", "C", 0), (None, None, 0)]
    assert got[1].m["specimen_id"] == {"path_llm": "A", "filename_llm": "A"} and got[3].m == {}
    two = df.withColumn("m", provenance.merged(F.col("m"), provenance.noted(specimen_id={"path_llm": F.lit("Z")})))
    assert [tuple(r) for r in provenance.discrepancies(two, "k", "m").orderBy("k").collect()] == [(1, "specimen_id", 2, "filename_llm", "filename_llm=A; path_llm=Z"), (2, "specimen_id", 2, "pattern_extractor", "path_llm=Z; pattern_extractor=C")]


def test_default_choices(spark):
    got = spark.createDataFrame([(k,) for k in [*provenance.DEFAULTS, "strange", None]], "k string").select("k", provenance.default_choice(F.col("k")).alias("c")).collect()
    assert {r.k: r.c for r in got} == provenance.DEFAULTS | {"strange": None, None: None}


def test_lists_stand_side_by_side(spark):
    lists = {"a": ["x", "y", "z"], "b": ["p"], "c": []}
    got = reports.side_by_side(**{k: spark.createDataFrame([(v,) for v in vs], "v string") for k, vs in lists.items()}).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(1, "x", "p", None), (2, "y", None, None), (3, "z", None, None)]


def test_a_log_counts_in_the_stage_s_own_job(spark, tmp_path):
    log = reports.Log(spark)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = log.watch("scan", spark.range(100), even=F.col("id") % 2 == 0, big=F.col("id") > 89)
    df.write.parquet(str(tmp_path / "out"))
    log.note("scan", "skipped", 3, "hidden")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before + 1
    assert {(r.stage, r.action, r.n) for r in log.close().collect()} == {("scan", "rows", 100), ("scan", "even", 50), ("scan", "big", 10), ("scan", "skipped", 3)}


def test_reports_are_written(spark, tmp_path):
    rows = reports.long_report(kinds=spark.createDataFrame([("image", 3)], "k string, n int"), years=spark.createDataFrame([(2009, 1)], "k int, n int"))
    reports.write_report(rows, str(tmp_path / "r"))
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "r")).collect()) == [("kinds", "image", "3"), ("years", "2009", "1")]
    open_ = reports.deferred(spark.createDataFrame([("a", "defer", "/x"), ("b", "keep", "/y")], "type string, outcome string, path string")).collect()
    assert [(r.type, json.loads(r.request)) for r in open_] == [("a", {"outcome": "defer", "path": "/x"})]
    assert reports.staging_folder("/out/", "run").startswith("/out_staging_run_2")


@pytest.mark.parametrize("most, itself", [(1, True), (3, False), (8, True), (8, False), (20, True)])
def test_near_hashes_equal_brute_force(spark, most, itself):
    rng = random.Random(most)
    base = [rng.getrandbits(64) for _ in range(12)]
    make = lambda: [f"{b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, most + 2))):016x}" for b in base for _ in range(8)]
    left, right = make(), make()
    df = lambda hs: spark.createDataFrame([(h,) for h in [*hs, None, "short"]], "h string")
    got = {(r.ha, r.hb): r.dist for r in fingerprint.near_hashes(df(left), df(left if itself else right), most, "h", itself).collect()}
    far = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    want = {(a, b): far(a, b) for a in left for b in (left if itself else right) if 0 < far(a, b) <= most and (a < b or not itself)}
    assert got == want and want


def test_bands_leave_few_candidates_by_chance():
    for most, n in ((3, 10**6), (8, 200_000)):
        bands, k = fingerprint.bands_for(most, n, n)
        assert bands - k == most and n * n / 2 * fingerprint.comb(bands, k) / 2 ** (64 * k / bands) <= fingerprint.AIM * 2 * n
    assert 200_000**2 / 2 * fingerprint.comb(*fingerprint.bands_for(8, 200_000, 200_000)) / 2 ** (64 * fingerprint.bands_for(8, 200_000, 200_000)[1] / fingerprint.bands_for(8, 200_000, 200_000)[0]) < 10**7


@pytest.mark.parametrize("itself", [False, True])
def test_exploded_hashes_are_never_broadcast(spark, itself):
    h = ["0" * 16, "0" * 15 + "7", "F" * 16, "f" * 15 + "E", "f" * 16, "0" * 14 + "0F", "8" + "0" * 15]
    df = spark.createDataFrame([(x,) for x in h], "h string")
    near = fingerprint.near_hashes(df, df, 3, "h", itself)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    want = {(x, y) for x in h for y in h if 0 < (int(x, 16) ^ int(y, 16)).bit_count() <= 3 and (x < y or not itself)}
    got = [(r.ha, r.hb) for r in near.collect()]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("name", ["first_match_cascade", "merge_links", "pair_kinds", "near_pairs", "mark_duplicates", "perceptual_groups"])
def test_texts_are_hashed_once(spark, name):
    from lamina.plans.queries import QUERIES

    assert "MapInArrow" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_simhash_of_odd_and_long_texts(spark, monkeypatch):
    """Tokens reach the worker inside their text, not as rows of an array: splitting them in the JVM took longer than hashing them."""
    texts = [None, "", " ", "\t a \n", "A a b\x0b\x0c\r\nc", "Été\u00a0été É\x1cx \u2003y", "x " * 40 + "y", "one two three " * 30]
    long = "p q r " * 25_000
    df = spark.createDataFrame([*enumerate([*texts, long])], "doc_id int, text string").coalesce(1)

    def brute(text):
        digests = [int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "big") for t in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if t]
        return f"{sum(1 << i for i in range(64) if 2 * sum(d >> i & 1 for d in digests) > len(digests)):016x}"

    kinds = []
    with_arrow = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: kinds.append(self.schema["t"].dataType.simpleString()) or with_arrow(self, *a, **k))
    got = {r.doc_id: r.simhash for r in fingerprint.simhash(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate([*texts, long])}
    assert kinds == ["string"]
