"""Whole runs with snapshots, EXIF of candidates, command-line options, look-ups and small helpers."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.__main__ import main
from lamina.functions import scalar
from lamina.operators import enrich, organize, review, stats
from lamina.sources import files, images, reports


def png(seed: int, side: int = 16) -> bytes:
    """A grey picture of random pixels."""
    pixels = np.random.default_rng(seed).integers(0, 256, (side, side), dtype=np.uint8)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", side, side, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def tiff(**tags: str) -> bytes:
    """A TIFF file with text tags only."""
    number = {"taken": 0x9003, "modified": 0x0132, "make": 0x010F, "artist": 0x013B}
    body, data, at = b"", b"", 8 + 2 + 12 * len(tags) + 4
    for name, text in tags.items():
        value = text.encode() + b"\0"
        value += b"\0" * (5 - len(value))
        body += struct.pack("<HHII", number[name], 2, len(value), at + len(data))
        data += value
    return b"II*\0" + struct.pack("<IH", 8, len(tags)) + body + struct.pack("<I", 0) + data


def jpeg(**tags: str) -> bytes:
    exif = b"Exif\0\0" + tiff(**tags)
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + b"\xff\xd9"


@pytest.fixture
def tree(tmp_path):
    content = {"in/LH/campaign_2022/Insecta/LH 001a.png": png(1), "in/LH/campaign_2022/Insecta/copy.png": png(1), "in/notes/n.txt": b"text", "in/notes/again.txt": b"text", "in/.git/x.png": png(3), "in/odd.png": png(2)}
    for name, data in content.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


def test_a_run_goes_from_folders_to_registries_and_resumes(spark, tree):
    folder, state, staging = str(tree / "in"), str(tree / "state"), str(tree / "staging")
    first = organize.organize(spark, [folder, str(tree / "none")], state)
    assert first.ran == ["hashed", "extracted", "marked", "routed"]
    rows = {r.name: r for r in first.result.collect()}
    assert set(rows) == {"LH 001a.png", "copy.png", "n.txt", "again.txt", "odd.png"}
    assert (rows["LH 001a.png"].specimen_id, rows["LH 001a.png"].campaign_year, rows["LH 001a.png"].taxonomic_class, rows["LH 001a.png"].folder) == ("LH-001-a", 2022, "Insecta", "Campaña_2022/Insects/Insecta/Sin_Genero")
    assert rows["copy.png"].duplicate_of == rows["LH 001a.png"].path and rows["copy.png"].folder == "Duplicados" and rows["odd.png"].folder == "Casos_Perdidos_Generales"
    assert rows["n.txt"].duplicate_of == rows["again.txt"].path and rows["n.txt"].folder == "Archivos_Texto" and rows["odd.png"].phash and rows["n.txt"].phash is None
    again = organize.organize(spark, [folder], state)
    assert again.ran == [] and sorted(map(tuple, again.result.collect()), key=str) == sorted(map(tuple, first.result.collect()), key=str)
    (tree / "in/new.txt").write_bytes(b"more")
    assert organize.organize(spark, [folder], state).result.count() == 6
    counts = organize.stage(spark, first.result, staging, "/final")
    assert counts == {"annotations": 2, "duplicates": 1, "text_files": 2, "other_files": 0, "plan": 5}
    assert organize.staging_info(spark, staging) == {"final_output_dir": "/final", "counts": counts} and organize.staging_info(spark, folder) is None
    assert files.registry_folder(spark, staging).endswith("/registries") and files.registry_folder(spark, folder) is None
    assert spark.read.parquet(f"{staging}/registries/plan").count() == 5
    asked = organize.organize(spark, [folder], state, review_unknown=True)
    assert asked.kept == ["hashed", "extracted", "marked"] and {r.folder for r in asked.result.filter("name = 'odd.png'").collect()} == {"Revision_Manual/No_Specimen_ID"}


def test_a_run_logs_what_its_stages_found(spark, tree):
    log = reports.Log(spark)
    out = organize.organize(spark, [str(tree / "in")], str(tree / "state"), log=log).result
    got = {(r.stage, r.action): r.n for r in log.close().collect()}
    assert {n for (_, a), n in got.items() if a == "rows"} == {out.count()} and len(got) == 12
    assert got["hashed", "pictures"] == out.filter("phash IS NOT NULL").count() == 3 and got["hashed", "unread"] == 0
    assert (got["marked", "exact"], got["routed", "duplicates"], got["routed", "lost"], got["extracted", "specimens"]) == (2, 1, 1, 1)
    again = reports.Log(spark)
    assert organize.organize(spark, [str(tree / "in")], str(tree / "state"), log=again).ran == [] and again.close().count() == 0


def test_a_cache_asks_once_and_counts(spark, tmp_path):
    asked = []

    def ask(keys):
        rows = [(r.k, len(r.k), "no" if r.k == "bad" else None) for r in keys.collect()]
        asked.extend(r[0] for r in rows)
        return spark.createDataFrame(rows, "k string, n int, error string")

    cache = enrich.Cache(spark, str(tmp_path / "cache"), "k string, n int", "k")
    wanted = spark.createDataFrame([("a",), ("bb",), ("bad",), ("a",), (None,)], "k string")
    assert sorted(map(tuple, cache.answers(wanted, ask).collect())) == [("a", 1), ("bb", 2)]
    assert cache.counts == {"wanted": 3, "known": 0, "asked": 3, "failed": 1}
    later = enrich.Cache(spark, str(tmp_path / "cache"), "k string, n int", "k")
    assert sorted(map(tuple, later.answers(spark.createDataFrame([("bb",), ("bad",), ("new",)], "k string"), ask).collect())) == [("bb", 2), ("new", 3)]
    assert later.counts == {"wanted": 3, "known": 1, "asked": 2, "failed": 1} and sorted(asked) == ["a", "bad", "bad", "bb", "new"]


def test_a_run_over_nothing(spark, tmp_path):
    assert organize.organize(spark, [str(tmp_path / "none")], str(tmp_path / "state")).result.count() == 0


def test_command_line_options(spark, tree, capsys):
    run = ["run", str(tree / "in"), "--state", str(tree / "state"), "--staging", str(tree / "staging"), "--output", "/final"]
    assert main([*run, "--dry-run"]) == 0 and not (tree / "staging").exists()
    assert "5 rows; nothing is written" in capsys.readouterr().out
    assert main([*run, "--to", str(tree / "plan")]) == 0 and spark.read.parquet(str(tree / "plan")).count() == 5
    assert "taken from before: hashed, extracted, marked, routed" in capsys.readouterr().out
    a, d, to = str(tree / "a"), str(tree / "d"), str(tree / "left")
    spark.createDataFrame([("u1",), ("u2",)], "uuid string").write.parquet(a)
    spark.createDataFrame([("u2",)], "uuid string").write.parquet(d)
    for _ in range(2):
        assert main(["clean", "--hashes", a, "--duplicates", d, "--to", to, "--backup"]) == 0
    assert [r.uuid for r in spark.read.parquet(f"{to}.backup").collect()] == ["u1"]
    audit = ["audit", "--output", str(tree / "in"), "--annotations", a, "--duplicates", d]
    assert main(audit) == 0 and main([*audit, "--strict"]) == 1


def test_exif_year_of_the_first_usable_file(spark, tmp_path):
    data = {"taken.jpg": jpeg(taken="2009:05:06 01:02:03", make="2001"), "other.tif": tiff(make="Model of 1999", artist="x"), "none.jpg": jpeg(make="Maker"), "odd.jpg": jpeg(taken="unknown", modified="in 2011, perhaps"), "torn.jpg": jpeg(taken="2009:05:06 01:02:03")[:20]}
    at = {n: str(tmp_path / n) for n in data}
    for n, d in data.items():
        (tmp_path / n).write_bytes(d)
    lists = {1: ["taken.jpg", "other.tif"], 2: ["gone", "none.jpg", "torn.jpg", "other.tif", "taken.jpg"], 3: ["none.jpg"], 4: [], 5: ["odd.jpg"]}
    rows = spark.createDataFrame([(k, "; ".join(at.get(n, str(tmp_path / n)) for n in v)) for k, v in lists.items()] + [(6, None)], "k int, paths string")
    got = {r.k: (r.year, r.used, r.opened) for r in images.first_years(rows, "k", "paths").collect()}
    assert got == {1: (2009, at["taken.jpg"], 1), 2: (1999, at["other.tif"], 3), 3: (None, None, 1), 4: (None, None, 0), 5: (2011, at["odd.jpg"], 1), 6: (None, None, 0)}
    two = spark.createDataFrame([(1, at["taken.jpg"], f"{at['none.jpg']};{at['odd.jpg']}")], "k int, old string, new string")
    assert [r.line for r in images.year_lines(two, "k", existing="old", staging="new").collect()] == ["[existing] taken.jpg  →  2009", "[staging ] none.jpg  →  (no EXIF / not found)", "[staging ] odd.jpg  →  2011"]


def test_pictures_in_order(spark):
    rows = spark.createDataFrame([("b.JPG", "image"), ("A.png", "image"), ("c.txt", "text"), ("a.png", "image")], "path string, type string")
    assert [r.path for r in files.pictures(rows).collect()] == ["A.png", "a.png", "b.JPG"]


def test_orders_of_distributions(spark):
    df = spark.createDataFrame([("10",), ("9",), ("9",), (None,), ("b",), ("a",), ("a",), ("a",)], "v string")
    assert [r.y for r in stats.distribution(df, F.col("v"), "y", "value").collect()] == ["9", "10", "Unknown", "a", "b"]
    assert [r.y for r in stats.distribution(df, F.col("v"), "y", "count").collect()] == ["a", "9", "10", "Unknown", "b"]


def test_bare_ids(spark):
    assert [r[0] for r in spark.createDataFrame([("LH-22 270_a",), (None,), (" ",)], "v string").select(scalar.bare_id(F.col("v"))).collect()] == ["lh22270a", "", ""]


def test_samples_in_a_seeded_order(spark):
    rows, none = spark.range(100).withColumn("f", F.lit("x")), spark.range(0)
    pick = lambda seed: [r.id for r in review.sample(rows, none, "id", 10, seed).collect()]
    assert pick(1) == pick(1) != pick(2) and pick(None) == list(range(10)) and review.sample(rows, none, "id", 10, missing=["f"]).count() == 0


def test_select_by_flags(spark):
    rows = spark.createDataFrame([(1, "image", "LH", True, None), (2, "image", "MU", None, True), (3, "text", None, False, False)], "k int, type string, collection string, needs_review boolean, is_duplicate boolean")
    pick = lambda **how: [r.k for r in review.select(rows, **how).collect()]
    assert (pick(kind="image"), pick(collection="MU"), pick(review=True), pick(duplicate=False), pick()) == ([1, 2], [2], [1], [1, 3], [1, 2, 3])


def test_neighbours_where_groups_are_null_or_hot(spark):
    rows = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)] + [("b", k) for k in range(10, 60)], "g string, k int")
    got = {r.k: (r.previous, r.next) for r in review.neighbours_in_order(rows, "g", "k").collect()}
    assert got[1] == (None, 3) and got[3] == (1, None) and got[2] == (None, None) and got[10] == (None, 11) and got[59] == (58, None) and got[30] == (29, 31)
