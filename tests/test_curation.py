"""Extraction against tables of examples, and the operators that SQL does not cover."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.__main__ import main
from lamina.functions import patterns as P
from lamina.operators import dedup, fingerprint, learned, match, registry, resolve
from lamina.sources import files, images
from lamina.streaming import incremental

PREFIXES = ["LH", "MUPA", "YCLH", "MCCM", "K-Bue", "Cer-Bue", "MCCM-LH"]
SPECIMENS = {
    "LH-15083_a_.jpg": "LH-15083-a", "LH-6120.jpg": "LH-6120", "LH 30202 AB.JPG": "LH-30202-ab", "LH32560AB.JPG": "LH-32560-ab", "LH 2442 (1).JPG": "LH-2442", "LH_9300_20130704 (1).JPG": "LH-9300",
    "LH-928061.JPG": "LH-928061", "MCCM-LH 26452A.JPG": "MCCM-LH-26452-a", "K-Bue 085 (1).JPG": "K-BUE-085", "Cer-Bue 292 AB.JPG": "CER-BUE-292-ab", "22270A.JPG": None,
    "DSC00016.JPG": None, "DSC_0495.JPG": None, "IMG_1171.JPG": None, "PA210066.JPG": None, "PC200057.JPG": None, "P1103168.JPG": None, "_DSC1935.JPG": None, "DSCN1394.JPG": None,
    "Imágenes_MCCM_2009/2009.JPG": None, r"C:\data\LH\campaign2023\12345678-a.jpg": "LH-12345678-a", "LH/PA290080.jpg": None, "PB 22184b.jpg": None,
}


def values(spark, expr, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x string")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_specimens(spark):
    got = values(spark, lambda c: P.specimen(c, PREFIXES), SPECIMENS)
    assert [g and g.specimen_id for g in got] == list(SPECIMENS.values())
    sure = dict(zip(SPECIMENS, got))
    assert sure["LH-6120.jpg"].confidence == 1.0 and sure[r"C:\data\LH\campaign2023\12345678-a.jpg"].confidence == 0.6


def test_numbers_dates_and_hints(spark):
    names = {"DSC_1234": (["1234"], []), "IMG_0001": (["0001"], []), "specimen_12345678": ([], ["12345678"]), "DSC_1234_specimen_87654321": (["1234"], ["87654321"]), "MUPA-12345678-a": ([], ["12345678"]), "photo_20231015_143022": ([], ["20231015", "143022"])}
    got = values(spark, lambda c: F.struct(P.camera_numbers(c).alias("a"), P.other_numbers(c).alias("b")), names)
    assert [(r.a, r.b) for r in got] == list(names.values())
    dates = {"photo_20231015.jpg": "20231015", "photo_2023-10-15.jpg": "20231015", "15-10-2023 x.jpg": "20231015", "C:/data/2023/photo.jpg": "2023", "C:/data/campaign_2022/photo.jpg": "2022", "none.jpg": None, "2021/20220304.jpg": "20220304"}
    assert values(spark, lambda c: P.partial_date(P.best_date(P.dates(c))), dates) == list(dates.values())
    hints = {"Arthropoda/Insecta/Coleoptera": (["phylum", "class", "order"], None), "Mollusca/Gastropoda": (["phylum", "class"], None), "2023": ([], 2023), "campaign_2022/Insecta": (["class"], 2022), "Scarabaeidae": (["family"], None)}
    got = values(spark, lambda c: F.struct(P.taxa(c)["level"].alias("t"), P.campaign(c).alias("y")), hints)
    assert [(r.t, r.y) for r in got] == list(hints.values())
    assert values(spark, lambda c: F.date_format(P.exif_time(c), "yyyyMMdd"), ["2020:01:02 03:04:05", "x", None]) == ["20200102", None, None]


def test_collections_paths_and_json(spark):
    assert values(spark, lambda c: P.collection(c), ["/x/Las Hoyas/a", "/Cantera/b", "/MONSET/c", "/q", None]) == ["LH", "BUE", "MON", None, None]
    assert values(spark, P.macroclass, [" insecta", "AVES", "Unheard", None]) == ["Insects", "Tetrapoda", None, None]
    assert values(spark, lambda c: P.relative(c, "/out/"), ["/out/a/b", "/else/c", r"\out\d", None]) == ["a/b", "/else/c", "d", None]
    assert values(spark, lambda c: P.absolute(c, "/out/"), ["a/b", "/c", "C:/d"]) == ["/out/a/b", "/c", "C:/d"]
    assert values(spark, lambda c: P.parsed(c, "a int")["a"], ['{"a": 1}', 'so:\n```json\n{"a": 2}\n```', "no", None]) == [1, 2, None, None]


def test_numbering_of_many_rows_is_a_permutation(spark):
    n = 1_000_000
    rows = spark.range(n, numPartitions=9).select((F.col("id") * 7919 % n).alias("v"), F.repeat(F.lit("x"), 40).alias("wide"))
    got = match.numbered(rows, "v", start=5).agg(F.count_distinct("rn"), F.min("rn"), F.max("rn"), F.sum(F.abs(F.col("rn") - F.col("v") - 6))).first()
    assert tuple(got) == (n, 6, n + 5, 0)
    ties = spark.createDataFrame([(None, 1), (1, 2), (1, 2), (1, 1), (None, 0)], "k int, v int")
    assert sorted((r.rn, r.k, r.v) for r in match.numbered(ties, "k").collect()) == [(1, None, 0), (2, None, 1), (3, 1, 1), (4, 1, 2), (5, 1, 2)]
    assert match.numbered(ties.limit(0), "k").count() == 0


def test_unique_names_never_clash(spark):
    names = ["a", "a", "a_1", "a_1", "a", "x.jpg", "x.jpg", "x_1.jpg", ".hidden", ".hidden", "a_01", "b.c.d", "b.c.d"]
    df = spark.createDataFrame(list(enumerate(names)), "k int, n string")
    got = {r.k: r.unique_name for r in match.unique_names(df, "n", "k").collect()}
    assert len(set(got.values())) == len(names) and got[1] == "a_2" and got[6] == "x_2.jpg" and got[9] == ".hidden_1" and got[12] == "b.c_1.d"
    taken = spark.createDataFrame([("a",), ("a_2",), ("x.jpg",)], "n string")
    got = {r.k: r.unique_name for r in match.unique_names(df, "n", "k", taken=taken).collect()}
    assert len(set(got.values()) | {"a", "a_2", "x.jpg"}) == len(names) + 3


def test_rows_without_text_or_digest_stay(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, " ")], "doc_id long, text string")
    got = {r.doc_id: r.simhash for r in fingerprint.simhash(docs).collect()}
    assert len(got) == 4 and got[1] == got[2] == got[4] == "0" * 16 and fingerprint.simhash(docs.limit(0)).count() == 0
    rows = spark.createDataFrame([(1, None, None), (2, None, None), (3, "d", "p"), (4, "d", "q")], "k int, d string, p string")
    assert {r.k: r.duplicate_of for r in dedup.mark_duplicates(rows, "d", "p", "k").collect()} == {1: None, 2: None, 3: None, 4: 3}
    assert sorted(r.k for r in incremental.dedup_batch(rows, rows.limit(0), "d", "k").collect()) == [1, 2, 3]


@pytest.mark.parametrize("most", [1, 3, 6, 10, 15])
def test_near_hashes_of_any_distance(spark, most):
    rng = np.random.default_rng(most)
    base = [int(x) for x in rng.integers(0, 2**63, 6)]
    hashes = sorted({f"{b ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 18), replace=False)):016x}" for b in base for _ in range(12)})
    df = spark.createDataFrame([(h,) for h in hashes], "p string")
    got = {tuple(r) for r in fingerprint.near_hashes(df, df, most, "p", itself=True).collect()}
    assert got == {(a, b, d) for a in hashes for b in hashes if a < b and (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= most}


def bitmap(pixels: np.ndarray) -> bytes:
    """An uncompressed 24-bit BMP file."""
    h, w, _ = pixels.shape
    body = b"".join(row[:, ::-1].tobytes() + b"\0" * (-3 * w % 4) for row in pixels[::-1])
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def picture(content: list[tuple[int, str]]) -> bytes:
    """A JPEG file with nothing but text tags of EXIF."""
    entries, data, at = b"", b"", 8 + 2 + 12 * len(content) + 4
    for tag, text in content:
        raw = text.encode() + b"\0"
        entries += struct.pack("<HHII", tag, 2, len(raw), at + len(data))
        data += raw
    body = b"Exif\0\0" + b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(content)) + entries + b"\0" * 4 + data
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xd9"


def test_image_hashes_and_metadata(spark, tmp_path):
    y, x = np.mgrid[0:90, 0:70]
    one = np.stack([(x * 3) % 256, (y * 2 + x) % 256, (x * y // 20) % 256], axis=2).astype(np.uint8)
    changed, other = one.copy(), np.random.default_rng(1).integers(0, 256, (90, 70, 3)).astype(np.uint8)
    changed[4, 5] = 255
    big = one.repeat(3, axis=0).repeat(3, axis=1)
    for name, p in (("one", one), ("copy", one), ("changed", changed), ("other", other), ("big", big)):
        (tmp_path / f"{name}.bmp").write_bytes(bitmap(p))
    (tmp_path / "fake.jpg").write_bytes(b"fake image 1")
    (tmp_path / "photo.jpg").write_bytes(picture([(0x010F, "Maker"), (0x0132, "2019:05:06 07:08:09")]))
    (tmp_path / "cut.jpg").write_bytes(picture([(0x010F, "Maker")])[:30])
    got = {r.path.rsplit("/", 1)[1]: r for r in images.image_hashes(spark, str(tmp_path)).collect()}
    far = lambda a, b: (int(got[a].phash, 16) ^ int(got[b].phash, 16)).bit_count()
    assert got["fake.jpg"].phash is None and got["one.bmp"].width == 70
    assert far("one.bmp", "copy.bmp") == 0 and far("one.bmp", "changed.bmp") <= 4 and far("one.bmp", "big.bmp") <= 2 and far("one.bmp", "other.bmp") > 10
    meta = images.image_metadata(spark, str(tmp_path))
    tags = {r.path.rsplit("/", 1)[1]: r for r in meta.collect()}
    assert tags["photo.jpg"].make == "Maker" and tags["photo.jpg"].year == 2019 and tags["cut.jpg"].make is None and tags["fake.jpg"].year is None
    rows = meta.select("path", F.lit(None).cast("int").alias("campaign_year"))
    assert {r.path.rsplit("/", 1)[1]: r.campaign_year for r in images.fill_years(rows, meta).collect()}["photo.jpg"] == 2019


def test_phash_equals_the_plain_transform():
    grey = np.random.default_rng(2).integers(0, 256, (32, 32)).astype(float)
    k = np.arange(32)
    low = [[sum(grey[a, b] * np.cos(np.pi * (2 * a + 1) * u / 64) * np.cos(np.pi * (2 * b + 1) * v / 64) for a in k for b in k) for v in range(8)] for u in range(8)]
    flat = np.array(low).reshape(-1)
    assert images.phash(grey) == f"{int(''.join('1' if x > np.median(flat) else '0' for x in flat), 2):016x}"


def test_registries(spark, tmp_path):
    path = str(tmp_path / "registry")
    rows = spark.createDataFrame([("u1", "a", None), ("u2", "b", "x")], "uuid string, class_label string, note string")
    files.save_registry(rows, path)
    files.save_registry(spark.read.parquet(path).withColumn("note", F.lit("new")), path)  # from itself
    assert {r.note for r in spark.read.parquet(path).collect()} == {"new"}
    kinds = spark.createDataFrame([("image", None), ("image", True), (None, None), ("text", None), ("video", False)], "type string, is_duplicate boolean")
    assert {k: v.count() for k, v in files.split_registries(kinds).items()} == {"annotations": 1, "duplicates": 1, "text_files": 1, "other_files": 2}
    assert registry.search(rows, uuid="u1", unknown=3).count() == 1 and registry.lookup(rows, "class_label", "b", "uuid").first().uuid == "u2"
    assert {r.note for r in registry.update(rows, "uuid", "u1", note="y", unknown=1).collect()} == {"y", "x"}
    assert registry.reorder(rows, ["note", "none"]).columns == ["note", "uuid", "class_label"]
    assert rows.select(registry.missing(rows, ["note"]).alias("m")).filter("m").count() == 1 and rows.select(registry.missing(rows, ["note", "none"]).alias("m")).filter("m").count() == 2
    listing = spark.createDataFrame([("/r/a/1.jpg",), ("/r/b/2.jpg",), ("/r/c/2.jpg",)], "path string")
    stored = spark.createDataFrame([("/r/a/1.jpg",), ("a/1.jpg",), (r"a\1.jpg",), ("gone/2.jpg",), ("none",)], "path string")
    assert {r.path: (r.file, r.step) for r in registry.resolve_paths(stored, listing, "path", "/r").collect()} == {"/r/a/1.jpg": ("/r/a/1.jpg", 1), "a/1.jpg": ("/r/a/1.jpg", 2), r"a\1.jpg": ("/r/a/1.jpg", 3), "gone/2.jpg": ("/r/b/2.jpg", 4), "none": (None, None)}
    found = registry.rows_of_paths(stored, spark.createDataFrame([("k1", "a/1.jpg", None), ("k2", None, "x/2.jpg")], "uuid string, p string, q string"), "path", "uuid", ["p", "q"])
    assert {r.path: r.uuid for r in found.collect()} == {"/r/a/1.jpg": "k1", "a/1.jpg": "k1", r"a\1.jpg": "k1", "gone/2.jpg": "k2", "none": None}
    links = spark.createDataFrame([("d1", "u1"), ("d2", "u1")], "dup string, main string")
    assert registry.nested_sample(rows, rows.select("uuid", F.lit("h").alias("h")), links, "uuid", 1).first().duplicates == ["d1", "d2"]


def test_decisions_and_fields(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("v")).first()["v"]
    a, b = F.lit("x"), F.lit("y")
    assert [pick(resolve.merge_pair(a, b, c)) for c in (0, 1, 2, "d")] == ["x", "y", None, "x || y"] and pick(resolve.merge_pair(F.lit(None).cast("string"), b, 2)) == "y"
    assert pick(resolve.camera_number(F.lit(" "), F.array(F.lit("12")), F.lit(True))) == "12" and pick(resolve.camera_number(F.lit("LH-1"), F.array(F.lit("12")), F.lit(True))) == "LH-1"
    old, new = (spark.createDataFrame([(1, t, "s")], "k int, f string, g string") for t in ("a" * 200, "b"))
    (diff,) = resolve.differences(old, new, "k", ["f", "g"]).collect()
    assert diff.field == "f" and len(diff.existing) == 120 and diff.staged == "b"
    names = spark.createDataFrame([("d", "LH 12.jpg"), ("e", "x")], "folder string, name string")
    got = learned.stored(names, spark.createDataFrame([("d", r"LH ([0-9]+)")], "folder string, pattern string"), "folder", "name").collect()
    assert {r.name: r.value for r in got} == {"LH 12.jpg": "12", "x": None}


def test_stream_appends_each_digest_once(spark, tmp_path):
    inp, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, d string"
    for rows in ([(1, "a"), (2, "a"), (3, None)], [(4, "a"), (5, "b"), (6, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inp)
        incremental.start(spark.readStream.schema(schema).parquet(inp), out, str(tmp_path / "state"), "d", "k").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 3, 5, 6]


def test_command_lines(spark, tmp_path):
    tree = tmp_path / "out"
    for p in ("Campaña_2020/LH 123a.jpg", "Duplicados/b.jpg", "Archivos_Texto/n.txt"):
        (tree / p).parent.mkdir(parents=True, exist_ok=True)
        (tree / p).write_bytes(zlib.compress(p.encode()))
    a, d = str(tmp_path / "a"), str(tmp_path / "d")
    spark.createDataFrame([("u1", "x"), ("u2", None)], "uuid string, c string").write.parquet(a)
    spark.createDataFrame([("u2", "y"), ("u3", "z")], "uuid string, c string").write.parquet(d)
    run = lambda *args: (main([*args, "--to", str(tmp_path / "res")]), spark.read.parquet(str(tmp_path / "res")).collect())[1]
    assert {r.extraction.specimen.specimen_id for r in run("scan", str(tree)) if r.extraction.specimen} == {"LH-123-a"}
    assert {r.kind: (r.structure, r.registry) for r in run("audit", "--output", str(tree), "--annotations", a, "--duplicates", d)} == {"main": (1, 2), "duplicate": (1, 2), "text": (1, 0), "total": (0, 4)}
    assert {r.field: r.filled for r in run("stats", "--annotations", a, "c")} == {"c": 1}
    assert {r.uuid: r.c for r in run("merge", "--existing", a, "--staged", d, "c")} == {"u1": "x", "u2": "y", "u3": "z"}
    assert [r.uuid for r in run("clean", "--hashes", a, "--duplicates", d)] == ["u1"]
