"""Perceptual hashes of decoded images and EXIF data of JPEG and TIFF files, in Arrow batches."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.patterns import exif_time
from lamina.functions.scalar import clean

#: Side of the picture that is transformed, side of the block of low frequencies.
SIDE, LOW = 32, 8
#: EXIF tags that are read, by number.
TAGS = {0x010F: "make", 0x0110: "model", 0x0132: "modified", 0x9003: "taken", 0x9004: "digitized"}


def shrunk(grey: np.ndarray, side: int = SIDE) -> np.ndarray:
    """Means over the areas of a side x side grid; borders of areas may cut pixels."""

    def means(a: np.ndarray) -> np.ndarray:
        edge = np.linspace(0, a.shape[0], side + 1)
        total = np.concatenate([np.zeros((1, a.shape[1])), np.cumsum(a, axis=0)])
        low = np.minimum(np.floor(edge).astype(int), a.shape[0] - 1)
        at = total[low] + (edge - low)[:, None] * a[low]
        return np.diff(at, axis=0) / (a.shape[0] / side)

    return means(means(grey.astype(np.float64)).T).T


def phash(grey: np.ndarray) -> str:
    """64 bits: which low frequencies of the cosine transform are above their median."""
    k = np.arange(SIDE)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * SIDE))
    block = (basis @ shrunk(grey) @ basis.T)[:LOW, :LOW]
    return np.packbits(block.reshape(-1) > np.median(block)).tobytes().hex()


def image_hashes(spark: SparkSession, folder: str, names: str | None = None) -> DataFrame:
    """(path, width, height, phash) of all images that can be decoded; null where one cannot. names: a glob; other files are not opened."""
    source = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True)
    rows = (source.option("pathGlobFilter", names) if names else source).load(folder).select("image.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                out = None
                if r["height"] > 0 and r["width"] > 0:
                    pixels = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["nChannels"]).astype(np.float64)
                    grey = pixels[:, :, 0] if r["nChannels"] == 1 else pixels[:, :, :3] @ np.array([0.114, 0.587, 0.299])  # blue, green, red
                    out = phash(grey)
                ok = out is not None
                yield pa.RecordBatch.from_pydict({"path": [r["origin"]], "width": pa.array([r["width"] if ok else None], pa.int32()), "height": pa.array([r["height"] if ok else None], pa.int32()), "phash": pa.array([out], pa.string())})

    return rows.mapInArrow(run, "path string, width int, height int, phash string")


def exif(content: bytes) -> dict[str, str]:
    """Text tags of a JPEG or TIFF file, those of `TAGS` by name, others by number; empty where there are none or the file is damaged."""
    try:
        if content[:2] == b"\xff\xd8":
            at = 2
            while content[at : at + 1] == b"\xff" and content[at + 1] not in (0xD9, 0xDA):
                size = struct.unpack_from(">H", content, at + 2)[0]
                if content[at + 1] == 0xE1 and content[at + 4 : at + 10] == b"Exif\0\0":
                    return _directory(content[at + 10 : at + 2 + size])
                at += 2 + size
            return {}
        return _directory(content) if content[:4] in (b"II*\0", b"MM\0*") else {}
    except (struct.error, IndexError, UnicodeDecodeError):
        return {}


def _directory(tiff: bytes) -> dict[str, str]:
    order = "<" if tiff[:2] == b"II" else ">"
    out, todo, seen = {}, [struct.unpack_from(order + "I", tiff, 4)[0]], set()
    while todo:
        at = todo.pop()
        if at in seen:
            continue
        seen.add(at)
        for k in range(struct.unpack_from(order + "H", tiff, at)[0]):
            tag, kind, count, value = struct.unpack_from(order + "HHII", tiff, at + 2 + 12 * k)
            if tag == 0x8769:  # where the directory of the picture's own tags is
                todo.append(value)
            elif kind == 2:
                where = value if count > 4 else at + 10 + 12 * k
                out[TAGS.get(tag, f"{tag:04x}")] = tiff[where : where + count].split(b"\0")[0].decode(errors="replace").strip()
    return out


def image_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(path, make, model, taken, year): EXIF of the files, the time taken before that digitized or modified."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content")
    names = list(TAGS.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [exif(c.as_py() or b"") for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *(pa.array([g.get(n) for g in got], pa.string()) for n in names)], names=["path", *names])

    tags = rows.mapInArrow(run, "path string, " + ", ".join(f"{n} string" for n in names))
    taken = F.coalesce(*[exif_time(F.col(n)) for n in ("taken", "digitized", "modified")])
    return tags.select("path", "make", "model", taken.alias("taken"), F.year(taken).alias("year"))


def fill_years(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """campaign_year filled from EXIF where it is empty; year_conflict where both tell and differ."""
    year = metadata.select("path", F.col("year").alias("_exif"))
    out = files.join(year, "path", "left").withColumn("year_conflict", F.coalesce(F.col("campaign_year") != F.col("_exif"), F.lit(False)))
    return out.withColumn("campaign_year", F.coalesce("campaign_year", "_exif")).drop("_exif")


_YEAR = re.compile(r"\b(?:19|20)\d{2}\b")


def year_of(tags: dict[str, str]) -> int | None:
    """The first year in the time taken or modified, else in any text tag."""
    first = [tags[t] for t in ("taken", "modified") if t in tags]
    for text in [*first, *tags.values()]:
        if m := _YEAR.search(text):
            return int(m.group(0))
    return None


def _content(path: str) -> bytes | None:
    """The bytes of a file, of any store; nothing if it is not there."""
    fs, at = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
    try:
        with fs.open_input_stream(at) as f:
            head = f.read(1 << 18)
            # a JPEG file has its tags in front, a TIFF file anywhere
            return head if head[:2] == b"\xff\xd8" else head + f.read()
    except (FileNotFoundError, OSError):
        return None


def first_years(rows: DataFrame, key: str, paths: str) -> DataFrame:
    """(key, year, used, opened): the EXIF year of the first of a row's paths ('; '-joined) that tells one, that path, and how many files were opened.

    Files are opened one after another until one tells a year, so a row whose first file does opens no other. Paths that are not there, files
    without tags and damaged ones are passed over. Without any: null.
    """
    whole = rows.select(F.col(key).alias("k"), F.filter(F.transform(F.split(F.coalesce(paths, F.lit("")), ";"), lambda p: clean(p)), lambda p: p.isNotNull()).alias("paths"))

    def one(candidates: list[str]) -> tuple[int | None, str | None, int]:
        opened = 0
        for p in candidates:
            content = _content(p)
            opened += content is not None
            if content is not None and (year := year_of(exif(content))) is not None:
                return year, p, opened
        return None, None, opened

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(p) for p in batch.column("paths").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.int32())], names=["k", "year", "used", "opened"])

    return whole.mapInArrow(run, f"k {whole.schema['k'].dataType.simpleString()}, year int, used string, opened int").withColumnRenamed("k", key)


def year_lines(rows: DataFrame, key: str, **paths: str) -> DataFrame:
    """(key, line): a line for each path of each side, with its EXIF year; sides and their columns of paths in the order given."""
    order = {side: n for n, side in enumerate(paths)}
    cells = [rows.select(F.col(key), F.lit(side).alias("side"), F.lit(n).alias("n"), F.posexplode(F.split(F.coalesce(paths[side], F.lit("")), ";")).alias("at", "p")) for side, n in order.items()]
    every = reduce(DataFrame.unionByName, cells).withColumn("p", clean(F.col("p"))).filter("p IS NOT NULL")
    years = first_years(every.select("p").distinct(), "p", "p").select("p", "year")
    named = F.format_string("[%-8s] %s  →  %s", "side", F.regexp_extract("p", r"([^/\\\\]*)$", 1), F.coalesce(F.col("year").cast("string"), F.lit("(no EXIF / not found)")))
    return every.join(years, "p").select(key, "n", "at", named.alias("line")).orderBy(key, "n", "at").select(key, "line")
