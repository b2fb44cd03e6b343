"""WARC archives: one gzip member for each record, and a sequential reader that checks digests.

The writer deals rows to archives, one for each partition, in a folder that all
executors share. An archive gets its final name only when it is complete, and a
task that runs again leaves the same records under the same name. The reader
decompresses incrementally: it holds one chunk of the file and one record,
frames records by Content-Length, and checks block and payload digests.

Of rows with equal payloads of at least `min_bytes`, the smallest id is the
response and the others revisit it; equal ids with equal payloads are all
responses. Defined results: a null payload is empty and a response; a row
without id is a response, and its id is read back as null; a null url is written as
the record's own id, and white space in a url is percent-encoded; an empty table gives no archives and an empty
result; columns other than id, url and payload are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.shared import arrow_rows, put, shared_dir, store

#: Fixed by the contract: payloads below this many bytes are never revisits.
MIN_BYTES = 100
#: Fixed values of the WARC format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
CHUNK = 1 << 18
SALTS = 16
#: Whole pages that are sent to a Python worker at once.
PAGES = 500


def urn(page: int | None) -> str:
    return f"urn:page:{'' if page is None else page}"


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """One gzip member with a response record, or with a revisit record of `first`."""
    head = HTTP % len(payload)
    block = head + payload if first is None else head
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<{urn(page)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\s\x00-\x20\x7f]", lambda m: quote(m[0]), url or urn(page))),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{urn(first)}>")]
    fields.append(("Content-Length", str(len(block))))
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(text) + z.flush()


def members(read) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time; a truncated one raises ValueError."""
    z, parts, left = zlib.decompressobj(31), [], b""
    while True:
        chunk = left or read(CHUNK)
        if not chunk:
            if parts or z.unconsumed_tail:
                raise ValueError("the archive ends within a record")
            return
        parts.append(z.decompress(chunk))
        left = b""
        if z.eof:
            left = z.unused_data
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block; raises ValueError if framing or a digest is wrong."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    block = rest[:n]
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is not its Content-Length")
    if (want := fields.get("warc-block-digest")) and want != f"sha256:{sha256(block).hexdigest()}":
        raise ValueError("the block digest is wrong")
    return fields, block


def page_of(name: str) -> int | None:
    number = name.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def read_records(read) -> Iterator[tuple[int | None, str, int, str, str, int | None]]:
    """(id, url, payload bytes, payload digest, type, id that it refers to) of each record."""
    for member in members(read):
        fields, block = parse(member)
        head, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
        size = int(next(x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")))
        if kind == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
            raise ValueError("the payload digest is wrong")
        yield page_of(fields["warc-record-id"]), fields["warc-target-uri"], size, digest, kind, page_of(fields["warc-refers-to"]) if kind == "revisit" else None


def write(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None, min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes archives and returns (path, records, bytes) of each.

    Payloads move once, to the join with the digests that occur twice or more;
    that join is salted, so a payload that a third of all pages share spreads.
    """
    folder = folder or shared_dir(pages.sparkSession)
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    first = rows.filter(F.octet_length("body") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(first, ["digest", "salt"], "left")
    rows = rows.select("id", "url", "body", "digest", F.when(F.col("first") != F.col("id"), F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz", 0

        def parts() -> Iterator[bytes]:
            nonlocal n
            for batch in batches:
                for r in batch.to_pylist():
                    n += 1
                    yield record(r["id"], r["url"], r["body"], r["digest"], r["first"], date)

        todo = parts()
        one = next(todo, None)
        if one is not None:

            def all_parts() -> Iterator[bytes]:
                yield one
                yield from todo

            size = put(path, all_parts())
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [size]})

    return rows.mapInArrow(run, "path string, records long, bytes long")


def read(archives: DataFrame) -> DataFrame:
    """Records of the archives in the column `path`; each archive is read by one task, record by record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, at = store(path)
                rows = []
                with fs.open_input_stream(at, compression=None) as f:
                    for r in read_records(f.read):
                        rows.append(r)
                        if len(rows) == 2000:
                            yield out(rows)
                            rows = []
                if rows:
                    yield out(rows)

    return archives.select("path").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the archives now and returns their records, read back when asked for."""
    spark: SparkSession = pages.sparkSession
    with arrow_rows(spark, PAGES):
        made = write(pages, **options).collect()  # one short row for each archive
    if not made:
        return read(spark.createDataFrame([], "path string"))
    paths = spark.createDataFrame([(r["path"],) for r in made], "path string").repartition(len(made))
    return read(paths)


def oracle_sql() -> str:
    return f"""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, CASE WHEN payload_bytes >= {MIN_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS f FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN f <> page_id THEN f END AS refers_to FROM f"""
