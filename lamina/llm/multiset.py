"""Fingerprints that add up: the sum of wide vectors hashed from a text's paragraphs.

A vector has 4 lanes of 64 digest bits, which tell multisets of paragraphs apart, and
`SIGNS` lanes of +1 or -1, by which the distance of two sums estimates how many paragraphs they do not share.
All lanes are sums modulo 2**64: order does not matter, and a paragraph is put in or taken out by one addition.
"""

from __future__ import annotations

import re
from base64 import b64decode, b64encode
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.shared import Tables, materialize

EXACT, SIGNS = 4, 256
LANES = EXACT + SIGNS
#: Paragraphs end at a line's end; long ones are cut behind sentences. Empty ones do not count.
CUT = re.compile(rb"(?<=[.!?]) |\n")
ENDS = (b"\n", b". ", b"! ", b"? ")
#: Paragraphs whose vectors are added up at once.
AT_ONCE = 1 << 13
#: Bytes of text behind one range of the order.
RANGE_BYTES = 32 << 20


def vector(text: bytes) -> np.ndarray:
    """The sum of the vectors of a text's paragraphs."""
    pieces = [p for p in CUT.split(text) if p]
    out = np.zeros(LANES, np.uint64)
    for i in range(0, len(pieces), AT_ONCE):
        part = pieces[i : i + AT_ONCE]
        raw = np.frombuffer(b"".join([blake2b(p, digest_size=8 * EXACT + SIGNS // 8).digest() for p in part]), np.uint8).reshape(len(part), -1)
        out[:EXACT] += np.ascontiguousarray(raw[:, : 8 * EXACT]).view("<u8").sum(axis=0, dtype=np.uint64)
        up = np.unpackbits(raw[:, 8 * EXACT :], axis=1).sum(axis=0, dtype=np.int64)
        out[EXACT:] += (2 * up - len(part)).astype(np.uint64)
    return out


def pack(v: np.ndarray) -> str:
    """Base64 of the digest lanes and of the sign lanes in the smallest width that holds them all."""
    signs = v[EXACT:].astype(np.int64)
    most = max(-int(signs.min()) - 1, int(signs.max()))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return b64encode(v[:EXACT].astype("<u8").tobytes() + signs.astype(f"<i{width}").tobytes()).decode()


def unpack(fingerprint: str) -> np.ndarray:
    raw = b64decode(fingerprint)
    signs = np.frombuffer(raw, f"<i{(len(raw) - 8 * EXACT) // SIGNS}", offset=8 * EXACT).astype(np.int64)
    return np.concatenate([np.frombuffer(raw, "<u8", EXACT), signs.astype(np.uint64)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice what two multisets share over what both have, estimated from their sums; 1 for equal ones, two empty ones included."""
    x, y = a[EXACT:].astype(np.int64).astype(np.float64), b[EXACT:].astype(np.int64).astype(np.float64)
    both = float(x @ x + y @ y)
    if not both:
        return 1.0
    return max(0.0, 1.0 - float((x - y) @ (x - y)) / both)


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Rows with the fingerprint of their text (null: empty) as a further column. Nothing is shuffled.

    Equal texts, and texts of the same paragraphs in any order, have equal fingerprints. A column of that name is replaced.
    """
    return _added(docs, name, [F.coalesce(text, F.lit(""))], lambda x: pack(vector(x.encode())))


def changed(rows: DataFrame, fingerprint: str, deleted: str, inserted: str) -> DataFrame:
    """Rows whose fingerprint has the paragraphs of one column taken out and those of another put in; null columns change nothing.

    The text itself is not needed. A null fingerprint is that of an empty text.
    """
    empty = lambda c: F.coalesce(c, F.lit(""))
    known = F.coalesce(fingerprint, F.lit(pack(np.zeros(LANES, np.uint64))))
    return _added(rows, fingerprint, [known, empty(deleted), empty(inserted)], lambda f, out, into: pack(unpack(f) - vector(out.encode()) + vector(into.encode())))


def merged(rows: DataFrame, by: str, fingerprint: str = "fingerprint") -> DataFrame:
    """(by, fingerprint) of all paragraphs of a group: each task adds up its rows, so groups of any size shuffle a sum for each task.

    Null fingerprints count as empty texts; null groups are one group.
    """
    kind = rows.schema[by].dataType.simpleString()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict = {}
            for key, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[key] = sums.get(key, np.zeros(LANES, np.uint64)) + (unpack(f) if f is not None else np.zeros(LANES, np.uint64))
            keys = pa.array(list(sums), batch.schema.field(0).type)
            yield pa.RecordBatch.from_arrays([keys, pa.array([v.astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["k", "v"])

    parts = rows.select(F.col(by).alias("k"), F.col(fingerprint).alias("f")).mapInArrow(partial, f"k {kind}, v array<bigint>")
    # lanes wrap as 64-bit sums do: two 32-bit halves are added apart and put together again
    lanes = [F.col("v")[i] for i in range(LANES)]
    halves = [x for i, c in enumerate(lanes) for x in (F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"l{i}"), F.sum(F.shiftrightunsigned(c, 32)).alias(f"h{i}"))]
    total = parts.groupBy("k").agg(*halves)
    whole = F.array(*[_joined(f"h{i}", f"l{i}") for i in range(LANES)])
    out = _added(total.select("k", whole.alias("v")), "fingerprint", [F.col("v")], lambda v: pack(np.array(v, np.int64).astype(np.uint64)))
    return out.select(F.col("k").alias(by), "fingerprint")


def _joined(high: str, low: str) -> Column:
    """high * 2**32 + low modulo 2**64 without overflow: the carry of the low half goes to the high one before it is shifted."""
    carried = F.col(high) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(carried, 32).bitwiseOR(F.col(low).bitwiseAND(F.lit(0xFFFFFFFF)))


def _added(rows: DataFrame, name: str, args: list[Column], of) -> DataFrame:
    """Rows with a string column of that name, computed from `args` row by row in Arrow batches."""
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != name]).alias("_row") if set(rows.columns) - {name} else F.struct(F.lit(1).alias("_")).alias("_row"), *[a.alias(f"_{i}") for i, a in enumerate(args)])
    kind, n = whole.schema["_row"].dataType.simpleString(), len(args)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [of(*[batch.column(k + 1)[i].as_py() for k in range(n)]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string())], names=["_row", "_value"])

    out = whole.mapInArrow(run, f"_row {kind}, _value string")
    kept = [F.col(f"_row.`{c}`") for c in rows.columns if c != name]
    return out.select(*kept, F.col("_value").alias(name))


def ranges_of(docs: DataFrame, text: str) -> int:
    """How many ranges the order is cut into: by the bytes of the texts, at least one for each shuffle partition."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size // RANGE_BYTES))


def with_next(docs: DataFrame, ranges: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_range, _last, _key, text): rows that stand in the order of the key, so that each row's next one follows it.

    To be dealt by `_range` and sorted by (_range, _last, _key). The last row of a range, marked `_last`, is the first of the
    next range that has rows (after the last the first) and is there for its predecessor only. Rows of equal key follow each
    other by a hash of their text; of wholly equal rows any order is the same. So a key of any number of rows is cut too.
    """
    base = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("_key", F.struct("id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("at")))
    # the rows with the least hashes are a sample of fixed size that every run draws alike
    spots = base.select("_key", F.xxhash64("_key").alias("r")).orderBy("r").limit(16 * ranges).select("_key")
    ranked = spots.select("_key", F.row_number().over(W.orderBy("_key")).alias("r"), F.count("*").over(W.partitionBy()).alias("n"))  # 16 rows for each range
    borders = ranked.filter(F.col("r") % F.greatest(F.lit(1), F.floor(F.col("n") / (2 * ranges))) == 0).agg(F.sort_array(F.collect_list("_key")).alias("_borders"))
    steps = F.array(*[F.lit(1 << k) for k in range((16 * ranges).bit_length(), -1, -1)])
    below = lambda at, step: F.when((at + step <= F.size("_borders")) & (F.get("_borders", at + step - 1) < F.col("_key")), at + step).otherwise(at)
    dealt = base.withColumn("_one", F.lit(1)).join(F.broadcast(borders.withColumn("_one", F.lit(1))), "_one")  # one row beside each
    dealt = dealt.select("_key", "text", F.aggregate(steps, F.lit(0), below).alias("_range"))
    with Tables() as tables:
        firsts = dealt.groupBy("_range").agg(F.min(F.struct("_key.id", "_key.h")).alias("_first"))
        order = W.orderBy("_range")  # a row for each range
        before = F.coalesce(F.lag("_range").over(order), F.max("_range").over(W.partitionBy()))
        firsts = tables.keep(materialize(firsts.select("_range", "_first", before.alias("_before"))))
    heads = dealt.withColumn("_first", F.struct("_key.id", "_key.h")).alias("d").join(F.broadcast(firsts.alias("f")), (F.col("d._range") == F.col("f._range")) & F.col("d._first").eqNullSafe(F.col("f._first")))
    heads = heads.select(F.col("f._before").alias("_range"), "d._key", "d.text").dropDuplicates(["_range"])
    return dealt.select("_range", F.lit(False).alias("_last"), "_key", "text").unionByName(heads.select("_range", F.lit(True).alias("_last"), "_key", "text"))


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside an edit of it: the last half of its characters gives way to as many first ones of the next document.

    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The edited
    fingerprint is that of the document with the paragraphs behind the last one left whole taken out and the new ones put in.

    Null texts are empty. Order is by key, null keys first, rows of equal key by a hash of their text; the last document
    is followed by the first, an only one by itself. Repeated rows each give a row. Without rows there is no result.
    Other columns are not looked at. Texts are shuffled once; a task holds one batch of them.
    """
    ranges = ranges_of(docs, text)
    rows = with_next(docs, ranges, key, text)
    kind = docs.schema[key].dataType.simpleString()
    dealt = rows.repartition(ranges, "_range").sortWithinPartitions("_range", "_last", "_key").select("_range", F.col("_key.id").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                at, this = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                mine = vector(this.encode())
                if held is not None and held[0] == at:
                    out.append(_edit(*held[1:], this, mine))
                held = (at, batch.column(1)[i], this, mine)
            if out:
                columns = list(zip(*out, strict=True))
                types = [batch.schema.field(1).type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in columns[0]], types[0]), *[pa.array(c, t) for c, t in zip(columns[1:], types[1:], strict=True)]], names=["id", *RESULTS])

    return dealt.mapInArrow(run, f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("id", key)


#: Columns of `edited` besides the key.
RESULTS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _edit(key, text: str, mine: np.ndarray, after: str, its: np.ndarray) -> tuple:
    half = len(text) // 2
    kept = text[: len(text) - half]
    new = (kept + after[:half]).encode()
    left = kept.encode()
    whole = max([left.rfind(e) + len(e) for e in ENDS if e in left], default=0)
    new_vector = mine - vector(text.encode()[whole:]) + vector(new[whole:])
    return key, len(text), sha256(new).hexdigest(), pack(mine), pack(new_vector), likeness(mine, new_vector), likeness(mine, its)
