"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Texts are lower-cased (A-Z) and cut into words; a window is 13 consecutive item
words, or a whole shorter item. The windows of all items make one automaton,
which scans each text once; matches are mapped back to words and to byte offsets
of the original text. Items beyond `block_bytes` of windows make further
automata, each in its own pass over the texts, so that no broadcast exceeds that
size whatever the benchmark. For several passes rows are numbered in a written
table, and the passes are merged by that number.

Defined results: a null or empty text has no words, no hits and is clean; an item
without words has no windows; items with equal windows are all reported; an empty
benchmark leaves every document clean; repeated documents are each reported;
other columns pass through unless they clash with an output, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import frugal, materialize, string_bytes

#: Fixed by the contract: words of an item in a window, and the share of hit words (1/20) that contaminates.
WINDOW, SHARE = 13, 20
#: ASCII that separates words: all but digits and letters.
SEPARATORS = bytes(i for i in range(128) if not (48 <= i < 58 or 97 <= i < 123))
_SPACED = bytes(32 if i in SEPARATORS else i for i in range(256))
_NORMAL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Bytes of windows in one automaton.
BLOCK_BYTES = 32 << 20


def normalise(text: bytes) -> bytes:
    """Lower case, and a space for each separator: as many bytes as before, so offsets stay."""
    return text.translate(_NORMAL).translate(_SPACED)


def windows(text: str | None) -> list[bytes]:
    words = normalise((text or "").encode()).split()
    if not words:
        return []
    return [b" ".join(words[i : i + WINDOW]) for i in range(max(1, len(words) - WINDOW + 1))]


def automaton(items: list[tuple]) -> ahocorasick.Automaton:
    """Windows, with a space on both sides, to (words, items that have it)."""
    owners: dict[bytes, set] = {}
    for item, text in items:
        for w in windows(text):
            ids = owners.setdefault(w, set())
            if item is not None:  # words of an item without an id are hit, but there is no item to name
                ids.add(str(item))
    out = ahocorasick.Automaton()
    for w, ids in owners.items():
        out.add_word(f" {w.decode('latin-1')} ", (len(w), w.count(b" ") + 1, tuple(ids)))
    if owners:
        out.make_automaton()
    return out


def scan(text: bytes, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit words as merged [first, last) ranges, and the items found."""
    words = normalise(text).split()
    if not words or not len(machine):
        return len(words), [], set()
    line = f" {b' '.join(words).decode('latin-1')} "
    found, items, at, k = [], set(), 0, 0
    for end, (size, n, ids) in machine.iter(line):
        start = end - size - 1
        k += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
        at = start
        found.append((k, k + n))
        items.update(ids)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return len(words), merged, items


def spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original text of ranges of words."""
    if not ranges:
        return []
    mark = np.frombuffer(normalise(text), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(first[a]), int(last[b - 1])) for a, b in ranges]


FIELDS = "n_words long, hit_ranges array<struct<first:long,last:long>>, hit_spans array<struct<start:long,end:long>>, items array<string>"


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, keep: str | None = None) -> DataFrame:
    """Per document: key, n_words, hit_ranges (words), hit_spans (bytes of the text), items; also the column `keep`.

    Items without an id contaminate like others, but are not among the items found.
    """
    spark = docs.sparkSession
    sized = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text"))
    blocks: list[list] = [[]]
    filled = 0
    # each window of 13 words starts at a word, so windows take at most 13 times the bytes of the text
    for row in sized.toLocalIterator():
        cost = 13 * len((row["text"] or "").encode())
        if filled and filled + cost > block_bytes:
            blocks.append([])
            filled = 0
        blocks[-1].append((row["item"], row["text"]))
        filled += cost
    several = len(blocks) > 1
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), *([F.col(f"`{keep}`").alias("row")] if keep else []))
    if several:
        whole = materialize(narrow.withColumn("number", F.monotonically_increasing_id()))
        narrow = whole.select(F.col("number").alias("key"), "text")
    with_row = bool(keep) and not several
    kind = narrow.schema["key"].dataType.simpleString()
    also = f", row {narrow.schema['row'].dataType.simpleString()}" if with_row else ""
    parts = []
    for block in blocks:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            machine = automaton(held.value)
            for batch in batches:
                data, at = string_bytes(batch.column("text"))
                raw = data.tobytes()
                rows = []
                for i in range(batch.num_rows):
                    t = raw[at[i] : at[i + 1]]
                    n, ranges, items = scan(t, machine)
                    rows.append((n, [{"first": a, "last": b} for a, b in ranges], [{"start": a, "end": b} for a, b in spans(t, ranges)], sorted(items)))
                cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
                word = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
                byte = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(cols[0], pa.int64()), pa.array(cols[1], word), pa.array(cols[2], byte), pa.array(cols[3], pa.list_(pa.string())), *([batch.column("row")] if with_row else [])],
                    names=["key", "n_words", "hit_ranges", "hit_spans", "items", *(["row"] if with_row else [])],
                )

        parts.append(narrow.mapInArrow(frugal(run), f"key {kind}, {FIELDS}{also}"))
    out = parts[0]
    if several:
        # passes are merged by the number of the row; the first has all rows. Ranges of different passes may overlap
        for p in parts[1:]:
            out = out.unionByName(p.filter("size(hit_ranges) > 0"))
        out = out.groupBy("key").agg(
            F.first("n_words").alias("n_words"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit_ranges")))).alias("hit_ranges"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit_spans")))).alias("hit_spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        out = whole.drop("text").join(out.withColumnRenamed("key", "number"), "number")
    # ranges of several passes may overlap: hit words are counted up to the furthest end so far
    hit = F.aggregate(
        "hit_ranges",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), r["last"] - F.greatest(a["end"], r["first"]))).alias("n"),
            F.greatest(a["end"], r["last"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    out = out.withColumn("n_hit", hit)
    return out.select(
        F.col("key").alias(key), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "hit_ranges", "hit_spans",
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        *([F.col("row").alias(keep)] if keep else []),
    )


def oracle_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all({low}, '{word}') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({low}, '{word}') AS w FROM benchmark),
    i AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, list_slice(w, k, k + least(len(w), {WINDOW}) - 1) AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS k FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM i),
    g AS (SELECT doc_id, n, k, list_slice(w, k, k + n - 1) AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
    m AS (SELECT doc_id, k, n, item_id FROM g JOIN i USING (n, g)),
    h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
    t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
