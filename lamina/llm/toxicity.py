"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and the L1 term keeps most weights at
exactly 0, so the model that is broadcast is two short arrays. Features are the
distinct words and their leading parts, word pairs and pairs with one word between them of a whole text,
hashed to 2**BITS places.

Learning uses at most `max_rows` labelled documents (those with the smallest
hashed keys); that bounds its one sequential task. Scoring covers all texts.

Defined results: a null text, or one without words, has the score of the bias
alone; without labelled rows of both kinds every score is 0; repeated rows are
each scored; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.decontaminate import SEPARATORS
from lamina.llm.shared import blocks, lower_ascii, mix, prefix_hash, span_hash, string_bytes, word_bounds

BITS, MAX_ROWS, EPOCHS = 20, 20_000, 3
#: Leading bytes of longer words that are features too, so that inflected forms of a word share weight.
STEMS = (4, 5, 6, 7)
#: FTRL: learning rate, its smoothing, and the L1 and L2 terms.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2.0, 1.0


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all features and their row; the place 2**BITS is the bias and not among them."""
    data = lower_ascii(data)
    start, end, per = word_bounds(data, at, SEPARATORS + bytes(range(65, 91)))
    sums = prefix_hash(data)
    words = span_hash(sums, start, end)
    row = np.repeat(np.arange(len(at) - 1), np.diff(per))
    out, rows = [words], [row]
    for size in STEMS:
        long = np.flatnonzero(end - start > size)
        out.append(span_hash(sums, start[long], start[long] + size) * np.uint64(7))
        rows.append(row[long])
    for gap, salt in ((1, 3), (2, 5)):
        if len(words) > gap:
            same = row[:-gap] == row[gap:]
            out.append(mix(words[:-gap] * np.uint64(salt) + words[gap:])[same])
            rows.append(row[:-gap][same])
    return (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the proximal step."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Places with a weight, and the weights; rows are (distinct places, label) in order."""
    z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
    for _ in range(epochs):
        for places, label in rows:
            zs, ns = z[places], n[places]
            w = weights(zs, ns)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            root = np.sqrt(ns + g * g)
            z[places] = zs + g - (root - np.sqrt(ns)) / ALPHA * w
            n[places] = ns + g * g
    w = weights(z, n)
    at = np.flatnonzero(w)
    return at, w[at]


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Fits the model on at most `max_rows` labelled documents; null labels and unknown keys are left out."""
    chosen = labels.filter(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    chosen = chosen.withColumn("order", F.xxhash64(F.lit(11), "key")).orderBy("order", "key", "label").limit(max_rows)
    # at most max_rows short rows are broadcast
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            out = []
            for i, j in blocks(at):
                place, row = features(data[at[i] : at[j]], at[i : j + 1] - at[i])
                got = np.unique(row << (BITS + 1) | place)
                cut = np.searchsorted(got >> (BITS + 1), np.arange(j - i + 1))
                got = np.append((got & (2 ** (BITS + 1) - 1)).astype(np.int32), np.int32(0))
                out += [np.append(got[a:b], np.int32(2**BITS)).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("label"), pa.array(out, pa.binary())], names=["order", "label", "places"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(r["places"], np.int32).copy(), r["label"]) for b in batches for r in b.to_pylist()]
        if len({label for _, label in rows}) > 1:
            at, w = fit(rows)
            yield pa.RecordBatch.from_pydict({"place": pa.array(at, pa.int64()), "weight": pa.array(w, pa.float64())})

    made = rows.mapInArrow(extract, "order long, label int, places binary").repartition(1).sortWithinPartitions("order", "places", "label")
    got = made.mapInArrow(train, "place long, weight double").toPandas()  # 2**BITS + 1 rows at most, few by L1
    return got["place"].to_numpy(np.int64), got["weight"].to_numpy(np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score (0 to 1) of each row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, w = held.value
        dense = np.zeros(2**BITS + 1, np.float64)
        dense[places] = w
        bias = dense[2**BITS] if len(places) else -np.inf
        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            out = [np.zeros(0)]
            for i, j in blocks(at):
                place, row = features(data[at[i] : at[j]], at[i : j + 1] - at[i])
                used = dense[place] != 0
                got = np.unique(row[used] << (BITS + 1) | place[used])
                total = np.bincount(got >> (BITS + 1), weights=dense[got & (2 ** (BITS + 1) - 1)], minlength=j - i)
                out.append(1 / (1 + np.exp(-np.clip(total + bias, -700, 700))) if len(places) else total)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.concatenate(out), pa.float64())], names=["key", "score"])

    return narrow.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
