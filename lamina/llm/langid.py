"""Language identification with hyperdimensional profiles.

Every letter symbol has a random vector of +1 and -1; the vectors of an n-gram's
letters, permuted by their place, are bound by multiplication into the n-gram's
vector. Bundling (adding) the n-gram vectors of a text gives its profile, and
bundling all texts of a language its prototype. A text gets the language whose
prototype has the greatest cosine with its profile.

Bundling is linear, so a language's prototype is made from its n-gram counts,
which combine before the shuffle; executors bundle them, and SIZE numbers for each
language come to the driver. Vectors of n-grams are bound when they are needed.

Defined results: a null text, or one without a letter, is `und` with score 0; ties
go to the language that sorts first; without training rows every text is `und`;
repeated rows are each judged; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import blocks, string_bytes

#: Components of a vector; symbols (a power of two); letters in an n-gram; most languages, beyond which an error is raised.
SIZE, SYMBOLS, N, MAX_LANGS = 1024, 4096, 3, 65_536
UNKNOWN = "und"
#: Bytes of text and n-grams looked at together; n-gram counts that a task holds before it sends them.
BLOCK, BOUND, HELD = 1 << 18, 1 << 12, 1 << 20
#: Vectors that a worker keeps.
KEPT = 1 << 14
_known: dict[int, int] = {}
_bound = np.empty((KEPT, SIZE), np.int8)
_symbols: np.ndarray | None = None
_vectors: list[np.ndarray] | None = None


def symbols() -> np.ndarray:
    """Symbol of each code point: 0 for all but letters, 1-26 for a-z in either case, a hash beyond for other letters."""
    global _symbols
    if _symbols is None:
        out = np.zeros(0x110000, np.uint16)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()[0]
                out[i] = ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 7) % (SYMBOLS - 27)
        _symbols = out
    return _symbols


def vectors(ids: np.ndarray) -> np.ndarray:
    """The bound vectors of n-grams: the product of their letters' vectors, each rotated by its place. The first `KEPT` that a worker meets are bound once."""
    global _vectors
    if _vectors is None:
        letters = np.random.default_rng(5).integers(0, 2, (SYMBOLS, SIZE), dtype=np.int8) * 2 - 1
        _vectors = [np.roll(letters, k, axis=1) for k in range(N)]
    place = np.fromiter((_known.get(i, -1) for i in ids.tolist()), np.int64, len(ids))
    new = np.flatnonzero(place < 0)
    out = np.empty((len(ids), SIZE), np.int8)
    old = np.flatnonzero(place >= 0)
    out[old] = _bound[place[old]]
    if len(new):
        bound = _vectors[0][ids[new] % SYMBOLS]
        for k in range(1, N):
            bound *= _vectors[k][ids[new] // SYMBOLS**k % SYMBOLS]
        out[new] = bound
        for i, v in zip(ids[new][: max(0, KEPT - len(_known))].tolist(), bound, strict=False):
            _bound[len(_known)] = v
            _known[i] = len(_known)
    return out


def ngrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram ids with their row, and the number of letters in each row; runs of other characters are one space, which ends a text too but does not begin it."""
    text = data.tobytes()
    chars = np.frombuffer("".join(text[a:b].decode() + "\n" for a, b in zip(at[:-1], at[1:], strict=True)).encode("utf-32-le"), np.uint32)
    code = symbols()[chars]
    # texts hold line feeds of their own, so row numbers come from character counts
    lengths = np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at))[(data & 0xC0) != 0x80], minlength=len(at) - 1) if len(data) else np.zeros(len(at) - 1, int)
    row = np.repeat(np.arange(len(at) - 1), lengths + 1)[: len(chars)]
    letters = np.bincount(row[code > 0], minlength=len(at) - 1)
    keep = np.ones(len(code), bool)
    keep[:1] = code[:1] > 0
    keep[1:] = (code[1:] > 0) | (code[:-1] > 0)
    code, row = code[keep].astype(np.int64), row[keep]
    n = len(code) - N + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    ids = np.zeros(n, np.int64)
    for k in range(N):
        ids = ids * SYMBOLS + code[k : k + n]
    same = row[:n] == row[N - 1 :]
    return ids[same], row[:n][same], letters


def language_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, id, n): n-gram counts over all texts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # language, n-gram, count
        known: dict[str, int] = {}

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            which, ids, n = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((ids, which))
            which, ids, n = which[order], ids[order], n[order]
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (which[1:] != which[:-1])
            head = np.flatnonzero(new)
            return which[head], ids[head], np.add.reduceat(n, head)

        def flush() -> pa.RecordBatch:
            which, ids, n = merged()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()).take(pa.array(which)), pa.array(ids), pa.array(n)], names=["lang", "id", "n"])

        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for i, j in blocks(at, BLOCK):
                ids, row, _ = ngrams(data[at[i] : at[j]], at[i : j + 1] - at[i])
                if not len(ids):
                    for name in langs[i:j]:  # a language whose texts have no n-gram is one nevertheless
                        known.setdefault(name, len(known))
                    continue
                which = np.array([known.setdefault(name, len(known)) for name in langs[i:j]])
                held.append((which[row], ids, np.ones(len(ids), np.int64)))
                if sum(len(h[1]) for h in held) > HELD:
                    held[:] = [merged()]
                    if len(held[0][1]) > HELD // 2:
                        yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInArrow(run, "lang string, id long, n long")
    return rows.groupBy("lang", "id").agg(F.sum("n").alias("n"))


def prototypes(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their unit vectors."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, ids, n = batch.column("lang").dictionary_encode(), batch.column("id").to_numpy(), batch.column("n").to_numpy()
            which = langs.indices.to_numpy()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                own = np.flatnonzero(which == k)
                for a in range(0, len(own), BOUND):
                    at = own[a : a + BOUND]
                    total[name] = total.get(name, 0) + n[at].astype(np.float64) @ vectors(ids[at])
        for name, v in total.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name]), "v": pa.array([v.tolist()], pa.list_(pa.float64()))})

    parts = counts.mapInArrow(bundle, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    each = parts.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))
    got = sorted(each.limit(MAX_LANGS + 1).collect())  # SIZE numbers for each language
    if len(got) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not got:
        return [], np.zeros((0, SIZE), np.float32)
    out = np.array([r["v"] for r in got])
    return [r["lang"] for r in got], (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def profiles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vector of each row, and its letters. Vectors are bound for some n-grams at a time, so a long text with many of them takes no more memory than its letters."""
    n = len(at) - 1
    ids, row, letters = ngrams(data, at)
    seen, which = np.unique(ids, return_inverse=True)
    order = np.argsort(which, kind="stable")
    which, row = which[order], row[order]
    out = np.zeros((n, SIZE), np.float32)
    step = max(64, min(BOUND, (1 << 22) // max(n, 1)))
    for a in range(0, len(seen), step):
        part = seen[a : a + step]
        i, j = np.searchsorted(which, (a, a + len(part)))
        counts = np.bincount(row[i:j] * len(part) + which[i:j] - a, minlength=n * len(part)).reshape(n, len(part)).astype(np.float32)
        out += counts @ vectors(part).astype(np.float32)
    return out, letters


def predict(docs: DataFrame, names: list[str], proto: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score (cosine, 0 to 1) of each row."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast((names, proto))  # MAX_LANGS vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, proto = held.value
        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            langs, scores = [], []
            for i, j in blocks(at, BLOCK):
                got, letters = profiles(data[at[i] : at[j]], at[i : j + 1] - at[i])
                norm = np.linalg.norm(got, axis=1)
                cos = got @ proto.T / np.maximum(norm, 1e-12)[:, None] if names else np.zeros((j - i, 1))
                best = cos.argmax(axis=1)
                known = (letters > 0) & bool(names)
                langs += [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores.append(np.where(known, np.clip(cos[np.arange(j - i), best], 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["key", "lang_pred", "score"])

    return narrow.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def identify(docs: DataFrame, learn: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learns prototypes from all rows of `learn` whose language is not null, and judges `docs`."""
    return predict(docs, *prototypes(language_counts(learn.filter(F.col(lang).isNotNull()), text, lang)), key, text)
