"""Removal of repeated byte strings by prefix-free parsing.

A byte is removed if a string of LENGTH bytes that covers it also starts in a
document with a smaller key. Strings are judged on the input.

Parsing. A rolling hash over GRAM bytes sets triggers: the trigger of a string is
the smallest hash in it, so equal strings have equal triggers wherever they
stand. Neighbouring strings with one trigger make a phrase, which runs to the end
of the last of them; the next phrase overlaps it by LENGTH - 1 bytes, so no phrase
is a prefix of what starts in another, and each string starts in exactly one
phrase. At this length of comparison the order of suffixes is settled within
phrases: dictionary order first, and among equal suffixes the order of the parse,
of which only the smallest key is needed.

Distribution. Equal strings share their trigger, so the corpus order falls apart
into independent ranges by trigger.
1. Tasks send each trigger once: with its phrase's hash and the smallest key that
   has it, or with the word that several phrases have it. Where all phrases of a
   trigger are equal, every key but the smallest is settled as a whole phrase.
2. Only phrases whose trigger also stands in other phrases are sent as text; their
   suffixes are put in corpus order, and runs of equal ones settled by smallest key.
   Triggers that very many rows have are spread further, by their strings, and each
   task sends a string once.
3. Settled starts go back to their texts, which are shuffled once for both joins.

Defined results: a null or empty text has no bytes; texts shorter than LENGTH
stay; rows with equal keys have to be equal and get equal results; a null key
removes nothing and keeps everything; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import INVERSE, blocks, materialize, mix, powers, prefix_hash, span_hash, string_bytes

#: Fixed by the contract.
LENGTH = 50
#: Bytes of a trigger; bytes of a trigger and of a phrase hash that are sent (44 million phrases a GB of text; 8 is the most).
GRAM, TRIGGER_BYTES, PHRASE_BYTES = 16, 6, 5
#: Phrases that a task gathers before it sends them; rows from which a trigger is spread; triggers that are spread, those with the most rows.
CHUNK, HOT, MOST_HOT = 1 << 20, 1000, 1 << 20
#: Phrases of one trigger that a task sends; of more it sends only that there are many.
FEW = 8
#: Bytes of phrases that a task gathers before it sends them as text.
TEXT_CHUNK = 16 << 20
LOW = np.uint64((1 << (8 * TRIGGER_BYTES)) - 1)


def phrases(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all phrases: row, first start, number of starts, trigger and hash of the whole phrase."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_hash(data)
    low = mix((sums[GRAM:] - sums[:-GRAM]) * powers(INVERSE, len(data))[: len(data) - GRAM + 1])
    width, have = LENGTH - GRAM + 1, 1
    total = len(low) - width + 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[:total], low[width - have : width - have + total])
    # a string has to end in the row in which it starts
    sizes = np.maximum(np.diff(at) - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(row)) + np.repeat(at[:-1] - (np.cumsum(sizes) - sizes), sizes)
    if not len(start):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    key = low[start]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(key)))
    if count.max() > width:  # periodic text: one trigger again and again
        since = np.arange(len(key)) - np.repeat(head, count)
        head = np.flatnonzero(since % width == 0)
        count = np.diff(np.append(head, len(key)))
    first = start[head]
    return row[head], first, count, key[head], span_hash(sums, first, first + count + LENGTH - 1)


def narrow(values: np.ndarray, size: int) -> bytes:
    """The lowest `size` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def wide(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    return out.view("<u8").reshape(-1)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where groups of equal rows begin, in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def settled(trigger: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    return mix(trigger * np.uint64(0x9E3779B97F4A7C15) + phrase)


def merged(key: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts, sorted by key, with touching and overlapping ones joined."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], (start + count)[order]
    if not len(key):
        return key, start, end
    head = heads(key)
    # ends are made to rise through all keys, so that one running maximum serves
    shift = np.zeros(len(key), np.int64)
    shift[head[1:]] = end.max() + 1
    shift = np.cumsum(shift)
    top = np.maximum.accumulate(end + shift)
    new = np.ones(len(key), bool)
    new[1:] = (start + shift)[1:] > top[:-1]
    at = np.flatnonzero(new)
    return key[at], start[at], (top - shift)[np.append(at[1:], len(key)) - 1] - start[at]


def dealt(keys: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple]:
    """(part, keys, columns …) as bytes, a key's rows all in one part."""
    part = (mix(keys.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cut)):
        o = order[cut[p] : cut[p + 1]]
        yield int(p), keys[o].tobytes(), *(c[o].tobytes() for c in columns)


def gathered(packed: DataFrame, parts: int) -> DataFrame:
    """From packed rows (part, keys, a, b) one row (key, a, b) for each key; a and b hold 8-byte values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [[np.frombuffer(v or b"", np.int64) for v in r.values()] for batch in batches for r in batch.select(["keys", "a", "b", "more"]).to_pylist()]
        if not rows:
            return
        keys, a, b, more = (np.concatenate(c) for c in zip(*rows, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, a, b, more = keys[order], a[order], b[order], more[order].astype(bool)
        head = heads(keys)
        # a row of kind "more" has its value in a for the second list
        for at in range(0, len(head), 4096):
            ends = np.append(head, len(keys))[at : at + 4097]
            if more.any():
                first = [a[x:y][~more[x:y]].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                second = [a[x:y][more[x:y]].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
            else:
                first, second = ([c[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)] for c in (a, b))
            yield pa.RecordBatch.from_arrays([pa.array(keys[ends[:-1]]), pa.array(first, pa.binary()), pa.array(second, pa.binary())], names=["key", "a", "b"])

    return packed.repartitionById(parts, "part").mapInArrow(run, "key long, a binary, b binary")


def parts_of(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def parse(rows: DataFrame, parts: int, hot_rows: int = HOT) -> DataFrame:
    """Packed by text: phrases that are settled as a whole, and triggers (more) with several phrases; in part null, hot triggers."""

    def answers(key: np.ndarray, value: np.ndarray, more: bool) -> Iterator[tuple]:
        return dealt(key, parts, value, np.zeros(len(key), np.int64), np.full(len(key), more, np.int64))

    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["part", "sure", "base", "width", "a", "b", "c", "d"]

    def batch_of(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            doc, trigger, phrase = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((doc, phrase, trigger))
            doc, trigger, phrase = doc[order], trigger[order], phrase[order]
            keep = heads(trigger, phrase, doc)
            doc, trigger, phrase = doc[keep], trigger[keep], phrase[keep]
            head = heads(trigger, phrase)
            size = np.diff(np.append(head, len(doc)))
            later = doc != np.repeat(doc[head], size)
            out = [(p, True, 0, 0, *row) for p, *row in answers(doc[later], settled(trigger, phrase)[later], False)]
            # the smallest key of each phrase goes on; of a trigger with many phrases only the fact, as phrase 0
            doc, trigger, phrase = doc[head], trigger[head], phrase[head]
            head = heads(trigger)
            count = np.diff(np.append(head, len(doc)))
            size = np.minimum(np.add.reduceat(size, head), 255).astype(np.uint8)
            many = count > FEW
            told = np.repeat(many, count)
            out += [(p, True, 0, 0, *row) for p, *row in answers(doc[told], trigger[told], True)]
            phrase[head[many]] = 0
            told[head] = False
            n = np.repeat(size, count)[~told]
            t, p, d = trigger[~told], phrase[~told], doc[~told]
            part = (mix(t) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            t, p, d, n = t[order], p[order], d[order], n[order]
            base = int(d.min())
            size = next(s for s in (2, 4, 8) if s == 8 or int(d.max()) - base < 1 << (8 * s))
            d = (d - base).astype(np.uint64)
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            for i in range(parts):
                a, b = cut[i], cut[i + 1]
                if b > a:
                    out.append((i, False, base, size, narrow(t[a:b], TRIGGER_BYTES), narrow(p[a:b], PHRASE_BYTES), narrow(d[a:b], size), n[a:b].tobytes()))
            yield batch_of(out, names, kinds)

        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            keys = batch.column("key").to_numpy()
            for i, j in blocks(at):
                row, _, _, trigger, phrase = phrases(data[at[i] : at[j]], at[i : j + 1] - at[i])
                if not len(row):
                    continue
                found.append((keys[i:j][row], trigger & LOW, np.maximum(phrase & np.uint64((1 << (8 * PHRASE_BYTES)) - 1), np.uint64(1))))
                held += len(row)
                if held >= CHUNK:
                    yield from flush()
                    found.clear()
                    held = 0
        if held:
            yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[tuple] = []
        names, kinds = ["part", "keys", "a", "b", "more"], [pa.int32(), *[pa.binary()] * 4]
        for batch in batches:
            for r in batch.to_pylist():
                if r["sure"]:
                    yield batch_of([(r["part"], r["a"], r["b"], r["c"], r["d"])], names, kinds)
                else:
                    columns.append((wide(r["a"], TRIGGER_BYTES), wide(r["b"], PHRASE_BYTES), wide(r["c"], r["width"]).astype(np.int64) + r["base"], np.frombuffer(r["d"], np.uint8)))
        if not columns:
            return
        t, p, d, n = (np.concatenate(c) for c in zip(*columns, strict=True))
        columns.clear()
        order = np.lexsort((d, p, t))
        t, p, d, n = t[order], p[order], d[order], n[order]
        head = heads(t)
        rows_of = np.add.reduceat(n.astype(np.int64), head)
        hot, weight = t[head][rows_of >= hot_rows], rows_of[rows_of >= hot_rows]
        count = np.diff(np.append(head, len(t)))
        several = np.repeat(p[head] != p[head + count - 1], count) & (p != 0)
        head = heads(t, p)
        first = np.zeros(len(t), bool)
        first[head] = True
        later = (p != 0) & (d != np.repeat(d[head], np.diff(np.append(head, len(t)))))
        ask = several & first
        done = [*answers(d[later], settled(t[later], p[later]), False), *answers(d[ask], t[ask], True)]
        if len(hot):
            done.append((None, b"", hot.tobytes(), weight.tobytes(), b""))
        if done:
            yield batch_of(done, names, kinds)

    sent = rows.filter("key IS NOT NULL").mapInArrow(send, "part int, sure boolean, base long, width int, a binary, b binary, c binary, d binary")
    return sent.repartitionById(parts, "part").mapInArrow(match, "part int, keys binary, a binary, b binary, more binary")


def corpus_order(text: np.ndarray, start: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each string at `start` has an equal one with a smaller key.

    Strings are sorted as suffixes cut at LENGTH bytes, by big-endian words, and
    within equal ones by key; a run's first key is its smallest.
    """
    # most strings have no equal: a hash sets those aside before anything is sorted as text
    h = span_hash(prefix_hash(text), start, start + LENGTH)
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h), bool)
    twin = h[order][1:] == h[order][:-1]
    same[order[1:]] |= twin
    same[order[:-1]] |= twin
    at = np.flatnonzero(same)
    out = np.zeros(len(start), bool)
    if not len(at):
        return out
    raw = np.zeros((len(at), -(-LENGTH // 8) * 8), np.uint8)
    raw[:, :LENGTH] = text[start[at][:, None] + np.arange(LENGTH)]
    words = raw.view(">u8").astype(np.uint64)
    order = np.lexsort((key[at], *words.T[::-1]))
    head = heads(*words[order].T)
    count = np.diff(np.append(head, len(order)))
    out[at[order]] = key[at][order] > np.repeat(key[at][order][head], count)
    return out


def compare(joined: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """Packed by text: settled starts (a) and how many follow one another (b), from texts with the findings of `parse`."""
    held = joined.sparkSession.sparkContext.broadcast(np.sort(hot))  # MOST_HOT numbers at most
    names = ["part", "sure", "keys", "triggers", "starts", "counts", "text"]
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def pieces(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all spans one after another, and where each begins there."""
        into = np.cumsum(size) - size
        return text[np.arange(int(size.sum())) + np.repeat(start - into, size)], into

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread, pack = held.value, zstandard.ZstdCompressor(level=3)
        sure: list[tuple] = []
        asked: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            key, trigger, inside, count, text = (np.concatenate(c) for c in zip(*asked, strict=True))
            into = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
            if len(spread) and len(trigger):
                is_hot = spread[np.minimum(np.searchsorted(spread, trigger), len(spread) - 1)] == trigger
                each = np.repeat(np.flatnonzero(is_hot), count[is_hot])
                step = np.arange(len(each)) - np.repeat(np.cumsum(count[is_hot]) - count[is_hot], count[is_hot])
                place, owner, home = into[each] + step, key[each], inside[each] + step
                h = span_hash(prefix_hash(text), place, place + LENGTH)
                order = np.lexsort((home, owner, h))
                place, owner, home, h = place[order], owner[order], home[order], h[order]
                head = heads(h)
                size = np.diff(np.append(head, len(h)))
                equal = (text[place[:, None] + np.arange(LENGTH)] == text[np.repeat(place[head], size)[:, None] + np.arange(LENGTH)]).all(1) if len(h) else np.zeros(0, bool)
                later = equal & (owner != np.repeat(owner[head], size))
                sure.append((owner[later], home[later], np.ones(int(later.sum()), np.int64)))
                # the smallest key's starts of a string stand for all that the task holds here
                left, cold = ~later, ~is_hot
                bytes_of, _ = pieces(text, place[left], np.full(int(left.sum()), LENGTH))
                rest, _ = pieces(text, into[cold], count[cold] + LENGTH - 1)
                key, trigger, inside = np.append(key[cold], owner[left]), np.append(trigger[cold], h[left]), np.append(inside[cold], home[left])
                count = np.append(count[cold], np.ones(int(left.sum()), np.int64))
                text = np.append(rest, bytes_of)
                into = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
            done = merged(*(np.concatenate(x) for x in zip(*sure, strict=True)))
            rows = [(p, True, k, b"", s, c, b"") for p, k, s, c in dealt(done[0], parts, *done[1:])]
            part = (mix(trigger + np.uint64(1)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cut)):
                o = order[cut[p] : cut[p + 1]]
                body, _ = pieces(text, into[o], count[o] + LENGTH - 1)
                columns = (key[o], trigger[o], inside[o].astype(np.int64), count[o].astype(np.uint8), body)
                rows.append((int(p), False, *(pack.compress(c.tobytes()) for c in columns)))
            if rows:
                yield batch_of(rows)

        size = 0
        for batch in batches:
            use = np.flatnonzero(~np.asarray(batch.column("a").is_null()))
            if not len(use):
                continue
            batch = batch.take(pa.array(use))
            done, mixed, keys = batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("key").to_numpy()
            data, at = string_bytes(batch.column("text"))
            for i, j in blocks(at):
                text = data[at[i] : at[j]]
                row, first, count, trigger, phrase = phrases(text, at[i : j + 1] - at[i])
                trigger = trigger & LOW
                code = settled(trigger, np.maximum(phrase & np.uint64((1 << (8 * PHRASE_BYTES)) - 1), np.uint64(1)))
                cut = np.searchsorted(row, np.arange(j - i + 1))
                yes, ask = np.zeros(len(row), bool), np.zeros(len(row), bool)
                for k in range(j - i):
                    part = slice(cut[k], cut[k + 1])
                    if done[i + k]:
                        yes[part] = np.isin(code[part], np.frombuffer(done[i + k], np.uint64))
                    if mixed[i + k]:
                        ask[part] = np.isin(trigger[part], np.frombuffer(mixed[i + k], np.uint64))
                ask &= ~yes
                inside = first - (at[i : j + 1] - at[i])[row]
                sure.append((keys[i:j][row][yes], inside[yes], count[yes]))
                asked.append((keys[i:j][row][ask], trigger[ask], inside[ask], count[ask], pieces(text, first[ask], count[ask] + LENGTH - 1)[0]))
                size += len(asked[-1][4]) + 24 * len(sure[-1][0])
                if size >= TEXT_CHUNK:
                    yield from flush()
                    sure.clear(), asked.clear()
                    size = 0
        if asked:
            yield from flush()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.RecordBatch | None:
            key, start, count = merged(key, start, count)
            rows = list(dealt(key, parts, start, count, np.zeros(len(key), np.int64)))
            if rows:
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], names=["part", "keys", "a", "b", "more"])

        got: list[tuple] = []
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                if r["sure"]:
                    if (b := out(*(np.frombuffer(r[c], np.int64) for c in ("keys", "starts", "counts")))) is not None:
                        yield b
                else:
                    columns = (("keys", np.int64), ("triggers", np.uint64), ("starts", np.int64), ("counts", np.uint8), ("text", np.uint8))
                    key, trigger, start, count, text = (np.frombuffer(unpack.decompress(r[c]), t) for c, t in columns)
                    got.append((key, trigger, start, count.astype(np.int64), text))
        if not got:
            return
        key, trigger, start, count, text = (np.concatenate(c) for c in zip(*got, strict=True))
        got.clear()
        into = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
        order = np.argsort(trigger, kind="stable")
        head = heads(trigger[order])
        # whole groups of one trigger, up to about this many phrases at a time
        edges = [0]
        for h in np.append(head[1:], len(order)).tolist():
            if h - edges[-1] >= 20_000 or h == len(order):
                edges.append(h)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            o = order[a:b]
            body, at = pieces(text, into[o], count[o] + LENGTH - 1)
            each = np.repeat(np.arange(len(o)), count[o])
            step = np.arange(len(each)) - np.repeat(np.cumsum(count[o]) - count[o], count[o])
            yes = corpus_order(body, at[each] + step, key[o][each])
            if (found := out(key[o][each][yes], (start[o][each] + step)[yes], np.ones(int(yes.sum()), np.int64))) is not None:
                yield found

    sent = joined.mapInArrow(send, "part int, sure boolean, keys binary, triggers binary, starts binary, counts binary, text binary")
    return sent.repartitionById(parts, "part").mapInArrow(settle, "part int, keys binary, a binary, b binary, more binary")


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True, hot_rows: int = HOT) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256; with_text: also the removed spans (bytes) and the bytes kept."""
    parts = parts_of(docs)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = materialize(parse(rows, parts, hot_rows))
    hot, weight = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for r in found.filter("part IS NULL").select("a", "b").toLocalIterator():
        hot, weight = np.append(hot, np.frombuffer(r["a"], np.uint64)), np.append(weight, np.frombuffer(r["b"], np.int64))
        if len(hot) > 2 * MOST_HOT:
            top = np.argpartition(-weight, MOST_HOT)[:MOST_HOT]
            hot, weight = hot[top], weight[top]
    if len(hot) > MOST_HOT:  # the others are settled too, each in one task
        hot = hot[np.argpartition(-weight, MOST_HOT)[:MOST_HOT]]
    per_text = gathered(found.filter("part IS NOT NULL"), parts)
    # both joins are outer ones over the same rows, so that one shuffle of the texts serves both
    marks = gathered(compare(rows.join(per_text, "key", "left"), hot, parts), parts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            raw = data.tobytes()
            starts, counts = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            size, removed, spans, digest, kept, where = [], [], [], [], [], []
            for i in range(batch.num_rows):
                t = raw[at[i] : at[i + 1]]
                a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if starts[i]:
                    a = np.frombuffer(starts[i], np.int64)
                    b = a + np.frombuffer(counts[i], np.int64) + LENGTH - 1
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    gap = np.flatnonzero(a[1:] > b[:-1])
                    a, b = a[np.append(0, gap + 1)], b[np.append(gap, len(b) - 1)]
                keep = b"".join(t[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(t)], strict=True))
                size.append(len(t)), removed.append(int((b - a).sum())), spans.append(len(a)), digest.append(sha256(keep).hexdigest())
                if with_text:
                    kept.append(keep), where.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            out = {"key": batch.column("key"), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
            if with_text:
                out |= {"spans": pa.array(where, span), "kept": pa.array(kept, pa.binary())}
            yield pa.RecordBatch.from_pydict(out)

    kind = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", spans array<struct<start:long,end:long>>, kept binary" * with_text
    return rows.join(marks, "key", "left").mapInArrow(cut, kind).withColumnRenamed("key", key)
