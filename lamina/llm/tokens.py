"""Token ids in binary files, coded by a static range asymmetric numeral system (rANS).

Files hold frames, a file those of one shard that one task codes; a frame holds
whole documents in order and is coded in independent blocks. A block interleaves LANES coder states; all blocks share one
frequency table, which is counted over the whole corpus and written beside the
files. The directory of a frame has for each block its number of ids and words
and a crc32 of its ids, so that any block can be decoded alone, and blocks are
decoded together.

Steps: range-partition by key, tokenise and pack frames (a table in the shared
folder); count ids (at most one row for each id and task); code frames into
files under final names only when complete; read the files back.

Defined results: a null or empty text is only the end id; rows with equal keys
stay side by side, in the order of their text's hash; a null key comes first; an
empty table gives no files and an empty result; other columns are left out.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.shared import Tables, arrow_rows, blocks, frugal, give_back, materialize, put, shared_dir, store, string_bytes

#: Fixed by the contract: the id that ends a document.
END = 0
#: Ids of a frame (more if one document has more) and of a block, interleaved states of a block, bits of a probability.
FRAME, BLOCK, LANES, BITS = 1 << 20, 1 << 16, 64, 20
LOW = 1 << 31  # states stay in LOW … 2**63, and move 32 bits at a time
HEAD = struct.Struct("<4sHHIIIQQI")  # magic, version, lanes, block, crc of the table, documents, ids, ids before, blocks
MAGIC, VERSION = b"RNSF", 1
#: Stretches that a worker remembers (as many again until it renews them), and their longest; bytes of text that it looks at together.
#: Workers live on after a task, so what they remember stays small, and only what occurs twice in a block is worth it.
REMEMBER, LONGEST, TEXT_BLOCK = 1 << 17, 64, 2 << 20
#: Texts, and frames, that are sent to a Python worker at once.
TEXTS, FRAMES = 500, 1
#: A page of Parquet ends with the frame that fills it, else no page ends before its hundredth row: pages are compressed whole, outside the heap.
PAGES = {"parquet.page.size.row.check.min": "1"}


# --- tokenising

#: Classes of bytes: letter, digit, other sign, apostrophe, space, other white space, and bytes of which it takes more to tell.
LETTER, DIGIT, SIGN, QUOTE, SPACE, BREAK, OPEN = range(7)
_class = np.full(256, OPEN, np.uint8)
for _c in range(0x21, 0x7F):
    _class[_c] = LETTER if chr(_c).isalpha() else DIGIT if chr(_c).isdigit() else SIGN
_class[0x27], _class[0x20], _class[0x09:0x0E] = QUOTE, SPACE, BREAK
#: Whether a piece ends between two classes, whatever stands around them. An apostrophe can begin a contraction.
_ends = np.zeros((7, 7), bool)
_ends[:4, :6] = _ends[BREAK, :6] = True
np.fill_diagonal(_ends, False)
for _pair in ((SIGN, QUOTE), (QUOTE, SIGN), (QUOTE, LETTER), (QUOTE, DIGIT), (BREAK, SPACE)):
    _ends[_pair] = False
_ends = _ends.reshape(-1)
#: Bytes that begin a character which is surely no white space.
_solid = _class <= QUOTE
_solid[0xC3:0xE1] = _solid[0xE4:0xF5] = True
#: The character that byte-level tokens have for each byte; a line break parts words.
_shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SPELLED = "".join(" " if b == 0x0A else chr(b if b in _shown else 0x100 + sum(c not in _shown for c in range(b))) for b in range(256))
#: Words of a text that the library encodes at once.
WORDS = 1000


def classes(data: np.ndarray) -> np.ndarray:
    kind = _class[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF: letters but for two signs
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    return kind


def stretches(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Offsets at which a piece of the byte-level pattern surely ends: all of `at`, and what single bytes and their neighbours tell.

    Runs of letters, digits and signs are pieces of their own, with a space that
    stands before them; the last of several spaces before another character stands
    alone, or goes with it.
    """
    kind = classes(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = _ends[kind[:-1] * np.uint8(7) + kind[1:]]
    spaced = ((kind[:-1] == SPACE) | (kind[:-1] == BREAK)) & _solid[data[1:]]
    last = at[1:] - 1
    spaced[last[(last >= 0) & (last < len(spaced))]] = False  # what follows is another text
    cut[: max(0, len(data) - 1)] |= spaced
    cut[at] = True
    return np.flatnonzero(cut)


def words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which stretches are one piece: letters, digits or signs only, and maybe a space before them."""
    kind = classes(data)
    other = np.concatenate([[0], np.cumsum(kind > SIGN)])
    return other[at[1:]] == other[at[:-1]] + ((kind[at[:-1]] == SPACE) & (np.diff(at) > 1))


class Pieces:
    """Encodes texts with the tokenizers library, calling it once for each distinct stretch (see `stretches`).

    The pattern splits a text before anything is merged, so the ids of stretches
    that end where pieces end are those of the text. Stretches that are one piece
    go to the library's model past its pattern. Texts with something that the
    library treats as a special token are encoded whole, and so are all texts
    where the tokenizer is not of this kind.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.by_word = Tokenizer(self.library.model)  # the same model; its pieces are parted by spaces
        self.by_word.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        parts = json.loads(self.library.to_str())
        before, model = parts["pre_tokenizer"] or {}, parts["model"]
        self.splits = parts["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.splits = self.splits and model.get("type") == "BPE" and not model.get("dropout")
        self.special = [t["content"] for t in parts["added_tokens"]]
        vocabulary = self.library.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # each character of a byte-level token is one byte
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.known = self.ids = pa.array([], pa.binary())  # stretches, their ids, and whether they were met since they were renewed
        self.met = np.zeros(0, bool)

    def ask(self, stretches: list[bytes], together: bool = False) -> list[bytes]:
        """Ids of each stretch; together: those before which a piece ends in any case are encoded as one text, and told apart by the bytes of their ids."""
        out: list[bytes | None] = [None] * len(stretches)
        if together:
            solid = _solid.tolist()
            at = [i for i, s in enumerate(stretches) if 1 < len(s) <= LONGEST and s[0] == 0x20 and solid[s[1]]]
            groups = [at[k : k + 1000] for k in range(0, len(at), 1000)]
            texts = [b"".join([stretches[i] for i in g]).decode(errors="replace") for g in groups]
            for group, e in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else [], strict=True):
                ids = np.array(e.ids, self.kind)
                ends, reached = np.cumsum([len(stretches[i]) for i in group]), np.cumsum(self.bytes_of[ids])
                last = np.searchsorted(reached, ends)
                if last[-1] == len(ids) - 1 and (reached[last] == ends).all():
                    raw, edge = ids.tobytes(), [0, *((last + 1) * self.kind.itemsize).tolist()]
                    for i, a, b in zip(group, edge[:-1], edge[1:], strict=True):
                        out[i] = raw[a:b]
        alone = [i for i, ids in enumerate(out) if ids is None]
        got = self.library.encode_batch_fast([stretches[i].decode(errors="replace") for i in alone], add_special_tokens=False) if alone else []
        for i, e in zip(alone, got, strict=True):
            out[i] = array(self.code, e.ids).tobytes()
        return out

    def spell(self, pieces: pa.Array) -> pa.Array | None:
        """Ids of stretches that are one piece each (see `words`), as bytes; none where they cannot be told apart by the bytes of their ids."""
        _, at = string_bytes(pieces)
        edge = pa.array([*range(0, len(pieces), WORDS), len(pieces)], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(edge, pieces), b"\n").to_pylist()
        got = self.by_word.encode_batch_fast([t.decode("latin-1").translate(SPELLED) for t in texts], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.kind) for e in got])
        reached = np.cumsum(self.bytes_of[ids])
        last = np.searchsorted(reached, at[1:])
        if last[-1] != len(ids) - 1 or (reached[last] != at[1:]).any():
            return None
        edge = np.append(0, (last + 1) * self.kind.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(pieces), [None, pa.py_buffer(edge), pa.py_buffer(ids.tobytes())])

    def look(self, distinct: pa.Array, often: np.ndarray, together: bool) -> tuple[pa.Array, np.ndarray]:
        """Ids, as bytes, and where among them those of each distinct stretch are; frequent stretches are remembered while they are used."""
        where = pc.fill_null(pc.index_in(distinct, value_set=self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(where < 0)
        self.met[where[where >= 0]] = True
        parts, asked = [self.ids], distinct.take(pa.array(new))
        data, at = string_bytes(asked)
        one = words(data, at) if together and len(new) else np.zeros(len(new), bool)
        if one.any():
            spelled = self.spell(asked.filter(pa.array(one)))
            if spelled is None:
                one[:] = False
            else:
                parts.append(spelled)
        order = np.concatenate([np.flatnonzero(one), np.flatnonzero(~one)])
        where[new[order]] = len(self.ids) + np.arange(len(new))
        parts.append(pa.array(self.ask(asked.filter(pa.array(~one)).to_pylist(), together), pa.binary()))
        ids = pa.concat_arrays(parts)
        worth = pa.array(new[often[new] & (np.diff(at) <= LONGEST)])
        if len(worth):
            self.known = pa.concat_arrays([self.known, distinct.take(worth)])
            self.ids = pa.concat_arrays([self.ids, ids.take(pa.array(where[worth.to_numpy()]))])
            self.met = np.append(self.met, np.ones(len(worth), bool))
        if len(self.known) > 2 * REMEMBER:
            self.renew()
        return ids, where

    def renew(self) -> None:
        """Forgets stretches that were not met since the last time."""
        live = pa.array(np.flatnonzero(self.met))
        self.known, self.ids, self.met = self.known.take(live), self.ids.take(live), np.zeros(len(live), bool)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (as offsets)."""
        data, at = string_bytes(texts)
        together = True
        if self.splits and len(data):
            edge = stretches(data, at)
            for token in self.special:
                whole = np.flatnonzero(pc.match_substring(pc.fill_null(texts, ""), token).to_numpy(zero_copy_only=False))
                together &= not len(whole)
                for i in whole.tolist():
                    edge = np.concatenate([edge[: np.searchsorted(edge, at[i], "right")], edge[np.searchsorted(edge, at[i + 1]) :]])
        else:
            edge = np.unique(at)
        cut = pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        distinct, index = cut.dictionary, cut.indices.to_numpy()
        if self.splits:
            got, where = self.look(distinct, np.bincount(index, minlength=len(distinct)) > 1, together)
            index = where[index]
        else:
            got = pa.array(self.ask(distinct.to_pylist()), pa.binary())
        ids = got.take(pa.array(index))
        begins = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        raw = ids.buffers()[2]
        flat = np.frombuffer(raw, self.kind, int(begins[-1]) // self.kind.itemsize) if raw is not None and len(edge) > 1 else np.zeros(0, self.kind)
        return flat, begins[np.searchsorted(edge, at)].astype(np.int64) // self.kind.itemsize


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def forget() -> None:
    """Drops the tokenizer of a worker and what it remembers: workers outlive the encoding, beside all that comes later."""
    if pieces.cache_info().currsize:
        pieces.cache_clear()
        gc.collect()
        give_back()


# --- coding


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**BITS, at least 1 for each id that occurs."""
    at = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(at):
        return out
    if len(at) > 1 << BITS:
        raise ValueError("more ids than the table has places")
    out[at] = np.maximum(1, counts[at] * ((1 << BITS) / counts.sum())).astype(np.int64)
    excess = int(out.sum()) - (1 << BITS)
    order = at[np.argsort(-out[at], kind="stable")]
    if excess <= 0:
        out[order[0]] -= excess
    while excess > 0:
        step = np.minimum(out[order] - 1, np.maximum(1, out[order] * excess // out.sum()))
        step = np.where(np.cumsum(step) <= excess, step, 0)
        if not step.any():
            step[0] = min(excess, int(out[order[0]]) - 1)
        out[order] -= step
        excess -= int(step.sum())
    return out


class Table:
    """Frequencies, their running sum, and the id of each place."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.raw = freq.astype("<u4").tobytes()
        self.crc = zlib.crc32(self.raw)

    @functools.cached_property
    def place(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def encode_blocks(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids (blocks, steps, lanes) to states (blocks, lanes), words per block, and all words."""
    b, steps, lanes = ids.shape
    flat = ids.transpose(1, 0, 2).reshape(steps, b * lanes)
    x = np.full(b * lanes, LOW, np.uint64)
    words, used = np.zeros((steps, b * lanes), np.uint32), np.zeros((steps, b * lanes), bool)
    limit = np.uint64((LOW >> BITS) << 32)
    for t in range(steps - 1, -1, -1):
        s = flat[t]
        f = table.freq[s]
        over = x >= limit * f
        used[t], words[t] = over, x.astype(np.uint32)
        x = np.where(over, x >> np.uint64(32), x)
        q = x // f
        x = (q << np.uint64(BITS)) + (x - q * f) + table.start[s]
    by_block = lambda a: a.reshape(steps, b, lanes).transpose(1, 0, 2)
    mask = by_block(used)
    return x.reshape(b, lanes), mask.sum((1, 2)), by_block(words)[mask]


def decode_blocks(states: np.ndarray, lengths: np.ndarray, words: np.ndarray, steps: int, table: Table) -> np.ndarray:
    b, lanes = states.shape
    x, out = states.copy(), np.empty((steps, b, lanes), np.uint32)
    at = np.cumsum(lengths) - lengths
    words = np.append(words, np.uint32(0)).astype(np.uint64)
    low = np.uint64((1 << BITS) - 1)
    for t in range(steps):
        slot = x & low
        s = table.place[slot]
        out[t] = s
        x = table.freq[s] * (x >> np.uint64(BITS)) + slot - table.start[s]
        need = x < np.uint64(LOW)
        rank = np.cumsum(need, axis=1)
        got = words[np.minimum(at[:, None] + rank - 1, len(words) - 1)]
        x = np.where(need, (x << np.uint64(32)) | got, x)
        at = at + rank[:, -1]
    return out.transpose(1, 0, 2)


def encode_frame(keys: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray, before: int, table: Table) -> bytes:
    sizes = [BLOCK] * (len(ids) // BLOCK) + [len(ids) % BLOCK] * bool(len(ids) % BLOCK)
    states, lengths, words, full = [], [], [], len(ids) // BLOCK
    for part in (ids[: full * BLOCK].reshape(full, BLOCK // LANES, LANES), ids[full * BLOCK :]):
        if not part.size:
            continue
        if part.ndim == 1:  # the last block is filled up with its first id
            part = np.append(part, np.full(-len(part) % LANES, part[0], part.dtype)).reshape(1, -1, LANES)
        x, n, w = encode_blocks(part, table)
        states.append(x.astype("<u8").tobytes()), lengths.extend(n.tolist()), words.append(w.astype("<u4").tobytes())
    crcs = [zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) for i in range(len(sizes))]
    head = HEAD.pack(MAGIC, VERSION, LANES, BLOCK, table.crc, len(keys), len(ids), before, len(sizes))
    head += keys.astype("<i8").tobytes() + known.astype("u1").tobytes() + counts.astype("<u4").tobytes()
    head += np.array([sizes, lengths, crcs], "<u4").tobytes()
    body = b"".join(states) + b"".join(words)
    return struct.pack("<II", len(head), len(body)) + head + struct.pack("<I", zlib.crc32(head)) + body


def read_frames(read, table: Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(keys, known, counts, ids, ids before) of each frame; raises ValueError on any damage."""

    def exactly(n: int) -> bytes:
        parts = []
        while n:
            got = read(n)
            if not got:
                raise ValueError("the file ends within a frame")
            parts.append(got)
            n -= len(got)
        return b"".join(parts)

    while first := read(1):
        size, body = struct.unpack("<II", first + exactly(7))
        head = exactly(size)
        if struct.unpack("<I", exactly(4))[0] != zlib.crc32(head):
            raise ValueError("the directory is damaged")
        magic, version, lanes, block, crc, docs, n, before, blocks = HEAD.unpack_from(head)
        if magic != MAGIC or version != VERSION or crc != table.crc:
            raise ValueError("not a frame of this version and table")
        at = HEAD.size
        keys = np.frombuffer(head, "<i8", docs, at)
        known = np.frombuffer(head, "u1", docs, at + 8 * docs).astype(bool)
        counts = np.frombuffer(head, "<u4", docs, at + 9 * docs)
        sizes, lengths, crcs = np.frombuffer(head, "<u4", 3 * blocks, at + 13 * docs).reshape(3, blocks)
        raw = exactly(body)
        states = np.frombuffer(raw, "<u8", blocks * lanes).reshape(blocks, lanes)
        words = np.frombuffer(raw, "<u4", offset=8 * blocks * lanes)
        full, ids = n // block, []
        lengths = lengths.astype(np.int64)
        cut = int(lengths[:full].sum())
        if full:
            ids.append(decode_blocks(states[:full], lengths[:full], words[:cut], block // lanes, table).reshape(-1))
        if full < blocks:
            ids.append(decode_blocks(states[full:], lengths[full:], words[cut:], -(-int(sizes[full]) // lanes), table).reshape(-1)[: sizes[full]])
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        for i in range(blocks):
            if zlib.crc32(ids[i * block : i * block + int(sizes[i])].astype("<u4").tobytes()) != crcs[i]:
                raise ValueError(f"block {i} is damaged")
        yield keys, known, counts, ids, before


# --- the operator


def pack(docs: DataFrame, tokenizer: str, key: str, text: str, frame: int = FRAME) -> DataFrame:
    """Frames of ids, not yet coded: shard and frame number, ids before it in its shard, keys, counts, ids."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("text"))
    names = ["shard", "frame", "before", "n", "keys", "known", "counts", "ids"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard = pieces(tokenizer), TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, ...]] = []
        before = size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, before, size, number
            keys, known, counts, ids = (np.concatenate(c) for c in zip(*held, strict=True))
            row = [shard, number, before, size, keys.astype("<i8").tobytes(), known.astype("u1").tobytes(), counts.astype("<u4").tobytes(), ids.tobytes()]
            before, number, size, held = before + size, number + 1, 0, []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            _, at = string_bytes(batch.column("text"))
            known = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            keys = batch.column("key").fill_null(0).to_numpy()
            for i, j in blocks(at, TEXT_BLOCK):
                ids, begins = tool.encode(batch.column("text").slice(i, j - i))
                counts = np.diff(begins) + 1
                edge = np.concatenate([[0], np.cumsum(counts)])
                full, own = np.full(edge[-1], END, tool.kind), np.ones(edge[-1], bool)
                own[edge[1:] - 1] = False
                full[own] = ids
                a = 0
                while a < j - i:  # a frame ends with the document that fills it
                    b = min(j - i, int(np.searchsorted(edge, edge[a] + frame - size)))
                    held.append((keys[i + a : i + b], known[i + a : i + b], counts[a:b], full[edge[a] : edge[b]]))
                    size += int(edge[b] - edge[a])
                    a = b
                    if size >= frame:
                        yield flush()
            give_back()
        if held:
            yield flush()
        if len(tool.known) > REMEMBER:
            tool.renew()

    return rows.mapInArrow(frugal(run), "shard int, frame int, before long, n long, keys binary, known binary, counts binary, ids binary")


def write(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", folder: str | None = None, frame: int = FRAME) -> tuple[list[str], str]:
    """Writes coded files and the frequency table; returns their paths."""
    from tokenizers import Tokenizer

    folder = folder or shared_dir(docs.sparkSession)
    n_ids = max(Tokenizer.from_file(tokenizer).get_vocab_size(), END + 1)
    kind = np.dtype("<u2" if n_ids <= 1 << 16 else "<u4")
    spark = docs.sparkSession
    with Tables(), arrow_rows(spark, TEXTS):
        frames = materialize(pack(docs, tokenizer, key, text, frame), **PAGES)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            total = np.zeros(n_ids, np.int64)
            for batch in batches:
                for raw in batch.column("ids"):
                    total += np.bincount(np.frombuffer(raw.as_buffer(), kind), minlength=n_ids)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"id": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

        with arrow_rows(spark, FRAMES, read=True):
            got = frames.select("ids").mapInArrow(frugal(count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # one row for each id
        counts = np.zeros(n_ids, np.int64)
        counts[got["id"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
        table = Table(quantise(counts))
        put(f"{folder}/table.freq", iter([table.raw]))
        base, total = {}, 0
        for r in frames.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect():  # one row for each shard
            base[r["shard"]], total = total, total + r["n"]
        held = spark.sparkContext.broadcast((table.raw, base))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            raw, base = held.value
            table = Table(np.frombuffer(raw, "<u4"))

            def coded(rows: Iterator[dict]) -> Iterator[bytes]:
                for r in rows:
                    ids = np.frombuffer(r["ids"], kind).astype(np.int64)
                    parts = np.frombuffer(r["keys"], "<i8"), np.frombuffer(r["known"], "u1"), np.frombuffer(r["counts"], "<u4")
                    yield encode_frame(*parts, ids, base[r["shard"]] + r["before"], table)

            rows = (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))
            for shard, run in itertools.groupby(rows, lambda r: r["shard"]):  # the frames of a shard that this task reads, in order
                first = next(run)
                path = f"{folder}/{shard:06d}-{first['frame']:06d}.rans"
                size = put(path, coded(itertools.chain([first], run)))
                yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size]})

        with arrow_rows(spark, FRAMES, read=True):
            made = frames.mapInArrow(frugal(code), "path string, bytes long").collect()  # one short row for each file
        return sorted(r["path"] for r in made), f"{folder}/table.freq"


def read(spark: SparkSession, paths: list[str], table_path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of each document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        fs, at = store(table_path)
        with fs.open_input_stream(at) as f:
            table = Table(np.frombuffer(f.read(), "<u4"))
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, at = store(path)
                with fs.open_input_stream(at, compression=None) as f:
                    for keys, known, counts, ids, before in read_frames(f.read, table):
                        edge = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                        raw = memoryview(ids.astype("<u4")).cast("B")
                        out = {
                            "doc_id": pa.array(keys, pa.int64(), mask=~known),
                            "start": pa.array(edge[:-1] + before, pa.int64()),
                            "n_tokens": pa.array(counts, pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.int64()),
                        }
                        if with_ids:
                            out["ids"] = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int64()).cast(pa.int32()))
                        yield pa.RecordBatch.from_pydict(out)

    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    if not paths:
        return spark.createDataFrame([], kind)
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths))
    return files.mapInArrow(frugal(run), kind)


def round_trip(docs: DataFrame, tokenizer: str, with_ids: bool = True, **options) -> DataFrame:
    """Writes the files now and returns their documents, read back when asked for."""
    return read(docs.sparkSession, *write(docs, tokenizer, **options), with_ids=with_ids)
