"""Fingerprints of texts and vectors, and the near-hash join."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from itertools import combinations, pairwise
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.functions.scalar import bits_to_hex, halves, hamming
from lamina.sources.snapshots import few_rows, written


#: Whole texts that are sent to a Python worker at once, and tokens that it looks at together.
TEXTS, TOKENS = 500, 1 << 18
#: The four bits of the high and of the low half of each byte, 16 bits apart: so many tokens can be added up, four positions in a number.
_bits = np.array([[sum((b >> 7 - 4 * half - q & 1) << 16 * q for q in range(4)) for half in range(2)] for b in range(256)], "<u8")
MOST_ADDED = (1 << 16) - 1
#: ASCII white space, and what of it `\s` means in RE2 and in SQL of DuckDB: no vertical tab.
SPACE, RE2_SPACE = " \t\n\x0b\f\r", " \t\n\f\r"


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, space: str = SPACE, blank: str | None = "0" * 16) -> DataFrame:
    """(key, simhash, columns to keep): bit i is set if more tokens have it in the first half of their md5 than have not.

    Arrow lowers texts, each character by itself, and splits them at `space`; tokens stay in their row, so nothing is shuffled. Distinct tokens of a part of a batch are hashed
    once; their bits are then added up by position. A text without tokens has no bit set, or what `blank` says. The result is written: texts are read and hashed once, however often it is used.
    """
    keep = keep or []
    valid = F.make_valid_utf8(F.coalesce(F.col(text), F.lit("")))
    others = [c for c in SPACE if c not in space]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = pc.utf8_lower(batch.column("t"))
            if any(pc.any(pc.match_substring(column, c)).as_py() for c in others):
                column = pc.split_pattern_regex(column, f"[{space}]")
            else:
                column = pc.ascii_split_whitespace(column)  # an empty token stands before and behind white space at the ends
            parts = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = column.flatten()
            token = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
            at = np.concatenate([[0], np.cumsum(token)])[parts]
            flat = flat.filter(pa.array(token))
            sums = np.zeros((len(column), 64), np.int64)
            for a in range(0, int(at[-1]), TOKENS):
                coded = flat.slice(a, TOKENS).dictionary_encode()
                edge = np.frombuffer(coded.dictionary.buffers()[1], np.int32)[: len(coded.dictionary) + 1].tolist()
                data = coded.dictionary.buffers()[2].to_pybytes()
                raw = np.frombuffer(b"".join([md5(data[i:j]).digest()[:8] for i, j in pairwise(edge)]), np.uint8).reshape(-1, 8)
                bits = _bits[raw].reshape(-1, 16)[coded.indices.to_numpy()]
                begin = np.unique(np.concatenate([at[(at >= a) & (at < a + len(bits))], np.arange(a, a + len(bits), MOST_ADDED)]))
                np.add.at(sums, np.searchsorted(at, begin, "right") - 1, np.add.reduceat(bits, begin - a, axis=0).view("<u2"))
                del coded, data, raw, bits
            out = np.packbits(2 * sums > np.diff(at)[:, None], axis=1)
            hashes = pa.array([r.tobytes().hex() if n else blank for r, n in zip(out, np.diff(at).tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), hashes, batch.column("k")], names=["key", "simhash", "k"])
            # workers outlive the task, and hold what they do not give back
            del batch, column, flat, token, sums, out, hashes
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(key).alias("key"), valid.alias("t"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("k"))
    out = rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, simhash string, k {rows.schema['k'].dataType.simpleString()}")
    with few_rows(docs.sparkSession, TEXTS):
        return written(out.select(F.col("key").alias(key), "simhash", *[F.col(f"k.`{c}`").alias(c) for c in keep]))


def median_bits(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, phash) of vectors with 64 components: bit i is set if component i is above the median."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    middle = F.array_sort(v)
    mid = (F.get(middle, F.lit(31)) + F.get(middle, F.lit(32))) / 2
    row = vectors.select(key, v.alias("v"), mid.alias("m"))
    return row.select(key, bits_to_hex([F.when(F.get("v", F.lit(i)) > F.col("m"), 1).otherwise(0) for i in range(64)]).alias("phash"))


#: Keys of a hash that bands make, at most; candidates for each hash that are aimed at.
MOST_KEYS, AIM = 500, 32


def bands_for(most: int, left: int, right: int) -> tuple[int, int]:
    """(bands, of which a key takes) for that many distinct hashes: of most + k bands at least k are equal in hashes at most `most` bits apart.

    A key of k bands has 64 * k / (most + k) bits. k is the least, from 3 for small distances, for which chance makes no more than `AIM` candidates for each hash, or the greatest that makes `MOST_KEYS` keys at most.
    """
    least = 3 if most <= 4 else 2 if most <= 8 else 1  # hashes of like texts are not spread evenly
    best = least
    for k in range(least, 64 - most + 1):
        if comb(most + k, k) > MOST_KEYS:
            break
        best = k
        if left * right * comb(most + k, k) / 2 ** (64 * k // (most + k)) <= AIM * (left + right):
            break
    return most + best, best


def near_hashes(left: DataFrame, right: DataFrame, most: int, phash: str, itself: bool = False) -> DataFrame:
    """Pairs (ha, hb, dist) of distinct hashes with 0 < dist <= most.

    The 64 bits are cut into bands, of which two near hashes have some in common: each combination of bands is a key that few hashes share by chance.
    How many bands a key takes follows from the numbers of hashes, counted once. Hashes go as numbers, and a pair is told by the first combination
    that it shares only, so none has to be told from its repeats.
    """
    if not 0 < most < 64:
        raise ValueError("hashes have 64 bits: a distance from 1 to 63 is asked for")
    (high, low), legible = halves(F.col("h")), F.col("h").rlike("^[0-9a-fA-F]{16}$")
    number = lambda df: df.filter(legible).select(F.shiftleft(high, 32).bitwiseOR(low).alias("x"), F.when(F.col("h") != F.lower("h"), F.col("h")).alias("raw"))
    sides = [written(number(df.select(F.col(phash).alias("h")).distinct())) for df in ([left] if itself else [left, right])]
    sizes = [df.count() for df in sides]
    n, k = bands_for(most, sizes[0], sizes[-1])
    edge = [64 * i // n for i in range(n + 1)]
    signed = lambda v: F.lit(v - (1 << 64) if v >> 63 else v).cast("long")
    band = [((1 << edge[i + 1] - edge[i]) - 1) << 64 - edge[i + 1] for i in range(n)]
    keys = list(combinations(range(n), k))

    def banded(df: DataFrame, side: str) -> DataFrame:
        cut = F.array(*[F.struct(F.lit(j).alias("j"), F.col("x").bitwiseAND(signed(sum(band[i] for i in c))).alias("part")) for j, c in enumerate(keys)])
        rows = df.select(F.col("x").alias(f"x{side}"), F.col("raw").alias(f"raw{side}"), F.explode(cut).alias("key"))
        return rows.select(f"x{side}", f"raw{side}", "key.j", "key.part")

    differ = F.col("xa").bitwiseXOR(F.col("xb"))
    alike = F.lit(0).cast("long")
    for i in range(n):
        alike = alike.bitwiseOR(F.when(differ.bitwiseAND(signed(band[i])) == 0, signed(1 << i)).otherwise(signed(0)))
    # bands before the last of a combination that are not of it: if two hashes share one, an earlier combination has them
    before = F.get(F.array(*[signed(sum(1 << i for i in range(c[-1]) if i not in c)) for c in keys]), F.col("j"))
    text = lambda side: F.coalesce(f"raw{side}", F.lpad(F.lower(F.hex(f"x{side}")), 16, "0")).alias(f"h{side}")
    # one side would pass for small before its keys are exploded, and be sent whole through the driver
    met = banded(sides[0], "a").join(banded(sides[-1], "b").hint("merge"), ["j", "part"])
    met = met.filter(F.bit_count(differ).between(1, most) & (alike.bitwiseAND(before) == 0))
    pairs = met.select(text("a"), text("b"), F.bit_count(differ).alias("dist"))
    return pairs.filter("ha < hb") if itself else pairs


def near_pairs(left: DataFrame, right: DataFrame, most: int, key: str, phash: str, itself: bool = False) -> DataFrame:
    """Pairs (a, b, dist) of rows with 0 < dist <= most. Where many rows share a hash, `near_hashes` and its members say the same in fewer rows."""
    a, b = left.select(F.col(key).alias("a"), F.col(phash).alias("ha")), right.select(F.col(key).alias("b"), F.col(phash).alias("hb"))
    return near_hashes(left, right, most, phash, itself).join(a, "ha").join(b, "hb").select("a", "b", "dist")


def neighbours(files: DataFrame, others: DataFrame, most: int, key: str, phash: str) -> DataFrame:
    """(key, near, dist, rank): what is near each file, by distance, then by the key found; rank counts from 1."""
    pairs = near_pairs(files, others, most, key, phash).select(F.col("a").alias(key), F.col("b").alias("near"), "dist")
    return pairs.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy("dist", "near")))


def pair_type(a_digest: Column, b_digest: Column, a_phash: Column, b_phash: Column, most: int) -> Column:
    """What two files are to each other: exact (equal digests, not empty ones), perceptual (equal hashes), near (at most `most` bits apart) or none."""
    dist = hamming(a_phash, b_phash)
    return F.when((a_digest == b_digest) & (a_digest != ""), "exact").when(dist == 0, "perceptual").when(dist.between(1, most), "near").otherwise("none")
