"""N-gram Jaccard join of whole texts, as classes of linked documents.

1. Each text becomes its set of hashed 4-word shingles. Of the set, a row keeps
   its size, a hash of all of it (equal sets are one class from here on), the
   prefix that any partner must share (the smallest n - ceil(t n) + 1 hashes) and
   a bitmap signature: each hash flips one of 512 bits, so bits in which two
   signatures differ are never more than elements in which the sets differ.
2. Prefix hashes that two classes share make tiles. Hashes that very many classes
   share are put last in the order of all hashes, so they are in a prefix only where
   little else is. Tiles are found from packed
   arrays: a task sends each hash once, so a hash in a third of all rows costs one
   entry for each task.
3. Tiles are banded by set size. First every class meets the smallest class of
   its tile; links found so contract a large group of near copies to one
   component in work linear in its members. Then members of different components
   in neighbouring bands of a tile meet. In both steps sizes and signature bits
   bound the overlap from above, and only pairs within the bound are intersected
   exactly, as sorted arrays.
4. Components by star contraction.

Pairs inside a component that is already linked are not made, since they cannot
change the result; no others are left out.

Defined results: a null or empty text has size 0 and is its own component;
equal texts are linked; repeated keys share a result; ties do not matter; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.graph import components
from lamina.llm.shared import Tables, arrow_rows, blocks, frugal, lower_ascii, materialize, mix, shingle_hashes, string_bytes, word_bounds, word_hashes

#: Fixed by the contract: words of a shingle, and the similarity in percent.
WORDS, PERCENT = 4, 85
#: Classes that share a prefix hash from which it counts as frequent; most of those; how far beyond prefixes they are looked for.
FREQUENT, MOST_FREQUENT, WIDE = 200, 100_000, 2
#: Members of one band outside a tile's largest component from which it counts as large, and members of a cell of such a tile.
LARGE, CELL = 256, 2048
#: Hashes that a task gathers before it sends them, and compares at a time.
CHUNK = 1 << 19
#: Hashes of a partition at most, on average; a session's shuffle partitions are raised to this.
PARTITION = 1 << 23
#: Texts that are sent to a Python worker at once.
TEXTS = 1000
#: 64-bit words of a signature.
SIGNATURE = 8
#: Bits of the filter that keeps texts which nothing asks for out of a shuffle; when it is full, all texts pass.
FILTER_BITS = 1 << 23
SIGNS = [f"s{i}" for i in range(SIGNATURE)]


def shingle_sets(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = lower_ascii(data)
    start, end, per = word_bounds(data, at)
    h, row = shingle_hashes(word_hashes(data, start, end), per, words)
    if len(row) and (np.diff(row) < 0).any():
        order = np.argsort(row, kind="stable")
        h, row = h[order], row[order]
    cut = np.searchsorted(row, np.arange(len(at)))
    return [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def signature(grams: np.ndarray) -> np.ndarray:
    bits = np.bincount((mix(grams) >> np.uint64(64 - 9)).astype(np.int64), minlength=64 * SIGNATURE) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def band(n: Column, percent: int = PERCENT) -> Column:
    """Sizes that can be linked are in the same band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")


def sized(n: Column, m: Column, percent: int = PERCENT) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def bounded(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT, share: int = 1) -> DataFrame:
    """Pairs (a, b) whose sizes, prefixes and signatures leave a link possible; c: the prefix hashes they share.

    A link needs overlap >= percent / (100 + percent) * (n + m). Common elements
    that are not in both prefixes stand behind the end of one prefix, so overlap
    <= c + what is behind; and overlap <= (n + m - apart) / 2. With share > 1 that
    part of the c needed is enough, for pairs of which c has not all.
    """
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"{x}n"), *[F.col(s).alias(f"{x}{s}") for s in SIGNS])
    if "most" in pairs.columns:  # sizes are known: what the prefixes rule out needs no join
        pairs = pairs.filter((100 + percent) * (share * F.col("c") + F.floor((percent * F.col("most") + 99) / 100) - 1) >= percent * F.col("sum"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = sum((F.bit_count(F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}"))) for s in SIGNS), F.lit(0))
    total, larger = F.col("an") + F.col("bn"), F.greatest("an", "bn")
    behind = F.floor((percent * larger + 99) / 100) - 1
    fits = sized(F.col("an"), F.col("bn"), percent) & ((100 + percent) * (share * F.col("c") + behind) >= percent * total)
    return rows.filter(fits & ((100 + percent) * (total - apart) >= 2 * percent * total)).select("a", "b")


def sketch(docs: DataFrame, key: str, text: str, percent: int, words: int, last: np.ndarray | None = None) -> DataFrame:
    """Size, hash, signature and the leading hashes (WIDE times the prefix) of each set; hashes in `last` (sorted) come last."""
    held = docs.sparkSession.sparkContext.broadcast(last) if last is not None and len(last) else None  # MOST_FREQUENT numbers at most

    def leading(grams: np.ndarray) -> bytes:
        if held is not None:
            late = held.value[np.minimum(np.searchsorted(held.value, grams), len(held.value) - 1)] == grams
            grams = np.concatenate([grams[~late], grams[late]])
        return grams[: WIDE * prefix_size(len(grams), percent)].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = string_bytes(batch.column("text"))
            for i, j in blocks(at):
                sizes, hashes, prefixes, signs = [], [], [], []
                for grams in shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], words):
                    sizes.append(len(grams))
                    hashes.append(int(mix(grams + np.uint64(len(grams))).sum(dtype=np.uint64).view(np.int64)) if len(grams) else None)
                    prefixes.append(leading(grams) if len(grams) else None)
                    signs.append(signature(grams))
                signs = np.array(signs, np.int64).reshape(-1, SIGNATURE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(hashes, pa.int64()), pa.array(prefixes, pa.binary()), *(pa.array(signs[:, k]) for k in range(SIGNATURE))],
                    names=["key", "n", "hash", "prefix", *SIGNS],
                )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return materialize(rows.mapInArrow(frugal(run), "key long, n long, hash long, prefix binary, " + ", ".join(f"{s} long" for s in SIGNS)))


def shared_prefixes(sketches: DataFrame, percent: int, wide: bool = False, chunk: int = CHUNK) -> DataFrame:
    """(gram, hash) of all prefix hashes (wide: of all that the sketch holds) that two or more classes have."""
    # wide ones are only counted, to choose an order of hashes, and any order is exact: half of an owner's bits tell them apart
    kind = np.dtype("<u4" if wide else "<i8")
    parts = int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sketches.agg(F.sum(F.octet_length("prefix") / 8 / (1 if wide else WIDE))).first()[0] or 0
    parts = max(parts, int(total // PARTITION))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, owners, held, turn = [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal turn
            g, o = np.concatenate(grams), np.concatenate(owners)
            grams.clear(), owners.clear()
            order = np.lexsort((o, g))
            g, o = g[order], o[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
            g, o = g[new], o[new]
            head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            count = np.diff(np.append(head, len(g)))
            many = np.repeat(count > 1, count)
            # hashes that are shared within this task are known to be; others have to be told only that
            turn += 1
            rows = [(turn % parts, True, g[many].tobytes(), o[many].astype(kind).tobytes(), b"")]
            k, owner, flag = g[head], np.where(count > 1, 0, o[head]), count > 1
            part = (k % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            k, owner, flag = k[order], owner[order], flag[order]
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            rows += [(p, False, k[a:b].tobytes(), owner[a:b].astype(kind).tobytes(), flag[a:b].tobytes()) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.bool_()), *(pa.array(c, pa.binary()) for c in cols[2:])], names=["part", "sure", "grams", "owners", "many"])

        for batch in batches:
            for p, h, n in zip(batch.column("prefix").to_pylist(), batch.column("hash").to_pylist(), batch.column("n").to_pylist(), strict=True):
                grams.append(np.frombuffer(p, np.uint64)[: None if wide else prefix_size(n, percent)])
                owners.append(np.full(len(grams[-1]), h, np.int64))
                held += len(grams[-1])
                if held >= chunk:
                    yield from flush()
                    held = 0
        if held:
            yield from flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda g, o: pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(o)], names=["gram", "hash"])
        grams, owners, many = [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                g, o = np.frombuffer(r["grams"], np.uint64), np.frombuffer(r["owners"], kind).astype(np.int64)
                if r["sure"]:
                    yield out(g, o)
                else:
                    grams.append(g), owners.append(o), many.append(np.frombuffer(r["many"], bool))
        if not grams:
            return
        g, o, m = np.concatenate(grams), np.concatenate(owners), np.concatenate(many)
        grams.clear(), owners.clear(), many.clear()
        # equal hashes share their low bits, so the partition is compared in ranges of those
        slices = 1 << max(0, (len(g) // CHUNK).bit_length())
        home = (mix(g) & np.uint64(slices - 1)).astype(np.uint16 if slices <= 1 << 16 else np.uint32)
        for k in range(slices):
            at = np.flatnonzero(home == k) if slices > 1 else slice(None)
            x, y, z = g[at], o[at], m[at]
            if not len(x):
                continue
            order = np.lexsort((y, x))
            x, y, z = x[order], y[order], z[order]
            head = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            count = np.diff(np.append(head, len(x)))
            shared = np.logical_or.reduceat(z, head) | (np.minimum.reduceat(y, head) != np.maximum.reduceat(y, head))
            keep = np.repeat(shared, count) & ~z
            keep[1:] &= (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | z[:-1]
            yield out(x[keep], y[keep])

    rows = sketches.filter("n > 0").select("prefix", "hash", "n").mapInArrow(frugal(send), "part int, sure boolean, grams binary, owners binary, many binary")
    return rows.repartitionById(parts, "part").mapInArrow(frugal(match), "gram long, hash long")


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int, words: int) -> DataFrame:
    """Pairs (a, b) of keys whose sets really are that similar."""
    spark = pairs.sparkSession
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    bits = asked.select(spot(F.col("key")).alias("at")).groupBy(F.floor(F.col("at") / 32).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits"))
    got = bits.toPandas()  # FILTER_BITS / 32 rows at most
    field = np.zeros(FILTER_BITS // 32, np.uint32)
    field[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint32)
    held = spark.sparkContext.broadcast(np.unpackbits(field.view(np.uint8), bitorder="little").view(bool))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(held.value[batch.column("at").to_numpy()]))
            data, at = string_bytes(batch.column("text"))
            for i, j in blocks(at):
                out = [g.tobytes() for g in shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], words)]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), pa.array(out, pa.binary())], names=["key", "grams"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).filter("key IS NOT NULL")
    rows = rows.withColumn("at", spot(F.col("key"))).mapInArrow(frugal(sets), "key long, grams binary")
    # of the texts that the filter lets through few are not asked for, unless it is well filled: else a join would shuffle all sets
    found = materialize(rows if int(np.bitwise_count(field).sum()) <= FILTER_BITS // 8 else rows.join(asked, "key", "left_semi"))

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) else 0
                keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(found.select(F.col("key").alias("a"), F.col("grams").alias("x")), "a").join(found.select(F.col("key").alias("b"), F.col("grams").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(frugal(intersect), "a long, b long")


def deal(banded: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of tiles that hold more than one component, with the largest as main: of tiles that are not crowded, and of those that are."""
    named = banded.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    by_comp = materialize(named.groupBy("gram", "comp").agg(F.count("*").alias("c")))
    largest = by_comp.groupBy("gram").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("members"), (F.sum("c") - F.max("c")).alias("others"), F.count("*").alias("k"))
    largest = largest.filter("k > 1").select("gram", "main", "members", "others")
    named = materialize(named.join(largest, "gram"))
    crowd = named.filter((F.col("others") >= LARGE) & (F.col("comp") != F.col("main"))).groupBy("gram", "band").agg(F.count("*").alias("c"))
    crowd = materialize(crowd.filter(F.col("c") >= LARGE).select("gram").distinct())
    return named.join(crowd, "gram", "left_anti"), named.join(crowd, "gram", "left_semi")


def meet_in_cells(named: DataFrame, classes: DataFrame, percent: int, large_cell: int, hubs: bool = False) -> DataFrame:
    """Pairs (a, b) of members of different components in one tile whose sizes and signatures leave a link possible.

    A tile's members are dealt to cells of about `large_cell`, and each pair of
    cells in the same or in neighbouring bands is a row, dealt by its first cell,
    so that no task holds a whole tile. With hubs, each member gives one pair for
    two cells, with the member that the most of its cell may be linked to.
    """
    cells = named.join(classes.select("id", *SIGNS), "id").withColumn("parts", F.ceil(F.col("members") / large_cell).cast("int"))
    cells = cells.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).groupBy("gram", "band", "part")
    members = F.collect_list(F.struct("id", "n", "comp", *SIGNS)).alias("cell")  # about large_cell of them
    cells = materialize(cells.agg(F.first("parts").alias("parts"), F.min("comp").alias("low"), F.max("comp").alias("high"), members))
    same = F.expr("transform(sequence(0, part), p -> struct(band AS band, p AS part))")
    lower = F.expr("transform(sequence(0, parts - 1), p -> struct(band - 1 AS band, p AS part))")
    y = cells.select("gram", "low", "high", "cell", F.explode(F.concat(same, lower)).alias("at")).alias("y")
    rule = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.band") == F.col("y.at.band")) & (F.col("x.part") == F.col("y.at.part"))
    rule &= (F.least("x.low", "y.low") != F.greatest("x.high", "y.high"))  # else all members are one component

    def fields(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        flat = column.flatten()
        at = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
        number = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
        return at, [number(c).astype(np.int64) for c in ("id", "n", "comp")], np.stack([number(s) for s in SIGNS]).view(np.uint64)  # bits of negative numbers would be those of their absolute value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (xat, xs, xsign), (yat, ys, ysign) = fields(batch.column("x")), fields(batch.column("y"))
            for k in range(len(batch)):
                (xid, xn, xcomp), (yid, yn, ycomp) = ([v[at[k] : at[k + 1]] for v in vs] for at, vs in ((xat, xs), (yat, ys)))
                fits = np.empty((len(xid), len(yid)), bool)
                for i in range(0, len(xid), 256):
                    cut = slice(i, i + 256)
                    apart = np.zeros((len(xid[cut]), len(yid)), np.int64)
                    for s in range(SIGNATURE):
                        apart += np.bitwise_count(xsign[s, xat[k] : xat[k + 1]][cut, None] ^ ysign[None, s, yat[k] : yat[k + 1]])
                    n = xn[cut, None]
                    fits[cut] = (xcomp[cut, None] != ycomp) & (100 * np.minimum(n, yn) >= percent * np.maximum(n, yn))
                    fits[cut] &= (100 + percent) * (n + yn - apart) >= 2 * percent * (n + yn)
                if hubs:
                    x, y = np.flatnonzero(fits.any(axis=1)), np.flatnonzero(fits.any(axis=0))
                    to_y, to_x = (fits[x] * fits.sum(axis=0, dtype=np.int32)).argmax(axis=1), (fits[:, y] * fits.sum(axis=1, dtype=np.int32)[:, None]).argmax(axis=0)
                    r, c = np.concatenate([x, to_x]), np.concatenate([to_y, y])
                else:
                    r, c = np.nonzero(fits)
                a, b = xid[r], yid[c]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return cells.alias("x").join(y, rule).select(F.col("x.cell").alias("x"), F.col("y.cell").alias("y")).mapInArrow(frugal(run), "a long, b long").distinct()


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """key, n_shingles and component_id of every row."""
    with Tables() as tables, arrow_rows(docs.sparkSession, TEXTS):
        sketches, ids = classes_of(docs, key, text, percent, words, tables)
        tables.keep(sketches), tables.keep(ids)
    out = sketches.select("key", "n", "hash").join(ids, ["hash", "n"], "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))


def classes_of(docs: DataFrame, key: str, text: str, percent: int, words: int, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The sketches, and (hash, n, component_id) of every class of equal sets."""
    sketches = sketch(docs, key, text, percent, words)
    # any order of hashes gives the same links; with frequent ones last, a common line makes no large tile
    often = shared_prefixes(sketches, percent, wide=True).groupBy("gram").agg(F.count("*").alias("c")).filter(F.col("c") >= FREQUENT)
    often = often.orderBy(F.desc("c"), "gram").limit(MOST_FREQUENT).select("gram").toPandas()["gram"].to_numpy(np.int64)
    if len(often):
        tables.drop(sketches)
        sketches = sketch(docs, key, text, percent, words, np.sort(often.view(np.uint64)))
    # a set's hash goes with its size: both have to be equal for two texts to be one class
    classes = materialize(sketches.filter("n > 0 AND key IS NOT NULL").groupBy("hash", "n").agg(F.min("key").alias("id"), *[F.first(s).alias(s) for s in SIGNS]))
    tiles = materialize(shared_prefixes(sketches, percent).join(classes.select("hash", "id", "n"), "hash").select("gram", "id", F.col("n").cast("int").alias("n")))
    banded = tiles.withColumn("band", band(F.col("n"), percent))

    leads = banded.groupBy("gram", "band").agg(F.min(F.struct("n", "id")).alias("y"), F.count("*").alias("c")).filter("c > 1").select("gram", "band", "y")
    met = banded.join(leads, ["gram", "band"]).filter((F.col("id") != F.col("y.id")) & sized(F.col("n"), F.col("y.n"), percent))
    met = met.groupBy(F.col("id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("c"))
    met = met.groupBy("a").agg(F.max(F.struct("c", (-F.col("b")).alias("b"))).alias("m")).select("a", (-F.col("m.b")).alias("b"), "m.c")
    first = materialize(verified(materialize(bounded(met, classes, percent, 4)), docs, key, text, percent, words))
    known = materialize(components(first))

    few, many = deal(banded, known)
    if not many.isEmpty():  # what hubs contract need not meet pair by pair
        first = materialize(first.union(verified(materialize(meet_in_cells(many, classes, percent, CELL, hubs=True)), docs, key, text, percent, words)))
        known = materialize(components(first))
        few, many = deal(banded, known)
    near = few.filter("comp <> main").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).alias("y")
    rule = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.band") == F.col("y.band")) & (F.col("x.comp") != F.col("y.comp"))
    rule &= ((F.col("x.comp") == F.col("x.main")) | (F.col("x.id") < F.col("y.id"))) & sized(F.col("x.n"), F.col("y.n"), percent)
    # a pair meets in every tile that holds both: the count is of all prefix hashes that they share, or they meet in cells too
    rest = few.alias("x").join(near, rule).groupBy(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    rest = rest.agg(F.count("*").alias("c"), F.max(F.greatest("x.n", "y.n")).alias("most"), F.max(F.col("x.n") + F.col("y.n")).alias("sum"))
    rest = materialize(bounded(rest, classes, percent).union(meet_in_cells(many, classes, percent, CELL)).distinct())
    links = first
    if not rest.isEmpty():
        links = first.union(verified(rest, docs, key, text, percent, words))
        known = components(links)

    ids = classes.select("hash", "n", "id").join(known.select(F.col("node").alias("id"), "component"), "id", "left").select("hash", "n", F.coalesce("component", "id").alias("component_id"))
    return sketches, materialize(ids)


def oracle_sql() -> str:
    """All pairs that share a shingle, by brute force; components by recursion."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({low}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, hash(list_slice(w, k, k + {WORDS - 1})) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {WORDS - 1}) + 1)) AS k FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) AS m USING (doc_id)"""
