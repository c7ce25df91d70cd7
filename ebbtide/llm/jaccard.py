"""Exact Jaccard join on word shingles: size-banded tiles, bitmap bounds, then sorted-array intersection.

Sets are cut into parts by hash range, 1 + s parts more than two linked sets of a size band can differ in elements;
so linked sets agree in at least 1 + s whole parts. Each set leaves out its parts that hold fewer elements
than the part of rank s + 1 by size; at most s of the parts they agree in are so small for one or the other, so both
keep one of them. Each (band, part, content) kept is a tile. Texts that share only a passage seldom meet: a part mixes shingles
from all over a text, and the parts that hold nothing or next to nothing make no tiles. Tiles stream by and pair each
member with the first one; bitmaps bound the intersection of each pair, and sorted arrays decide what they leave. That
settles groups of copies in linear work. In tiles whose members are then still in different components, all such pairs
are bounded and decided in the same way, large tiles in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import among, arrow_rows, components, may_be_among, passes, staged, unclash
from .text import mix, raw, word_runs

MAX_BITS = 16_384
SPARE = 3  # a third more parts than needed, so that the emptiest third of what is needed can be left out
BLOCK_ROWS = 256  # of a tile in one comparison
MET_ROWS, UNPACK_ROWS, PACK_ROWS = 2048, 20_000, 50_000
SEEN_SETS = 100_000  # of a task, remembered at once
KNOWN_TILES = 16     # of a row, by which nearly every pair is given out once; each costs 8 bytes of every row that travels
TEXT_ROWS, PAIR_BATCH = 2000, 500  # texts, and pairs of bitmaps or sets, that reach Python at once
NO_CENTRE = np.iinfo(np.int64).min
PAIR_ROWS = 4096  # bitmaps compared at once
# Odd factors that make a shingle's hash depend on the order of its words.
FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def bands(parts_of: int, whole: int, upto: int) -> list[int]:
    """Lower bounds of the size bands: sets that link lie in one band or in two that touch."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, out[-1] * whole // parts_of + 1))
    return out


class Sets:
    """Shingle sets as sorted 64-bit hashes. Links: whole * intersection >= num * union (num of `whole`)."""

    def __init__(self, size: int, num: int, whole: int = 100):
        if not 0 < num <= whole or not 0 < size <= len(FACTORS):
            raise ValueError("threshold or shingle size out of range")
        self.size, self.num, self.whole = size, num, whole

    def each(self, texts: list[bytes]) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first text, sets of the texts from there on) in bounded runs; a long text is hashed in pieces."""
        k, parts = self.size, []
        for first, h, bounds, before, last in word_runs(texts, lower=True, keep=self.size - 1):
            rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
            for j in range(k):
                rolled += h[j:j + len(rolled)] * FACTORS[j]
            rolled = mix(rolled)
            if not last or parts:
                parts.append(np.unique(rolled))
                if not last:
                    continue
            out = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                if parts:
                    whole = np.unique(np.concatenate(parts))
                elif b - a >= k:
                    whole = np.unique(rolled[a:b - k + 1])
                else:
                    whole = np.zeros(0, np.uint64)
                if not len(whole) and b > a:  # fewer words than a shingle: all of them are one
                    whole = mix((h[a:b] * FACTORS[:b - a]).sum(keepdims=True) + FACTORS[-1 - (b - a)])
                out.append(whole)
            parts = []
            yield first, out

    def tiles(self, s: np.ndarray, bounds: list[int]) -> np.ndarray:
        """Tile keys of a set: its parts as the larger partner's band cuts them, for its own band and the next."""
        band = int(np.searchsorted(bounds, len(s), "right")) - 1
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(s + np.uint64(1)))))
        keys = []
        for j in (band, band + 1):
            differ = 2 * (bounds[j + 1] - 1) * (self.whole - self.num) // (self.whole + self.num)
            spare = differ // SPARE
            m = differ + 1 + spare
            edges = np.arange(1, m, dtype=np.uint64) * np.uint64((2**64 - 1) // m)
            at = np.concatenate(([0], np.searchsorted(s, edges), [len(s)]))
            held = np.diff(at)
            kept = np.flatnonzero(held >= np.partition(held, spare)[spare])
            keys.append(mix(total[at[1:]][kept] - total[at[:-1]][kept] + mix(kept.astype(np.uint64) + np.uint64(j << 40))))
        return np.concatenate(keys)

    def possible(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """False where sizes a, b and bitmaps x, y rule a link out: bits of one set alone are elements of it alone."""
        most = np.minimum(a - np.bitwise_count(x & ~y).sum(-1, dtype=np.int64), b - np.bitwise_count(y & ~x).sum(-1, dtype=np.int64))
        return (most > 0) & ((self.whole + self.num) * most >= self.num * (a + b))

    def linked(self, both: int, a: int, b: int) -> bool:
        return both > 0 and self.whole * both >= self.num * (a + b - both)


def digest(s: np.ndarray) -> bytes:
    """24 bytes that tell sets apart."""
    h = mix(s)
    return np.array([len(s), s.sum(), np.bitwise_xor.reduce(h) ^ (h * (s | np.uint64(1))).sum()], np.uint64).tobytes()


def bitmap(s: np.ndarray) -> np.ndarray:
    """64-bit words with one bit per hashed element; four bits an element, at least, up to MAX_BITS, and a power of two."""
    width = min(MAX_BITS, max(64, 1 << (4 * len(s) - 1).bit_length())) if len(s) else 64
    bits = np.zeros(width, np.uint8)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def narrowed(bits: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as rows of `words` words: wider ones fold, as an element's place is its hash modulo the width."""
    out = np.zeros((len(bits), words), np.uint64)
    sizes = np.fromiter(map(len, bits), np.int64, len(bits)) // 8
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        wide = np.frombuffer(b"".join(bits[i] for i in own), np.uint64).reshape(len(own), -1, words)
        out[own] = np.bitwise_or.reduce(wide, 1)
    return out


def shared(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def signatures(documents: DataFrame, sets: Sets, id_col: str = "doc_id") -> DataFrame:
    """id, n (set size), mark (a digest of the set) and bits (its bitmap) of every row; a row without a set has n = 0."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, held in sets.each(raw(b.column(1))):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(held)), pa.array([len(s) for s in held], pa.int64()), pa.array([digest(s) for s in held], pa.binary()),
                     pa.array([bitmap(s).tobytes() for s in held], pa.binary())], names=["id", "n", "mark", "bits"])

    return (documents.select(F.col(id_col).cast("long").alias("id"), "text")
            .mapInArrow(sign, "id long, n long, mark binary, bits binary"))


def tile_rows(documents: DataFrame, sets: Sets, id_col: str) -> DataFrame:
    """(bucket, keys, ids, centres): the tiles of every distinct set of a task, packed by bucket of the key.

    A row for every tile would take four times the bytes in the shuffle, so PACK_ROWS of a task travel together.
    `centres` is filled where the tile already has a row among those at hand, or (with key 0) for a set
    that the task has seen before: such rows need not meet others, and are dealt out as they come.
    """
    bounds = bands(sets.num, sets.whole, 1 << 33)
    buckets = 2 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(keys: list[np.ndarray], owners: list[np.ndarray], same: list[tuple[int, int]]) -> pa.RecordBatch:
        key = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
        owner = np.concatenate([np.zeros(0, np.int64), *owners])
        _, at, back = np.unique(key, return_index=True, return_inverse=True)
        centre = owner[at][back]
        repeat = at[back] != np.arange(len(key))
        known = np.asarray(same, np.int64).reshape(-1, 2)
        bucket = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((key, bucket, repeat))
        order = order[:len(order) - int(repeat.sum())]
        heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        out = [(int(bucket[own[0]]), planes(key[own]), planes(owner[own]), b"") for own in np.split(order, heads[1:]) if len(own)]
        met = [np.concatenate((x[repeat], y)) for x, y in ((key, np.zeros(len(known), np.int64)), (owner, known[:, 0]), (centre, known[:, 1]))]
        for at in range(0, len(met[0]), MET_ROWS):
            part = [x[at:at + MET_ROWS] for x in met]
            out.append((int(part[1][0] % buckets), *map(planes, part)))
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int32() if i == 0 else pa.binary()) for i in range(4)],
                                          names=["bucket", "keys", "ids", "centres"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        keys, owners, same, held = [], [], [], 0
        for b in batches:
            ids = b.column(0).to_pylist()
            for first, found in sets.each(raw(b.column(1))):
                for i, s in enumerate(found, first):
                    if not len(s):
                        continue
                    mark = digest(s)
                    if seen.setdefault(mark, ids[i]) != ids[i]:
                        same.append((ids[i], seen[mark]))
                        continue
                    keys.append(sets.tiles(s, bounds))
                    owners.append(np.full(len(keys[-1]), ids[i], np.int64))
                    held += len(keys[-1])
                if held + len(same) >= PACK_ROWS:
                    yield packed(keys, owners, same)
                    keys, owners, same, held = [], [], [], 0
                if len(seen) > SEEN_SETS:  # a set forgotten meets its equals in its tiles
                    seen.clear()
        yield packed(keys, owners, same)

    rows = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), "text")
    return rows.mapInArrow(emit, "bucket int, keys binary, ids binary, centres binary")


def planes(x: np.ndarray) -> bytes:
    """64-bit values with their bytes of equal rank side by side, which the shuffle's codec shortens."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, centre) of packed tiles; centre is null where none is known."""
    def values(data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()

    for b in batches:
        held, rows = [], 0
        for row in range(b.num_rows):
            keys, ids, centres = (b.column(c)[row].as_py() for c in ("keys", "ids", "centres"))
            held.append((values(keys), values(ids), values(centres) if centres else np.full(len(keys) // 8, NO_CENTRE)))
            rows += len(held[-1][0])
            if rows > UNPACK_ROWS or row == b.num_rows - 1:
                key, own, centre = (np.concatenate(x) for x in zip(*held))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own), pa.array(centre, mask=centre == NO_CENTRE)], names=["key", "id", "centre"])
                held, rows = [], 0


def centred(rows: DataFrame) -> DataFrame:
    """Members of tiles with two rows or more, each with its centre; tiles stream by in order, none is held.

    `rows` (key, id, centre) have each key without a centre in one partition.
    """
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_id = None
        open_ = False  # the last tile has one row only, not given out so far
        for b in batches:
            key, own = b.column("key").to_numpy(), b.column("id").to_numpy()
            given = b.column("centre")
            done = given.is_valid().to_numpy(zero_copy_only=False)
            local = np.flatnonzero(done)
            out = [(key[local], own[local], given.fill_null(0).to_numpy()[local])]
            key, own = key[~done], own[~done]
            if len(key):
                if last_key is not None and open_:
                    key, own = np.concatenate(([last_key], key)), np.concatenate(([last_id], own))
                new = np.concatenate(([True], key[1:] != key[:-1]))
                if last_key is not None and not open_ and key[0] == last_key:
                    new[0] = False
                    heads = np.concatenate(([-1], np.flatnonzero(new)))
                    centres = np.concatenate(([last_id], own[heads[1:]]))
                    group = np.cumsum(new)
                else:
                    heads = np.flatnonzero(new)
                    centres, group = own[heads], np.cumsum(new) - 1
                size = np.bincount(group, minlength=len(heads))
                if heads[0] == -1:
                    size[0] += 2
                keep = size[group] > 1
                out.append((key[keep], own[keep], centres[group][keep]))
                last_key, last_id, open_ = int(key[-1]), int(centres[-1]), bool(size[-1] == 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["key", "id", "centre"])

    return rows.sortWithinPartitions("key", "id").mapInArrow(stream, "key long, id long, centre long")


def candidates(pairs: DataFrame, signs: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, equal) of the pairs that sizes and bitmaps allow."""
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            n, m = t.column("n").to_numpy(), t.column("m").to_numpy()
            x, y = t.column("x").to_pylist(), t.column("y").to_pylist()
            words = np.fromiter((min(len(p), len(q)) // 8 for p, q in zip(x, y)), np.int64, len(x))
            may = np.zeros(len(n), bool)
            for w in np.unique(words):
                own = np.flatnonzero(words == w)
                may[own] = sets.possible(n[own], m[own], narrowed([x[i] for i in own], w), narrowed([y[i] for i in own], w))
            yield t.filter(pa.array(may)).select(["a", "b", "equal"])

    left = signs.select(F.col("id").alias("a"), "n", F.col("mark").alias("k"), F.col("bits").alias("x"))
    right = signs.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("mark").alias("l"), F.col("bits").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").where(
        sets.whole * F.least("n", "m") >= sets.num * F.greatest("n", "m"))
    return both.select("a", "b", "n", "m", "x", "y", (F.col("k") == F.col("l")).alias("equal")).mapInArrow(bound, "a long, b long, equal boolean")


def verified(found: DataFrame, documents: DataFrame, sets: Sets, id_col: str) -> DataFrame:
    """The candidate pairs that link: equal sets at once, the others by intersecting their sorted arrays."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, held in sets.each(raw(b.column("text"))):
                yield pa.RecordBatch.from_arrays([b.column("id").slice(first, len(held)), pa.array([s.tobytes() for s in held], pa.binary())],
                                                 names=["id", "elements"])

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            pairs = [(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)) for p, q in zip(t.column("x"), t.column("y"))]
            yield t.filter(pa.array([sets.linked(shared(p, q), len(p), len(q)) for p, q in pairs], pa.bool_())).select(["a", "b"])

    unequal = found.where("NOT equal").select("a", "b")
    ids = unequal.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = documents.select(F.col(id_col).cast("long").alias("id"), "text")
    may = may_be_among(ids)  # a set too many meets no pair
    wanted = texts.join(ids, "id") if may is None else texts.where(passes(may, F.col("id")))
    with arrow_rows(documents.sparkSession, PAIR_BATCH):
        return _intersected(found, unequal, staged(wanted.mapInArrow(make, "id long, elements binary"), "sets"), intersect)


def _intersected(found: DataFrame, unequal: DataFrame, loaded: DataFrame, intersect: Callable) -> DataFrame:
    exact = (unequal.join(loaded.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a")
             .join(loaded.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b").mapInArrow(intersect, "a long, b long"))
    return staged(found.where("equal").select("a", "b").union(exact), "links")


def open_tiles(members: DataFrame, pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(key, id, component, rows): the rows of tiles that hold several components and more than the two rows that have met.

    A tile holds several components where some member's differs from its centre's; that is asked of the distinct pairs of
    members and centres, of which there are few, before any tile is gathered. Of tiles with the same rows one is kept.
    """
    a, b = (known.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
    apart = staged(pairs.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"), "apart")
    tiles = members.where("key <> 0")
    may = may_be_among(apart.select(F.xxhash64("a", "b").alias("id")))  # most members go before the joins shuffle them
    likely = tiles if may is None else tiles.where(passes(may, F.xxhash64("id", "centre")))
    keys = staged(likely.join(apart, (F.col("id") == F.col("a")) & (F.col("centre") == F.col("b")), "left_semi").select("key").distinct(), "open-keys")
    may = may_be_among(keys.select(F.col("key").alias("id")))
    likely = tiles if may is None else tiles.where(passes(may, F.col("key")))
    rows = likely.join(keys, "key", "left_semi").select("key", F.explode(F.array("id", "centre")).alias("id")).distinct()
    rows = staged(rows, "open-rows")
    once = (rows.groupBy("key").agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
            .where("rows > 2").groupBy("rows", "x", "y").agg(F.min("key").alias("key")).select("key", "rows"))
    return (rows.join(once, "key").join(known, "id", "left").withColumn("component", F.coalesce("component", "id")))


def met_in_tiles(rows: DataFrame, signs: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, equal) of pairs in a tile that are in different components so far and that sizes and bitmaps allow.

    Tiles of up to BLOCK_ROWS rows are compared many to a task, larger ones in blocks and pairs of blocks. A row knows the
    first of its tiles, so that a pair is given out in the first tile that both know and share; a few pairs come twice.
    """
    rows = staged(rows, "tiles")
    first = rows.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("key")), 1, KNOWN_TILES).alias("tiles"))
    open_ = rows.select("key", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"), "rows").distinct()
    total = open_.where("blocks = 1").agg(F.sum("rows")).first()[0] or 0
    bins = total // (16 * BLOCK_ROWS) + 1
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (rows.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")).drop("rows").withColumn("own", own).withColumn("other", other)
             .withColumn("bin", F.when(F.col("blocks") == 1, F.pmod("key", F.lit(bins))).otherwise(F.col("key")))
             .withColumn("x", F.when(F.col("blocks") > 1, F.least("own", "other"))).withColumn("y", F.when(F.col("blocks") > 1, F.greatest("own", "other"))))

    def meet(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("id", "ascending")])
        key, ids, label, n, own, mark = (group[c].to_numpy() for c in ("key", "id", "component", "n", "own", "mark"))
        bits, cross = group["bits"].to_pylist(), group["x"][0].as_py() != group["y"][0].as_py()
        tiles = [set(t) for t in group["tiles"].to_pylist()]
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        out = []
        for lo, hi in zip(edges[:-1], edges[1:]):
            b = narrowed(bits[lo:hi], min(map(len, bits[lo:hi])) // 8)
            i, j = np.triu_indices(hi - lo, 1)
            differ = label[lo + i] != label[lo + j]
            if cross:
                differ &= own[lo + i] != own[lo + j]
            i, j = i[differ], j[differ]
            for at in range(0, len(i), PAIR_ROWS):
                p, q = i[at:at + PAIR_ROWS], j[at:at + PAIR_ROWS]
                fit = sets.whole * np.minimum(n[lo + p], n[lo + q]) >= sets.num * np.maximum(n[lo + p], n[lo + q])
                p, q = p[fit], q[fit]
                may = sets.possible(n[lo + p], n[lo + q], b[p], b[q])
                out += [(int(ids[y]), int(ids[x]), bool(mark[x] == mark[y])) for x, y in zip(lo + p[may], lo + q[may])
                        if min(tiles[x] & tiles[y], default=key[lo]) >= key[lo]]
        a, c, e = zip(*out) if out else ((), (), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(e, pa.bool_())], names=["a", "b", "equal"])

    carried = (dealt.join(first, "id").join(signs, "id")
               .select("bin", "x", "y", "key", "id", "component", "own", "n", "mark", "bits", "tiles"))
    return carried.groupBy("bin", "x", "y").applyInArrow(meet, "a long, b long, equal boolean").distinct()


def link_components(documents: DataFrame, sets: Sets, signs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, component) of every document that links with another one. `signs` is staged.

    First every member of a tile meets the tile's centre; that is linear in the tiles, and settles groups of copies.
    Then members of tiles that still hold several components meet each other.
    """
    tiles = tile_rows(documents, sets, id_col).repartition("bucket").mapInArrow(unpacked, "key long, id long, centre long")
    members = staged(centred(tiles), "members")
    pairs = members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"), (F.col("key") == 0).alias("same"))
    pairs = staged(pairs.groupBy("a", "b").agg(F.max("same").alias("same")), "pairs")
    same = pairs.where("same").select("a", "b")  # equal sets that one task has seen
    with arrow_rows(documents.sparkSession, PAIR_BATCH):
        found = staged(candidates(pairs.where("NOT same"), signs, sets), "candidates")
    links = verified(found, documents, sets, id_col).union(same)
    known = staged(components(links), "components")
    rest = staged(met_in_tiles(open_tiles(members, pairs, known), signs, sets), "rest")
    rest = staged(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
    if rest.isEmpty():
        return known
    return components(verified(rest, documents, sets, id_col).union(known.select(F.col("id").alias("a"), F.col("component").alias("b"))))


def join_documents(documents: DataFrame, size: int = 3, num: int = 90, whole: int = 100) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included).

    Null and empty texts have no set and link with nothing; rows that repeat a doc_id count as one node; a null
    doc_id stays alone. An empty table gives no rows.
    """
    sets = Sets(size, num, whole)
    with arrow_rows(documents.sparkSession, TEXT_ROWS):
        signs = staged(signatures(documents, sets), "signs")
        found = link_components(documents, sets, signs)
    return (signs.select("id", "n").join(found, "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def keep_one(documents: DataFrame, size: int = 5, num: int = 80, whole: int = 100) -> DataFrame:
    """The documents without those that link, directly or not, with one of a smaller doc_id; all columns kept.

    A row with a null doc_id always stays. Of rows equal in doc_id and text one stays, the first by all columns.
    Rows that share a doc_id but not the text are documents of their own; where they link, the smallest
    (doc_id, md5 of the text) stays.
    """
    with arrow_rows(documents.sparkSession, TEXT_ROWS):
        return _kept(documents, Sets(size, num, whole))


def _kept(documents: DataFrame, sets: Sets) -> DataFrame:
    text = F.coalesce(F.md5("text"), F.lit(""))
    known = documents.where("doc_id IS NOT NULL")
    mixed = known.groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high")).where("low <> high")
    if mixed.isEmpty():
        signs = staged(signatures(documents, sets), "signs")
        gone = staged(link_components(documents, sets, signs).where("id <> component").select("id"), "gone")
        return _once(_without(documents, "doc_id", gone, signs.select("id")))
    node, best = unclash(documents, name="_node"), F.min(F.struct("doc_id", "digest", "id")).alias("best")
    rows = staged(documents.withColumn(node, F.monotonically_increasing_id()), "rows")
    known = rows.where("doc_id IS NOT NULL").select(node, "doc_id", "text")
    signs = staged(signatures(known, sets, node), "signs")
    linked = staged(link_components(known, sets, signs, node), "linked")
    first = linked.join(known.select(F.col(node).alias("id"), "doc_id", text.alias("digest")), "id").groupBy("component").agg(best).select("best.id")
    gone = staged(linked.join(first, "id", "left_anti").select("id"), "gone")
    return _once(_without(rows, node, gone, signs.select("id")).select(*documents.columns))


def _without(rows: DataFrame, column: str, gone: DataFrame, universe: DataFrame) -> DataFrame:
    """The rows whose id is not among those of `gone`; a null id stays. Rows are dropped where they lie, not shuffled to a join."""
    test, ids = among(gone, universe), gone.select(F.col("id").alias("_id"))
    if test is None:
        return rows.join(ids, rows[column] == ids["_id"], "left_anti")
    return rows.where(~passes(test, F.col(f"`{column}`").cast("long")))


def _once(rows: DataFrame) -> DataFrame:
    """One row, the first by all columns, for each pair of a doc_id, not null, and a text."""
    known = rows.where("doc_id IS NOT NULL")
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows
    first = known.groupBy("doc_id", F.md5("text")).agg(F.min(F.struct(*rows.columns)).alias("row")).select("row.*")
    return rows.where("doc_id IS NULL").unionByName(first)
