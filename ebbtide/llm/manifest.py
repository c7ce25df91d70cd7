"""A Merkle manifest of a table, its leaves ordered by bitmap ranks instead of a sort.

The ids of a group (a language) are kept as a compressed bitmap: 64-bit words of 64 neighbouring ids, made by OR before
the shuffle, only words that hold an id, put together in blocks of 65,536 ids with a popcount directory (the rows before
each word of the block). Running sums over the block totals give the rows before each block. A leaf's place is then a
rank query: rows before its block, rows before its word, bits below its own. Where ids repeat, rows of such words are
counted instead of bits, in the order (id, leaf).

Places key the slots of arrays of 8 * 8 * 8 nodes. A task reduces such an array by three levels at once; its top is
a slot of the next round's arrays. Proofs come down the same arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import running_sums
from .common import each_copy, staged

FAN, LEVELS = 8, 3
NODES = FAN ** LEVELS
WORD_BITS, BLOCK_BITS = 6, 10
NO_ID_WORD = -(1 << 57) - (1 << BLOCK_BITS)  # below the word of any id
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    parts = [field(text if c == "text" else F.col(c)) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def group_key(column: str) -> Column:
    """Text in the order of the groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def tampered(text: Column, id_col: str = "doc_id") -> Column:
    """The text after tampering, null where the row is left alone; rows without an id are."""
    return F.when(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.translate(text, UPPER, LOWER))


def leaves_of(documents: DataFrame) -> DataFrame:
    """(key, word, bit, doc_id, leaf, fake): a row per document; fake is its leaf after tampering, null without any."""
    fake = tampered(F.col("text"))
    word = F.coalesce(F.shiftright("doc_id", WORD_BITS), F.lit(NO_ID_WORD))
    # Of a text without A-Z, the tampered leaf is the leaf.
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
            .select(group_key("lang").alias("key"), word.alias("word"), F.coalesce(F.col("doc_id").bitwiseAND(63).cast("int"), F.lit(0)).alias("bit"),
                    "doc_id", leaf_hash(F.col("text")).alias("leaf"), F.when(fake.isNotNull() & (fake != F.col("text")), leaf_hash(fake)).alias("fake")))


def bitmap_blocks(leaves: DataFrame) -> DataFrame:
    """(key, block, before, total, words): the compressed bitmap of each group in blocks, with its directory.

    words: array of (word, bits, rows, ahead), at most 1,024 of them; ahead are the rows before the word in its block.
    before and total are the rows before the block and of the whole group.
    """
    word = leaves.groupBy("key", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("rows"))
    blocks = (word.groupBy("key", F.shiftright("word", BLOCK_BITS).alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("word", "bits", "rows"))).alias("words"), F.sum("rows").alias("n")))
    ahead = F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.struct(
        F.element_at("words", i)["word"].alias("word"), F.element_at("words", i)["bits"].alias("bits"), F.element_at("words", i)["rows"].alias("rows"),
        F.aggregate(F.slice("words", F.lit(1), i - 1), F.lit(0).cast("long"), lambda a, x: a + x["rows"]).alias("ahead")))
    directory = running_sums(blocks.select("key", "block", "n"), ["key"], "block", ["n"], groups=None)
    return (blocks.drop("n").join(directory.select("key", "block", F.col("n_before").alias("before"), F.col("n_total").alias("total")), ["key", "block"])
            .withColumn("words", ahead))


def placed(leaves: DataFrame) -> DataFrame:
    """(key, pos, n, doc_id, leaf, fake): the leaves with their place from 0 in their group, and its size; `leaves` are staged."""
    blocks = staged(bitmap_blocks(leaves), "bitmaps")
    words = blocks.select("key", F.col("total").alias("n"), "before", F.inline("words"))
    ranked = (leaves.join(words, ["key", "word"])
              .select("key", "n", (F.col("before") + F.col("ahead")).alias("first"), "bit", "doc_id", "leaf", "fake",
                      (F.col("rows") > F.bit_count("bits")).alias("crowded"),
                      F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)"))).cast("long").alias("below")))
    plain = ranked.where(~F.col("crowded")).select("key", (F.col("first") + F.col("below")).alias("pos"), "n", "doc_id", "leaf", "fake")
    if blocks.where(F.exists("words", lambda x: x["rows"] > F.bit_count(x["bits"]))).isEmpty():
        return plain
    same = ranked.where("crowded").groupBy("key", "first", "n", "bit", "doc_id", "leaf", "fake").agg(F.count("*").alias("copies"))
    order = F.concat(F.lpad(F.col("first").cast("string"), 19, "0"), F.lpad(F.col("bit").cast("string"), 2, "0"), F.hex("leaf"), F.coalesce(F.hex("fake"), F.lit("")))
    numbered = staged(running_sums(same.withColumn("order", order), ["key"], "order", ["copies"], groups=None), "repeated-ids")
    base = numbered.groupBy("key", "first").agg(F.min("copies_before").alias("base"))
    spread = each_copy(numbered.join(base, ["key", "first"]), "copies", "copy")
    return plain.unionByName(spread.select("key", (F.col("first") + F.col("copies_before") - F.col("base") + F.col("copy")).alias("pos"), "n", "doc_id", "leaf", "fake"))


def levels_of(nodes: int) -> int:
    """Levels above `nodes` nodes until one is left."""
    out = 0
    while nodes > 1:
        nodes, out = -(-nodes // FAN), out + 1
    return out


def node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def tree(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from `nodes` up to `levels` above; a last run may be short."""
    out = [nodes]
    for _ in range(levels):
        last = out[-1]
        out.append([node(last[i:i + FAN]) for i in range(0, len(last), FAN)])
    return out


def siblings(levels: list[list[str]], slot: int) -> str:
    """For each level below the top: the run's nodes left of the slot, `<`, those right of it, `>`."""
    out = []
    for level in levels[:-1]:
        run = slot - slot % FAN
        out.append("".join(level[run:slot]) + "<" + "".join(level[slot + 1:run + FAN]) + ">")
        slot //= FAN
    return "".join(out)


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and its siblings give."""
    for step in path.split(">")[:-1]:
        left, right = step.split("<")
        leaf = node([left, leaf, right])
    return leaf


def proof(path: str) -> str:
    return hashlib.sha256(path.replace("<", "").replace(">", "").encode()).hexdigest()


def _here(n: int, round_: int) -> int:
    return min(LEVELS, max(0, levels_of(n) - LEVELS * round_))


def _arrays(nodes: DataFrame, *more: str) -> DataFrame:
    """(key, chunk, n, slots): nodes (key, pos, n, hash) in arrays of at most NODES, in order."""
    return (nodes.groupBy("key", F.expr(f"pos div {NODES}").alias("chunk"))
            .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct((F.col("pos") % NODES).cast("int").alias("slot"), "hash", *more))).alias("slots")))


def _tops(arrays: DataFrame, round_: int) -> DataFrame:
    """The top node of each array, as a node of the next round."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [bytes.fromhex(tree([s["hash"].hex() for s in slots.as_py()], _here(n.as_py(), round_))[-1][0])
                    for n, slots in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(tops, pa.binary())], names=["key", "pos", "n", "hash"])

    return arrays.select("key", "chunk", "n", F.transform("slots", lambda s: F.struct(s["hash"].alias("hash"))).alias("slots")).mapInArrow(reduce, "key string, pos long, n long, hash binary")


def grown(nodes: DataFrame, name: str, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """The staged arrays of every round, and (key, n, hash) of each key's last node. One round per 512-fold size."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    rounds = []
    while True:
        rounds.append(staged(_arrays(nodes, *(more if not rounds else ())), name))
        nodes = _tops(rounds[-1], len(rounds) - 1)
        if levels_of(most) <= LEVELS * len(rounds):
            return rounds, nodes.select("key", "n", "hash")


def lowered(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(key, chunk, n, slots, path, subroot, root): the first round's arrays with the siblings of their tops.

    `tops` have (key, path, subroot, root), path being the siblings of the key's last node.
    """
    above = tops.withColumn("chunk", F.lit(0).cast("long"))
    for round_ in range(len(rounds) - 1, 0, -1):
        def down(batches: Iterator[pa.RecordBatch], round_: int = round_) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                    levels = tree([s["hash"].hex() for s in row["slots"]], _here(row["n"], round_))
                    yield pa.RecordBatch.from_pylist(
                        [{"key": row["key"], "path": siblings(levels, i) + row["path"], "subroot": row["subroot"], "root": row["root"],
                          "chunk": row["chunk"] * NODES + i} for i in range(len(levels[0]))], schema=out)

        out = pa.schema([("key", pa.string()), ("path", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("chunk", pa.int64())])
        above = (rounds[round_].join(above, ["key", "chunk"]).select("key", "chunk", "n", "slots", "path", "subroot", "root")
                 .mapInArrow(down, "key string, path string, subroot string, root string, chunk long"))
    return rounds[0].join(above, ["key", "chunk"]).select("key", "chunk", "n", "slots", "path", "subroot", "root")


@dataclass
class Manifest:
    """arrays: the leaves in arrays of 512 with the siblings above them; subroots: (key, n, subroot, root) of each group."""

    arrays: DataFrame
    subroots: DataFrame

    def proofs(self) -> DataFrame:
        """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_siblings, pos."""
        schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean,"
                  " n_siblings int, pos long")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    n, chunk, slots, path, subroot, root = (b.column(c)[r].as_py() for c in ("n", "chunk", "slots", "path", "subroot", "root"))
                    levels = tree([s["hash"].hex() for s in slots], _here(n, 0))
                    rows = []
                    for i, s in enumerate(slots):
                        whole = siblings(levels, i) + path
                        folded = fold((s["fake"] or s["hash"]).hex(), whole)
                        held = len(whole) - 2 * whole.count(">")
                        rows.append((s["doc_id"], s["hash"].hex(), subroot, root, proof(whole), folded, folded == root, held // 64, chunk * NODES + i))
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), out)], schema=out)

        out = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                         ("verified", pa.bool_()), ("n_siblings", pa.int32()), ("pos", pa.int64())])
        return self.arrays.mapInArrow(read, schema)


def build(documents: DataFrame) -> Manifest:
    """The manifest of documents (doc_id, source, lang, n_chars, text; other columns are not read).

    A null or empty lang is a group of its own each. Rows without an id come first in their group. Rows of one id follow
    by leaf; equal rows have a leaf and a proof each. Very long texts are hashed where they are read.
    """
    leaves = staged(leaves_of(documents), "leaves")
    rounds, tops = grown(placed(leaves).withColumnRenamed("leaf", "hash"), "manifest", "doc_id", "fake")
    tops = staged(tops, "subroots")
    # The groups in their order are the leaves of one more tree.
    order = running_sums(tops.withColumn("one", F.lit(1).cast("long")), [], "key", ["one"])
    groups = order.select(F.lit("").alias("key"), F.col("one_before").alias("pos"), F.col("one_total").alias("n"), "hash", F.col("key").alias("group"))
    above, root = grown(groups, "manifest-top", "group")
    root = F.hex(root.select("hash").scalar())
    paths = lowered(above, above[0].sparkSession.createDataFrame([("", "", "", "")], "key string, path string, subroot string, root string"))
    subroots = staged(_of_groups(paths), "group-proofs").withColumn("root", F.lower(root))
    subroots = tops.drop("hash").join(subroots, "key")
    return Manifest(lowered(rounds, subroots.select("key", "path", "subroot", "root")), subroots.select("key", "n", "subroot", "root"))


def _of_groups(arrays: DataFrame) -> DataFrame:
    """(key, path, subroot) of every group."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                levels = tree([s["hash"].hex() for s in row["slots"]], _here(row["n"], 0))
                yield pa.RecordBatch.from_pylist([{"key": s["group"], "path": siblings(levels, i) + row["path"], "subroot": s["hash"].hex()}
                                                  for i, s in enumerate(row["slots"])], schema=out)

    out = pa.schema([("key", pa.string()), ("path", pa.string()), ("subroot", pa.string())])
    return arrays.mapInArrow(read, "key string, path string, subroot string")


def verify(documents: DataFrame) -> DataFrame:
    """One row per document: the proofs of the manifest held against documents of which a third may be tampered with."""
    return build(documents).proofs()
