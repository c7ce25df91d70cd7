"""Language identification by a byte convolutional network over fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .convnet import ByteNet

WINDOW = 192
TRAIN_ROWS = 500       # sampled texts per language, about
TRAIN_WINDOWS = 6      # per sampled text, at random places; bounds the bytes of a text of any length
MAX_LANGUAGES = 200
UNKNOWN = "und"
BATCH = 512


def fold(doc_id: Column | str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % of


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All windows of a text, side by side, the last padded with zeros; at least one."""
    count = max(1, -(-len(data) // size))
    out = np.zeros(count * size, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(count, size)


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, seed: int = 9) -> ByteNet | None:
    """Fits on a bounded sample of (text, lang, doc_id): about `rows` texts a language, chosen by a hash of the id.

    Rows without language or text take no part; None where nothing is left. Of a text, TRAIN_WINDOWS windows travel.
    """
    usable = labelled.where("lang IS NOT NULL AND text <> ''")
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (place < -(-rows * 1_000_000 // n)))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            taken = []
            for value, key in zip(b.column("text"), b.column("key").to_pylist()):
                own = windows(value.as_buffer().to_pybytes())
                taken.append(own[np.random.default_rng([seed, key % (1 << 64)]).permutation(len(own))[:TRAIN_WINDOWS]].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("key"), pa.array(taken, pa.binary())], names=["lang", "key", "windows"])

    sample = (usable.where(chosen).select("lang", "text", F.xxhash64("doc_id", "text").alias("key"))
              .mapInArrow(draw, "lang string, key long, windows binary").limit(2 * rows * len(counts)).toArrow()
              .sort_by([("lang", "ascending"), ("key", "ascending"), ("windows", "ascending")]))
    classes = sorted(counts)
    x = [np.frombuffer(w.as_buffer(), np.uint8).reshape(-1, WINDOW) for w in sample["windows"]]
    y = [classes.index(lang) for lang, own in zip(sample["lang"].to_pylist(), x) for _ in own]
    net = ByteNet(classes)
    net.fit(np.concatenate(x), np.asarray(y))
    return net


def predict(df: DataFrame, net: ByteNet | None, text: str = "text") -> DataFrame:
    """Adds lang_pred and score: mean window probabilities over the whole text.

    `und` with score 0 where the text is null or has no letter. Only the columns of `df` travel.
    """
    if net is None:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    schema = df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}).schema
    at = df.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _classify(net, b.column(at), b.column(b.num_columns - 1))
            names, scores = [n for n, _ in found], [s for _, s in found]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names), pa.array(scores, pa.float64())], names=schema.names)

    return df.withColumn("_letters", F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))).mapInArrow(score, schema)


def _classify(net: ByteNet, texts: pa.Array, letters: pa.Array) -> list[tuple[str, float]]:
    total = np.zeros((len(texts), len(net.classes)))
    count = np.zeros(len(texts))
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if held:
            x = np.concatenate([w for _, w in held])
            owner = np.repeat([i for i, _ in held], [len(w) for _, w in held])
            np.add.at(total, owner, net.probabilities(x))
            np.add.at(count, owner, 1)
            held.clear()

    waiting = 0
    for i, (value, has) in enumerate(zip(texts, letters.to_pylist())):
        if not has:
            continue
        own = windows(value.as_buffer().to_pybytes())
        for a in range(0, len(own), BATCH):
            held.append((i, own[a:a + BATCH]))
            waiting += len(held[-1][1])
            if waiting >= BATCH:
                flush()
                waiting = 0
    flush()
    mean = total / np.maximum(count, 1)[:, None]
    best = mean.argmax(1)
    return [(net.classes[k], float(min(1.0, mean[i, k]))) if count[i] else (UNKNOWN, 0.0)
            for i, k in enumerate(best)]


def identify(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learns outside the held-out fold (remainder 1 of 3)."""
    slim = documents.select("doc_id", "text", "lang", (fold("doc_id", 3) == 1).alias("held_out"))
    net = train(slim.where("NOT held_out").select("doc_id", "text", "lang"))
    return predict(slim.select("doc_id", "text", "held_out"), net).drop("text")
