"""Toxicity by a convolutional text classifier over hashed word embeddings, with thresholds by language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.ordered import running_sums
from .common import staged
from .convnet import Adam
from .language import fold
from .text import BLOCK_BYTES, blocks, pieces, words

BUCKETS = 1 << 15
PREFIXES = (4, 5, 6)
SHARD_BYTES = 16 << 20   # of labelled text, about: what one task fits on, held as bucket numbers
STEP_WORDS = 1 << 16     # words whose embeddings are held at once
CALIBRATE = 4            # one in so many labelled rows sets the thresholds, the others fit
RARE = 5               # a bucket seen in fewer texts says nothing
OWN_CUT = 20             # rows of each class that a language needs for a threshold of its own
PARAM_BLOCK = 1 << 14    # parameters that travel as one row


def _ends() -> np.ndarray:
    """Every ASCII byte but letters and digits ends a word."""
    out = np.zeros(256, bool)
    out[[i for i in range(128) if not chr(i).isalnum()]] = True
    return out


ENDS = _ends()


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(words, features) bucket numbers: the word itself and its prefixes; and words before each text. Hashes a bounded run of bytes at a time."""
    own, sizes = [np.zeros((0, 1 + len(PREFIXES)), np.int32)], np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    places: list[int] = []

    def hash_held() -> None:
        whole, before, prefixes = words(held, ENDS, PREFIXES)
        own.append((np.stack([whole, *prefixes], 1) >> np.uint64(64 - 15)).astype(np.int32))
        np.add.at(sizes, places, np.diff(before))
        held.clear()
        places.clear()

    total = 0
    for i, data in enumerate(texts):
        for piece in pieces(data):
            if held and total + len(piece) > BLOCK_BYTES:
                hash_held()
                total = 0
            held.append(piece)
            places.append(i)
            total += len(piece)
    if held:
        hash_held()
    return np.concatenate(own), np.concatenate(([0], np.cumsum(sizes)))


def runs_of(before: np.ndarray, overlap: int, size: int = STEP_WORDS) -> Iterator[tuple[int, int, int, int]]:
    """(first text, text after the last, first word, word after the last): runs of about `size` words that hold whole texts,
    or of one longer text a part, which begins with the last `overlap` words of the part before."""
    t, n = 0, len(before) - 1
    while t < n:
        if before[t + 1] - before[t] > size:
            for low in range(before[t], before[t + 1] - overlap, size - overlap):
                yield t, t + 1, low, min(low + size, before[t + 1])
            t += 1
            continue
        last = max(t + 1, int(np.searchsorted(before, before[t] + size, "right")) - 1)
        yield t, last, before[t], before[last]
        t = last


def language_profile(data: bytes) -> np.ndarray:
    """Shares of the bytes in a text's words; what the language group is read from."""
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256) / max(1, len(data))


class ToxicNet:
    """Sum of hashed embeddings per word -> filters over 1, 2 and 3 words -> maximum over the text -> logistic."""

    def __init__(self, dim: int = 6, filters: int = 6, widths: tuple[int, ...] = (1, 2, 3), seed: int = 4):
        rng = np.random.default_rng(seed)
        self.widths, self.filters = widths, filters
        self.p = {"e": rng.normal(0, .05, (BUCKETS, dim)), "o": np.full(filters * len(widths), .1), "b": np.zeros(1)}
        for k in widths:
            w = rng.normal(0, .1, (k, dim, filters))
            w[0, 0] = np.abs(w[0, 0]) + .3
            self.p[f"w{k}"] = w
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.profiles, self.cuts, self.scale = np.zeros((1, 256)), np.zeros(1), 1.0

    def pooled(self, own: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maximum of every filter over each text (0 where it has no words), and at which word."""
        n, f = len(before) - 1, self.filters
        out = np.zeros((n, f * len(self.widths)), np.float32)
        where = [np.full((n, f), -1) for _ in self.widths]
        for first, last, low, high in runs_of(before, max(self.widths) - 1):
            e = self.p["e"][own[low:high]].sum(1)
            for i, k in enumerate(self.widths):
                z = e @ self.p[f"w{k}"][0]
                for j in range(1, k):
                    z[:-j] += e[j:] @ self.p[f"w{k}"][j]
                for t in range(first, last):
                    start, stop = max(before[t], low) - low, min(before[t + 1], high) - low - k + 1
                    if stop > start:
                        at = z[start:stop].argmax(0) + start
                        top, best = z[at, np.arange(f)], out[t, i * f:(i + 1) * f]
                        better = (where[i][t] < 0) | (top > best)
                        best[better] = top[better]
                        where[i][t][better] = at[better] + low
        return np.maximum(out, 0), where

    def start(self, seen: np.ndarray, size: np.ndarray) -> None:
        """The first embedding axis starts as the smoothed log ratio of text frequencies (class, bucket) of each bucket; size: texts by class."""
        ratio = np.log((seen[1] + .5) / (size[1] + 1)) - np.log((seen[0] + .5) / (size[0] + 1))
        self.p["e"][:, 0] = np.where(seen.sum(0) >= RARE, np.clip(ratio, -4, 6) / 4, 0)

    def fit(self, own: np.ndarray, before: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 3, batch: int = 32, rate: float = .01, seed: int = 6) -> None:
        """weight: of each class, the same in every shard."""
        rng, adam = np.random.default_rng(seed), Adam({k: v for k, v in self.p.items() if k != "e"}, rate)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for start in range(0, len(order), batch):
                rows = order[start:start + batch]
                parts = [own[before[t]:before[t + 1]] for t in rows]
                ob, bb = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))
                h, where = self.pooled(ob, bb)
                d = (sigmoid(h @ self.p["o"] + self.p["b"]) - y[rows]) * weight[y[rows]] / len(rows)
                g, dh = {"o": h.T @ d, "b": d.sum(keepdims=True)}, d[:, None] * self.p["o"] * (h > 0)
                for i, k in enumerate(self.widths):
                    dz = np.where(where[i] >= 0, dh[:, i * self.filters:(i + 1) * self.filters], 0)
                    at = np.maximum(where[i], 0)[:, :, None] + np.arange(k)
                    at = ob[np.minimum(at, len(ob) - 1)] if len(ob) else np.zeros((*at.shape, own.shape[1]), np.int32)
                    g[f"w{k}"] = np.einsum("nf,nfkd->kdf", dz, self.p["e"][at].sum(3))
                    step = np.einsum("nf,kdf->nfkd", dz, self.p[f"w{k}"])
                    np.subtract.at(self.p["e"], at, np.float32(rate) * step[:, :, :, None, :])
                adam.step(g)

    def raw(self, own: np.ndarray, before: np.ndarray) -> np.ndarray:
        return self.pooled(own, before)[0] @ self.p["o"] + self.p["b"]

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def unflat(self, values: np.ndarray) -> None:
        at = 0
        for name, v in self.p.items():
            self.p[name] = values[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def score(self, texts: list[bytes]) -> np.ndarray:
        own, before = buckets(texts)
        shares = np.sqrt(np.stack([language_profile(t) for t in texts]))
        cut = self.cuts[(shares @ self.profiles.T).argmax(1)]
        return sigmoid((self.raw(own, before) - cut) * self.scale)


def best_cuts(scored: DataFrame) -> dict[str, tuple[float, int, int]]:
    """key -> (cut, clean rows, toxic rows) of rows (key, raw, toxic), over all of them.

    A cut lies in the middle between two neighbouring values, or 1 outside all. It has the fewest errors, both classes weighing
    the same, of several the widest gap, then the smallest value.
    """
    bad = F.col("toxic").cast("long")
    hist = staged(scored.groupBy("key", "raw").agg(F.sum(bad).alias("bad"), F.sum(1 - bad).alias("good")), "toxic-scores")
    at = running_sums(hist, ["key"], "raw", ["bad", "good"], groups=None, next_value=True)
    exact = "decimal(19,0)"
    below, above = F.col("bad_before") + F.col("bad"), F.col("good_total") - F.col("good_before") - F.col("good")
    wrong = (below.cast(exact) * F.greatest("good_total", F.lit(1)).cast(exact) + above.cast(exact) * F.greatest("bad_total", F.lit(1)).cast(exact))
    gap = F.coalesce(F.col("next_value") - F.col("raw"), F.lit(0.0))
    cut = F.coalesce((F.col("next_value") + F.col("raw")) / 2, F.col("raw") + 1)
    found = at.groupBy("key").agg(F.min(F.struct(wrong.alias("wrong"), (-gap).alias("gap"), cut.alias("cut"))).alias("best"), F.min("raw").alias("least"),
                                  F.first("good_total").alias("good"), F.first("bad_total").alias("bad"))
    out = {}
    for r in found.collect():  # one row per language
        best = min(tuple(r.best), (r.good * max(1, r.bad), 0.0, r.least - 1))
        out[r.key] = (best[2], r.good, r.bad)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(documents: DataFrame, labels: DataFrame) -> ToxicNet | None:
    """Fits on the whole text of every labelled row; None without both classes.

    One labelled row in CALIBRATE, by a hash, sets the thresholds; the others fit (all do both where a part lacks a class).
    Text frequencies are counted over all of them; then shards of about SHARD_BYTES, dealt by a hash, are fitted in a task
    each from the same start, and their parameters averaged. Results do not depend on how tables are partitioned.
    """
    usable = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    # Labels may be of any number, so texts travel to them: compressed.
    read = _packed(documents.where("text <> ''").select(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("key"), "lang", "text"))
    rows = staged(read.join(usable.hint("merge"), F.col("id") == F.col("_id"))
                  .select("key", "toxic", "lang", "body", "bytes", (F.pmod("key", F.lit(CALIBRATE)) == 0).alias("held")), "labelled")
    parts = rows.groupBy("held", "toxic").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()
    if len({r.toxic for r in parts}) < 2:
        return None
    split = len(parts) == 4
    fit, held = (rows.where("NOT held"), rows.where("held")) if split else (rows, rows)
    used = [r for r in parts if not split or not r.held]
    size = np.array([sum(r.n for r in used if r.toxic == label) for label in (0, 1)])
    net = ToxicNet()
    net.start(_text_frequencies(fit), size)
    net.unflat(_averaged(fit, net, size.sum() / (2 * size), -(-sum(r.bytes for r in used) // SHARD_BYTES)))
    profiles = _profiles(rows)
    scored = staged(_raw_scores(held, net), "toxic-raw")
    cuts = best_cuts(scored.select(F.explode(F.when(F.col("lang").isNull(), F.array(F.lit(""))).otherwise(
        F.array(F.lit(""), F.concat(F.lit("="), "lang")))).alias("key"), "raw", "toxic"))
    own = [cuts.get(f"={lang}") for lang in profiles]
    net.cuts = np.array([c[0] if c and min(c[1:]) >= OWN_CUT else cuts[""][0] for c in own] or [cuts[""][0]])
    net.profiles = np.sqrt(np.stack([*profiles.values()] or [np.zeros(256)]))
    raw = F.col("raw").cast("decimal(24,8)")
    n, total, squares = scored.agg(F.count("*"), F.sum(raw), F.sum((F.col("raw") * F.col("raw")).cast("decimal(28,8)"))).first()
    net.scale = 4 / max(1e-3, float(max(0, squares / n - (total / n) ** 2)) ** .5)
    return net


def _packed(texts: DataFrame) -> DataFrame:
    """(id, key, lang, body, bytes) of (id, key, lang, text): the compressed text and its bytes before that."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [v.as_buffer() for v in b.column(3)]
            body = pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in held], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], body, pa.array([x.size for x in held], pa.int64())], names=["id", "key", "lang", "body", "bytes"])

    schema = texts.select("id", "key", "lang", F.lit(b"").alias("body"), F.lit(0).cast("long").alias("bytes")).schema
    return texts.mapInArrow(pack, schema)


def _unpacked(body: pa.Array | pa.ChunkedArray, size: pa.Array | pa.ChunkedArray) -> Iterator[list[bytes]]:
    """The texts in turn, in runs of about BLOCK_BYTES."""
    held, total = [], 0
    for v, n in zip(body, size.to_pylist()):
        held.append(pa.decompress(v.as_buffer(), decompressed_size=n, codec="zstd", asbytes=True))
        total += n
        if total >= BLOCK_BYTES:
            yield held
            held, total = [], 0
    if held:
        yield held


def _text_frequencies(rows: DataFrame) -> np.ndarray:
    """(class, bucket): in how many texts of the class the bucket is."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            y = iter(b.column(2).to_pylist())
            for held in _unpacked(b.column(0), b.column(1)):
                own, before = buckets(held)
                for t in range(len(held)):
                    seen[next(y), np.unique(own[before[t]:before[t + 1]])] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen.ravel()[at])], names=["place", "n"])

    found = rows.select("body", "bytes", "toxic").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # two rows a bucket at most
    out = np.zeros(2 * BUCKETS)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(2, BUCKETS)


def _averaged(rows: DataFrame, net: ToxicNet, weight: np.ndarray, shards: int) -> np.ndarray:
    """The parameters fitted from `net` on each shard of the rows, averaged by their numbers of rows."""
    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("body", "ascending"), ("toxic", "ascending")])
        shard, y = table["shard"][0].as_py(), table["toxic"].to_numpy().astype(np.int64)
        parts = [buckets(held) for held in _unpacked(table["body"], table["bytes"])]
        own, sizes = np.concatenate([o for o, _ in parts]), np.concatenate([np.diff(b) for _, b in parts])
        net.fit(own, np.concatenate(([0], np.cumsum(sizes))), y, weight)
        values = net.flat()
        cut = range(0, len(values), PARAM_BLOCK)
        return pa.table({"block": pa.array(range(len(cut)), pa.int32()), "shard": pa.array([shard] * len(cut), pa.int64()), "n": pa.array([len(y)] * len(cut), pa.int64()),
                         "part": pa.array([values[i:i + PARAM_BLOCK].tobytes() for i in cut], pa.binary())})

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for block, n, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                held = sums.setdefault(block, [0, 0.0])
                held[0] += n
                held[1] = held[1] + n * np.frombuffer(part.as_buffer(), np.float32).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int32()), pa.array([(v / n).tobytes() for n, v in sums.values()], pa.binary())], names=["block", "part"])

    dealt = rows.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "toxic", "body", "bytes")
    fitted = dealt.groupBy("shard").applyInArrow(fit, "block int, shard long, n long, part binary")
    # Each block's shards are added in their order.
    summed = fitted.repartition("block").sortWithinPartitions("block", "shard").select("block", "n", "part").mapInArrow(mean, "block int, part binary")
    return np.concatenate([np.frombuffer(p) for _, p in sorted((r.block, bytes(r.part)) for r in summed.collect())])


def _profiles(rows: DataFrame) -> dict[str | None, np.ndarray]:
    """Mean byte shares of the texts of each language by name; of all texts, under None, where no row has a language. Sums are of whole numbers."""
    unit = float(1 << 32)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, np.ndarray] = {}
        for b in batches:
            langs = iter(b.column(0).to_pylist())
            for data in (x for held in _unpacked(b.column(1), b.column(2)) for x in held):
                mine = sums.setdefault(next(langs), np.zeros(257, np.int64))
                mine[:256] += np.rint(language_profile(data) * unit).astype(np.int64)
                mine[256] += 1
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(v[at])], names=["lang", "place", "n"])

    out: dict[str | None, np.ndarray] = {}
    added = rows.select("lang", "body", "bytes").mapInArrow(add, "lang string, place int, n long")
    for r in added.groupBy("lang", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():  # 257 rows a language at most
        out.setdefault(r.lang, np.zeros(257))[r.place] = float(r.n)
    if len(out) > 1:
        out.pop(None, None)
    return {lang: out[lang][:256] / unit / out[lang][256] for lang in sorted(out, key=lambda x: x or "")}


def _raw_scores(rows: DataFrame, net: ToxicNet) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [net.raw(*buckets([x])) for held in _unpacked(b.column(2), b.column(3)) for x in held]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.concatenate([np.zeros(0), *raw]).astype(np.float64))], names=["lang", "toxic", "raw"])

    return rows.select("lang", "toxic", "body", "bytes").mapInArrow(score, "lang string, toxic int, raw double")


def predict(df: DataFrame, net: ToxicNet | None, text: str = "text") -> DataFrame:
    """Adds score and predicted. Null and empty texts score as texts without words; without a model all score 0."""
    if net is None:
        return df.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    schema = df.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    at = df.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.concatenate([np.zeros(0), *(net.score(held) for _, held in blocks(b.column(at)))])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= .5).astype(np.int32))], names=schema.names)

    return df.mapInArrow(score, schema)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; learns outside the held-out fold (remainder 0 of 5)."""
    net = train(documents, labels.where(fold("doc_id", 5) != 0))
    slim = documents.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return predict(slim, net).drop("text")
