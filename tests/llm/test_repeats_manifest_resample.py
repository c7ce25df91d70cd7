"""Repeated windows, the Merkle manifest and importance resampling against plain brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import common, manifest, repeats, resample, text

EDGE = [(900, None, None, None), (901, "", "en", "src1"), (902, "  \n", "en", "src1"), (903, "word", "", None), (904, "12 34", "de", "src2"),
        (None, "no id here " * 30, "de", "src2"), (None, None, None, "src1"), (903, "word", "", None), (903, "Another TEXT", "", None)]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def passages(seed=3, n=60):
    """Texts with shared passages around the window size, copies, periodic texts and a text of several pieces."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = [[word() for _ in range(size)] for size in (20, 49, 50, 51, 60, 99, 150, 400)]
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(0, 120))]
        for part in rng.sample(shared, rng.randrange(0, 3)):
            words[(at := rng.randrange(len(words) + 1)):at] = part
        out.append((i, rng.choice([" ", "\n", " \t"]).join(words), "en", "src1"))
    long = " ".join(word() for _ in range(1500))
    out += [(200, long, "en", "a"), (201, long, "en", "a"), (202, long[:4000] + " CUT " + long[4000:], "en", "a"), (150, "a " * 300, "en", "a"),
            (151, "a " * 90, "en", "a"), (152, "b " + "a b " * 70, "en", "a"), (153, "a b " * 60, "en", "a"), (201, long + " more", "en", "a"),
            (201, long, "en", "a"), (None, long, "en", "a")]
    return out


def plain_repeats(rows, window):
    split = [(repeats.NO_ID if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    least = {}
    for i, words in split:
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, words), row in zip(split, rows):
        gone = set()
        for s in range(len(words) - window + 1):
            if least[tuple(words[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((row[0], len(words), len(gone), sha(" ".join(w for k, w in enumerate(words) if k not in gone))))
    return Counter(out)


@pytest.mark.parametrize("piece_bytes", [text.PIECE_BYTES, 700])
def test_repeats_equal_brute_force(docs, monkeypatch, piece_bytes):
    """With small pieces, texts are cut many times, as texts of many megabytes are."""
    rows = passages() + EDGE
    if piece_bytes != text.PIECE_BYTES:
        monkeypatch.setattr(text.word_runs, "__defaults__", (False, 0, piece_bytes))
        monkeypatch.setattr(text.pieces, "__defaults__", (piece_bytes,))
    df = docs(rows).withColumn("key", F.lit("x")).withColumn("anchor", F.lit(1)).withColumn("spans", F.lit(1)).repartition(5)
    got = repeats.remove_repeats(df).drop("spans").collect()
    assert Counter(map(tuple, got)) == plain_repeats(rows, 50)


def test_repeats_of_other_sizes_and_empty_tables(docs):
    rows = [(1, "a b c d e", "en", "s"), (2, "x b c d y", "en", "s"), (3, "b c", "en", "s"), (4, "b c d", "en", "s")]
    got = {r.doc_id: (r.n_removed, [tuple(s) for s in r.spans]) for r in repeats.remove_repeats(docs(rows), 3, 2).collect()}
    assert got == {1: (0, []), 2: (3, [(1, 4)]), 3: (0, []), 4: (3, [(0, 3)])}
    assert repeats.remove_repeats(docs([])).count() == 0
    assert repeats.remove_repeats(docs(EDGE[:3])).count() == 3
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs([]), 3, 4)


def test_word_hashes_of_pieces_are_those_of_the_whole():
    rng = random.Random(5)
    data = " ".join("x" * rng.randrange(1, 9000) if rng.random() < .02 else f"é{rng.randrange(99)}" for _ in range(3000)).encode()
    whole = text.word_hashes(data)[0]
    parts = np.concatenate([text.word_hashes(p)[0] for p in text.pieces(data, 1000)])
    assert (whole == parts).all() and len(whole) == 3000
    same = {w: h for w, h in zip(data.split(), whole.tolist())}
    assert len(set(same.values())) == len(same)
    swapped = b"y" * 4096 + b"z" * 4096, b"z" * 4096 + b"y" * 4096
    assert len({text.word_hashes(s)[0][0] for s in swapped}) == 2


def plain_manifest(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: sha("".join(map(part, (r[0], r[3], r[2], len(r[1] or ""), t))))

    def build(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def sides(levels, i):
        for level in levels[:-1]:
            yield "".join(level[i - i % 8:i]), "".join(level[i + 1:i - i % 8 + 8])
            i //= 8

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[k] = build([leaf(r, r[1]) for r in groups[k]])
    top = build([trees[k][-1][0] for k in keys])
    out = []
    for g, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            path = [*sides(trees[k], i), *sides(top, g)]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            folded = leaf(r, r[1].translate(LOWER) if changed else r[1])
            for a, b in path:
                folded = sha(a + folded + b)
            out.append((r[0], leaf(r, r[1]), trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("n", [1, 9, 600])
def test_manifest_equals_brute_force(docs, n):
    rng = random.Random(n)
    ids = rng.sample([*range(-300, 900), *(rng.randrange(-2**63, 2**63) for _ in range(400))], n)
    rows = [(i, rng.choice(["Some Text", "lower only", "ÄÖ É", "Z" * 50]), rng.choice(["en", "de", "é", "zz"]), rng.choice(["s", None])) for i in ids]
    df = docs(rows).withColumn("key", F.lit(1)).withColumn("word", F.lit(1)).repartition(4)
    got = manifest.verify(df)
    assert Counter(tuple(r)[:7] for r in got.collect()) == plain_manifest(rows)


def test_manifest_with_nulls_repeats_and_many_groups(docs, monkeypatch):
    monkeypatch.setattr(common, "COPIES_PER_TASK", 7)
    rows = EDGE + [(5, "Same ROW", "en", "s")] * 40 + [(5, f"Text {i}", "en", "s") for i in range(30)] + [(i, "T", f"l{i % 70}", "s") for i in range(100)]
    got = manifest.verify(docs(rows).repartition(3)).collect()
    assert Counter(tuple(r)[:7] for r in got) == plain_manifest(rows)
    assert manifest.verify(docs([])).count() == 0


def test_manifest_finds_tampering(docs):
    rows = [(i, "Upper Case" if i % 2 else "no capitals", "en", "s") for i in range(100)]
    for r in manifest.verify(docs(rows)).collect():
        assert r.verified == (not (zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.doc_id % 2))


def plain_resample(rows, target, percent=10, run=(1, 1), buckets=10_000, least=20):
    def features(t):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        return len(words), [" ".join(words[i:i + n]) for n in range(run[0], run[1] + 1) for i in range(len(words) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for r in rows for f in features(r[1])[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    n, m = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets))))
    out = []
    for r in rows:
        words, fs = features(r[1])
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(sha(f"2024:{'' if r[0] is None else r[0]}")[:8], 16)
        out.append((r[0], len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32))), words >= least))
    drawn = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    take = percent * len(drawn) // 100
    ranked = [(*x[:4], k + 1 if k < take else None) for k, x in enumerate(drawn)]
    return Counter(ranked + [(*x[:4], None) for x in out if not x[4]])


@pytest.mark.parametrize("run", [(1, 1), (1, 3), (2, 2)])
def test_resampling_equals_brute_force(docs, spark, monkeypatch, run):
    monkeypatch.setattr(resample.pieces, "__defaults__", (64,))
    monkeypatch.setattr(common, "COPIES_PER_TASK", 7)
    rng = random.Random(8)
    rows = [(i, rng.choice([" ", "-", ", "]).join(f"{rng.choice('abÉzİ')}{rng.randrange(40)}" for _ in range(rng.randrange(0, 60))), "en", "s") for i in range(120)]
    rows += EDGE + [(7, "many equal rows " * 8, "en", "s")] * 40 + [(500, "x" * 5000 + " " + "\x00y\x7f" * 50, "en", "s")]
    target = ["a1 a2 a3 a4", None, "", "É5-É6"]
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    df = docs(rows).withColumn("score", F.lit(1)).withColumn("buckets", F.lit(1)).repartition(4)
    got = resample.resample(df, wanted, percent=30, run=run, buckets=500)
    assert Counter(map(tuple, got.collect())) == plain_resample(rows, target, 30, run, 500)


def test_resampling_of_nothing(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(docs([]), none).count() == 0
    assert Counter(map(tuple, resample.resample(docs(EDGE), none).collect())) == plain_resample(EDGE, [])


def test_splitter_is_the_stated_pattern():
    odd = "\x00a\x00b\x7fc\x80d é_ß`z{|}~ 0-9  x\U0001f600y İ A@[B"
    data = odd.translate(LOWER).encode()
    assert [data[a:b].decode() for a, b in resample.splitter()(data.decode())] == re.findall(resample.GAP.replace("[", "[^", 1) + "+", data.decode())
