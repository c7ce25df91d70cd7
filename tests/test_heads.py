"""Heads of groups by counted cut points against a plain sort, and the order-preserving images."""

import hashlib
import math
import random
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.columns import double_bits, double_of
from ebbtide.operators import heads, sampling, splits


def test_images_of_doubles_are_their_bits(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.0 ** -1022, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
              float("inf"), -float("inf"), 0.1, 1 / 3, 2.0 ** 52 + 1, 1e-310]
    values += [math.ldexp(1.0, e) for e in range(-1074, 1024, 7)] + [math.nextafter(math.ldexp(1.0, e), d) for e in range(-1070, 1024, 13) for d in (0, math.inf)]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", double_bits(F.col("x")).alias("image")).collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.image == (-bits if r.x < 0 else bits), r.x
        assert double_of(r.image) == r.x
    nan = spark.createDataFrame([(float("nan"),), (None,)], "x double").select(double_bits(F.col("x"))).collect()
    assert nan[0][0] == 2 ** 63 - 1 and nan[1][0] is None


def plain_heads(rows, quotas, seed=42):
    """Counter of (row, taken), rows being (g, x, y, k)."""
    def order(r):
        h = hashlib.md5(f"{'' if r[3] is None else r[3]}|{seed}".encode()).hexdigest()
        return (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or 0, h)
    out = Counter()
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=order)
        take = quotas.get(g, 0)
        out.update((r, i < take) for i, r in enumerate(own))
    return out


@pytest.mark.parametrize("few", [200_000, 20])
def test_heads_equal_a_sort(spark, monkeypatch, few):
    """With few = 20 the cuts go down digit by digit, as they do in tables of billions of rows."""
    monkeypatch.setattr(heads, "FEW_ROWS", few)
    rng = random.Random(few)
    rows = [(rng.choice([0, 1, 2, 3, None]), rng.choice([None, -1.5, 0.0, 70.35, 70.350001, rng.uniform(-100, 100)]),
             rng.choice([None, -3, 0, 5, 2 ** 40]), f"k{i}") for i in range(700)]
    rows += [(1, 99.0, 1, f"tie{i}") for i in range(120)]  # equal but for the hash
    df = spark.createDataFrame(rows, "g int, x double, y long, k string").repartition(6)
    order = heads.Order((("x", True), ("y", False)), ("k",))
    for quotas in ({0: 10, 1: 100, 2: 1}, {1: 37, 3: 5000}, {0: 0, 7: 3}, {}):
        got = Counter(((r.g, r.x, r.y, r.k), r.head) for r in heads.mark_heads(df, F.col("g"), quotas, order, "head").collect())
        assert got == plain_heads(rows, quotas)
    sums = heads.head_per_group(df, "g", {0: 10, 1: 100}, order).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in sums} == {0: 10, 1: 100}
    assert heads.mark_heads(df.limit(0), F.col("g"), {1: 5}, order, "head").count() == 0


def test_heads_with_repeated_keys_and_rows(spark, monkeypatch):
    monkeypatch.setattr(heads, "FEW_ROWS", 10)
    monkeypatch.setattr(sampling, "COPIES_PER_TASK", 50)
    same = [(1, 5.0, 1, "k", "x")] * 400 + [(1, 5.0, 1, "k", f"t{i % 90}") for i in range(270)] + [(1, 9.0, 0, "a", "y")] * 3
    df = spark.createDataFrame(same, "g int, x double, y long, k string, t string")
    order = heads.Order((("x", True), ("y", False)), ("k",))
    for take in (1, 3, 4, 100, 402, 500, 672, 673, 900):
        out = heads.mark_heads(df, F.col("g"), {1: take}, order, "head")
        assert out.count() == len(same) and out.where("head").count() == min(take, len(same))
        assert out.where("head AND k = 'a'").count() == min(3, take)
    with pytest.raises(ValueError):
        heads.mark_heads(df, F.col("g"), {1: 3}, heads.Order((("t", True),), ("k",)), "head")


def test_stress_quotas_fill_from_the_top():
    assert splits.stress_quotas({4: 10, 3: 10, 2: 10, 1: 10, 0: 10}, {4: 2, 3: 2, 2: 2}, 10) == {4: 6, 3: 2, 2: 2, 1: 0, 0: 0}
    assert splits.stress_quotas({4: 3, 3: 10, 1: 5}, {4: 2, 3: 2, 2: 2}, 15) == {4: 3, 3: 10, 1: 2}
    assert splits.stress_quotas({4: 3, 3: 1}, {4: 2, 3: 2}, 2) == {4: 2, 3: 1}
    assert splits.stress_quotas({}, {4: 2}, 2) == {}
