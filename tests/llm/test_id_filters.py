"""Rows are picked by id where they lie: exactly, and without a shuffle of their texts."""

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import common, jaccard


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few, bits", [(10_000, 24), (3, 24), (3, 1)])
def test_among_is_exact(spark, monkeypatch, few, bits):
    monkeypatch.setattr(common, "FEW_IDS", few)
    monkeypatch.setattr(common, "BITS_PER_ID", bits)
    monkeypatch.setattr(common, "MAP_BITS", 1 << 15)
    wanted = set(range(-9000, 9000, 3)) | {2**63 - 1, -2**63}
    universe = common.staged(spark.createDataFrame([(i,) for i in [*range(-20_000, 20_000), 2**63 - 1, -2**63]], "id long"), "universe")
    ids = common.staged(spark.createDataFrame([(i,) for i in wanted], "id long"), "ids")
    may, exact = common.may_be_among(ids), common.among(ids, universe)
    rows = universe.unionByName(spark.createDataFrame([(None,)], "id long"))
    found = rows.select("id", common.passes(may, F.col("id")).alias("may"), common.passes(exact, F.col("id")).alias("among")).collect()
    assert all(r["may"] for r in found if r["id"] in wanted)
    assert {r["id"] for r in found if r["among"]} == wanted
    assert [r["among"] for r in found if r["id"] is None] == [False]
    if (few, bits) == (3, 1):  # the filter alone lets others through
        assert sum(r["may"] for r in found) > len(wanted)


def test_more_ids_than_a_filter_tells_apart(spark, monkeypatch, docs):
    for name, value in (("FEW_IDS", 0), ("FILTER_BITS", 4)):
        monkeypatch.setattr(common, name, value)
    ids = common.staged(spark.range(1), "ids")
    assert common.may_be_among(ids) is None and common.among(ids, ids) is None
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "a"), (2, text + " more", "en", "a"), (3, "other words", "en", "a"), (None, text, "en", "a")]
    assert sorted(r.doc_id or 0 for r in jaccard.keep_one(docs(rows)).collect()) == [0, 1, 3]


@pytest.mark.parametrize("few", [10_000, 1])
def test_keep_one_shuffles_no_texts(spark, monkeypatch, docs, few):
    monkeypatch.setattr(common, "FEW_IDS", few)
    made = {}

    def staged(df, name):
        made.setdefault(name, []).append(plan(df))
        return common.staged(df, name)

    monkeypatch.setattr(jaccard, "staged", staged)
    rows = [(100 * g + i, " ".join(f"w{g}x{j}" for j in range(60)) + f" end{i}", "en", "a") for g in range(8) for i in range(3)] + [(None, "w", "en", "a")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables of ids outgrow any threshold
    try:
        kept = jaccard.keep_one(docs(rows))
        assert "Exchange" not in plan(kept) and made["sets"] and all("Exchange" not in p for p in made["sets"])
        assert "ArrowEvalPython" in made["open-keys"][0] and "ArrowEvalPython" in made["open-rows"][0]  # members go before these joins
        assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [100 * g for g in range(8)]
        assert kept.where("doc_id IS NULL").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
