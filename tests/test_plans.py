"""The physical plans that the operators promise."""

import re

from rows import SF
from pyspark.sql import functions as F

from ebbtide.operators import heads, metrics as m, sampling, splits
from ebbtide.operators.features import add_domain_features, fit_features, transform_features
from ebbtide.sources.tables import write_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The executed plan without the initial plans that adaptive execution keeps beside it."""
    df.collect()
    kept, skip = [], None
    for line in plan(df).splitlines():
        indent = re.search(r"[A-Za-z=*]", line).start() if line.strip(" :+-") else 0
        if skip is not None and indent >= skip:
            continue
        skip = indent if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def lines(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_sample_is_a_map_side_predicate(spark):
    out = sampling.mark_sample(lines(spark), strata=["l_returnflag"], share=0.2, key=["l_orderkey", "l_linenumber"])
    assert "Exchange" not in plan(out) and "Join" not in plan(out)
    narrow = plan(out.select("l_orderkey", "sampled"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in narrow


def test_heads_of_groups_are_a_map_side_predicate(spark, sample, tmp_path):
    """Quotas of 5,000 rows: nothing but prefix counts is shuffled, and the marked table not at all."""
    df = lines(spark).select("l_linenumber", "l_extendedprice", "l_orderkey", "l_quantity")
    order = heads.Order((("l_extendedprice", True), ("l_quantity", False)), ("l_orderkey",))
    marked = heads.mark_heads(df, F.col("l_linenumber"), {1: 5000, 2: 700, 3: 3}, order, "head")
    assert not re.search("Exchange|Sort|Window|Join", plan(marked))
    got = {r[0]: r[1] for r in marked.where("head").groupBy("l_linenumber").count().collect()}
    assert got == {1: min(5000, df.where("l_linenumber = 1").count()), 2: 700, 3: 3}
    write_table(sample(400), str(tmp_path / "c"))
    split = splits.three_way_split(spark.read.parquet(str(tmp_path / "c")), {4: 3, 3: 20, 2: 30}, 90, 100)
    assert not re.search("Exchange|Sort|Window|Join", plan(split))
    assert {r[0]: r[1] for r in split.groupBy("batch").count().collect()} == {"stress": 90, "current": 100, "train": 210}


def test_metrics_read_the_rows_once(spark):
    df = lines(spark).select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_discount").alias("score"))
    p = final_plan(m.evaluate(df))
    assert p.count("FileScan") == 1 and p.count("ReusedExchange") == 2 and "NestedLoop" not in p and "Cartesian" not in p
    grouped = final_plan(m.evaluate(df.withColumn("model", F.lit("a")), by=["model"]))
    assert grouped.count("FileScan") == 1 and grouped.count("ReusedExchange") >= 2


def test_one_feature_reads_one_column(spark, sample, tmp_path):
    write_table(sample(50), str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    assert "ReadSchema: struct<contract:string>" in plan(add_domain_features(df, None).select("contract_risk"))
    x = transform_features(df, fit_features(df))
    assert "Exchange" not in plan(x) and "Python" not in plan(x)
