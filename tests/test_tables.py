import pytest
from rows import customer
from pyspark.sql import functions as F

from ebbtide.functions.columns import level_of, number, with_cut_index
from ebbtide.operators import runs
from ebbtide.operators.lookup import describe_batches, pool, without
from ebbtide.sources import tables as t
from ebbtide.sources.schema import CANONICAL, RAW_HEADINGS


def test_numbers_are_coerced_like_a_table_reader(spark):
    texts = {"12": 12.0, " 1.5 ": 1.5, "1e3": 1000.0, ".5": 0.5, "": None, " ": None, "abc": None, "12d": None,
             "1f": None, "0x1p3": None, "NaN": None, "1,5": None, "inf": float("inf"), "-3.": -3.0}
    df = spark.createDataFrame([(k,) for k in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", number(F.col("t"))).collect()} == texts


def test_csv_is_read_by_name_with_missing_texts(spark, tmp_path):
    names = [k for k in RAW_HEADINGS][::-1] + ["Extra"]
    by_raw = {k: customer()[v] for k, v in RAW_HEADINGS.items()}
    lines = [",".join(f'"{n}"' for n in names)]
    for total in ("10.5", " ", "n/a"):
        row = {**by_raw, "Total Charges": total, "Extra": "1"}
        lines.append(",".join(f'"{row[n]}"' for n in names))
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    df = t.read_customers(spark, str(tmp_path / "raw.csv"), "csv")
    assert tuple(df.columns) == CANONICAL
    assert sorted(r["total_charges"] or 0 for r in df.collect()) == [0, 0, 10.5]


def test_missing_column_and_bad_label(make):
    with pytest.raises(ValueError, match="the table lacks"):
        t.canonicalise(make([customer()]).drop("gender"))
    with pytest.raises(Exception, match="not an integer"):
        t.canonicalise(make([customer(churn=None)])).collect()


def test_batch_names(make):
    df = make([customer(), customer(1)]).withColumn("batch", F.lit("stress"))
    assert t.named_batch(df, "stress").count() == 2
    with pytest.raises(ValueError, match="current, stress"):
        t.named_batch(df, "train2")


def test_splits_are_written_once(spark, sample, tmp_path):
    root = str(tmp_path / "splits")
    options = dict(quotas={4: 2, 3: 2}, stress_size=10, current_size=20)
    first = t.ensure_splits(spark, root, sample(100), **options)
    assert {r["batch"]: r["count"] for r in first.groupBy("batch").count().collect()} == {
        "stress": 10, "current": 20, "train": 70}
    assert t.ensure_splits(spark, root, sample(50, seed=1), **options).count() == 100
    assert t.ensure_splits(spark, root, sample(50, seed=1), force=True, **options).count() == 50


def test_batch_filter_prunes_partitions(spark, sample, tmp_path):
    root = str(tmp_path / "splits")
    df = t.ensure_splits(spark, root, sample(60), quotas={4: 2}, stress_size=5, current_size=9)
    plan = t.named_batch(df, "stress").select("churn")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "ReadSchema: struct<churn:int>" in plan


def test_describe_and_pool(make):
    df = make([customer(i, churn=i % 2) for i in range(4)]).withColumn(
        "batch", F.when(F.col("churn") == 1, "stress").otherwise("train"))
    assert {r["batch"]: r["churn_delta"] for r in describe_batches(df).collect()} == {"train": 0.0, "stress": 1.0}
    assert pool(df, df).count() == 8 and without(df, df.where("churn = 1")).count() == 2
    with pytest.raises(Exception):
        pool(df, df.drop("churn")).count()


def test_cut_indices_are_binary_searches(spark):
    cuts = [0.1, 0.2, 0.2, 0.5, 0.9]
    values = [None, float("nan"), *(x / 20 for x in range(-2, 24))]
    df = spark.createDataFrame([(x,) for x in values], "v double")
    for n in (1, 3, 5):
        at = df.withColumn("reached", level_of(cuts[:n], F.col("v"))).withColumn("cuts", F.array(*[F.lit(c) for c in cuts[:n]]))
        for r in with_cut_index(at, "cuts", "v", n, "below").collect():
            if r.v is None:
                assert (r.reached, r.below) == (0, 0)
            elif r.v != r.v:
                assert (r.reached, r.below) == (n, n)
            else:
                assert (r.reached, r.below) == (sum(c <= r.v for c in cuts[:n]), sum(c < r.v for c in cuts[:n]))
    sweep = df.select(level_of([i / 100 for i in range(65)], F.col("v")).alias("n"))
    assert "*(1) Project" in sweep._jdf.queryExecution().executedPlan().toString() and "lambda" not in sweep._jdf.queryExecution().executedPlan().toString()


def test_cut_index_stays_small_as_one_expression(spark):
    df = spark.range(1).select((F.col("id") + 0.5).alias("v"), F.array_repeat(F.col("id") + 0.1, (F.col("id") + 1).cast("int")).alias("cuts"))
    pushed = with_cut_index(df, "cuts", "v", 127, "below").where("below >= 0")  # the filter goes below the steps
    assert len(pushed._jdf.queryExecution().optimizedPlan().toString()) < 50_000
    assert pushed.first()["below"] == 1


def test_runs_versions_and_lineage(spark, tmp_path):
    home = str(tmp_path)
    runs.log_run(spark, f"{home}/runs", "e", "a" * 32, "first", {"model": "XGB"}, {"f1": 0.65, "recall": 0.7}, 1000)
    runs.log_run(spark, f"{home}/runs", "e", "b" * 32, "second", {}, {"f1": 0.5}, 90_000_000)
    listed = runs.list_runs(runs.wide_runs(spark.read.parquet(f"{home}/runs"))).collect()
    assert [(r["run_name"], r["run_id"], r["f1"], r["recall"], r["model"], r["time"]) for r in listed] == [
        ("second", "b" * 12, 0.5, 0.0, "LightGBM", "1970-01-02 01:00"), ("first", "a" * 12, 0.65, 0.7, "XGB", "1970-01-01 00:00")]
    assert [runs.register_and_promote(spark, f"{home}/v", "m", r) for r in ("r1", "r2")] == [1, 2]
    stages = runs.current_versions(runs.read_events(spark, f"{home}/v"))
    assert {r["version"]: r["stage"] for r in stages.collect()} == {1: "archived", 2: "production"}
    assert runs.production_version(stages).first()["run_id"] == "r2"
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    assert len(runs.file_checksums(spark, f"{home}/a.csv").first()["checksum"]) == 16
    df = spark.range(100)
    assert runs.fingerprint(df.repartition(7)) == runs.fingerprint(df) != runs.fingerprint(df.where("id > 0"))
    r = runs.record_lineage(spark, f"{home}/l", "m", "t", "1", "c", "2", "run", extra={"k": 1})
    assert r["run_id"] == "run" and spark.read.json(f"{home}/l").count() == 1


def test_csv_keeps_quotes_inside_fields(spark, tmp_path):
    from ebbtide.sources.tables import read_csv, write_table
    rows = [('x "y" z', "1"), ('a, "b"', "2")]
    write_table(spark.createDataFrame(rows, "name string, n string"), str(tmp_path / "q"), "csv")
    assert sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "q")).collect()) == sorted(rows)


def test_last_logged_value_wins(spark, tmp_path):
    for cost in (9, 10, 9):
        runs.log_run(spark, str(tmp_path / "r"), "e", "a", "n", {"f1": "parameter"}, {"total_business_cost": cost, "f1": 0.5}, 1)
    row = runs.wide_runs(spark.read.schema(runs.RUN_SCHEMA).parquet(str(tmp_path / "r"))).first()
    assert (row["total_business_cost"], row["f1"]) == ("9", "0.5")
    with pytest.raises(Exception, match="(?i)parquet|infer|schema|read|footer"):
        (tmp_path / "bad").mkdir()
        (tmp_path / "bad" / "x.parquet").write_text("broken")
        runs.read_events(spark, str(tmp_path / "bad")).collect()
    assert runs.read_events(spark, str(tmp_path / "none")).count() == 0
