"""Top-k, entropy and medians without a window over few keys; digest trees; mart parts by measured counts; retention."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from caseweave.operators import compare as cmp
from caseweave.operators import merge as mg
from caseweave.operators import source as src
from caseweave.plans import base
from caseweave.registry import QUERIES
from caseweave.sources import io


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["label_granularity", "top_labels", "top_disagreements", "top_disagreement_in_stratum"])
def test_no_window_over_few_keys(spark, sf_dir, name):
    assert "Window" not in plan_of(QUERIES[name](spark, sf_dir))


def test_top_k_over_salts(spark):
    generator = random.Random(2)
    rows = [(generator.choice("xyz"), generator.randrange(50), f"l{k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, n long, label string").repartition(6)
    out = cmp.top_k(df, ["g"], [(-F.col("n")).alias("m"), F.col("label")], 7).collect()
    for g in "xyz":
        expected = sorted((-n, label) for k, n, label in rows if k == g)[:7]
        assert [tuple(r.row) for r in sorted((r for r in out if r.g == g), key=lambda r: r["rank"])] == expected
    assert cmp.top_k(df.limit(0), ["g"], [F.col("label")], 3).count() == 0


def test_medians_by_selection(spark):
    generator = random.Random(7)
    rows = [(g, generator.choice([None, round(generator.gauss(0, 3), 2), 0.5])) for g in "abc" for _ in range(generator.choice([400, 401]))]
    rows += [("one", 4.0), ("two", -1.0), ("two", 8.0), ("same", 2.0), ("same", 2.0), ("none", None), ("inf", float("inf")), ("inf", 1.0), ("inf", float("-inf"))]
    out = {r.g: r.median for r in cmp.exact_medians(spark.createDataFrame(rows, "g string, v double").repartition(5), "g", "v").collect()}
    assert out == {g: statistics.median(v for k, v in rows if k == g and v is not None) for g in {k for k, v in rows if v is not None}}


def test_equal_ranges_leave_no_ids(spark):
    source = spark.range(20_000).select(F.col("id").alias("in_id"))
    target = source.where("in_id not in (17, 9000)").unionByName(spark.createDataFrame([(50_000,), (None,)], "in_id long")).repartition(7)
    assert {(r.in_id, r.side) for r in mg.reconcile_ids(source, target).collect()} == {(17, "missing_in_target"), (9000, "missing_in_target"), (50_000, "extra_in_target")}
    s, t = mg.differing_ids(source, target)
    assert s.count() + t.count() <= 5  # of 40 000 ids
    s, t = mg.differing_ids(source, source.repartition(3))
    assert s.count() == t.count() == 0
    again = source.unionByName(source.where("in_id < 3"))  # repeated ids cost a comparison only
    assert mg.reconcile_ids(again, source).count() == 0 and 0 < mg.differing_ids(again, source)[0].count() < 20


def test_mart_parts_follow_the_rows(spark):
    driver, url = "org.apache.derby.iapi.jdbc.AutoloadedDriver", "jdbc:derby:memory:busy;create=true"
    days = [dt.datetime(2024, 1, 1 + k % 20, 5) for k in range(40)] + [dt.datetime(2024, 2, d, h) for d in range(1, 11) for h in range(24)] + [None] * 3
    df = spark.createDataFrame([(k, d, "a" if k % 2 else "b") for k, d in enumerate(days)], "in_id int, open_time timestamp, kind string")
    df.write.jdbc(url, "tickets", properties={"driver": driver, "createTableColumnTypes": "kind VARCHAR(8)"})
    mart = io.read_mart(spark, url, "tickets", partitions=4, driver=driver)
    sizes = [r["count"] for r in mart.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert mart.count() == len(days) and mart.rdd.getNumPartitions() == 4 and len(sizes) == 4 and max(sizes) < 2 * len(days) / 4
    plan = plan_of(mart.where("kind = 'a'").select("in_id"))
    assert "PushedFilters: [*IsNotNull(KIND), *EqualTo(KIND,a)]" in plan.replace("*IsNotNull(kind), *EqualTo(kind,a)", "*IsNotNull(KIND), *EqualTo(KIND,a)") and "open_time" not in plan.lower().split("readschema")[1]
    assert {r[0] for r in mart.where("open_time is null").select("in_id").collect()} == {280, 281, 282}
    df.limit(0).write.jdbc(url, "nothing", properties={"driver": driver})
    assert io.read_mart(spark, url, "nothing", driver=driver).count() == 0


def test_retention_deletes_old_runs_only(spark, tmp_path):
    names = [f"2024010{k}-000000" for k in range(1, 8)] + ["2024-01-01", "latest"]
    for name in names:
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_text("x")
    (tmp_path / "20230101-000000").write_text("a file, no folder")
    assert io.delete_runs(spark, str(tmp_path), 5) == ["20240101-000000", "20240102-000000"]
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted([*names[2:], "20230101-000000"])
    assert io.delete_runs(spark, str(tmp_path), 5) == []


def test_explainability_holds_no_percentile_buffer(spark, sf_dir):
    assert "percentile" not in plan_of(QUERIES["explainability_presence"](spark, sf_dir)) and base.QUERIES is QUERIES


def test_shapes_in_a_row(spark):
    df = spark.createDataFrame([(1, "  Abcdef ", 7.9), (2, None, None)], "k int, t string, x double")
    out = src.shaped(df, "k", {"a": ("t", "trim", "cut", 3, "upper"), "b": ("x", "whole", "text"), "c": ("t",)})
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, "ABC", "7", "  Abcdef "), (2, None, None, None)]
