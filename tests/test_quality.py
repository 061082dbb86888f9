"""Duplicates, conforming, expectations, summaries and schema reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import SchemaMismatch
from sluicegate.operators import quality
from sluicegate.operators.quality import Conform
from sluicegate.operators.schema import require_schema, schema_report


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deduplicate_keeps_the_first_in_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (None, 1, "d"), (None, 2, "e")], "k int, v int, x string")
    kept = quality.deduplicate(df, ["k"], [F.desc("v")])
    assert sorted((r.k or 0, r.v) for r in kept.collect()) == [(0, 2), (1, 7), (2, 1)]
    assert kept.columns == ["k", "v", "x"]


def test_deduplicate_does_not_depend_on_input_order(spark):
    rows = [(i % 5, i % 3, f"x{i}") for i in range(60)]
    schema = "k int, v int, x string"
    one = quality.deduplicate(spark.createDataFrame(rows, schema).repartition(1), ["k"])
    other = quality.deduplicate(spark.createDataFrame(rows[::-1], schema).repartition(7), ["k"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_deduplicate_whole_rows_and_unsortable_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "k int, m map<string, int>")
    assert quality.deduplicate(df, ["k"]).count() == 1
    assert quality.deduplicate(df.select("k"), ["k"]).count() == 1


def test_deduplicate_keeps_hot_keys_small(spark):
    """Each map task keeps one row per key before the shuffle."""
    plan = plan_of(quality.deduplicate(spark.range(100).withColumn("k", F.col("id") % 3), ["k"]))
    before_shuffle = plan[plan.index("hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle
    assert "Partial" in before_shuffle


def test_duplicate_tally(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert tuple(quality.duplicate_tally(df, ["k"]).first()) == (5, 3, 2)
    assert tuple(quality.duplicate_tally(df.limit(0), ["k"]).first()) == (0, 0, 0)


RULES = {"n": Conform("int"), "day": Conform("date"), "code": Conform("string", case="upper")}


def test_conform(spark):
    df = spark.createDataFrame([(" 1 ", "2024-01-02", " ab "), ("x", "never", None)], "n string, day string, code string")
    got = [(r.n, str(r.day), r.code) for r in quality.conform(df, RULES).collect()]
    assert got == [(1, "2024-01-02", "AB"), (None, "None", None)]
    failures = {r.column: r.n_failed for r in quality.conform_failures(df, RULES).collect()}
    assert failures == {"n": 1, "day": 1, "code": 0}


def test_conform_numbers(spark):
    df = spark.createDataFrame([(1.5,), (1e30,)], "n double")
    assert [r.n for r in quality.conform(df, {"n": Conform("int")}).collect()] == [1, None]
    assert "Exchange hashpartitioning" not in plan_of(quality.conform_failures(df, {"n": Conform("int")}))


EXPECTATIONS = {"positive": "v > 0", "known": "x IS NOT NULL"}


@pytest.fixture
def judged(spark):
    return spark.createDataFrame([(1, "a"), (-1, "b"), (None, "c"), (2, None)], "v int, x string")


def test_expectation_report(judged):
    report = {r.expectation: (r.n_passed, r.n_failed) for r in quality.expectation_report(judged, EXPECTATIONS).collect()}
    assert report == {"positive": (2, 2), "known": (3, 1)}


def test_expect_all(judged):
    assert quality.expect_all(judged, EXPECTATIONS).count() == 4
    assert [tuple(r) for r in quality.expect_all(judged, EXPECTATIONS, "drop").collect()] == [(1, "a")]
    with pytest.raises(quality.ExpectationFailure, match="positive: 2 rows"):
        quality.expect_all(judged, EXPECTATIONS, "fail")
    assert quality.expect_all(judged.where("v = 1"), EXPECTATIONS, "fail").count() == 1
    with pytest.raises(ValueError):
        quality.expect_all(judged, EXPECTATIONS, "ignore")


@pytest.mark.parametrize(("mode", "n"), [("warn", 6), ("drop", 2)])
def test_violations_are_counted_in_the_same_pass(spark, log, mode, n):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (9, "c"), (9, "c"), (3, "a")], "x int, `odd name` string")
    counts = quality.Counts()
    kept = quality.expect_all(rows, {"small": "x < 5", "named": "`odd name` = 'a'"}, mode, counts)
    assert len(kept.collect()) == n
    assert counts.get() == {"violations of small": 3, "violations of named": 4}
    counts.log(log, "write_silver", "t")
    messages = sorted(r.message for r in log.query({"status": "warning"}).collect())
    assert messages == ["t: 3 rows violate small", "t: 4 rows violate named"]


def test_unknown_columns_raise_at_once(spark):
    for mode in ("warn", "drop", "fail"):
        with pytest.raises(Exception, match="nope"):
            quality.expect_all(spark.range(3), {"e": "nope > 1"}, mode)
    assert quality.expect_all(spark.range(3), {}, "fail").count() == 3


def test_removed_duplicates_are_counted_in_the_same_pass(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "`a.b` int, `A c` string")
    counts = quality.Counts()
    kept = quality.deduplicate(rows, ["a.b"], counts=counts)
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "c")]
    assert counts.get() == {"n_rows": 3, "n_kept": 2}
    assert tuple(quality.duplicate_tally(rows, ["a.b"]).first()) == (3, 2, 1)
    assert quality.deduplicate(rows, ["A.B"]).count() == 2
    assert quality.summarize(rows, ["a.b"], {"n": "count(1)"}).count() == 2


def test_drop_is_pushed_to_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = plan_of(quality.expect_all(lines, {"q": "l_quantity > 10"}, "drop"))
    assert "l_quantity" in plan.split("PushedFilters")[1].split("]")[0]


def test_summarize(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    got = quality.summarize(df, ["k"], {"total": "sum(v)", "n": F.count(F.lit(1))}).collect()
    assert sorted(map(tuple, got)) == [("a", 3, 2), ("b", 5, 1)]


EXPECTED = T.StructType().add("id", "long").add("name", "string").add("code", "integer")


def test_schema_report(spark):
    df = spark.createDataFrame([(1, 2, None), (2, 3, "x")], "ID bigint, name int, more string")
    report = {r.column: (r.status, r.actual_type, r.n_values) for r in schema_report(df, EXPECTED, True).collect()}
    assert report == {
        "id": ("ok", "bigint", 2), "name": ("type", "int", 2), "code": ("missing", None, 0), "more": ("extra", "string", 1),
    }


def test_schema_report_reads_no_data(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    report = schema_report(lines, EXPECTED)
    assert report.columns == ["column", "expected_type", "actual_type", "status"]
    assert "FileScan" not in plan_of(report)


def test_require_schema(spark):
    good = spark.createDataFrame([], EXPECTED)
    assert require_schema(good, EXPECTED) is good
    with pytest.raises(SchemaMismatch, match="code: missing"):
        require_schema(good.drop("code"), EXPECTED)
