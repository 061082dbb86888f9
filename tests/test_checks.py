"""The five checks on real data, one by one and together."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicegate.operators import checks

DATED = "id int, day date, moment timestamp_ntz, zoned timestamp, text string"


def day_rows(*days):
    rows = []
    for i, day in enumerate(days):
        moment = dt.datetime.fromisoformat(day)
        rows.append((i, moment.date(), moment, moment, day[:10]))
    return rows


def outcome(df, known, table="t"):
    """The report, which must be the same however the table is scanned."""
    rows = checks.check_table(df, table, known).orderBy("position").collect()
    assert checks.check_table(df, table, known, one_scan=True).orderBy("position").collect() == rows
    return {r.check_name: r for r in rows}


def table_of(spark, n_rows, n_columns, n_ids):
    """A table of which rows, columns and distinct values of ``key`` are known."""
    more = [F.lit(i).alias(f"extra_{i}") for i in range(1, n_columns)]
    return spark.range(n_rows).select((F.col("id") % n_ids).alias("key"), *more)


def expected_of(n_rows, n_columns, n_ids):
    return {"n_rows": str(n_rows), "n_mbrs": str(n_columns), "n_unique_id": str(n_ids), "id_col": "key"}


@pytest.mark.parametrize("off", range(8))
def test_counts_pass_and_fail_each_by_itself(spark, off):
    """Every combination of right and wrong expectations about one table."""
    true = (37, 4, 11)
    stated = [n + (off >> bit & 1) for bit, n in enumerate(true)]
    report = outcome(table_of(spark, *true), expected_of(*stated))
    assert list(report) == ["validate_row_count", "validate_n_members", "validate_unique_id_count"]
    assert [r.passed for r in report.values()] == [s == t for s, t in zip(stated, true)]
    assert [r.message for r in report.values()] == [
        f"Expected {stated[0]} rows, got 37",
        f"Expected {stated[1]} columns, got 4",
        f"Expected {stated[2]} unique values in 'key', got 11",
    ]


@pytest.mark.parametrize("column", ["day", "moment", "zoned", "text"])
def test_date_checks(spark, column):
    df = spark.createDataFrame(day_rows("2024-01-01", "2024-02-01", "2024-03-31"), DATED)
    known = {"max_date": "2024-03-31", "min_date": "2024-01-01", "date_col": column}
    assert [r.passed for r in outcome(df, known).values()] == [True, True]
    known |= {"max_date": "2024-03-30", "min_date": "2024-01-02"}
    report = outcome(df, known)
    assert [r.passed for r in report.values()] == [False, False]
    assert report["validate_max_date"].message == (
        f"expected 2024-03-30 00:00:00 max date in '{column}', got 2024-03-31 00:00:00"
    )


@pytest.mark.parametrize("column", ["moment", "zoned"])
def test_time_of_day_fails(spark, column):
    df = spark.createDataFrame(day_rows("2024-03-31 10:00:00"), DATED)
    report = outcome(df, {"max_date": "2024-03-31", "date_col": column})
    assert not report["validate_max_date"].passed
    assert report["validate_max_date"].actual == "2024-03-31 10:00:00"


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
@pytest.mark.parametrize("column", ["day", "moment", "text"])
def test_no_dates_fail_without_error(spark, rows, column):
    df = spark.createDataFrame(rows, DATED)
    report = outcome(df, {"max_date": "2024-03-31", "min_date": "2024-01-01", "date_col": column, "n_rows": str(len(rows))})
    assert [r.passed for r in report.values()] == [True, False, False]
    assert report["validate_max_date"].actual == "None"


def test_text_dates_are_ordered_as_text(spark):
    df = spark.createDataFrame([("2024-10-01",), ("2024-9-1",)], "d string")
    report = outcome(df, {"max_date": "2024-09-01", "date_col": "d"})
    assert report["validate_max_date"].passed


def test_unreadable_text_date_is_shown(spark):
    df = spark.createDataFrame([("2024-10-01",), ("soon",)], "d string")
    report = outcome(df, {"max_date": "2024-10-01", "date_col": "d"})
    assert (report["validate_max_date"].passed, report["validate_max_date"].actual) == (False, "soon")


def test_number_is_no_date(spark):
    df = spark.createDataFrame([(20240331,)], "d int")
    report = outcome(df, {"max_date": "2024-03-31", "date_col": "d"})
    assert (report["validate_max_date"].passed, report["validate_max_date"].actual) == (False, "20240331")


@pytest.mark.parametrize(
    ("values", "n"), [([1, 1, None], 2), ([1, 2], 2), ([None, None], 1), ([], 0)]
)
def test_null_is_one_distinct_value(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "id int")
    assert checks.distinct_count(df, F.col("id")).first().n_distinct == n
    assert outcome(df, {"n_unique_id": str(n), "id_col": "id"})["validate_unique_id_count"].passed


def test_triggers(spark):
    df = table_of(spark, 3, 2, 3)
    assert outcome(df, {}) == {}
    assert outcome(df, {"number_of_rows": "3"}) == {}
    assert outcome(df, {"max_date": "2024-01-01"}) == {}  # no date_col, no check
    assert list(outcome(df, {"n_rows": "3", "id_col": "key"})) == ["validate_row_count"]


def test_bad_expectations_are_failed_checks(spark):
    known = {"n_rows": "many", "n_mbrs": None, "n_unique_id": "3", "max_date": "2024", "date_col": "key"}
    report = outcome(table_of(spark, 3, 2, 3), known)
    assert [r.passed for r in report.values()] == [False] * 4
    assert report["validate_row_count"].message == "cannot read the expected value 'many'"
    assert report["validate_unique_id_count"].message == "id_col is not given"


def test_missing_columns_are_failed_checks(spark):
    known = {"n_unique_id": "3", "id_col": "nope", "max_date": "2024-01-01", "date_col": "nope.x", "n_rows": "3"}
    report = outcome(table_of(spark, 3, 2, 3), known)
    assert report["validate_row_count"].passed
    assert report["validate_unique_id_count"].message == "column 'nope' does not exist"
    assert not report["validate_max_date"].passed


def test_column_names(spark):
    df = spark.createDataFrame([(1, (2,))], "`a.b` int, s struct<x: int>")
    for column in ("a.b", "A.B", "s.x"):
        assert outcome(df, {"n_unique_id": "1", "id_col": column})["validate_unique_id_count"].passed


def test_verdict(spark):
    report = checks.check_table(table_of(spark, 37, 5, 11), "t", expected_of(37, 4, 11))
    verdict = checks.verdicts(report).select("*", checks.report_text(F.lit("t")).alias("text")).first()
    assert (verdict.n_checks, verdict.n_passed, verdict.n_failed, verdict.passed) == (3, 2, 1, False)
    assert verdict.text.splitlines() == [
        "Validation failed for table 't': 1 of 3 checks failed",
        "  [PASS] validate_row_count: Expected 37 rows, got 37",
        "  [FAIL] validate_n_members: Expected 4 columns, got 5",
        "  [PASS] validate_unique_id_count: Expected 11 unique values in 'key', got 11",
    ]
    assert [r.check_name for r in verdict.results] == [c.name for c in checks.CHECKS[:3]]


def test_no_checks_pass(spark):
    verdict = checks.verdicts(checks.check_table(table_of(spark, 1, 1, 1), "t", {})).first()
    assert (verdict.n_checks, verdict.passed, verdict.results) == (0, True, [])


def test_measurement_reads_each_column_once_and_sorts_nothing(spark):
    """One scan per measured column, ids alone in the shuffle, no sort even for dates kept as text."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = checks.measure(df, "l_orderkey", "l_returnflag")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "ReadSchema: struct<l_returnflag:string>" in plan
    assert "Sort [" not in plan
    assert plan.count("hashpartitioning") == 1


numbers = st.none() | st.integers(0, 5)
days = st.none() | st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 9))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(numbers, days), max_size=30))
def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "id int, day date").repartition(3)
    seen = [day for _, day in rows if day]
    known = {
        "n_rows": str(len(rows)), "n_mbrs": "2", "n_unique_id": str(len({n for n, _ in rows})), "id_col": "id",
        "max_date": str(max(seen, default="")), "min_date": str(min(seen, default="")), "date_col": "day",
    }
    passed = {name: row.passed for name, row in outcome(df, known).items()}
    dated = bool(seen)
    assert passed == dict(zip([c.name for c in checks.CHECKS], [True, True, True, dated, dated], strict=True))


def test_row_formats_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "date'2024-01-01' AS day", "id AS x").write.csv(path)
    df = spark.read.schema("id long, day date, x long").csv(path)
    plan = checks.measure(df, "id", "day", one_scan=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Sort [" not in plan


def test_hot_id_is_counted_once_per_task(spark):
    """A third of all rows share one id: partial aggregation removes them before the shuffle."""
    ids = spark.range(0, 30000, numPartitions=3).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id")
    )
    assert checks.distinct_count(ids, F.col("id")).first().n_distinct == 20001
    plan = checks.distinct_count(ids, F.col("id"))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("hashpartitioning"):]
    assert "HashAggregate(keys=[id" in before_shuffle
