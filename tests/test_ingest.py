"""Whole ingest runs on real files, and what is left after a step fails."""

from __future__ import annotations

import os
import threading
import time

import pyarrow as pa
import pyarrow.orc
import pytest
from pyspark.sql import types as T

from sluicegate import Ingest, LogWriteFailed, NoDataFiles, RunLog, bronze_job, outcome_frame, run_tally
from sluicegate.errors import StepFailed
from sluicegate.sinks import tables
from sluicegate.sinks.tables import replace_table
from sluicegate.sources.files import SharedFiles, run_each
from sluicegate.sources.landing import read_chunks
from tests.conftest import DAY


def put_good(box, table="good", rows=4):
    box.put(f"{table}_20240101_20240331", {"id": list(range(rows)), "day": ["2024-01-01"] * rows})
    box.put(f"{table}_20240401_20240630", {"id": list(range(rows)), "day": ["2024-06-30"] * rows})
    box.meta(table, {"n_rows": str(2 * rows), "n_mbrs": "2", "n_unique_id": str(rows), "id_col": "id",
                     "max_date": "2024-06-30", "min_date": "2024-01-01", "date_col": "day"})


def put_bad(box, table="bad"):
    box.put(table, {"id": [1, 2]})
    box.meta(table, {"n_rows": "3"})


def bronze(box, table):
    return box.spark.table(box.settings().bronze(table).sql)


def has_table(box, table):
    return box.spark.catalog.tableExists(box.settings().bronze(table).sql)


def steps(log, status):
    return sorted(r.step for r in log.query({"status": status}).collect())


def test_good_table(box, log):
    put_good(box)
    assert Ingest(box.spark, box.settings(), log).run(["good"]) == {"good": "success"}
    assert bronze(box, "good").count() == 8
    assert box.landed() == []
    assert box.archived() == [
        "good_20240101_20240331_processed20260210",
        "good_20240401_20240630_processed20260210",
        "good_processed20260210.meta",
    ]
    assert steps(log, "failure") == []
    assert steps(log, "success") == sorted([
        "archive_files", "discover_tables", "extract", "extract_table", "extract_table", "read_chunks", "read_meta",
        "validate", "validate_max_date", "validate_min_date", "validate_n_members", "validate_row_count",
        "validate_unique_id_count", "write_to_bronze",
    ])


@pytest.mark.parametrize("parallel", [1, 3])
def test_failures_stay_with_their_table(box, log, parallel):
    put_bad(box)
    put_good(box)
    box.put("no_meta", {"id": [1]})
    box.put("not_requested", {"id": [1]})
    box.put("broken", {"id": [1]})
    (box.landing_dir / "broken").write_text("not parquet")
    box.meta("broken", {"n_rows": "1"})
    names = ["bad", "absent", "no_meta", "broken", "good", "good"]
    results = Ingest(box.spark, box.settings(parallel_tables=parallel), log).run(names)
    assert list(results) == ["bad", "absent", "no_meta", "broken", "good"]
    assert results["good"] == "success"
    assert "1 of 1 checks failed" in results["bad"]
    assert "[FAIL] validate_row_count: Expected 3 rows, got 2" in results["bad"]
    assert "not found" in results["absent"]
    assert "no readable expectations" in results["no_meta"]
    assert "broken" in results["broken"]
    assert [has_table(box, t) for t in ("bad", "broken", "good", "not_requested")] == [False, False, True, False]
    assert box.landed() == ["bad", "bad.meta", "broken", "broken.meta", "no_meta", "not_requested"]
    tally = run_tally(outcome_frame(box.spark, results)).first()
    assert tuple(tally) == (1, 4, 5, "warning")
    summary = log.query({"step": "extract", "status": "warning"}).first()
    assert summary.message == "5 tables requested: 1 ingested, 4 failed"


def test_nothing_to_ingest(box, log):
    with pytest.raises(NoDataFiles):
        Ingest(box.spark, box.settings(), log).run(["t"])
    assert box.spark.table(log.table.sql).count() == 1  # the failure is in the log


def test_no_tables_requested(box, log):
    put_good(box)
    assert Ingest(box.spark, box.settings(), log).run([]) == {}
    assert tuple(run_tally(outcome_frame(box.spark, {})).first()) == (0, 0, 0, "success")
    assert len(box.landed()) == 3


def test_second_delivery_replaces_the_table(box, log):
    put_good(box)
    Ingest(box.spark, box.settings(), log).run(["good"])
    box.put("good_20240701_20240930", {"key": ["a"]})
    box.meta("good", {"n_rows": "1"})
    settings = box.settings(archive_day=DAY.replace(day=11))
    assert Ingest(box.spark, settings, log).run(["good"]) == {"good": "success"}
    assert [tuple(r) for r in bronze(box, "good").collect()] == [("a",)]


def test_failed_gate_keeps_the_old_table(box, log):
    put_good(box)
    Ingest(box.spark, box.settings(), log).run(["good"])
    box.put("good", {"id": [1], "day": ["2024-01-01"]})
    box.meta("good", {"n_mbrs": "9"})
    results = Ingest(box.spark, box.settings(), log).run(["good"])
    assert "validate_n_members" in results["good"]
    assert bronze(box, "good").count() == 8
    assert box.landed() == ["good", "good.meta"]


def test_failed_write_leaves_the_files(box, log):
    put_good(box)
    results = Ingest(box.spark, box.settings(bronze_schema="nowhere"), log).run(["good"])
    assert "nowhere" in results["good"]
    assert len(box.landed()) == 3
    assert steps(log, "failure") == ["extract", "write_to_bronze"]


def test_rows_are_in_the_log(box, log):
    put_good(box)
    box.put("plain", {"id": [1]})
    box.meta("plain", {"n_mbrs": "1"})
    Ingest(box.spark, box.settings(), log).run(["good", "plain"])
    messages = {r.message for r in log.query({"step": "read_chunks"}).collect()}
    assert messages == {"'good' was read: 2 chunks, 8 rows", "'plain' was read: 1 chunks"}


def test_run_after_a_crash_within_a_replacement(box, log, monkeypatch):
    """The new version appears in the next run, even if that run's delivery fails its gate."""
    target = box.settings().bronze("bad")
    replace_table(box.spark.range(3), target)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_create", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replace_table(box.spark.range(4).selectExpr("id", "1 AS more"), target)
    assert not has_table(box, "bad")
    put_bad(box)
    assert "1 of 1 checks failed" in Ingest(box.spark, box.settings(), log).run(["bad"])["bad"]
    assert bronze(box, "bad").count() == 4


def test_redeliveries_of_one_day_are_archived(box, log):
    for number in (1, 2, 3):
        put_good(box, rows=number)
        assert Ingest(box.spark, box.settings(), log).run(["good"]) == {"good": "success"}
        assert bronze(box, "good").count() == 2 * number
    stamps = ["_processed20260210", "_processed20260210-2", "_processed20260210-3"]
    names = ("good_20240101_20240331{}", "good_20240401_20240630{}", "good{}.meta")
    assert box.archived() == sorted(name.format(stamp) for name in names for stamp in stamps)


@pytest.mark.parametrize("day", ["20260210", "20251224"])
def test_rest_of_an_interrupted_archiving_is_no_delivery(box, log, day):
    """Without a row count in its meta the rest would pass, and replace the whole table."""
    put_good(box)
    assert Ingest(box.spark, box.settings(), log).run(["good"]) == {"good": "success"}
    put_good(box, rows=9)
    box.meta("good", {"n_mbrs": "2"})
    first = box.landing_dir / "good_20240101_20240331"
    first.rename(box.archive_dir / f"{first.name}_processed{day}-7")
    results = Ingest(box.spark, box.settings(), log).run(["good"])
    assert f"1 files of 'good' are archived as _processed{day}-7 already" in results["good"]
    assert bronze(box, "good").count() == 8
    assert len(box.landed()) == 2
    assert steps(log, "failure") == ["archive_files", "extract"]


def test_another_file_system_is_refused_at_the_start(box, log, monkeypatch):
    put_good(box)
    monkeypatch.setattr(SharedFiles, "same_system", lambda *args: False)
    with pytest.raises(StepFailed, match="different file systems"):
        Ingest(box.spark, box.settings(), log).run(["good"])
    assert not has_table(box, "good")
    assert len(box.landed()) == 3


@pytest.mark.parametrize("parallel", [1, 3])
def test_names_that_differ_in_case(box, log, parallel):
    for name, rows in (("sales", 5), ("Sales", 2)):
        box.put(f"{name}_20240101_20240331", {"id": list(range(rows))})
        box.meta(name, {"n_rows": str(rows)})
    results = Ingest(box.spark, box.settings(parallel_tables=parallel), log).run(["sales", "Sales"])
    assert results["sales"] == "success" and "differs only in case" in results["Sales"]
    assert bronze(box, "sales").count() == 5
    assert box.landed() == ["Sales.meta", "Sales_20240101_20240331"]


@pytest.mark.parametrize(
    "columns",
    [{"test": ["n_rows"], "value": ["999"]}, {"test_name": ["n_rows"], "worth": ["999"]}, {"a": []},
     {"test_name": [None, "n_rows"], "value": ["1", "2"]}],
)
def test_malformed_expectations_close_the_gate(box, log, columns):
    put_good(box)
    box.put("odd", {"id": [1, 2]})
    box.put("odd.meta", pa.table({k: pa.array(v, pa.string()) for k, v in columns.items()}))
    results = Ingest(box.spark, box.settings(), log).run(["odd", "good"])
    assert results["good"] == "success"
    assert "no readable expectations" in results["odd"]
    assert not has_table(box, "odd")
    assert box.landed() == ["odd", "odd.meta"]


def test_unknown_keys_alone_pass(box, log):
    box.put("t", {"id": [1, 2]})
    box.meta("t", {"colour": "red"})
    assert Ingest(box.spark, box.settings(), log).run(["t"]) == {"t": "success"}


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
@pytest.mark.parametrize("extra_first", [True, False])
def test_columns_of_some_chunks(box, log, file_format, extra_first):
    """A warning without a schema, a failure with one, all columns with a merge; in either order."""
    chunks = [{"id": [1], "extra": ["e"]}, {"id": [2]}]
    for number, chunk in enumerate(chunks if extra_first else chunks[::-1], 1):
        put_as(box, f"t_2024010{number}_2024010{number}", chunk, file_format)
    box.meta("t", {"n_rows": "2"})
    narrow, wide = T.StructType().add("id", "long"), T.StructType().add("id", "long").add("extra", "string")
    for schema in (narrow, wide):
        settings = box.settings(file_format=file_format, table_schemas={"t": schema})
        assert "extra" in Ingest(box.spark, settings, log).run(["t"])["t"]
        assert not has_table(box, "t")
    merged = box.settings(file_format=file_format, merge_schema=True)
    first = Ingest(box.spark, merged, log)
    first.landing.shared.move_all = lambda *batches: None  # leave the files for the next run
    assert first.run(["t"]) == {"t": "success"}
    assert sorted((r.id, r.extra) for r in bronze(box, "t").collect()) == [(1, "e"), (2, None)]
    assert Ingest(box.spark, box.settings(file_format=file_format), log).run(["t"]) == {"t": "success"}
    rows = log.query({"step": "read_chunks", "status": "warning"}).collect()
    # Spark takes the columns of one of the files; if they are the fewer, the others are named.
    assert ["extra" in r.message for r in rows] == ([] if "extra" in bronze(box, "t").columns else [True])


def put_as(box, name, chunk, file_format):
    table = pa.table(chunk)
    if file_format == "orc":
        pyarrow.orc.write_table(table, str(box.landing_dir / name))
    else:
        box.put(name, table)


@pytest.mark.parametrize(
    ("file_format", "text"),
    [("json", '{"id": 1}\nnot json at all\n'), ("json", '{"id": "abc"}\n'), ("csv", "id\n1\n2,3\n"), ("csv", "id\nabc\n")],
)
def test_broken_lines_fail_the_table(box, log, file_format, text):
    (box.landing_dir / "t").write_text(text)
    box.meta("t", {"n_mbrs": "1"})
    schema = T.StructType().add("id", "integer")
    settings = box.settings(file_format=file_format, table_schemas={"t": schema})
    assert Ingest(box.spark, settings, log).run(["t"])["t"] != "success"
    assert not has_table(box, "t")
    lenient = box.settings(file_format=file_format, table_schemas={"t": schema}, file_options={"mode": "DROPMALFORMED"})
    assert Ingest(box.spark, lenient, log).run(["t"]) == {"t": "success"}


def test_one_absent_meta_costs_little(box):
    """Absent files are known from the listing; the others are still read in one job."""
    names = [f"t{i}" for i in range(60)]
    for name in names:
        box.meta(name, {"n_rows": "1"})

    def seconds(tables):
        start = time.perf_counter()
        found = box.landing.expectations(tables)
        return time.perf_counter() - start, found

    seconds(names)
    whole = min(seconds(names)[0] for _ in range(3))
    some, found = min((seconds([*names, "none"]) for _ in range(3)), key=lambda x: x[0])
    assert isinstance(found["none"], Exception) and found["t0"] == {"n_rows": "1"}
    assert some < 1.5 * whole + 0.2


def test_many_chunks_are_planned_quickly(box, spark):
    """In a few tasks; one for each path would take some 20 seconds."""
    source = box.put("t_20000101_20000101", {"id": [1]})
    names = [f"t_{20000101 + n}_{20000101 + n}" for n in range(4000)]
    for name in names[1:]:
        os.link(source, box.landing_dir / name)
    (box.landing_dir / "sub").mkdir()
    os.link(source, box.landing_dir / "sub" / names[5])
    paths = [f"{box.landing_dir}/{name}" for name in names]
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    context = spark.sparkContext
    context.setJobGroup("planning", "listing of many paths")
    try:
        df = read_chunks(spark, paths)
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("planning") for s in tracker.getJobInfo(j).stageIds]
        tasks = [tracker.getStageInfo(stage).numTasks for stage in stages]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 16
    assert spark.conf.get(key) == before
    assert len(df.inputFiles()) == 4000 and df.sparkSession is spark
    assert df.join(spark.range(2), "id").groupBy("id").count().collect() == [(1, 4000)]


def test_failed_move_is_undone(box, log, monkeypatch):
    put_good(box)
    move = SharedFiles.move

    def failing(self, src, dest):
        if src.endswith(".meta"):
            raise OSError("denied")
        move(self, src, dest)

    monkeypatch.setattr(SharedFiles, "move", failing)
    results = Ingest(box.spark, box.settings(), log).run(["good"])
    assert "denied" in results["good"]
    assert len(box.landed()) == 3
    assert box.archived() == []
    monkeypatch.undo()
    assert Ingest(box.spark, box.settings(), log).run(["good"]) == {"good": "success"}


def test_type_clash_between_chunks_fails_the_table(box, log):
    box.put("t_20240101_20240331", {"id": [1]})
    box.put("t_20240401_20240630", {"id": ["x"]})
    box.meta("t", {"n_rows": "2"})
    results = Ingest(box.spark, box.settings(), log).run(["t"])
    assert results["t"] != "success"
    assert not has_table(box, "t")
    assert len(box.landed()) == 3


def test_files_that_arrive_during_a_run_are_left_alone(box, log, monkeypatch):
    put_good(box)
    ingest = Ingest(box.spark, box.settings(), log)
    read = ingest._read

    def late(work):
        box.put("good_20240701_20240930", {"id": [9], "day": ["2024-07-01"]})
        return read(work)

    monkeypatch.setattr(ingest, "_read", late)
    assert ingest.run(["good"]) == {"good": "success"}
    assert bronze(box, "good").count() == 8
    assert box.landed() == ["good_20240701_20240930"]


@pytest.mark.parametrize("buffer_size", [1, 200])
def test_log_that_cannot_be_written_does_not_fail_a_table(box, layout, buffer_size):
    put_good(box)
    log = RunLog("d", "p", layout.table("nowhere", "logs"), box.spark, buffer_size=buffer_size)
    with pytest.raises(LogWriteFailed) as raised:
        Ingest(box.spark, box.settings(), log).run(["good"])
    assert raised.value.results == {"good": "success"}
    assert bronze(box, "good").count() == 8
    assert len(box.archived()) == 3


def test_table_name_that_is_no_identifier_fails_alone(box, log):
    box.put("my table-1_20240101_20240331", {"id": [1]})
    box.meta("my table-1", {"n_rows": "1"})
    put_good(box)
    results = Ingest(box.spark, box.settings(), log).run(["my table-1", "good"])
    assert results["good"] == "success"
    assert results["my table-1"] != "success"
    assert len([name for name in box.landed() if name.startswith("my")]) == 2


def test_bronze_job(box, log):
    put_good(box)
    put_bad(box)
    assert bronze_job(box.spark, box.settings(), ["good", "bad"], log) == 1
    assert log.query({"step": "pipeline"}).first().message == "1 of 2 tables failed: bad"
    put_good(box, "fine")
    assert bronze_job(box.spark, box.settings(), ["fine"], log) == 0


def test_wrong_schema_fails_before_the_checks(box, log):
    put_good(box)
    wanted = T.StructType().add("id", "long").add("day", "date")
    results = Ingest(box.spark, box.settings(table_schemas={"good": wanted}), log).run(["good"])
    assert "day: type (expected date, got string)" in results["good"]
    assert not has_table(box, "good")
    assert log.query({"step": "validate_row_count"}).count() == 0


def test_csv_ingest(box, log):
    (box.landing_dir / "t_20240101_20240331").write_text("id,name\n1,a\n2,b\n")
    box.meta("t", {"n_rows": "2", "n_mbrs": "2"})
    schema = T.StructType().add("id", "integer").add("name", "string")
    settings = box.settings(file_format="csv", table_schemas={"t": schema})
    assert Ingest(box.spark, settings, log).run(["t"]) == {"t": "success"}
    assert sorted(tuple(r) for r in bronze(box, "t").collect()) == [(1, "a"), (2, "b")]


def test_meta_directory_is_archived(box, log):
    box.put("t", {"id": [1]})
    frame = box.spark.createDataFrame([("n_rows", "1")], "test_name string, value string")
    frame.coalesce(1).write.parquet(f"{box.landing_dir}/t.meta")
    assert Ingest(box.spark, box.settings(), log).run(["t"]) == {"t": "success"}
    assert "t_processed20260210.meta" in box.archived()


def test_run_each(spark):
    assert run_each(spark, lambda x: x * 2, [1, 2, 3], 2) == [2, 4, 6]
    assert run_each(spark, lambda x: threading.current_thread().name, [1], 4) == ["MainThread"]
