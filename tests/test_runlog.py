"""The run log: events, buffering, queries."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from sluicegate import LogWriteFailed, RunLog
from sluicegate.sinks.runlog import LOG_SCHEMA


def test_arguments(spark, layout, log):
    table = layout.table("ua", "logs")
    for domain, process in (("", "p"), ("d", "")):
        with pytest.raises(ValueError):
            RunLog(domain, process, table, spark)
    for step, status, message in (("", "success", "m"), ("s", "success", ""), ("s", "invalid", "m")):
        with pytest.raises(ValueError):
            log.event(step, status, message)


def test_without_a_session(layout, monkeypatch):
    from sluicegate.sinks import runlog

    monkeypatch.setattr(runlog.SparkSession, "getActiveSession", staticmethod(lambda: None))
    with pytest.raises(RuntimeError):
        RunLog("d", "p", layout.table("ua", "logs"))


def test_active_session_is_found(spark, layout):
    assert RunLog("d", "p", layout.table("ua", "logs")).spark is not None


def test_three_statuses(log):
    log.success("a", "fine")
    log.warning("b", "hm")
    log.failure("c", "no")
    rows = {r.status: r for r in log.query().collect()}
    assert {s: r.message for s, r in rows.items()} == {"success": "fine", "warning": "hm", "failure": "no"}
    row = rows["success"]
    assert (row.domain, row.process, row.step, row.source, row.user) == ("tests", "unit", "a", "tests", log.user)
    assert log.query().columns == LOG_SCHEMA.fieldNames()


EVENTS = [(step, status) for step in ("load", "merge", "ship") for status in ("success", "warning", "failure")] * 2


@pytest.fixture
def filled(log):
    for number, (step, status) in enumerate(EVENTS):
        log.event(step, status, f"event {number}")
    return log


def test_filters(filled):
    """Every set of given columns finds the events that a plain loop finds."""
    for step in (None, "load", "none such"):
        for status in (None, "failure"):
            for message in (None, "event 2", "event 3"):
                given = {k: v for k, v in (("step", step), ("status", status), ("message", message)) if v}
                expected = [
                    n for n, (a, b) in enumerate(EVENTS)
                    if step in (None, a) and status in (None, b) and message in (None, f"event {n}")
                ]
                found = filled.query(given).select("message").collect()
                assert sorted(r.message for r in found) == sorted(f"event {n}" for n in expected), given
    assert filled.query(None).count() == len(EVENTS)
    assert filled.query({"source": None}).count() == 0


def test_limits(filled):
    counts = [filled.query(limit=limit).count() for limit in (None, 0, 1, 17, 18, 19)]
    assert counts == [18, 18, 1, 17, 18, 18]
    assert filled.query({"step": "ship"}, limit=5).count() == 5
    assert filled.query({"step": "ship"}, limit=7).count() == 6


def test_filters_reach_the_scan(filled):
    plan = filled.query({"status": "failure"})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,failure)" in plan


def test_unknown_column_and_missing_table(filled, spark, layout):
    with pytest.raises(RuntimeError):
        filled.query({"nope": 1})
    with pytest.raises(RuntimeError):
        RunLog("d", "p", layout.table("ua", "nothing"), spark).query()


def test_messages_are_kept(log):
    """Quotes, control characters and letters of many scripts, alone and in one long text."""
    pieces = ["`a`", '"', "\\n", "\r\n", "\x00", "%s {x}", "ключ", "مفتاح", "鍵", "🔑"]
    messages = [*pieces, "|".join(pieces) * 700]
    for message in messages:
        log.success("s", message)
    assert sorted(r.message for r in log.query().collect()) == sorted(messages)


def test_source_override(log):
    log.success("s", "m", source="elsewhere.py")
    log.success("s", "m")
    assert sorted(r.source for r in log.query().collect()) == ["elsewhere.py", "tests"]


def test_moment_is_that_of_the_event(log):
    before = dt.datetime.now()
    log.success("s", "m")
    after = dt.datetime.now()
    row = log.query().first()
    assert row.date == before.date().isoformat()
    assert before <= row.time <= after


def files_of(log):
    return len(log.spark.table(log.table.sql).inputFiles())


def test_one_append_per_flush(log):
    for i in range(20):
        log.success("s", f"{i}")
    log.flush()
    log.flush()  # nothing waits
    assert files_of(log) == 1


def test_threads_share_a_log(log):
    def work(number):
        for i in range(5):
            log.success("s", f"{number} {i}")
            log.flush(wait=False)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    messages = [r.message for r in log.query().collect()]
    assert sorted(messages) == sorted(f"{n} {i}" for n in range(6) for i in range(5))


def test_full_buffer_is_written(spark, layout):
    log = RunLog("d", "p", layout.table("ua", "logs"), spark, buffer_size=2)
    for i in range(3):
        log.success("s", f"{i}")
    assert spark.table(log.table.sql).count() == 2


def test_context_manager_keeps_events_of_a_failing_run(spark, layout):
    table = layout.table("ua", "logs")
    with pytest.raises(KeyError), RunLog("d", "p", table, spark) as log:
        log.failure("s", "m")
        raise KeyError
    assert spark.table(table.sql).count() == 1


def test_failed_flush_keeps_the_events(spark, layout):
    log = RunLog("d", "p", layout.table("nowhere", "logs"), spark)
    log.success("s", "m")
    with pytest.raises(LogWriteFailed):
        log.flush()
    log.table = layout.table("ua", "logs")
    assert log.query().count() == 1


def test_append_frame_in_any_column_order(spark, log):
    log.success("s", "m")
    rows = log.query()
    log.append(rows.select(*reversed(rows.columns)).withColumn("step", F.lit("copied")))
    assert sorted(r.step for r in log.query().collect()) == ["copied", "s"]


def test_partitioned_log_prunes(spark, layout):
    log = RunLog("d", "p", layout.table("ua", "logs"), spark, partition_by=("date",))
    log.success("s", "m")
    query = log.query({"date": dt.date.today().isoformat()})
    assert query.count() == 1
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
