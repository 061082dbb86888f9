"""Listing, manifest, expectations and chunk union on real files."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException

from sluicegate import Landing, read_chunks
from sluicegate.errors import MetaUnreadable, StepFailed
from sluicegate.queries import staging
from sluicegate.queries.staging import stage_chunks, workspace
from tests.conftest import DAY, SF_DIR

ONE = {"id": [1]}


def test_manifest(box):
    """Tables of one to four files, some of them plain, some with a meta file, in mixed order."""
    expected = {}
    for number, table in enumerate(("ledger", "b_2", "Zone", "late bids"), 1):
        days = [(f"2019{month:02d}01", f"2019{month:02d}28") for month in range(number, 0, -1)]
        for first, last in days:
            box.put(f"{table}_{first}_{last}", ONE)
        if number % 2:
            box.put(table, ONE)
        else:
            box.meta(table, {"n_rows": "1"})
        expected[table] = (number + number % 2, "20190101", f"2019{number:02d}28")
    box.put("single", ONE)
    expected["single"] = (1, None, None)
    rows = box.landing.manifest().collect()
    assert {r.table_name: (r.n_files, r.first_start, r.last_end) for r in rows} == expected


def test_empty_and_meta_only(box):
    assert box.landing.manifest().count() == 0
    box.meta("t", {"n_rows": "1"})
    assert box.landing.manifest().count() == 0


def test_missing_directory(spark, tmp_path):
    with pytest.raises(AnalysisException):
        Landing(spark, str(tmp_path / "nowhere")).listing()


def test_only_files_directly_in_the_directory_count(box):
    """A key=value directory must not hide the files beside it."""
    box.put("t", ONE)
    for folder in ("dt=1", "nested"):
        (box.landing_dir / folder).mkdir()
        box.put(f"{folder}/u", ONE)
    assert [r.table_name for r in box.landing.manifest().collect()] == ["t"]


def test_hidden_names_are_not_discovered(box):
    box.put("_t_20240101_20240331", ONE)
    assert box.landing.data_files().count() == 0


def test_names_with_special_characters(box):
    box.put("a[1]{x} +%20*?_20240101_20240331", {"id": [1, 2]})
    box.put("a[1]{x} +%20*?_20240401_20240630", {"id": [3]})
    box.meta("a[1]{x} +%20*?", {"n_rows": "3"})
    table = box.landing.manifest().first().table_name
    assert table == "a[1]{x} +%20*?"
    assert box.landing.chunks(table).count() == 3
    assert box.landing.expectations([table]) == {table: {"n_rows": "3"}}


def test_trailing_slash(box, spark):
    box.put("t", ONE)
    assert Landing(spark, f"{box.landing_dir}/").manifest().count() == 1


def test_requested(box):
    box.put("t", ONE)
    rows = box.landing.requested(["t", "u"]).collect()
    assert {r.table_name: r.found for r in rows} == {"t": True, "u": False}


def test_work_list(box):
    box.put("t_20240101_20240331", ONE)
    box.put("other", ONE)
    rows = box.landing.work_list(["t"], str(box.archive_dir), DAY).collect()
    assert sorted((r.kind, r.src.rpartition("/")[2], r.dest.rpartition("/")[2]) for r in rows) == [
        ("chunk", "t_20240101_20240331", "t_20240101_20240331_processed20260210"),
        ("meta", "t.meta", "t_processed20260210.meta"),
    ]


def test_chunks_union_by_name_and_keep_duplicates(box):
    box.put("t_20240101_20240331", {"id": [1, 1], "x": ["a", "a"]})
    box.put("t_20240401_20240630", {"x": ["b"], "id": [2]})
    rows = [(r.id, r.x) for r in box.landing.chunks("t").collect()]
    assert sorted(rows) == [(1, "a"), (1, "a"), (2, "b")]


def test_extra_column_needs_merge(box):
    box.put("t_20240101_20240331", {"id": [1]})
    box.put("t_20240401_20240630", {"id": [2], "extra": ["e"]})
    merged = box.landing.chunks("t", merge_schema=True)
    assert sorted(merged.columns) == ["extra", "id"]
    assert sorted((r.id, r.extra) for r in merged.collect()) == [(1, None), (2, "e")]
    assert box.landing.chunks("t").count() == 2


def test_chunk_range(box):
    for i, name in enumerate(["t_20240101_20240331", "t_20240401_20240630", "t_20240701_20240930", "t"]):
        box.put(name, {"id": [i]})

    def ids(**days):
        return sorted(r.id for r in box.landing.chunks("t", **days).collect())

    assert ids() == [0, 1, 2, 3]
    assert ids(since=dt.date(2024, 6, 30)) == [1, 2, 3]
    assert ids(until=dt.date(2024, 4, 1)) == [0, 1, 3]
    assert ids(since=dt.date(2024, 5, 1), until=dt.date(2024, 5, 2)) == [1, 3]


def test_damaged_chunk_is_an_error_whatever_the_session_says(box, spark):
    box.put("t_20240101_20240331", {"id": [1]})
    (box.landing_dir / "t_20240401_20240630").write_bytes(b"PAR1 cut off PAR1")
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", True)
    try:
        with pytest.raises(Exception):
            box.landing.chunks("t").select("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")


def test_chunks_of_unknown_table(box):
    box.put("t", ONE)
    with pytest.raises(StepFailed):
        box.landing.chunks("u")


def test_meta_last_duplicate_wins_and_unknown_keys_are_ignored(box):
    box.put("t.meta", {"test_name": ["n_rows", "zzz", "n_rows"], "value": ["1", "x", "2"]})
    assert box.landing.expectations(["t"]) == {"t": {"n_rows": "2"}}
    assert box.landing.meta(["t"]).count() == 3


def test_meta_null_value_is_present(box):
    box.put("t.meta", pa.table({"test_name": ["n_rows"], "value": pa.array([None], pa.string())}))
    assert box.landing.expectations(["t"]) == {"t": {"n_rows": None}}


def test_one_bad_meta_fails_one_table(box):
    box.meta("good", {"n_rows": "1"})
    (box.landing_dir / "bad.meta").write_text("this is not parquet")
    found = box.landing.expectations(["good", "bad", "none"])
    assert found["good"] == {"n_rows": "1"}
    assert isinstance(found["bad"], Exception)
    assert isinstance(found["none"], MetaUnreadable)


def test_meta_with_numbers_and_as_directory(box, spark):
    box.put("n.meta", {"test_name": ["n_rows"], "value": pa.array([12])})
    frame = spark.createDataFrame([("n_rows", "7"), ("id_col", "id")], "test_name string, value string")
    frame.coalesce(1).write.parquet(f"{box.landing_dir}/d.meta")
    found = box.landing.expectations(["n", "d"])
    assert found == {"n": {"n_rows": "12"}, "d": {"n_rows": "7", "id_col": "id"}}


@pytest.mark.parametrize("file_format", ["csv", "json", "orc"])
def test_other_formats(spark, file_format):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    landing = f"{workspace(spark)}/landing"
    stage_chunks(orders, landing, "orders", file_format=file_format)
    back = Landing(spark, landing).chunks("orders", file_format=file_format, schema=orders.schema)
    assert back.exceptAll(orders).count() == 0
    assert orders.exceptAll(back).count() == 0


def test_csv_header_must_agree(box, spark):
    (box.landing_dir / "t_20240101_20240331").write_text("id,x\n1,2\n")
    (box.landing_dir / "t_20240401_20240630").write_text("x,id\n1,2\n")
    with pytest.raises(Exception, match="header|CSV"):
        box.landing.chunks("t", file_format="csv", schema="id int, x int").collect()


def test_staged_years_split_into_parts_keep_every_row(spark):
    """Forced small partitions: a year of several files, all of them in the same table."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    landing = f"{workspace(spark)}/landing"
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, False)
    try:
        stage_chunks(orders.repartition(3), landing, "orders", orders.o_orderdate)
    finally:
        spark.conf.set(key, True)
    assert Landing(spark, landing).chunks("orders").count() == orders.count()


def test_staging_does_not_shuffle_rows(spark, monkeypatch, tmp_path):
    """A small table is one chunk a year, whatever its files; a large one is written by the tasks that read it."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    orders.repartition(3).write.parquet(f"{tmp_path}/some orders")
    given = spark.read.parquet(f"{tmp_path}/some orders")
    key = "spark.sql.files.openCostInBytes"
    for most, chunks in ((1 << 26, 7), (1, 21)):
        monkeypatch.setattr(staging, "TASK_BYTES", most)
        landing = f"{workspace(spark)}/landing"
        spark.conf.set(key, "128m")
        try:
            stage_chunks(given, landing, "orders", given.o_orderdate)
        finally:
            spark.conf.unset(key)
        back = Landing(spark, landing).chunks("orders")
        assert len(back.inputFiles()) == chunks
        assert back.exceptAll(orders).count() == orders.exceptAll(back).count() == 0


def test_read_chunks_never_reads_contents_for_listing(box):
    box.put("t", {"id": list(range(1000))})
    plan = box.landing.listing()._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_dates_of_archive_plan(box, spark):
    frame = spark.createDataFrame([("/l/t",)], "src string")
    from sluicegate.sources.landing import archive_plan

    assert archive_plan(frame, "/a", dt.date(2024, 1, 2)).first().dest == "/a/t_processed20240102"


def test_read_chunks_with_explicit_paths(box, spark):
    paths = [box.put("x_20240101_20240102", {"id": [1]}), box.put("x_20240103_20240104", {"id": [2]})]
    assert read_chunks(spark, paths).count() == 2
