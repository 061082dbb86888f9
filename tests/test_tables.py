"""Replacing tables, promotion, owner prefixes, catalog listing and clean-up."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluicegate import (
    Layout,
    drop_prefixed,
    find_catalog,
    prefixed_tables,
    promote,
    promote_many,
    replace_table,
    resolve_prefix,
    schema_tables,
    silver_job,
)
from sluicegate.config import IngestSettings, TableRef
from sluicegate.sinks import tables
from sluicegate.sinks.tables import TRANSACTIONAL_FORMATS, History, restore_table, table_as_of, table_versions
from sluicegate.sources.catalog import PREFIX_VARIABLE
from sluicegate.sources.files import SharedFiles


def table_names(spark, layout):
    return sorted(r.table_name for r in schema_tables(spark, layout, ("bronze", "silver", "gold")).collect())


def test_replace_changes_rows_and_schema(spark, layout):
    target = layout.table("bronze", "t")
    replace_table(spark.range(5), target)
    replace_table(spark.range(2).select(F.lit("x").alias("name")), target)
    assert spark.table(target.sql).columns == ["name"]
    assert spark.table(target.sql).count() == 2
    assert table_names(spark, layout) == ["t"]


def test_failed_write_keeps_the_old_table(spark, layout):
    target = layout.table("bronze", "t")
    replace_table(spark.range(5), target)
    broken = spark.range(3).select(F.raise_error(F.lit("broken row")).cast("string").alias("x"))
    with pytest.raises(Exception, match="broken row"):
        replace_table(broken, target)
    assert spark.table(target.sql).count() == 5
    replace_table(spark.range(1), target)  # what the failed write left behind is no obstacle
    assert table_names(spark, layout) == ["t"]


def test_replace_a_table_that_is_being_read(spark, layout):
    target = layout.table("bronze", "t")
    replace_table(spark.range(5), target)
    replace_table(spark.table(target.sql).where("id > 2"), target)
    assert sorted(r.id for r in spark.table(target.sql).collect()) == [3, 4]


@pytest.mark.parametrize("name", ["previous__t", "staging__t", "t_versions"])
def test_other_tables_are_never_touched(spark, layout, name):
    other, target = layout.table("bronze", name), layout.table("bronze", "t")
    replace_table(spark.range(7), other)
    for rows in (3, 2):
        replace_table(spark.range(rows), target)
        replace_table(spark.range(rows).selectExpr("id", "'x' AS more"), target)
    assert (spark.table(other.sql).count(), spark.table(target.sql).count()) == (7, 2)
    spark.sql(f"DROP TABLE {target.sql}")
    restore_table(spark, target)
    assert table_names(spark, layout) == [name]


def versions(spark, target):
    return SharedFiles(spark).names(tables._folder(spark, target))


AT_ONCE = History(dt.timedelta(0))


def test_one_version_is_left_without_history(spark, layout):
    target = layout.table("bronze", "t")
    for rows in (1, 2, 3):
        replace_table(spark.range(rows), target, history=AT_ONCE)
    assert len(versions(spark, target)) == 1


@pytest.mark.parametrize("same_schema", [True, False])
def test_readers_keep_what_they_opened(spark, layout, same_schema):
    target = layout.table("bronze", "t")
    replace_table(spark.range(100), target)
    reader = spark.table(target.sql).where("id % 2 = 0")
    following = spark.range(3) if same_schema else spark.range(3).selectExpr("id", "'x' AS more")
    replace_table(following, target)
    replace_table(following, target)
    assert reader.count() == 50
    assert spark.table(target.sql).count() == 3


def test_reading_as_of_a_moment(spark, layout):
    target = layout.table("bronze", "t")
    before = dt.datetime.now(dt.UTC)
    moments = []
    for rows, more, kind in ((1, "id", "parquet"), (2, "id, 'x' AS more", "parquet"), (3, "id", "orc")):
        replace_table(spark.range(rows).selectExpr(*more.split(", ")), target, kind)
        moments.append(dt.datetime.now(dt.UTC))
    found = [table_as_of(spark, target, moment) for moment in moments]
    assert [df.count() for df in found] == [1, 2, 3]
    assert [df.columns for df in found] == [["id"], ["id", "more"], ["id"]]
    assert table_as_of(spark, target, moments[0].replace(tzinfo=None)).count() == 1
    with pytest.raises(LookupError):
        table_as_of(spark, target, before)
    listed = table_versions(spark, target).orderBy("written").collect()
    assert [row.is_present for row in listed] == [False, False, True]
    assert listed[0].replaced < listed[1].replaced and listed[2].replaced is None


def test_history_is_bounded(spark, layout):
    target = layout.table("bronze", "t")
    for rows in range(1, 6):
        replace_table(spark.range(rows), target, history=History(most=2))
    assert table_versions(spark, target).count() == 3
    folders = [name for name in versions(spark, target) if not name.startswith("_")]
    assert len(folders) == 3 and len(versions(spark, target)) == 5  # and the marks of two
    replace_table(spark.range(9), target, history=History(most=0))
    assert len(versions(spark, target)) == 1
    with pytest.raises(LookupError):
        table_as_of(spark, layout.table("bronze", "no_such_table"), dt.datetime.now(dt.UTC))


def test_leftovers_of_a_killed_writer_are_no_obstacle(spark, layout):
    target = layout.table("bronze", "t")
    replace_table(spark.range(1), target)
    SharedFiles(spark).make_dir(f"{tables._folder(spark, target)}/{'0' * 32}/_temporary/0")
    replace_table(spark.range(4), target, history=AT_ONCE)
    assert spark.table(target.sql).count() == 4
    assert len(versions(spark, target)) == 1


@pytest.mark.parametrize("step", ["make_dir", "drop_entry", "_create", "delete"])
@pytest.mark.parametrize("same_schema", [True, False])
def test_a_crash_at_any_step_leaves_an_old_or_a_new_table(spark, layout, monkeypatch, step, same_schema):
    target = layout.table("bronze", "t")
    replace_table(spark.range(5), target)
    following = spark.range(2) if same_schema else spark.range(2).selectExpr("id", "'x' AS more")
    with monkeypatch.context() as patch:
        where = SharedFiles if step in ("make_dir", "delete") else tables

        def killed(*args):
            raise KeyboardInterrupt

        patch.setattr(where, step, killed)
        try:
            replace_table(following, target)
        except KeyboardInterrupt:
            pass
    restore_table(spark, target)
    assert spark.table(target.sql).count() in (5, 2)
    replace_table(following, target, history=AT_ONCE)
    assert spark.table(target.sql).count() == 2
    assert len(versions(spark, target)) == 1


def test_a_table_made_otherwise_is_replaced(spark, layout):
    target = layout.table("bronze", "t")
    spark.range(6).write.saveAsTable(target.sql)
    replace_table(spark.range(2), target)
    assert spark.table(target.sql).count() == 2


@pytest.mark.parametrize("table_format", ["orc", "json", "csv"])
def test_formats(spark, layout, table_format):
    target = layout.table("bronze", "t")
    rows = spark.createDataFrame([(1, "a"), (None, "it's")], "`odd name` int, b string")
    replace_table(spark.range(3), target)
    replace_table(rows, target, table_format)
    replace_table(rows.limit(0), target, table_format)
    assert spark.table(target.sql).schema.simpleString() == rows.schema.simpleString()
    replace_table(rows, target, table_format)
    assert sorted(map(str, spark.table(target.sql).collect())) == sorted(map(str, rows.collect()))


def test_drop_removes_the_versions(spark, layout):
    target = layout.table("silver", "kim_t")
    replace_table(spark.range(3), target)
    folder = tables._folder(spark, target)
    assert len(drop_prefixed(spark, layout, "kim_")) == 1
    assert not SharedFiles(spark).exists(folder)


def test_transactional_formats_overwrite_directly(spark, layout):
    assert "delta" in TRANSACTIONAL_FORMATS
    with pytest.raises(Exception, match="(?i)delta"):  # not on this classpath
        replace_table(spark.range(1), layout.table("bronze", "t"), "delta")


def test_promote(spark, layout, log):
    bronze, silver = layout.table("bronze", "people"), layout.table("silver", "people", "roe_")
    replace_table(spark.createDataFrame([(17,), (18,), (40,)], "age int"), bronze)
    promote(spark, bronze, silver, log=log)
    assert spark.table(silver.sql).count() == 3
    promote(spark, bronze, silver, lambda df: df.where("age >= 18").withColumn("is_adult", F.lit(True)), log=log)
    assert sorted(tuple(r) for r in spark.table(silver.sql).collect()) == [(18, True), (40, True)]
    steps = [r.step for r in log.query({"status": "success"}).collect()]
    assert sorted(steps) == ["read_bronze"] * 2 + ["write_silver"] * 2


def test_a_failing_promotion_is_in_the_log(spark, layout, log):
    bronze, silver = layout.table("bronze", "people"), layout.table("silver", "people")
    with pytest.raises(Exception, match="(?i)not_found"):
        promote(spark, bronze, silver, log=log)
    replace_table(spark.range(3), bronze)
    with pytest.raises(ZeroDivisionError):
        promote(spark, bronze, silver, lambda df: 1 / 0, log=log)
    assert sorted((r.step, r.status) for r in log.query().collect()) == [
        ("read_bronze", "failure"), ("read_bronze", "success"), ("write_silver", "failure"),
    ]


def test_silver_job(spark, layout, log, monkeypatch):
    replace_table(spark.range(3), layout.table("bronze", "member"))
    target = silver_job(spark, layout, "member", "jane.roe@x.org", log=log)
    assert target == layout.table("silver", "member", "roe_")
    assert spark.table(target.sql).count() == 3
    assert silver_job(spark, layout, "member", "") == layout.table("silver", "member")
    monkeypatch.setenv(PREFIX_VARIABLE, "a.doe")
    assert silver_job(spark, layout, "member").name == "doe_member"


def test_promote_many_isolates_failures(spark, layout, log):
    bronze = layout.table("bronze", "t")
    replace_table(spark.range(4), bronze)
    good, bad = layout.table("silver", "good"), layout.table("silver", "bad")
    results = promote_many(spark, bronze, {bad: lambda df: df.select("nope"), good: None}, log=log)
    assert results[good] == "success"
    assert "nope" in results[bad]
    assert log.query({"status": "failure"}).count() == 1


# ---- addresses and settings -------------------------------------------------------------------


def test_layout():
    assert str(Layout("dev").table("silver", "member", "roe_")) == "dev.silver.roe_member"
    assert Layout(db_prefix="dev_").table("bronze", "a b`c").sql == "`spark_catalog`.`dev_bronze`.`a b``c`"
    for blank in ("", "  "):
        with pytest.raises(ValueError):
            Layout(blank)


def test_settings():
    settings = IngestSettings(Layout("dev"), "/landing", "/archive/")
    assert (settings.landing_path, settings.archive_path) == ("/landing/", "/archive/")
    assert settings.bronze("t") == TableRef(("dev", "bronze"), "t")
    with pytest.raises(AttributeError):
        settings.landing_path = "x"
    with pytest.raises(ValueError):
        IngestSettings(Layout("dev"), " ", "/archive")
    with pytest.raises(ValueError):
        IngestSettings(Layout("dev"), "/l", "/a", parallel_tables=0)


# ---- prefixes and catalogs --------------------------------------------------------------------


def test_resolve_prefix_order(spark, monkeypatch):
    monkeypatch.setenv(PREFIX_VARIABLE, "from.env@x.org")
    assert resolve_prefix("jane.roe@x.org", spark) == "roe_"
    assert resolve_prefix(spark=spark) == "env_"
    assert resolve_prefix("", spark) == ""
    monkeypatch.setenv(PREFIX_VARIABLE, "")
    assert resolve_prefix(spark=spark) == ""
    monkeypatch.delenv(PREFIX_VARIABLE)
    user = spark.sql("SELECT current_user()").first()[0]
    assert resolve_prefix(spark=spark) == resolve_prefix(user, spark)
    monkeypatch.setenv("OTHER", "a.b")
    assert resolve_prefix(spark=spark, variable="OTHER") == "b_"


def test_resolve_prefix_without_a_source(monkeypatch):
    monkeypatch.delenv(PREFIX_VARIABLE, raising=False)
    from sluicegate.sources import catalog

    monkeypatch.setattr(catalog.SparkSession, "getActiveSession", staticmethod(lambda: None))
    assert resolve_prefix("") == ""
    with pytest.raises(RuntimeError):
        resolve_prefix()


def test_find_catalog(spark):
    assert find_catalog(spark, "spark_cat") == "spark_catalog"
    with pytest.raises(IndexError):
        find_catalog(spark, "SPARK")


@pytest.fixture
def owned(spark, layout):
    """Three owners' tables in every layer; names that only look like an owner's; a temporary view."""
    for schema in ("bronze", "silver", "gold"):
        for prefix in ("kim_", "kimura_", ""):
            replace_table(spark.range(1), layout.table(schema, f"{prefix}sales"))
    replace_table(spark.range(1), layout.table("silver", "kim"))
    spark.sql("CREATE OR REPLACE TEMP VIEW kim_recent AS SELECT 1 AS x")
    return layout


def test_drop_prefixed(spark, owned):
    before = table_names(spark, owned)
    dropped = drop_prefixed(spark, owned, "kim_")
    assert sorted(name.rpartition("_")[0].rpartition(".")[2] for name in dropped) == ["kim", "kim"]
    left = table_names(spark, owned)
    assert left.count("kim_sales") == 1  # bronze has no owners
    assert sorted(left + ["kim_sales"] * 2) == sorted(before)
    assert spark.table("kim_recent").count() == 1
    assert drop_prefixed(spark, owned, "kim_") == []


def test_dry_run_and_one_schema(spark, owned):
    before = table_names(spark, owned)
    assert len(drop_prefixed(spark, owned, "kim_", dry_run=True)) == 2
    assert table_names(spark, owned) == before
    assert len(drop_prefixed(spark, owned, "KIM_", schemas=("gold",))) == 1


def test_empty_prefix_is_refused(spark, owned, monkeypatch):
    for prefix in ("", None):
        monkeypatch.setenv(PREFIX_VARIABLE, "")
        with pytest.raises(ValueError):
            drop_prefixed(spark, owned, prefix)
    assert len(table_names(spark, owned)) == 10


def test_missing_schema_is_skipped(spark, owned):
    with pytest.warns(UserWarning, match="nowhere"):
        found = prefixed_tables(spark, owned, "kimura_", ("nowhere", "gold")).collect()
    assert [r.table_name for r in found] == ["kimura_sales"]


def test_failed_drop_is_not_in_the_result(spark, owned):
    silver = owned.namespace_sql("silver")
    spark.sql(f"CREATE VIEW {silver}.kim_a_view AS SELECT 1 AS x")
    dropped = drop_prefixed(spark, owned, "kim_")
    assert len(dropped) == 2
    assert not any("kim_a_view" in name for name in dropped)
