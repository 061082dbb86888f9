"""File names, owner prefixes and parsing, against plain-Python statements of the same rules."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicegate.functions import naming, parsing

quick = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def evaluate(spark, values, *columns):
    """Apply expressions over a column ``v`` to many values in one job."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(row)[1:] for row in df.select("i", *columns).orderBy("i").collect()]


def named_cases():
    """(file name, kind, table): every stem with every ending, by the rules for names."""
    cases = []
    for stem in ("k", "north_wind", "Q7__z", "two words", "tail-end", "7up", "_low", "x_2020", "é"):
        identifier = re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", stem) is not None
        for first, last in (("20200229", "20211231"), ("00000000", "99999999")):
            cases.append((f"{stem}_{first}_{last}", "chunk", stem))
            cases.append((f"{stem}_{first}_{last}.meta", "meta", f"{stem}_{first}_{last}"))
            cases.append((f"{stem}_{first}_{last}.parquet", "ignored", None))
        for ending in ("", "_2020_2021", "_20200229", "_20200229_2021123"):
            cases.append((stem + ending, *(("plain", stem + ending) if identifier else ("ignored", None))))
        cases += [(f"{stem}.meta", "meta", stem), (f"{stem}.meta.old", "ignored", None), (f".{stem}", "ignored", None)]
    return cases + [("_20200229_20211231", "plain", "_20200229_20211231"), ("", "ignored", None)]


NAMES = named_cases()


def test_names(spark):
    v = F.col("v")
    got = evaluate(spark, [n for n, _, _ in NAMES], naming.name_kind(v), naming.table_of(v))
    assert got == [(kind, table) for _, kind, table in NAMES]


def python_table(name):
    if "." in name:
        return None
    found = re.fullmatch(r"(.+?)_(\d{8})_(\d{8})", name, re.ASCII)
    if found:
        return found.group(1)
    return name if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) else None


pieces = st.sampled_from(["a", "B_", "_", "-", ".", " ", "20240101", "_20240331", "_2024010", "9", "é", "x"])
names = st.lists(pieces, min_size=1, max_size=6).map("".join)


@quick
@given(st.lists(names, min_size=40, max_size=40))
def test_table_of_data_files(spark, values):
    v = F.col("v")
    table = F.when(naming.name_kind(v).isin("chunk", "plain"), naming.table_of(v))
    assert [row[0] for row in evaluate(spark, values, table)] == [python_table(n) for n in values]


def test_chunk_bounds(spark):
    v = F.col("v")
    got = evaluate(spark, ["t_20240101_20240331", "t"], naming.chunk_start(v), naming.chunk_end(v))
    assert got == [("20240101", "20240331"), (None, None)]


def test_archive_names(spark):
    day = F.lit(dt.date(2026, 2, 10))
    got = evaluate(
        spark, ["t_20240101_20240331", "t.meta", "plain"], naming.archive_name(F.col("v"), day)
    )
    assert [g[0] for g in got] == [
        "t_20240101_20240331_processed20260210", "t_processed20260210.meta", "plain_processed20260210"
    ]


def test_paths(spark):
    got = evaluate(spark, ["/a/b/c", "file:/x/y z"], naming.file_name(F.col("v")), naming.parent_dir(F.col("v")))
    assert got == [("c", "/a/b"), ("y z", "file:/x")]


def owner_cases():
    """(identity, owner, prefix): given names and hosts around a last part, which alone counts."""
    cases = []
    for last, prefix in (("vidal", "vidal_"), ("Ng", "Ng_"), ("de-la-cruz", "de_la_cruz_"), ("d'arcy", "d_arcy_"),
                         ("svc__etl", "svc_etl_"), ("42", "42_"), ("-", ""), ("", "")):
        for given in ("", "ana.", "ana.b.", "."):
            cases += [(given + last + host, last, prefix) for host in ("", "@h.test", "@", "@a@b.c")]
    return cases


OWNERS = owner_cases()


def test_owner_prefix(spark):
    got = evaluate(spark, [i for i, _, _ in OWNERS], naming.owner_of(F.col("v")), naming.owner_prefix(F.col("v")))
    assert got == [(owner, prefix) for _, owner, prefix in OWNERS]


def python_prefix(identity):
    owner = identity.partition("@")[0].rpartition(".")[2]
    words = [w for w in re.split("[^a-zA-Z0-9]+", owner) if w]
    return "_".join(words) + "_" if words else ""


@quick
@given(st.lists(st.text(alphabet="aZ9._@-' é\U0001f600", max_size=12), min_size=40, max_size=40))
def test_owner_prefix_any_text(spark, values):
    got = evaluate(spark, values, naming.owner_prefix(F.col("v")))
    assert [row[0] for row in got] == [python_prefix(v) for v in values]


def test_qualified_name(spark):
    got = evaluate(spark, ["roe_", ""], naming.qualified_name(F.lit("silver"), F.col("v"), F.lit("t")))
    assert got == [("silver.roe_t",), ("silver.t",)]


@pytest.mark.parametrize(
    ("text", "number"),
    [("1000", 1000), (" 1_000 ", 1000), ("-5", -5), ("+7", 7), ("1__0", None), ("1.0", None), ("", None),
     ("abc", None), ("_1", None), ("99999999999999999999", None), ("\t12\n", 12)],
)
def test_whole_number(spark, text, number):
    assert evaluate(spark, [text], parsing.whole_number(F.col("v"))) == [(number,)]


@pytest.mark.parametrize(
    ("text", "moment"),
    [("2024-03-31", "2024-03-31 00:00:00"), ("2024-3-1", "2024-03-01 00:00:00"), ("2024-02-30", None),
     ("2024-03-31 10:00", None), ("2024", None), ("31.03.2024", None), (" 2024-03-31", None)],
)
def test_iso_midnight(spark, text, moment):
    shown = parsing.moment_text(parsing.iso_midnight(F.col("v")))
    assert evaluate(spark, [text], shown) == [(moment,)]


def test_midnight_in_a_zone_that_skips_it(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        shown = parsing.moment_text(parsing.iso_midnight(F.col("v")))
        assert evaluate(spark, ["2018-11-04"], shown) == [("2018-11-04 00:00:00",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_moment_text_fraction(spark):
    moment = F.col("v").cast("timestamp_ntz")
    got = evaluate(spark, ["2024-01-02 10:00:00.5", "2024-01-02 10:00:00"], parsing.moment_text(moment))
    assert got == [("2024-01-02 10:00:00.500000",), ("2024-01-02 10:00:00",)]
