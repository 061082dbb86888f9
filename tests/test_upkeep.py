"""Spans, references, quarantine, footers, bitmaps and summaries that are kept up to date."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import Ingest
from sluicegate.operators import checks, references, spans
from sluicegate.operators.references import orphan_rows, orphans, reference_report
from sluicegate.operators.spans import merge_spans, spans_at
from sluicegate.plans.rollup import Metric, Rollup
from sluicegate.sources.footers import footer_frame
from sluicegate.sources.landing import Landing, read_chunks
from sluicegate.sources.quarantine import split_lines

# ---- spans ----------------------------------------------------------------------------------

ORIGIN = dt.date(2020, 1, 1)
SPAN_SHAPE = "k string, n int, a date, b date"


def day(number):
    return None if number is None else ORIGIN + dt.timedelta(number)


def some_spans(seed, keys, count, length, open_share=0.02):
    source = random.Random(seed)
    rows = []
    for _ in range(count):
        first = source.randrange(-900, 1500)
        last = None if source.random() < open_share else first + source.randrange(-2, length)
        rows.append((source.choice(keys), source.randrange(2), first, last))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, n, day(a), day(b)) for k, n, a, b in rows], SPAN_SHAPE)


def merged(rows, gap):
    """Runs by walking over the spans of each key."""
    found = []
    for key in sorted({row[:2] for row in rows}, key=repr):
        spans = sorted((a, 10**6 if b is None else b) for *k, a, b in rows if tuple(k) == key and a is not None and (b is None or a <= b))
        for a, b in spans:
            if found and found[-1][0] == key and a <= found[-1][2] + 1 + gap:
                found[-1][2] = max(found[-1][2], b)
                found[-1][3] += 1
            else:
                found.append([key, a, b, 1])
    return sorted(((*key, day(a), None if b == 10**6 else day(b), n) for key, a, b, n in found), key=repr)


@pytest.mark.parametrize(("gap", "length"), [(0, 5), (0, 700), (10, 30), (30, 3)])
def test_merged_spans(spark, gap, length):
    rows = some_spans(gap + length, ["x", "y", None], 400, length) + [("z", 1, None, 5), ("z", 1, 7, 3)]
    found = merge_spans(frame(spark, rows).repartition(5), ["k", "n"], "a", "b", gap)
    assert found.columns == ["k", "n", "span_start", "span_end", "n_spans"]
    assert sorted(map(tuple, found.collect()), key=repr) == merged(rows, gap)
    assert merge_spans(frame(spark, []), ["k"], "a", "b").count() == 0


def test_a_hot_key_is_ordered_by_many_tasks(spark):
    """No window sorts a key's rows by the key alone before they are merged within bins."""
    plan = merge_spans(frame(spark, some_spans(1, ["x"], 50, 9)), ["k"], "a", "b")._jdf.queryExecution().executedPlan().toString()
    by_span = [line for line in plan.splitlines() if "Window" in line and "s#" in line.split("windowspec")[-1].split("ASC")[0]]
    assert by_span and all("bin#" in line for line in by_span)


def test_spans_at_a_day(spark):
    spans = some_spans(3, ["x", "y"], 120, 400) + [("x", 0, 5, 5), ("y", 1, -800, 1400)]
    source = random.Random(5)
    points = [(i, source.choice(["x", "y", "w", None]), source.randrange(2), source.randrange(-950, 1600)) for i in range(300)]
    points += [(900, "x", 0, None), (901, "x", 0, 5)]
    rows = spark.createDataFrame([(i, k, n, day(d)) for i, k, n, d in points], "i int, k string, n int, d date")
    found = spans_at(rows, frame(spark, spans), ["k", "n"], "d", "a", "b")
    expected = [
        (i, k, n, day(d), day(a), day(b))
        for i, k, n, d in points
        for sk, sn, a, b in spans
        if d is not None and (k, n) == (sk, sn) and a <= d and (b is None or d <= b)
    ]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="a"):
        spans_at(rows.withColumn("a", F.lit(1)), frame(spark, spans), ["k"], "d", "a", "b")
    assert spans_at(rows, frame(spark, []), ["k", "n"], "d", "a", "b").count() == 0


def test_a_point_meets_short_spans_in_one_period(spark):
    """Spans of a third of a year stand in few periods of one size, long ones in a bounded number."""
    found = spark.sql("SELECT 1000 AS a, 1099 AS b UNION ALL SELECT 0, 3652058 UNION ALL SELECT 4095, 8192")
    found = found.select("a", "b", spans._periods(F.col("a"), F.col("b")).alias("p")).collect()
    by_start = {row.a: [tuple(place) for place in row.p] for row in found}
    assert by_start[1000] == [(6, 15), (6, 16), (6, 17)]
    assert by_start[4095] == [(6, 63), (6, 128), (12, 1)]
    assert len(by_start[0]) < 14 + 2 * 64
    for start, last in ((0, 3652058), (4095, 8192)):
        days = [range(place << level, (place + 1) << level) for level, place in by_start[start]]
        for at in (start, start + 1, 5000, 8191, last):
            assert sum(at in own for own in days) == 1


def test_equal_spans_are_one_run(spark):
    rows = [(k, 0, i % 5 * 10, i % 5 * 10 + 4) for k in "abcdefgh" for i in range(100)]
    found = merge_spans(frame(spark, rows).repartition(7), ["k"], "a", "b")
    assert sorted((r.k, r.span_start, r.n_spans) for r in found.collect()) == [(k, day(i * 10), 20) for k in "abcdefgh" for i in range(5)]


def test_days_at_the_ends_of_the_calendar(spark):
    far = spark.createDataFrame([("x", dt.date(1, 1, 1), dt.date(9999, 12, 31))], "k string, a date, b date")
    points = spark.createDataFrame([("x", dt.date(1, 1, 1)), ("x", dt.date(9999, 12, 31))], "k string, d date")
    assert spans_at(points, far, ["k"], "d", "a", "b").count() == 2


# ---- references -----------------------------------------------------------------------------


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_orphans(spark, monkeypatch, words):
    """With a filter of one word nearly every parent passes, and the result is the same."""
    monkeypatch.setattr(references, "FILTER_WORDS", words)
    child = spark.createDataFrame([(i % 50 if i % 3 else 0, "x" if i % 7 else None, i) for i in range(600)], "a long, b string, i int")
    parent = spark.createDataFrame([(i, "x") for i in range(0, 90, 2)] * 3, "p int, q string")
    found = orphans(child, parent, {"a": "p", "b": "q"})
    counts = {}
    for row in child.collect():
        if row.b is not None and row.a % 2:
            counts[row.a, row.b] = counts.get((row.a, row.b), 0) + 1
    assert sorted(map(tuple, found.collect())) == sorted((*key, n) for key, n in counts.items())
    rows = orphan_rows(child, parent, {"a": "p", "b": "q"})
    assert sorted(r.i for r in rows.collect()) == sorted(r.i for r in child.collect() if r.b is not None and r.a % 2)
    report = {r.expectation: (r.n_passed, r.n_failed) for r in reference_report({"r": (child, parent, {"a": "p", "b": "q"})}).collect()}
    assert report == {"r": (600 - sum(counts.values()), sum(counts.values()))}


@pytest.mark.parametrize(("kind", "other"), [("double", "double"), ("int", "double"), ("decimal(5,1)", "decimal(9,2)")])
def test_keys_that_are_equal_without_equal_hashes(spark, kind, other):
    child = spark.sql(f"SELECT cast(x AS {kind}) AS k FROM VALUES (0), (1), (2), (3) AS t(x)")
    parent = spark.sql(f"SELECT cast(x AS {other}) AS k FROM VALUES (-0.0D), (1), (3) AS t(x)")
    assert [float(r.k) for r in orphans(child, parent, {"k": "k"}).collect()] == [2.0]


def test_only_the_filter_is_broadcast_by_order(spark):
    plan = orphans(spark.range(9), spark.range(5), {"id": "id"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1


# ---- bitmaps and footers --------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint"])
def test_distinct_whole_numbers(spark, kind):
    source = random.Random(2)
    most = {"tinyint": 127, "int": 2**31 - 1, "bigint": 2**63 - 1}[kind]
    values = [source.randrange(-most - 1, most) for _ in range(200)] + list(range(-100, 100)) * 3 + [None, None, most, -most - 1, 0]
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(4)
    assert checks.distinct_whole_numbers(df, F.col("x")).first().n_distinct == len(set(values))
    assert checks.distinct_whole_numbers(df.limit(0), F.col("x")).first().n_distinct == 0


def test_ids_are_not_shuffled(spark):
    rows = spark.range(1000).select((F.col("id") % 400).alias("x"))
    plan = checks.measure(rows, "x", bitmaps=True)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and "word#" in shuffled[0]
    text = checks.measure(rows.select(F.col("x").cast("string").alias("x")), "x", bitmaps=True)
    assert {r.key: r.actual_count for r in text.collect()}["n_unique_id"] == 400


def put(path, rows, **options):
    pq.write_table(pa.table(rows), path, **options)
    return str(path)


def days(start, count):
    return pa.array([ORIGIN + dt.timedelta(start + i) if i % 5 else None for i in range(count)], pa.date32())


def test_counts_and_days_from_footers(spark, tmp_path):
    paths = [put(tmp_path / f"f{i}", {"id": list(range(100)), "d": days(100 * i, 100), "s": ["x"] * 100}) for i in range(3)]
    df, footers = read_chunks(spark, paths), footer_frame(spark, paths)
    for date_col in ("d", None, "s"):
        read, told = checks.measure(df, "id", date_col), checks.measure(df, "id", date_col, footers=footers)
        assert sorted(map(repr, told.collect())) == sorted(map(repr, read.collect()))
    plan = checks.measure(df, None, "d", footers=footers)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(d), MIN(d)]" in plan and "FileScan" not in plan
    plan = checks.measure(df, None, "s", footers=footers)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and plan.count("FileScan") == 1
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_ingest_with_footers_and_bitmaps(box, log):
    for statistics in (True, False):  # without figures in the footers, data is read
        box.put("t_20200101_20200131", {"id": list(range(50)), "d": days(1, 50)})
        pq.write_table(pa.table({"id": list(range(50, 90)), "d": days(60, 40)}), box.landing_dir / "t_20200201_20200331", write_statistics=statistics)
        last = ORIGIN + dt.timedelta(99)
        box.meta("t", {"n_rows": "90", "n_unique_id": "90", "id_col": "id", "date_col": "d", "max_date": str(last)})
        assert Ingest(box.spark, box.settings(footers=True, bitmaps=True), log).run(["t"]) == {"t": "success"}


# ---- quarantine -----------------------------------------------------------------------------

SHAPE = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_broken_lines_are_set_aside(spark, tmp_path):
    lines = {
        "t_20200101_20200131": ["a,b", "1,x", "two,y", "3,z", "", "4", "5,v,w", '6,"q, r"'],
        "t_20200201_20200229": ["a,b", "7,x"],
        "t_20200301_20200331": ["a,b", *[f"{'x' if i % 1000 == 999 else ''}{i},t" for i in range(5000)]],
    }
    for name, text in lines.items():
        (tmp_path / name).write_text("\n".join(text) + "\n")
    paths = [str(tmp_path / name) for name in lines]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")  # several tasks for the long file
    try:
        split = split_lines(spark, paths, "csv", SHAPE, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    good = sorted(map(tuple, split.good.where("b <> 't'").collect()))
    assert good == [(1, "x"), (3, "z"), (6, "q, r"), (7, "x")]
    broken = sorted((r.file.rpartition("/")[2][2:10], r.row, r.line) for r in split.broken.collect())
    assert broken == [
        ("20200101", 2, "two,y"), ("20200101", 4, "4"), ("20200101", 5, "5,v,w"),
        *[("20200301", 1000 * i, f"x{1000 * i - 1},t") for i in range(1, 6)],
    ]
    assert split.good.count() + split.broken.count() == 7 + 5000
    with pytest.raises(ValueError, match="_line"):
        split_lines(spark, paths, "csv", T.StructType([T.StructField("_line", T.IntegerType())]), "x")
    with pytest.raises(ValueError, match="orc"):
        split_lines(spark, paths, "orc", SHAPE, "x")


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_ingest_with_quarantine(box, log, file_format):
    text = {
        "csv": "a,b\n1,x\nnone,y\n3,z\n",
        "json": '{"a": 1, "b": "x"}\n{"a": "none", "b": "y"}\nno json\n{"a": 3, "b": "z"}\n',
    }[file_format]
    (box.landing_dir / "t_20200101_20200131").write_text(text)
    box.meta("t", {"n_rows": "2"})
    place = box.landing_dir.parent / "quarantine"
    settings = box.settings(file_format=file_format, table_schemas={"t": SHAPE}, quarantine_path=str(place))
    assert Ingest(box.spark, settings, log).run(["t"]) == {"t": "success"}
    rows = box.spark.table(settings.bronze("t").sql)
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (3, "z")]
    [folder] = list((place / "t").iterdir())  # the lines of the run are gone, the broken ones stay
    broken = box.spark.read.parquet(str(folder))
    assert broken.count() == text.count("no")
    [warning] = log.query({"status": "warning", "step": "read_chunks"}).collect()
    assert f"{broken.count()} broken lines" in warning.message


# ---- summaries kept up to date --------------------------------------------------------------

METRICS = {
    "n": Metric("count"),
    "total": Metric("sum", "v"),
    "least": Metric("min", "v"),
    "most": Metric("max", "name"),
    "names": Metric("distinct", "name"),
    "half": Metric("quantile", "v", 0.5),
}


def chunk(seed, count=40):
    source = random.Random(seed)
    return {
        "k": [source.choice(["a", "b", None]) for _ in range(count)],
        "v": pa.array([source.choice([None, *range(9)]) for _ in range(count)], pa.int64()),
        "name": [source.choice("pqrst") for _ in range(count)],
    }


def by_key(data):
    rows = {}
    for k, v, name in zip(data["k"], data["v"].to_pylist(), data["name"], strict=True):
        rows.setdefault(k, []).append((v, name))
    found = []
    for k, pairs in rows.items():
        values = [v for v, _ in pairs if v is not None]
        names = [name for _, name in pairs]
        found.append((k, len(pairs), sum(values), min(values), max(names), len(set(names))))
    return sorted(found, key=repr)


def test_updates_equal_a_full_summary(box, spark, layout):
    landing, target = box.landing, layout.table("gold", "t")
    rollup = Rollup(spark, target, ["k"], METRICS)
    read = []

    def update():
        def reader(paths):
            read.append(sorted(path.rpartition("_")[2] for path in paths))
            return read_chunks(spark, paths)

        return rollup.update(landing.data_files(), reader)

    def gold():
        return sorted(map(tuple, spark.table(target.sql).drop("half").collect()), key=repr)

    def all_of(*chunks):
        return by_key({key: pa.concat_arrays([c[key] for c in chunks]) if key == "v" else sum([c[key] for c in chunks], []) for key in chunks[0]})

    one, two, three, none = chunk(1), chunk(2), chunk(3, 60), chunk(4, 0)
    for number, data in ((1, one), (2, two), (4, none)):
        box.put(f"t_20200101_2020010{number}", data)
    assert update() == {"n_chunks": 3, "n_read": 3, "n_dropped": 0}
    assert gold() == all_of(one, two)
    assert update() == {"n_chunks": 3, "n_read": 0, "n_dropped": 0}  # the empty chunk is known too
    box.put("t_20200101_20200103", three)
    box.put("t_20200101_20200102", chunk(7, 55))
    (box.landing_dir / "t_20200101_20200101").unlink()
    assert update() == {"n_chunks": 3, "n_read": 2, "n_dropped": 1}
    assert gold() == all_of(three, chunk(7, 55))
    assert read[-1] == ["20200102", "20200103"] and len(read) == 2
    half = {row.k: row.half for row in spark.table(target.sql).collect()}
    assert all(0 <= value <= 8 for value in half.values())


def test_an_update_that_died_between_both_tables_is_finished(box, spark, layout, monkeypatch):
    target = layout.table("gold", "t")
    rollup = Rollup(spark, target, ["k"], METRICS)

    def update():
        return rollup.update(box.landing.data_files(), lambda paths: read_chunks(spark, paths))

    box.put("t_20200101_20200101", chunk(1))
    update()
    box.put("t_20200101_20200102", chunk(2))
    with monkeypatch.context() as patch:
        patch.setattr(Rollup, "_merge", lambda self: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            update()
    assert spark.table(target.sql).agg(F.sum("n")).first()[0] == 40
    assert update()["n_read"] == 0
    assert spark.table(target.sql).agg(F.sum("n")).first()[0] == 80


def test_refused_metrics(spark, layout):
    with pytest.raises(ValueError, match="kind"):
        Metric("mean")
    with pytest.raises(ValueError, match="names"):
        Rollup(spark, layout.table("gold", "t"), ["k"], {"K": Metric("count")})


def test_only_changed_chunks_are_scanned(box, spark, layout):
    rollup = Rollup(spark, layout.table("gold", "t"), ["k"], METRICS)
    path = box.put("t_20200101_20200101", chunk(1))
    box.put("t_20200101_20200102", chunk(2))
    assert [p.rpartition("/")[2] for p in rollup.partials(read_chunks(spark, [path])).inputFiles()] == ["t_20200101_20200101"]
    assert isinstance(Landing(spark, str(box.landing_dir)).paths(["t"])["t"], list)
