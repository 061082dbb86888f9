"""Landing files, checks, gated ingest and archive."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import IngestSettings
from sluicegate.functions import naming
from sluicegate.functions.parsing import iso_midnight, moment_text, whole_number
from sluicegate.operators.checks import (
    CHECKS,
    DATE_CHECKS,
    check_tables,
    compare,
    distinct_count,
    expected_frame,
    measure,
    report_text,
    verdicts,
)
from sluicegate.operators.schema import schema_report
from sluicegate.plans.ingest import Ingest, outcome_frame, run_tally
from sluicegate.queries.registry import query, table
from sluicegate.queries.staging import (
    STAGED,
    WRONG,
    new_layout,
    shifted,
    stage_chunks,
    stage_landing,
    stage_meta,
    staged_landing,
    true_expectations,
    workspace,
)
from sluicegate.sinks.runlog import RunLog
from sluicegate.sources.footers import footer_frame
from sluicegate.sources.landing import Landing, archive_plan, read_chunks

ARCHIVE_DAY = dt.date(2026, 2, 10)

# ---- SQL for the checks ---------------------------------------------------------------------


def _truth(name: str, key: str) -> str:
    """Aggregate that gives the true value of a check."""
    id_col, date_col = STAGED[name]
    return {
        "n_rows": "count(*)",
        "n_mbrs": f"any_value((SELECT count(*) FROM (DESCRIBE {name})))",
        "n_unique_id": f"count(DISTINCT {id_col})",
        "max_date": f"max({date_col})",
        "min_date": f"min({date_col})",
    }[key]


def _check_sql(name: str, key: str, extra: int = 0, label: str | None = None) -> str:
    """Report row of one check whose expectation is off by the staged error plus ``extra``."""
    offset = WRONG.get((name, key), 0) + extra
    id_col, date_col = STAGED[name]
    expected = f"a + INTERVAL ({offset}) DAY" if key in DATE_CHECKS else f"a + ({offset})"
    text = {
        "n_rows": "'Expected ' || e || ' rows, got ' || a",
        "n_mbrs": "'Expected ' || e || ' columns, got ' || a",
        "n_unique_id": f"'Expected ' || e || ' unique values in ''{id_col}'', got ' || a",
        "max_date": f"'expected ' || e || ' max date in ''{date_col}'', got ' || a",
        "min_date": f"'expected ' || e || ' min date in ''{date_col}'', got ' || a",
    }[key]
    keys = [check.key for check in CHECKS]
    check = CHECKS[keys.index(key)]
    return f"""
        SELECT '{label or name}' AS table_name, {keys.index(key) + 1} AS position,
               '{check.name}' AS check_name, e AS expected, a AS actual, e = a AS passed,
               {text} AS message
        FROM (SELECT CAST({expected} AS VARCHAR) AS e, CAST(a AS VARCHAR) AS a
              FROM (SELECT {_truth(name, key)} AS a FROM {name}))"""


def _keys_of(name: str) -> list[str]:
    return [check.key for check in CHECKS if STAGED[name][1] or check.key not in DATE_CHECKS]


REPORT_SQL = " UNION ALL ".join(_check_sql(name, key) for name in STAGED for key in _keys_of(name))


def _twice_sql(*keys: str) -> str:
    """Checks on staged expectations, and on the same moved up by one."""
    return " UNION ALL ".join(
        _check_sql(name, key, extra, f"{name}_shifted" if extra else name)
        for name in ("orders", "lineitem")
        for extra in (0, 1)
        for key in keys
    )


# ---- landing --------------------------------------------------------------------------------


@query("""
    SELECT 'orders' AS table_name, count(DISTINCT year(o_orderdate)) AS n_files,
           min(year(o_orderdate)) || '0101' AS first_start, max(year(o_orderdate)) || '1231' AS last_end
    FROM orders
    UNION ALL
    SELECT 'lineitem', count(DISTINCT year(l_shipdate)),
           min(year(l_shipdate)) || '0101', max(year(l_shipdate)) || '1231'
    FROM lineitem
    UNION ALL
    SELECT 'customer', least(1, count(*)), NULL, NULL FROM customer
""")
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_landing(spark, sf_dir).manifest().drop("n_bytes")


@query("""
    SELECT 'orders_' || y || '0101_' || y || '1231' AS name, 'chunk' AS kind, 'orders' AS table_name,
           y || '0101' AS chunk_start, y || '1231' AS chunk_end
    FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
    UNION ALL
    SELECT 'lineitem_' || y || '0101_' || y || '1231', 'chunk', 'lineitem', y || '0101', y || '1231'
    FROM (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem)
    UNION ALL
    SELECT 'customer', 'plain', 'customer', NULL, NULL FROM (SELECT count(*) AS n FROM customer) WHERE n > 0
    UNION ALL
    SELECT t || '.meta', 'meta', t, NULL, NULL
    FROM (VALUES ('orders'), ('lineitem'), ('customer')) AS v(t)
""")
def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = staged_landing(spark, sf_dir).files()
    return files.select("name", "kind", "table_name", "chunk_start", "chunk_end")


@query("""
    SELECT 'orders' AS table_name, count(DISTINCT year(o_orderdate)) AS n_files, true AS found FROM orders
    UNION ALL SELECT 'customer', least(1, count(*)), true FROM customer
    UNION ALL SELECT 'returns', 0, false
""")
def requested_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = staged_landing(spark, sf_dir).requested(["orders", "returns", "customer"])
    return wanted.select("table_name", F.coalesce("n_files", F.lit(0)).alias("n_files"), "found")


@query("""
    WITH s AS (
      SELECT 'orders' AS table_name, count(*) AS n, 6 AS c, count(DISTINCT o_custkey) AS ids, 'o_custkey' AS id_col,
             max(o_orderdate) AS hi, min(o_orderdate) AS lo, 'o_orderdate' AS date_col FROM orders
      UNION ALL
      SELECT 'lineitem', count(*) - 1, 11, count(DISTINCT l_orderkey), 'l_orderkey',
             max(l_shipdate), min(l_shipdate) - INTERVAL 1 DAY, 'l_shipdate' FROM lineitem
      UNION ALL
      SELECT 'customer', count(*), 5, count(DISTINCT c_custkey), 'c_custkey', NULL, NULL, NULL FROM customer
    )
    SELECT table_name, 'n_rows' AS test_name, CAST(n AS VARCHAR) AS value FROM s
    UNION ALL SELECT table_name, 'n_mbrs', CAST(c AS VARCHAR) FROM s
    UNION ALL SELECT table_name, 'n_unique_id', CAST(ids AS VARCHAR) FROM s
    UNION ALL SELECT table_name, 'id_col', id_col FROM s
    UNION ALL SELECT table_name, 'max_date', strftime(hi, '%Y-%m-%d') FROM s WHERE hi IS NOT NULL
    UNION ALL SELECT table_name, 'min_date', strftime(lo, '%Y-%m-%d') FROM s WHERE lo IS NOT NULL
    UNION ALL SELECT table_name, 'date_col', date_col FROM s WHERE date_col IS NOT NULL
""")
def meta_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_landing(spark, sf_dir).meta(list(STAGED)).drop("position", "file")


_NAMES_SQL = """
    SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN 't' || o_custkey || '_' || d || '_' || d
        WHEN '2-HIGH' THEN 't' || o_custkey
        WHEN '3-MEDIUM' THEN 't' || o_custkey || '_' || left(d, 6) || '_' || left(d, 6)
        WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus
            WHEN 'F' THEN 'a-' || o_custkey || '_' || d || '_' || d
            WHEN 'O' THEN 'a-' || o_custkey
            ELSE 'a_' || d || '_' || d || '_99999999' END
        ELSE 't' || o_custkey || CASE o_orderstatus WHEN 'F' THEN '.meta' ELSE '.md' END
      END AS name
    FROM ({source})
"""


@query(f"""
    SELECT o_orderkey, name,
           CASE WHEN name LIKE '%.meta' THEN 'meta'
                WHEN contains(name, '.') THEN 'ignored'
                WHEN regexp_matches(name, '^(.+?)_(\\d{{8}})_(\\d{{8}})$') THEN 'chunk'
                WHEN regexp_matches(name, '^[A-Za-z_][A-Za-z0-9_]*$') THEN 'plain'
                ELSE 'ignored' END AS kind,
           CASE WHEN name LIKE '%.meta' THEN replace(name, '.meta', '')
                WHEN contains(name, '.') THEN NULL
                WHEN regexp_matches(name, '^(.+?)_(\\d{{8}})_(\\d{{8}})$')
                THEN regexp_extract(name, '^(.+?)_(\\d{{8}})_(\\d{{8}})$', 1)
                WHEN regexp_matches(name, '^[A-Za-z_][A-Za-z0-9_]*$') THEN name END AS table_name
    FROM ({_NAMES_SQL.format(source="SELECT *, strftime(o_orderdate, '%Y%m%d') AS d FROM orders")})
""")
def classify_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    names = spark.sql(
        _NAMES_SQL.format(source="SELECT *, date_format(o_orderdate, 'yyyyMMdd') AS d FROM {orders}"),
        orders=orders,
    )
    name = F.col("name")
    kinds = names.withColumn("kind", naming.name_kind(name))
    return kinds.withColumn("table_name", naming.table_of(name, F.col("kind")))


@query("SELECT * FROM orders")
def chunk_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_landing(spark, sf_dir).chunks("orders")


@query("SELECT * FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1999")
def chunk_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the chunks whose names say that they overlap a range of days are read."""
    landing = staged_landing(spark, sf_dir)
    return landing.chunks("orders", since=dt.date(1997, 5, 1), until=dt.date(1999, 2, 28))


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in chunks of which only those from 1999 on have a comment column."""
    orders = table(spark, sf_dir, "orders")
    landing = f"{workspace(spark)}/landing"
    day = F.col("o_orderdate")
    stage_chunks(orders.where(F.year(day) < 1999), landing, "orders", day)
    later = orders.where(F.year(day) >= 1999).withColumn("o_comment", F.col("o_orderpriority"))
    stage_chunks(later, landing, "orders", day)
    return Landing(spark, landing).chunks("orders", merge_schema=True)


@query("SELECT *, CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS o_comment FROM orders")
def chunk_union_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drifted(spark, sf_dir)


def _text_chunks(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    landing = f"{workspace(spark)}/landing"
    stage_chunks(orders, landing, "orders", F.col("o_orderdate"), file_format)
    return Landing(spark, landing).chunks("orders", file_format=file_format, schema=orders.schema)


@query("SELECT * FROM orders")
def chunk_union_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_chunks(spark, sf_dir, "csv")


@query("SELECT * FROM orders")
def chunk_union_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_chunks(spark, sf_dir, "json")


@query("""
    SELECT 'o_orderkey' AS "column", 'bigint' AS expected_type, 'bigint' AS actual_type, 'ok' AS status,
           count(o_orderkey) AS n_values FROM orders
    UNION ALL SELECT 'o_custkey', 'string', 'bigint', 'type', count(o_custkey) FROM orders
    UNION ALL SELECT 'o_clerk', 'string', NULL, 'missing', 0
    UNION ALL SELECT 'o_orderstatus', NULL, 'string', 'extra', count(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', NULL, 'double', 'extra', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', NULL, 'timestamp_ntz', 'extra', count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', NULL, 'string', 'extra', count(o_orderpriority) FROM orders
    UNION ALL SELECT 'o_comment', NULL, 'string', 'extra', count(*) FROM orders WHERE year(o_orderdate) >= 1999
""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = T.StructType.fromDDL("o_orderkey bigint, o_custkey string, o_clerk string")
    return schema_report(_drifted(spark, sf_dir), expected, count_values=True)


# ---- checks ---------------------------------------------------------------------------------


def _checked_twice(spark: SparkSession, sf_dir: str, *keys: str, bitmaps: bool = True) -> DataFrame:
    """Both tables measured once, and compared with the staged expectations and with shifted ones."""
    landing = staged_landing(spark, sf_dir)
    frames = landing.frames(["orders", "lineitem"])
    expected, measured = {}, []
    for name, known in landing.expectations(list(frames)).items():
        columns = {key: known[key] for key in ("id_col", "date_col")}
        expected[name] = columns | {key: known[key] for key in keys}
        expected[f"{name}_shifted"] = columns | {key: shifted(known[key], 1) for key in keys}
        id_col = columns["id_col"] if "n_unique_id" in keys else None
        date_col = columns["date_col"] if set(keys) & set(DATE_CHECKS) else None
        measured.append(measure(frames[name], id_col, date_col, name, bitmaps=bitmaps))
    labels = F.array("table_name", F.concat("table_name", F.lit("_shifted")))
    twice = reduce(DataFrame.union, measured).withColumn("table_name", F.explode(labels))
    return compare(twice, expected_frame(spark, expected))


@query(_twice_sql("n_rows"))
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_twice(spark, sf_dir, "n_rows")


@query(_twice_sql("n_rows", "n_mbrs"))
def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_twice(spark, sf_dir, "n_rows", "n_mbrs")


@query(_twice_sql("n_unique_id"))
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids counted as any type of id is, by shuffling distinct ones."""
    return _checked_twice(spark, sf_dir, "n_unique_id", bitmaps=False)


@query(_twice_sql("n_unique_id"))
def check_unique_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from bitmaps, without shuffling ids: the usual way for whole numbers."""
    return _checked_twice(spark, sf_dir, "n_unique_id")


@query(_twice_sql("max_date"))
def check_max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_twice(spark, sf_dir, "max_date")


@query(_twice_sql("min_date"))
def check_min_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_twice(spark, sf_dir, "min_date")


@query("""
    SELECT count(DISTINCT x) + max(CASE WHEN x IS NULL THEN 1 ELSE 0 END) AS n_distinct
    FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS x FROM orders)
""")
def check_unique_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return distinct_count(orders, F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))


def staged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of every check on every staged table, in one job."""
    landing = staged_landing(spark, sf_dir)
    return check_tables(landing.frames(list(STAGED)), landing.expectations(list(STAGED)))


@query(REPORT_SQL)
def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_report(spark, sf_dir)


@query(" UNION ALL ".join(_check_sql("orders", key) for key in _keys_of("orders")))
def check_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a table whose row count and days come from the footers of its chunks."""
    landing = f"{workspace(spark)}/landing"
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    stage_chunks(orders, landing, "orders", F.col("o_orderdate"))
    stage_meta(spark, landing, "orders", true_expectations(orders, *STAGED["orders"]))
    delivered = Landing(spark, landing)
    paths = delivered.paths(["orders"])["orders"]
    frames, footers = {"orders": read_chunks(spark, paths)}, {"orders": footer_frame(spark, paths)}
    return check_tables(frames, delivered.expectations(["orders"]), footers=footers)


@query(f"""
    SELECT table_name, count(*) AS n_checks, count(*) FILTER (passed) AS n_passed,
           count(*) FILTER (NOT passed) AS n_failed, bool_and(passed) AS passed
    FROM ({REPORT_SQL}) GROUP BY table_name
""")
def check_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(staged_report(spark, sf_dir), "table_name").drop("results", "lines")


@query(f"""
    SELECT table_name,
           'Validation failed for table ''' || table_name || ''': ' || count(*) FILTER (NOT passed)
             || ' of ' || count(*) || ' checks failed' || chr(10)
             || string_agg('  ' || CASE WHEN passed THEN '[PASS] ' ELSE '[FAIL] ' END
                           || check_name || ': ' || message, chr(10) ORDER BY position) AS text
    FROM ({REPORT_SQL}) GROUP BY table_name HAVING NOT bool_and(passed)
""")
def check_failure_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tally = verdicts(staged_report(spark, sf_dir), "table_name").where(~F.col("passed"))
    return tally.select("table_name", report_text(F.col("table_name")).alias("text"))


# ---- ingest ---------------------------------------------------------------------------------


_runs: dict[tuple[str, str], tuple[Ingest, dict[str, str]]] = {}


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[Ingest, dict[str, str]]:
    """A run over a landing directory of its own, once per session and set of tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        _runs[key] = _ingest_staged(spark, sf_dir)
    return _runs[key]


def _ingest_staged(spark: SparkSession, sf_dir: str) -> tuple[Ingest, dict[str, str]]:
    """Two good tables, a bad one and a missing one."""
    landing = stage_landing(spark, sf_dir)
    layout = new_layout(spark)
    settings = IngestSettings(layout, landing, f"{workspace(spark)}/archive", archive_day=ARCHIVE_DAY)
    log = RunLog("ingest", "extract", layout.table("ua", "logs"), spark, source="queries")
    ingest = Ingest(spark, settings, log)
    return ingest, ingest.run(["orders", "lineitem", "customer", "returns"])


@query("""
    SELECT 'orders' AS table_name, 'success' AS status, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'customer', 'success', count(*) FROM customer
    UNION ALL SELECT 'lineitem', 'failure', 0
    UNION ALL SELECT 'returns', 'failure', 0
""")
def ingest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingest, results = _ingested(spark, sf_dir)
    outcomes = outcome_frame(spark, results).drop("error")
    written = [
        spark.table(ingest.settings.bronze(name).sql).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for name in results
        if spark.catalog.tableExists(ingest.settings.bronze(name).sql)
    ]
    joined = outcomes.join(reduce(DataFrame.union, written), "table_name", "left")
    return joined.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@query("SELECT * FROM orders")
def ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingest, _ = _ingested(spark, sf_dir)
    return spark.table(ingest.settings.bronze("orders").sql)


@query("""
    SELECT count(*) FILTER (ok) AS n_succeeded, count(*) FILTER (NOT ok) AS n_failed,
           count(*) AS n_tables, CASE WHEN bool_and(ok) THEN 'success' ELSE 'warning' END AS status
    FROM (SELECT count(*) = count(*) AS ok FROM orders
          UNION ALL SELECT count(*) = count(*) FROM customer
          UNION ALL SELECT count(*) = count(*) - 1 FROM lineitem
          UNION ALL SELECT false)
""")
def ingest_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, results = _ingested(spark, sf_dir)
    return run_tally(outcome_frame(spark, results))


@query("""
    SELECT 'archive' AS place, 'orders_' || y || '0101_' || y || '1231_processed20260210' AS name
    FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
    UNION ALL SELECT 'archive', n || '_processed20260210' || s
    FROM (VALUES ('customer', ''), ('customer', '.meta'), ('orders', '.meta')) AS v(n, s)
    UNION ALL SELECT 'landing', 'lineitem_' || y || '0101_' || y || '1231'
    FROM (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem)
    UNION ALL SELECT 'landing', 'lineitem.meta'
""")
def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingest, _ = _ingested(spark, sf_dir)
    places = {"archive": ingest.settings.archive_path, "landing": ingest.settings.landing_path}
    listings = [
        Landing(spark, path).listing().select(F.lit(place).alias("place"), "name")
        for place, path in places.items()
    ]
    return reduce(DataFrame.union, listings)


@query("""
    WITH t AS (
      SELECT 'orders' AS name, count(*) = count(*) AS good, true AS dated FROM orders
      UNION ALL SELECT 'customer', count(*) = count(*), false FROM customer
      UNION ALL SELECT 'lineitem', count(*) = count(*) - 1, true FROM lineitem
    ), events AS (
      SELECT 'discover_tables' AS step, true AS ok
      UNION ALL SELECT unnest(['extract_table', 'read_meta', 'read_chunks', 'validate_n_members',
                               'validate_unique_id_count']), true FROM t
      UNION ALL SELECT 'validate_row_count', good FROM t
      UNION ALL SELECT 'validate_max_date', true FROM t WHERE dated
      UNION ALL SELECT 'validate_min_date', good FROM t WHERE dated
      UNION ALL SELECT unnest(['validate', 'write_to_bronze', 'archive_files', 'extract_table']), true
                FROM t WHERE good
      UNION ALL SELECT 'extract', false FROM t WHERE NOT good
      UNION ALL SELECT 'extract', false
      UNION ALL SELECT 'extract', NULL
    )
    SELECT step, CASE ok WHEN true THEN 'success' WHEN false THEN 'failure' ELSE 'warning' END AS status,
           count(*) AS n FROM events GROUP BY ALL
""")
def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingest, _ = _ingested(spark, sf_dir)
    return ingest.log.query().groupBy("step", "status").agg(F.count(F.lit(1)).alias("n"))


_TEXTS_SQL = """
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN d WHEN '2-HIGH' THEN replace(d, '-0', '-')
                WHEN '3-MEDIUM' THEN d || ' 10:00' WHEN '4-NOT SPECIFIED' THEN replace(d, '-', '')
                ELSE 'unknown' END AS day,
           CASE o_orderpriority WHEN '1-URGENT' THEN ' ' || o_custkey || ' ' WHEN '2-HIGH' THEN '1_' || o_custkey
                WHEN '3-MEDIUM' THEN '1__' || o_custkey WHEN '4-NOT SPECIFIED' THEN o_custkey || '.0'
                ELSE 'many' END AS number
    FROM ({source})
"""


@query(f"""
    SELECT t.o_orderkey, day, number,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS moment,
           CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey
                WHEN '2-HIGH' THEN CAST('1' || o_custkey AS BIGINT) ELSE -1 END AS whole
    FROM ({_TEXTS_SQL.format(source="SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")}) t
    JOIN orders o ON o.o_orderkey = t.o_orderkey
""")
def parse_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered days and numbers, readable and not."""
    texts = spark.sql(
        _TEXTS_SQL.format(source="SELECT *, date_format(o_orderdate, 'yyyy-MM-dd') AS d FROM {orders}"),
        orders=table(spark, sf_dir, "orders"),
    )
    return texts.select(
        "*",
        moment_text(iso_midnight(F.col("day"))).alias("moment"),
        F.coalesce(whole_number(F.col("number")), F.lit(-1)).alias("whole"),
    )


@query("""
    SELECT o_orderkey, '/landing/t' || o_custkey || s AS src,
           '/archive/t' || o_custkey || CASE WHEN s = '.meta' THEN '_processed20260210.meta'
                                             ELSE s || '_processed20260210' END AS dest
    FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN '.meta'
                         ELSE '_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate, '%Y%m%d')
                    END AS s FROM orders)
""")
def archive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    suffix = F.when(F.col("o_orderstatus") == "F", ".meta").otherwise(F.concat(F.lit("_"), day, F.lit("_"), day))
    src = F.concat(F.lit("/landing/t"), "o_custkey", suffix)
    files = table(spark, sf_dir, "orders").select("o_orderkey", src.alias("src"))
    return archive_plan(files, "/archive", ARCHIVE_DAY)


def _outcomes(spark: SparkSession, landing: str, names: list[str], **changes) -> tuple[Ingest, DataFrame]:
    """An ingest of a landing directory, and its results with the rows of each bronze table."""
    layout = new_layout(spark)
    archive = f"{workspace(spark)}/archive"
    settings = IngestSettings(layout, landing, archive, archive_day=ARCHIVE_DAY, **changes)
    log = RunLog("ingest", "extract", layout.table("ua", "logs"), spark, source="queries")
    ingest = Ingest(spark, settings, log)
    outcomes = outcome_frame(spark, ingest.run(names)).drop("error")
    written = [
        spark.table(settings.bronze(name).sql).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in names
        if spark.catalog.tableExists(settings.bronze(name).sql)
    ]
    if written:
        outcomes = outcomes.join(reduce(DataFrame.union, written), "table_name", "left")
    else:
        outcomes = outcomes.withColumn("n_rows", F.lit(0).cast("long"))
    return ingest, outcomes.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@query("""
    SELECT 'nation' AS table_name, 'success' AS status, count(*) AS n_rows FROM nation
    UNION ALL SELECT 'supplier', 'failure', 0 UNION ALL SELECT 'part', 'failure', 0
    UNION ALL SELECT 'region', 'failure', 0
""")
def closed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A meta of other columns, none at all, and one with rows that have no name; one good table."""
    landing = f"{workspace(spark)}/landing"
    for name in ("nation", "supplier", "part", "region"):
        stage_chunks(table(spark, sf_dir, name), landing, name)
    stage_meta(spark, landing, "nation", {"n_rows": str(table(spark, sf_dir, "nation").count())})
    metas = {"supplier": "test string, value string", "region": "test_name string, value string"}
    for name, schema in metas.items():
        rows = spark.createDataFrame([(None if name == "region" else "n_rows", "999")], schema)
        stage_chunks(rows, landing, f"{name}.meta")
    return _outcomes(spark, landing, ["nation", "supplier", "part", "region"])[1]


@query("""
    SELECT 'early' AS table_name, 'failure' AS status, 0::BIGINT AS n_rows, 'failure' AS open_status FROM region
    UNION SELECT 'late', 'failure', 0, 'success' FROM region
    UNION SELECT 'same', 'success', count(*), 'success' FROM supplier
""")
def chunk_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only the first or the last chunk has, under a schema without it and with it.

    ``early`` also lacks a column in its other chunk, which the wider schema asks for.
    """
    landing = f"{workspace(spark)}/landing"
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    more = rows.withColumn("s_extra", F.lit(1))
    for name, first, last in (("early", more, rows), ("late", more, more), ("same", rows, None)):
        stage_chunks(first, landing, f"{name}_20200101_20200131")
        if last:
            stage_chunks(last, landing, f"{name}_20200201_20200229")
        stage_meta(spark, landing, name, {"n_unique_id": str(rows.count()), "id_col": "s_suppkey"})
    names = ["early", "late", "same"]
    narrow = {name: rows.schema for name in names}
    strict = _outcomes(spark, landing, names, table_schemas=narrow)[1]
    wide = {"early": more.schema, "late": more.schema}
    closed = [(r.table_name, r.status, r.n_rows) for r in strict.collect()]
    opened = _outcomes(spark, landing, ["early", "late"], table_schemas=wide)[1].collect()
    status = {r.table_name: r.status for r in opened}
    result = [(n, s, k, status.get(n, s)) for n, s, k in closed]
    return spark.createDataFrame(result, "table_name string, status string, n_rows long, open_status string")


@query("""
    SELECT 'csv_broken' AS table_name, 'failure' AS status, 0::BIGINT AS n_rows FROM region
    UNION SELECT 'csv_good', 'success', count(*) FROM customer
""")
def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same customers as CSV, once with a key that is no number."""
    landing = f"{workspace(spark)}/landing"
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    first = F.col("c_custkey") == rows.agg(F.min("c_custkey")).first()[0]
    broken = rows.withColumn("c_custkey", F.when(first, F.lit("abc")).otherwise(F.col("c_custkey").cast("string")))
    for name, frame in (("csv_good", rows), ("csv_broken", broken)):
        stage_chunks(frame, landing, name, file_format="csv")
        stage_meta(spark, landing, name, {"n_mbrs": "2"})
    schemas = {name: rows.schema for name in ("csv_good", "csv_broken")}
    return _outcomes(spark, landing, list(schemas), file_format="csv", table_schemas=schemas)[1]


@query("""
    SELECT 'nation' || stamp || suffix AS name, n_rows
    FROM (VALUES ('_processed20260210'), ('_processed20260210-2')) AS s(stamp),
         (VALUES (''), ('.meta')) AS x(suffix), (SELECT count(*) AS n_rows FROM nation)
""")
def redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of one day: the archive's names, and the rows of the table."""
    landing, archive = f"{workspace(spark)}/landing", f"{workspace(spark)}/archive"
    rows, layout = table(spark, sf_dir, "nation"), new_layout(spark)
    settings = IngestSettings(layout, landing, archive, archive_day=ARCHIVE_DAY)
    for delivered in (rows.where("n_nationkey < 9"), rows):
        stage_chunks(delivered, landing, "nation")
        stage_meta(spark, landing, "nation", {"n_rows": str(delivered.count())})
        log = RunLog("ingest", "extract", layout.table("ua", "logs"), spark, source="queries")
        Ingest(spark, settings, log).run(["nation"])
    n_rows = spark.table(settings.bronze("nation").sql).count()
    return Landing(spark, archive).listing().select("name", F.lit(n_rows).cast("long").alias("n_rows"))
