"""Versions, keyed tables, spans, references, quarantine and summaries that are kept up to date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.operators import references, spans
from sluicegate.plans.rollup import Metric, Rollup
from sluicegate.queries.registry import query, table
from sluicegate.queries.staging import new_layout, stage_chunks, workspace
from sluicegate.sinks.keyed import Keyed, create_keyed, upsert
from sluicegate.sinks.tables import replace_table, table_as_of
from sluicegate.sources.files import SharedFiles
from sluicegate.sources.landing import Landing, read_chunks
from sluicegate.sources.quarantine import split_lines

# ---- versions and keys ----------------------------------------------------------------------


@query("SELECT * FROM orders")
def bronze_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was replaced twice since, the second time with other columns."""
    target = new_layout(spark).table("bronze", "orders")
    orders = table(spark, sf_dir, "orders")
    replace_table(orders, target)
    moment = dt.datetime.now(dt.UTC)
    replace_table(orders.where(F.col("o_orderstatus") == "F"), target)
    replace_table(orders.select("o_orderkey", "o_custkey"), target)
    return table_as_of(spark, target, moment)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
           CASE WHEN o_orderkey % 100 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL
    SELECT -o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, o_totalprice
    FROM orders WHERE o_orderkey % 1000 = 0 AND o_orderkey > 0
""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which one in a hundred is delivered again, with some new ones."""
    target = new_layout(spark).table("silver", "orders")
    orders = table(spark, sf_dir, "orders")
    create_keyed(orders, target, Keyed(("o_orderkey",), buckets=8, shard="pmod(o_orderkey, 16)"))
    again = orders.where("o_orderkey % 100 = 0").withColumn("o_totalprice", -F.col("o_totalprice"))
    new = orders.where("o_orderkey % 1000 = 0 AND o_orderkey > 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    upsert(again.unionByName(new), target)
    return spark.table(target.sql)


# ---- spans ----------------------------------------------------------------------------------

# A third of all orders belongs to one member.
_MEMBER = "CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END"

_SPANS_SQL = f"""
    SELECT member, min(a) AS span_start, max(b) AS span_end, count(*) AS n_spans FROM (
      SELECT *, sum(begins) OVER (PARTITION BY member ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, CASE WHEN a <= 1 + max(b) OVER (PARTITION BY member ORDER BY a, b
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       THEN 0 ELSE 1 END AS begins FROM (
          SELECT {_MEMBER} AS member, CAST(o_orderdate AS DATE) AS a,
                 CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INTEGER) AS b FROM orders)))
    GROUP BY member, run
"""


def _enrolments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order covers its day and up to 119 more."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        f"{_MEMBER} AS member",
        "CAST(o_orderdate AS DATE) AS first_day",
        "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 120 AS INT)) AS last_day",
    )
    return spans.merge_spans(rows, ["member"], "first_day", "last_day")


@query(f"""
    SELECT member, strftime(span_start, '%Y-%m-%d') AS span_start, strftime(span_end, '%Y-%m-%d') AS span_end, n_spans
    FROM ({_SPANS_SQL})
""")
def enrolment_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of days that a member's orders cover without a gap."""
    text = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("span_start", "span_end")]
    return _enrolments(spark, sf_dir).select("member", *text, "n_spans")


@query(f"""
    SELECT r.member, strftime(span_start, '%Y-%m-%d') AS span_start, count(*) AS n_lines, sum(l_quantity) AS quantity
    FROM lineitem JOIN (SELECT *, {_MEMBER} AS member FROM orders) AS o ON o_orderkey = l_orderkey
         JOIN ({_SPANS_SQL}) AS r ON r.member = o.member AND CAST(l_shipdate AS DATE) BETWEEN span_start AND span_end
    GROUP BY r.member, span_start
""")
def enrolment_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was shipped to a member within each run."""
    members = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", f"{_MEMBER} AS member")
    shipped = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity").join(members, "l_orderkey")
    met = spans.spans_at(shipped, _enrolments(spark, sf_dir), ["member"], "l_shipdate")
    return met.groupBy("member", F.date_format("span_start", "yyyy-MM-dd").alias("span_start")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )


# ---- references -----------------------------------------------------------------------------


@query("""
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey
""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose order is not among those that are settled."""
    settled = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return references.orphans(table(spark, sf_dir, "lineitem"), settled, {"l_orderkey": "o_orderkey"})


@query("""
    SELECT 'line_has_order' AS expectation, count(*) FILTER (l_orderkey IN (SELECT o_orderkey FROM orders)) AS n_passed,
           count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS n_failed FROM lineitem
    UNION ALL
    SELECT 'order_has_solvent_customer',
           count(*) FILTER (o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)),
           count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) FROM orders
    UNION ALL
    SELECT 'customer_has_order', count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)),
           count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)) FROM customer
""")
def reference_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to a unique key, to a part of a table, and to a key with many rows."""
    names = ("lineitem", "orders", "customer")
    lineitem, orders, customer = (table(spark, sf_dir, name) for name in names)
    return references.reference_report(
        {
            "line_has_order": (lineitem, orders, {"l_orderkey": "o_orderkey"}),
            "order_has_solvent_customer": (orders, customer.where("c_acctbal >= 0"), {"o_custkey": "c_custkey"}),
            "customer_has_order": (customer, orders, {"c_custkey": "o_custkey"}),
        }
    )


# ---- quarantine -----------------------------------------------------------------------------


def _parted(spark: SparkSession, landing: str, file_format: str, schema: T.StructType) -> DataFrame:
    """The good rows of staged orders, and the broken lines, with -1 as their keys."""
    paths = Landing(spark, landing).paths(["orders"])["orders"]
    split = split_lines(spark, paths, file_format, schema, f"{workspace(spark)}/lines")
    good = split.good.select("o_orderkey", "o_custkey", F.lit(None).cast("string").alias("line"))
    no_key = F.lit(-1).cast("long")
    return good.unionByName(split.broken.select(no_key.alias("o_orderkey"), no_key.alias("o_custkey"), "line"))


@query("""
    SELECT o_orderkey, o_custkey, NULL AS line FROM orders WHERE o_orderkey % 10 <> 0
    UNION ALL
    SELECT -1, -1, 'x' || o_orderkey || ',' || o_custkey || ',' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000')
    FROM orders WHERE o_orderkey % 10 = 0
""")
def quarantine_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which one key in ten is no number, in a chunk for each year."""
    landing = f"{workspace(spark)}/landing"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    mark = F.when(F.col("o_orderkey") % 10 == 0, "x").otherwise("")
    text = orders.withColumn("o_orderkey", F.concat(mark, "o_orderkey"))
    stage_chunks(text, landing, "orders", F.col("o_orderdate"), "csv")
    return _parted(spark, landing, "csv", orders.schema)


@query("""
    SELECT o_orderkey, o_custkey, NULL AS line FROM orders WHERE o_orderkey % 10 <> 0
    UNION ALL
    SELECT -1, -1, '{"o_orderkey":"x' || o_orderkey || '","o_custkey":' || o_custkey || '}'
    FROM orders WHERE o_orderkey % 10 = 0
""")
def quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys as JSON, where the broken ones are texts."""
    landing = f"{workspace(spark)}/landing"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key = F.when(F.col("o_orderkey") % 10 == 0, F.format_string('"x%d"', "o_orderkey"))
    line = F.format_string('{"o_orderkey":%s,"o_custkey":%d}', F.coalesce(key, F.col("o_orderkey").cast("string")), "o_custkey")
    stage_chunks(orders.select(line.alias("value")), landing, "orders", file_format="text")
    return _parted(spark, landing, "json", orders.schema)


# ---- summaries kept up to date --------------------------------------------------------------


@query("""
    WITH o AS (
      SELECT *, o_totalprice * CASE WHEN year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 2 ELSE 1 END
             AS price FROM orders WHERE year(o_orderdate) > (SELECT min(year(o_orderdate)) FROM orders))
    SELECT o_orderpriority, count(*) AS n_orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_finished,
           CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS total, min(price) AS least, max(price) AS most,
           strftime(max(o_orderdate), '%Y-%m-%d') AS last_day, true AS customers_close, true AS median_close,
           0::BIGINT AS read_again
    FROM o GROUP BY o_orderpriority
""")
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of chunks of which one went and one changed after it was built, against the rows that are there.

    Estimates are shown as whether they are close to the exact figures: 10 % of customers, 5 % of rank.
    """
    landing, target = f"{workspace(spark)}/landing", new_layout(spark).table("gold", "orders")
    orders, day = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    stage_chunks(orders, landing, "orders", day)
    metrics = {
        "n_orders": Metric("count"),
        "n_finished": Metric("count", "CASE WHEN o_orderstatus = 'F' THEN 1 END"),
        "total": Metric("sum", "CAST(o_totalprice AS DECIMAL(18, 2))"),
        "least": Metric("min", "o_totalprice"),
        "most": Metric("max", "o_totalprice"),
        "last_day": Metric("max", "o_orderdate"),
        "customers": Metric("distinct", "o_custkey"),
        "median": Metric("quantile", "o_totalprice", 0.5),
    }
    rollup, delivered = Rollup(spark, target, ["o_orderpriority"], metrics), Landing(spark, landing)

    def update() -> dict[str, int]:
        return rollup.update(delivered.data_files(), lambda paths: read_chunks(spark, paths))

    update()
    years = orders.agg(F.min(F.year(day)).alias("first"), F.max(F.year(day)).alias("last")).first()
    shared = SharedFiles(spark)
    for path in delivered.paths(["orders"])["orders"]:
        if f"orders_{years.first}" in path or f"orders_{years.last}" in path:
            shared.delete(path)
    changed = orders.where(F.year(day) == years.last).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    stage_chunks(changed, landing, "orders", day)
    update()
    unread = update()["n_read"]
    now = delivered.chunks("orders")
    rank = F.col("o_totalprice") <= F.col("median")
    exact = now.join(spark.table(target.sql).select("o_orderpriority", "median"), "o_orderpriority").groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("n"), F.avg(rank.cast("double")).alias("share")
    )
    return spark.table(target.sql).join(exact, "o_orderpriority").select(
        "o_orderpriority", "n_orders", "n_finished", F.col("total").cast("double").alias("total"), "least", "most",
        F.date_format("last_day", "yyyy-MM-dd").alias("last_day"),
        (F.abs(F.col("customers") - F.col("n")) <= 0.1 * F.col("n")).alias("customers_close"),
        (F.abs(F.col("share") - 0.5) <= 0.05).alias("median_close"),
        F.lit(unread).cast("long").alias("read_again"),
    )
