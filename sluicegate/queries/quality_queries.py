"""Duplicates, conforming, expectations and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators import quality
from sluicegate.operators.quality import Conform, Counts
from sluicegate.plans.promote import promote, promote_many
from sluicegate.queries.registry import query, table
from sluicegate.queries.staging import new_layout
from sluicegate.sinks.runlog import RunLog
from sluicegate.sinks.tables import replace_table


@query("""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus) AS rn
      FROM lineitem)
    WHERE rn = 1
""")
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest shipment of every order line."""
    lines = table(spark, sf_dir, "lineitem")
    return quality.deduplicate(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query("""
    SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_kept,
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_removed
    FROM lineitem
""")
def duplicate_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_tally(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


CONFORM_RULES = {
    "user_id": Conform("bigint"),
    "event_type": Conform("string", case="upper"),
    "value": Conform("double"),
    "day": Conform("date"),
}


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text with blanks, and values and days that are not always readable."""
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("  "), "user_id", F.lit(" ")).alias("user_id"),
        F.concat(F.lit(" "), "event_type").alias("event_type"),
        F.when(failed, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(failed & (F.col("value") < 5), "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
    )


@query("""
    SELECT event_id, user_id, upper(event_type) AS event_type,
           CASE WHEN event_type <> 'error' THEN value END AS value,
           strftime(CASE WHEN NOT (event_type = 'error' AND value < 5) THEN ts END, '%Y-%m-%d') AS day
    FROM events
""")
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = quality.conform(_raw_events(spark, sf_dir), CONFORM_RULES)
    return events.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""
    SELECT 'user_id' AS "column", 0 * count(*) AS n_failed FROM events
    UNION ALL SELECT 'event_type', 0
    UNION ALL SELECT 'value', count(*) FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'day', count(*) FROM events WHERE event_type = 'error' AND value < 5
""")
def conform_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conform_failures(_raw_events(spark, sf_dir), CONFORM_RULES)


@query("""
    SELECT o_orderpriority, o_orderstatus, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
           count(DISTINCT o_custkey) AS n_customers, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day
    FROM orders GROUP BY o_orderpriority, o_orderstatus
""")
def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_layout(spark)
    silver, gold = layout.table("silver", "orders"), layout.table("gold", "order_summary")
    replace_table(table(spark, sf_dir, "orders"), silver)
    metrics = {
        "n_orders": F.count(F.lit(1)),
        "total": "double(sum(cast(o_totalprice AS decimal(18, 2))))",
        "n_customers": F.count_distinct("o_custkey"),
        "last_day": F.date_format(F.max("o_orderdate"), "yyyy-MM-dd"),
    }
    promote(
        spark, silver, gold, lambda df: quality.summarize(df, ["o_orderpriority", "o_orderstatus"], metrics)
    )
    return spark.table(gold.sql)


LINE_EXPECTATIONS = {
    "has_quantity": "l_quantity > 0",
    "small_discount": "l_discount <= 0.05",
    "not_returned": "nullif(l_returnflag, 'R') <> 'A'",
}


@query("""
    SELECT 'has_quantity' AS expectation, count(*) FILTER (l_quantity > 0) AS n_passed,
           count(*) FILTER (NOT l_quantity > 0) AS n_failed FROM lineitem
    UNION ALL SELECT 'small_discount', count(*) FILTER (l_discount <= 0.05),
           count(*) FILTER (NOT l_discount <= 0.05) FROM lineitem
    UNION ALL SELECT 'not_returned', count(*) FILTER (l_returnflag NOT IN ('A', 'R')),
           count(*) FILTER (l_returnflag IN ('A', 'R')) FROM lineitem
""")
def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectation_report(table(spark, sf_dir, "lineitem"), LINE_EXPECTATIONS)


@query("SELECT * FROM lineitem WHERE l_quantity > 0 AND l_discount <= 0.05 AND l_returnflag NOT IN ('A', 'R')")
def expectations_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_all(table(spark, sf_dir, "lineitem"), LINE_EXPECTATIONS, "drop")


@query("""
    WITH counts AS (
      SELECT 'rows' AS what, count(*) AS n FROM lineitem
      UNION ALL SELECT 'has_quantity', count(*) FILTER (NOT l_quantity > 0) FROM lineitem
      UNION ALL SELECT 'small_discount', count(*) FILTER (NOT l_discount <= 0.05) FROM lineitem
      UNION ALL SELECT 'not_returned', count(*) FILTER (l_returnflag IN ('A', 'R')) FROM lineitem)
    SELECT * FROM counts WHERE n > 0
""")
def expectations_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are all kept, and the violations that were counted on the way, from the log."""
    layout, counts = new_layout(spark), Counts()
    target = layout.table("silver", "lineitem")
    log = RunLog("quality", "silver", layout.table("ua", "logs"), spark, source="queries")
    replace_table(quality.expect_all(table(spark, sf_dir, "lineitem"), LINE_EXPECTATIONS, "warn", counts), target)
    counts.log(log, "write_silver", str(target))
    logged = log.query({"status": "warning"}).select(
        F.regexp_extract("message", r"violate (\w+)$", 1).alias("what"),
        F.regexp_extract("message", r": (\d+) rows", 1).cast("long").alias("n"),
    )
    return spark.table(target.sql).agg(F.lit("rows").alias("what"), F.count(F.lit(1)).alias("n")).union(logged)


@query("""
    SELECT 'read_bronze' AS step, 'success' AS status, 2::BIGINT AS n FROM region
    UNION SELECT 'write_silver', 'success', 1 FROM region
    UNION SELECT 'write_silver', 'failure', 1 FROM region
""")
def promotion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A promotion that succeeds and one whose transformation asks for a column that is not there."""
    layout = new_layout(spark)
    log = RunLog("promote", "silver", layout.table("ua", "logs"), spark, source="queries")
    source = layout.table("bronze", "orders")
    replace_table(table(spark, sf_dir, "orders"), source)
    targets = {
        layout.table("silver", "orders"): None,
        layout.table("silver", "failed"): lambda df: df.select("no_such_column"),
    }
    promote_many(spark, source, targets, log=log)
    return log.query().groupBy("step", "status").agg(F.count(F.lit(1)).alias("n"))
