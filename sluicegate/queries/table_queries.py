"""Layer tables, the run log, owner prefixes and clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.config import Layout
from sluicegate.functions import naming
from sluicegate.plans.cleanup import drop_prefixed as drop_owned
from sluicegate.plans.promote import promote_many, silver_job
from sluicegate.queries.registry import query, table
from sluicegate.queries.staging import new_layout
from sluicegate.sinks.runlog import RunLog
from sluicegate.sinks.tables import replace_table
from sluicegate.sources.catalog import prefixed_tables as list_owned
from sluicegate.sources.catalog import schema_tables


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def bronze_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery with fewer rows and columns replaces the first one altogether."""
    target = new_layout(spark).table("bronze", "orders")
    orders = table(spark, sf_dir, "orders")
    replace_table(orders, target)
    finished = orders.where(F.col("o_orderstatus") == "F")
    replace_table(finished.select("o_orderkey", "o_custkey", "o_totalprice"), target)
    return spark.table(target.sql)


def _adults(customers: DataFrame) -> DataFrame:
    """The balance stands in for an age: filter, then derive a flag."""
    return customers.where(F.col("c_acctbal") >= 0).withColumn("is_large", F.col("c_acctbal") >= 5000)


@query("SELECT *, c_acctbal >= 5000 AS is_large FROM customer WHERE c_acctbal >= 0")
def silver_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_layout(spark)
    replace_table(table(spark, sf_dir, "customer"), layout.table("bronze", "customer"))
    silver_job(spark, layout, "customer", "jane.doe@example.org", _adults)
    return spark.table(layout.table("silver", "customer", "doe_").sql)


@query("""
    SELECT 'customer_orders' AS target, count(DISTINCT o_custkey) AS n_rows, count(*) AS n_orders FROM orders
    UNION ALL SELECT 'open_orders', count(*), count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'order_copy', count(*), count(*) FROM orders
""")
def promote_several(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_layout(spark)
    bronze = layout.table("bronze", "orders")
    replace_table(table(spark, sf_dir, "orders"), bronze)
    one = F.lit(1).cast("bigint").alias("n_orders")
    transforms = {
        "customer_orders": lambda df: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")),
        "open_orders": lambda df: df.where(F.col("o_orderstatus") == "O").select("*", one),
        "order_copy": lambda df: df.select("*", one),
    }
    targets = {layout.table("silver", name): transform for name, transform in transforms.items()}
    promote_many(spark, bronze, targets)
    counts = [
        spark.table(target.sql).agg(
            F.lit(target.name).alias("target"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("n_orders").alias("n_orders"),
        )
        for target in targets
    ]
    return reduce(DataFrame.union, counts)


# ---- run log --------------------------------------------------------------------------------


def _event_log(spark: SparkSession, sf_dir: str) -> RunLog:
    """Every event of the table as a row of a new log."""
    log = RunLog("events", "replay", new_layout(spark).table("ua", "logs"), spark, source="queries")
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("ts").cast("timestamp").alias("time"),
        F.concat(F.lit("user"), "user_id").alias("user"),
        F.lit(log.domain).alias("domain"),
        F.lit(log.process).alias("process"),
        kind.alias("step"),
        F.lit(log.source).alias("source"),
        F.when(kind == "error", "failure").when(F.col("value") < 5, "warning").otherwise("success").alias("status"),
        F.col("props").alias("message"),
    )
    log.append(rows)
    return log


_LOG_SQL = """
    SELECT strftime(ts, '%Y-%m-%d') AS "date", 'user' || user_id AS "user", 'events' AS domain,
           'replay' AS process, event_type AS step, 'queries' AS source,
           CASE WHEN event_type = 'error' THEN 'failure' WHEN value < 5 THEN 'warning' ELSE 'success' END
             AS status, props AS message
    FROM events
"""


@query(f"SELECT * FROM ({_LOG_SQL}) WHERE status = 'warning' AND step = 'click'")
def runlog_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_log(spark, sf_dir).query({"status": "warning", "step": "click"}).drop("time")


@query(f"SELECT * FROM ({_LOG_SQL})")
def runlog_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_log(spark, sf_dir).query().drop("time")


@query(f"""
    SELECT status, least(100, count(*)) AS n FROM ({_LOG_SQL}) WHERE status = 'failure' GROUP BY status
""")
def runlog_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a limit keeps is not defined, so only their number is shown."""
    rows = _event_log(spark, sf_dir).query({"status": "failure"}, limit=100)
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---- owner prefixes -------------------------------------------------------------------------


@query("""
    WITH ids AS (
      SELECT 'jane.' || c_name || '@example.org' AS identity, c_mktsegment AS t FROM customer
      UNION ALL SELECT replace(p_name, ' ', '.') || '@example.org', p_type FROM part
      UNION ALL SELECT s_name, 'supplier' FROM supplier
    ), owners AS (
      SELECT *, string_split(string_split(identity, '@')[1], '.')[-1] AS owner FROM ids
    ), prefixes AS (
      SELECT *, trim(regexp_replace(regexp_replace(owner, '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '_')
             AS word FROM owners
    )
    SELECT identity, owner, CASE WHEN word = '' THEN '' ELSE word || '_' END AS prefix,
           'silver.' || CASE WHEN word = '' THEN '' ELSE word || '_' END || t AS target
    FROM prefixes
""")
def owner_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.lit("@example.org")
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("jane."), "c_name", host).alias("identity"), F.col("c_mktsegment").alias("t")
    )
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.translate("p_name", " ", "."), host), "p_type"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_name", F.lit("supplier"))
    identity = F.col("identity")
    prefix = naming.owner_prefix(identity)
    return customers.union(parts).union(suppliers).select(
        "identity",
        naming.owner_of(identity).alias("owner"),
        prefix.alias("prefix"),
        naming.qualified_name(F.lit("silver"), prefix, F.col("t")).alias("target"),
    )


def _owned(spark: SparkSession, sf_dir: str) -> Layout:
    """Tables of two owners and a shared one in silver and gold."""
    layout = new_layout(spark)
    for schema, prefix, name in (
        ("silver", "doe_", "orders"),
        ("silver", "doe_", "customer"),
        ("silver", "", "supplier"),
        ("silver", "roe_", "orders"),
        ("gold", "doe_", "part"),
    ):
        replace_table(table(spark, sf_dir, name), layout.table(schema, name, prefix))
    spark.sql("CREATE OR REPLACE TEMP VIEW doe_view AS SELECT 1 AS x")
    return layout


def _with_row_counts(spark: SparkSession, layout: Layout, tables: DataFrame) -> DataFrame:
    counts = [
        spark.table(layout.table(row.schema, row.table_name).sql).agg(
            F.lit(row.schema).alias("schema"),
            F.lit(row.table_name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for row in tables.collect()
    ]
    return reduce(DataFrame.union, counts)


@query("""
    SELECT 'silver' AS schema, 'doe_orders' AS table_name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'silver', 'doe_customer', count(*) FROM customer
    UNION ALL SELECT 'gold', 'doe_part', count(*) FROM part
""")
def prefixed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _owned(spark, sf_dir)
    return _with_row_counts(spark, layout, list_owned(spark, layout, "DOE_", ("silver", "gold")))


@query("""
    SELECT 'silver' AS schema, 'roe_orders' AS table_name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'silver', 'supplier', count(*) FROM supplier
""")
def drop_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _owned(spark, sf_dir)
    drop_owned(spark, layout, "doe_")
    return _with_row_counts(spark, layout, schema_tables(spark, layout, ("silver", "gold")))
