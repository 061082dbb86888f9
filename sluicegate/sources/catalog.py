"""Catalogs, schemas and owner prefixes as DataFrames."""

from __future__ import annotations

import os
import warnings
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.config import Layout
from sluicegate.functions.naming import owner_prefix

PREFIX_VARIABLE = "SLUICEGATE_TABLE_PREFIX"


def find_catalog(spark: SparkSession, text: str) -> str:
    """First catalog whose name contains the text; upper and lower case differ."""
    match = spark.sql("SHOW CATALOGS").where(F.col("catalog").contains(text)).limit(1).collect()
    if not match:
        raise IndexError(f"no catalog name contains {text!r}")
    return match[0].catalog


def resolve_prefix(
    identity: str | None = None,
    spark: SparkSession | None = None,
    variable: str = PREFIX_VARIABLE,
) -> str:
    """Owner prefix from the argument, else an environment variable, else the session user.

    An empty string from any of them means no prefix.
    """
    session = spark or SparkSession.getActiveSession()
    if identity is None:
        identity = os.environ.get(variable)
    if identity == "":
        return ""
    if session is None:
        raise RuntimeError(f"no Spark session to resolve an owner prefix with; {variable} is not set")
    try:
        owner = F.current_user() if identity is None else F.lit(identity)
        return session.range(1).select(owner_prefix(owner)).first()[0]
    except PySparkException as error:
        raise RuntimeError(f"could not determine the owner prefix: {error}") from error


def schema_tables(spark: SparkSession, layout: Layout, schemas: tuple[str, ...]) -> DataFrame:
    """``schema, table_name`` of the tables in several schemas.

    Temporary views are left out; a schema that cannot be listed is warned about and skipped.
    """
    listings = []
    for schema in schemas:
        try:
            tables = spark.sql(f"SHOW TABLES IN {layout.namespace_sql(schema)}")
        except PySparkException as error:
            warnings.warn(f"could not list tables in {layout.namespace_sql(schema)}: {error}", stacklevel=2)
            continue
        tables = tables.where(~F.col("isTemporary"))
        listings.append(tables.select(F.lit(schema).alias("schema"), F.col("tableName").alias("table_name")))
    if not listings:
        return spark.createDataFrame([], "schema string, table_name string")
    return reduce(DataFrame.union, listings)


def prefixed_tables(spark: SparkSession, layout: Layout, prefix: str, schemas: tuple[str, ...]) -> DataFrame:
    """Tables whose name starts with the prefix; the catalog keeps names in lower case."""
    if not prefix:
        raise ValueError("the prefix is empty, which would select every table")
    tables = schema_tables(spark, layout, schemas)
    return tables.where(F.lower("table_name").startswith(prefix.lower()))
