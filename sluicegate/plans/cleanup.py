"""Drop the tables of one owner."""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from sluicegate.config import Layout
from sluicegate.sinks.tables import drop_table
from sluicegate.sources.catalog import prefixed_tables, resolve_prefix

OWNED_SCHEMAS = ("silver", "gold")

_logger = logging.getLogger(__name__)


def drop_prefixed(
    spark: SparkSession,
    layout: Layout,
    prefix: str | None = None,
    schemas: tuple[str, ...] = OWNED_SCHEMAS,
    dry_run: bool = False,
) -> list[str]:
    """Drop every table that starts with the prefix and return their names.

    A given prefix is taken as it is; without one the owner's is resolved. An empty prefix is
    refused. ``dry_run`` only lists. A table that cannot be dropped is not in the result.
    """
    prefix = resolve_prefix(spark=spark) if prefix is None else prefix
    names = []
    for row in prefixed_tables(spark, layout, prefix, schemas).collect():
        table = layout.table(row.schema, row.table_name)
        if not dry_run:
            try:
                drop_table(spark, table)
            except PySparkException as error:
                _logger.error("could not drop %s: %s", table, error)
                continue
        _logger.info("%s %s", "would drop" if dry_run else "dropped", table)
        names.append(str(table))
    return names
