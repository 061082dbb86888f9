"""Carry a table to the next layer."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sluicegate.config import History, Layout, TableRef
from sluicegate.sinks.runlog import RunLog
from sluicegate.sinks.tables import replace_table
from sluicegate.sources.catalog import resolve_prefix
from sluicegate.sources.files import run_each

Transform = Callable[[DataFrame], DataFrame]


def promote(
    spark: SparkSession,
    source: TableRef,
    target: TableRef,
    transform: Transform | None = None,
    table_format: str = "parquet",
    log: RunLog | None = None,
    history: History = History(),
) -> None:
    """Read a table, transform it (not at all by default) and replace the target with the result.

    Log steps are named after the layers, ``read_bronze`` and ``write_silver``, in every environment.
    A step that fails leaves a failure row.
    """
    with _step(log, f"read_{_layer(source)}", f"{source} is the source", f"reading {source}"):
        rows = spark.table(source.sql)
    with _step(log, f"write_{_layer(target)}", f"{target} was replaced", f"replacing {target}"):
        replace_table(transform(rows) if transform else rows, target, table_format, history)


def _layer(table: TableRef) -> str:
    return table.layer or table.namespace[-1]


@contextmanager
def _step(log: RunLog | None, step: str, done: str, doing: str) -> Iterator[None]:
    """Log a step's outcome."""
    try:
        yield
    except Exception as error:
        if log:
            log.failure(step, f"{doing} failed: {error}")
        raise
    if log:
        log.success(step, done)


def silver_job(
    spark: SparkSession,
    layout: Layout,
    table: str,
    identity: str | None = None,
    transform: Transform | None = None,
    table_format: str = "parquet",
    log: RunLog | None = None,
) -> TableRef:
    """Promote a shared bronze table to the silver table of an owner, and say which table that is.

    ``identity`` is an e-mail address or user name; see :func:`resolve_prefix` for what happens
    without one. Bronze tables have no prefix.
    """
    target = layout.table("silver", table, resolve_prefix(identity, spark))
    promote(spark, layout.table("bronze", table), target, transform, table_format, log)
    return target


def promote_many(
    spark: SparkSession,
    source: TableRef,
    targets: dict[TableRef, Transform | None],
    table_format: str = "parquet",
    log: RunLog | None = None,
    parallel_tables: int = 4,
) -> dict[TableRef, str]:
    """Derive several tables from one; gives ``success`` or the error text by target.

    Every target reads just the columns it needs. One that fails does not stop the others.
    """

    def one(item: tuple[TableRef, Transform | None]) -> str:
        target, transform = item
        try:
            promote(spark, source, target, transform, table_format, log)
        except Exception as error:  # noqa: BLE001 - user transforms raise anything
            return str(error)
        return "success"

    return dict(zip(targets, run_each(spark, one, list(targets.items()), parallel_tables), strict=True))
