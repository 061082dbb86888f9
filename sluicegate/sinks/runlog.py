"""A run log kept in a table: one row per step of a pipeline."""

from __future__ import annotations

import datetime as dt
import os
import sys
import threading
from functools import reduce
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import TableRef
from sluicegate.errors import LogWriteFailed

# Columns of the log table, and the closed set of statuses.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType(), False),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("user", T.StringType(), False),
        T.StructField("domain", T.StringType(), False),
        T.StructField("process", T.StringType(), False),
        T.StructField("step", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("message", T.StringType(), True),
    ]
)
STATUSES = ("success", "warning", "failure")
UNKNOWN_USER = "unknown_user"
UNKNOWN_SOURCE = "unknown_source"

_ARROW_TYPES = [
    pa.timestamp("us", "UTC") if isinstance(f.dataType, T.TimestampType) else pa.string() for f in LOG_SCHEMA
]


def session_user(spark: SparkSession) -> str:
    """The session's user, else the operating system's."""
    try:
        return spark.range(1).select(F.current_user()).first()[0]
    except PySparkException:
        return os.environ.get("USER") or os.environ.get("USERNAME") or UNKNOWN_USER


class RunLog:
    """Appends events to a log table and queries it.

    Events carry the moment they happened and wait in a buffer: one append per ``buffer_size``
    events, per :meth:`flush` and per :meth:`query`, instead of one per event. Threads may share a
    log.
    ``buffer_size=1`` makes every event durable at once. Use it as a context manager, or flush in
    a ``finally``, so that a failing run keeps its events.

    Appends from one process are made one after the other. For writers in several applications
    use a transactional ``table_format`` or a log table per application: plain file formats share
    one temporary directory per table.
    """

    def __init__(
        self,
        domain: str,
        process: str,
        table: TableRef,
        spark: SparkSession | None = None,
        source: str | None = None,
        table_format: str = "parquet",
        partition_by: tuple[str, ...] = (),
        buffer_size: int = 200,
    ):
        if not domain or not process:
            raise ValueError("domain and process must not be empty")
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            raise RuntimeError("there is no active Spark session; pass one")
        self.spark = spark
        self.domain = domain
        self.process = process
        self.table = table
        self.source = source or Path(sys.argv[0] if sys.argv else "").name or UNKNOWN_SOURCE
        self.user = session_user(spark)
        self._format = table_format
        self._partition_by = partition_by
        self._buffer_size = buffer_size
        self._events: list[tuple] = []
        self._buffer_lock = threading.Lock()
        self._write_lock = threading.Lock()

    def event(
        self, step: str, status: str, message: str, source: str | None = None, durable: bool = True
    ) -> None:
        """Record one event; a full buffer is written out, and so is a failure with all before it.

        With ``durable=False`` a failure waits like any other event, for callers that flush soon: a table
        that fails several checks costs one append instead of one for each.
        """
        if not step or not message:
            raise ValueError("step and message must not be empty")
        if status not in STATUSES:
            raise ValueError(f"status must be one of {', '.join(STATUSES)}, not {status!r}")
        now = dt.datetime.now().astimezone()
        row = (now.date().isoformat(), now, self.user, self.domain, self.process, step)
        with self._buffer_lock:
            self._events.append((*row, source or self.source, status, message))
            full = (durable and status == "failure") or len(self._events) >= self._buffer_size
        if full:
            self.flush()

    def success(self, step: str, message: str, source: str | None = None) -> None:
        self.event(step, "success", message, source)

    def warning(self, step: str, message: str, source: str | None = None) -> None:
        self.event(step, "warning", message, source)

    def failure(self, step: str, message: str, source: str | None = None) -> None:
        self.event(step, "failure", message, source)

    def flush(self, wait: bool = True) -> None:
        """Append the waiting events; if that fails they stay in the buffer.

        Without ``wait``, an append that is under way elsewhere is not waited for; the events are
        written by the next flush.
        """
        if not self._write_lock.acquire(blocking=wait):
            return
        try:
            with self._buffer_lock:
                waiting = list(self._events)
            if not waiting:
                return
            columns = [pa.array(values, kind) for values, kind in zip(zip(*waiting), _ARROW_TYPES)]
            rows = pa.Table.from_arrays(columns, LOG_SCHEMA.fieldNames())
            self._append(self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1))
            with self._buffer_lock:
                del self._events[: len(waiting)]
        finally:
            self._write_lock.release()

    def append(self, rows: DataFrame) -> None:
        """Append a whole DataFrame of log rows, with the log's columns in any order."""
        with self._write_lock:
            self._append(rows.select(*LOG_SCHEMA.fieldNames()))

    def _append(self, rows: DataFrame) -> None:
        writer = rows.write.format(self._format).mode("append").partitionBy(*self._partition_by)
        try:
            writer.saveAsTable(self.table.sql)
        except Exception as error:
            raise LogWriteFailed(f"could not write to the log table {self.table}: {error}") from error

    def query(self, filters: dict[str, Any] | None = None, limit: int | None = None) -> DataFrame:
        """Log rows whose columns equal all the given values, at most ``limit`` of them.

        ``None`` as a value matches nothing, as in SQL; no limit or zero means all rows.
        """
        self.flush()
        try:
            rows = self.spark.table(self.table.sql)
            if filters:
                tests = [rows[column] == F.lit(value) for column, value in filters.items()]
                rows = rows.where(reduce(lambda left, right: left & right, tests))
            return rows.limit(limit) if limit else rows
        except PySparkException as error:
            raise RuntimeError(f"could not read the log table {self.table}: {error}") from error

    def __enter__(self) -> RunLog:
        return self

    def __exit__(self, *exc_info: object) -> None:
        self.flush()
