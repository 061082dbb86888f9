"""Exceptions raised by ingest."""

from __future__ import annotations

from typing import Any


class NoDataFiles(FileNotFoundError):
    """The landing directory holds no data file."""


class MetaUnreadable(FileNotFoundError):
    """A table's expectations are missing or cannot be read."""


class StepFailed(RuntimeError):
    """Reading, writing or archiving failed; the cause is chained."""


class LogWriteFailed(RuntimeError):
    """Run-log events could not be written; ``results`` are those of the run, if there was one."""

    def __init__(self, message: str, results: dict[str, str] | None = None):
        super().__init__(message)
        self.results = results


class SchemaMismatch(Exception):
    """A table does not have the schema it should have."""


class GateFailure(Exception):
    """At least one check failed; carries the outcome of every check.

    Fixed interface; the attributes are what callers of a failed gate read:
        table_name: table that was measured.
        results: one row per check, in check order, at most five.
        passed_results, failed_results: the same rows split by outcome.
    """

    def __init__(self, table_name: str, text: str, results: list[Any], hint: str = ""):
        super().__init__(f"{text}\n{hint}" if hint else text)
        self.table_name = table_name
        self.results = results
        self.passed_results = [row for row in results if row["passed"]]
        self.failed_results = [row for row in results if not row["passed"]]
