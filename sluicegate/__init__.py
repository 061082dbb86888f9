"""Gated ingest of delivered files into layered tables, on Spark."""

from sluicegate.config import IngestSettings, Layout, TableRef
from sluicegate.errors import (
    GateFailure,
    LogWriteFailed,
    MetaUnreadable,
    NoDataFiles,
    SchemaMismatch,
    StepFailed,
)
from sluicegate.plans.cleanup import drop_prefixed
from sluicegate.plans.ingest import Ingest, bronze_job, outcome_frame, run_tally
from sluicegate.plans.promote import promote, promote_many, silver_job
from sluicegate.sinks.runlog import RunLog
from sluicegate.sinks.tables import replace_table
from sluicegate.sources.catalog import find_catalog, prefixed_tables, resolve_prefix, schema_tables
from sluicegate.sources.landing import Landing, read_chunks

__all__ = [
    "GateFailure",
    "Ingest",
    "IngestSettings",
    "Landing",
    "Layout",
    "LogWriteFailed",
    "MetaUnreadable",
    "NoDataFiles",
    "RunLog",
    "SchemaMismatch",
    "StepFailed",
    "TableRef",
    "bronze_job",
    "drop_prefixed",
    "find_catalog",
    "outcome_frame",
    "prefixed_tables",
    "promote",
    "promote_many",
    "read_chunks",
    "replace_table",
    "resolve_prefix",
    "run_tally",
    "schema_tables",
    "silver_job",
]
