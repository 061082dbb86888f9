"""Gated ingest: landing files to bronze tables, one table at a time or several at once."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicegate.config import IngestSettings
from sluicegate.errors import GateFailure, LogWriteFailed, MetaUnreadable, NoDataFiles, StepFailed
from sluicegate.functions import naming
from sluicegate.operators.checks import CHECKS, check_table, report_text, verdicts
from sluicegate.operators.schema import require_every_column, require_schema
from sluicegate.sinks.runlog import RunLog
from sluicegate.sinks.tables import replace_table, restore_table
from sluicegate.sources.files import SharedFiles, run_each
from sluicegate.sources.footers import footer_frame
from sluicegate.sources.landing import Landing, dropped_columns, read_chunks
from sluicegate.sources.quarantine import split_lines

SUCCESS = "success"

# Steps as they appear in the run log, beside the names of the checks.
DISCOVER = "discover_tables"
EXTRACT = "extract"
EXTRACT_TABLE = "extract_table"
READ_META = "read_meta"
READ_CHUNKS = "read_chunks"
VALIDATE = "validate"
WRITE = "write_to_bronze"
ARCHIVE = "archive_files"
PIPELINE = "pipeline"

# Formats that are read column by column.
COLUMNAR_FORMATS = frozenset({"parquet", "orc"})

_logger = logging.getLogger(__name__)


@dataclass
class TableWork:
    """What one table's ingest needs, fixed when the run starts.

    Files that arrive later are neither read nor archived by this run.
    """

    table: str
    moves: list[tuple[str, str]] = field(default_factory=list)  # (file, archive file), meta last
    known: dict[str, str | None] | Exception | None = None
    interrupted: str = ""  # what an archiving that died has left behind

    @property
    def paths(self) -> list[str]:
        return [src for src, _ in self.moves[:-1]]


class Ingest:
    """Replaces bronze tables by delivered data that passes its checks.

    For each table: read the expectations, union the chunks, measure and compare, replace the
    bronze table, move the files to the archive. The first failure ends that table: a failed gate
    writes nothing, and files are only moved once the table is complete.
    """

    def __init__(
        self,
        spark: SparkSession,
        settings: IngestSettings,
        log: RunLog,
        shared: SharedFiles | None = None,
    ):
        self.spark = spark
        self.settings = settings
        self.log = log
        self.landing = Landing(spark, settings.landing_path, shared)
        self.day = settings.archive_day or dt.date.today()
        self._log_errors: list[LogWriteFailed] = []
        self._staged: dict[str, str] = {}  # lines of tables that are worked on

    def run(self, tables: list[str]) -> dict[str, str]:
        """Ingest the requested tables; gives ``success`` or the error text by table name.

        A table that fails or is not there does not stop the others. Each name is worked on once.
        If the log could not be written, the error raised at the end carries the results.
        """
        tables = list(dict.fromkeys(tables))
        first: dict[str, str] = {}
        for table in tables:
            first.setdefault(table.lower(), table)
        self._log_errors.clear()
        try:
            self._require_renames()
            work = self._discover(tables)
            refused = {table: self._refuse(table, first[table.lower()]) for table in tables if first[table.lower()] != table}
            items = [(table, work.get(table)) for table in tables if table not in refused]
            outcomes = run_each(self.spark, self._one, items, self.settings.parallel_tables)
            done = dict(zip([table for table, _ in items], outcomes, strict=True)) | refused
            results = {table: done[table] for table in tables}
            self._summary(results)
        finally:
            self._flush()
        if self._log_errors:
            raise LogWriteFailed(str(self._log_errors[0]), results) from self._log_errors[0]
        return results

    def _require_renames(self) -> None:
        """Files are archived by renaming them, which needs one file system."""
        shared, settings = self.landing.shared, self.settings
        if not shared.same_system(settings.landing_path, settings.archive_path):
            message = f"{settings.landing_path} and {settings.archive_path} are on different file systems"
            self._note("failure", ARCHIVE, message)
            raise StepFailed(message)
        shared.make_dir(settings.archive_path)

    def _refuse(self, table: str, first: str) -> str:
        """Table names that differ only in case would be one table in the catalog."""
        message = f"'{table}' was not ingested: its name differs only in case from '{first}'"
        self._note("failure", EXTRACT, message)
        return message

    def _discover(self, tables: list[str]) -> dict[str, TableWork]:
        """Files and expectations of the requested tables that are there, from a single listing.

        Only names pass through the driver, as they do in any Spark file scan.
        """
        listed = self.landing.data_files()
        interrupted, numbers = self._archived(tables)
        frames = [
            self.landing.manifest(listed),
            self.landing.work_list(tables, self.settings.archive_path, self.day, listed, numbers),
        ]
        manifest, files = run_each(self.spark, DataFrame.collect, frames, len(frames))
        if not manifest:
            message = f"{self.landing.root} holds no data file"
            self._note("failure", DISCOVER, message)
            raise NoDataFiles(message)
        counts = ", ".join(f"{row.table_name} {row.n_files}" for row in sorted(manifest))
        self._note(SUCCESS, DISCOVER, f"files by table: {counts}")
        there = {row.table_name for row in manifest}
        found = [table for table in tables if table in there]
        known = self.landing.expectations(found) if found else {}
        work = {table: TableWork(table, known=known[table], interrupted=interrupted.get(table, "")) for table in found}
        # Data files first: the meta file is what a rerun needs most.
        for row in sorted(files, key=lambda row: (row.kind == "meta", row.src)):
            if row.table_name in work:
                work[row.table_name].moves.append((row.src, row.dest))
        return work

    def _archived(self, tables: list[str]) -> tuple[dict[str, str], dict[str, int]]:
        """From one listing of the archive: interrupted deliveries, and today's numbers, by table.

        Only deliveries of this day or without their meta reach the driver.
        """
        archive = Landing(self.spark, self.settings.archive_path, self.landing.shared)
        today = F.col("day") == f"{self.day:%Y%m%d}"
        # A meta may have been a directory, which a listing of files does not show.
        names = set(self.landing.shared.names(archive.root))
        rows = archive.deliveries().where(F.col("table_name").isin(*tables) & (today | (F.col("n_meta") == 0)))
        interrupted, numbers = {}, {}
        for row in rows.collect():
            if row.n_meta == 0 and f"{row.table_name}{row.stamp}{naming.META_SUFFIX}" not in names:
                interrupted[row.table_name] = f"{row.n_files} files of '{row.table_name}' are archived as {row.stamp} already"
            if row.day == f"{self.day:%Y%m%d}":
                numbers[row.table_name] = max(numbers.get(row.table_name, 1), row.number + 1)
        return interrupted, numbers

    def _one(self, item: tuple[str, TableWork | None]) -> str:
        table, work = item
        if work is None:
            message = f"'{table}' was requested but not found in {self.landing.root}"
            self._note("failure", EXTRACT, message)
            return message
        try:
            self._ingest(work)
            return SUCCESS
        except Exception as error:  # noqa: BLE001 - whatever went wrong belongs to this table
            _logger.debug("ingest of %s failed", table, exc_info=error)
            self._note("failure", EXTRACT, f"'{table}' was not ingested: {error}")
            return str(error)
        finally:
            if table in self._staged:
                self.landing.shared.delete(self._staged.pop(table))
            self._flush(wait=False)

    def _ingest(self, work: TableWork) -> None:
        table, target = work.table, self.settings.bronze(work.table)
        restore_table(self.spark, target)
        self._note(SUCCESS, EXTRACT_TABLE, f"'{table}' begins with {len(work.paths)} data files")
        if isinstance(work.known, Exception):
            self._note("failure", READ_META, f"expectations of '{table}': {work.known}")
            raise MetaUnreadable(str(work.known)) from work.known
        self._note(SUCCESS, READ_META, f"expectations of '{table}': {', '.join(sorted(work.known)) or 'none'}")
        if work.interrupted:
            # A run died while archiving: what is left in landing is only a part of the delivery.
            message = f"{work.interrupted}, without their meta file; put them back or archive the rest"
            self._note("failure", ARCHIVE, message)
            raise StepFailed(message)
        with self._step(READ_CHUNKS, f"reading {self.settings.file_format} chunks of '{table}'"):
            df = self._read(work)
        self._gate(df, work)
        with self._step(WRITE, f"replacing {target}"):
            replace_table(df, target, self.settings.table_format, self.settings.history)
        self._note(SUCCESS, WRITE, f"{target} was replaced")
        with self._step(ARCHIVE, f"archiving files of '{table}'"):
            self.landing.shared.move_all(work.moves[:-1], work.moves[-1:])
        self._note(SUCCESS, ARCHIVE, f"{len(work.moves)} files of '{table}' are in {self.settings.archive_path}")
        self._note(SUCCESS, EXTRACT_TABLE, f"'{table}' is done")

    def _read(self, work: TableWork) -> DataFrame:
        settings, schema = self.settings, self.settings.table_schemas.get(work.table)
        if settings.quarantine_path and schema and settings.file_format in ("csv", "json"):
            return self._read_lines(work, schema)
        typed = settings.file_format in COLUMNAR_FORMATS  # the files know their schema
        # With a schema to enforce, the columns of all footers count, whatever the order of files.
        df = read_chunks(
            self.spark,
            work.paths,
            settings.file_format,
            None if typed else schema,
            settings.merge_schema or (typed and schema is not None),
            settings.file_options,
        )
        if typed and schema:
            require_schema(df, schema)
            require_every_column(self.spark, work.paths, settings.file_format, df)
        elif not settings.merge_schema:
            dropped = dropped_columns(self.spark, work.paths, settings.file_format, df, settings.file_options)
            if dropped:
                message = f"'{work.table}': only some chunks have {', '.join(dropped)}; the table will not"
                self._note("warning", READ_CHUNKS, message)
        return df

    def _read_lines(self, work: TableWork, schema: StructType) -> DataFrame:
        """The lines that fit the schema; the others go to a folder of this run, and a warning counts them."""
        settings = self.settings
        run = f"{settings.quarantine_path}{work.table}/{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}"
        self._staged[work.table] = f"{run}-lines"
        split = split_lines(self.spark, work.paths, settings.file_format, schema, f"{run}-lines", settings.file_options)
        if not split.broken.isEmpty():
            split.broken.write.parquet(f"{run}-broken")
            n_broken = self.spark.read.parquet(f"{run}-broken").count()
            self._note("warning", READ_CHUNKS, f"'{work.table}': {n_broken} broken lines are in {run}-broken")
        return split.good

    def _gate(self, df: DataFrame, work: TableWork) -> None:
        """Measure in one job, log every check, and raise unless all passed."""
        table = work.table
        with self._step(READ_CHUNKS, f"measuring chunks of '{table}'"):
            verdict = self._verdict(df, work)
        n_rows = [row.actual for row in verdict.results if row.check_name == CHECKS[0].name]
        rows = f", {n_rows[0]} rows" if n_rows else ""
        self._note(SUCCESS, READ_CHUNKS, f"'{table}' was read: {len(work.paths)} chunks{rows}")
        for result in verdict.results:
            self._note(SUCCESS if result.passed else "failure", result.check_name, result.message)
        if not verdict.passed:
            raise GateFailure(table, verdict.text, verdict.results)
        self._note(SUCCESS, VALIDATE, f"'{table}' passes {verdict.n_checks} checks")

    def _verdict(self, df: DataFrame, work: TableWork) -> Row:
        """The tally of a table's checks, from one job."""
        settings = self.settings

        def tally(footers: DataFrame | None) -> Row:
            one_scan = settings.file_format not in COLUMNAR_FORMATS and not settings.quarantine_path
            report = check_table(df, work.table, work.known, one_scan, footers, settings.bitmaps)
            return verdicts(report).select("*", report_text(F.lit(work.table)).alias("text")).first()

        if not settings.footers or settings.file_format != "parquet":
            return tally(None)
        try:
            return tally(footer_frame(self.spark, work.paths, settings.merge_schema))
        except Exception as error:  # noqa: BLE001 - footers without figures surface as any error
            _logger.debug("footers of %s cannot be used", work.table, exc_info=error)
            return tally(None)

    def _summary(self, results: dict[str, str]) -> None:
        n_failed = sum(outcome != SUCCESS for outcome in results.values())
        self._note(
            "warning" if n_failed else SUCCESS,
            EXTRACT,
            f"{len(results)} tables requested: {len(results) - n_failed} ingested, {n_failed} failed",
        )

    def _note(self, status: str, step: str, message: str) -> None:
        """Log an event, written when its table is done; a log that cannot be written must not make a table look failed."""
        try:
            self.log.event(step, status, message, durable=False)
        except LogWriteFailed as error:
            self._log_errors.append(error)

    def _flush(self, wait: bool = True) -> None:
        try:
            self.log.flush(wait)
        except LogWriteFailed as error:
            self._log_errors.append(error)

    @contextmanager
    def _step(self, step: str, what: str) -> Iterator[None]:
        """Logs an error of a step and wraps it."""
        try:
            yield
        except Exception as error:
            message = f"{what} failed: {error}"
            self._note("failure", step, message)
            raise StepFailed(message) from error


def outcome_frame(spark: SparkSession, results: dict[str, str]) -> DataFrame:
    """Run results as ``table_name, status, error``."""
    rows = [
        {"table_name": table, "status": outcome if outcome == SUCCESS else "failure",
         "error": None if outcome == SUCCESS else outcome}
        for table, outcome in results.items()
    ]
    schema = pa.schema([("table_name", pa.string()), ("status", pa.string()), ("error", pa.string())])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema))


def run_tally(outcomes: DataFrame) -> DataFrame:
    """``n_succeeded, n_failed, n_tables, status`` of a run."""
    n_failed = F.count_if(F.col("status") != SUCCESS)
    return outcomes.agg(
        F.count_if(F.col("status") == SUCCESS).alias("n_succeeded"),
        n_failed.alias("n_failed"),
        F.count(F.lit(1)).alias("n_tables"),
        F.when(n_failed == 0, SUCCESS).otherwise("warning").alias("status"),
    )


def bronze_job(spark: SparkSession, settings: IngestSettings, tables: list[str], log: RunLog) -> int:
    """Ingest and give a process exit code: 0 when every table succeeded, else 1."""
    results = Ingest(spark, settings, log).run(tables)
    failed = [table for table, outcome in results.items() if outcome != SUCCESS]
    if failed:
        log.failure(PIPELINE, f"{len(failed)} of {len(results)} tables failed: {', '.join(failed)}")
    else:
        log.success(PIPELINE, f"ingested {', '.join(results) or 'nothing'}")
    log.flush()
    for table, outcome in results.items():
        _logger.log(logging.ERROR if table in failed else logging.INFO, "%s: %s", table, outcome)
    return 1 if failed else 0
