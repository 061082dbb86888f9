"""Where things live: table addresses and ingest settings."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


def quote(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


@dataclass(frozen=True)
class History:
    """How long replaced versions of a table stay readable, and how many of them at most."""

    keep: dt.timedelta = dt.timedelta(days=1)
    most: int | None = None


@dataclass(frozen=True)
class TableRef:
    """A table in a namespace; ``str()`` gives the plain name, ``sql`` the quoted one."""

    namespace: tuple[str, ...]
    name: str
    # The schema's name without the prefix of an environment.
    layer: str = field(default="", compare=False)

    @property
    def sql(self) -> str:
        return ".".join(quote(part) for part in (*self.namespace, self.name))

    def sibling(self, name: str) -> TableRef:
        return TableRef(self.namespace, name, self.layer)

    def __str__(self) -> str:
        return ".".join((*self.namespace, self.name))


@dataclass(frozen=True)
class Layout:
    """Addresses of the layers.

    With a catalog of its own an environment is addressed as ``catalog.schema.table``. A session
    that has only ``spark_catalog`` can keep environments apart with ``db_prefix`` instead, giving
    ``spark_catalog.{db_prefix}{schema}.table``.
    """

    catalog: str = "spark_catalog"
    db_prefix: str = ""

    def __post_init__(self) -> None:
        if not self.catalog.strip():
            raise ValueError("catalog must not be blank")

    def namespace(self, schema: str) -> tuple[str, ...]:
        return (self.catalog, f"{self.db_prefix}{schema}")

    def namespace_sql(self, schema: str) -> str:
        return ".".join(quote(part) for part in self.namespace(schema))

    def table(self, schema: str, table: str, prefix: str = "") -> TableRef:
        return TableRef(self.namespace(schema), f"{prefix}{table}", schema)


def _directory(path: str) -> str:
    if not path.strip():
        raise ValueError("directory path must not be blank")
    return path if path.endswith("/") else path + "/"


@dataclass(frozen=True)
class IngestSettings:
    """Settings of a gated ingest run.

    Attributes:
        layout: table addresses.
        landing_path, archive_path: directories on storage every executor can reach.
        bronze_schema: schema the tables are written to.
        table_format: format of bronze tables.
        file_format, file_options, merge_schema: how landing files are read.
        table_schemas: schemas of some tables. Parquet files that have another one fail before they
            are read; CSV and JSON files are read with it, and without it Spark infers one.
        footers: measure row counts, and ranges of dates, from the footers of parquet files; a file whose footer
            does not state them is read.
        bitmaps: count distinct ids that are whole numbers as bits; without it they are shuffled.
        quarantine_path: directory that takes the broken lines of CSV and JSON files with a schema, in a folder
            for each table and run; without it a broken line fails its table.
        history: how long replaced bronze tables stay readable.
        parallel_tables: tables worked on at the same time; each stays a separate Spark job.
        archive_day: day stamped on archived files, today when not given.
    """

    layout: Layout
    landing_path: str
    archive_path: str
    bronze_schema: str = "bronze"
    table_format: str = "parquet"
    file_format: str = "parquet"
    file_options: dict[str, str] = field(default_factory=dict)
    merge_schema: bool = False
    table_schemas: dict[str, StructType] = field(default_factory=dict)
    footers: bool = False
    bitmaps: bool = True
    quarantine_path: str | None = None
    history: History = History()
    parallel_tables: int = 4
    archive_day: dt.date | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "landing_path", _directory(self.landing_path))
        object.__setattr__(self, "archive_path", _directory(self.archive_path))
        if self.quarantine_path is not None:
            object.__setattr__(self, "quarantine_path", _directory(self.quarantine_path))
        if self.parallel_tables < 1:
            raise ValueError("parallel_tables must be at least 1")

    def bronze(self, table: str) -> TableRef:
        return self.layout.table(self.bronze_schema, table)
