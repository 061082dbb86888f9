"""Replace a table as a whole, and read what it was before."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluicegate.config import History, TableRef, quote
from sluicegate.sources.files import SharedFiles, literal_path

# Formats whose overwrite is one transaction. None of them is on this project's test classpath.
TRANSACTIONAL_FORMATS = frozenset({"delta", "iceberg", "hudi"})
# Formats whose files state their schema, so that a version can be read without its catalog entry.
SELF_DESCRIBING_FORMATS = frozenset({"parquet", "orc", "avro"})

# A table's versions lie in a folder beside it. No table of the session catalog has a dot in its name.
VERSIONS = ".versions"
_NEXT = "_next-"
_PAST = "_past-"
_STAMP = "%Y%m%dT%H%M%S%f"


class Version(NamedTuple):
    """One state of a table: ``name`` is its folder; ``replaced`` is None for the present one."""

    name: str
    replaced: dt.datetime | None

    @property
    def written(self) -> dt.datetime:
        return _moment(self.name.partition("-")[0])

    @property
    def table_format(self) -> str:
        return self.name.rpartition("-")[2]


def replace_table(
    df: DataFrame, target: TableRef, table_format: str = "parquet", history: History = History()
) -> None:
    """Replace a table, schema included; if writing fails the old table is still there.

    Plain file formats drop the old table before they write. For them the rows go to a folder of
    their own below the schema's location, and the table's location is set to it once it is complete.
    Nothing is copied, and no other table is touched. A changed schema needs a new catalog entry: the
    old one is dropped, and a mark in the folder lets :func:`restore_table` finish that step after a
    crash. A table may be replaced by a query that reads it. One writer per target at a time; what a
    killed writer leaves in the folder is removed by the next one.

    What was replaced stays in the folder as long as ``history`` says, so that a reader that has opened
    it can finish, and :func:`table_as_of` can read it. The next replacement removes what is older.
    """
    if table_format in TRANSACTIONAL_FORMATS:
        writer = df.write.format(table_format)
        if table_format == "delta":
            writer = writer.option("overwriteSchema", True)
        writer.mode("overwrite").saveAsTable(target.sql)
        return
    spark = df.sparkSession
    restore_table(spark, target)
    folder = _folder(spark, target)
    version = f"{_now():{_STAMP}}-{uuid.uuid4().hex[:8]}-{table_format}"
    df.write.format(table_format).save(f"{folder}/{version}")
    files = SharedFiles(spark)
    entry = _entry(spark, target)
    before = entry.version if entry else None
    replaced = _now()
    if before:
        files.make_dir(f"{folder}/{_PAST}{before}~{replaced:{_STAMP}}")
    if entry and before and entry.table_format == table_format and entry.shape == _shape(df.schema):
        spark.sql(f"ALTER TABLE {target.sql} SET LOCATION {_text(f'{folder}/{version}')}")
        spark.catalog.refreshTable(target.sql)
    else:
        mark = f"{folder}/{_NEXT}{version}"
        files.make_dir(mark)
        drop_entry(spark, target)
        _create(spark, target, f"{folder}/{version}", table_format, df.schema)
        files.delete(mark)
    _prune(files, folder, version, replaced, history)


def _prune(files: SharedFiles, folder: str, present: str, now: dt.datetime, history: History) -> None:
    """Remove versions that are too old or too many, and folders that never were a version."""
    names = files.names(folder)
    past = [version for version in _past(names) if version.name != present]
    kept = [version for version in past if now - version.replaced < history.keep]
    kept = kept[-history.most :] if history.most else kept if history.most is None else []
    marks = {f"{_PAST}{version.name}~{version.replaced:{_STAMP}}" for version in kept}
    for name in set(names) - marks - {version.name for version in kept} - {present}:
        files.delete(f"{folder}/{name}")


def _past(names: list[str]) -> list[Version]:
    """Replaced versions that are still there, from the first replaced to the last."""
    there = set(names)
    marks = [name.removeprefix(_PAST).partition("~") for name in names if name.startswith(_PAST)]
    found = [Version(name, _moment(stamp)) for name, _, stamp in marks if name in there]
    return sorted(found, key=lambda version: version.replaced)


def _versions(spark: SparkSession, target: TableRef) -> list[Version]:
    entry = _entry(spark, target)
    past = _past(SharedFiles(spark).names(_folder(spark, target)))
    if entry is None or entry.version is None:
        return past
    # A writer may have died after marking the present version as past.
    return [version for version in past if version.name != entry.version] + [Version(entry.version, None)]


def table_versions(spark: SparkSession, target: TableRef) -> DataFrame:
    """``version, written, replaced, is_present`` of every version that can be read, as UTC times."""
    versions = _versions(spark, target)
    columns = {
        "version": pa.array([v.name for v in versions], pa.string()),
        "written": pa.array([v.written for v in versions], pa.timestamp("us", "UTC")),
        "replaced": pa.array([v.replaced for v in versions], pa.timestamp("us", "UTC")),
        "is_present": pa.array([v.replaced is None for v in versions], pa.bool_()),
    }
    return spark.createDataFrame(pa.table(columns))


def table_as_of(
    spark: SparkSession, target: TableRef, moment: dt.datetime, table_format: str = "parquet"
) -> DataFrame:
    """The rows a table had at a moment; a moment without a time zone is UTC.

    A version counts from the replacement of the one before it, the first one from when it was written.
    LookupError if the table is younger than the moment, or the version is no longer kept.
    """
    moment = moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)
    if table_format in TRANSACTIONAL_FORMATS:
        return spark.sql(f"SELECT * FROM {target.sql} TIMESTAMP AS OF {_text(moment.isoformat())}")
    versions = _versions(spark, target)
    after = [version for version in versions if version.replaced is None or version.replaced > moment]
    if not after or (after[0] is versions[0] and after[0].written > moment):
        raise LookupError(f"no version of {target} from {moment.isoformat()} is kept")
    found = after[0]
    if found.replaced is None:
        return spark.table(target.sql)
    if found.table_format not in SELF_DESCRIBING_FORMATS:
        raise LookupError(f"{found.table_format} files do not state their schema")
    return spark.read.format(found.table_format).load(literal_path(f"{_folder(spark, target)}/{found.name}"))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


def _moment(stamp: str) -> dt.datetime:
    return dt.datetime.strptime(stamp, _STAMP).replace(tzinfo=dt.UTC)


def restore_table(spark: SparkSession, target: TableRef) -> None:
    """Finish a replacement that died between dropping the old catalog entry and making the new one."""
    if spark.catalog.tableExists(target.sql):
        return
    try:
        folder = _folder(spark, target)
    except PySparkException:
        return  # no such schema, so nothing to restore
    files = SharedFiles(spark)
    for name in files.names(folder):
        if name.startswith(_NEXT):
            version = name.removeprefix(_NEXT)
            table_format = Version(version, None).table_format
            schema = spark.read.format(table_format).load(f"{folder}/{version}").schema
            _create(spark, target, f"{folder}/{version}", table_format, schema)
            files.delete(f"{folder}/{name}")
            return


def drop_table(spark: SparkSession, target: TableRef) -> None:
    """Drop a table together with its versions."""
    folder = _folder(spark, target)
    drop_entry(spark, target)
    SharedFiles(spark).delete(folder)


def drop_entry(spark: SparkSession, target: TableRef) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {target.sql}")


def _folder(spark: SparkSession, target: TableRef) -> str:
    namespace = ".".join(quote(part) for part in target.namespace)
    details = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE NAMESPACE {namespace}").collect()}
    return f"{details['Location'].rstrip('/')}/{target.name}{VERSIONS}"


class _Entry(NamedTuple):
    """A table's catalog entry; ``version`` is None if its rows are not in the folder of its versions."""

    version: str | None
    table_format: str
    shape: list[tuple[str, str]]


def _entry(spark: SparkSession, target: TableRef) -> _Entry | None:
    if not spark.catalog.tableExists(target.sql):
        return None
    rows = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target.sql}").collect()]
    details = dict(rows[[name for name, _ in rows].index("# Detailed Table Information") :])
    _, own, version = details.get("Location", "").rpartition(f"/{target.name}{VERSIONS}/")
    return _Entry(version if own else None, details.get("Provider", ""), _shape(spark.table(target.sql).schema))


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _create(spark: SparkSession, target: TableRef, path: str, table_format: str, schema: T.StructType) -> None:
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    columns = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(nullable.json()).toDDL()
    spark.sql(f"CREATE TABLE {target.sql} ({columns}) USING {table_format} LOCATION {_text(path)}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
