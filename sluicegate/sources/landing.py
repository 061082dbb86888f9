"""Landing directories as DataFrames: files, manifest, expectations and chunk data."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.errors import MetaUnreadable, StepFailed
from sluicegate.functions import naming
from sluicegate.operators.checks import EXPECTATION_KEYS
from sluicegate.sources.files import SharedFiles, literal_path, run_each

META_SCHEMA = "test_name string, value string"

# Large files make one scan partition each; a listing merges them into at most this many tasks.
LISTING_TASKS = 256
# Tasks that look up given paths.
READING_TASKS = 16


def read_chunks(
    spark: SparkSession,
    paths: list[str],
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Union all chunks of a table by column name.

    Without ``merge_schema`` one file's columns win and extra columns of other chunks are dropped
    (:func:`dropped_columns` names them); with it, the result has every column found in any chunk of
    a columnar format.
    CSV chunks carry a header that must agree with the schema; give CSV and JSON a schema, or
    Spark reads every file once more to infer one. Their broken lines are an error, unless
    ``options`` set another ``mode``.
    """
    # Whatever the session says, a file that is damaged or gone is an error, not fewer rows.
    # Up to this number Spark looks the paths up by itself, without a job.
    few = len(paths) <= int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold"))
    listing = spark if few else _listing_session(spark)
    reader = listing.read.format(file_format).option("ignoreCorruptFiles", False)
    reader = reader.option("ignoreMissingFiles", False)
    if file_format in ("csv", "json"):
        reader = reader.option("mode", "FAILFAST")
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if file_format in ("parquet", "orc"):
        reader = reader.option("mergeSchema", merge_schema)
    reader = reader.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    loaded = reader.load([literal_path(path) for path in paths])
    if few:
        return loaded
    plan = loaded._jdf.queryExecution().analyzed()
    dataset = spark._jvm.org.apache.spark.sql.classic.Dataset
    return DataFrame(dataset.ofRows(spark._jsparkSession, plan), spark)


def _listing_session(spark: SparkSession) -> SparkSession:
    """A copy of a session that lists many given paths in a few tasks, instead of one task for each.

    Listing is settled when the reader loads; the frames are handed back to the given session.
    """
    copy = spark._jsparkSession.cloneSession()
    copy.conf().set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(READING_TASKS))
    return SparkSession(spark.sparkContext, copy)


def dropped_columns(
    spark: SparkSession, paths: list[str], file_format: str, df: DataFrame, options: dict[str, str] | None = None
) -> list[str]:
    """Columns that some chunks of a columnar format have and a frame read from them has not.

    All footers are read, in tasks.
    """
    if len(paths) < 2 or file_format not in ("parquet", "orc"):
        return []
    merged = read_chunks(spark, paths, file_format, merge_schema=True, options=options)
    have = {name.lower() for name in df.columns}
    return [name for name in merged.columns if name.lower() not in have]


class Landing:
    """One landing directory.

    Only files directly in the directory count. Names starting with ``_`` or ``.`` are hidden
    from Spark and therefore never discovered.
    """

    def __init__(self, spark: SparkSession, path: str, shared: SharedFiles | None = None):
        self.spark = spark
        self.shared = shared or SharedFiles(spark)
        self.root = self.shared.qualify(path)

    def listing(self, name_glob: str | None = None) -> DataFrame:
        """``path, name, length, modified`` of every file; contents are never read.

        The recursive listing with a test on the parent keeps a ``key=value`` directory beside
        the files from being taken for a partitioned table, which would hide the files.
        """
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        reader = reader.option("ignoreMissingFiles", True)  # a file taken away is not there
        if name_glob:
            reader = reader.option("pathGlobFilter", name_glob)
        path = F.col("path")
        return (
            reader.load(literal_path(self.root))
            .where(naming.parent_dir(path) == self.root)
            .select(
                "path",
                naming.file_name(path).alias("name"),
                "length",
                F.col("modificationTime").alias("modified"),
            )
            .coalesce(LISTING_TASKS)
        )

    def files(self) -> DataFrame:
        """The listing with ``kind, table_name, chunk_start, chunk_end`` read from each name."""
        name, kind = F.col("name"), F.col("kind")
        return (
            self.listing()
            .withColumn("kind", naming.name_kind(name))
            .withColumns(
                {
                    "table_name": naming.table_of(name, kind),
                    "chunk_start": naming.chunk_start(name, kind),
                    "chunk_end": naming.chunk_end(name, kind),
                }
            )
        )

    def data_files(self) -> DataFrame:
        return self.files().where(F.col("kind").isin("chunk", "plain"))

    def manifest(self, data_files: DataFrame | None = None) -> DataFrame:
        """One row per table: number and size of its files, first and last chunk day.

        The paths stay in :meth:`files`, so a table with very many chunks is still one small row.
        ``data_files``, a frame of :meth:`data_files`, saves listing the directory again.
        """
        data = self.data_files() if data_files is None else data_files
        return (
            data.groupBy("table_name")
            .agg(
                F.count(F.lit(1)).alias("n_files"),
                F.sum("length").alias("n_bytes"),
                F.min("chunk_start").alias("first_start"),
                F.max("chunk_end").alias("last_end"),
            )
        )

    def requested(self, tables: list[str]) -> DataFrame:
        """Requested names with their manifest row; ``found`` is false where there is none."""
        wanted = self.spark.createDataFrame(pa.table({"table_name": pa.array(tables, pa.string())}))
        manifest = self.manifest().where(F.col("table_name").isin(*tables))
        return wanted.join(manifest, "table_name", "left").select(
            "*", F.col("n_files").isNotNull().alias("found")
        )

    def deliveries(self) -> DataFrame:
        """Deliveries in an archive: ``table_name, stamp, day, number, n_files, n_meta``.

        One listing of names. A delivery's meta is archived last, so one without it is incomplete.
        """
        name = F.col("name")
        part = [F.regexp_extract(name, naming.ARCHIVED_NAME, group) for group in range(5)]
        original = F.concat(part[1], part[4])
        stamped = self.listing(f"*{naming.PROCESSED_MARK}*").where(part[2] != "")
        # A meta that is a directory shows by the files in it.
        return (
            stamped.select(
                naming.table_of(original).alias("table_name"),
                part[2].alias("stamp"),
                F.substring(part[2], len(naming.PROCESSED_MARK) + 1, 8).alias("day"),
                F.coalesce(part[3].try_cast("int"), F.lit(1)).alias("number"),
                (part[4] != "").alias("is_meta"),
            )
            .groupBy("table_name", "stamp", "day", "number")
            .agg(F.count_if(~F.col("is_meta")).alias("n_files"), F.count_if("is_meta").alias("n_meta"))
        )

    def work_list(
        self,
        tables: list[str],
        archive_path: str,
        day: dt.date,
        data_files: DataFrame | None = None,
        numbers: dict[str, int] | None = None,
    ) -> DataFrame:
        """Every file of the requested tables with its place in the archive.

        Columns ``table_name, kind, src, dest``. The meta path is derived from the table name
        because a meta "file" may be a directory, which a listing of files does not show.
        ``numbers`` gives the number of a table's delivery on that day, 1 if it is the first.
        """
        data = self.data_files() if data_files is None else data_files
        data = data.where(F.col("table_name").isin(*tables))
        data = data.select("table_name", "kind", F.col("path").alias("src"))
        number = [(numbers or {}).get(table, 1) for table in tables]
        columns = {"table_name": pa.array(tables, pa.string()), "number": pa.array(number, pa.int32())}
        names = self.spark.createDataFrame(pa.table(columns))
        meta_path = F.concat(F.lit(self.root + "/"), "table_name", F.lit(naming.META_SUFFIX))
        meta = names.select("table_name", F.lit("meta").alias("kind"), meta_path.alias("src"))
        files = data.union(meta).join(names, "table_name")
        return archive_plan(files, self.shared.qualify(archive_path), day, F.col("number")).drop("number")

    def frames(
        self,
        tables: list[str],
        since: dt.date | None = None,
        until: dt.date | None = None,
        **read_options,
    ) -> dict[str, DataFrame]:
        """Union of each table's chunks, after one listing; see :func:`read_chunks`.

        ``since`` and ``until`` skip chunks whose names put them outside that range of days. Plain
        files have no days in their names and are always read.
        """
        paths = self.paths(tables, since, until)
        return {table: read_chunks(self.spark, paths[table], **read_options) for table in tables}

    def paths(
        self, tables: list[str], since: dt.date | None = None, until: dt.date | None = None
    ) -> dict[str, list[str]]:
        """The files of each table, after one listing; a table without any is an error."""
        files = self.data_files().where(F.col("table_name").isin(*tables))
        if since:
            files = files.where(F.coalesce(F.col("chunk_end") >= f"{since:%Y%m%d}", F.lit(True)))
        if until:
            files = files.where(F.coalesce(F.col("chunk_start") <= f"{until:%Y%m%d}", F.lit(True)))
        paths = {table: [] for table in tables}
        for row in files.select("table_name", "path").collect():
            paths[row.table_name].append(row.path)
        absent = [table for table in tables if not paths[table]]
        if absent:
            raise StepFailed(f"no files of {', '.join(absent)} in {self.root}")
        return {table: sorted(found) for table, found in paths.items()}

    def chunks(self, table: str, **read_options) -> DataFrame:
        """Union of one table's chunks."""
        return self.frames([table], **read_options)[table]

    def meta_path(self, table: str) -> str:
        return f"{self.root}/{table}{naming.META_SUFFIX}"

    def meta(self, tables: list[str]) -> DataFrame:
        """Delivered expectations of several tables: ``table_name, test_name, value, position``.

        One scan reads all files. ``position`` is the row's place in its file.
        """
        reader = self.spark.read.schema(META_SCHEMA)
        rows = reader.parquet(*[literal_path(self.meta_path(table)) for table in tables])
        # The metadata path is URL-encoded, except that a plus sign stands for itself.
        source = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        return rows.select(
            F.regexp_extract(source, r"([^/]+)\.meta(?:/[^/]*)?$", 1).alias("table_name"),
            "test_name",
            "value",
            F.col("_metadata.row_index").alias("position"),
            source.alias("file"),
        )

    def meta_of(self, table: str) -> DataFrame:
        """Expectations of one table, whatever types its file uses for names and values."""
        try:
            rows = self.spark.read.parquet(literal_path(self.meta_path(table)))
            if not {"test_name", "value"} <= set(rows.columns):
                raise ValueError(f"its columns are {', '.join(rows.columns)}, not test_name and value")
            kind = rows.schema["value"].dataType
            value = F.col("value").cast("bigint") if isinstance(kind, T.NumericType) else F.col("value")
            return rows.select(
                F.lit(table).alias("table_name"),
                F.col("test_name").cast("string").alias("test_name"),
                value.cast("string").alias("value"),
                F.col("_metadata.row_index").alias("position"),
                F.col("_metadata.file_path").alias("file"),
            )
        except Exception as error:
            raise self._unreadable(table, str(error)) from error

    def _unreadable(self, table: str, why: str) -> MetaUnreadable:
        return MetaUnreadable(f"no readable expectations in {self.meta_path(table)}: {why.splitlines()[0]}")

    def expectations(self, tables: list[str]) -> dict[str, dict[str, str | None] | Exception]:
        """Expectations by table, or the error that made a table's file unreadable.

        Tables without a file are found from one listing. The files that are there are read in one
        job; only if that fails are they read one by one, so that one bad file fails one table. What
        the joint job cannot tell, a file of other columns from one without rows or values, is looked
        up in that table's file. At most one value per known key and table reaches the driver.
        """
        names = set(self.shared.names(self.root))
        found: dict[str, dict | Exception] = {
            table: {} if table + naming.META_SUFFIX in names else self._unreadable(table, "there is no such file")
            for table in tables
        }
        there = [table for table, known in found.items() if known == {}]
        try:
            summary = {row.table_name: row for row in _known_values(self.meta(there)).collect()} if there else {}
        except Exception:  # noqa: BLE001 - a damaged file can surface as almost any error
            summary = {}
        doubtful = [table for table in there if not _plain(summary.get(table))]
        outcomes = run_each(self.spark, self._values_or_error, doubtful, parallelism=8)
        for table in there:
            found[table] = _values(summary.get(table))
        return found | dict(zip(doubtful, outcomes, strict=True))

    def _values_or_error(self, table: str) -> dict[str, str | None] | Exception:
        try:
            row = _known_values(self.meta_of(table)).first()
        except Exception as error:  # noqa: BLE001
            return error if isinstance(error, MetaUnreadable) else self._unreadable(table, str(error))
        if row and row.n_unnamed:
            return self._unreadable(table, f"{row.n_unnamed} rows have no test_name")
        return _values(row)


def _known_values(meta: DataFrame) -> DataFrame:
    """One row per table: the last value of every known key, and how many rows have no key.

    Unknown keys are ignored. Rows count in the order of their files' names and of their places there.
    """
    key = F.when(F.col("test_name").isin(*EXPECTATION_KEYS), F.col("test_name"))
    last = F.max_by(F.struct("value"), F.struct("file", "position")).alias("last")
    by_key = meta.groupBy("table_name", key.alias("key")).agg(
        last, F.count_if(F.col("test_name").isNull()).alias("n_unnamed")
    )
    pairs = F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", F.col("last.value").alias("value"))))
    return by_key.groupBy("table_name").agg(pairs.alias("pairs"), F.sum("n_unnamed").alias("n_unnamed"))


def _values(row: Row | None) -> dict[str, str | None]:
    return {pair.key: pair.value for pair in row.pairs} if row else {}


def _plain(row: Row | None) -> bool:
    """Whether a table's rows are what a file with both columns gives: names, and no missing value."""
    return bool(row) and not row.n_unnamed and all(pair.value is not None for pair in row.pairs)


def archive_plan(files: DataFrame, archive_root: str, day: dt.date, number: Column | None = None) -> DataFrame:
    """Add ``dest`` to a frame with a ``src`` path."""
    name = naming.archive_name(naming.file_name(F.col("src")), F.lit(day), number)
    return files.withColumn("dest", F.concat(F.lit(archive_root + "/"), name))
