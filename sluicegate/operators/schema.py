"""Compare a table's schema with the schema it should have."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import quote
from sluicegate.errors import SchemaMismatch
from sluicegate.sources.files import literal_path


def _differences(actual: T.StructType, expected: T.StructType) -> list[dict[str, str | None]]:
    have = {f.name.lower(): f for f in actual.fields}
    want = {f.name.lower(): f for f in expected.fields}
    rows = []
    for key in [*want, *(key for key in have if key not in want)]:
        expected_type = want[key].dataType.simpleString() if key in want else None
        actual_type = have[key].dataType.simpleString() if key in have else None
        if key not in have:
            status = "missing"
        elif key not in want:
            status = "extra"
        else:
            status = "ok" if actual_type == expected_type else "type"
        name = (want.get(key) or have[key]).name
        rows.append({"column": name, "expected_type": expected_type, "actual_type": actual_type, "status": status})
    return rows


def schema_report(df: DataFrame, expected: T.StructType, count_values: bool = False) -> DataFrame:
    """``column, expected_type, actual_type, status`` for every column of either schema.

    ``status`` is ok, missing, extra or type. Column names are compared without regard to case, as
    Spark resolves them. No data is read, unless ``count_values`` asks for ``n_values``, the number
    of non-null values: for chunks read with a merged schema it shows how much of the data really
    has a drifted column, at the price of one scan of every column, without a shuffle.
    """
    rows = _differences(df.schema, expected)
    fields = [(name, pa.string()) for name in ("column", "expected_type", "actual_type", "status")]
    report = df.sparkSession.createDataFrame(pa.Table.from_pylist(rows, pa.schema(fields)))
    if not count_values:
        return report
    counts = df.agg(*[F.count(F.col(quote(name))).alias(name) for name in df.columns])
    pairs = [
        F.struct(F.lit(name.lower()).alias("column_key"), F.col(quote(name)).alias("n_values"))
        for name in df.columns
    ]
    counts = counts.select(F.inline(F.array(*pairs)))
    return (
        report.join(counts, F.lower("column") == F.col("column_key"), "left")
        .drop("column_key")
        .withColumn("n_values", F.coalesce("n_values", F.lit(0)))
    )


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The DataFrame itself, or :class:`SchemaMismatch`; decided from the schemas, no data is read."""
    wrong = [row for row in _differences(df.schema, expected) if row["status"] != "ok"]
    if wrong:
        parts = [
            f"{row['column']}: {row['status']} (expected {row['expected_type']}, got {row['actual_type']})"
            for row in wrong
        ]
        raise SchemaMismatch("; ".join(parts))
    return df


def require_every_column(spark: SparkSession, paths: list[str], file_format: str, df: DataFrame) -> None:
    """:class:`SchemaMismatch` if a file of a columnar format lacks one of a frame's columns.

    Spark would fill the column with nulls. Footers are read from a few driver threads, as file
    listings are; no data is read. ``df`` must have been read with the columns of all files.
    """

    def lacking(path: str) -> str:
        columns = {name.lower() for name in _columns(spark, path, file_format)}
        absent = [name for name in df.columns if name.lower() not in columns]
        return f"{path.rpartition('/')[2]} has no {', '.join(absent)}" if absent else ""

    with ThreadPoolExecutor(16) as pool:
        wrong = [text for text in pool.map(lacking, paths) if text]
    if wrong:
        raise SchemaMismatch(f"{len(wrong)} of {len(paths)} chunks are incomplete: {wrong[0]}")


def _columns(spark: SparkSession, path: str, file_format: str) -> list[str]:
    if file_format != "parquet":
        return spark.read.format(file_format).load(literal_path(path)).columns
    jvm = spark._jvm
    hadoop, conf = jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        return [f.getName() for f in reader.getFileMetaData().getSchema().getFields()]
    finally:
        reader.close()
