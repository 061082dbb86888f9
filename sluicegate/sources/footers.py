"""Counts and ranges of parquet files from their footers, without reading a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluicegate.sources.files import literal_path

# Types whose least and greatest value a parquet footer states as they are: texts may be cut short there,
# and the order of old timestamps is not defined.
RANGE_TYPES = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
)


def states_range(dtype: T.DataType) -> bool:
    """Whether footers give the least and greatest value of a column of this type."""
    return isinstance(dtype, RANGE_TYPES)


def footer_frame(spark: SparkSession, paths: list[str], merge_schema: bool = False) -> DataFrame:
    """Parquet files as a frame whose plain counts, minima and maxima come from their footers.

    Only aggregates over the whole frame are answered so: ``count(*)``, ``count(column)``, and ``min``
    and ``max`` of columns for which :func:`states_range` holds, all without a filter. Any other query reads
    data as usual. A file that lacks the figures makes such a query fail, it never makes it wrong. The given
    session keeps its settings: the reader that does this is chosen in a copy of it.
    """
    copy = spark._jsparkSession.cloneSession()
    others = [name for name in copy.conf().get("spark.sql.sources.useV1SourceList").split(",") if name != "parquet"]
    copy.conf().set("spark.sql.sources.useV1SourceList", ",".join(others))
    copy.conf().set("spark.sql.parquet.aggregatePushdown", "true")
    # Figures of a file that cannot be read are an error, whatever the session says.
    reader = SparkSession(spark.sparkContext, copy).read.option("ignoreCorruptFiles", False)
    loaded = reader.option("mergeSchema", merge_schema).parquet(*[literal_path(path) for path in paths])
    dataset = spark._jvm.org.apache.spark.sql.classic.Dataset
    return DataFrame(dataset.ofRows(spark._jsparkSession, loaded._jdf.queryExecution().analyzed()), spark)
