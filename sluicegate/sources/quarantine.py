"""Chunks of text files whose broken lines are set aside instead of failing the delivery."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import quote
from sluicegate.sources.landing import read_chunks

# Helper columns, which no delivered column may be called.
LINE, BROKEN, FILE, BLOCK, PLACE = "_line", "_broken", "_file", "_block", "_place"


class Split(NamedTuple):
    """``good`` has the schema's columns; ``broken`` has ``file, row, line``."""

    good: DataFrame
    broken: DataFrame


def split_lines(
    spark: SparkSession,
    paths: list[str],
    file_format: str,
    schema: T.StructType,
    folder: str,
    options: dict[str, str] | None = None,
) -> Split:
    """Read CSV or JSON chunks once, and part the lines that fit the schema from those that do not.

    All lines are written to ``folder``, a new one on shared storage, the broken ones apart; both frames
    read it. ``row`` counts a file's records from 1, a CSV header and blank lines not included, and ``line`` is
    the record as it was delivered. A line is broken if a value has not the type of its column, or if it has
    fewer or more values than columns. A header that disagrees with the schema fails, as without quarantine.
    """
    if file_format not in ("csv", "json"):
        raise ValueError(f"lines can be broken in csv and json, not in {file_format}")
    taken = {name.lower() for name in schema.names} & {LINE, BROKEN, FILE, BLOCK, PLACE}
    if taken:
        raise ValueError(f"columns may not be called {', '.join(sorted(taken))}")
    wanted = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    wide = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(LINE, T.StringType())])
    lines = read_chunks(spark, paths, file_format, wide, options={**(options or {}), **wanted})
    # Numbers rise within a block of a file, whose records one task reads in their order.
    located = lines.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(PLACE),
        F.col(LINE).isNotNull().alias(BROKEN),
    )
    located.write.partitionBy(BROKEN).parquet(folder)
    shape = T.StructType([f for f in located.schema.fields if f.name != BROKEN]).add(BROKEN, "boolean")
    written = spark.read.schema(shape).parquet(folder)
    good = written.where(f"NOT {BROKEN}").select(*map(quote, schema.names))
    blocks = written.groupBy(FILE, BLOCK).agg(F.min(PLACE).alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    broken = written.where(BROKEN).select(FILE, BLOCK, PLACE, LINE).join(blocks, [FILE, BLOCK])
    # The path is URL-encoded, except that a plus sign stands for itself.
    path = F.url_decode(F.replace(F.col(FILE), F.lit("+"), F.lit("%2B")))
    row = F.col("before") + F.col(PLACE) - F.col("first") + 1
    return Split(good, broken.select(path.alias("file"), row.alias("row"), F.col(LINE).alias("line")))
