"""References between tables: keys that a child has and its parent has not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import quote

# Words of 64 bits in the filter of referenced keys; as a broadcast table some 32 MiB, whatever the data.
FILTER_WORDS = 1 << 20


def _named(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(quote(name)).alias(f"k{i}") for i, name in enumerate(columns)])


def _same_hashes(child: DataFrame, parent: DataFrame, names: list[str]) -> bool:
    """Whether equal keys have equal hashes: one exact type on both sides, or whole numbers."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    exact = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BooleanType, T.BinaryType)
    pairs = [(child.schema[name].dataType, parent.schema[name].dataType) for name in names]
    return all((isinstance(a, whole) and isinstance(b, whole)) or (a == b and isinstance(a, exact)) for a, b in pairs)


def orphans(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """``keys`` (columns of the child to those of its parent): the child's keys without a parent, with ``n_rows``.

    A key with a null in it refers to nothing, as in SQL. Types must be comparable.

    The child's rows are counted by key within map tasks, and the parent's keys are made distinct there, so a
    hot key costs a row for each task on both sides. Parents that no child refers to are kept out of the shuffle by a
    filter of one bit for each hashed key of the child. The filter has a fixed size. What it lets through by
    chance, or because the child has more keys than it has bits, only costs time: the anti join behind it
    compares the keys.
    """
    names = [f"k{i}" for i in range(len(keys))]
    own = _named(child, list(keys)).dropna()
    others = _named(parent, list(keys.values())).dropna()
    if _same_hashes(own, others, names):
        whole = {f.name for f in own.schema if isinstance(f.dataType, T.IntegralType)}
        hashed = [F.col(name).cast("long") if name in whole else F.col(name) for name in names]
        place = F.pmod(F.xxhash64(*hashed), F.lit(FILTER_WORDS * 64))
        referenced = own.select(place.alias("place")).groupBy(F.expr("shiftright(place, 6)").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits")
        )
        placed = others.withColumn("place", place).withColumn("word", F.expr("shiftright(place, 6)"))
        referenced = F.broadcast(referenced.withColumnRenamed("word", "filter_word"))
        known = (F.col("word") == F.col("filter_word")) & (F.expr("bit_get(bits, cast(place & 63 AS int))") == 1)
        others = placed.join(referenced, known, "left_semi")
    counted = own.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = counted.join(others.select(*names).distinct(), names, "left_anti")
    return missing.select(*[F.col(n).alias(name) for n, name in zip(names, keys, strict=True)], "n_rows")


def orphan_rows(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The child's rows whose key has no parent, whole."""
    return child.join(orphans(child, parent, keys).drop("n_rows"), list(keys), "left_semi").select(child.columns)


def reference_report(references: dict[str, tuple[DataFrame, DataFrame, dict[str, str]]]) -> DataFrame:
    """``expectation, n_passed, n_failed`` for named references (child, parent, keys), as of row expectations.

    A row whose key has a null passes.
    """
    rows = []
    for name, (child, parent, keys) in references.items():
        total = child.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("n_failed"))
        failed = orphans(child, parent, keys).agg(F.lit(0).cast("long").alias("n"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_failed"))
        rows.append(total.unionByName(failed).select(F.lit(name).alias("expectation"), "n", "n_failed"))
    sums = reduce(DataFrame.unionAll, rows).groupBy("expectation").agg(F.sum("n").alias("n"), F.sum("n_failed").alias("n_failed"))
    return sums.select("expectation", (F.col("n") - F.col("n_failed")).alias("n_passed"), "n_failed")
