"""Measure a table and compare it with delivered expectations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import quote
from sluicegate.functions.parsing import as_moment, iso_midnight, moment_text, whole_number
from sluicegate.sources.footers import states_range


@dataclass(frozen=True)
class Check:
    """A check is made when ``key`` is delivered and, for dates, ``column_key`` is too."""

    key: str
    name: str
    column_key: str | None
    message: str  # of expected, actual, column


# Delivered keys, check names in report order, and report texts.
CHECKS = (
    Check("n_rows", "validate_row_count", None, "Expected %1$s rows, got %2$s"),
    Check("n_mbrs", "validate_n_members", None, "Expected %1$s columns, got %2$s"),
    Check(
        "n_unique_id",
        "validate_unique_id_count",
        "id_col",
        "Expected %1$s unique values in '%3$s', got %2$s",
    ),
    Check("max_date", "validate_max_date", "date_col", "expected %1$s max date in '%3$s', got %2$s"),
    Check("min_date", "validate_min_date", "date_col", "expected %1$s min date in '%3$s', got %2$s"),
)
DATE_CHECKS = ("max_date", "min_date")
EXPECTATION_KEYS = ("n_rows", "n_mbrs", "n_unique_id", "id_col", "max_date", "min_date", "date_col")
REPORT_HEADER = "Validation failed for table '%s': %s of %s checks failed"
REPORT_PASS = "[PASS]"
REPORT_FAIL = "[FAIL]"

EXPECTED_SCHEMA = pa.schema(
    [
        ("table_name", pa.string()),
        ("key", pa.string()),
        ("position", pa.int32()),
        ("check_name", pa.string()),
        ("is_date", pa.bool_()),
        ("column_key", pa.string()),
        ("column", pa.string()),
        ("value", pa.string()),
        ("template", pa.string()),
    ]
)


def _resolve(df: DataFrame, column: str | None) -> tuple[Column, T.DataType] | None:
    """Column and type for a name taken from a meta file, or None if the table has no such column."""
    if not column:
        return None
    for f in df.schema.fields:
        if f.name.lower() == column.lower():
            return F.col(quote(column)), f.dataType
    if "." not in column:
        return None
    try:
        return F.col(column), df.select(column).schema[0].dataType  # a field of a struct column
    except AnalysisException:
        return None


def distinct_count(df: DataFrame, column: Column) -> DataFrame:
    """Exact number of distinct values as ``n_distinct``; NULL counts as one value.

    Each map task sends a value at most once, so a hot key costs one row per task, and the
    shuffle carries nothing but the column itself.
    """
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def distinct_whole_numbers(df: DataFrame, column: Column) -> DataFrame:
    """:func:`distinct_count` of whole numbers, without shuffling them.

    A value is a bit of the bitmap of its 64 neighbours, which fits into one number. Map tasks join the bits, so
    at most one row for 64 neighbouring values leaves a task, and one for a single value where there are gaps. Bitmaps of
    32,768 values, 4 KB each, would have to be sorted together in the map tasks, and cost 4 KB for a single value.
    """
    ids = df.select(column.cast("bigint").alias("id"))
    words = ids.selectExpr("shiftright(id, 6) AS word", "shiftleft(1L, cast(id & 63 AS int)) AS bit")
    bits = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    counts = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)) + F.count_if(F.col("word").isNull())
    return bits.agg(counts.alias("n_distinct"))


def measure(
    df: DataFrame,
    id_col: str | None = None,
    date_col: str | None = None,
    table: str | None = None,
    one_scan: bool = False,
    footers: DataFrame | None = None,
    bitmaps: bool = True,
) -> DataFrame:
    """Measure a table in one job: ``[table_name,] key, actual_count, actual_moment, actual_text``.

    Row count and date range need no shuffle, distinct ids need one. Keeping them in separate
    branches lets each scan read only its own column and keeps the date range out of the rows that
    are shuffled by id; a date kept as text would otherwise force a sort of the whole table.
    ``one_scan`` joins the branches instead, for formats such as CSV where reading a column means
    parsing the whole file.
    ``footers``, the same table as a :func:`footer_frame`, answers the row count without reading data, and the
    date range too where footers state it. Without ``bitmaps`` whole numbers are shuffled as ids of other
    types are, instead of being counted as bits.
    Minimum and maximum are taken on the column as it is, and converted afterwards.
    """
    label = F.lit(table).cast("string").alias("table_name")
    dated, identified = _resolve(df, date_col), _resolve(df, id_col)
    n_rows = F.count(F.lit(1))
    latest, earliest = (F.max(dated[0]), F.min(dated[0])) if dated else (None, None)
    source = df
    if identified and one_scan:
        per_id = [n_rows.alias("n_rows")]
        if dated:
            per_id += [latest.alias("latest"), earliest.alias("earliest")]
        source = df.groupBy(identified[0].alias("id")).agg(*per_id)
        n_rows, latest, earliest = F.coalesce(F.sum("n_rows"), F.lit(0)), F.max("latest"), F.min("earliest")
    totals = [n_rows.alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_mbrs")]
    rows = [_row(key, count=key) for key in ("n_rows", "n_mbrs")]
    ranges, range_rows = [], []
    if dated:
        for key, value in zip(DATE_CHECKS, (latest, earliest), strict=True):
            ranges += [as_moment(value, dated[1]).alias(key), value.cast("string").alias(f"{key}_text")]
            range_rows.append(_row(key, moment=key, text=f"{key}_text"))
    id_row = _row("n_unique_id", count="n_distinct")
    if identified and one_scan:
        totals.append(F.count(F.lit(1)).alias("n_distinct"))
        rows.append(id_row)
    elif footers is not None:
        source = footers
    # A range that footers do not state is read from the data, in a branch of its own.
    apart = bool(dated) and source is footers and not states_range(dated[1])
    branches = [(source, totals, rows), (df, ranges, range_rows)] if apart else [(source, totals + ranges, rows + range_rows)]
    if identified and not one_scan:
        whole = bitmaps and isinstance(identified[1], T.IntegralType)
        count_ids = distinct_whole_numbers if whole else distinct_count
        branches.append((count_ids(df, identified[0]), None, [id_row]))
    measured = reduce(
        DataFrame.union,
        [
            (frame.select("*", label) if figures is None else frame.agg(label, *figures)).selectExpr(f"inline(array({', '.join(shown)}))")
            for frame, figures, shown in branches
        ],
    )
    return measured.drop("table_name") if table is None else measured


def _row(key: str, count: str = "NULL", moment: str = "NULL", text: str | None = None) -> str:
    """One measurement as SQL; the arguments name columns."""
    return (
        f"struct(table_name, '{key}' AS key, bigint({count}) AS actual_count, "
        f"CAST({moment} AS timestamp_ntz) AS actual_moment, coalesce(string({text or count}), 'None') AS actual_text)"
    )


def expected_frame(spark: SparkSession, expectations: dict[str, dict[str, str | None]]) -> DataFrame:
    """Triggered checks of several tables with what they expect, five rows per table at most."""
    rows = [
        {
            "table_name": table,
            "key": check.key,
            "position": position,
            "check_name": check.name,
            "is_date": check.key in DATE_CHECKS,
            "column_key": check.column_key,
            "column": known.get(check.column_key),
            "value": known[check.key],
            "template": check.message,
        }
        for table, known in expectations.items()
        for position, check in enumerate(CHECKS, start=1)
        if check.key in known and (check.key not in DATE_CHECKS or check.column_key in known)
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, EXPECTED_SCHEMA))


def compare(measured: DataFrame, expected: DataFrame) -> DataFrame:
    """Check report: ``table_name, position, check_name, expected, actual, passed, message``.

    Typed values are compared, text is only shown. An expectation that cannot be read, or one
    about a column the table does not have, is a failed check.
    ``expected`` has at most five rows per table and comes from the driver, so Spark knows its
    size and may broadcast it.
    """
    keys = [column for column in ("table_name", "key") if column in measured.columns]
    is_date, value = F.col("is_date"), F.col("value")
    typed = expected.withColumns(
        {
            "wanted_count": F.when(~is_date, whole_number(value)),
            "wanted_moment": F.when(is_date, iso_midnight(value)),
        }
    )
    shown = typed.join(measured, keys, "left").withColumns(
        {
            "readable": F.coalesce(moment_text(F.col("wanted_moment")), F.expr("string(wanted_count)")),
            "actual": F.coalesce(moment_text(F.col("actual_moment")), "actual_text"),
            "no_column": F.format_string("%s is not given", "column_key"),
            "unknown_column": F.format_string("column '%s' does not exist", "column"),
            "unreadable": F.format_string("cannot read the expected value '%s'", "value"),
        }
    )
    return shown.selectExpr(
        "table_name",
        "position",
        "check_name",
        "coalesce(readable, value) AS expected",
        "actual",
        "coalesce(actual_moment = wanted_moment, actual_count = wanted_count, false) AS passed",
        """CASE WHEN column_key IS NOT NULL AND column IS NULL THEN no_column
                WHEN actual IS NULL THEN unknown_column
                WHEN readable IS NULL THEN unreadable
                ELSE printf(template, readable, actual, column) END AS message""",
    )


def check_tables(
    frames: dict[str, DataFrame],
    expectations: dict[str, dict[str, str | None]],
    one_scan: bool = False,
    footers: dict[str, DataFrame] | None = None,
    bitmaps: bool = True,
) -> DataFrame:
    """Report of every triggered check on every table, as one job.

    Columns that no check asks for are not measured. For ``footers`` and ``bitmaps`` see :func:`measure`.
    """
    measured = []
    for table, df in frames.items():
        known = expectations[table]
        id_col = known.get("id_col") if "n_unique_id" in known else None
        date_col = known.get("date_col") if any(key in known for key in DATE_CHECKS) else None
        measured.append(measure(df, id_col, date_col, table, one_scan, (footers or {}).get(table), bitmaps))
    spark = next(iter(frames.values())).sparkSession
    return compare(reduce(DataFrame.union, measured), expected_frame(spark, expectations))


def check_table(
    df: DataFrame,
    table: str,
    known: dict[str, str | None],
    one_scan: bool = False,
    footers: DataFrame | None = None,
    bitmaps: bool = True,
) -> DataFrame:
    """Report of every triggered check on one table."""
    return check_tables({table: df}, {table: known}, one_scan, None if footers is None else {table: footers}, bitmaps)


def report_line() -> Column:
    mark = F.when(F.col("passed"), REPORT_PASS).otherwise(REPORT_FAIL)
    return F.format_string("  %s %s: %s", mark, F.col("check_name"), F.col("message"))


def verdicts(report: DataFrame, *keys: Column | str) -> DataFrame:
    """Tally of a report: ``n_checks, n_passed, n_failed, passed, results, lines``.

    With ``keys`` there is one row per group; without, exactly one, also for an empty report, which
    passes. ``results`` holds at most five rows per table, in check order.
    """
    result = F.struct("position", "check_name", "expected", "actual", "passed", "message")
    line = F.struct("position", report_line().alias("line"))
    return report.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if("passed").alias("n_passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
        F.array_sort(F.collect_list(result)).alias("results"),
        F.array_join(F.array_sort(F.collect_list(line))["line"], "\n").alias("lines"),
    )


def report_text(table: Column) -> Column:
    """Text of a failed verdict: a header, then one line per check."""
    header = F.format_string(REPORT_HEADER, table, F.col("n_failed"), F.col("n_checks"))
    return F.concat_ws("\n", header, "lines")
