"""Spans of days: join those that overlap, and find the span a day lies in.

Days are whole numbers inside, both ends of a span included. A span without a start or that ends before it
starts is none. A span without an end is open, which counts as the last day there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.config import quote

# Spans that start within so many days are put in order by one task.
BIN_DAYS = 512
# 0001-01-01 and 9999-12-31 as days since 1970.
FIRST_DAY, LAST_DAY = -719_162, 2_932_896
# Sizes of the periods that points and spans meet in, as powers of two: 64, 4,096 and 262,144 days.
STEP = 6
LEVELS = (STEP, 2 * STEP, 3 * STEP)


def _days(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """``key, s, e``: the spans as numbers. A struct, unlike its fields, is never null."""
    key = F.struct(*[F.col(quote(name)) for name in keys])
    first, last = (F.unix_date(F.col(quote(name)).cast("date")) for name in (start, end))
    spans = df.select(key.alias("key"), first.alias("s"), F.coalesce(last, F.lit(LAST_DAY)).alias("e"))
    return spans.where("s <= e")


def merge_spans(df: DataFrame, keys: list[str], start: str, end: str, gap_days: int = 0) -> DataFrame:
    """One row for each run of spans of a key: the keys, ``span_start``, ``span_end`` and ``n_spans``.

    Spans belong to one run if they overlap or at most ``gap_days`` days lie between them; 0 joins spans of which
    one starts the day after the other ends. The end of an open run is null.

    A key's spans are put in order bin by bin, so a key with a large part of all rows is work for as many
    tasks as it has bins. What the spans of earlier bins reach, and how many runs began there, comes from one
    small row for each key and bin.
    """
    spans = _days(df, keys, start, end).withColumn("bin", F.floor(F.col("s") / BIN_DAYS))
    in_bin = Window.partitionBy("key", "bin").orderBy("s", "e")
    earlier = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    reach = spans.groupBy("key", "bin").agg(F.max("e").alias("reach"))
    reach = reach.select("key", "bin", F.max("reach").over(earlier).alias("carried"))
    before = F.max("e").over(in_bin.rowsBetween(Window.unboundedPreceding, -1))
    placed = spans.withColumn("before", before).join(reach, ["key", "bin"])
    until = F.greatest("before", "carried")
    placed = placed.withColumn("begins", (until.isNull() | (F.col("s") > until + (1 + gap_days))).cast("long"))
    # Of equal spans the one that begins a run comes first, whatever order they had in the window before.
    again = Window.partitionBy("key", "bin").orderBy("s", "e", F.desc("begins"))
    number = F.sum("begins").over(again.rowsBetween(Window.unboundedPreceding, 0))
    runs = placed.withColumn("number", number).groupBy("key", "bin", "number").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("n"), F.max("begins").alias("begins")
    )
    # Few rows are left: runs within bins, of which the first may belong to a run of an earlier bin.
    order = Window.partitionBy("key").orderBy("bin", "number").rowsBetween(Window.unboundedPreceding, 0)
    joined = runs.withColumn("run", F.sum("begins").over(order)).groupBy("key", "run").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n")
    )
    return joined.select(
        *[F.col("key")[name].alias(name) for name in keys],
        F.date_from_unix_date("s").alias("span_start"),
        F.when(F.col("e") < LAST_DAY, F.date_from_unix_date("e")).alias("span_end"),
        F.col("n").alias("n_spans"),
    )


def spans_at(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    day: str,
    start: str = "span_start",
    end: str = "span_end",
) -> DataFrame:
    """The rows of ``points`` whose day lies in a span of the same keys, with ``start`` and ``end`` of that span.

    A point comes once for every span that holds its day; points without a span, a day or all keys do not
    come. Days are cut into periods of 64, these into periods of 64 times the size, and so on. A span is cut into
    the large periods that it fills and, at its ends, the small ones that it touches, 126 of a size at most; a
    day lies in one period of each size. So points meet spans by equality, a key with many rows is spread over its
    periods, and within 64 days the days decide. Only sizes that some span has are used: a point is sent once, unless spans
    fill whole periods of 4,096 days.
    """
    given = {name.lower() for name in points.columns}
    clash = [name for name in (start, end) if name.lower() in given]
    if clash:
        raise ValueError(f"points have columns named {', '.join(clash)}")
    # Names no column of the points has.
    mark = "_" * (1 + max(map(len, points.columns)))
    found = _days(spans, keys, start, end)
    periods = F.explode(_periods(F.col("s") - FIRST_DAY, F.col("e") - FIRST_DAY)).alias("period")
    cut = found.select("key", "s", "e", periods)
    levels = sorted(row.level for row in cut.select("period.level").distinct().collect())
    cut = cut.select(
        *[F.col("key")[name].alias(f"{mark}key{i}") for i, name in enumerate(keys)],
        *[F.col(name).alias(f"{mark}{name}") for name in "se"],
        _number(F.col("period.level"), F.col("period.place")).alias(f"{mark}period"),
    )
    at = F.unix_date(F.col(quote(day)).cast("date"))
    own = [_number(F.lit(level), F.call_function("shiftright", at - FIRST_DAY, F.lit(level))) for level in levels]
    for name in (*keys, day):
        points = points.where(F.col(quote(name)).isNotNull())
    columns = [F.col(quote(name)) for name in points.columns]
    sent = points.select(
        *columns,
        *[F.col(quote(name)).alias(f"{mark}own{i}") for i, name in enumerate(keys)],
        at.alias(f"{mark}at"),
        F.explode(F.array(*own).cast("array<int>")).alias(f"{mark}in"),
    )
    meets = F.expr(f"{mark}at BETWEEN {mark}s AND {mark}e AND {mark}in = {mark}period")
    for i in range(len(keys)):
        meets &= F.col(f"{mark}own{i}") == F.col(f"{mark}key{i}")
    return sent.join(cut, meets).select(
        *columns,
        F.date_from_unix_date(f"{mark}s").alias(start),
        F.when(F.col(f"{mark}e") < LAST_DAY, F.date_from_unix_date(f"{mark}e")).alias(end),
    )


def _number(level: Column, place: Column) -> Column:
    """A period as one number."""
    return place * 32 + level


def _periods(first: Column, last: Column) -> Column:
    """The periods that stand for a range of numbers, as ``level`` and ``place``.

    Of the smallest size those that the range touches, of the others those that it fills; without those that a
    larger one holds.
    """

    def bounds(level: int) -> tuple[Column, Column]:
        size = F.lit(level)
        if level == STEP:
            return F.call_function("shiftright", first, size), F.call_function("shiftright", last, size)
        filled = F.call_function("shiftright", first + ((1 << level) - 1), size)
        return filled, F.call_function("shiftright", last + 1, size) - 1

    def places(level: int, left: Column, right: Column) -> Column:
        held = F.transform(F.sequence(left, right), lambda place: F.struct(F.lit(level).alias("level"), place.alias("place")))
        return F.when(left <= right, held).otherwise(F.array().cast("array<struct<level: int, place: int>>"))

    found = []
    for level in LEVELS:
        left, right = bounds(level)
        if level == LEVELS[-1]:
            found.append(places(level, left, right))
            continue
        above, below = bounds(level + STEP)
        larger = above <= below
        found.append(places(level, left, F.when(larger, above * (1 << STEP) - 1).otherwise(right)))
        found.append(places(level, F.when(larger, (below + 1) * (1 << STEP)).otherwise(right + 1), right))
    return F.concat(*found)
