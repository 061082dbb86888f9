"""Quality steps between layers: duplicates, types, expectations, summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.config import quote
from sluicegate.sinks.runlog import RunLog


def deduplicate(
    df: DataFrame,
    keys: list[str],
    order_by: list[Column | str] | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    """Keep the first row of every key in the given order.

    All other sortable columns break ties, so the result does not depend on the order of the
    input; only exact copies are left to chance. Every map task keeps one row per key before the
    shuffle (Spark's window group limit), so a key that holds a large part of the table does not
    pile up in one task. Rows are sorted whole. ``counts`` gets ``n_rows`` and ``n_kept`` when the
    result is first written or counted.
    """
    given = {key.lower() for key in keys}
    ties = [
        F.col(quote(f.name)) for f in df.schema.fields if f.name.lower() not in given and _sortable(f.dataType)
    ]
    order = [*(order_by or []), *ties] or [F.lit(1)]
    place = F.row_number().over(Window.partitionBy(*_columns(keys)).orderBy(*order))
    # A name no column of the input has.
    helper = "_" * (1 + max(map(len, df.columns))) + "place"
    if counts:
        df = counts.observe(df, n_rows=F.count(F.lit(1)))
    kept = df.withColumn(helper, place).where(F.col(helper) == 1).drop(helper)
    return counts.observe(kept, n_kept=F.count(F.lit(1))) if counts else kept


def _columns(names: list[str]) -> list[Column]:
    return [F.col(quote(name)) for name in names]


class Counts:
    """Numbers that are counted while a frame is written, without a pass of their own.

    ``get()`` waits for the first action on the frame.
    """

    def __init__(self) -> None:
        self._observations: list[Observation] = []

    def observe(self, df: DataFrame, **numbers: Column) -> DataFrame:
        self._observations.append(Observation())
        return df.observe(self._observations[-1], *[column.alias(name) for name, column in numbers.items()])

    def get(self) -> dict[str, int]:
        return {name: value for one in self._observations for name, value in one.get.items()}

    def log(self, log: RunLog, step: str, what: str) -> None:
        """One row per number that is not zero: a warning for violations, else a success."""
        for name, value in self.get().items():
            violation = name.startswith(VIOLATIONS)
            if value or not violation:
                text = f"{value} rows violate {name.removeprefix(VIOLATIONS)}" if violation else f"{name} is {value}"
                log.event(step, "warning" if violation else "success", f"{what}: {text}")


# How numbers of rows that violate an expectation are named in counts.
VIOLATIONS = "violations of "


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def duplicate_tally(df: DataFrame, keys: list[str]) -> DataFrame:
    """``n_rows, n_kept, n_removed`` of :func:`deduplicate`, from the key columns alone."""
    per_key = df.groupBy(*_columns(keys)).agg(F.count(F.lit(1)).alias("n"))
    n_rows, n_kept = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return per_key.agg(
        n_rows.alias("n_rows"), n_kept.alias("n_kept"), (n_rows - n_kept).alias("n_removed")
    )


@dataclass(frozen=True)
class Conform:
    """Target type of a column and what is done to its text first."""

    type: str
    trim: bool = True
    case: str | None = None  # "upper" or "lower"

    def apply(self, column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StringType):
            column = F.trim(column) if self.trim else column
            column = {"upper": F.upper, "lower": F.lower}.get(self.case, lambda c: c)(column)
        return column.try_cast(self.type)


def conform(df: DataFrame, rules: dict[str, Conform]) -> DataFrame:
    """Clean and convert columns; a value that cannot be converted becomes null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({name: rule.apply(F.col(quote(name)), types[name]) for name, rule in rules.items()})


def conform_failures(df: DataFrame, rules: dict[str, Conform]) -> DataFrame:
    """``column, n_failed``: values :func:`conform` would turn into null. One scan, no shuffle."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def lost(name: str, rule: Conform) -> Column:
        column = F.col(quote(name))
        return column.isNotNull() & rule.apply(column, types[name]).isNull()

    counts = df.agg(*[F.count_if(lost(name, rule)).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(n).alias("column"), F.col(quote(n)).alias("n_failed")) for n in rules]
    return counts.select(F.inline(F.array(*pairs)))


class ExpectationFailure(Exception):
    """Rows violate an expectation that must hold."""


def _holds(expression: str) -> Column:
    """An expectation that evaluates to null is violated."""
    return F.coalesce(F.expr(expression), F.lit(False))


def expectation_report(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """``expectation, n_passed, n_failed`` for named boolean SQL expressions. One scan, no shuffle."""
    named = list(expectations.items())
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_holds(expression)).alias(f"e{i}") for i, (_, expression) in enumerate(named)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col(f"e{i}").alias("n_passed"),
            (F.col("n") - F.col(f"e{i}")).alias("n_failed"),
        )
        for i, (name, _) in enumerate(named)
    ]
    return counts.select(F.inline(F.array(*rows)))


def expect_all(
    df: DataFrame, expectations: dict[str, str], on_violation: str = "warn", counts: Counts | None = None
) -> DataFrame:
    """Apply expectations: ``warn`` keeps every row, ``drop`` keeps rows that meet all of them.

    ``counts`` gets the number of rows that violate each, when the result is first written or
    counted; with ``drop`` that keeps the filters from reaching the scan. ``fail`` reads the data
    once, raises if any row violates an expectation, and keeps every row. An expectation that Spark
    cannot resolve raises at once.
    """
    if on_violation not in ("warn", "drop", "fail"):
        raise ValueError(f"on_violation must be warn, drop or fail, not {on_violation!r}")
    df.select(*[_holds(expression) for expression in expectations.values()]).schema  # noqa: B018 - resolves them
    if counts and expectations:
        df = counts.observe(
            df, **{VIOLATIONS + name: F.count_if(~_holds(expression)) for name, expression in expectations.items()}
        )
    if on_violation == "drop":
        for expression in expectations.values():
            df = df.where(expression)  # drops nulls too, and can reach the scan as it is
    if on_violation == "fail" and expectations:
        failed = expectation_report(df, expectations).where("n_failed > 0").collect()
        if failed:
            raise ExpectationFailure("; ".join(f"{row.expectation}: {row.n_failed} rows" for row in failed))
    return df


def summarize(df: DataFrame, keys: list[str], metrics: dict[str, Column | str]) -> DataFrame:
    """One row per key with named aggregates, given as columns or SQL.

    Spark aggregates within map tasks first, so a hot key costs one row per task.
    """
    columns = [
        (F.expr(metric) if isinstance(metric, str) else metric).alias(name)
        for name, metric in metrics.items()
    ]
    return df.groupBy(*_columns(keys)).agg(*columns)
