"""Summaries that are kept up to date: what every chunk adds is kept, and merged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.config import History, TableRef, quote
from sluicegate.functions import naming
from sluicegate.sinks.tables import replace_table, table_versions

# Columns of the table of parts that no key or metric may be called.
CHUNK, LENGTH, MODIFIED, LISTED = "_chunk", "_length", "_modified", "_listed"
_VERSION = [CHUNK, LENGTH, MODIFIED]

Read = Callable[[list[str]], DataFrame]


@dataclass(frozen=True)
class Metric:
    """A figure that can be merged from parts.

    ``kind`` is count (of values that are not null; of rows for the column ``1``), sum, min, max, distinct (an
    estimate by HyperLogLog sketches, about 2 % off) or quantile (``at``, by KLL sketches, about 1 % of rank off).
    ``column`` is SQL. Sums of decimals and whole numbers do not depend on how rows are dealt to chunks.
    """

    kind: str
    column: str = "1"
    at: float = 0.5

    def __post_init__(self) -> None:
        if self.kind not in _STEPS:
            raise ValueError(f"kind must be one of {', '.join(_STEPS)}, not {self.kind!r}")

    def part(self) -> Column:
        return _STEPS[self.kind][0](F.expr(self.column))

    def merged(self, part: Column) -> Column:
        return _STEPS[self.kind][1](part)

    def shown(self, merged: Column) -> Column:
        return _STEPS[self.kind][2](merged, self.at)


def _as_it_is(merged: Column, at: float) -> Column:
    return merged


# How each kind is taken from rows, merged from parts, and shown.
_STEPS: dict[str, tuple[Callable, Callable, Callable]] = {
    "count": (F.count, F.sum, _as_it_is),
    "sum": (F.sum, F.sum, _as_it_is),
    "min": (F.min, F.min, _as_it_is),
    "max": (F.max, F.max, _as_it_is),
    "distinct": (F.hll_sketch_agg, F.hll_union_agg, lambda merged, at: F.hll_sketch_estimate(merged)),
    "quantile": (
        lambda column: F.call_function("kll_sketch_agg_double", column.cast("double")),
        lambda part: F.call_function("kll_merge_agg_double", part),
        lambda merged, at: F.call_function("kll_sketch_get_quantile_double", merged, F.lit(at)),
    ),
}


class Rollup:
    """A gold table with one row for each key, and beside it the table ``<name>_parts`` with one for each chunk and key.

    An update reads the chunks that are new or have another length or time, and no others; parts of chunks that are
    gone are dropped. The gold table is merged from the parts, which are few against the rows. Both are replaced as
    a whole and in this order; an update that died between the two is finished by the next one.
    """

    def __init__(
        self,
        spark: SparkSession,
        target: TableRef,
        keys: list[str],
        metrics: dict[str, Metric],
        history: History = History(),
    ):
        taken = {name.lower() for name in (*keys, *metrics)} & {CHUNK, LENGTH, MODIFIED, LISTED}
        if taken or len({name.lower() for name in (*keys, *metrics)}) < len(keys) + len(metrics):
            raise ValueError("keys and metrics need names of their own")
        self.spark, self.target, self.keys, self.metrics, self.history = spark, target, keys, metrics, history
        self.parts = target.sibling(f"{target.name}_parts")

    def update(self, files: DataFrame, read: Read) -> dict[str, int]:
        """Bring the gold table up to date with a listing (``path, name, length, modified``) of all chunks.

        ``read`` gives the rows of some files. The result tells ``n_chunks`` there are, ``n_read`` that were
        read and ``n_dropped`` that are gone.
        """
        listed = files.select("path", F.col("name").alias(CHUNK), F.col("length").alias(LENGTH), F.col("modified").alias(MODIFIED))
        there = self.spark.catalog.tableExists(self.parts.sql)
        known = self.spark.table(self.parts.sql).where(LISTED).select(*_VERSION, CHUNK) if there else None
        if known is None:
            fresh = {row.path: row for row in listed.collect()}
            n_chunks, n_dropped = len(fresh), 0
        else:
            known = known.select(*_VERSION)
            fresh = {row.path: row for row in listed.join(known, _VERSION, "left_anti").collect()}
            gone = known.join(listed, CHUNK, "left_anti").agg(F.count(F.lit(1)).alias("n"))
            n_chunks, n_dropped = (row.n for row in listed.agg(F.count(F.lit(1)).alias("n")).unionAll(gone).collect())
        if not there or fresh or n_dropped:
            self._replace_parts(list(fresh.values()), read, listed if there else None)
        if not there or fresh or n_dropped or self._behind():
            self._merge()
        return {"n_chunks": n_chunks, "n_read": len(fresh), "n_dropped": n_dropped}

    def partials(self, rows: DataFrame) -> DataFrame:
        """What each file of a frame adds to each key."""
        # The path is URL-encoded, except that a plus sign stands for itself.
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        named = rows.select("*", naming.file_name(path).alias(CHUNK))
        figures = [metric.part().alias(name) for name, metric in self.metrics.items()]
        return named.groupBy(CHUNK, *[F.col(quote(key)) for key in self.keys]).agg(*figures)

    def _replace_parts(self, fresh: list, read: Read, listed: DataFrame | None) -> None:
        """Parts of chunks that are there as they were, and those of fresh ones; a row without a key lists a chunk."""
        old = None
        if listed is not None:
            old = self.spark.table(self.parts.sql).join(listed.select(*_VERSION), _VERSION, "left_semi")
        if not fresh:
            replace_table(old, self.parts, history=self.history)
            return
        versions = self.spark.createDataFrame(
            [(row[CHUNK], row[LENGTH], row[MODIFIED]) for row in fresh], f"{CHUNK} string, {LENGTH} long, {MODIFIED} timestamp"
        )
        found = self.partials(read(sorted(row.path for row in fresh))).join(versions, CHUNK).withColumn(LISTED, F.lit(False))
        chunks = versions.withColumn(LISTED, F.lit(True))
        new = found.unionByName(chunks, allowMissingColumns=True)
        # Few rows for each chunk: as many files as there are tasks would be many small ones.
        new = new.select(*_VERSION, LISTED, *[F.col(quote(name)) for name in (*self.keys, *self.metrics)])
        parts = new if old is None else old.select(new.columns).unionByName(new)
        replace_table(parts.hint("rebalance"), self.parts, history=self.history)

    def _merge(self) -> None:
        parts = self.spark.table(self.parts.sql).where(~F.col(LISTED))
        merged = parts.groupBy(*[F.col(quote(key)) for key in self.keys]).agg(
            *[metric.merged(F.col(quote(name))).alias(name) for name, metric in self.metrics.items()]
        )
        shown = [metric.shown(F.col(quote(name))).alias(name) for name, metric in self.metrics.items()]
        gold = merged.select(*[F.col(quote(key)) for key in self.keys], *shown)
        replace_table(gold, self.target, history=self.history)

    def _behind(self) -> bool:
        """Whether the parts were replaced after the gold table was."""
        if not self.spark.catalog.tableExists(self.target.sql):
            return True
        written = [
            table_versions(self.spark, table).where("is_present").first().written for table in (self.parts, self.target)
        ]
        return written[0] > written[1]
