"""Tables with a key, of which a delivery replaces some rows.

The rows of a keyed table are divided twice: into shards, which are partitions, by an expression over the
key, and within every shard into buckets by the hash of the key. A delivery rewrites only the shards that
it has keys of. It is shuffled to the buckets; what is stored there is not, as its files are bucketed
already.

Every state of the table is a catalog entry of its own, whose partitions lie where they were last written,
and the table itself is a view of one entry. Replacing the view is the only step that readers see, and
whoever has opened an entry keeps it as long as :class:`History` says.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.config import History, TableRef, quote
from sluicegate.sinks import tables
from sluicegate.sources.files import SharedFiles

# The column of shards, the property that keeps a table's layout, the folder of its map.
SHARD = "_shard"
PROPERTY = "sluicegate.keyed"
MAP = "_shards"
# A state is named by when it was written and some random digits; catalogs may not keep the case of names.
_STATE = re.compile("[0-9]{20}_[0-9a-f]{8}")
_STAMP = "%Y%m%d%H%M%S%f"
# A delivery's shards are named by the driver, and so is the place of each shard.
MOST_SHARDS = 10_000


@dataclass(frozen=True)
class Keyed:
    """How a keyed table is divided.

    Attributes:
        keys: columns whose values name a row; none of them may be null.
        buckets: buckets of each shard, and tasks of an upsert.
        shard: SQL over the keys that gives a whole number. Ranges of the key, such as ``id div 1000000``,
            keep neighbouring keys together; without it, 64 shards are told by a hash.
    """

    keys: tuple[str, ...]
    buckets: int = 64
    shard: str = ""

    @property
    def shard_sql(self) -> str:
        return f"cast({self.shard or 'pmod(xxhash64(' + ', '.join(map(quote, self.keys)) + '), 64)'} AS bigint)"


def create_keyed(df: DataFrame, target: TableRef, layout: Keyed, history: History = History()) -> None:
    """Write a whole keyed table in place of the one that is there; one row for each key is the caller's duty."""
    keys = [F.col(quote(key)) for key in layout.keys]
    _publish(df.repartition(layout.buckets, *keys), target, layout, _shards_of(df, layout), {}, history)


def upsert(df: DataFrame, target: TableRef, history: History = History()) -> dict[str, int]:
    """Replace the rows of the delivered keys, and add those of new keys.

    The delivery has the table's columns, in any order, and one row for each key (see ``deduplicate``).
    Gives ``n_shards``, the number of shards, and ``n_rewritten``, how many of them were written.
    """
    spark = df.sparkSession
    state = _present(spark, target)
    layout, places = _layout(spark, target, state), _places(spark, target, state)
    columns = [quote(name) for name in spark.table(target.sql).columns]
    delivered = df.select(*columns)
    touched = _shards_of(delivered, layout)
    if touched:
        known = [shard for shard in touched if shard in places]
        old = spark.table(_entry(target, state).sql).where(F.col(SHARD).isin(known)).select(*columns)
        merged = merge(old, delivered, layout)
        untouched = {shard: place for shard, place in places.items() if shard not in touched}
        _publish(merged, target, layout, touched, untouched, history)
    return {"n_shards": len({*places, *touched}), "n_rewritten": len(touched)}


def merge(stored: DataFrame, delivered: DataFrame, layout: Keyed) -> DataFrame:
    """The delivered rows, and the stored ones of other keys.

    Both sides meet in the buckets of what is stored: only the delivery is shuffled.
    """
    keys = [F.col(quote(key)) for key in layout.keys]
    replaced = delivered.select(*keys).hint("merge")
    kept = stored.join(replaced, list(layout.keys), "left_anti").select(stored.columns)
    return kept.unionByName(delivered.repartition(layout.buckets, *keys))


def keyed_as_of(spark: SparkSession, target: TableRef, moment: dt.datetime) -> DataFrame:
    """The rows a keyed table had at a moment (without a time zone: UTC); LookupError if that state is not kept."""
    moment = moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)
    present = _present(spark, target)
    states = [state for state in _states(spark, target) if state <= present and _written(state) <= moment]
    if not states:
        raise LookupError(f"no state of {target} from {moment.isoformat()} is kept")
    return spark.table(_entry(target, states[-1]).sql).drop(SHARD)


def drop_keyed(spark: SparkSession, target: TableRef) -> None:
    """Drop a keyed table with all its states and files."""
    folder = tables._folder(spark, target)
    spark.sql(f"DROP VIEW IF EXISTS {target.sql}")
    for state in _states(spark, target):
        tables.drop_entry(spark, _entry(target, state))
    SharedFiles(spark).delete(folder)


def _shards_of(df: DataFrame, layout: Keyed) -> list[int]:
    """The shards of a frame's rows, from its key columns alone."""
    absent = " OR ".join(f"{quote(key)} IS NULL" for key in layout.keys)
    found = df.selectExpr(f"{layout.shard_sql} AS shard", f"({absent}) AS absent").distinct()
    rows = found.limit(MOST_SHARDS + 1).collect()
    if any(row.absent or row.shard is None for row in rows):
        raise ValueError(f"{', '.join(layout.keys)} must not be null, nor {layout.shard_sql}")
    if len(rows) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards; take a coarser expression than {layout.shard_sql}")
    return sorted(row.shard for row in rows)


def _publish(
    df: DataFrame, target: TableRef, layout: Keyed, written: list[int], untouched: dict[int, str], history: History
) -> None:
    """Write some shards, put them together with the others to a new state, and let the view show that."""
    spark, now = df.sparkSession, dt.datetime.now(dt.UTC)
    state = f"{now:{_STAMP}}_{uuid.uuid4().hex[:8]}"
    entry, folder = _entry(target, state), tables._folder(spark, target)
    sharded = df.withColumn(SHARD, F.expr(layout.shard_sql))
    writer = sharded.write.format("parquet").partitionBy(SHARD).bucketBy(layout.buckets, *layout.keys)
    writer.sortBy(*layout.keys).option("path", f"{folder}/{state}").saveAsTable(entry.sql)
    files = SharedFiles(spark)
    root = files.qualify(f"{folder}/{state}")
    places = untouched | {shard: f"{root}/{SHARD}={shard}" for shard in written}
    listed = pa.table({"shard": pa.array(places, pa.int64()), "place": pa.array(places.values(), pa.string())})
    spark.createDataFrame(listed).coalesce(1).write.parquet(f"{folder}/{state}/{MAP}")
    text = json.dumps({"keys": layout.keys, "buckets": layout.buckets, "shard": layout.shard})
    spark.sql(f"ALTER TABLE {entry.sql} SET TBLPROPERTIES ({tables._text(PROPERTY)} = {tables._text(text)})")
    if untouched:
        parts = " ".join(f"PARTITION ({SHARD} = {s}) LOCATION {tables._text(p)}" for s, p in untouched.items())
        spark.sql(f"ALTER TABLE {entry.sql} ADD IF NOT EXISTS {parts}")
    shown = ", ".join(map(quote, df.columns))
    spark.sql(f"CREATE OR REPLACE VIEW {target.sql} AS SELECT {shown} FROM {entry.sql}")
    _prune(spark, target, state, now, history)


def _prune(spark: SparkSession, target: TableRef, present: str, now: dt.datetime, history: History) -> None:
    """Drop states that are too old or too many, and the files that no state has."""
    states = _states(spark, target)
    before = [state for state in states if state < present]
    # A state was replaced when the next one was written.
    kept = [
        state for state, later in zip(before, [*before[1:], present], strict=False) if now - _written(later) < history.keep
    ]
    if history.most is not None:
        kept = kept[max(0, len(kept) - history.most) :]
    kept = {*kept, present}
    for state in states:
        if state not in kept:
            tables.drop_entry(spark, _entry(target, state))
    used = {place for state in kept for place in _places(spark, target, state).values()}
    files, folder = SharedFiles(spark), tables._folder(spark, target)
    root = files.qualify(folder)
    for state in files.names(folder):
        if state not in kept:
            parts = files.names(f"{folder}/{state}")
            unused = [part for part in parts if f"{root}/{state}/{part}" not in used]
            for path in [f"{state}/{part}" for part in unused] if len(unused) < len(parts) else [state]:
                files.delete(f"{folder}/{path}")


def _entry(target: TableRef, state: str) -> TableRef:
    return target.sibling(f"{target.name}__{state}")


def _states(spark: SparkSession, target: TableRef) -> list[str]:
    """The states of a table that the catalog has, from the first to the last."""
    namespace = ".".join(map(quote, target.namespace))
    rows = spark.sql(f"SHOW TABLES IN {namespace} LIKE {tables._text(target.name + '__*')}").collect()
    names = [row.tableName[len(target.name) + 2 :] for row in rows]
    return sorted(name for name in names if _STATE.fullmatch(name))


def _written(state: str) -> dt.datetime:
    return dt.datetime.strptime(state.partition("_")[0], _STAMP).replace(tzinfo=dt.UTC)


def _present(spark: SparkSession, target: TableRef) -> str:
    """The state that the view shows."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target.sql}").collect()
    except AnalysisException as error:
        raise LookupError(f"there is no table {target}") from error
    text = next((row.data_type for row in rows if row.col_name == "View Text"), "")
    found = [state for state in _states(spark, target) if text.endswith(f"__{state}`")]
    if not found:
        raise LookupError(f"{target} is not a keyed table")
    return found[0]


def _layout(spark: SparkSession, target: TableRef, state: str) -> Keyed:
    rows = spark.sql(f"SHOW TBLPROPERTIES {_entry(target, state).sql}").collect()
    found = json.loads(next(row.value for row in rows if row.key == PROPERTY))
    return Keyed(tuple(found["keys"]), found["buckets"], found["shard"])


def _places(spark: SparkSession, target: TableRef, state: str) -> dict[int, str]:
    """Where each shard of a state lies."""
    rows = spark.read.parquet(f"{tables._folder(spark, target)}/{state}/{MAP}").collect()
    return {row.shard: row.place for row in rows}
