"""Near duplicates by a blocked sparse matrix product of classes by n-grams.

Documents with the same set of n-grams form a class; a class is a row of the incidence matrix, an
n-gram a column. The product of the matrix with its transpose holds the overlaps of all pairs.

* Only a row's prefix takes part: with sizes ``a`` and a similarity of at least ``t``, two sets that
  link share a column among their first ``a - ceil(t a) + 1``, in any order of columns that is the
  same for all rows. Columns come in the order of their hashes, those of many rows last.
* Columns are dealt to blocks by hash. A block drops columns with one row. Heavy columns skip the
  blocks, so that no block depends on how often a column occurs.
* Overlap counts are accumulated over the columns; a pair whose count, plus all that its rows hold
  beyond their prefixes, is below the overlap its sizes ask for, is discarded. The overlap of the
  remaining pairs is taken from their whole sets.
* A column of many rows would give the square of their number in pairs. So its rows are multiplied
  with one pivot row first. Rows that link, directly or by others, need no product among themselves.
  Only then all pairs of rows that are not yet connected are multiplied, which makes the
  components exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, Scratch, map_batches
from sluicegate.llm.components import components
from sluicegate.llm.words import gram_sets, mix

# At most so many columns count as heavy; their 8-byte codes are sent to all tasks.
MOST_HEAVY = 1 << 21
# No column of fewer rows is heavy.
LEAST_HEAVY = 4
# Rows with at most so many open columns carry the list of them.
LISTED_COLUMNS = 256
# Rounds in which a column's rows are multiplied with a pivot only.
PIVOT_ROUNDS = 2
# N-grams that a task holds at once; a longer text is held alone.
GROUP_GRAMS = 1 << 20
# Bits of the filter of documents whose texts are read again, 8 MiB in all.
FILTER_BITS = 26


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _codes(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Block and lower half of a hash: what columns are counted by."""
    low = hashes & np.uint64(0xFFFFFFFF)
    return _block(hashes, blocks).astype(np.uint64) << np.uint64(32) | low


_WEIGHTS = np.array([3, 5, 7], np.uint64)


def class_key(grams: np.ndarray) -> int:
    """One 64-bit number for a set."""
    state = np.array([grams.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(grams)), len(grams)], np.uint64)
    return int(mix((mix(state) * _WEIGHTS).sum(keepdims=True)).view(np.int64)[0])


def _by_block(codes: np.ndarray, extra: np.ndarray | None, blocks: int):
    """Sorted codes by block: block, lower halves, and what belongs to them."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    ends = np.searchsorted(codes, np.arange(1, blocks + 1, dtype=np.uint64) << np.uint64(32))
    start = 0
    for block, end in enumerate(ends):
        if end > start:
            low = (codes[start:end] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield block, low.tobytes(), extra[order[start:end]].tobytes() if extra is not None else b""
        start = end


def _measured(blocks: int, size: int):
    """A row for each document, and a row for each block with columns of the documents before it."""

    def run(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId()
        for batch in batches:
            kind = batch.schema.field("id").type
            for start, part, sets in _set_groups(batch, size):
                number += 1
                keys = [class_key(grams) if len(grams) else None for grams in sets]
                columns = list(_by_block(_codes(np.concatenate(sets), blocks), None, blocks))
                n, m = len(sets), len(columns)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([blocks + number % blocks] * n + [c[0] for c in columns], pa.int32()),
                        pa.concat_arrays([part.column("id"), pa.nulls(m, kind)]),
                        pa.array([*map(len, sets), *[None] * m], pa.int64()),
                        pa.array(keys + [None] * m, pa.int64()),
                        pa.array([None] * n + [c[1] for c in columns], pa.binary()),
                    ],
                    names=["block", "doc_id", "n_shingles", "class", "columns"],
                )

    return run


def _set_groups(batch: pa.RecordBatch, size: int):
    """Sets of neighbouring rows, about a million n-grams at a time."""
    start, sets, held = 0, [], 0
    for i, grams in enumerate(gram_sets(batch.column("text"), size)):
        sets.append(grams)
        held += len(grams)
        if held >= GROUP_GRAMS or i + 1 == len(batch):
            yield start, batch.slice(start, i + 1 - start), sets
            start, sets, held = i + 1, [], 0


def _frequent(blocks: int, least: int):
    """Documents as they are; of a block's columns those with more than ``least`` rows."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        if key[0].as_py() >= blocks:
            none = pa.nulls(len(part), pa.int64())
            part = part.select(["doc_id", "n_shingles", "class"])
            return part.append_column("code", none).append_column("rows", none)
        low = np.concatenate([np.frombuffer(b, np.uint32) for b in part.column("columns").to_pylist()])
        low.sort()
        starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        counts = np.diff(np.r_[starts, len(low)])
        often = counts > least
        code = low[starts[often]].astype(np.int64) | key[0].as_py() << 32
        none = pa.nulls(len(code), pa.int64())
        return pa.table(
            {
                "doc_id": pa.nulls(len(code), part.schema.field("doc_id").type),
                "n_shingles": none,
                "class": none,
                "code": pa.array(code, pa.int64()),
                "rows": pa.array(counts[often], pa.int64()),
            }
        )

    return run


def _prefix(grams: np.ndarray, codes: np.ndarray, percent: int, heavy: np.ndarray):
    """The columns of a row that take part, and which of them are heavy."""
    late = np.zeros(len(grams), bool)
    if len(heavy):
        late = heavy[np.minimum(np.searchsorted(heavy, codes), len(heavy) - 1)] == codes
    first = np.argsort(late, kind="stable")[: len(grams) - (len(grams) * percent + 99) // 100 + 1]
    return grams[first], codes[first], late[first]


def _prefixes(blocks: int, size: int, percent: int, shared):
    """Prefix columns with their class: by block, and heavy ones under block numbers beyond those."""

    def run(batches: Batches) -> Batches:
        heavy = np.frombuffer(shared.value, np.uint64)
        number = TaskContext.get().partitionId()
        for batch in batches:
            for _, _, sets in _set_groups(batch, size):
                number += 1
                rows = {class_key(grams): grams for grams in sets if len(grams)}
                light, owners, full, full_owners = [], [], [], []
                for key, grams in rows.items():
                    grams, codes, late = _prefix(grams, _codes(grams, blocks), percent, heavy)
                    light.append(codes[~late])
                    owners.append(np.full(len(light[-1]), key, np.int64))
                    if late.any():
                        full.append(grams[late])
                        full_owners.append(np.full(len(full[-1]), key, np.int64))
                if not rows:
                    continue
                parts = list(_by_block(np.concatenate(light), np.concatenate(owners), blocks))
                if full:
                    both = np.concatenate(full).tobytes(), np.concatenate(full_owners).tobytes()
                    parts.append((blocks + number % blocks, *both))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in parts], pa.int32())]
                    + [pa.array([p[i] for p in parts], pa.binary()) for i in (1, 2)],
                    names=["block", "columns", "classes"],
                )

    return run


def _shared(blocks: int):
    """The entries of a block whose column has two classes or more; heavy entries as they are."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        block = key[0].as_py()
        kind = np.uint32 if block < blocks else np.int64
        column = np.concatenate([np.frombuffer(b, kind) for b in part.column("columns").to_pylist()])
        owner = np.concatenate([np.frombuffer(b, np.int64) for b in part.column("classes").to_pylist()])
        if block < blocks:
            order = np.lexsort((owner, column))
            column, owner = column[order], owner[order]
            new = np.r_[True, (column[1:] != column[:-1]) | (owner[1:] != owner[:-1])]
            column, owner = column[new], owner[new]
            same = column[1:] == column[:-1]
            keep = np.r_[same, False] | np.r_[False, same]
            column, owner = column[keep].astype(np.int64) | block << 32, owner[keep]
        return pa.table({"gram": pa.array(column, pa.int64()), "class": pa.array(owner, pa.int64())})

    return run


def _sets_of(size: int, shared):
    """Sets, each class once per task, of the documents that a filter lets through."""

    def run(batches: Batches) -> Batches:
        bits = np.frombuffer(shared.value, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            places = batch.column("place").to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero(bits[places >> 3] >> (places & 7).astype(np.uint8) & 1)
            for _, _, sets in _set_groups(batch.take(pa.array(chosen)), size):
                rows = {class_key(grams): grams for grams in sets}
                rows = {key: grams.view(np.int64) for key, grams in rows.items() if key not in seen}
                seen.update(rows)
                if rows:
                    ends = pa.array(np.cumsum([0, *map(len, rows.values())]), pa.int32())
                    lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(list(rows.values()))))
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), lists], names=["class", "grams"])

    return run


class _Join:
    """One run of the join."""

    def __init__(self, df: DataFrame, size: int, percent: int, id_col: str, text_col: str):
        self.spark = df.sparkSession
        self.size, self.percent = size, percent
        self.texts = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
        self.id_type = df.schema[id_col].dataType
        self.scratch = Scratch(self.spark)
        self.blocks = 2 * int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.docs = self.classes = self.entries = None

    def measure(self) -> np.ndarray:
        """Documents with size and class; the codes of heavy columns, sorted."""
        id_field = T.StructField("doc_id", self.id_type)
        sizes = [T.StructField(name, T.LongType()) for name in ("n_shingles", "class")]
        mapped = [T.StructField("block", T.IntegerType()), id_field, *sizes, T.StructField("columns", T.BinaryType())]
        reduced = [id_field, *sizes, T.StructField("code", T.LongType()), T.StructField("rows", T.LongType())]
        # One pass over the texts gives both: documents pass through, columns are counted.
        both = map_batches(self.texts, _measured(self.blocks, self.size), T.StructType(mapped))
        counted = both.groupBy("block").applyInArrow(_frequent(self.blocks, LEAST_HEAVY), T.StructType(reduced))
        measured = self.scratch.table(counted, "measured")
        self.docs = measured.where("code IS NULL").select("doc_id", "n_shingles", "class")
        # Columns by their number of rows, from the most: as many as may be sent count as heavy.
        often = measured.where("code IS NOT NULL")
        steps = often.groupBy("rows").count().orderBy(F.desc("rows")).toArrow().to_pylist()
        least, sent = None, 0
        for step in steps:
            sent += step["count"]
            if sent > MOST_HEAVY:
                break
            least = step["rows"]
        heavy = often.where(F.col("rows") >= least if steps and least else F.lit(False)).select("code").toArrow()
        return np.sort(heavy.column(0).to_numpy().astype(np.uint64))

    def fill(self, heavy: np.ndarray) -> None:
        """Classes, and the entries of columns that two classes share."""
        self.classes = self.scratch.table(
            self.docs.where("class IS NOT NULL AND doc_id IS NOT NULL")
            .groupBy("class")
            .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")),
            "classes",
        )
        shared = self.spark.sparkContext.broadcast(heavy.tobytes())
        blobs = map_batches(
            self.texts.where("id IS NOT NULL"),
            _prefixes(self.blocks, self.size, self.percent, shared),
            "block int, columns binary, classes binary",
        )
        entries = blobs.groupBy("block").applyInArrow(_shared(self.blocks), "gram long, class long")
        entries = self.scratch.table(entries.distinct(), "shared")
        # Of near copies, those with the fewest changes share the most columns.
        degrees = entries.groupBy("class").agg(F.count("*").alias("degree"))
        sizes = self.classes.select("class", "n")
        self.entries = self.scratch.table(entries.join(degrees, "class").join(sizes, "class"), "entries")
        self.scratch.drop("shared")

    def products(self, pairs: DataFrame, name: str) -> DataFrame | None:
        """Pairs (``a``, ``b``, ``shared`` prefix columns, to be added up) that link, by their whole sets.

        None if no pair can.
        """
        p = self.percent
        sizes = self.classes.select("class", "n")
        counted = (
            pairs.groupBy("a", "b")
            .agg(F.sum("shared").alias("shared"))
            .join(sizes.select(F.col("class").alias("a"), F.col("n").alias("na")), "a")
            .join(sizes.select(F.col("class").alias("b"), F.col("n").alias("nb")), "b")
        )
        needed = F.ceil((F.col("na") + F.col("nb")) * p / (100 + p))
        beyond = F.greatest(F.ceil(F.col("na") * p / 100), F.ceil(F.col("nb") * p / 100)) - 1
        possible = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * p) & (F.col("shared") + beyond >= needed)
        kept = self.scratch.table(counted.where(possible), f"{name}_pairs")
        if kept.isEmpty():
            return None
        sets = self.sets(kept.select("a").union(kept.select("b")).distinct(), f"{name}_sets")
        left = sets.select(F.col("class").alias("a"), F.col("grams").alias("ga"))
        right = sets.select(F.col("class").alias("b"), F.col("grams").alias("gb"))
        overlap = F.size(F.array_intersect("ga", "gb"))
        links = (
            kept.join(left, "a")
            .join(right, "b")
            .withColumn("overlap", overlap)
            .where(F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * p)
            .select("a", "b", "overlap")
            .distinct()
        )
        links = self.scratch.table(links, f"{name}_links")
        self.scratch.drop(f"{name}_pairs", f"{name}_sets", f"{name}_sets_first")
        return links

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """Whole sets of classes, from the text of each class's first document.

        A bit filter of fixed size picks the documents while texts are read, so that texts are not
        shuffled; documents that it lets through by chance fall out in the join.
        """
        first = self.scratch.table(wanted.toDF("class").join(self.classes, "class"), f"{name}_first")
        place = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
        words = (
            first.select(F.col("doc_id").alias("id"))
            .select(place.alias("place"))
            .groupBy(F.expr("shiftright(place, 6)").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
            .toArrow()
        )
        bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        shared = self.spark.sparkContext.broadcast(bits.tobytes())
        texts = self.texts.where("id IS NOT NULL").withColumn("place", place)
        found = map_batches(texts, _sets_of(self.size, shared), "class long, grams array<long>")
        return self.scratch.table(found.join(first.select("class"), "class", "left_semi"), name)

    def pivots(self, known: DataFrame | None, salt: int) -> DataFrame:
        """Every entry with the pivot of its column; only columns that still join two components."""
        entries = self.grouped(known)
        # Every round turns to other classes among those that share many columns.
        chance = F.pmod(F.xxhash64("class", F.lit(salt)), F.lit(1000)) / 1000
        centre = F.struct(F.col("degree") * (1 - 0.3 * chance * min(1, salt)), F.col("class"))
        ends = entries.groupBy("gram").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.max_by("class", centre).alias("pivot")
        )
        open_columns = ends.where("low <> high").select("gram", "pivot")
        return (
            entries.join(open_columns, "gram")
            .where("class <> pivot")
            .select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b"), F.lit(1).alias("shared"))
        )

    def grouped(self, known: DataFrame | None) -> DataFrame:
        """Entries with the root of their class."""
        if known is None:
            return self.entries.withColumn("root", F.col("class"))
        roots = known.select(F.col("node").alias("class"), "root")
        return self.entries.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))

    def cross(self, known: DataFrame) -> DataFrame:
        """All pairs of a column that are not yet connected and may still link.

        Of two rows, the one whose prefix ends first in the order of columns has all common columns of
        that prefix in the other's prefix too. So two rows of different components overlap in the open
        columns that both can have, and in what the one of them holds beyond its prefix, at most. Pairs
        for which that is too little, or whose sizes differ too much, are not multiplied. Rows with few
        such columns carry the list of them, so that a pair is multiplied in one go, at its first common
        column; longer rows are multiplied column by column.
        """
        p = self.percent
        entries = self.grouped(known)
        ends = entries.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        entries = entries.join(ends.where("low <> high").select("gram"), "gram")
        entries = self.scratch.table(entries.select("gram", "class", "root", "n"), "open")
        beyond = F.ceil(F.col("n") * p / 100) - 1
        listed = F.when(F.count("*") <= LISTED_COLUMNS, F.collect_list("gram"))
        by_class = entries.groupBy("class").agg(F.count("*").alias("open"), listed.alias("grams"))
        entries = entries.join(by_class, "class").withColumn("beyond", beyond)
        left, right = (
            entries.select("gram", *[F.col(c).alias(f"{c}_{side}") for c in entries.columns if c != "gram"])
            for side in "ab"
        )
        needed = F.expr(f"ceil((n_a + n_b) * {p} / {100 + p})")
        common = F.array_intersect("grams_a", "grams_b")
        in_one_go = F.col("grams_a").isNotNull() & F.col("grams_b").isNotNull()
        once = (F.array_min(common) == F.col("gram")) & (F.size(common) + F.greatest("beyond_a", "beyond_b") >= needed)
        conditions = (
            F.expr("class_a < class_b AND root_a <> root_b")
            & F.expr(f"n_a * 100 >= n_b * {p} AND n_b * 100 >= n_a * {p}")
            & (F.least("open_a", "open_b") + F.greatest("beyond_a", "beyond_b") >= needed)
            & (~in_one_go | once)
        )
        return left.join(right, "gram").where(conditions).select(
            F.col("class_a").alias("a"),
            F.col("class_b").alias("b"),
            F.when(in_one_go, F.size(common)).otherwise(1).alias("shared"),
        )

    def run(self) -> DataFrame:
        self.fill(self.measure())
        known, links = None, None
        rounds = 0 if self.entries.isEmpty() else PIVOT_ROUNDS + 1
        for number in range(rounds):
            pairs = self.cross(known) if number == PIVOT_ROUNDS else self.pivots(known, number)
            found = self.products(pairs, f"round_{number}")
            if found is not None:
                links = found if links is None else links.unionByName(found)
                known = components(links.select("a", "b"), self.scratch, f"components_{number}")
        rooted = self.classes.select("class", "doc_id", F.col("class").alias("root"))
        if known is not None:
            roots = known.select(F.col("node").alias("class"), F.col("root").alias("found"))
            rooted = rooted.join(roots, "class", "left").select(
                "class", "doc_id", F.coalesce("found", "root").alias("root")
            )
        smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        by_class = rooted.join(smallest, "root").select("class", "component_id")
        result = (
            self.docs.join(by_class, "class", "left")
            .withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select(
                "doc_id",
                "n_shingles",
                F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
            )
        )
        result = self.scratch.table(result, "result")
        self.scratch.drop(*[name for name in self.scratch.names if name != "result"])
        return result


def near_duplicates(
    df: DataFrame,
    gram_size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    A set holds the distinct n-grams of the whole text, of words between ASCII white space with A-Z in
    lower case; a text with fewer words is one n-gram. Two sets link if their Jaccard similarity is at
    least ``percent`` / 100. ``component_id`` is the smallest id reachable by links, the row's own
    included. N-grams are compared by 64-bit hashes.

    Null and empty texts have an empty set and link with nothing: their component is their own id.
    Rows without an id have none and take no part. Repeated rows are copies of each other and share a
    component. Other columns are not read; an empty table gives an empty result.
    """
    return _Join(df, gram_size, percent, id_col, text_col).run()
