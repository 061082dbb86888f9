"""Near duplicates by an LSH forest: MinHash signatures in several sorted orders.

Documents with the same set of n-grams form a class with one signature: 128 functions, of whose least
values one byte each is kept. A tree of the forest is a permutation of the signature, kept as a sorted order
of all classes: those that share a prefix, a region of the tree, lie next to each other.

* Neighbours in an order whose longest common prefix is deep enough are candidates. Every class is confirmed
  with the neighbour it shares most bytes of prefixes with, over all orders.
* A region can hold classes that are not neighbours. Its classes are confirmed with one central class as
  well: copies of one text connect through those with few changes. A dense region is first divided at its next
  byte, as long as the chance to miss a link at that depth stays small.
* Where regions still join several components after that, their classes form clusters. All classes of a cluster are compared with those
  outside its largest component, block by block: by their signatures, and if those agree enough (six
  standard deviations below what a link is expected to have) by their whole sets. A block gives only links that
  connect something, so what leaves a task grows with its rows, not with their pairs.

Depths follow from the asked similarity: two sets that just link share no region of the least depth in any
order with a chance of 1e-8, none of the greatest depth with 1e-5.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluicegate.llm.common import Batches, Scratch, bit_filter, chosen_by, map_batches
from sluicegate.llm.components import components
from sluicegate.llm.words import gram_sets, mix

HASHES, ORDERS, LABEL = 128, 64, 16
# Regions are told apart by the first number of a label.
MOST_DEPTH = 8
# A region with more comparisons is divided, as far as depths allow.
REGION_PAIRS = 1 << 18
# Bytes of sets of one block of a cluster, and of one group.
BLOCK_BYTES = 8 << 20
# N-grams that a task holds at once; a longer text is held alone.
GROUP_GRAMS = 1 << 20
# Bits of a filter for each document it lets through, and at most.
BITS_A_ROW, MOST_BITS = 32, 1 << 29

_random = np.random.default_rng(41_121)
_FLIPS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_FACTORS = _random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ORDERS = np.stack([_random.permutation(HASHES)[:LABEL] for _ in range(ORDERS)])
_KEY = np.array([3, 5, 7], np.uint64)
_SIGN = np.uint64(1 << 63)


def class_key(grams: np.ndarray) -> int:
    """One 64-bit number for a set."""
    state = np.array([grams.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(grams)), len(grams)], np.uint64)
    return int(mix((mix(state) * _KEY).sum(keepdims=True)).view(np.int64)[0])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A byte for every non-empty set (row) and hash function: two sets agree in as many as they are similar."""
    found = np.zeros((len(sets), HASHES), np.uint8)
    start = 0
    while start < len(sets):
        stop, held = start, 0
        while stop < len(sets) and (stop == start or held + len(sets[stop]) <= 1 << 17):
            held += len(sets[stop])
            stop += 1
        grams = np.concatenate(sets[start:stop])
        grams = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
        begin = np.cumsum([0, *map(len, sets[start : stop - 1])])
        values = np.empty_like(grams)
        for j in range(HASHES):
            np.bitwise_xor(grams, _FLIPS[j], out=values)
            np.multiply(values, _FACTORS[j], out=values)
            least = np.minimum.reduceat(values, begin)
            found[start:stop, j] = mix(least.astype(np.uint64) + np.uint64(j << 32)).astype(np.uint8)
        start = stop
    return found


def depth_for(similarity: float, chance: float) -> int:
    """The deepest prefix that two sets so similar share in no order with at most this chance."""
    if similarity >= 1:
        return MOST_DEPTH
    return max(1, min(MOST_DEPTH, int(math.log(1 - chance ** (1 / ORDERS)) / math.log(similarity))))


def least_agreeing(similarity: float) -> int:
    return max(1, int(HASHES * similarity - 6 * math.sqrt(HASHES * similarity * (1 - similarity))))


def _set_groups(batch: pa.RecordBatch, size: int):
    """Sets of neighbouring rows with the first row's place, about a million n-grams at a time."""
    start, sets, held = 0, [], 0
    for i, grams in enumerate(gram_sets(batch.column("text"), size)):
        sets.append(grams)
        held += len(grams)
        if held >= GROUP_GRAMS or i + 1 == len(batch):
            yield start, sets
            start, sets, held = i + 1, [], 0


def _signed(size: int):
    """Documents with the size, class and signature of their set."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for start, sets in _set_groups(batch, size):
                full = [grams for grams in sets if len(grams)]
                signed = iter([row.tobytes() for row in signatures(full)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(start, len(sets)),
                        pa.array(list(map(len, sets)), pa.int64()),
                        pa.array([class_key(grams) if len(grams) else None for grams in sets], pa.int64()),
                        pa.array([next(signed) if len(grams) else None for grams in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "class", "signature"],
                )

    return run


def _labelled(batches: Batches) -> Batches:
    """A row for every class and order, with the label in two numbers that sort like its bytes."""
    for whole in batches:
        for begin in range(0, len(whole), 2048):
            batch = whole.slice(begin, 2048)
            signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
            labels = np.ascontiguousarray(signed[:, _ORDERS]).view(">u8").astype(np.uint64) ^ _SIGN
            keys = batch.column("class").to_numpy()
            columns = [
                np.tile(np.arange(ORDERS, dtype=np.int32), len(batch)),
                labels[:, :, 0].ravel().view(np.int64),
                labels[:, :, 1].ravel().view(np.int64),
                np.repeat(keys, ORDERS),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tree", "high", "low", "class"])


def _common(tree: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Bytes that each row's label shares with the row before it."""
    if not len(tree):
        return np.zeros(0, np.int64)
    first, second = high[1:] ^ high[:-1], low[1:] ^ low[:-1]
    shared = np.where(first != 0, _leading(first), 8 + _leading(second))
    return np.r_[0, np.where(tree[1:] == tree[:-1], shared, 0)]


def _leading(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit numbers."""
    octets = x.astype(">u8").view(np.uint8).reshape(-1, 8) != 0
    return np.where(octets.any(axis=1), octets.argmax(axis=1), 8)


def _neighbours(depth: int):
    """Of sorted rows those that share a region with a row beside them, with the class before them and the bytes shared.

    The first and last row of a task are always given, with ``edge`` 0 and 1: their neighbours are elsewhere.
    """

    def run(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId()
        held, first = None, True
        for batch in batches:
            rows = pa.table(batch.columns, names=batch.schema.names)
            if held is not None:
                rows = pa.concat_tables([held, rows])
            if len(rows):
                # The last row waits for the next batch, and comes again if that shows a neighbour.
                yield _near(rows, depth, number, 0 if first else None, None)
                held, first = rows.slice(len(rows) - 1), False
        if held is not None:
            yield _near(held, depth, number, None, 1)

    return run


def _near(rows: pa.Table, depth: int, number: int, at_start: int | None, at_end: int | None) -> pa.RecordBatch:
    tree, high, low, keys = (rows.column(name).to_numpy() for name in ("tree", "high", "low", "class"))
    shared = _common(tree, high.view(np.uint64), low.view(np.uint64))
    deep = shared >= depth
    near = deep | np.r_[deep[1:], False]
    edge = np.full(len(rows), -1, np.int8)
    if at_start is not None:
        edge[0] = at_start
    if at_end is not None:
        edge[-1] = at_end
    at = np.flatnonzero(near | (edge >= 0))
    before = np.where(deep[at], keys[at - 1], 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(c[at]) for c in (tree, high, low, keys)]
        + [
            pa.array(before, pa.int64(), mask=~deep[at]),
            pa.array(shared[at].astype(np.int32), pa.int32(), mask=~deep[at]),
            pa.array(edge[at].astype(np.int32), pa.int32(), mask=edge[at] < 0),
            pa.array(np.full(len(at), number, np.int32)),
        ],
        names=["tree", "high", "low", "class", "before", "shared", "edge", "part"],
    )


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).sum(axis=-1)


def _compared(batches: Batches) -> Batches:
    """Pairs with the number of functions their signatures agree in."""
    for whole in batches:
        for begin in range(0, len(whole), 4096):
            batch = whole.slice(begin, 4096)
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sa", "sb")
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(_agreeing(left, right), pa.int64())],
                names=["a", "b", "agreeing"],
            )


def _within(percent: int, least: int):
    """Links of a group's blocks, between a row outside its cluster's largest component and any other row.

    Only those that connect what the block did not know to be connected.
    """

    def run(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by([("block", "ascending"), ("class", "ascending")]).combine_chunks()
        block, keys, roots = (part.column(c).to_numpy() for c in ("block", "class", "root"))
        minor, any_row = (part.column(c).to_numpy() for c in ("minor", "any"))
        signed = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
        grams = part.column("grams").combine_chunks()
        ends = grams.offsets.to_numpy()
        values, ends = grams.values.to_numpy().view(np.uint64), ends.astype(np.int64)
        sizes = np.diff(ends)
        found = []
        bounds = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            joined: dict[int, int] = {}
            others = np.arange(start, end)[any_row[start:end]]
            for at in np.arange(start, end)[minor[start:end]].tolist():
                may = others[
                    (roots[others] != roots[at])
                    & (sizes[others] * 100 >= sizes[at] * percent)
                    & (sizes[at] * 100 >= sizes[others] * percent)
                ]
                may = may[_agreeing(signed[may], signed[at]) >= least]
                may = may[[_root(joined, r) != _root(joined, roots[at].item()) for r in roots[may].tolist()]] if len(joined) else may
                if not len(may):
                    continue
                overlap = _overlaps(values, ends, at, may)
                for other in may[overlap * 100 >= (sizes[at] + sizes[may] - overlap) * percent].tolist():
                    one, two = _root(joined, roots[at].item()), _root(joined, roots[other].item())
                    if one != two:
                        joined[one] = two
                        found.append(sorted((keys[at].item(), keys[other].item())))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _root(joined: dict[int, int], root: int) -> int:
    while root in joined:
        root = joined[root]
    return root


def _overlaps(values: np.ndarray, ends: np.ndarray, at: int, others: np.ndarray) -> np.ndarray:
    """How many of one sorted set's values some others have."""
    own = values[ends[at] : ends[at + 1]]
    sizes = ends[others + 1] - ends[others]
    first = np.cumsum(sizes) - sizes
    theirs = values[np.repeat(ends[others] - first, sizes) + np.arange(sizes.sum())]
    place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
    return np.add.reduceat((own[place] == theirs).astype(np.int64), first)


def _sets_of(size: int, shared):
    """Sets of the documents that a filter lets through, each class once per task."""

    def run(batches: Batches) -> Batches:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(chosen_by(shared.value, batch.column("place").to_numpy(zero_copy_only=False))))
            for _, sets in _set_groups(batch, size):
                rows = {class_key(grams): grams for grams in sets if len(grams)}
                rows = {key: grams.view(np.int64) for key, grams in rows.items() if key not in seen}
                seen.update(rows)
                if rows:
                    ends = pa.array(np.cumsum([0, *map(len, rows.values())]), pa.int32())
                    lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(list(rows.values()))))
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), lists], names=["class", "grams"])

    return run


class _Forest:
    """One run over a table of documents."""

    def __init__(self, df: DataFrame, size: int, percent: int, id_col: str, text_col: str):
        self.spark = df.sparkSession
        self.size, self.percent = size, percent
        self.texts = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
        self.id_type = df.schema[id_col].dataType
        self.scratch = Scratch(self.spark)
        self.least = least_agreeing(percent / 100)
        self.depth = depth_for(percent / 100, 1e-8)
        self.deepest = depth_for(percent / 100, 1e-5)
        self.known: DataFrame | None = None

    def sign(self) -> None:
        """Documents, and classes with their first document and signature."""
        schema = T.StructType([T.StructField("doc_id", self.id_type)]).add("n_shingles", "long").add("class", "long").add("signature", "binary")
        signed = self.scratch.table(map_batches(self.texts, _signed(self.size), schema), "signed")
        self.docs = signed.select("doc_id", "n_shingles", "class")
        one = F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "signature")).alias("one")
        classes = signed.where("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(one)
        self.classes = self.scratch.table(classes.select("class", "one.*"), "classes")

    def order(self) -> DataFrame:
        """Rows that share a region with a neighbour in an order; returns each class with its best neighbour.

        Neighbours are weighed by the bytes they share, so that one pair for each class goes on, not one for each order.
        """
        labelled = map_batches(self.classes.select("class", "signature"), _labelled, "tree int, high long, low long, class long")
        by = ["tree", "high", "low", "class"]
        ordered = labelled.repartitionByRange(*by).sortWithinPartitions(*by)
        schema = "tree int, high long, low long, class long, before long, shared int, edge int, part int"
        self.regions = self.scratch.table(map_batches(ordered, _neighbours(self.depth), schema), "regions")
        # The last row of a task and the first of the next: two rows for each task, whatever the data.
        edges = self.regions.where("edge IS NOT NULL")
        along = Window.orderBy("part", "edge")
        seams = edges.select("edge", "tree", F.col("class"), F.expr(self._prefix(self.depth)).alias("prefix"), *[
            F.lag(c).over(along).alias(f"{c}_before") for c in ("class", "tree")
        ], F.lag(F.expr(self._prefix(self.depth))).over(along).alias("prefix_before"))
        seams = seams.where("edge = 0 AND tree = tree_before AND prefix = prefix_before")
        pairs = self.regions.where("before IS NOT NULL").select("class", "before", "shared").unionByName(
            seams.select("class", F.col("class_before").alias("before"), F.lit(self.depth).alias("shared"))
        )
        pair = F.least("class", "before").alias("a"), F.greatest("class", "before").alias("b")
        weighed = pairs.where("class <> before").groupBy(*pair).agg(F.sum("shared").alias("shared"))
        both = weighed.unionByName(weighed.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
        best = both.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
        return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    @staticmethod
    def _prefix(depth: int) -> str:
        return f"shiftright(high, {64 - 8 * depth})"

    def _pairs(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose sizes and signatures allow a link."""
        p = self.percent
        left, right = (
            self.classes.select(F.col("class").alias(s), F.col("signature").alias(f"s{s}"), F.col("n").alias(f"n{s}")) for s in "ab"
        )
        sized = pairs.join(left, "a").join(right, "b").where(f"na * 100 >= nb * {p} AND nb * 100 >= na * {p}")
        compared = map_batches(sized.select("a", "b", "sa", "sb"), _compared, "a long, b long, agreeing long")
        return self.scratch.table(compared.where(F.col("agreeing") >= self.least).select("a", "b"), name)

    def confirm(self, pairs: DataFrame) -> None:
        """Confirm those of the pairs that may link on whole sets, and connect those that do."""
        pairs = self._pairs(pairs, "first_pairs")
        if pairs.isEmpty():
            return
        sets = self._sets(pairs.select("a").union(pairs.select("b")).distinct(), "pair")
        left = sets.select(F.col("class").alias("a"), F.col("grams").alias("ga"))
        right = sets.select(F.col("class").alias("b"), F.col("grams").alias("gb"))
        both = pairs.join(left, "a").join(right, "b").withColumn("overlap", F.size(F.array_intersect("ga", "gb")))
        union = F.size("ga") + F.size("gb") - F.col("overlap")
        links = self.scratch.table(both.where(F.col("overlap") * 100 >= union * self.percent).select("a", "b"), "first_links")
        self.known = components(links, self.scratch, "first_components")
        self.scratch.drop("pair_sets", "pair_first")

    def _sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """Whole sets of classes, read again from the text of each one's first document.

        A bit filter picks the documents while texts are read, so that texts are not shuffled; those that
        it lets through by chance fall out in the join.
        """
        first = self.scratch.table(wanted.toDF("class").join(self.classes.select("class", "doc_id"), "class"), f"{name}_first")
        bits = 1 << 16
        while bits < min(MOST_BITS, BITS_A_ROW * first.count()):
            bits *= 2
        place = F.pmod(F.xxhash64("id"), F.lit(bits)).alias("place")
        shared = self.spark.sparkContext.broadcast(bit_filter(first.select(F.col("doc_id").alias("id")).select(place), bits))
        texts = self.texts.where("id IS NOT NULL").select("text", place)
        found = map_batches(texts, _sets_of(self.size, shared), "class long, grams array<long>")
        # A class comes once from each task that has a copy of its document.
        whole = found.join(first.select("class"), "class", "left_semi").dropDuplicates(["class"])
        return self.scratch.table(whole, f"{name}_sets")

    def rooted(self, rows: DataFrame) -> DataFrame:
        if self.known is None:
            return rows.withColumn("root", F.col("class"))
        roots = self.known.select(F.col("node").alias("class"), "root")
        return rows.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))

    def open_regions(self) -> DataFrame:
        """``region, class, root`` of regions that join several components, dense ones divided."""
        rows = self.rooted(self.regions.select("tree", "high", "class").distinct())
        found = None
        for depth in range(self.depth, self.deepest + 1):
            rows = rows.withColumn("region", F.xxhash64("tree", F.expr(self._prefix(depth))))
            by_root = rows.groupBy("region", "root").agg(F.count("*").alias("count"))
            sizes = by_root.groupBy("region").agg(F.max("count").alias("most"), F.sum("count").alias("total"))
            rows = rows.join(sizes.where("most < total"), "region")
            dense = F.lit(depth < self.deepest) & ((F.col("total") - F.col("most")) * F.col("total") > REGION_PAIRS)
            taken = rows.where(~dense).select("region", "class", "root")
            found = taken if found is None else found.unionByName(taken)
            rows = rows.where(dense).select("tree", "high", "class", "root")
        return found

    def centres(self) -> DataFrame:
        """Pairs of a region's classes with its central one, the class that shares the most regions."""
        rows = self.open_regions().select("region", "class")
        degrees = rows.groupBy("class").agg(F.count("*").alias("degree"))
        weighed = self.scratch.table(rows.join(degrees, "class"), "weighed")
        centre = weighed.groupBy("region").agg(F.max_by("class", F.struct("degree", "class")).alias("centre"))
        pairs = weighed.join(centre, "region").where("class <> centre")
        return pairs.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()

    def clusters(self) -> None:
        """Confirm what open regions may still join, cluster by cluster."""
        rows = self.scratch.table(self.open_regions(), "open")
        if rows.isEmpty():
            return
        cluster = components(self._tied(rows), self.scratch, "clusters").select(F.col("node").alias("class"), F.col("root").alias("cluster"))
        rows = rows.select("class", "root").distinct().join(cluster, "class")
        rows = self.scratch.table(rows.join(self.classes.select("class", "n", "signature"), "class"), "clustered")
        weight = F.sum(8 * F.col("n") + HASHES).alias("bytes")
        by_root = rows.groupBy("cluster", "root").agg(weight)
        largest = by_root.groupBy("cluster").agg(
            F.max_by("root", F.struct("bytes", "root")).alias("main"), F.max("bytes").alias("most"), F.sum("bytes").alias("bytes")
        )
        placed = self._placed(rows.join(largest, "cluster"))
        sets = self._sets(rows.select("class"), "cluster")
        placed = self.scratch.table(placed.join(sets, "class"), "placed")
        groups = placed.agg(F.sum(8 * F.size("grams") + HASHES)).first()[0] // BLOCK_BYTES + 1
        groups = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), groups)
        bucket = F.pmod("block", F.lit(groups)).alias("bucket")
        links = placed.groupBy(bucket).applyInArrow(_within(self.percent, self.least), "a long, b long")
        links = self.scratch.table(links, "cluster_links")
        if not links.isEmpty():
            if self.known is not None:
                links = links.unionByName(self.known.select(F.col("node").alias("a"), F.col("root").alias("b")))
            self.known = components(links, self.scratch, "all_components")

    def _tied(self, rows: DataFrame) -> DataFrame:
        """Edges that make classes of one region one cluster, and regions with a class in common.

        A class is tied to the least class it meets, and so are the least classes of its regions: many classes
        have the same, so that edges are not much more than classes, however many regions each is in.
        """
        least = rows.groupBy("region").agg(F.min("class").alias("least"))
        met = rows.join(least, "region").select("class", "least").distinct()
        met = self.scratch.table(met.withColumn("b", F.min("least").over(Window.partitionBy("class"))), "met")
        tied = met.select(F.col("class").alias("a"), "b").unionByName(met.select(F.col("least").alias("a"), "b"))
        return tied.where("a <> b").distinct()

    def _placed(self, rows: DataFrame) -> DataFrame:
        """A row of a cluster goes to each block that its own block of rows forms with a block of minor rows."""
        minor = F.col("root") != F.col("main")
        rows = rows.withColumns(
            {
                "is_minor": minor,
                "minor_blocks": F.ceil((F.col("bytes") - F.col("most")) / BLOCK_BYTES).cast("int"),
                "blocks": F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int"),
            }
        )
        own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
        own_minor = F.pmod(F.xxhash64("class", F.lit(1)), F.col("minor_blocks")).cast("int")

        def place(i, j, is_minor, is_any):
            return F.struct(i.alias("i"), j.alias("j"), is_minor.alias("minor"), F.lit(is_any).alias("any"))

        as_any = F.transform(
            F.sequence(F.lit(0), F.col("minor_blocks") - 1), lambda i: place(i, own, F.col("is_minor") & (own_minor == i), True)
        )
        # A minor row is in the block of its own rows already.
        as_minor = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: place(own_minor, j, F.lit(True), False))
        as_minor = F.filter(as_minor, lambda s: F.col("is_minor") & (s["j"] != own))
        return rows.withColumn("place", F.explode(F.concat(as_any, as_minor))).select(
            F.xxhash64("cluster", "place.i", "place.j").alias("block"), "class", "root", "signature", "place.minor", "place.any"
        )

    def run(self) -> DataFrame:
        self.sign()
        best = self.order()
        self.confirm(best.unionByName(self.centres()).distinct())
        self.clusters()
        return self._result()

    def _result(self) -> DataFrame:
        rooted = self.rooted(self.classes.select("class", "doc_id"))
        smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        by_class = rooted.join(smallest, "root").select("class", "component_id")
        component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        result = (
            self.docs.join(by_class, "class", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
            .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
        )
        result = self.scratch.table(result, "result")
        self.scratch.drop(*[name for name in self.scratch.names if name != "result"])
        return result


def forest_duplicates(
    df: DataFrame,
    gram_size: int = 4,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    A set holds the distinct n-grams of the whole text, of words between ASCII white space with A-Z in
    lower case; a text with fewer words is one n-gram. Two sets link if their Jaccard similarity is at
    least ``percent`` / 100, which is confirmed on whole sets; candidates come from the forest, which misses
    a link with a chance of about 1e-8, and 1e-5 in dense regions. ``component_id`` is the smallest id reachable
    by links, the row's own included; ``kept`` tells whether it is the row's own. N-grams are compared by
    64-bit hashes.

    Null and empty texts have an empty set and link with nothing: their component is their own id. Rows
    without an id take no part and have neither component nor ``kept``. Repeated rows are copies of each
    other and share a component. Other columns are not read; an empty table gives an empty result.
    """
    return _Forest(df, gram_size, percent, id_col, text_col).run()
