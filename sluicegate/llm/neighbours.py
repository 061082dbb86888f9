"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are dealt to bands by their norms, scaled by the largest norm of their band and given one more
component that makes all lengths 1, so that within a band the largest inner product is the smallest distance;
without bands one long vector would move all others to one place. A query visits the bands alike. A hash is the slot of a vector's projection on a
random Gaussian direction; a table joins several. A query visits, in every table, its own bucket and
then buckets whose slots differ by one, in the order in which they are expected to hold neighbours: by
the squared distances to the slots' borders. Candidates of all tables are ranked by exact products.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, Scratch, find_on_workers, map_batches
from sluicegate.llm.words import mix

TABLES = 8
# Slots' width in units of a unit vector's projections, which have standard deviation 1.
WIDTH = 1.5
# Vectors per bucket that the number of hashes in a table aims at.
PER_BUCKET = 16
# Queries that the number of probes is fitted on; the share of their neighbours it must reach.
SAMPLE, RECALL = 64, 0.96
MOST_PROBES = 1 << 13
# Bands halve the norm; the last one takes all shorter vectors.
BANDS = 8
# Vectors that a task compares queries with, and probing queries that it compares at once.
PART_ROWS, PART_PROBES = 1 << 16, 1 << 14
# Queries and vectors of one block of the exact way.
BLOCK_QUERIES, BLOCK_ROWS = 1 << 11, 1 << 15


def probe_order(hashes: int, count: int) -> np.ndarray:
    """The first ``count`` sets of perturbations by expected squared distance to the borders.

    Rows of a 0/1 matrix over the 2 * ``hashes`` single perturbations, nearest border first. A set
    never moves a slot both ways, which are the nearest and the farthest, the second and so on.
    """
    n = 2 * hashes
    near = [j * (j + 1) / (4 * (hashes + 1) * (hashes + 2)) for j in range(1, hashes + 1)]
    far = []
    for j in range(hashes + 1, n + 1):
        k = n + 1 - j
        far.append(1 - k / (hashes + 1) + k * (k + 1) / (4 * (hashes + 1) * (hashes + 2)))
    cost = near + far
    sets, heap = [()], [(cost[0], (0,))]
    while heap and len(sets) < count:
        total, own = heapq.heappop(heap)
        if all(n - 1 - j not in own for j in own):
            sets.append(own)
        last = own[-1]
        if last + 1 < n:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*own[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*own, last + 1)))
    order = np.zeros((len(sets), n), np.int8)
    for row, own in enumerate(sets):
        order[row, list(own)] = 1
    return order


class Tables:
    """Random projections of all tables."""

    def __init__(self, size: int, hashes: int, largest: dict[int, float], tables: int = TABLES, seed: int = 3):
        """``largest`` has the largest norm of each band."""
        source = np.random.default_rng(seed)
        self.hashes, self.tables = hashes, tables
        self.bands = sorted(largest)
        self.scales = np.ones(BANDS)
        self.scales[self.bands] = [largest[band] for band in self.bands]
        self.directions = source.normal(size=(tables, size + 1, hashes))
        self.offsets = source.uniform(0, 1, (tables, hashes))
        self.weights = source.integers(1, 1 << 62, (tables, hashes + 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def places(self, vectors: np.ndarray, bands: np.ndarray | None) -> np.ndarray:
        """Projections in units of slots: table, vector, hash. A query has no band, and its length does not matter."""
        if bands is None:
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            more = np.zeros(len(vectors))
        else:
            unit = vectors / self.scales[bands, None]
            more = np.sqrt(np.maximum(0, 1 - (unit**2).sum(1)))
        whole = np.concatenate([unit, more[:, None]], 1)
        return np.einsum("nd,tdh->tnh", whole, self.directions) / WIDTH + self.offsets[:, None]

    def codes(self, table: int, slots: np.ndarray, bands: np.ndarray | int) -> np.ndarray:
        """A 64-bit number for a bucket of a band; the last axis holds its slots."""
        weights = self.weights[table]
        own = (slots.astype(np.int64).view(np.uint64) * weights[1:]).sum(-1, dtype=np.uint64)
        return mix(own + weights[0] * (np.asarray(bands, np.uint64) + np.uint64(1)))

    def moves(self, places: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A table's own slots of queries, and the changes of slots (query, probe, hash) in order."""
        slots = np.floor(places)
        down = places - slots
        n, h = places.shape
        nearest = np.argsort(np.concatenate([down, 1 - down], 1) ** 2, axis=1, kind="stable")
        single = np.zeros((n, 2 * h, h), np.int8)
        rows, ranks = np.arange(n)[:, None], np.arange(2 * h)[None]
        single[rows, ranks, nearest % h] = np.where(nearest < h, -1, 1)
        return slots.astype(np.int64), np.einsum("pr,nrh->nph", order, single)


def _usable(vector: Column) -> Column:
    """Whether a vector has numbers only, and not all of them 0."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


class _Search:
    def __init__(self, df: DataFrame, every: int, count: int, id_col: str, vector_col: str):
        self.spark, self.every, self.count = df.sparkSession, every, count
        self.scratch = Scratch(self.spark)
        rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].alias("vector"))
        rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
        by_size = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
        sizes = by_size.limit(1).collect()
        self.size = sizes[0]["size"] if sizes else 1
        rows = rows.where(F.size("vector") == self.size)
        # Of equal vectors only the smallest ids can be among the nearest.
        equal = Window.partitionBy("vector").orderBy("vec_id")
        self.index = self.scratch.table(
            rows.distinct().withColumn("place", F.row_number().over(equal)).where(F.col("place") <= count + 1).drop("place"),
            "index",
        )
        self.queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
        squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        total = self.index.agg(F.count("*").alias("n"), F.max(squares).alias("most")).first()
        self.rows, most = total.n, math.sqrt(total.most or 1.0)
        share = F.greatest(F.sqrt(squares) / F.lit(most), F.lit(2.0 ** -(BANDS + 1)))
        band = F.greatest(F.lit(0), F.least(F.lit(BANDS - 1), F.floor(-F.log2(share)))).cast("int")
        self.index = self.index.withColumn("band", band)
        bands = self.index.groupBy("band").agg(F.max(F.sqrt(squares)).alias("largest")).collect()
        self.largest = {row.band: row.largest * (1 + 1e-12) for row in bands} or {0: 1.0}
        self.tables = self._tables(min(16, max(2, round(math.log(max(1, self.rows / PER_BUCKET), 4)))))

    def _tables(self, hashes: int) -> Tables:
        return Tables(self.size, hashes, self.largest)

    def exact(self, queries: pa.Table) -> DataFrame:
        """The exact neighbours of a few queries, from one pass over all vectors."""
        count = self.count
        ids = queries.column("vec_id").to_numpy()
        wanted = self.spark.sparkContext.broadcast((ids, _matrix(queries.column("vector").combine_chunks())))

        def best(batches: Batches) -> Batches:
            query_ids, vectors = wanted.value
            for batch in batches:
                own, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"))
                scores = vectors @ matrix.T
                scores[query_ids[:, None] == own[None]] = -np.inf
                at = np.argsort(-scores, axis=1, kind="stable")[:, :count]
                top = np.take_along_axis(scores, at, 1).ravel()
                rows = pa.array(at.ravel())
                table = pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, at.shape[1])),
                        pa.array(own[at.ravel()]),
                        pa.array(top),
                        batch.column("vector").take(rows),
                        batch.column("band").take(rows),
                    ],
                    names=["query_id", "vec_id", "score", "vector", "band"],
                )
                yield table.filter(pa.array(top > -np.inf))

        kind = self.index.schema["vector"].dataType.simpleString()
        found = map_batches(self.index, best, f"query_id long, vec_id long, score double, vector {kind}, band int")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= count)

    def blocked(self, queries: DataFrame) -> DataFrame:
        """The exact neighbours of any number of queries: every block of queries meets every block of vectors."""
        count, rows = self.count, queries.count()
        across, down = max(1, -(-rows // BLOCK_QUERIES)), max(1, -(-self.rows // BLOCK_ROWS))

        def compared(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            if len(left) and len(right):
                at = np.argsort(left.column("vec_id").to_numpy(), kind="stable")
                ids = left.column("vec_id").to_numpy()[at]
                vectors = _matrix(left.column("vector").combine_chunks())[at]
                for query_id, query in zip(right.column("query_id").to_pylist(), _matrix(right.column("query").combine_chunks()), strict=True):
                    found.append(_nearest(query_id, query, ids, vectors, np.flatnonzero(ids != query_id), count))
            return _found(found)

        index = self.index.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(down)).alias("block")).withColumn(
            "side", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long")))
        )
        probes = queries.select(
            F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.pmod(F.xxhash64("vec_id"), F.lit(across)).alias("side")
        ).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
        find_on_workers(self.spark)
        both = index.groupBy("block", "side").cogroup(probes.groupBy("block", "side"))
        return both.applyInArrow(compared, "query_id long, vec_id long, score double")

    def probes(self) -> np.ndarray | None:
        """The order of probes, as long as the sample's neighbours ask for; None if no number of them is enough.

        Where the asked share lies beyond all probes, tables of fewer hashes are taken, whose buckets are larger.
        """
        sample = self.queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
        near = self.exact(sample).select("query_id", "vector", "band").toArrow() if len(sample) else pa.table({})
        if not len(near):
            return probe_order(self.tables.hashes, 1)
        for hashes in range(self.tables.hashes, 0, -1):
            self.tables = self._tables(hashes)
            order = probe_order(hashes, MOST_PROBES)
            first = np.sort(self._first_probes(sample, near, order))
            needed = int(first[math.ceil(RECALL * len(first)) - 1])
            if needed < len(order):
                return order[: needed + 1]
        return None

    def _first_probes(self, sample: pa.Table, near: pa.Table, order: np.ndarray) -> np.ndarray:
        """The first probe that reaches each neighbour of the sample in some table; their number if none does."""
        row = {i: k for k, i in enumerate(sample.column("vec_id").to_pylist())}
        of = np.array([row[i] for i in near.column("query_id").to_pylist()])
        queries = self.tables.places(_matrix(sample.column("vector").combine_chunks()), None)
        found = self.tables.places(_matrix(near.column("vector").combine_chunks()), near.column("band").to_numpy())
        first = np.full(len(of), len(order))
        power = 3 ** np.arange(self.tables.hashes)
        for table in range(self.tables.tables):
            slots, moves = self.tables.moves(queries[table], order)
            codes = ((moves.astype(np.int64) + 1) * power).sum(2)
            change = np.floor(found[table]).astype(np.int64) - slots[of]
            wanted = np.where((np.abs(change) <= 1).all(1), ((change + 1) * power).sum(1), -1)
            for k, (query, code) in enumerate(zip(of.tolist(), wanted.tolist(), strict=True)):
                hit = np.flatnonzero(codes[query] == code)
                if len(hit):
                    first[k] = min(first[k], hit[0])
        return first

    def run(self) -> DataFrame:
        order = self.probes()
        if order is None:
            found = self.blocked(self.queries)
        else:
            found = self.scratch.table(self.probed(order), "probed")
            # Queries that met too few vectors are compared with all.
            met = found.groupBy("query_id").agg(F.count("*").alias("n"))
            others = self.queries.join(met, F.col("vec_id") == F.col("query_id"), "left")
            short = others.where(F.coalesce("n", F.lit(0)) < min(self.count, self.rows - 1)).select("vec_id", "vector")
            short = self.scratch.table(short, "short")
            if not short.isEmpty():
                ids = short.select(F.col("vec_id").alias("query_id"))
                found = found.join(ids, "query_id", "left_anti").unionByName(self.blocked(short))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        found = found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= self.count)
        result = self.scratch.table(found.select("query_id", "rank", "vec_id", "score"), "result")
        self.scratch.drop(*[name for name in self.scratch.names if name != "result"])
        return result

    def probed(self, order: np.ndarray) -> DataFrame:
        """The nearest of the vectors that each query's probes reach."""
        tables, count = self.tables, self.count
        parts = max(1, math.ceil(self.rows * tables.tables / PART_ROWS))
        kind = self.index.schema["vector"].dataType
        long = T.LongType()
        model = self.spark.sparkContext.broadcast((tables, order))

        def indexed(batches: Batches) -> Batches:
            own, _ = model.value
            for batch in batches:
                bands = batch.column("band").to_numpy()
                places = own.places(_matrix(batch.column("vector")), bands)
                for table in range(own.tables):
                    codes = own.codes(table, np.floor(places[table]), bands)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((codes % np.uint64(parts)).astype(np.int64)), pa.array(codes.view(np.int64)),
                         batch.column("vec_id"), batch.column("vector")],
                        names=["part", "code", "vec_id", "vector"],
                    )

        def probed(batches: Batches) -> Batches:
            own, wanted = model.value
            for whole in batches:
                for start in range(0, len(whole), 64):
                    batch = whole.slice(start, 64)
                    places = own.places(_matrix(batch.column("vector")), None)
                    codes = []
                    for table in range(own.tables):
                        slots, moves = own.moves(places[table], wanted)
                        codes += [own.codes(table, slots[:, None] + moves, band) for band in own.bands]
                    codes = np.concatenate(codes, 1)
                    part = (codes % np.uint64(parts)).astype(np.int64)
                    at = np.argsort(part, axis=1, kind="stable")
                    codes, part = np.take_along_axis(codes, at, 1), np.take_along_axis(part, at, 1)
                    rows, keys, lists = [], [], []
                    for row in range(len(batch)):
                        starts = np.flatnonzero(np.r_[True, part[row, 1:] != part[row, :-1]])
                        for first, past in zip(starts, [*starts[1:], part.shape[1]], strict=True):
                            rows.append(row)
                            keys.append(int(part[row, first]))
                            lists.append(np.unique(codes[row, first:past]).tobytes())
                    taken = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), taken.column("vec_id"), taken.column("vector"),
                         pa.array(lists, pa.binary())],
                        names=["part", "query_id", "query", "codes"],
                    )

        def compared(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            """A part's candidates of every query, the nearest ``count``."""
            found = []
            if len(left) and len(right):
                codes = left.column("code").to_numpy().view(np.uint64)
                at = np.argsort(codes, kind="stable")
                codes, vec_ids = codes[at], left.column("vec_id").to_numpy()[at]
                vectors = _matrix(left.column("vector").combine_chunks())[at]
                matrix = _matrix(right.column("query").combine_chunks())
                for query_id, query, own in zip(
                    right.column("query_id").to_pylist(), matrix, right.column("codes").to_pylist(), strict=True
                ):
                    own = np.frombuffer(own, np.uint64)
                    low, high = np.searchsorted(codes, own), np.searchsorted(codes, own, side="right")
                    lengths = high - low
                    rows = np.repeat(low - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
                    _, once = np.unique(vec_ids[rows], return_index=True)
                    rows = rows[once]
                    found.append(_nearest(query_id, query, vec_ids, vectors, rows[vec_ids[rows] != query_id], count))
            return _found(found)

        def fields(*names: tuple) -> T.StructType:
            return T.StructType([T.StructField(*name) for name in names])

        find_on_workers(self.spark)
        index = map_batches(
            self.index, indexed, fields(("part", long), ("code", long), ("vec_id", long), ("vector", kind))
        )
        index = self.scratch.table(index, "buckets")
        probes = map_batches(
            self.queries, probed,
            fields(("part", long), ("query_id", long), ("query", kind), ("codes", T.BinaryType())),
        )
        # A part above its size is cut by hashes of the ids, on both sides; each cut of one side meets each of the other.
        probes = self.scratch.table(probes, "probes")
        cuts = index.groupBy("part").agg(F.ceil(F.count("*") / (2 * PART_ROWS)).alias("cuts"))
        probe_cuts = probes.groupBy("part").agg(F.ceil(F.count("*") / PART_PROBES).alias("probe_cuts"))
        cuts = cuts.join(probe_cuts, "part")

        def every(number: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

        index = index.join(cuts, "part").withColumn("cut", F.pmod(F.xxhash64("vec_id"), F.col("cuts")))
        index = index.withColumn("probe_cut", every("probe_cuts")).drop("cuts", "probe_cuts")
        probes = probes.join(cuts, "part").withColumn("probe_cut", F.pmod(F.xxhash64("query_id"), F.col("probe_cuts")))
        probes = probes.withColumn("cut", every("cuts")).drop("cuts", "probe_cuts")
        by = ["part", "cut", "probe_cut"]
        found = index.groupBy(*by).cogroup(probes.groupBy(*by)).applyInArrow(compared, "query_id long, vec_id long, score double")
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= count).drop("rank")


def _nearest(
    query_id: int, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query id, ids and products of the ``count`` nearest of some rows; ties go to the smaller id."""
    # A rough choice with room for rounding, then products in one fixed order of terms.
    rough = vectors[rows] @ query
    if len(rows) > 2 * count:
        least = np.partition(rough, len(rough) - count)[len(rough) - count]
        rows = rows[rough >= least - 1e-9 * max(1.0, abs(least))]
    exact = (vectors[rows] * query).sum(1)
    best = np.lexsort((ids[rows], -exact))[:count]
    return np.full(len(best), query_id), ids[rows][best], exact[best]


def _found(parts: list[tuple]) -> pa.Table:
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    columns = [np.concatenate(column) for column in zip(none, *parts, strict=True)]
    return pa.table([pa.array(column) for column in columns], names=["query_id", "vec_id", "score"])


def nearest(
    df: DataFrame, every: int = 20, count: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the nearest vectors found.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those with the
    query's id. Nearness is the inner product in double precision, ties go to the smaller id.

    Every row is indexed. The number of hashes follows the number of rows; the number of probes is the
    smallest that reaches the exact neighbours, found in one pass, of a fixed sample of queries to the
    share 0.96. If no number of probes does, there are fewer hashes, and without any left all queries are
    compared with all vectors, block by block. So are queries whose probes meet fewer than ``count``
    vectors. Buckets are dealt to parts, and parts above their size are cut, so that a common bucket
    is no one task's work.

    Vectors that are null, empty, all zero, hold null or non-finite components, or whose length is not
    the most frequent one, take no part, nor do rows without an id. Repeated rows count once; of
    equal vectors only the ``count`` + 1 smallest ids are indexed, as no other can be among the nearest.
    Other columns are not read; an empty table gives an empty result.
    """
    return _Search(df, every, count, id_col, vector_col).run()
