"""Collocations from a weighted de Bruijn graph of words.

The longest counted phrases, of three words, are the edges of a graph: ``w1 w2 w3`` leads from the node
``w1 w2`` to the node ``w2 w3``, and its weight is the number of its occurrences. Shorter phrases are not
counted on their own:

* a node occurs as often as its edges leave it, plus as often as it ends a piece;
* a word occurs as often as the nodes that begin with it, plus as often as it ends a piece.

So every node and word has one further row that takes its ends of pieces.

A node whose one edge in, one edge out and own count all agree is unary: nothing starts, ends or branches
there. Paths through unary nodes are compacted to one row. All nodes inside a path have its weight, so
counts are looked up for the ends of paths only, and a node inside a path is never a result of its own.

Phrases that cannot reach the least count are kept out of the graph: a first pass counts hashes of edges,
nodes and words, and a bit filter of fixed size tells the second pass which may be frequent. Occurrences
of other edges and nodes still count for the nodes and words they begin with, in the row of the ends.
The filter lets rare phrases through by chance, never the other way round, so counts are
exact.

Words are numbers in the graph, hashes of language and word. Should two frequent words share a number,
the graph is built again with other hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.llm.common import Batches, Scratch, bit_filter, chosen_by, give_back, map_batches
from sluicegate.llm.words import byte_values, mix, span_hashes, text_slices, word_spans

# In place of a number: the end of a piece, or what is too rare to have an edge or a node of its own.
REST = 0
# Words that a task handles at once; a longer text is handled alone.
CHUNK_WORDS = 1 << 18
# Hashes, and edges, that a task adds up before it passes them on; edges wait for so many more until they are added.
HELD_CODES, HELD_EDGES = 1 << 21, 3 << 19
WAITING_EDGES = 1 << 19
# Hashes are counted by their first bits: a bucket and a place in it, of four bytes beyond so much text.
BUCKET_BITS = 20
WIDE_BYTES = 1 << 36
# Bits of the filter of phrases that may be frequent, 16 MiB in all.
FILTER_BITS = 27
# Bytes of text whose hashes one group of the first pass counts.
BLOCK_BYTES = 16 << 20
# Word numbers that a task remembers having named.
MOST_NAMED = 1 << 20
# Rows that leave a task at once.
OUT_ROWS = 1 << 17

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_WORD = np.uint64(0xD6E8FEB86659FD93)


class _Chunk(NamedTuple):
    """Numbers of neighbouring words, whether each is followed by the next within its piece, and texts."""

    ids: np.ndarray
    followed: np.ndarray
    langs: list[str]
    lang: np.ndarray
    spelled: list[tuple[bytes, np.ndarray, np.ndarray]]

    def words(self, at: np.ndarray) -> list[str]:
        """The words at some places, spelled."""
        firsts = np.cumsum([0, *[len(start) for _, start, _ in self.spelled]])
        found = []
        for part, place in zip((np.searchsorted(firsts, at, side="right") - 1).tolist(), at.tolist(), strict=True):
            data, start, end = self.spelled[part]
            place -= int(firsts[part])
            found.append(data[start[place] : end[place]].lower().decode())
        return found


def _chunks(batches: Batches, seed: int) -> Iterator[_Chunk]:
    """The words of whole texts, about ``CHUNK_WORDS`` at a time; no chunk ends inside a text."""
    values = byte_values(seed)
    parts, held = [], 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for begin, stop, data, bounds in text_slices(batch.column("text")):
            start, end, owner = word_spans(data, bounds, _GAP)
            if not len(start):
                continue
            breaks = np.zeros(len(data) + 1, np.int32)
            np.cumsum(_BREAK[data], out=breaks[1:])
            followed = np.zeros(len(start), bool)
            followed[:-1] = (owner[1:] == owner[:-1]) & (breaks[start[1:]] == breaks[end[:-1]])
            parts.append((span_hashes(data, start, end, values), followed, langs[begin:stop], owner, (data.tobytes(), start, end)))
            held += len(start)
            if held >= CHUNK_WORDS:
                yield _chunk(parts)
                parts, held = [], 0
    if parts:
        yield _chunk(parts)


def _chunk(parts: list[tuple]) -> _Chunk:
    names = sorted({lang for part in parts for lang in part[2]})
    number = {name: i for i, name in enumerate(names)}
    salts = [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest()) for name in names]
    lang = np.concatenate([np.array([number[name] for name in part[2]], np.int32)[part[3]] for part in parts])
    ids = mix(np.concatenate([part[0] for part in parts]) + np.array(salts, np.uint64)[lang])
    ids[ids == REST] = 1
    return _Chunk(ids, np.concatenate([part[1] for part in parts]), names, lang, [part[4] for part in parts])


def _node_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _FACTORS[0] + second * _FACTORS[1])


def _edge_codes(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mix(first * _FACTORS[0] + second * _FACTORS[1] + third * _FACTORS[2])


def _word_codes(ids: np.ndarray) -> np.ndarray:
    return mix(ids ^ _WORD)


def _steps(followed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that one more word, and two more words, follow in their piece."""
    at = np.flatnonzero(followed)
    return at, at[followed[at + 1]]


class _Counting(NamedTuple):
    """How hashes are counted: in blocks of buckets, with so many bits for the place in a bucket."""

    seed: int
    blocks: int
    place_bits: int

    @property
    def buckets(self) -> int:
        """Buckets of a block."""
        return (1 << BUCKET_BITS) // self.blocks

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the filter, from hashes cut to what is counted."""
        return (codes >> np.uint64(BUCKET_BITS + self.place_bits - FILTER_BITS)).astype(np.int64)

    def cut(self, codes: np.ndarray) -> np.ndarray:
        return codes >> np.uint64(64 - BUCKET_BITS - self.place_bits)


def _counted(how: _Counting):
    """By block: the number of hashes in each of its buckets, their places there, and their counts."""
    kind = np.uint16 if how.place_bits == 16 else np.uint32

    def blobs(held: list[tuple]) -> pa.RecordBatch:
        codes, counts = _added(*map(np.concatenate, zip(*held, strict=True)))
        sizes = np.bincount((codes >> np.uint64(how.place_bits)).astype(np.int64), minlength=1 << BUCKET_BITS)
        ends = np.r_[0, np.cumsum(sizes)][:: how.buckets].tolist()
        sizes, places, counts = sizes.astype(np.uint16), codes.astype(kind), counts.astype(np.uint32)
        rows = [
            (block, sizes[block * how.buckets : (block + 1) * how.buckets], places[start:end], counts[start:end])
            for block, (start, end) in enumerate(zip(ends[:-1], ends[1:], strict=True))
            if end > start
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0] for row in rows], pa.int32())]
            + [pa.array([row[i].tobytes() for row in rows], pa.binary()) for i in (1, 2, 3)],
            names=["block", "sizes", "places", "counts"],
        )

    def run(batches: Batches) -> Batches:
        held, size = [], 0
        for chunk in _chunks(batches, how.seed):
            ids = chunk.ids
            one, two = _steps(chunk.followed)
            codes = [_edge_codes(ids[two], ids[two + 1], ids[two + 2]), _node_codes(ids[one], ids[one + 1]), _word_codes(ids)]
            codes = how.cut(np.concatenate(codes))
            held.append(_added(codes, np.ones(len(codes), np.uint32)))
            size += len(held[-1][0])
            if size >= HELD_CODES:
                yield blobs(held)
                held, size = [], 0
                give_back()
        if held:
            yield blobs(held)
            give_back()

    return run


def _added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal hashes once, sorted, with the sum of their counts."""
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[starts], np.add.reduceat(counts, starts)


def _frequent(how: _Counting, least: int):
    """Bits of the filter of a block's hashes that occur ``least`` times or more, together with their like."""
    kind = np.uint16 if how.place_bits == 16 else np.uint32
    numbers = np.arange(how.buckets, dtype=np.uint64) << np.uint64(how.place_bits)

    def run(key: tuple, part: pa.Table) -> pa.Table:
        codes, counts = [], []
        for row in part.select(["sizes", "places", "counts"]).to_pylist():
            bucket = np.repeat(numbers, np.frombuffer(row["sizes"], np.uint16))
            codes.append(bucket | np.frombuffer(row["places"], kind).astype(np.uint64))
            counts.append(np.frombuffer(row["counts"], np.uint32))
        added, sums = _added(np.concatenate(codes), np.concatenate(counts).astype(np.int64))
        first = np.uint64(key[0].as_py() * how.buckets << how.place_bits)
        return pa.table({"place": pa.array(np.unique(how.places(added[sums >= least] + first)), pa.int64())})

    return run


def _edges(how: _Counting, shared):
    """Weighted edges, the names of words that may be frequent, and words by language."""

    def run(batches: Batches) -> Batches:
        def frequent(codes: np.ndarray) -> np.ndarray:
            return chosen_by(shared.value, how.places(how.cut(codes)))

        named, sums, waiting, size = np.zeros(0, np.uint64), None, [], 0
        for chunk in _chunks(batches, how.seed):
            ids = chunk.ids
            known = frequent(_word_codes(ids))
            one, two = _steps(chunk.followed)
            second, third = np.full((2, len(ids)), REST, np.uint64)
            node = one[frequent(_node_codes(ids[one], ids[one + 1]))]
            second[node] = ids[node + 1]
            edge = two[frequent(_edge_codes(ids[two], ids[two + 1], ids[two + 2]))]
            third[edge] = np.where(second[edge] == REST, np.uint64(REST), ids[edge + 2])
            waiting.append(_summed(ids[known], second[known], third[known], np.ones(known.sum(), np.int64)))
            size += len(waiting[-1][0])
            if size >= WAITING_EDGES:
                sums, waiting, size = _joined(sums, waiting), [], 0
                if len(sums[0]) >= HELD_EDGES:
                    yield from _edge_rows(sums)
                    sums = None
                give_back()
            numbers, first = np.unique(ids[known], return_index=True)
            fresh = ~np.isin(numbers, named, assume_unique=True)
            numbers, first = numbers[fresh], np.flatnonzero(known)[first[fresh]]
            named = np.union1d(named, numbers) if len(named) < MOST_NAMED else numbers
            yield _rows(numbers, langs=[chunk.langs[i] for i in chunk.lang[first]], words=chunk.words(first))
            totals = np.bincount(chunk.lang, minlength=len(chunk.langs))
            yield _rows(weight=totals, langs=chunk.langs)
        yield from _edge_rows(_joined(sums, waiting))
        give_back()

    return run


def _joined(sums: tuple | None, waiting: list[tuple]) -> tuple:
    parts = waiting if sums is None else [sums, *waiting]
    return _summed(*map(np.concatenate, zip(*parts, strict=True))) if parts else (np.zeros(0, np.uint64),) * 4


def _edge_rows(sums: tuple) -> Iterator[pa.RecordBatch]:
    a, b, c, weight = sums
    for start in range(0, len(a), OUT_ROWS):
        part = slice(start, start + OUT_ROWS)
        yield _rows(a[part], b[part], c[part], weight[part])


def _summed(a: np.ndarray, b: np.ndarray, c: np.ndarray, weight: np.ndarray):
    """Equal triples once, with the sum of their weights."""
    order = np.argsort(_edge_codes(a, b, c))
    a, b, c, weight = a[order], b[order], c[order], weight[order]
    if not len(a):
        return a, b, c, weight
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    return a[starts], b[starts], c[starts], np.add.reduceat(weight, starts)


_ROWS = "a long, b long, c long, weight long, lang string, word string"


def _rows(a=None, b=None, c=None, weight=None, langs=None, words=None) -> pa.RecordBatch:
    size = next(len(column) for column in (a, weight) if column is not None)
    longs = [pa.nulls(size, pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in (a, b, c, weight)]
    texts = [pa.nulls(size, pa.string()) if x is None else pa.array(x, pa.string()) for x in (langs, words)]
    return pa.RecordBatch.from_arrays(longs + texts, names=["a", "b", "c", "weight", "lang", "word"])


class Graph:
    """Words, nodes and edges of at least ``least`` occurrences, with compacted paths."""

    def __init__(self, df: DataFrame, least: int, text_col: str, lang_col: str):
        self.spark = df.sparkSession
        self.least = least
        lang = F.coalesce(df[lang_col].cast("string"), F.lit("und"))
        self.texts = df.select(df[text_col].alias("text"), lang.alias("lang"))
        self.scratch = Scratch(self.spark)
        size = self.texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        wanted = max(2 * int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
        how = _Counting(1, 1 << min(BUCKET_BITS, (wanted - 1).bit_length()), 16 if size < WIDE_BYTES else 32)
        while not self._build(how):
            how = how._replace(seed=how.seed + 1)

    def _build(self, how: _Counting) -> bool:
        """Whether every frequent word got a number of its own."""
        seed = how.seed
        shared = self.spark.sparkContext.broadcast(self._filter(how))
        rows = map_batches(self.texts, _edges(how, shared), _ROWS)
        summed = rows.groupBy("a", "b", "c", "lang", "word").agg(F.sum("weight").alias("weight"))
        graph = self.scratch.table(summed, f"graph_{seed}")
        shared.unpersist()
        self.totals = graph.where("a IS NULL").select("lang", F.col("weight").alias("n"))
        names = graph.where("word IS NOT NULL").select("a", "lang", "word")
        flows = graph.where("a IS NOT NULL AND word IS NULL").select("a", "b", "c", "weight")
        # Node flow: what leaves a node and what ends there; a word's nodes and what ends with it.
        nodes = flows.where(f"b <> {REST}").groupBy("a", "b").agg(F.sum("weight").alias("f"))
        words = flows.groupBy("a").agg(F.sum("weight").alias("f"))
        frequent = words.where(F.col("f") >= self.least).join(names, "a")
        self.words = self.scratch.table(frequent.withColumnRenamed("a", "id"), f"words_{seed}")
        if not self.words.groupBy("id").count().where("count > 1").isEmpty():
            self.scratch.drop(*list(self.scratch.names))
            return False
        self.nodes = self.scratch.table(nodes.where(F.col("f") >= self.least), "nodes")
        self.edges = self.scratch.table(flows.where(f"c <> {REST}").where(F.col("weight") >= self.least), "edges")
        return True

    def _filter(self, how: _Counting) -> bytes:
        counted = map_batches(self.texts, _counted(how), "block int, sizes binary, places binary, counts binary")
        places = counted.groupBy("block").applyInArrow(_frequent(how, self.least), "place long")
        return bit_filter(places, 1 << FILTER_BITS)

    def unary(self) -> DataFrame:
        """Unary nodes ``x y`` with their one edge ``x y z``: the edge in, the edge out and the node count the same."""
        node = self.nodes.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("f").alias("weight"))
        into = self.edges.select(F.col("b").alias("x"), F.col("c").alias("y"), "weight")
        out = self.edges.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("c").alias("z"), "weight")
        both = node.join(into, ["x", "y", "weight"]).join(out, ["x", "y", "weight"])
        return self.scratch.table(both.select("x", "y", "z"), "unary")

    def paths(self) -> DataFrame:
        """``words`` (numbers) and ``weight`` of every path, compacted.

        Each unary node learns the last unary node of its path by doubling its steps, in as many rounds as
        the longest path has binary digits. A path lies within one piece, which bounds its words.
        """
        unary = self.unary()
        here = unary.select(F.col("x").alias("tx"), F.col("y").alias("ty"))
        linked = unary.join(here, (F.col("y") == F.col("tx")) & (F.col("z") == F.col("ty")), "left")
        step = F.col("tx").isNotNull()
        jump = linked.select(
            "x", "y", F.coalesce("tx", "x").alias("tx"), F.coalesce("ty", "y").alias("ty"), step.cast("long").alias("steps")
        )
        jump, number = self.scratch.table(jump, "jump_0"), 0
        while True:
            number += 1
            onward = jump.where("steps > 0").select(
                F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("tx").alias("ux"), F.col("ty").alias("uy"), F.col("steps").alias("more")
            )
            further = jump.join(onward, ["tx", "ty"], "left").select(
                "x", "y", F.coalesce("ux", "tx").alias("tx"), F.coalesce("uy", "ty").alias("ty"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("more").isNotNull().alias("moved"),
            )
            following = self.scratch.table(further, f"jump_{number}")
            moved = not following.where("moved").isEmpty()
            self.scratch.drop(f"jump_{number - 1}")
            jump = following.drop("moved")
            if not moved:
                break
        # A path is known by its last edge, the one that leaves its last unary node.
        ends = jump.join(unary.select(F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("z").alias("tz")), ["tx", "ty"])
        ends = ends.select(F.col("x").alias("b"), F.col("y").alias("c"), "tx", "ty", "tz", (F.col("steps") + 1).alias("before"))
        placed = self.edges.join(ends, ["b", "c"], "left").select(
            F.coalesce("tx", "a").alias("x"), F.coalesce("ty", "b").alias("y"), F.coalesce("tz", "c").alias("z"),
            F.coalesce("before", F.lit(0)).alias("before"), "a", "weight",
        )
        grouped = placed.groupBy("x", "y", "z", "weight").agg(
            F.sort_array(F.collect_list(F.struct("before", "a")), asc=False).alias("steps")
        )
        words = F.concat(F.transform("steps", lambda s: s["a"]), F.array("y", "z"))
        return self.scratch.table(grouped.select(words.alias("words"), "weight"), "paths")


def phrase_paths(
    df: DataFrame, min_count: int = 10, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Compacted paths: ``lang``, ``phrase`` of three or more words, its ``count``, and ``n_words``.

    A path is a run of words that always occurs as a whole wherever any three of its words in a row do,
    such as a licence line or a passage of many copies. See :func:`collocations` for what a piece, a word and
    a language is and what odd rows give.
    """
    graph = Graph(df, min_count, text_col, lang_col)
    paths = graph.paths().withColumn("path", F.monotonically_increasing_id())
    paths = graph.scratch.table(paths, "numbered")
    spelled = paths.select("path", "weight", F.posexplode("words").alias("at", "id")).join(graph.words, "id")
    return spelled.groupBy("path", "lang", F.col("weight").alias("count")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase"),
        F.count("*").alias("n_words"),
    ).drop("path")


def collocations(
    df: DataFrame,
    min_count: int = 10,
    inside_percent: int = 50,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The phrases of two or three words whose parts occur together most exclusively, by language.

    Texts (A-Z in lower case) are cut at ``. , ; : ! ?`` and line breaks into pieces, and those at spaces and
    tabs into words; phrases do not cross pieces. A phrase with ``a`` occurrences, ``min_count`` or more, is
    cut into a first part with ``l`` and a rest with ``r`` occurrences; its ``score`` is
    floor(1000000 * a * a / (l * r)) of the cut that scores lowest, the earlier one at a tie. A phrase within a
    longer one is left out if the longer one makes up ``inside_percent`` or more of it. Of each language the
    ``top`` phrases by score, ``a`` (both descending) and phrase are returned: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n`` (all words of the language) and ``score``.

    A null text is empty and a null language is ``und``. Repeated rows count each. Other columns are not
    read, and an empty table gives an empty result. Numbers are exact: products are decimals of 38 digits.
    """
    graph = Graph(df, min_count, text_col, lang_col)
    paths = graph.paths()
    chosen = _triples(graph, paths).unionByName(_pairs(graph, paths, inside_percent))
    found = _scored(graph, chosen).join(graph.totals, "lang")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    columns = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    result = graph.scratch.table(ranked.select(*columns), "result")
    graph.scratch.drop(*[name for name in graph.scratch.names if name != "result"])
    return result


def _triples(graph: Graph, paths: DataFrame) -> DataFrame:
    """Phrases of three words as ``w1``, ``w2``, ``w3``, ``a``, with the counts of their nodes.

    Nodes inside a path have its weight; only those at its ends are looked up.
    """
    first, last = (
        graph.nodes.select(F.col("a").alias(f"{side}1"), F.col("b").alias(f"{side}2"), F.col("f").alias(f"{side}_count"))
        for side in ("first", "last")
    )
    ended = paths.select(
        "words", "weight",
        F.col("words")[0].alias("first1"), F.col("words")[1].alias("first2"),
        F.element_at("words", -2).alias("last1"), F.element_at("words", -1).alias("last2"),
    ).join(first, ["first1", "first2"]).join(last, ["last1", "last2"])
    at = F.explode(F.sequence(F.lit(0), F.size("words") - 3)).alias("at")
    spread = ended.select("words", "weight", "first_count", "last_count", at)
    return spread.select(
        *[F.expr(f"words[at + {i}]").alias(f"w{i + 1}") for i in range(3)],
        F.col("weight").alias("a"),
        F.when(F.col("at") == 0, F.col("first_count")).otherwise(F.col("weight")).alias("left"),
        F.when(F.col("at") == F.size("words") - 3, F.col("last_count")).otherwise(F.col("weight")).alias("right"),
    )


def _pairs(graph: Graph, paths: DataFrame, inside_percent: int) -> DataFrame:
    """Phrases of two words that no longer phrase makes up for the greater part."""
    ends = paths.select(F.col("words")[0].alias("a"), F.col("words")[1].alias("b"), "weight").unionByName(
        paths.select(F.element_at("words", -2).alias("a"), F.element_at("words", -1).alias("b"), "weight")
    )
    longer = ends.groupBy("a", "b").agg(F.max("weight").alias("longer"))
    free = graph.nodes.join(longer, ["a", "b"], "left")
    if inside_percent <= 100:
        inside = graph.scratch.table(paths.where("size(words) > 3").select(
            F.explode(F.expr("transform(sequence(1, size(words) - 3), i -> struct(words[i] AS a, words[i + 1] AS b))")).alias("node")
        ).select("node.*"), "inside")
        free = free.join(inside, ["a", "b"], "left_anti")
    free = free.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * inside_percent))
    none = F.lit(None).cast("long")
    return free.select(
        F.col("a").alias("w1"), F.col("b").alias("w2"), none.alias("w3"), F.col("f").alias("a"), none.alias("left"), none.alias("right")
    )


def _scored(graph: Graph, phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r`` and ``score`` of the lowest cut."""
    for i in (1, 2, 3):
        named = graph.words.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}"), F.col("lang").alias(f"lang{i}"))
        phrases = phrases.join(named, f"w{i}", "left" if i == 3 else "inner")
    whole = F.col("w3").isNotNull()

    def cut(k: int, l: Column, r: Column) -> Column:
        return F.struct(_score("a", l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    early = cut(1, F.col("f1"), F.when(whole, F.col("right")).otherwise(F.col("f2")))
    late = F.when(whole, cut(2, F.col("left"), F.col("f3")))
    lowest = F.least(early, F.coalesce(late, early))
    return phrases.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", lowest.alias("cut")
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _score(a: str, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)); neither part is rarer than the whole, so it is at most a million."""
    wide = "decimal(16,0)"
    square = F.col(a).cast(wide) * F.col(a).cast(wide)
    return F.call_function("div", square * F.lit(1_000_000), l.cast(wide) * r.cast(wide))


COLLOCATION_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, w[i] AS phrase, 1 AS k FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words)
    UNION ALL
    SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM words)
    UNION ALL
    SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3
    FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
f AS (SELECT lang, phrase, k, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT lang, phrase, a, k, cut, array_to_string(w[1:cut], ' ') AS p, array_to_string(w[cut + 1:k], ' ') AS q
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.k, a, lf.f AS l, rf.f AS r, cut, (1000000 * a * a) // (lf.f * rf.f) AS score
    FROM cuts JOIN f lf ON lf.lang = cuts.lang AND lf.phrase = p JOIN f rf ON rf.lang = cuts.lang AND rf.phrase = q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY ALL),
ranked AS (
    SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank,
           best.phrase, a, l, r, score
    FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.phrase = best.phrase AND best.k = 2
    WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
