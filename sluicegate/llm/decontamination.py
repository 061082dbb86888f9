"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared runs of tokens, the seeds. For each pair that shares
one, the longest common runs are marked again and again, none overlapping another, found with rolling
Karp-Rabin hashes. The share of the item's tokens that such tiles cover decides; tiles may lie in any
order, so reordered passages count as well.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, fields, keep_rows, map_batches, parts
from sluicegate.llm.words import gram_hashes, text_slices, word_hashes

# Bytes of benchmark text sent to the tasks at once; a larger benchmark is compared block by block.
BLOCK_BYTES = 32 << 20
_PRIME, _FACTOR = (1 << 61) - 1, 0x5851F42D4C957F2D % ((1 << 61) - 1)


def _rolled(tokens: list[int], marked: list[bool], length: int) -> dict[int, list[int]]:
    """Starts of all unmarked runs of a length, by Karp-Rabin hash."""
    starts: dict[int, list[int]] = {}
    top = pow(_FACTOR, length, _PRIME)
    value = held = 0
    for i, token in enumerate(tokens):
        if marked[i]:
            value = held = 0
            continue
        value, held = (value * _FACTOR + token) % _PRIME, held + 1
        if held > length:
            value = (value - tokens[i - length] * top) % _PRIME
        if held >= length:
            starts.setdefault(value, []).append(i + 1 - length)
    return starts


def tiles(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs of at least ``least`` tokens: (length, start in item, in text).

    Longest first: in each round all maximal matches of at least the search length are marked by
    descending length; a match that overlaps a mark is cut to what is free if that is long enough.
    """
    found: list[tuple[int, int, int]] = []
    item_marked, text_marked = [False] * len(item), [False] * len(text)
    length = max(least, min(len(item), len(text)) // 2)
    while True:
        matches, longest = [], 0
        in_text = _rolled(text, text_marked, length)
        for value, starts in _rolled(item, item_marked, length).items():
            for i in starts:
                for j in in_text.get(value, ()):
                    if item[i : i + length] != text[j : j + length]:
                        continue
                    if i and j and not item_marked[i - 1] and not text_marked[j - 1] and item[i - 1] == text[j - 1]:
                        continue  # part of a match that starts earlier
                    k = length
                    while (
                        i + k < len(item)
                        and j + k < len(text)
                        and item[i + k] == text[j + k]
                        and not item_marked[i + k]
                        and not text_marked[j + k]
                    ):
                        k += 1
                    matches.append((-k, i, j))
                    longest = max(longest, k)
        if longest > 2 * length:
            length = longest
            continue
        matches.sort()
        while matches:
            size, i, j = matches.pop(0)
            free = [not item_marked[i + k] and not text_marked[j + k] for k in range(-size)]
            if all(free):
                found.append((-size, i, j))
                item_marked[i : i - size] = [True] * -size
                text_marked[j : j - size] = [True] * -size
                continue
            start = next((k for k, f in enumerate(free) if f), len(free))
            end = next((k for k in range(start, len(free)) if not free[k]), len(free))
            for first, past in ((start, end), (end, len(free))):
                if past - first >= length and past - first < -size:
                    matches.append((first - past, i + first, j + first))
            matches.sort()
        if length <= least:
            return found
        length = max(least, length // 2)


class Index:
    """Tokens and seeds of a block of benchmark items."""

    def __init__(self, items: pa.Table, least: int):
        self.ids = items.column("item_id").to_pylist()
        self.tokens: list[np.ndarray] = []
        for start, stop, data, bounds in text_slices(_folded(items.column("text"))):
            words, owner = word_hashes(data, bounds, marks=True)
            self.tokens += [words[owner == i] for i in range(stop - start)]
        # Items shorter than a seed are one seed of their own length.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({min(least, len(t)) for t in self.tokens if len(t)}):
            own = [i for i, t in enumerate(self.tokens) if min(least, len(t)) == size]
            words = np.concatenate([self.tokens[i] for i in own])
            owner = np.repeat(own, [len(self.tokens[i]) for i in own])
            grams, owner = gram_hashes(words, owner, size)
            order = np.argsort(grams, kind="stable")
            self.seeds[size] = grams[order], owner[order]

    def pairs(self, words: np.ndarray, owner: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """For every text and item that share a seed, the tokens of the text that belong to seeds."""
        places: dict[tuple[int, int], list] = {}
        for size, (grams, items) in self.seeds.items():
            if len(words) < size:
                continue
            at = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
            hashes = gram_hashes(words, owner, size)[0][: len(at)]
            low = np.searchsorted(grams, hashes)
            hit = np.flatnonzero(grams[np.minimum(low, len(grams) - 1)] == hashes)
            high = np.searchsorted(grams, hashes[hit], side="right")
            for place, first, past in zip(at[hit].tolist(), low[hit].tolist(), high.tolist(), strict=True):
                for item in set(items[first:past].tolist()):
                    places.setdefault((int(owner[place]), item), []).append((place, size))
        return {
            pair: np.unique(np.concatenate([np.arange(p, p + size) for p, size in found]))
            for pair, found in places.items()
        }


def _folded(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def _compare(index: Index, least: int, words: np.ndarray, owner: np.ndarray):
    """Tilings of a slice's texts with the items they share seeds with."""
    for (text, item), places in sorted(index.pairs(words, owner).items(), key=lambda x: x[0]):
        # Stretches between seeds become one token that occurs nowhere else.
        tokens: list[int] = []
        for k, place in enumerate(places.tolist()):
            if k and place != places[k - 1] + 1:
                tokens.append(-1 - k)
            tokens.append(int(words[place]))
        own = [int(t) for t in index.tokens[item]]
        found = tiles(own, tokens, min(least, len(own)))
        if found:
            yield text, item, len(found), found[0][0], sum(t[0] for t in found), len(own)


def _matches(index: Index, column: pa.Array, coverage: float, least: int):
    """Texts and items covered far enough: row, item, tiles, longest tile, covered tokens, all tokens."""
    for start, _, data, bounds in text_slices(_folded(column)):
        for text, item, n, longest, covered, total in _compare(index, least, *word_hashes(data, bounds, marks=True)):
            if covered >= coverage * total:
                yield start + text, item, n, longest, covered, total


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str):
    """The benchmark in broadcasts of bounded size."""
    items = benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].alias("text"))
    items = items.where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / (BLOCK_BYTES // 2)))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        yield benchmark.sparkSession.sparkContext.broadcast(part)


def clean_rows(
    df: DataFrame,
    benchmark: DataFrame,
    coverage: float = 0.5,
    least: int = 5,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Whole rows that hold no benchmark item; cases as in ``find_contamination``."""
    for shared in _blocks(benchmark, item_col, item_text_col):

        def judge(shared=shared):
            index = Index(shared.value, least)

            def keep(texts: list[str]) -> list[bool]:
                found = {row for row, *_ in _matches(index, pa.array(texts, pa.string()), coverage, least)}
                return [row not in found for row in range(len(texts))]

            return keep

        df = keep_rows(df, text_col, judge)
    return df


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    coverage: float = 0.5,
    least: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row for every document and benchmark item of which it holds at least the share ``coverage``.

    ``doc_id``, ``item_id``, ``coverage``, ``covered`` and ``item_tokens``, ``n_tiles``, ``longest``.
    Tokens are runs of characters other than ASCII white space and ASCII marks, in lower case, over
    whole texts. Tiles have at least ``least`` tokens; an item with fewer counts as one tile.

    The benchmark is sent to the tasks in blocks of at most 32 MiB of text; its number of blocks, not
    a limit, follows its size. Documents are not shuffled, and a lost task is run again.

    Null or empty texts and items without a token match nothing. Repeated documents or items give a
    row each, null ids stay null, other columns are not read; empty tables give an empty result.
    """
    blocks = list(_blocks(benchmark, item_col, item_text_col))
    schema = T.StructType(
        [
            *fields(df, {"doc_id": id_col}),
            *fields(benchmark, {"item_id": item_col}),
            T.StructField("coverage", T.DoubleType()),
            *[T.StructField(n, T.LongType()) for n in ("covered", "item_tokens", "n_tiles", "longest")],
        ]
    )
    documents = df.select(df[id_col].alias("id"), df[text_col].alias("text")).where("text IS NOT NULL")
    result = None
    for shared in blocks:

        def found(batches: Batches, shared=shared) -> Batches:
            index = Index(shared.value, least)
            for batch in parts(batches):
                rows, places = [], []
                for place, item, n, longest, covered, total in _matches(index, batch.column("text"), coverage, least):
                    places.append(place)
                    rows.append((index.ids[item], covered / total, covered, total, n, longest))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    kinds = [shared.value.schema.field("item_id").type, pa.float64(), *[pa.int64()] * 4]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(places))]
                        + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=schema.names,
                    )

        one = map_batches(documents, found, schema)
        result = one if result is None else result.unionByName(one)
    return result
