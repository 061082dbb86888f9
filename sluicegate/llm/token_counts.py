"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a word form a linked list; a heap holds the ranks of adjacent pairs. The pair of the
lowest rank, leftmost among equals, is popped and merged until no pair has a rank. The number of
tokens is the number of symbols minus the number of merges; no token identifiers are made.
"""

from __future__ import annotations

import heapq
import json

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, fields, kept, map_batches, parts, texts_of

# How byte-level vocabularies split texts before merging.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Counts a process remembers, of words and of pieces between spaces; both start anew when full.
REMEMBERED = 400_000
# Longer pieces are not remembered.
LONGEST_REMEMBERED = 40
_IRREGULAR = 1 << 48


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for characters from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Merger:
    """Counts the tokens of words under a table of ranked merges."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        self.symbols = [vocabulary[c] for c in byte_symbols()]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocabulary[left] << 24 | vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])

    def count(self, word: bytes) -> int:
        ranks, symbol = self.ranks, [self.symbols[b] for b in word]
        end = len(symbol)
        heap = [
            ranks[pair] << 32 | i
            for i in range(end - 1)
            if (pair := symbol[i] << 24 | symbol[i + 1]) in ranks
        ]
        heapq.heapify(heap)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        left = end
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j >= end or ranks.get(symbol[i] << 24 | symbol[j]) != rank:
                continue  # one of the two has been merged meanwhile
            symbol[i], symbol[j] = self.merged[rank], -1
            after[i] = k = after[j]
            left -= 1
            if k < end:
                before[k] = i
                if (new := ranks.get(symbol[i] << 24 | symbol[k])) is not None:
                    heapq.heappush(heap, new << 32 | i)
            if (h := before[i]) >= 0 and (new := ranks.get(symbol[h] << 24 | symbol[i])) is not None:
                heapq.heappush(heap, new << 32 | h)
        return left


class Counter:
    """Counts the tokens of texts as the vocabulary's own library does.

    A text is cut at single spaces. A space always opens a new word, so the counts of the pieces add
    up; pieces repeat, and their counts are remembered. Texts in which white space meets white space
    at a cut are split as a whole.
    """

    def __init__(self, vocabulary: str):
        parts = json.loads(vocabulary)
        self.merger = Merger(parts["model"])
        self.special = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.split = regex.compile(WORD_PATTERN).findall

    def count(self, text: str) -> int:
        return self._without(text, 0)

    def _without(self, text: str, depth: int) -> int:
        """Tokens of a text in which the special strings from ``depth`` on are one token each."""
        for number in range(depth, len(self.special)):
            parts = text.split(self.special[number])
            if len(parts) > 1:
                return len(parts) - 1 + sum(self._without(part, number + 1) for part in parts)
        first, *rest = text.split(" ")
        pieces = self.pieces
        try:
            total = sum([pieces[piece] for piece in rest])
        except KeyError:
            total = sum([pieces[piece] if piece in pieces else self._piece(piece) for piece in rest])
        if total >= _IRREGULAR or (rest and first[-1:].isspace()):
            return sum(map(self._word, self.split(text)))
        return total + sum(map(self._word, self.split(first)))

    def _piece(self, piece: str) -> int:
        """Tokens of a piece that follows a space."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            count = _IRREGULAR
        else:
            count = sum(map(self._word, self.split(" " + piece)))
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            self.pieces[piece] = count
        return count

    def _word(self, word: str) -> int:
        count = self.words.get(word)
        if count is None:
            count = self.merger.count(word.encode())
            if len(word) <= LONGEST_REMEMBERED:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[word] = count
        return count


def count_tokens(
    df: DataFrame,
    vocabulary: str | None = None,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Bytes and tokens of every whole text.

    ``vocabulary`` is the path of a byte-level vocabulary on the driver; the file has a fixed size
    and is sent to the tasks. No shuffle: a lost executor costs the tasks it was running.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each on its own, null
    ids stay null, other columns are not read, and an empty table gives an empty result. Special
    strings inside a text are one token each, as the library counts them.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType(
        [
            *fields(df, {"doc_id": id_col}),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    names = schema.names

    def counted(batches: Batches) -> Batches:
        counter = kept(Counter, shared.value)
        for batch in parts(batches):
            texts = texts_of(batch, "text")
            tokens = [counter.count(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=names,
            )

    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), counted, schema)
