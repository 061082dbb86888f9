"""Packing of documents into training sequences, balanced by attention cost.

A piece of ``n`` tokens costs ``linear * n + quadratic * n * n``. Pieces are taken by descending cost,
and each goes to the sequence of the lowest cost that still has room for it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, fields, kept, map_batches, slices, texts_of
from sluicegate.llm.token_counts import byte_symbols

# Bytes of encodings a process remembers, of pieces between spaces and of words in them.
PIECE_BYTES, WORD_BYTES = 192 << 20, 96 << 20
LONGEST_REMEMBERED = 40
# Characters encoded at once; a longer text is encoded alone.
ENCODED_CHARS = 1 << 19
MARKS = ".,;:!?*#$%&()-"
_ID = 4  # bytes of a token id
# How few ids become bytes, by their number.
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(16)]


class Remembered:
    """Encodings by text, within a number of bytes: those that were used lately.

    New ones go to a young table. When that holds half of the bytes it becomes the old table, whose
    entries come back when they are used again, and are forgotten with the next change.
    """

    ENTRY = 250  # bytes of an entry beside its texts

    def __init__(self, most_bytes: int):
        self.most = most_bytes // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def get(self, text: str) -> bytes | None:
        found = self.young.get(text)
        if found is None and text in self.old:
            found = self.old[text]
            self.put(text, found)
        return found

    def put(self, text: str, ids: bytes) -> None:
        self.young[text] = ids
        self.held += len(text) + len(ids) + self.ENTRY

    def forget(self) -> None:
        """Keep to the bound; between batches, so that a batch finds all of its own."""
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The vocabulary drops white space and never joins what stands on both sides of it, so a text's
    ids are those of its pieces between spaces or lines. Pieces repeat, and their ids are remembered.
    A piece that is a word of Latin letters, with or without marks after it, is encoded without the
    library's splitting and normalising, which such words do not need.
    """

    PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.symbols = str.maketrans(dict(enumerate(byte_symbols())))
        self.words = Remembered(WORD_BYTES)
        self.marks: dict[str, bytes] = {"": b""}
        self.pieces = Remembered(PIECE_BYTES)

    def encode(self, texts: list[str]) -> list[bytes]:
        joined = []
        for start, end in slices(texts, ENCODED_CHARS):
            joined += self._encode(texts[start:end])
            self.pieces.forget()
            self.words.forget()
        return joined

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        young, old, plain = self.pieces.young, self.pieces.old, self.words.young
        young[""] = b""
        # What is too long to be remembered is known for this batch only.
        long, other = [], []
        held, entry = 0, Remembered.ENTRY
        for piece in set().union(*split).difference(young):
            ids = old.get(piece)
            if ids is None:
                word = piece.lower().rstrip(MARKS)
                ids = plain.get(word)
                if ids is None and (ids := self._word(word)) is None:
                    other.append(piece)
                    continue
                if mark := piece[len(word) :]:
                    ids += self.marks[mark] if mark in self.marks else self._mark(mark)
            young[piece] = ids
            held += len(piece) + len(ids) + entry
            if len(piece) > LONGEST_REMEMBERED:
                long.append(piece)
        for start in range(0, len(other), 4096):
            part = other[start : start + 4096]
            encodings = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            for piece, encoding in zip(part, encodings, strict=True):
                young[piece] = ids = self._bytes(encoding.ids)
                held += len(piece) + len(ids) + entry
                if len(piece) > LONGEST_REMEMBERED:
                    long.append(piece)
        ids_of = young.__getitem__
        joined = [b"".join(map(ids_of, parts)) for parts in split]
        for piece in long:
            held -= len(piece) + len(young.pop(piece)) + entry
        self.pieces.held += held
        return joined

    def _word(self, word: str) -> bytes | None:
        """A plain word's ids; None for other pieces."""
        ids = self.words.get(word)
        if ids is None and self.PLAIN(word):
            ids = self._encoded(word)
            if len(word) <= LONGEST_REMEMBERED:
                self.words.put(word, ids)
        return ids

    def _mark(self, mark: str) -> bytes:
        ids = self._bytes(self.tokenizer.encode(mark, add_special_tokens=False).ids)
        if len(mark) <= 2:
            self.marks[mark] = ids
        return ids

    def _encoded(self, word: str) -> bytes:
        # Printable bytes of ASCII stand for themselves.
        symbols = word if word.isascii() else word.encode().decode("latin-1").translate(self.symbols)
        return self._bytes([token.id for token in self.model.tokenize(symbols)])

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        if len(ids) < len(_PACKED):
            return _PACKED[len(ids)](*ids)
        return struct.pack(f"<{len(ids)}I", *ids)


class Piece:
    """Part of a document: ids from ``start`` on, not yet in a sequence."""

    __slots__ = ("doc_id", "ids", "start", "doc_tokens")

    def __init__(self, doc_id, ids: bytes, start: int, doc_tokens: int):
        self.doc_id, self.ids, self.start, self.doc_tokens = doc_id, ids, start, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // _ID

    def cut(self, length: int) -> tuple[Piece, Piece]:
        at = length * _ID
        return (
            Piece(self.doc_id, self.ids[:at], self.start, self.doc_tokens),
            Piece(self.doc_id, self.ids[at:], self.start + length, self.doc_tokens),
        )


class Packer:
    """Packs a stream of documents, holding at most ``pool_tokens`` and one document at a time.

    Full sequences are cut off long documents at once. What remains, pieces shorter than a sequence,
    is gathered in a pool. A full pool is spread over as many sequences as it can fill. Pieces that
    fit nowhere whole are cut to fill the sequences; what is left over returns to the pool. So only
    the end of the stream leaves less than a sequence; it goes to sequences whose lengths are powers
    of two, which need no padding.
    """

    def __init__(self, context: int, pool_tokens: int, linear: float, quadratic: float, first_id: int):
        self.context, self.pool_tokens = context, pool_tokens
        self.linear, self.quadratic = linear, quadratic
        self.next_id = first_id
        self.pool: list[Piece] = []
        self.held = 0
        self.rows: list[tuple] = []

    def cost(self, length: int | np.ndarray):
        return self.linear * length + self.quadratic * length * length

    def add(self, doc_id, ids: bytes) -> None:
        total = len(ids) // _ID
        piece = Piece(doc_id, ids, 0, total)
        whole = total // self.context * self.context
        for start in range(0, whole, self.context):
            part = Piece(doc_id, ids[start * _ID : (start + self.context) * _ID], start, total)
            self._emit([part])
        if total > whole:
            self.pool.append(piece.cut(whole)[1] if whole else piece)
            self.held += total - whole
        if self.held >= self.pool_tokens:
            self._pack(self.held // self.context)

    def finish(self) -> None:
        if self.held >= self.context:
            self._pack(self.held // self.context)
        rest, size = self.pool, self.context
        while rest:
            size //= 2
            if self.held & size:
                filled, rest = self._fill([], size, rest)
                self._emit(filled)
        self.pool, self.held = [], 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def _pack(self, count: int) -> None:
        """Fill ``count`` sequences from the pool."""
        free = np.full(count, self.context)
        cost = np.zeros(count)
        sequences: list[list[Piece]] = [[] for _ in range(count)]
        left: list[Piece] = []
        for piece in sorted(self.pool, key=len, reverse=True):
            at = int(np.argmin(np.where(free >= len(piece), cost, np.inf)))
            if free[at] < len(piece):
                left.append(piece)
                continue
            sequences[at].append(piece)
            free[at] -= len(piece)
            cost[at] += self.cost(len(piece))
        for at in np.argsort(cost, kind="stable"):
            if free[at]:
                sequences[at], left = self._fill(sequences[at], int(free[at]), left)
            self._emit(sequences[at])
        self.pool, self.held = left, sum(map(len, left))

    @staticmethod
    def _fill(sequence: list[Piece], room: int, pieces: list[Piece]) -> tuple[list[Piece], list[Piece]]:
        """Give a sequence the last pieces of a list until its room is used up, cutting one of them."""
        while room:
            piece = pieces.pop()
            if len(piece) > room:
                piece, rest = piece.cut(room)
                pieces.append(rest)
            sequence.append(piece)
            room -= len(piece)
        return sequence, pieces

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append(
                (
                    piece.doc_id,
                    piece.start,
                    len(piece),
                    zlib.crc32(piece.ids),
                    piece.doc_tokens,
                    self.next_id,
                    offset,
                    piece.ids,
                )
            )
            offset += len(piece)
        self.next_id += 1


def pack(
    df: DataFrame,
    vocabulary: str | None = None,
    context: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    pool_tokens: int = 1 << 20,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack whole documents into sequences of ``context`` tokens (a power of two).

    One row per piece: ``doc_id``, ``start`` and ``length`` in its document, ``ids_crc32`` of its ids
    as little-endian unsigned 32-bit numbers, ``doc_tokens``, ``sequence_id``, ``offset`` in the
    sequence, and with ``with_ids`` the ids themselves (``ids``, binary).

    Each task packs its own rows from a pool of ``pool_tokens``; nothing is shuffled or collected,
    memory is bounded by the pool and the longest document, and a lost task is simply run again.
    All sequences of a task are full, except for at most log2(context) at its end, whose lengths are
    smaller powers of two. Sequence ids have the task's number in their upper half.

    A null text counts as empty: its only id is ``end_id``. Repeated rows are packed each on its own,
    null ids stay null, other columns are not read, and an empty table gives an empty result.
    """
    if context < 1 or context & (context - 1):
        raise ValueError(f"context must be a power of two, not {context}")
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    long = T.LongType()
    schema = T.StructType(
        [
            *fields(df, {"doc_id": id_col}),
            T.StructField("start", long),
            T.StructField("length", long),
            T.StructField("ids_crc32", long),
            T.StructField("doc_tokens", long),
            T.StructField("sequence_id", long),
            T.StructField("offset", long),
            *([T.StructField("ids", T.BinaryType())] if with_ids else []),
        ]
    )
    names = schema.names

    def packed(batches: Batches) -> Batches:
        encoder = kept(Encoder, shared.value)
        first = TaskContext.get().partitionId() << 32
        packer = Packer(context, pool_tokens, linear, quadratic, first)
        end = np.array([end_id], dtype="<u4").tobytes()
        id_type = None

        def rows() -> Iterator[pa.RecordBatch]:
            if taken := packer.take():
                columns = list(zip(*taken, strict=True))[: len(names)]
                kinds = [id_type, *[pa.int64()] * 6, pa.binary()][: len(names)]
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            id_type = batch.schema.field("id").type
            ids, texts = batch.column("id").to_pylist(), texts_of(batch, "text")
            for start in range(0, len(texts), 512):
                part = slice(start, start + 512)
                for doc_id, encoded in zip(ids[part], encoder.encode(texts[part]), strict=True):
                    packer.add(doc_id, encoded + end)
                yield from rows()
        packer.finish()
        yield from rows()

    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), packed, schema)
