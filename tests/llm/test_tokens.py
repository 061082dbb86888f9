"""Token counts and packing against the tokenizer library."""

from __future__ import annotations

import functools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluicegate.llm import packing
from sluicegate.llm.packing import Encoder, Remembered, pack
from sluicegate.llm.token_counts import Counter, count_tokens
from tests.llm.cases import awkward, document, frame, prose

PARTS = (
    "a B the 's ' é É <|endoftext|> <|startoftext|> 1 ² ½ Ⅷ 漢 👍 İ ß Σ _ - . , %%% ### 'LL don't ﬁ *** K ! ?. b é. Äther Été,"
).split() + [" ", " ", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "​", "\x00"]


@functools.cache
def vocabulary(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@functools.cache
def library(name: str) -> Tokenizer:
    return Tokenizer.from_str(vocabulary(name))


def ids(name: str, text: str | None) -> list[int]:
    return library(name).encode(text or "", add_special_tokens=False).ids


def odd_texts(count: int) -> list[str]:
    source = random.Random(1)
    return ["".join(source.choice(PARTS) for _ in range(source.randrange(14))) for _ in range(count)]


def test_counts_of_odd_texts():
    counter = Counter(vocabulary("byte_bpe_50k.json"))
    for text in odd_texts(4000):
        assert counter.count(text) == len(ids("byte_bpe_50k.json", text)), repr(text)


def test_ids_of_odd_texts():
    encoder = Encoder(vocabulary("word_bpe_49k.json"))
    texts = odd_texts(4000)
    for text, encoded in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(encoded, "<u4").tolist() == ids("word_bpe_49k.json", text), repr(text)


def test_long_words():
    counter = Counter(vocabulary("byte_bpe_50k.json"))
    for text in ("ab" * 5000, "a" * 20_001, "=" * 3000, "漢" * 700, " " * 900):
        assert counter.count(text) == len(ids("byte_bpe_50k.json", text))


def test_counted_rows(spark):
    rows = awkward()
    got = count_tokens(frame(spark, rows), limit=6).collect()
    expected = []
    for row in rows:
        n = len(ids("byte_bpe_50k.json", row[1]))
        expected.append((row[0], len((row[1] or "").encode()), n, n > 6))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert count_tokens(frame(spark, [])).count() == 0


def check_packed(rows, pieces, context: int) -> dict[int, int]:
    """Every id once, sequences gapless and no longer than the context; their lengths."""
    sequences = defaultdict(list)
    for piece in pieces:
        sequences[piece.sequence_id].append(piece)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in own])
        assert [p.offset for p in own] == [0, *ends[:-1].tolist()]
        assert ends[-1] <= context
    full = defaultdict(int)
    for row in rows:
        full[row[0], np.array([*ids("word_bpe_49k.json", row[1]), 1], "<u4").tobytes()] += 1
    by_document = defaultdict(list)
    for piece in pieces:
        by_document[piece.doc_id, piece.doc_tokens].append(piece)
    assert sum(p.length for p in pieces) == sum(len(encoded) // 4 * times for (_, encoded), times in full.items())
    texts = [doc_id for doc_id, _ in full]
    for (doc_id, encoded), times in full.items():
        if texts.count(doc_id) > 1:
            continue  # pieces do not tell which of the texts of an id they come from
        crc = {zlib.crc32(encoded[4 * a : 4 * b]): (a, b) for a, b in
               {(p.start, p.start + p.length) for p in by_document[doc_id, len(encoded) // 4]}}
        own = [p for p in by_document[doc_id, len(encoded) // 4] if p.ids_crc32 in crc]
        assert sum(p.length for p in own) == times * len(encoded) // 4
        covered = np.zeros(len(encoded) // 4, int)
        for p in own:
            assert crc[p.ids_crc32][1] - crc[p.ids_crc32][0] == p.length
            covered[p.start : p.start + p.length] += 1
        assert (covered == times).all()
    return {s: sum(p.length for p in own) for s, own in sequences.items()}


@pytest.mark.parametrize("context", [8, 256, 2048])
def test_packing_leaves_no_padding(spark, context):
    rows = awkward() + [document(100 + i, " ".join(prose(i, i % 90))) for i in range(120)]
    pieces = pack(frame(spark, rows).repartition(3), context=context, pool_tokens=4 * context).collect()
    lengths = check_packed(rows, pieces, context)
    # What is shorter than the context has a power of two as its length, each once in a task.
    short = [(s >> 32, n) for s, n in lengths.items() if n < context]
    assert all(n & (n - 1) == 0 for _, n in short)
    assert len(short) == len(set(short))


def test_costs_are_balanced(spark):
    """Sequences of short documents get like numbers of them."""
    rows = [document(i, " ".join(prose(i, 6 + i % 5))) for i in range(600)]
    pieces = pack(frame(spark, rows).coalesce(1), context=256).collect()
    costs = defaultdict(float)
    for p in pieces:
        costs[p.sequence_id] += p.length + p.length**2 / 2048
    full = [costs[s] for s, n in check_packed(rows, pieces, 256).items() if n == 256]
    assert max(full) < 1.1 * min(full)


def test_packed_ids(spark):
    row = document(1, "two words")
    assert pack(frame(spark, []), context=4).count() == 0
    (piece,) = pack(frame(spark, [row]), context=4, with_ids=True).where("start = 0").collect()
    expected = [*ids("word_bpe_49k.json", "two words"), 1][: piece.length]
    assert np.frombuffer(piece.ids, "<u4").tolist() == expected
    with pytest.raises(ValueError, match="power of two"):
        pack(frame(spark, [row]), context=1000)


def test_remembered_encodings_keep_to_their_bytes(monkeypatch):
    """Ids stay those of the library while encodings are forgotten again and again."""
    monkeypatch.setattr(packing, "ENCODED_CHARS", 500)
    name = "word_bpe_49k.json"
    encoder = Encoder(vocabulary(name))
    encoder.pieces, encoder.words = Remembered(20_000), Remembered(10_000)
    texts = [" ".join(prose(seed, 60)) + f" Ünï {seed}, end. " + "long" * 30 for seed in range(60)] * 2
    for text, encoded in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(encoded, "<u4").tolist() == ids(name, text)
    for table, most in ((encoder.pieces, 20_000), (encoder.words, 10_000)):
        held = sum(len(k) + len(v) + table.ENTRY for part in (table.young, table.old) for k, v in part.items())
        assert 0 < held <= most + 70 * 300
