"""Collocations against counting every phrase on its own."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluicegate.llm import collocations as module
from sluicegate.llm.collocations import collocations, phrase_paths
from tests.llm.cases import awkward, document, frame

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def pieces_of(rows):
    for row in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (row[1] or "").translate(UPPER)):
            if words := re.findall(r"[^ \t]+", piece):
                yield row[2] or "und", words


def counted(rows):
    counts, totals = Counter(), Counter()
    for lang, words in pieces_of(rows):
        totals[lang] += len(words)
        for size in (1, 2, 3):
            for i in range(len(words) - size + 1):
                counts[lang, *words[i : i + size]] += 1
    return counts, totals


def expected(rows, least, percent, top):
    counts, totals = counted(rows)
    by_lang = {}
    for key, a in counts.items():
        lang, words = key[0], key[1:]
        if len(words) == 1 or a < least:
            continue
        longer = [n for other, n in counts.items() if len(other) == 4 and n >= least and words in (other[1:3], other[2:4]) and other[0] == lang]
        if len(words) == 2 and any(100 * n >= percent * a for n in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


def some_rows(seed):
    source = random.Random(seed)
    words = "Ab ab c d e é漢 f-g h' zz x".split()
    line = "all of these words always come together in one line"
    rows = []
    for i in range(120):
        text = "".join(source.choice(words) + source.choice([" "] * 9 + ["\t", "  ", ". ", ",", "\n", "\x0b", "!?", ";"]) for _ in range(40))
        if i % 7 == 0:
            text += ". " + line + source.choice(["", " c", ". c"])
        rows.append(document(i, text, source.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize(("least", "percent", "top"), [(2, 50, 2000), (3, 80, 25), (10, 0, 2000), (4, 150, 2000)])
def test_equals_counting_phrases(spark, least, percent, top):
    rows = some_rows(least) + awkward()
    found = collocations(frame(spark, rows).repartition(5), least, percent, top)
    assert sorted(map(tuple, found.collect())) == sorted(expected(rows, least, percent, top))


@pytest.mark.parametrize("wide", [False, True])
def test_many_blocks_and_wide_places_give_the_same(spark, monkeypatch, wide):
    rows = some_rows(9)
    monkeypatch.setattr(module, "BLOCK_BYTES", 64)
    if wide:
        monkeypatch.setattr(module, "WIDE_BYTES", 0)
    found = collocations(frame(spark, rows), 3)
    assert sorted(map(tuple, found.collect())) == sorted(expected(rows, 3, 50, 2000))


def test_paths_are_runs_that_only_occur_whole(spark):
    rows = some_rows(4)
    counts, _ = counted(rows)
    found = phrase_paths(frame(spark, rows), 5).collect()
    assert any(row.phrase == "all of these words always come together in one line" for row in found)
    edges = Counter()
    for row in found:
        words = row.phrase.split(" ")
        assert row.n_words == len(words)
        for i in range(len(words) - 2):
            edges[row.lang, *words[i : i + 3]] = row["count"]
        for i in range(1, len(words) - 2):
            assert counts[row.lang, words[i], words[i + 1]] == row["count"]
    assert edges == {key: n for key, n in counts.items() if len(key) == 4 and n >= 5}


def test_empty_table(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, [document(1, None), document(2, " . ")])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, big + 7, big + 1)], "a long, l long, r long")
    score = row.select(module._score("a", row.l, row.r).alias("s")).first().s
    assert score == 1_000_000 * big * big // ((big + 7) * (big + 1))


def test_shared_numbers_are_noticed(spark, monkeypatch):
    """With hashes of a few bits words collide, until a seed with other hashes comes."""
    tried = []
    real = module.byte_values

    def values(seed):
        tried.append(seed)
        return real(seed) if seed > 1 else np.full(256, 3, np.uint64)

    monkeypatch.setattr(module, "byte_values", values)
    # Equal byte values make words of one length share a hash.
    batch = pa.RecordBatch.from_pydict({"text": ["ab cd ab"], "lang": ["en"]})
    assert len(set(next(module._chunks(iter([batch]), 1)).ids.tolist())) == 1
    assert len(set(next(module._chunks(iter([batch]), 2)).ids.tolist())) == 2
    assert tried == [1, 2]


def test_passing_rows_on_early_gives_the_same(monkeypatch):
    """What tasks hold changes how often edges come, not their sum."""
    texts = {"text": [row[1] for row in some_rows(5)], "lang": [row[2] or "und" for row in some_rows(5)]}
    batch = pa.RecordBatch.from_pydict(texts)

    class Everything:
        value = b"\xff" * (1 << (module.FILTER_BITS - 3))

    found = []
    for chunk, held in ((1 << 20, 1 << 20), (50, 30), (1, 1)):
        monkeypatch.setattr(module, "CHUNK_WORDS", chunk)
        monkeypatch.setattr(module, "HELD_EDGES", held)
        monkeypatch.setattr(module, "WAITING_EDGES", held // 2)
        sums = Counter()
        for rows in module._edges(module._Counting(1, 4, 16), Everything)(iter([batch.slice(0, 70), batch.slice(70)])):
            for row in rows.to_pylist():
                if row["word"] is None:
                    sums[row["a"], row["b"], row["c"], row["lang"]] += row["weight"]
        found.append(sums)
    assert found[0] == found[1] == found[2]


def test_counted_hashes_come_back(monkeypatch):
    monkeypatch.setattr(module, "HELD_CODES", 100)
    batch = pa.RecordBatch.from_pydict({"text": [row[1] for row in some_rows(6)], "lang": ["en"] * 120})
    how = module._Counting(1, 8, 16)
    rows = pa.Table.from_batches(list(module._counted(how)(iter([batch]))))
    blocks = rows.column("block").to_numpy()
    places = set()
    for block in set(blocks.tolist()):
        part = rows.filter(pa.array(blocks == block))
        places |= set(module._frequent(how, 5)((pa.scalar(block),), part).column("place").to_pylist())
    chunk = next(module._chunks(iter([batch]), 1))
    one, two = module._steps(chunk.followed)
    ids = chunk.ids
    codes = np.concatenate(
        [module._edge_codes(ids[two], ids[two + 1], ids[two + 2]), module._node_codes(ids[one], ids[one + 1]), module._word_codes(ids)]
    )
    cut, counts = np.unique(how.cut(codes), return_counts=True)
    assert places == set(how.places(cut[counts >= 5]).tolist())
