"""The join against all pairs, and awkward rows."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from sluicegate.llm import ngram_join
from sluicegate.llm.common import Scratch
from sluicegate.llm.components import components
from sluicegate.llm.ngram_join import near_duplicates
from sluicegate.llm.words import gram_sets
from tests.llm.cases import awkward, document, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    return frozenset(runs or ([tuple(words)] if words else []))


def brute_force(rows) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(text) for i, text in rows}
    smallest = {i: i for i in sets}
    for _ in sets:
        for a, b in combinations(sets, 2):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]):
                smallest[a] = smallest[b] = min(smallest[a], smallest[b])
    return {i: (len(sets[i]), smallest[i]) for i in sets}


def corpus() -> list[tuple[int, str]]:
    """Chains of near copies, exact copies, a passage that many share, and pairs at the border."""
    source, texts = random.Random(3), []
    passage = prose(99, 60)
    for group in range(6):
        words = prose(group, 120)
        for _ in range(source.randrange(1, 14)):
            texts.append(" ".join(words))
            words = words[:]
            for _ in range(source.randrange(0, 4)):
                words[source.randrange(len(words))] = f"changed{source.randrange(1000)}"
    texts += [" ".join(prose(200 + i, 12) + passage) for i in range(45)]
    texts += [texts[0].upper()] * 9 + ["a b c", "A  b\tc", "a b c d", "x", ""]
    # 36 words are 32 shingles; 4 further words give 36: similarities from 32/36 down to below 0.8.
    base = prose(500, 36)
    texts += [" ".join(base + prose(600 + n, n)) for n in range(1, 13)]
    source.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("heavy", [2, 32])
def test_against_all_pairs(spark, monkeypatch, heavy):
    monkeypatch.setattr(ngram_join, "LEAST_HEAVY", heavy)
    rows = corpus()
    result = near_duplicates(frame(spark, [document(*r) for r in rows])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result} == brute_force(rows)
    assert len(result) == len(rows)


def test_pairs_at_the_border_beside_a_long_quoting_row(spark):
    """A fifth to a quarter of added words, where a long row that quotes the shorter text is the pivot."""
    source, rows, quotes = random.Random(11), [], []
    for i in range(30):
        text = prose(1000 + i, 84)
        added = prose(2000 + i, 16 + i % 5)
        rows += [" ".join(text), " ".join(text + added)]
        quotes += text
    rows.append(" ".join(quotes))
    source.shuffle(rows)
    rows = list(enumerate(rows, 1))
    result = near_duplicates(frame(spark, [document(*r) for r in rows])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result} == brute_force(rows)


def test_awkward_rows(spark):
    got = sorted(map(tuple, near_duplicates(frame(spark, awkward())).collect()), key=str)
    expected = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), *[(6, 2, 6)] * 3, (7, 1, 7), (7, 1, 7), (8, 1, 8)]
    expected += [(9, 0, 9), (None, 1, None), (None, 0, None)]
    assert [r for r in got if r[0] != 5] == sorted(expected, key=str)
    assert next(r for r in got if r[0] == 5)[2] == 5


def test_empty_table(spark):
    result = near_duplicates(frame(spark, []))
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    assert result.count() == 0


def test_sets_have_the_size_of_real_sets():
    texts = [t for _, t in corpus()] + [None, "  ", "\x0b\x0c", "É é", "a\x1cb", "x" * 3_000_000, " ".join("ab" * 9)]
    for text, grams in zip(texts, gram_sets(pa.array(texts), 5), strict=True):
        assert len(grams) == len(shingles(text))
        assert (np.diff(grams.astype(object)) > 0).all()


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)]
    edges = spark.createDataFrame(path, "a long, b long")
    found = {r.node: r.root for r in components(edges, Scratch(spark), "path").collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
