"""The MinHash forest against the similarity of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sluicegate.llm import minhash_forest as module
from sluicegate.llm.minhash_forest import depth_for, forest_duplicates, signatures
from tests.llm.cases import awkward, document, frame, prose

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def expected(rows, percent=80, size=4):
    """All pairs that share a shingle, then components by union-find."""
    sets = {}
    for row in rows:
        if row[0] is not None:
            sets.setdefault(shingles(row[1], size), []).append(row[0])
    nodes = [s for s in sets if s]
    root = {s: s for s in nodes}

    def find(s):
        while root[s] is not s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    holders = {}
    for s in nodes:
        near = {other for gram in s for other in holders.get(gram, ())}
        for other in near:
            both = len(s & other)
            if 100 * both >= percent * (len(s) + len(other) - both):
                root[find(s)] = find(other)
        for gram in s:
            holders.setdefault(gram, []).append(s)
    smallest = {}
    for s in nodes:
        smallest[find(s)] = min([smallest.get(find(s), min(sets[s])), *sets[s]])
    for row in rows:
        s = shingles(row[1], size)
        component = None if row[0] is None else smallest[find(s)] if s else row[0]
        yield row[0], len(s), component, None if component is None else component == row[0]


def check(spark, rows, parts=6, **options):
    found = forest_duplicates(frame(spark, rows).repartition(parts), **options)
    percent, size = options.get("percent", 80), options.get("gram_size", 4)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got, true = sorted(map(repr, map(tuple, found.collect()))), sorted(map(repr, expected(rows, percent, size)))
    assert got == true


def changed(words, source, count):
    words = list(words)
    for _ in range(count):
        at = source.randrange(len(words))
        words[at : at + source.randrange(2)] = [f"new{source.randrange(10**6)}"] * source.randrange(2)
    return words


def test_awkward_rows(spark):
    check(spark, awkward())


def test_empty_table(spark):
    assert forest_duplicates(frame(spark, [])).count() == 0
    check(spark, [document(1, None), document(2, "")])


@pytest.mark.parametrize("percent", [80, 60, 95])
def test_families_of_copies(spark, percent):
    """Copies with few to many changes: similarities on both sides of the bound."""
    source = random.Random(percent)
    rows = []
    for family in range(12):
        words = prose(family, 30 + 40 * family)
        for copy in range(12):
            rows.append(document(1000 * family + copy, " ".join(changed(words, source, copy * len(words) // 100))))
    check(spark, rows, percent=percent)


def test_short_texts(spark):
    source = random.Random(7)
    rows = [document(i, " ".join(source.choice("a b c".split()) for _ in range(source.randrange(1, 9)))) for i in range(300)]
    check(spark, rows)
    check(spark, rows, gram_size=2, percent=70)


def test_unconnected_rows_around_a_shared_passage(spark):
    """A dense region: rows share half of their text, few of them link."""
    source = random.Random(11)
    passage = prose(1, 120)
    rows = []
    for i in range(150):
        own = prose(100 + i, 40)
        rows.append(document(i, " ".join(passage + own)))
        if i % 10 == 0:
            rows.append(document(1000 + i, " ".join(passage + changed(own, source, 3))))
    check(spark, rows, parts=20)


def test_dense_regions_are_divided_and_cut(spark, monkeypatch):
    """The same with regions so small that every one is divided, and cut into blocks."""
    monkeypatch.setattr(module, "REGION_PAIRS", 20)
    monkeypatch.setattr(module, "BLOCK_BYTES", 10_000)
    source = random.Random(12)
    passage = prose(2, 200)
    rows = []
    for i in range(60):
        own = prose(500 + i, 52)
        rows.append(document(i, " ".join(passage + own)))
        if i % 6 == 0:
            rows.append(document(1000 + i, " ".join(passage + changed(own, source, 4))))
    check(spark, rows)


def test_one_group_holds_most_rows(spark):
    source = random.Random(13)
    words = prose(3, 400)
    rows = [document(i, " ".join(changed(words, source, 12))) for i in range(250)]
    rows += [document(1000 + i, " ".join(words)) for i in range(40)]
    rows += [document(2000 + i, " ".join(prose(50 + i, 60))) for i in range(40)]
    check(spark, rows, parts=16)


def copies_of_one_text(count):
    source = random.Random(14)
    words = prose(4, 300)
    return [document(i, " ".join(changed(words, source, 8))) for i in range(count)]


def test_pairs_do_not_outnumber_classes(spark):
    """In a group of near copies every class goes on with one neighbour, not with one for each order."""
    for count in (100, 200):
        forest = module._Forest(frame(spark, copies_of_one_text(count)).repartition(5), 4, 80, "doc_id", "text")
        forest.sign()
        best = [tuple(r) for r in forest.order().collect()]
        assert len(best) == len(set(best)) <= count
        assert all(a < b for a, b in best)
        assert {c for pair in best for c in pair} == {r["class"] for r in forest.classes.collect()}


def test_few_edges_tie_clusters(spark):
    """Classes in many regions of one group: all are tied to each other, by few edges."""
    source = random.Random(15)
    rows = [(64 * g + region, 1000 * g + c, c) for g in range(3) for region in range(60) for c in source.sample(range(200), 25)]
    regions = spark.createDataFrame(rows, "region long, class long, root long")
    forest = module._Forest(frame(spark, []), 4, 80, "doc_id", "text")
    edges = [tuple(r) for r in forest._tied(regions).collect()]
    classes = {c for _, c, _ in rows}
    assert len(edges) == len(set(edges)) < 1.5 * len(classes)
    root = {c: c for c in classes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in edges:
        root[find(a)] = find(b)
    found, true = {c: find(c) for c in classes}, {c: min(k for k in classes if k // 1000 == c // 1000) for c in classes}
    assert {frozenset(c for c in classes if found[c] == r) for r in found.values()} == {
        frozenset(c for c in classes if true[c] == r) for r in true.values()
    }


def test_signatures_agree_as_sets_are_similar():
    source = np.random.default_rng(5)
    for size, common in ((60, 48), (1000, 800), (5, 4)):
        shares = []
        for _ in range(60):
            grams = source.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
            left, right = grams[:size], np.r_[grams[:common], grams[size : 2 * size - common]]
            a, b = signatures([left, right])
            shares.append((a == b).mean())
        jaccard = common / (2 * size - common)
        assert abs(np.mean(shares) - jaccard) < 0.02
        assert np.std(shares) < 1.5 * np.sqrt(jaccard * (1 - jaccard) / module.HASHES)


def test_links_of_a_block():
    """Exact links that connect all that can be connected, and no more of them than that takes."""
    source = np.random.default_rng(8)
    base = source.integers(0, 1 << 63, 100, dtype=np.uint64)
    sets = [np.unique(np.r_[base[: 100 - 3 * k], source.integers(0, 1 << 63, 3 * k, dtype=np.uint64)]) for k in source.integers(0, 12, 60)]
    rows = {
        "block": [1] * 60, "class": list(range(60)), "root": [0 if i < 3 else i for i in range(60)],
        "minor": [i >= 3 for i in range(60)], "any": [True] * 60,
        "signature": [row.tobytes() for row in module.signatures(sets)],
        "grams": [g.view(np.int64).tolist() for g in sets],
    }
    found = module._within(80, module.least_agreeing(0.8))((None,), pa.table(rows)).to_pylist()

    def jaccard(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return both / (len(sets[a]) + len(sets[b]) - both)

    assert all(jaccard(r["a"], r["b"]) >= 0.8 for r in found)

    def groups(pairs):
        root = {i: rows["root"][i] for i in range(60)}
        for a, b in pairs:
            old, new = root[a], root[b]
            root = {k: new if v == old else v for k, v in root.items()}
        return {frozenset(k for k in root if root[k] == v) for v in set(root.values())}

    true = [(a, b) for a in range(60) for b in range(a) if jaccard(a, b) >= 0.8 and rows["root"][a] != rows["root"][b]]
    assert groups((r["a"], r["b"]) for r in found) == groups(true)
    assert len(found) == 58 - len(groups(true)) < len(true)


def test_depths():
    for similarity in (0.5, 0.8, 0.9):
        for chance in (1e-8, 1e-5):
            depth = depth_for(similarity, chance)
            assert (1 - similarity**depth) ** module.ORDERS <= chance * 1.0001
    assert depth_for(1.0, 1e-8) == module.MOST_DEPTH


def test_neighbours_across_batches():
    """Rows that share a region are found whatever the batches, and none twice as a pair."""
    source = np.random.default_rng(2)
    n = 400
    tree = np.sort(source.integers(0, 3, n)).astype(np.int32)
    high = source.integers(0, 30, n) << 50
    order = np.lexsort((high, tree))
    tree, high, low, keys = tree[order], high[order], source.integers(0, 9, n), np.arange(n)
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in (tree, high, low, keys)], names=["tree", "high", "low", "class"])

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 3

    module_context, module.TaskContext = module.TaskContext, Context
    try:
        for size in (1, 7, n):
            batches = iter([whole.slice(i, size) for i in range(0, n, size)])
            found = pa.Table.from_batches(list(module._neighbours(6)(batches))).to_pylist()
            pairs = [(r["before"], r["class"]) for r in found if r["before"] is not None]
            same = [(i - 1, i) for i in range(1, n) if tree[i] == tree[i - 1] and high[i] >> 16 == high[i - 1] >> 16]
            assert pairs == same
            members = {i for pair in same for i in pair}
            assert {r["class"] for r in found if r["edge"] is None} >= members - {0, n - 1}
            assert [r["class"] for r in found if r["edge"] is not None] == [0, n - 1]
    finally:
        module.TaskContext = module_context
