"""Sharding against a directory split by hand, and nearest neighbours against all products."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from sluicegate.llm import neighbours, sharding
from sluicegate.llm.neighbours import nearest, probe_order
from sluicegate.llm.sharding import HASH_BITS, shard, write_shards
from tests.llm.cases import awkward, document, frame, prose


def bits(doc_id) -> str:
    digest = hashlib.md5(str("" if doc_id is None else doc_id).encode()).hexdigest()
    return format(int(digest[:15], 16), f"0{HASH_BITS}b")


def split(rows: list[tuple[str, int]], prefix: str, limit: int) -> dict[str, str]:
    if sum(n for _, n in rows) <= limit or len(prefix) == HASH_BITS:
        return {b: prefix for b, _ in rows}
    found = {}
    for bit in "01":
        found |= split([r for r in rows if r[0][len(prefix)] == bit], prefix + bit, limit)
    return found


@pytest.mark.parametrize("limit", [300, 5_000, 1 << 30])
def test_shards(spark, limit):
    rows = [document(i, " ".join(prose(i, i % 25))) for i in range(300)]
    rows += [r for r in awkward() if r[0] != 5]
    expected = split([(bits(r[0]), len((r[1] or "").encode())) for r in rows], "", limit)
    got = shard(frame(spark, rows), limit).collect()
    assert sorted((r.doc_id, r.shard) for r in got if r.doc_id is not None) == sorted(
        (r[0], expected[bits(r[0])]) for r in rows if r[0] is not None
    )
    assert len(got) == len(rows)
    assert all(r.depth == len(r.shard) and r.page == 0 for r in got)


def test_rows_of_one_key_overflow(spark):
    rows = [document(1, "x" * 100)] * 200 + [document(i, "y" * 50) for i in range(2, 40)]
    got = shard(frame(spark, rows), 2_000).collect()
    pages = defaultdict(int)
    for r in got:
        pages[r.shard, r.page] += r.n_bytes
    assert len(got) == len(rows)
    assert {r.depth for r in got if r.doc_id == 1} == {HASH_BITS}
    assert len([1 for s, _ in pages if len(s) == HASH_BITS]) >= 12
    assert max(pages.values()) <= 2_000
    assert shard(frame(spark, [])).count() == 0


def test_pages_of_a_hot_key_fit(spark, tmp_path, monkeypatch):
    """Texts of a third to a half of the limit, some longer than half and one longer than the limit."""
    monkeypatch.setattr(sharding, "PART_ROWS", 30)
    sizes = [700] * 150 + [999, 1_000, 1_001, 1_500, 2_000, 2_500] * 8 + [0] * 20
    rows = [document(1, chr(97 + i % 26) * n) for i, n in enumerate(sizes)] + [document(i, "y" * 50) for i in range(2, 40)]
    documents = frame(spark, rows).repartition(5)
    pages = defaultdict(list)
    for r in shard(documents, 2_000).collect():
        pages[r.shard, r.page].append(r.n_bytes)
    assert sum(map(len, pages.values())) == len(rows)
    assert all(sum(own) <= 2_000 or len(own) == 1 for own in pages.values())
    hot = [page for bits, page in pages if len(bits) == HASH_BITS]
    assert len(hot) > 60 and max(hot) < 4 * len(hot)
    write_shards(documents, str(tmp_path / "out"), 2_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(documents.columns).collect())) == sorted(map(str, documents.collect()))
    written = back.selectExpr("input_file_name() AS f", "octet_length(text) AS n").groupBy("f").agg({"n": "sum", "f": "count"})
    assert all(r["sum(n)"] <= 2_000 or r["count(f)"] == 1 for r in written.collect())


def test_written_shards(spark, tmp_path):
    rows = [document(i, " ".join(prose(i, 10))) for i in range(60)] + [document(None, "no id")]
    documents = frame(spark, rows)
    write_shards(documents, str(tmp_path / "out"), 1_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(documents.columns).collect())) == sorted(map(str, documents.collect()))
    sizes = back.selectExpr("shard_bits", "octet_length(text) AS n").groupBy("shard_bits").sum("n").collect()
    assert len(sizes) > 2 and max(r[1] for r in sizes) <= 1_000
    with pytest.raises(ValueError, match="shard_bits"):
        write_shards(back, str(tmp_path / "again"))


def test_probe_order():
    order = probe_order(3, 100)
    assert len(order) == 27 and len(np.unique(order, axis=0)) == 27
    assert not order[0].any() and order[1].tolist() == [1, 0, 0, 0, 0, 0]
    assert not (order & order[:, ::-1]).any()


SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, score string, part long, code int"


def rows_of(vectors) -> list:
    return [(i, v, 0, 1, "x", 2, 3) for i, v in vectors]


def brute_force(vectors: dict, count: int = 20) -> dict:
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], dtype=np.float32).astype(np.float64)
    found = {}
    for place, i in enumerate(ids):
        if i % 20 == 0:
            scores = (matrix * matrix[place]).sum(1)
            order = [k for k in np.lexsort((ids, -scores)) if k != place][:count]
            found[int(i)] = [(int(ids[k]), float(scores[k])) for k in order]
    return found


def found_by_query(result) -> dict:
    got = defaultdict(list)
    for r in sorted(result, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_neighbours(spark):
    source = np.random.default_rng(2)
    centers = source.normal(size=(12, 24))
    vectors = {i: (centers[i % 12] + source.normal(size=24) * 0.6) * source.uniform(0.3, 2) for i in range(900)}
    got = found_by_query(nearest(spark.createDataFrame(rows_of((i, v.tolist()) for i, v in vectors.items()), SCHEMA)).collect())
    expected = brute_force(vectors)
    assert got.keys() == expected.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    for query, own in got.items():
        scores = dict(brute_force({query: vectors[query], **{v: vectors[v] for v, _ in own}}, 99)[query])
        assert all(scores[v] == s for v, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))


def test_equal_and_unusable_vectors(spark):
    source = np.random.default_rng(3)
    same = [1.0, 2.0, -1.0, 0.5]
    vectors = {i: same if i % 3 else source.normal(size=4).tolist() for i in range(120)}
    rows = rows_of(vectors.items())
    rows += rows_of([(200, None), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]), (260, [1.0, float("nan"), 0.0, 0.0])])
    rows += rows_of([(280, [float("inf"), 0.0, 0.0, 0.0]), (300, [1.0]), (320, []), (None, same), (1, same), (1, same)])
    got = found_by_query(nearest(spark.createDataFrame(rows, SCHEMA)).collect())
    expected = brute_force(vectors)
    assert got.keys() == expected.keys()
    for query, own in got.items():
        if vectors[query] is same:
            assert [v for v, _ in own] == [i for i in range(120) if i % 3 and i != query][:20]


def test_few_vectors(spark):
    few = spark.createDataFrame(rows_of([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (20, [0.0, 2.0])]), SCHEMA)
    got = found_by_query(nearest(few).collect())
    assert {q: {v for v, _ in own} for q, own in got.items()} == {0: {1, 2, 20}, 20: {0, 1, 2}}
    assert nearest(few.where("vec_id = 0")).count() == 0
    assert nearest(few.limit(0)).columns == ["query_id", "rank", "vec_id", "score"]
    assert nearest(few.limit(0)).count() == 0


def complete(vectors, got, count=20):
    """Every query has as many rows as it can, at least 0.9 of them the true ones."""
    expected = brute_force(vectors, count)
    assert {q: len(own) for q, own in got.items()} == {q: len(own) for q, own in expected.items()}
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))


@pytest.mark.parametrize("norms", ["one long", "many sizes"])
def test_norms_of_very_different_size(spark, norms):
    source = np.random.default_rng(6)
    units = source.normal(size=(1_500, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    sizes = np.where(np.arange(1_500) == 7, 50.0, 1.0) if norms == "one long" else 10.0 ** source.uniform(-3, 3, 1_500)
    vectors = {i: (v * size).tolist() for i, (v, size) in enumerate(zip(units, sizes, strict=True))}
    got = found_by_query(nearest(spark.createDataFrame(rows_of(vectors.items()), SCHEMA)).collect())
    complete(vectors, got)


def test_queries_without_mates_are_compared_with_all(spark):
    """Some queries point away from all other vectors."""
    source = np.random.default_rng(9)
    ahead = np.r_[4.0, np.zeros(11)]
    vectors = {i: (source.normal(size=12) * 0.2 + (-ahead if i % 100 == 0 else ahead)).tolist() for i in range(1_000)}
    got = found_by_query(nearest(spark.createDataFrame(rows_of(vectors.items()), SCHEMA)).collect())
    complete(vectors, got)


def test_exact_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "MOST_PROBES", 0)
    source = np.random.default_rng(10)
    vectors = {i: source.normal(size=6).tolist() for i in range(450)}
    got = found_by_query(nearest(spark.createDataFrame(rows_of(vectors.items()), SCHEMA), count=5).collect())
    assert got == brute_force(vectors, 5)


def test_parts_cut_on_both_sides_give_the_same(spark, monkeypatch):
    source = np.random.default_rng(11)
    vectors = {i: source.normal(size=6).tolist() for i in range(400)}
    rows = spark.createDataFrame(rows_of(vectors.items()), SCHEMA)
    whole = sorted(nearest(rows).collect())
    monkeypatch.setattr(neighbours, "PART_PROBES", 3)
    monkeypatch.setattr(neighbours, "PART_ROWS", 100)
    assert sorted(nearest(rows).collect()) == whole
