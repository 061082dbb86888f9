"""Toxic segments and languages: brute force for the scan, held-out accuracy for the models."""

from __future__ import annotations

import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import language, toxicity
from sluicegate.llm.common import Scratch
from sluicegate.llm.language import RunVectors, identify
from sluicegate.llm.toxicity import Model, clean_rows, score_toxicity, segments
from sluicegate.queries.registry import table
from tests.llm.cases import awkward, document, frame, prose

SF = "/root/testdata/sf0.01"


def fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


def maximal(scores: list[float]) -> list[tuple]:
    """Maximal segments by their definition: take the best one, then do the same on both sides."""
    best, found = 0.0, None
    for first in range(len(scores)):
        total = 0.0
        for past in range(first + 1, len(scores) + 1):
            total += scores[past - 1]
            if total > best + 1e-9:
                best, found = total, (first, past)
    if not found:
        return []
    first, past = found
    right = [(s, f + past, p + past) for s, f, p in maximal(scores[past:])]
    return [*maximal(scores[:first]), (best, first, past), *right]


def test_segments_are_the_maximal_ones():
    source = random.Random(2)
    for _ in range(400):
        scores = [source.choice([-3.0, -1.0, -0.5, 0.7, 1.1, 2.3]) + source.random() / 8 for _ in range(source.randrange(12))]
        got = segments(np.array(scores))
        assert [(f, p) for _, f, p in got] == [(f, p) for _, f, p in maximal(scores)]
        assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in maximal(scores)])


def test_segments_of_long_texts_take_linear_time():
    rising = np.tile([1.0, -0.9], 200_000)
    falling = np.concatenate([np.linspace(2, 1, 200_000)[:, None], np.full((200_000, 1), -3.0)], 1).ravel()
    assert len(segments(rising)) == 1
    assert len(segments(falling)) == 200_000


def test_rate_solves_its_equation():
    values, counts = np.array([-1.0, 0.5, 2.0]), np.array([80.0, 15.0, 5.0])
    rate = toxicity._rate(values, counts)
    assert (counts / 100 * np.exp(rate * values)).sum() == pytest.approx(1)
    assert toxicity._rate(np.zeros(0), np.zeros(0)) == 1.0


def test_toxicity_on_held_out_rows(spark):
    documents = table(spark, "/root/testdata/sf0.1", "documents")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    scored = score_toxicity(documents, labels)
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", "toxic", "score").collect()
    hits = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 - r.toxic for r in rows)
    assert hits > 0.97 and found > 0.85 and wrong < 0.01
    assert all(0 <= r.score <= 1 for r in rows)


def toxic_corpus() -> tuple[list, list]:
    rows, labels = [], []
    for i in range(1000, 1400):
        words, toxic = prose(i, 40), i % 4 == 0
        if toxic:
            words[5:5] = ["vile", "rotten", "wretch"]
        rows.append(document(i, " ".join(words)))
        labels.append((i, int(toxic), "x"))
    return rows, labels


def test_passages_and_awkward_rows(spark):
    rows, labels = toxic_corpus()
    # A label contradicts itself, one is null, one has no id, one is of an unknown row.
    labels = spark.createDataFrame([*labels, (1004, 0, "x"), (1, None, "x"), (None, 1, "x"), (5, 1, "x")], "doc_id long, toxic int, text string")
    rows += [*awkward(), document(77, "VILE rotten, wretch! " + " ".join(prose(1, 2000)) + " vile rotten wretch.")]
    documents = frame(spark, rows)
    scored = score_toxicity(documents, labels).collect()
    assert len(scored) == len(rows)
    by_id = {r.doc_id: r for r in scored}
    assert by_id[1000].predicted == 1 and by_id[1001].predicted == 0
    assert any(p.first <= 5 and 8 <= p.past <= 12 for p in by_id[1000].passages)
    assert by_id[77].predicted == 1 and by_id[77].passages[0].past >= 3
    assert {by_id[i].predicted for i in (1, 2, 3, 4, 9, None)} == {0}
    assert all(r.held_out == (r.doc_id is None or fold(r.doc_id) == 0) for r in scored)
    kept = {r.doc_id for r in clean_rows(documents, labels).select("doc_id").collect()}
    assert kept == {r.doc_id for r in scored if not r.predicted}


TOXIC_WORDS = {"vile": 3.0, "rotten": 3.0, "wretch": 3.0}


def test_every_passage_counts():
    model, weigher = Model(TOXIC_WORDS, 1.0, -4.0), toxicity.Weigher(TOXIC_WORDS, toxicity.DRIFT)
    plain, passage = ["plain"] * 300, ["vile", "rotten", "wretch"]
    early = [*plain, "vile", *plain, "rotten", *plain, "wretch", *plain]
    _, found = toxicity._scored(model, weigher, " ".join([*early, *passage, *plain, *passage]))
    assert sorted((f, p) for _, f, p in found) == [(1203, 1206), (1506, 1509)]
    weights, _ = weigher.weights(" ".join(["vile"] * 20))
    assert (weights > 0).tolist() == [True] + [False] * 19


def test_joined_words_count_each():
    weigher = toxicity.Weigher(TOXIC_WORDS, toxicity.DRIFT)
    weights, at = weigher.weights("plain good/vile-rotten -- " + "x" * 70 + "/wretch")
    assert at.tolist() == [0, 1, 1, 1, 2, 3, 3, 3]
    assert (weights > 0).tolist() == [False, False, True, True, False, False, False, True]
    _, found = toxicity._scored(Model(TOXIC_WORDS, 1.0, -4.0), weigher, "plain good/vile-rotten plain")
    assert [(f, p) for _, f, p in found] == [(1, 2)]


def test_held_out_labels_teach_nothing(spark):
    rows, labels = toxic_corpus()
    flipped = [(i, 1 - t if fold(i) == 0 else t) for i, t, _ in labels]
    models = [
        toxicity.learn(frame(spark, rows), spark.createDataFrame(known, "doc_id long, toxic int")).to_json()
        for known in ([(i, t) for i, t, _ in labels], flipped)
    ]
    assert models[0] == models[1]


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scored = score_toxicity(frame(spark, awkward()), labels).collect()
    assert {r.predicted for r in scored} == {0}
    assert score_toxicity(frame(spark, []), labels).count() == 0
    assert Model({}).to_json()


def test_words_of_one_kind_of_text_only(spark):
    """In exact fractions: a word and its prefixes, all in thousands of toxic texts and in no clean one, and the reverse."""
    counts = {"wretchedly": (9_000, 0), "cheerfulness": (0, 90_000), "rest": (300, 700)}
    texts = spark.createDataFrame([(w, t, n) for w, c in counts.items() for t, n in zip((True, False), c)], "text string, toxic boolean, n int")
    texts = texts.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n")))).where("i < n").select("text", "toxic")
    scratch = Scratch(spark)
    weights = toxicity.learn_weights(texts, scratch)
    toxic, clean = (sum(c[i] for c in counts.values()) for i in (0, 1))
    for word in ("wretchedly", "cheerfulness"):
        share = [Fraction(toxic, toxic + clean), Fraction(clean, toxic + clean)]
        for stem in (*(word[:length] + "*" for length in toxicity.PREFIXES), word):
            share = [(n + 5 * p) / (sum(counts[word]) + 5) for n, p in zip(counts[word], share)]
            expected = math.log(share[0] / share[1]) - math.log(toxic / clean)
            assert weights[stem] == pytest.approx(expected, rel=1e-12)
        assert max(map(float, share)) == 1.0


def test_toxic_word_of_many_texts(spark):
    texts = spark.range(12_000).selectExpr(
        "id AS doc_id", "id % 2 AS toxic",
        "concat_ws(' ', 'common', concat('word', id % 7), if(id % 2 = 1, 'wretchedly', 'friendly'), concat('at', id % 11)) AS text",
    )
    scored = score_toxicity(texts.drop("toxic"), texts.drop("text"))
    assert {(r.toxic, r.predicted) for r in scored.join(texts, "doc_id").select("toxic", "predicted").distinct().collect()} == {(0, 0), (1, 1)}
    assert [r.asDict() for r in clean_rows(texts, texts.drop("text")).groupBy("toxic").count().collect()] == [{"toxic": 0, "count": 6_000}]


def test_run_vectors_follow_their_definition():
    vectors = RunVectors(64, 3, 1)
    a, b, space = (vectors._letter_vector(p) for p in (ord("a"), ord("b"), 0))
    runs = vectors.runs("..Ab--")
    expected = np.roll(space, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * space
    assert len(runs) == 2
    assert (vectors.bundles([runs])[0] == expected).all()
    assert len(vectors.runs("12 !?")) == 0
    assert len(vectors.runs("a")) == 1


def test_languages_of_held_out_rows(spark):
    documents = table(spark, SF, "documents")
    rows = identify(documents).where("held_out").join(documents, "doc_id").select("lang_pred", "lang").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98


def test_languages_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "REMEMBERED", 50)
    german, english = "der schnelle braune fuchs ueber zaun", "the quick brown fox jumps over fences"
    rows = [document(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(1000, 1040)]
    rows += [document(77, "über the " + german, None), document(78, "12 ... 34", "de"), *awkward()]
    found = identify(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[1000].lang_pred, by_id[1001].lang_pred, by_id[77].lang_pred) == ("de", "en", "de")
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 9, 78))
    assert all(0 <= r.score <= 1 for r in found)
    assert identify(frame(spark, [])).count() == 0
    alone = identify(frame(spark, [document(1, "text", None)])).first()
    assert (alone.lang_pred, alone.score) == ("und", 0.0)
