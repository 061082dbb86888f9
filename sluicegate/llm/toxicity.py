"""Toxic passages as maximum-scoring segments of token log-odds.

A token's weight is the log-odds of toxic against clean text, under a Dirichlet prior that comes from
the words that begin alike: a word's share is drawn towards that of its longest counted prefix, a
prefix's towards that of the next shorter one, the shortest towards the share of all tokens. So a word
never seen has the weight of its prefix.

From each weight a drift is taken, so that ordinary text scores below zero. A linear-time scan finds
every maximal segment. The scores of such segments in clean text follow an extreme-value law, whose
parameters are estimated on labelled rows kept apart; a text's evidence adds up what its segments
score beyond that law, and is turned into a probability.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, Scratch, fields, held_out, keep_rows, kept, map_batches, parts, texts_of

# Labelled rows that weights and calibration are fitted on, at most; a hash of the id chooses.
MOST_LABELS = 200_000
# Words and prefixes with a weight of their own, at most: those that tell most.
MOST_WEIGHTS = 200_000
# Lengths of prefixes.
PREFIXES = (4, 5, 6, 7, 8)
# Pseudo-occurrences of the prior, and how often a word or prefix must occur for its own weight.
PRIOR, LEAST_COUNT = 5.0, 3
# A weight of its own must differ this much from that of the next shorter prefix.
LEAST_GAIN = 0.5
# What each token costs a segment.
DRIFT = 0.25
# Folds, by crc32 of the id modulo 5: weights come from these, the calibration from the last.
WEIGHT_FOLDS, CALIBRATION_FOLD = (1, 2, 3), 4
# Weights of pieces, and counts of words, that a process remembers; it starts anew when full.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 40
# Words longer than this are counted in stretches of this length.
LONGEST_WORD = 64
# Within a passage, a word adds nothing so many words after the place where it last counted.
REPEAT_DISTANCE = 50
_EULER = 0.5772156649015329

_edges = re.compile(r"^[\W_]+|[\W_]+$")
# Punctuation and symbols divide words, apostrophes and marks that belong to letters do not.
_DIVIDING = {c: " " for c in range(0x20000) if unicodedata.category(chr(c))[0] in "PS" and chr(c) not in "'’"}


def words_of(piece: str) -> list[str]:
    """The words in a piece between white space: lower case, without marks; one empty word if there is none."""
    lower = piece.lower()
    words = [lower] if piece.isalpha() else [w for part in lower.translate(_DIVIDING).split() if (w := _edges.sub("", part))]
    if len(piece) > LONGEST_WORD:
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return words or [""]


def segments(weights: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, past the last) of a sequence, in linear time.

    Only positive weights open a segment; what lies between two of them counts by its sum.
    """
    places = np.flatnonzero(weights > 0)
    if not len(places):
        return []
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    found: list[list] = []  # sum before, sum after, first, past the last, index of the last with a lower sum before
    for place in places.tolist():
        left, right, first = float(sums[place]), float(sums[place + 1]), place
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append([left, right, first, place + 1, j])
                break
            left, first = found[j][0], found[j][2]
            del found[j:]
    return [(right - left, first, last) for left, right, first, last, _ in found]


class Weigher:
    """Weights of texts' tokens under a table of words and prefixes (marked by a star)."""

    def __init__(self, table: dict[str, float], drift: float):
        self.table, self.drift = table, drift
        self.pieces: dict[str, float] = {}

    def weights(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """A weight for each word, and the number of its piece between white space.

        A word's repetitions within a passage add none: those that lie in one maximal segment, at most
        REPEAT_DISTANCE words after the place where the word last counted.
        """
        pieces, known = text.split(), self.pieces
        try:
            weights = np.array([known[piece] for piece in pieces], float)
        except KeyError:
            weights = np.array([known[piece] if piece in known else self._piece(piece) for piece in pieces], float)
        at, several = np.arange(len(pieces)), {}
        if (places := np.flatnonzero(np.isnan(weights))).size:
            several = {place: words_of(pieces[place]) for place in places.tolist()}
            counts = np.ones(len(pieces), np.int64)
            counts[places] = [len(words) for words in several.values()]
            at, weights, starts = np.repeat(at, counts), np.repeat(weights, counts), np.cumsum(counts) - counts
            weights[np.isnan(weights)] = [self._word(word) for words in several.values() for word in words]
        result = weights.copy()
        for _, first, past in segments(weights):
            counted: dict[str, int] = {}
            for place in (first + np.flatnonzero(weights[first:past] > 0)).tolist() if past - first > 1 else ():
                piece = int(at[place])
                words = several.get(piece)
                word = words[place - int(starts[piece])] if words else words_of(pieces[piece])[0]
                if word in counted and place - counted[word] <= REPEAT_DISTANCE:
                    result[place] = -self.drift
                else:
                    counted[word] = place
        return result, at

    def _word(self, word: str) -> float:
        table = self.table
        weight = table.get(word)
        for length in reversed(PREFIXES):
            if weight is None and len(word) >= length:
                weight = table.get(word[:length] + "*")
        return (weight or 0.0) - self.drift if word else 0.0

    def _piece(self, piece: str) -> float:
        """The weight of a piece of one word; not a number if it has several."""
        words = words_of(piece)
        weight = self._word(words[0]) if len(words) == 1 else math.nan
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            self.pieces[piece] = weight
        return weight


class Model:
    """Weights, the law of segment scores in clean text, and the curve from evidence to probability."""

    def __init__(self, table: dict[str, float], rate: float = 1.0, shift: float = 0.0, slope: float = 1.0,
                 start: float = -4.0):
        self.table = table
        self.rate, self.shift, self.slope, self.start = rate, shift, slope, start

    def to_json(self) -> str:
        return json.dumps([self.table, self.rate, self.shift, self.slope, self.start])


def _loaded(text: str) -> tuple[Model, Weigher]:
    model = Model(*json.loads(text))
    return model, Weigher(model.table, DRIFT)


def evidence(model: Model, found: list[tuple[float, int, int]], tokens: int) -> tuple[float, list]:
    """A text's evidence, and its significant segments with what each scores beyond the law.

    The best segment counts as it is, further ones as far as they are significant.
    """
    limit = model.shift + math.log(max(2, tokens))
    beyond = sorted(((model.rate * s - limit, first, last) for s, first, last in found), reverse=True)
    if not beyond:
        return -limit, []
    significant = [b for b in beyond if b[0] > 0]
    return beyond[0][0] + sum(b[0] for b in significant[1:]), significant


def probability(model: Model, value: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, model.slope * value + model.start))))


def _training(df: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Labelled rows of the training folds, with their fold; at most about ``most`` labels are used.

    The labels have a bounded size and are sent to the tasks, so that texts are not shuffled.
    """
    known = (
        labels.select(labels[id_col].alias("label_id"), labels[label_col].cast("double").alias("toxic"))
        .where("label_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("label_id")))
    )
    share = most / max(most, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    known = known.groupBy("label_id").agg((F.max("toxic") >= 0.5).alias("toxic"))
    rows = df.select(df[id_col].alias("id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    fold = (F.crc32(F.col("id").cast("string").cast("binary")) % 5).cast("int")
    return rows.join(F.broadcast(known), F.col("id") == F.col("label_id")).select("text", "toxic", fold.alias("fold"))


def _counted(batches: Batches) -> Batches:
    """Toxic and clean texts that hold each word; repetitions within a text say nothing more."""
    counts: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        words = pa.array(counts, pa.string())
        return pa.RecordBatch.from_arrays(
            [words, *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (1, 0))],
            names=["word", "toxic", "clean"],
        )

    for batch in parts(batches):
        for text, toxic in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
            for word in {word for piece in set(text.split()) for word in words_of(piece)}:
                if word not in counts:
                    counts[word] = [0, 0]
                counts[word][toxic] += 1
            if len(counts) >= REMEMBERED:
                yield rows()
                counts.clear()
    yield rows()


def learn_weights(training: DataFrame, scratch: Scratch) -> dict[str, float]:
    """Log-odds of words and prefixes; the counts stay in Spark, the strongest weights come here."""
    counts = map_batches(training.select("text", "toxic"), _counted, "word string, toxic long, clean long")
    counts = counts.where("word <> ''").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    counts = scratch.table(counts, "toxic_words")
    total = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    if not total.t or not total.c:
        return {}
    base = F.struct(*(F.lit(total[kind] / (total.t + total.c)).alias(kind) for kind in ("t", "c")))
    parts, shares = [], None
    for number, length in enumerate(PREFIXES):
        own = (
            counts.where(F.length("word") >= length)
            .groupBy(F.substring("word", 1, length).alias("stem"))
            .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
            .where(F.col("t") + F.col("c") >= LEAST_COUNT)
        )
        if number:
            up = shares.select(F.col("stem").alias("parent"), F.col("share").alias("prior"))
            own = own.join(up, F.substring("stem", 1, PREFIXES[number - 1]) == F.col("parent"), "left")
        else:
            own = own.withColumn("prior", base)
        shares = scratch.table(_shrunk(own, base), f"toxic_stems_{length}")
        parts.append(shares.withColumn("stem", F.concat("stem", F.lit("*"))))
    words = counts.where(F.col("t") + F.col("c") >= LEAST_COUNT).withColumnRenamed("word", "stem")
    prior = F.lit(None).cast("struct<t: double, c: double>")
    for length, stems in zip(PREFIXES, parts, strict=True):
        up = stems.select(F.col("stem").alias(f"p{length}"), F.col("share").alias(f"s{length}"))
        key = F.when(F.length("stem") >= length, F.concat(F.substring("stem", 1, length), F.lit("*")))
        words = words.join(up, key == F.col(f"p{length}"), "left")
        prior = F.coalesce(F.col(f"s{length}"), prior)
    parts.append(_shrunk(words.withColumn("prior", prior), base))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    odds = _odds(F.col("share"))
    gain = F.abs(odds - _odds(F.col("prior")))
    kept = (
        every.select("stem", (odds - math.log(total.t / total.c)).alias("weight"), gain.alias("gain"), "n")
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc(F.col("gain") * F.sqrt("n")), "stem")
        .limit(MOST_WEIGHTS)
        .select("stem", "weight")
        .toArrow()
    )
    return dict(zip(kept.column("stem").to_pylist(), kept.column("weight").to_pylist(), strict=True))


def _shrunk(counts: DataFrame, base: Column) -> DataFrame:
    """Shares of toxic and of clean occurrences, drawn towards the prior shares by pseudo-occurrences.

    Neither is the other one taken from 1: a share may come so close to 1 that this leaves nothing.
    """
    n = F.col("t") + F.col("c")
    prior = F.coalesce(F.col("prior"), base)
    share = F.struct(*(((F.col(kind) + PRIOR * prior[kind]) / (n + PRIOR)).alias(kind) for kind in ("t", "c")))
    return counts.select("stem", share.alias("share"), prior.alias("prior"), n.alias("n"))


def _odds(share: Column) -> Column:
    """Log-odds of toxic against clean."""
    return F.log(share["t"] / share["c"])


def calibrate(training: DataFrame, model: Model) -> Model:
    """Fit the extreme-value law on clean rows and the probability on all rows; histograms come here."""
    shared = training.sparkSession.sparkContext.broadcast(model.to_json())

    def clean_scores(batches: Batches) -> Batches:
        _, weigher = kept(_loaded, shared.value)
        for batch in parts(batches):
            bins, tops = {}, []
            for text in texts_of(batch, "text"):
                weights, _ = weigher.weights(text)
                for value, count in zip(*np.unique(np.round(weights, 1), return_counts=True), strict=True):
                    bins[float(value)] = bins.get(float(value), 0) + int(count)
                best = max((s for s, _, _ in segments(weights)), default=0.0)
                tops.append((round(best, 1), len(weights)))
            kinds = ["token"] * len(bins) + ["top"] * len(tops)
            values = [*bins, *(t[0] for t in tops)]
            counts = [*bins.values(), *(max(2, t[1]) for t in tops)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(values, pa.float64()), pa.array(counts, pa.int64())],
                names=["kind", "value", "count"],
            )

    clean = map_batches(
        training.where("NOT toxic").select("text"), clean_scores, "kind string, value double, count long"
    )
    # A row per value of a token's weight, to one decimal; tops are summed up, with their texts' lengths.
    summary = (
        clean.groupBy("kind", "value")
        .agg(F.sum("count").alias("count"), F.count("*").alias("rows"), F.sum(F.log("count")).alias("logs"))
        .toArrow()
        .to_pylist()
    )
    tokens = [(r["value"], r["count"]) for r in summary if r["kind"] == "token"]
    tops = [r for r in summary if r["kind"] == "top"]
    model.rate = _rate(np.array([v for v, _ in tokens]), np.array([c for _, c in tokens], float))
    if rows := sum(r["rows"] for r in tops):
        mean = sum(model.rate * r["value"] * r["rows"] - r["logs"] for r in tops) / rows
        model.shift = mean - _EULER
    shared_law = training.sparkSession.sparkContext.broadcast(model.to_json())

    def evidences(batches: Batches) -> Batches:
        law, weigher = kept(_loaded, shared_law.value)
        for batch in parts(batches):
            values = []
            for text in texts_of(batch, "text"):
                weights, _ = weigher.weights(text)
                values.append(evidence(law, segments(weights), len(weights))[0])
            values = np.clip(np.round(np.array(values, float) * 4) / 4, -40, 40)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.float64()), batch.column("toxic")], names=["value", "toxic"]
            )

    rows = map_batches(training.select("text", "toxic"), evidences, "value double, toxic boolean")
    bins = rows.groupBy("value", "toxic").agg(F.count("*").alias("n")).toArrow().to_pylist()
    model.slope, model.start = _logistic(
        np.array([b["value"] for b in bins]), np.array([b["toxic"] for b in bins], float),
        np.array([b["n"] for b in bins], float),
    )
    return model


def _rate(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive solution of: the mean of exp(rate * value) is 1; 1 if there is none."""
    if not counts.sum() or values.max() <= 0 or (values * counts).sum() >= 0:
        return 1.0
    share = counts / counts.sum()
    low, high = 1e-6, 1.0
    while (share * np.exp(np.minimum(high * values, 600))).sum() < 1 and high < 50:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        if (share * np.exp(np.minimum(middle * values, 600))).sum() < 1:
            low = middle
        else:
            high = middle
    return high


def _logistic(values: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0.05) and start of a logistic curve, with a small penalty, by Newton's method."""
    if not len(values) or toxic.min() == toxic.max():
        return 1.0, -4.0 if not len(values) or not toxic.max() else 0.0
    x = np.stack([values, np.ones_like(values)], 1)
    beta = np.zeros(2)
    penalty = np.array([1e-1, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (counts * (toxic - p)) - penalty * beta
        hessian = (x * (counts * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return max(0.05, float(beta[0])), float(beta[1])


def learn(
    df: DataFrame,
    labels: DataFrame,
    most_labels: int = MOST_LABELS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from labelled rows; held-out rows and rows without a label teach nothing."""
    scratch = Scratch(df.sparkSession)
    training = _training(df, labels, most_labels, id_col, text_col, label_col)
    table = learn_weights(training.where(F.col("fold").isin(*WEIGHT_FOLDS)), scratch)
    model = calibrate(training.where(F.col("fold") == CALIBRATION_FOLD), Model(table))
    scratch.drop(*scratch.names[:])
    return model


def clean_rows(
    df: DataFrame,
    labels: DataFrame,
    most_labels: int = MOST_LABELS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """Whole rows whose text is not predicted to be toxic; cases as in ``score_toxicity``."""
    shared = df.sparkSession.sparkContext.broadcast(
        learn(df, labels, most_labels, id_col, text_col, label_col).to_json()
    )

    def judge():
        model, weigher = kept(_loaded, shared.value)
        return lambda texts: [_scored(model, weigher, text)[0] < 0.5 for text in texts]

    return keep_rows(df, text_col, judge)


def _scored(model: Model, weigher: Weigher, text: str) -> tuple[float, list]:
    """A text's probability of being toxic, and its significant segments, in pieces between white space."""
    weights, at = weigher.weights(text)
    value, significant = evidence(model, segments(weights), len(weights))
    return probability(model, value), [(s, int(at[first]), int(at[last - 1]) + 1) for s, first, last in significant]


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    most_labels: int = MOST_LABELS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``passages`` of every row.

    ``score`` is the probability that the whole text is toxic, ``predicted`` 1 from 0.5 on.
    ``passages`` are its significant segments, in order: first and past-the-last word (words stand
    between white space) and the score beyond the law of clean text. Learned from labelled rows
    outside the held-out fold only; labels, languages, sources and ids are no inputs of a score.

    Null and empty texts have the evidence of an empty text. Null ids are held out and stay null,
    repeated rows are scored each on its own, an id with several labels counts as toxic if one says
    so, other columns are not read, and an empty table gives an empty result. Without labels of both
    kinds all scores are low.
    """
    model = learn(df, labels, most_labels, id_col, text_col, label_col)
    shared = df.sparkSession.sparkContext.broadcast(model.to_json())
    passage = T.StructType(
        [T.StructField(n, T.IntegerType()) for n in ("first", "past")] + [T.StructField("score", T.DoubleType())]
    )
    schema = T.StructType(
        [
            *fields(df, {"doc_id": id_col}),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
            T.StructField("passages", T.ArrayType(passage)),
        ]
    )

    def scored(batches: Batches) -> Batches:
        own, weigher = kept(_loaded, shared.value)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32()), ("score", pa.float64())]))
        for batch in parts(batches):
            scores, passages = [], []
            for text in texts_of(batch, "text"):
                score, significant = _scored(own, weigher, text)
                scores.append(score)
                passages.append(
                    [{"first": f, "past": p, "score": s} for s, f, p in sorted(significant, key=lambda x: x[1])]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("held_out"),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(passages, kind),
                ],
                names=["doc_id", "held_out", "score", "predicted", "passages"],
            )

    rows = df.select(df[id_col].alias("id"), held_out(df[id_col]).alias("held_out"), df[text_col].alias("text"))
    return map_batches(rows, scored, schema)
