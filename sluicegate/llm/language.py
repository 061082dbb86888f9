"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ones and minus ones. The vector of a run of letters is the product
of its letters' vectors, each rotated by its place; a text's vector is the sum over its runs. A
language's is the sum of its training texts' vectors, each of length 1, so that long texts have no
more say. A text's language is the prototype of the highest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, fields, held_out, kept, map_batches, parts, slices, texts_of

UNDETERMINED = "und"
DIMENSIONS = 1024
# Languages a model may have: prototypes of this many times the dimensions go to the driver.
MOST_LANGUAGES = 1000
# Vectors of runs that a process remembers; they are made anew from their letters when needed.
REMEMBERED = 40_000
_BOUNDARY = 0
_BITS = 21  # of a code point


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class RunVectors:
    """Vectors of letter runs."""

    _letter_table: np.ndarray | None = None

    def __init__(self, dimensions: int, size: int, seed: int):
        self.dimensions, self.size, self.seed = dimensions, size, seed
        self.letter: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.known = np.zeros((1024, dimensions), np.int8)
        if RunVectors._letter_table is None:
            RunVectors._letter_table = _letters()

    def runs(self, text: str) -> np.ndarray:
        """A number for every run of letters and word boundaries, in lower case; none if no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self._letter_table[points]
        if not letter.any():
            return np.zeros(0, np.int64)
        # Each stretch without letters is one boundary; so are both ends.
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        row = np.r_[_BOUNDARY, np.where(letter, points, _BOUNDARY)[keep], _BOUNDARY].astype(np.int64)
        if row[1] == _BOUNDARY:
            row = row[1:]
        if row[-2] == _BOUNDARY:
            row = row[:-1]
        runs = np.zeros(max(1, len(row) - self.size + 1), np.int64)
        for j in range(self.size):
            part = row[j : j + len(runs)]
            runs[: len(part)] = runs[: len(part)] << _BITS | part
        return runs

    def _letter_vector(self, point: int) -> np.ndarray:
        if point not in self.letter:
            source = np.random.default_rng([self.seed, point])
            self.letter[point] = source.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.letter[point]

    def _vector(self, run: int) -> np.ndarray:
        bound = np.ones(self.dimensions, np.int8)
        for j in range(self.size):
            point = run >> _BITS * (self.size - 1 - j) & (1 << _BITS) - 1
            bound *= np.roll(self._letter_vector(point), self.size - 1 - j)
        return bound

    def bundles(self, runs: list[np.ndarray]) -> np.ndarray:
        """The sum of the runs' vectors, for every text."""
        counted = [np.unique(own, return_counts=True) for own in runs]
        distinct = np.unique(np.concatenate([found for found, _ in counted])) if runs else np.zeros(0, np.int64)
        total = np.zeros((len(runs), self.dimensions), np.float32)
        for start in range(0, len(distinct), REMEMBERED):
            part = distinct[start : start + REMEMBERED]
            counts = np.zeros((len(runs), len(part)), np.float32)
            for text, (found, number) in enumerate(counted):
                at = np.searchsorted(part, found)
                own = part[np.minimum(at, len(part) - 1)] == found
                counts[text, at[own]] = number[own]
            total += counts @ self._rows(part.tolist()).astype(np.float32)
        return total

    def _rows(self, runs: list[int]) -> np.ndarray:
        if len(self.place) + len(runs) > 2 * REMEMBERED:
            self.place.clear()
            self.letter.clear()
        rows = [self._row(run) for run in runs]
        return self.known[rows]

    def _row(self, run: int) -> int:
        row = self.place.get(run)
        if row is None:
            row = self.place[run] = len(self.place)
            if row == len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.known[row] = self._vector(run)
        return row


def prototypes(
    df: DataFrame,
    dimensions: int = DIMENSIONS,
    size: int = 3,
    seed: int = 7,
    text_col: str = "text",
    lang_col: str = "lang",
) -> dict[str, np.ndarray]:
    """Summed vectors of the languages of a frame; rows without a language teach nothing.

    Every task adds its texts up to one vector per language, and the vectors are added up by
    dimension. At most 1000 languages, whose vectors go to the driver; more are an error.
    """
    options = dimensions, size, seed

    def summed(batches: Batches) -> Batches:
        vectors = kept(RunVectors, *options)
        sums: dict[str, np.ndarray] = {}
        for batch in parts(batches):
            languages, texts = batch.column("lang").to_pylist(), texts_of(batch, "text")
            for start, end in slices(texts):
                for lang in sorted(set(languages[start:end])):
                    own = [vectors.runs(t) for t, x in zip(texts[start:end], languages[start:end]) if x == lang]
                    bundles = vectors.bundles(own).astype(np.float64)
                    lengths = np.maximum(1, np.linalg.norm(bundles, axis=1, keepdims=True))
                    sums[lang] = sums.get(lang, 0) + (bundles / lengths).sum(0)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * dimensions),
                    pa.array(range(dimensions), pa.int32()),
                    pa.array(vector, pa.float64()),
                ],
                names=["lang", "dimension", "value"],
            )

    rows = df.select(df[lang_col].cast("string").alias("lang"), df[text_col].alias("text")).where("lang IS NOT NULL")
    total = map_batches(rows, summed, "lang string, dimension int, value double")
    total = total.groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
    found = total.limit(MOST_LANGUAGES * dimensions + 1).toArrow()
    if len(found) > MOST_LANGUAGES * dimensions:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    result: dict[str, np.ndarray] = {}
    for lang, dimension, value in zip(*(found.column(i).to_pylist() for i in range(3)), strict=True):
        result.setdefault(lang, np.zeros(dimensions))[dimension] = value
    return {lang: result[lang] for lang in sorted(result) if result[lang].any()}


def identify(
    df: DataFrame,
    training: DataFrame | None = None,
    dimensions: int = DIMENSIONS,
    size: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    ``training`` has texts with languages; by default the rows of ``df`` whose crc32 of the id, as
    text, is not divisible by 5 (``held_out`` marks the others). Whole texts are read, in training
    and in prediction; nothing but the text decides a prediction. ``score`` is the cosine with the
    language's prototype, at least 0. Ties go to the language that comes first by name.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if there was
    nothing to learn from. Null ids are held out and stay null, repeated rows are predicted each on
    its own, other columns are not read, and an empty table gives an empty result.
    """
    if training is None:
        training = df.where(~held_out(df[id_col]))
    learned = prototypes(training, dimensions, size, seed, text_col, lang_col)
    names = list(learned)
    matrix = np.array([v / np.linalg.norm(v) for v in learned.values()]).reshape(-1, dimensions)
    options = dimensions, size, seed

    def scores(texts: list[str]) -> Iterator[tuple[str, float]]:
        vectors = kept(RunVectors, *options)
        runs = [vectors.runs(text) for text in texts]
        bundles = vectors.bundles(runs).astype(np.float64)
        lengths = np.maximum(np.linalg.norm(bundles, axis=1), 1e-9)
        for own, cosines in zip(runs, bundles @ matrix.T / lengths[:, None], strict=True):
            if len(own) and names:
                best = int(np.argmax(cosines))
                yield names[best], min(1.0, max(0.0, float(cosines[best])))
            else:
                yield UNDETERMINED, 0.0

    def predicted(batches: Batches) -> Batches:
        for batch in parts(batches):
            texts = texts_of(batch, "text")
            found = [one for start, end in slices(texts) for one in scores(texts[start:end])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    schema = T.StructType(
        [
            *fields(df, {"doc_id": id_col}),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    rows = df.select(df[id_col].alias("id"), held_out(df[id_col]).alias("held_out"), df[text_col].alias("text"))
    return map_batches(rows, predicted, schema)
