"""What the operators share: training folds, tables on shared storage, texts of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any, TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm import words
from sluicegate.queries.staging import workspace
from sluicegate.sources.files import SharedFiles

Batches = Iterator[pa.RecordBatch]
Kept = TypeVar("Kept")
# Texts handled at once inside a task, in characters; a longer text is handled alone.
SLICE_CHARS = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text is divisible by 5.

    A null id counts as held out, so that nothing is learned from it.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def find_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def map_batches(
    df: DataFrame,
    function: Callable[[Batches], Batches],
    schema: T.StructType | str,
    owner: str | None = None,
) -> DataFrame:
    """``mapInArrow`` with workers that find this package and forget what other modules kept."""
    find_on_workers(df.sparkSession)
    module = owner or function.__module__

    def run(batches: Batches) -> Batches:
        forget_others(module)
        return function(batches)

    return df.mapInArrow(run, schema)


def fields(df: DataFrame, names: dict[str, str]) -> T.StructType:
    """Schema fields of columns under new names, with the types they have in a frame."""
    return T.StructType([T.StructField(new, df.schema[old].dataType) for new, old in names.items()])


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """A column's texts; null is the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


_kept: dict[tuple, Any] = {}


def kept(make: Callable[..., Kept], *arguments: Any) -> Kept:
    """What a function made of these arguments, kept by the worker process until another is asked for.

    Only one thing is kept, so that the operators of a pipeline do not add up their memory.
    """
    key = make.__module__, make.__qualname__, *arguments
    if key not in _kept:
        _kept.clear()
        _kept[key] = make(*arguments)
    return _kept[key]


_ran = ""


def forget_others(module: str) -> None:
    """Give back what another module's tasks left in this worker: its tables, and memory that is free."""
    global _ran
    if _ran == module:
        return
    _ran = module
    if any(key[0] != module for key in _kept):
        _kept.clear()
    words.forget()
    gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory to the system. The C library keeps it unless asked; only glibc has such a call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def parts(batches: Batches, rows: int = 1024) -> Batches:
    """Batches cut into some that take little memory as Python objects."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts that hold at most so many characters, or one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def keep_rows(
    df: DataFrame, text_col: str, judge: Callable[[], Callable[[list[str]], list[bool]]]
) -> DataFrame:
    """Whole rows whose text a judge keeps. ``judge`` is called once per task; nothing is shuffled."""

    def chosen(batches: Batches) -> Batches:
        keep = judge()
        for batch in parts(batches):
            yield batch.filter(pa.array(keep(texts_of(batch, text_col)), pa.bool_()))

    return map_batches(df, chosen, df.schema, judge.__module__)


def bit_filter(places: DataFrame, bits: int) -> bytes:
    """A bit for each of ``bits`` places, set where a row of ``place`` names it; joined in the tasks."""
    words = (
        places.groupBy(F.expr("shiftright(place, 6)").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    found = np.zeros(-(-bits // 64), np.int64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return found.tobytes()


def chosen_by(bits: bytes, places: np.ndarray) -> np.ndarray:
    """Which places a bit filter has."""
    octets = np.frombuffer(bits, np.uint8)[places >> 3]
    return octets >> (places & 7).astype(np.uint8) & 1 == 1


class Scratch:
    """Tables of one query in the folder that all executors share.

    Writing a table cuts the lineage: lost executors cost at most the step that is running.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = workspace(spark)
        self.names: list[str] = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        files = SharedFiles(self.spark)
        for name in names:
            if name in self.names:
                files.delete(f"{self.folder}/{name}")
                self.names.remove(name)
