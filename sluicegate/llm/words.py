"""Hashed words and word n-grams of many texts at once, on the bytes of Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEEDS = np.random.default_rng(20_011)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# White space and ASCII marks.
_GAP = _SPACE.copy()
_GAP[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
# A random number for each byte; A-Z have those of a-z.
_VALUE = _SEEDS.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_PLACE = _SEEDS.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers = {}
# Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2^64, and of its inverse."""
    if not _powers or len(_powers["up"]) < count:
        size = max(count, SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:count], _powers["down"]


def forget() -> None:
    """Drop the powers; they are made again when needed."""
    _powers.clear()


def word_hashes(data: np.ndarray, bounds: np.ndarray, marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in order.

    ``data`` holds UTF-8 bytes, text ``i`` those from ``bounds[i]`` to ``bounds[i + 1]``. Words are
    runs of bytes other than ASCII white space, and with ``marks`` other than ASCII marks; A-Z count
    as a-z.
    """
    start, end, owner = word_spans(data, bounds, _GAP if marks else _SPACE)
    return span_hashes(data, start, end), owner


def word_spans(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes that a table of 256 flags doesn't call a gap."""
    solid = ~gap[data]
    if not solid.any():
        return (np.zeros(0, np.int64),) * 3
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = bounds[1:] > bounds[:-1]
    edges = bounds[:-1][full]
    first[edges] = solid[edges]
    edges = bounds[1:][full] - 1
    last[edges] = solid[edges]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(bounds[1:], start, side="right")


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    """A 64-bit hash of every span of bytes, from a random number for each byte value."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up, out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def byte_values(seed: int) -> np.ndarray:
    """Random numbers for ``span_hashes``; A-Z have those of a-z."""
    values = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def gram_hashes(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``size`` words; of all words of a text that has fewer."""
    if not len(words):
        return words, text
    found, owner = [], []
    if len(words) >= size:
        at = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :])
        total = np.zeros(len(at), np.uint64)
        for j in range(size):
            total += words[at + j] * _PLACE[j]
        found.append(mix(total))
        owner.append(text[at])
    starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    counts = np.diff(np.r_[starts, len(text)])
    for count in range(1, size):
        at = starts[counts == count]
        total = np.full(len(at), count, np.uint64) * _PLACE[size]
        for j in range(count):
            total += words[at + j] * _PLACE[j]
        found.append(mix(total))
        owner.append(text[at])
    return np.concatenate(found), np.concatenate(owner)


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of neighbouring texts, with their bytes and the bounds of each; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        stop = min(len(column), max(stop, start + 1))
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def gram_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every text, in order."""
    for start, stop, data, bounds in text_slices(column):
        grams, owner = gram_hashes(*word_hashes(data, bounds), size)
        order = np.argsort(owner, kind="stable")
        grams, ends = grams[order], np.cumsum(np.bincount(owner, minlength=stop - start))
        begin = 0
        for end in ends:
            yield np.unique(grams[begin:end])
            begin = end
