"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Text of one Arrow batch that is worked on at once.
SLICE_BYTES = 4 << 20


def rows_of(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator reads, so that others cannot clash with its own."""
    return docs.select(*(F.col(f"`{name}`") for name in columns))


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """``crc32(doc_id as text) mod buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut batches so that a slice holds about ``limit`` bytes of ``column``.

    Yields each slice and its texts, nulls read as empty. A single longer text is a slice
    of its own.
    """
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        text = pc.fill_null(text.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start), text.slice(start, stop - start)
            start = stop


def ascii_words(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts and the row each belongs to."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    words = pc.list_flatten(lists)
    row = pc.list_parent_indices(lists)
    filled = pc.greater(pc.binary_length(words), 0)
    if not pc.all(filled).as_py():
        words, row = words.filter(filled), row.filter(filled)
    return words, row.to_numpy(zero_copy_only=False).astype(np.int64)


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of GNU's library only
    if trim:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (SplitMix64's output step)."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string, the same in all tasks."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, strings.to_pylist()), np.uint64, len(strings))


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of words; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    table = string_hashes(coded.dictionary)
    return table[coded.indices.to_numpy(zero_copy_only=False)]


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _table_of(base: np.uint64, length: int) -> np.ndarray:
    table = np.full(length, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2**64.

    Tables of the usual size stay with the Python worker; those of a single long text do not.
    """
    if length > 2 * SLICE_BYTES:
        return tuple(_table_of(base, length) for base in (_BASE, _BASE_INVERSE))
    if len(_powers["up"]) < length:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            _powers[name] = _table_of(base, length)
    return _powers["up"], _powers["down"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large-string (or large-binary) array and where each text begins."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` and, per text, how many it has."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    space = _SPACES[data]
    edge = np.append(space, True)
    filled = offsets[:-1] < offsets[1:]
    before = np.roll(edge, 1)[:-1]
    before[offsets[:-1][filled]] = True
    after = edge[1:].copy()
    after[offsets[1:][filled] - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    counts = np.searchsorted(starts, offsets, side="left")
    return hashes, np.diff(counts)
