"""Finding benchmark passages in documents, edits allowed."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, rows_of, slices
from .stages import ship_package

Q = 8  # characters of a gram; grams are hashed by three doublings
_BLOCK = 32  # positions whose hits are counted together in the first filter
_SLOTS = 22  # bits of the table of gram hashes
# Places of a gram in one pattern above which its hits are counted for every diagonal alike.
REPEATED = 8
_HITS = 1 << 21  # pairs of a position and a pattern's place that are counted at once
_DIAGONALS = 1 << 14  # of one alignment; a wider stretch is aligned in overlapping parts
_MATCH = "doc_id {id}, item_id {item}, distance long, start long, `end` long, item_chars long"


def normal(text: str) -> str:
    """Lower case, runs of white space as one space."""
    return re.sub(r"\s+", " ", text.lower()).strip()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` characters from every position."""
    if len(points) < Q:
        return np.zeros(0, np.uint32)
    one = points * np.uint32(0x9E3779B1)
    one ^= one >> np.uint32(15)
    two = one[:-1] * np.uint32(0x85EBCA6B) + one[1:]
    four = two[:-2] * np.uint32(0xC2B2AE35) + two[2:]
    eight = four[:-4] * np.uint32(0x27D4EB2F) + four[4:]
    return eight ^ (eight >> np.uint32(13))


@dataclass
class Pattern:
    item: object
    points: np.ndarray
    budget: int  # edits
    needed: int  # grams an occurrence within the budget shares with it

    @property
    def longest(self) -> int:
        return len(self.points) + self.budget


def patterns(items: list[tuple], error_rate: float, window: int) -> list[Pattern]:
    """Items as search patterns; longer ones are cut into overlapping windows.

    The q-gram lemma: a text within ``e`` edits of ``m`` characters shares at least
    ``m - Q + 1 - Q·e`` of its grams. The budget is lowered where that is below one.
    """
    found = []
    for item, text in items:
        points = _points(normal(text or ""))
        starts = range(0, max(1, len(points) - window // 2), window // 2)
        for start in starts:
            own = points[start : start + window]
            if len(own) < Q:
                continue
            budget = min(int(error_rate * len(own)), (len(own) - Q) // Q)
            found.append(Pattern(item, own, budget, len(own) - Q + 1 - Q * budget))
    return found


def banded_distance(pattern: np.ndarray, text: np.ndarray, first: int, width: int, budget: int) -> tuple[int, int]:
    """Least edits that turn ``pattern`` into a part of ``text``, on a band of diagonals.

    Diagonals ``first … first + width - 1`` (text minus pattern position) are filled. The
    part may begin and end anywhere. Returns the distance and the part's end; stops early
    with ``budget + 1`` when no cell is within the budget.
    """
    far = budget + 1
    small = np.int16 if width + far < 1 << 15 else np.int64
    step = np.arange(width, dtype=small)
    row = np.full(width, far, small)
    # Text position of each diagonal before the current row: from 0 to the text's length.
    row[max(0, -first) : max(0, len(text) - first + 1)] = 0
    for i, c in enumerate(pattern):
        at = first + i  # text index that the first diagonal compares with pattern[i]
        low = min(width, max(0, -at))
        high = max(low, min(width, len(text) - at))
        new = row + small(1)
        new[low:high] -= text[at + low : at + high] == c
        new[:low] = far
        new[high:] = far
        # A pattern character without one in the text comes from the next diagonal; with
        # i + 1 characters read, diagonal d stands at text position first + d + i + 1.
        np.minimum(new[:-1], row[1:] + small(1), out=new[:-1])
        new[: max(0, -at - 1)] = far
        new[max(0, len(text) - at) :] = far
        # Text characters without one in the pattern: along the row.
        new -= step
        np.minimum.accumulate(new, out=new)
        new += step
        row = np.minimum(new, small(far))
        if row.min() > budget:
            return far, -1
    best = int(row.argmin())
    return int(row[best]), first + best + len(pattern)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


class Index:
    """The grams of one block of patterns."""

    def __init__(self, found: list[Pattern]):
        self.patterns = found
        grams = [_grams(p.points) for p in found]
        self.hash = np.concatenate(grams) if grams else np.zeros(0, np.uint32)
        self.pattern = np.repeat(np.arange(len(found)), [len(g) for g in grams])
        self.place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else self.pattern
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.pattern, self.place = self.hash[order], self.pattern[order], self.place[order]
        # Grams that a pattern repeats, as entries (hash, pattern) of their own.
        self.rare, self.repeated = self._by_repeats()
        self.used = np.zeros(1 << _SLOTS, bool)
        self.used[self.hash >> np.uint32(32 - _SLOTS)] = True
        self.budget = np.array([p.budget for p in found], np.int64)
        self.needed = np.array([p.needed for p in found], np.int64)
        # An occurrence lies in this many blocks at most, so one of them has its share.
        self.dense = min(
            (-(-p.needed // (-(-p.longest // _BLOCK) + 1)) for p in found), default=1
        )

    def hits(self, points: np.ndarray) -> np.ndarray:
        """Whether each position's gram is one of a pattern's."""
        grams = _grams(points)
        maybe = np.flatnonzero(self.used[grams >> np.uint32(32 - _SLOTS)])
        at = np.searchsorted(self.hash, grams[maybe])
        at[at == len(self.hash)] = 0
        out = np.zeros(len(points), bool)
        out[maybe[self.hash[at] == grams[maybe]]] = True
        return out

    def _by_repeats(self) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, np.ndarray]]:
        """Entries of grams that a pattern has in few places, and the others once each."""
        order = np.lexsort((self.pattern, self.hash))
        grams, pattern, place = self.hash[order], self.pattern[order], self.place[order]
        new = np.r_[True, (grams[1:] != grams[:-1]) | (pattern[1:] != pattern[:-1])] if len(grams) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        many = np.diff(np.r_[first, len(grams)]) > REPEATED
        keep = ~np.repeat(many, np.diff(np.r_[first, len(grams)]))
        return (grams[keep], pattern[keep], place[keep]), (grams[first[many]], pattern[first[many]])

    def _counted(self, where: np.ndarray, grams: np.ndarray, offset: int, span: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(pattern * span + band, hits)`` of rare grams, whole bands, part by part.

        Positions are taken in order, as many at once as give ``_HITS`` hits; bands that
        later positions cannot reach are given out, the others are carried on.
        """
        entries, patterns, places = self.rare
        low = np.searchsorted(entries, grams, side="left")
        size = np.searchsorted(entries, grams, side="right") - low
        where, low, size = where[size > 0], low[size > 0], size[size > 0]
        length = np.array([len(p.points) for p in self.patterns], np.int64)
        upto = np.cumsum(size)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = 0
        while start < len(where):
            base = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, base + _HITS, side="right")))
            own = size[start:stop]
            entry = np.repeat(low[start:stop] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            pattern = patterns[entry]
            band = (np.repeat(where[start:stop], own) - places[entry] + offset) // (self.budget[pattern] + 1)
            found, hits = np.unique(pattern * span + band, return_counts=True)
            keys, counts = _summed(np.r_[keys, found, found - 1], np.r_[counts, hits, hits])
            start = stop
            if start < len(where):
                pattern, band = np.divmod(keys, span)
                last = (band + 2) * (self.budget[pattern] + 1) - offset + length[pattern]
                done = last < where[start]
                yield keys[done], counts[done]
                keys, counts = keys[~done], counts[~done]
        yield keys, counts

    def regions(self, points: np.ndarray, hit: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Pattern, first diagonal and number of diagonals of stretches that meet the bound.

        Bands are ``2(e+1)`` diagonals wide and begin every ``e+1``, so that any ``e+1``
        neighbouring diagonals lie within one. Bands that overlap are one stretch. A gram
        that a pattern repeats counts for all bands in reach of its position, which can
        only let more bands through.
        """
        where = np.flatnonzero(hit)
        grams = _grams(points)[where]
        # So that every band, and the one before it, has a number from 0.
        offset = max((p.longest for p in self.patterns), default=0) + 2
        span = np.int64(len(points) + 2 * offset + 2)
        known = np.unique(self.repeated[1][np.isin(self.repeated[0], grams)])
        found, aside = [], []
        for keys, counts in self._counted(where, grams, offset, span):
            pattern = keys // span
            found.append(keys[counts >= self.needed[pattern]])
            if len(known):
                own = np.isin(pattern, known)
                aside.append((keys[own], counts[own]))
        if len(known):
            rare, counts = (np.concatenate(x) for x in zip(*aside))
            for p in known.tolist():
                step, length = self.budget[p] + 1, len(self.patterns[p].points)
                mine = where[np.isin(grams, self.repeated[0][self.repeated[1] == p])]
                bands = np.arange((len(points) + 2 * offset) // step + 1)
                first = bands * step - offset
                reached = np.searchsorted(mine, first + 2 * step + length) - np.searchsorted(mine, first)
                own = rare // span == p
                reached[rare[own] - p * span] += counts[own]
                found.append(p * span + bands[reached >= self.needed[p]])
        keys = np.unique(np.concatenate(found))
        if not len(keys):
            return
        pattern, band = np.divmod(keys, span)
        first = np.flatnonzero(np.r_[True, (pattern[1:] != pattern[:-1]) | (band[1:] > band[:-1] + 2)])
        last = np.r_[first[1:], len(keys)] - 1
        for p, low, high in zip(pattern[first].tolist(), band[first].tolist(), band[last].tolist()):
            step = int(self.budget[p]) + 1
            yield p, low * step - offset, (high - low + 2) * step

    def search(self, points: np.ndarray, hit: np.ndarray) -> dict[object, tuple[int, int, int]]:
        """Best occurrence ``(distance, start, end)`` of every item that occurs.

        A stretch is aligned in parts that overlap by what the edits may move. Parts that
        begin behind an exact occurrence of their item cannot better it and are left out.
        """
        best: dict[object, tuple[int, int, int]] = {}
        for number, first, width in self.regions(points, hit):
            own = self.patterns[number]
            low, end_of = first - own.budget, first + width + own.budget
            while True:
                known = best.get(own.item)
                if known and known[0] == 0 and known[1] <= max(0, low):
                    break
                part = min(end_of - low, _DIAGONALS)
                distance, end = banded_distance(own.points, points, low, part, own.budget)
                if distance <= own.budget:
                    start = max(0, end - len(own.points))
                    best[own.item] = min(known or (distance, start, end), (distance, start, end))
                if low + part >= end_of:
                    break
                low += part - 2 * (own.budget + 1)
        return best


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """Benchmark rows in blocks of bounded text."""
    block, size = [], 0
    for row in benchmark.toLocalIterator():
        block.append(tuple(row))
        size += len(row[1].encode())
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.08,
    window: int = 512,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """Every pair of a document and a benchmark item that occurs in it.

    Texts are compared in lower case with white space as single spaces. An item occurs
    where some part of the document is within ``error_rate`` edits per character of it,
    or, for items longer than ``window`` characters, of one of its overlapping windows.
    Shared 8-grams are counted in overlapping diagonal bands; bands that reach the q-gram
    lemma's bound are verified by banded alignment. The counting loses no occurrence;
    documents without a dense stretch of shared grams are left out before it. Repetitive
    texts: hits are counted in parts, overlapping bands are aligned as one, and a gram that
    an item has in more than ``REPEATED`` places counts for all bands in reach.

    The benchmark is the stated query set: it is searched in blocks of ``block_bytes`` of
    its text, each sent to all tasks and run over all rows. Nothing is shuffled.

    Returns ``doc_id``, ``item_id``, ``distance``, ``start``, ``end`` (code points of the
    normalised text; the start assumes no net insertions) and ``item_chars``. Null texts
    count as empty; items of fewer than 8 characters and empty texts match nothing;
    repeated documents give repeated rows; an item repeated under one id gives one row;
    null ids pass through; other columns are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    plain = rows_of(docs, id_col, text_col).toDF("doc_id", "text")
    items = rows_of(benchmark, item_id_col, item_text_col).toDF("item_id", "text").dropna(subset=["text"])
    schema = _MATCH.format(id=dict(plain.dtypes)["doc_id"], item=dict(items.dtypes)["item_id"])
    id_type = plain.select("doc_id").limit(0).toArrow().schema[0].type
    item_type = items.select("item_id").limit(0).toArrow().schema[0].type
    parts = []
    for block in _blocks(items, block_bytes):
        index = Index(patterns(block, error_rate, window))
        shared = spark.sparkContext.broadcast(index)

        def match(batches, shared=shared):
            own = shared.value
            size = {}
            for p in own.patterns:
                size[p.item] = max(size.get(p.item, 0), len(p.points))
            for batch, texts in slices(batches, "text", SLICE_BYTES // 2):
                plain = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(texts), r"[\s\v\x1c-\x1f\x{85}\p{Z}]+", " "), " ")
                ends = np.cumsum(pc.utf8_length(plain).to_numpy(zero_copy_only=False))
                points = _points("".join(plain.to_pylist()))
                if not len(points):
                    continue
                hit = own.hits(points)
                starts = np.r_[0, ends[:-1]]
                blocks = np.add.reduceat(hit, np.arange(0, len(hit), _BLOCK), dtype=np.int64)
                dense = np.flatnonzero(blocks >= own.dense) * _BLOCK
                # Blocks do not end where texts do: both texts of a block are looked at.
                rows = np.unique(
                    np.concatenate(
                        [np.searchsorted(ends, np.minimum(dense + k, len(hit) - 1), side="right") for k in range(_BLOCK)]
                    )
                )
                ids, found = batch.column(0), []
                for row in rows.tolist():
                    a, b = int(starts[row]), int(ends[row])
                    inside = hit[a:b].copy()
                    inside[max(0, b - a - Q + 1) :] = False
                    for item, (distance, start, end) in own.search(points[a:b], inside).items():
                        found.append((row, item, distance, start, end, size[item]))
                if found:
                    row, item, *numbers = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(row)), pa.array(item, item_type), *(pa.array(x, pa.int64()) for x in numbers)],
                        ["doc_id", "item_id", "distance", "start", "end", "item_chars"],
                    )

        parts.append(plain.mapInArrow(match, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    found = reduce(DataFrame.unionAll, parts)
    if len(parts) == 1:
        return found
    # An item's windows or repeats may lie in several blocks.
    best = F.min(F.struct("distance", "start", "end", "item_chars")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
