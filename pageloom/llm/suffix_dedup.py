"""Removing long byte strings that occur more than once in the corpus."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from .common import mixed, powers, rows_of, slices, text_bytes
from .stages import ship_package, stored
from .suffix_sort import repeated

_SLICE = 2 << 20
# Different segments at one anchor that are sorted together.
CELL_ROWS = 512
# Segments that one sorting task call gets, roughly.
BUCKET_ROWS = 4_000
# Offsets of one part of a segment whose cell is larger.
PART = 25
_MASK = (1 << 64) - 1


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def _leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of every ``width`` neighbouring values."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    top = np.iinfo(np.uint64).max
    grid = np.full(blocks * width, top, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(blocks, width)
    column = np.arange(width)
    head = np.minimum.accumulate(grid, axis=1)
    fell = np.ones_like(grid, bool)
    fell[:, 1:] = head[:, 1:] < head[:, :-1]
    head_at = np.maximum.accumulate(np.where(fell, column, 0), axis=1)
    back = grid[:, ::-1]
    tail = np.minimum.accumulate(back, axis=1)
    fell = np.ones_like(grid, bool)
    fell[:, 1:] = back[:, 1:] <= tail[:, :-1]
    tail_at = np.maximum.accumulate(np.where(fell, column, 0), axis=1)
    base = np.arange(blocks)[:, None] * width
    head_at = (base + head_at).ravel()
    tail_at = (base + width - 1 - tail_at[:, ::-1]).ravel()
    head, tail = head.ravel(), tail[:, ::-1].ravel()
    left, right = tail[:count], head[width - 1 : width - 1 + count]
    return np.where(left <= right, tail_at[:count], head_at[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """Anchors of all windows of ``length`` bytes of the texts in ``data``.

    A window's anchor is its leftmost half-length gram of least hash, so equal windows
    have equal anchors at equal places. Returns, per anchor of a run of neighbouring
    windows: the text's number, hash of the anchor, hash of the segment (all bytes of the
    run's windows), the anchor's place in the text, its place in the segment, and the
    number of windows.
    """
    gram = length // 2
    width = length - gram + 1
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return (empty,) * 6
    sums, down = _prefix_sums(data)
    hashes = mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    place = _leftmost_minima(hashes, width)
    starts = np.arange(len(place))
    row = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts + length <= offsets[row + 1]
    starts, row, place = starts[inside], row[inside], place[inside]
    if not len(starts):
        return (empty,) * 6
    new = np.r_[True, (np.diff(place) != 0) | (np.diff(row) != 0)]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(starts)])
    begin, row, place = starts[first], row[first], place[first]
    end = begin + count - 1 + length
    segment = (sums[end] - sums[begin]) * down[begin]
    shape = (count.astype(np.uint64) << np.uint64(20)) + (place - begin).astype(np.uint64)
    segment = mixed(mixed(segment) + shape)
    return row, hashes[place].view(np.int64), segment.view(np.int64), place - offsets[row], place - begin, count


def _emit(docs: DataFrame, length: int) -> DataFrame:
    """Anchors of every different text of a task."""

    def emit(batches):
        seen: set[int] = set()
        for batch, texts in slices(batches, "text", _SLICE):
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            new = np.zeros(len(keys), bool)
            for i, key in enumerate(keys.tolist()):
                new[i] = key not in seen
                seen.add(key)
            keys = keys[new]
            data, offsets = text_bytes(texts.filter(pa.array(new)))
            row, hashes, segment, at, back, count = anchors(data, offsets, length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (hashes, segment, keys[row], at, back, count)],
                ["hash", "seg", "key", "at", "back", "windows"],
            )

    return docs.select("key", "text").mapInArrow(
        emit, "hash long, seg long, key long, at long, back long, windows long"
    )


def _cut(found: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments asked for; those of large cells in parts.

    ``found`` has a text and its segments ``(hash, seg, n, at, back, windows, large)``. A
    part has the windows of ``PART`` neighbouring offsets; its cell is named by the bytes
    that they all share, so that only segments which agree on these meet.
    """

    def cut(batches):
        import xxhash

        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode()
                for s in wanted:
                    begin, total, at = s["at"] - s["back"], s["windows"], s["at"]
                    parts = _aligned(begin, total, at) if s["large"] else [(begin, total)]
                    for a, count in parts:
                        cell = s["hash"]
                        if s["large"]:
                            part = (at - a) // PART
                            core = data[at - part * PART : at - part * PART - PART + 1 + length]
                            name = xxhash.xxh3_64_intdigest(core, seed=part)
                            cell = int(np.uint64((cell & _MASK) ^ name).astype(np.int64))
                        row = (cell, s["seg"], s["n"], at - a, count, data[a : a + count - 1 + length])
                        for column, value in zip(out, row):
                            column.append(value)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, kinds)], ["cell", "seg", "n", "back", "windows", "bytes"]
            )

    return found.select("text", "wanted").mapInArrow(
        cut, "cell long, seg long, n long, back long, windows long, bytes binary"
    )


def _sorted_marks(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows ``(seg, low, high)``, as offsets from the anchor, of each bucket."""

    def search(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        cell = group["cell"].to_numpy()
        seg, n = group["seg"].to_numpy(), group["n"].to_numpy()
        back, count = group["back"].to_numpy(), group["windows"].to_numpy()
        texts = group["bytes"].combine_chunks().cast(pa.large_binary())
        data, offsets = text_bytes(texts)
        owner = np.repeat(np.arange(len(seg)), count)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        offset = inner - back[owner]
        # Equal windows have their anchor at the same place.
        _, number = np.unique(cell, return_inverse=True)
        classes = number[owner] * np.int64(2 * length) + offset + length
        hit = repeated(data, offsets[owner] + inner, classes, n[owner], length)
        hit &= n[owner] < 2
        rows = np.flatnonzero(hit)
        owner, offset = owner[rows], offset[rows]
        new = np.r_[True, (np.diff(owner) != 0) | (np.diff(offset) != 1)] if len(rows) else []
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(rows)] - 1 if len(rows) else first
        return pa.table({"seg": seg[owner[first]], "low": offset[first], "high": offset[last]})

    return rows.groupBy("bucket").applyInArrow(search, "seg long, low long, high long")


def _window_marks(rows: DataFrame, length: int) -> DataFrame:
    """The same for cells whose windows agree almost everywhere, window by window.

    Every window is named by a digest of its bytes; names are counted by a partial
    aggregation, so that a window of very many segments is one row per task.
    """

    def explode(batches):
        import xxhash

        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for seg, n, back, count, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                for i in range(count):
                    name = xxhash.xxh3_64_intdigest(data[i : i + length], seed=back - i + length)
                    row = (int(np.uint64(name).astype(np.int64)), seg, n, i - back)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["name", "seg", "n", "low"])

    columns = ["seg", "n", "back", "windows", "bytes"]
    windows = rows.select(*columns).mapInArrow(explode, "name long, seg long, n long, low long")
    twice = windows.groupBy("name").agg(F.sum("n").alias("total")).filter("total > 1")
    return windows.filter("n < 2").join(twice.select("name"), "name").select("seg", "low", F.col("low").alias("high"))


def _aligned(begin: int, total: int, at: int):
    """Windows ``begin …`` cut where their offset to ``at`` is a multiple of ``PART``."""
    a, stop = begin, begin + total
    while a < stop:
        count = min((at - a) % PART + 1, stop - a)
        yield a, count
        a += count


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400, with_text: bool = False
) -> DataFrame:
    """Texts without the bytes that any repeated string of ``length`` bytes covers.

    Each text is UTF-8 bytes; a string is repeated if it also starts anywhere else, in
    another row or the same one; overlaps count, and strings are judged on the input.

    1. Every window of ``length`` bytes has an anchor within it (:func:`anchors`), so
       equal windows have equal anchors. Windows with one anchor in a row form a segment.
       Anchors that occur once are dropped by a partial aggregation.
    2. Equal segments are one, with a weight: their windows are repeated.
    3. Different segments at equal anchors form a cell. Their suffixes are sorted by
       deep-shallow sorting (:mod:`suffix_sort`), and those equal to a neighbour for
       ``length`` bytes are repeated. Cells of more than ``CELL_ROWS`` segments are cut
       by offset and by the bytes shared there; what still stays large is counted window
       by window, so no group grows with the corpus.
    4. Each text drops the union of its repeated windows.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept_sha256``, and with ``with_text`` the bytes left (``kept``; a cut may part a
    character). A null or empty text has zeros and the digest of nothing. Repeated rows are
    copies of each other, so they lose everything if long enough. Null ids pass through;
    other columns are not read. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    plain = rows_of(docs, id_col, text_col).toDF("doc_id", "text")
    plain = plain.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = plain.withColumn("key", F.xxhash64("text"))
    plain = plain.withColumn("uid", F.coalesce(F.col("doc_id").cast("long"), "key"))
    described = plain.select("uid", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    described = stored(described, "texts")
    kinds = described.groupBy("key").agg(F.count("*").alias("copies"), F.min("uid").alias("uid"))
    kinds = stored(kinds, "kinds")

    found = _emit(plain, length)
    node = F.xxhash64("key", "at")
    twice = found.groupBy("hash").agg(F.min(node).alias("low"), F.max(node).alias("high"))
    twice = stored(twice.filter("low < high").select("hash"), "anchors")
    uses = stored(found.join(twice, "hash").distinct(), "segments")

    segments = uses.groupBy("hash", "seg").agg(
        F.count("*").alias("n"), F.min("key").alias("key"), F.min_by("at", "key").alias("at"),
        F.first("back").alias("back"), F.first("windows").alias("windows"),
    )
    segments = stored(segments, "kinds-of-segments")
    cells = segments.groupBy("hash").agg(F.count("*").alias("m"), F.min("n").alias("least"))
    cells = cells.filter("m > 1 AND least = 1").select("hash", (F.col("m") > CELL_ROWS).alias("large"))
    members = segments.join(cells, "hash").groupBy("key").agg(
        F.collect_list(F.struct("hash", "seg", "n", "at", "back", "windows", "large")).alias("wanted")
    )
    members = members.join(kinds.select("key", "uid"), "key")
    texts = plain.select("uid", "key", "text")
    rows = _cut(texts.join(members, ["uid", "key"]), length).dropDuplicates(["cell", "seg", "back"])
    rows = stored(rows, "cells")
    sizes = rows.groupBy("cell").agg(F.count("*").alias("m"))
    large = stored(sizes.filter(F.col("m") > 4 * CELL_ROWS).select("cell"), "large-cells")
    buckets = max(1, rows.count() // BUCKET_ROWS)
    usual = rows.join(large, "cell", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("cell"), F.lit(buckets)))
    marks = _sorted_marks(usual, length).union(_window_marks(rows.join(large, "cell", "left_semi"), length))
    marks = marks.groupBy("seg").agg(F.collect_list(F.struct("low", "high")).alias("marks"))
    marks = stored(marks, "marks")

    # Texts with copies lose everything; the others what their segments say.
    single = kinds.filter("copies = 1").select("key", "uid")
    judged = uses.join(single, "key").join(segments.select("hash", "seg", "n"), ["hash", "seg"]).join(marks, "seg", "left")
    every = F.array(F.struct((-F.col("back")).alias("low"), (F.col("windows") - F.col("back") - 1).alias("high")))
    ranges = F.when(F.col("n") > 1, every).otherwise(F.col("marks"))
    spans = judged.select("uid", "key", "at", F.explode(ranges).alias("r")).select(
        "uid", "key", F.struct((F.col("at") + F.col("r.low")).alias("a"), (F.col("at") + F.col("r.high") + length).alias("b")).alias("s")
    )
    spans = spans.groupBy("uid", "key").agg(F.collect_list("s").alias("spans"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b")))
    copied = described.filter(F.col("n_bytes") >= length).join(kinds.filter("copies > 1").select("key"), "key")
    copied = copied.select("uid", "key", "n_bytes").distinct().select("uid", "key", whole.alias("spans"))
    return _without(plain.join(spans.union(copied), ["uid", "key"], "left"), with_text)


def _without(found: DataFrame, with_text: bool) -> DataFrame:
    """Texts without their spans; those with none stay whole."""
    schema = StructType([found.schema["doc_id"]]).add("n_bytes", LongType()).add("n_removed", LongType())
    schema = schema.add("n_spans", LongType()).add("kept_sha256", StringType())
    if with_text:
        schema = schema.add("kept", BinaryType())

    def remove(batches):
        for batch, texts in slices(batches, "text", _SLICE):
            out: list[list] = [[] for _ in schema.names[1:]]
            for data, spans in zip(texts.cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
                done, kept, removed, runs = 0, [], 0, 0
                end = -1
                for a, b in sorted((s["a"], s["b"]) for s in spans or []):
                    if a > end:
                        runs += 1
                        kept.append(data[done:a])
                        end = a
                    if b > end:
                        removed += b - end
                        done = end = b
                kept.append(data[done:])
                rest = b"".join(kept)
                row = (len(data), removed, runs, hashlib.sha256(rest).hexdigest(), rest)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            columns = [pa.array(x, k) for x, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return found.select("doc_id", "text", "spans").mapInArrow(remove, schema)
