"""Packing documents into fixed-length training sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import rows_of, slices
from .stages import ship_package
from .tokens import word_tokenizer

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"


class LevelPacker:
    """Sum-of-squares placement of pieces into windows of ``capacity`` tokens.

    ``count[h]`` is the number of open windows filled to level ``h``. A piece goes to the
    level where the sum of squared counts ends lowest; opening a window is level 0. Ties
    go to the fullest level. A window leaves the array when it is full.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def level_for(self, size: int) -> int:
        low, high = self.count[: self.capacity - size + 1], self.count[size:]
        cost = 2 * (high - low) + 2
        cost[-1] = 1 - 2 * low[-1]  # the window gets full: nothing is added above
        cost[1:][low[1:] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * high[0] + 1
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece shorter than a window; returns the window if that filled it."""
        level = self.level_for(size)
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.open.setdefault(level + size, []).append(window)
        self.count[level + size] += 1
        return None

    def close(self) -> Iterator[list]:
        """Empty the windows left open: the emptiest are cut up to fill the fullest.

        What remains is one partly filled window; it is cut at powers of two, whose
        sequences need no padding.
        """
        left = [(h, w) for h in sorted(self.open) for w in self.open[h]]
        pieces = [p for _, w in left[::-1] for p in w]  # fullest windows first
        self.open.clear()
        self.count[:] = 0
        total = sum(len(p[2]) for p in pieces)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        at = 0
        for size in sizes:
            window: list = []
            while size:
                doc, start, ids, n = pieces[at]
                take = min(size, len(ids))
                window.append((doc, start, ids[:take], n))
                size -= take
                if take == len(ids):
                    at += 1
                else:
                    pieces[at] = (doc, start + take, ids[take:], n)
            yield window


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents packed into sequences of ``capacity`` tokens.

    A document is its token ids and ``end_id``. Whole windows are cut from its front; the
    shorter rest is placed online by the sum-of-squares rule (:class:`LevelPacker`). Every
    task packs its own split, so nothing is shuffled; at its end the few open windows are
    emptied into each other, and no sequence needs padding unless the final cut at powers
    of two is padded by the reader. ``sequence_id`` holds the task's number in its upper
    31 bits. A task keeps only its open windows' ids.

    One row per piece: ``doc_id``, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and with
    ``with_ids`` the ``ids`` themselves. A null or empty text is the end id alone; a null
    id is kept; equal rows are packed each for itself; other columns are not read. An
    empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    schema = _PIECE + (", ids array<int>" if with_ids else "")

    def rows(windows: list[list], first: int) -> pa.RecordBatch:
        flat = [(p, i) for i, w in enumerate(windows) for p in w]
        length = np.array([len(p[2]) for p, _ in flat], np.int64)
        number = np.array([i for _, i in flat], np.int64)
        before = np.cumsum(length) - length
        new = np.r_[True, number[1:] != number[:-1]]
        begins = np.maximum.accumulate(np.where(new, before, 0))
        columns = {
            "doc_id": pa.array([p[0] for p, _ in flat], pa.int64()),
            "start": pa.array([p[1] for p, _ in flat], pa.int64()),
            "length": pa.array(length),
            "ids_crc32": pa.array([zlib.crc32(p[2].astype("<u4").tobytes()) for p, _ in flat], pa.int64()),
            "doc_tokens": pa.array([p[3] for p, _ in flat], pa.int64()),
            "sequence_id": pa.array(number + first),
            "offset": pa.array(before - begins),
        }
        if with_ids:
            columns["ids"] = pa.array(
                [p[2].astype(np.int32) for p, _ in flat], pa.list_(pa.int32())
            )
        return pa.RecordBatch.from_pydict(columns)

    def pack(batches):
        from pyspark import TaskContext

        tokenizer, packer = word_tokenizer(vocabulary_path), LevelPacker(capacity)
        next_id = TaskContext.get().partitionId() << 32
        for batch, texts in slices(batches, "text"):
            ids, sizes = tokenizer.encode(texts)
            full: list[list] = []
            end = 0
            for doc, size in zip(batch.column(0).to_pylist(), sizes.tolist()):
                own = np.append(ids[end : end + size], np.uint32(end_id))
                end += size
                total, cut = len(own), len(own) // capacity * capacity
                full += [
                    [(doc, at, own[at : at + capacity], total)]
                    for at in range(0, cut, capacity)
                ]
                if cut < total:
                    # A copy: the window must not keep the whole document alive.
                    done = packer.place((doc, cut, own[cut:].copy(), total), total - cut)
                    if done:
                        full.append(done)
            if full:
                yield rows(full, next_id)
                next_id += len(full)
        tokenizer.forget()
        rest = list(packer.close())
        if rest:
            yield rows(rest, next_id)

    plain = rows_of(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return plain.mapInArrow(pack, schema)
