"""Fill-in-middle transformation over texts stored as seekable compressed frames."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import rows_of, slices, text_bytes
from .stages import ship_package

# Bytes of text in one frame.
FRAME_BYTES = 1 << 16
# Bytes of text, or of frames, that one Arrow batch holds.
BATCH_BYTES = 2 << 20
# --- Fixed values: the marks of the three parts -----------------------------------
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# ----------------------------------------------------------------------------------

_FRAMES = "array<struct<units: bigint, chars: bigint, inside: boolean, data: binary>>"
_STORE = f"doc_id long, n long, n_chars long, marked boolean, frames {_FRAMES}"
_OUTPUT = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames array<binary>"
)
_DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long,"
    " output_sha256 string, restored_sha256 string"
)
_FRAME_TYPE = pa.struct(
    [("units", pa.int64()), ("chars", pa.int64()), ("inside", pa.bool_()), ("data", pa.binary())]
)


def _letters(data: np.ndarray) -> np.ndarray:
    low = data | 0x20
    return (low >= 97) & (low <= 122)


def _unit_starts(data: np.ndarray, inside: bool) -> np.ndarray:
    """Bytes at which a unit begins; ``inside``: a letter stands before the first byte."""
    letter = _letters(data)
    before = np.empty_like(letter)
    before[:1] = inside
    before[1:] = letter[:-1]
    return np.where(letter, ~before, (data & 0xC0) != 0x80)


def write_frames(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Every text as independent zstandard frames with cumulative counts.

    A unit is a run of ASCII letters or one other code point. One row per document:
    ``doc_id``, ``n`` units, ``n_chars`` code points, ``marked`` (the text holds one of the
    part marks) and ``frames`` in order. A frame holds at most ``frame_bytes`` bytes, cut
    between code points, and says how many units and code points begin before it and
    whether a run of letters goes on into it; so the frame of any unit is found by a binary
    search and read alone. Map-only. Null and empty texts have no frames and ``n`` 0; null
    ids and equal rows are kept; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def framed(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch, texts in slices(batches, "text", BATCH_BYTES):
            data, offsets = text_bytes(texts)
            starts = _unit_starts(data, False)
            first = offsets[:-1][offsets[:-1] < offsets[1:]]
            starts[first] = True
            point = (data & 0xC0) != 0x80
            units = np.concatenate([[0], np.cumsum(starts)])
            chars = np.concatenate([[0], np.cumsum(point)])
            raw = data.tobytes()
            frames = []
            for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                own, at = [], begin
                while at < end:
                    stop = min(end, at + frame_bytes)
                    while stop < end and not point[stop]:
                        stop -= 1
                    own.append(
                        {
                            "units": int(units[at] - units[begin]),
                            "chars": int(chars[at] - chars[begin]),
                            "inside": at > begin and bool(_letters(data[at - 1 : at])[0]),
                            "data": packer.compress(raw[at:stop]),
                        }
                    )
                    at = stop
                frames.append(own)
            marked = pc.or_(
                pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)),
                pc.match_substring(texts, MIDDLE),
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n": pa.array(units[offsets[1:]] - units[offsets[:-1]], pa.int64()),
                    "n_chars": pa.array(chars[offsets[1:]] - chars[offsets[:-1]], pa.int64()),
                    "marked": marked,
                    "frames": pa.array(frames, pa.list_(_FRAME_TYPE)),
                }
            )

    plain = rows_of(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return plain.mapInArrow(framed, _STORE)


def with_cuts(store: DataFrame, *, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Adds ``form``, ``first_cut`` and ``last_cut`` (units before each cut) to stored texts.

    They follow from four 32-bit numbers of the SHA-256 of ``seed`` and the id, so a
    repeated run gives the same. A null id counts as empty text.
    """
    digest = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256
    )

    def number(i: int) -> Column:
        return F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("bigint")

    a, b = (number(i) % (F.col("n") + 1) for i in (0, 1))
    whole = (F.col("n") == 0) | F.col("marked") | (number(2) % 100 >= plain_from)
    form = F.when(whole, "plain").when(number(3) % 100 < spm_below, "spm").otherwise("psm")
    return store.withColumn("_digest", digest).select(
        *store.columns,
        form.alias("form"),
        F.least(a, b).alias("first_cut"),
        F.greatest(a, b).alias("last_cut"),
    )


class _Text:
    """Random access to a text's frames; at most one is unpacked at a time."""

    def __init__(self, frames: list[dict], unpack):
        self.frames, self.unpack = frames, unpack
        self.units = np.array([f["units"] for f in frames], np.int64)

    def place(self, unit: int) -> tuple[int, int, int]:
        """The frame and byte at which ``unit`` begins, and the code points before it."""
        number = int(np.searchsorted(self.units, unit, side="right")) - 1
        frame = self.frames[number]
        data = np.frombuffer(self.unpack(frame["data"]), np.uint8)
        starts = np.flatnonzero(_unit_starts(data, frame["inside"]))
        byte = int(starts[unit - frame["units"]])
        before = int(np.count_nonzero((data[:byte] & 0xC0) != 0x80))
        return number, byte, frame["chars"] + before

    def between(self, start: tuple[int, int], stop: tuple[int, int]) -> Iterator[bytes]:
        """The bytes from ``start`` to ``stop``, each a frame and a byte in it."""
        for number in range(start[0], min(stop[0] + 1, len(self.frames))):
            low = start[1] if number == start[0] else 0
            if number == stop[0]:
                if low < stop[1]:
                    yield self.unpack(self.frames[number]["data"])[low : stop[1]]
            else:
                yield self.unpack(self.frames[number]["data"])[low:]


def _transformed(row: dict, unpack) -> tuple[Iterable[bytes], int | None, int | None]:
    """The chunks of a document's output and the code points of its prefix and middle."""
    text = _Text(row["frames"], unpack)
    end = (len(text.frames), 0)
    if row["form"] == "plain":
        return text.between((0, 0), end), None, None
    cuts = []
    for unit in (row["first_cut"], row["last_cut"]):
        at_end = unit == row["n"]
        cuts.append((*end, row["n_chars"]) if at_end else text.place(unit))
    (*first, prefix), (*last, both) = cuts
    parts = {
        PREFIX: ((0, 0), tuple(first)),
        MIDDLE: (tuple(first), tuple(last)),
        SUFFIX: (tuple(last), end),
    }
    order = (PREFIX, SUFFIX, MIDDLE) if row["form"] == "psm" else (SUFFIX, PREFIX, MIDDLE)

    def chunks():
        for mark in order:
            yield mark.encode()
            yield from text.between(*parts[mark])

    return chunks(), prefix, both - prefix


def fill_in_middle(cut: DataFrame, *, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Outputs of stored texts with cuts (:func:`with_cuts`), as frames again.

    ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` begins with suffix and
    prefix, ``plain`` is the text. To find the cuts only the frames that hold them are
    unpacked; the parts are then streamed frame by frame in the order of the output, so a
    task holds one row's frames and the text of two. ``prefix_chars`` and ``middle_chars``
    are null where the form is plain. ``frames`` are plain zstandard frames: their
    concatenation is a valid zstandard stream of the output.
    """
    ship_package(cut.sparkSession)

    def outputs(batches):
        import zstandard

        packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunks, prefix, middle = _transformed(row, unpacker.decompress)
                frames, open_, size = [], [], 0
                for chunk in chunks:
                    open_.append(chunk)
                    size += len(chunk)
                    if size >= frame_bytes:
                        frames.append(packer.compress(b"".join(open_)))
                        open_, size = [], 0
                if open_:
                    frames.append(packer.compress(b"".join(open_)))
                rows.append((row["doc_id"], row["n"], row["form"], prefix, middle, frames))
                held += 200 + sum(map(len, frames))
                if held >= BATCH_BYTES:
                    yield _batch(rows, pa.list_(pa.binary()))
                    rows, held = [], 0
        if rows:
            yield _batch(rows, pa.list_(pa.binary()))

    names = ["doc_id", "n", "n_chars", "form", "first_cut", "last_cut", "frames"]
    return cut.select(*names).mapInArrow(outputs, _OUTPUT)


def _batch(rows: list[tuple], last: pa.DataType, more: str | None = None) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), last]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames"]
    if more:
        kinds.append(last)
        names[-1:] = ["output_sha256", more]
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _mark_places(frames: list[bytes], unpack, marks: tuple[bytes, ...]) -> list[int]:
    """Bytes before each of ``marks``, which follow one another in the stream."""
    found: list[int] = []
    done, tail = 0, b""
    for frame in frames:
        window = tail + unpack(frame)
        at = 0
        while len(found) < len(marks):
            hit = window.find(marks[len(found)], at)
            if hit < 0:
                break
            found.append(done + hit)
            at = hit + 3
        if len(found) == len(marks):
            return found
        keep = window[max(at, len(window) - 2) :]
        done += len(window) - len(keep)
        tail = keep
    raise ValueError("the output lacks a mark of its form")


def _range(frames: list[bytes], unpack, start: int, stop: int | None) -> Iterator[bytes]:
    at = 0
    for frame in frames:
        if stop is not None and at >= stop:
            return
        data = unpack(frame)
        if at + len(data) > start:
            yield data[max(0, start - at) : None if stop is None else stop - at]
        at += len(data)


def restored(frames: list[bytes], form: str, unpack) -> Iterator[bytes]:
    """The text again, from an output's frames and its form only."""
    if form == "plain":
        yield from map(unpack, frames)
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    places = _mark_places(frames, unpack, tuple(m.encode() for m in order))
    ends = [*places[1:], None]
    ranges = {m: (p + 3, e) for m, p, e in zip(order, places, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from _range(frames, unpack, *ranges[mark])


def output_digests(outputs: DataFrame) -> DataFrame:
    """SHA-256 of every output and of the text rebuilt from it and its form.

    Frames are unpacked one at a time, in order, and only pass through the digests.
    """
    ship_package(outputs.sparkSession)

    def digests(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                plain, back = hashlib.sha256(), hashlib.sha256()
                for frame in row["frames"]:
                    plain.update(unpack(frame))
                for chunk in restored(row["frames"], row["form"], unpack):
                    back.update(chunk)
                rows.append(
                    (row["doc_id"], row["n"], row["form"], row["prefix_chars"],
                     row["middle_chars"], plain.hexdigest(), back.hexdigest())
                )
            if rows:
                yield _batch(rows, pa.string(), "restored_sha256")

    return outputs.mapInArrow(digests, _DIGESTS)
