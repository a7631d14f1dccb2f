"""A trie of conversations' prefixes, built by bursting containers of suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .stages import ship_package, stored

# A container with more sequences or bytes than these bursts.
CONTAINER_ROWS = 4_096
CONTAINER_BYTES = 4 << 20
# Ids of one piece of a list of members.
_LISTED = 100_000
# A turn is 16 bytes of its digest and 4 of its text's length.
TURN_BYTES = 20
_NONE = hashlib.sha256(b"").hexdigest()

_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, its turns' names in order.

    Order is ``turn``, null first; equal numbers by the digest of role and text. A name is
    the hex form of 16 bytes of the SHA-256 of role and text and of the text's code points;
    null role or text is empty. Rows without ``conv_id`` belong to no conversation. Only
    names are shuffled, 20 bytes a turn, however long the text is. A conversation is one
    row, so its names must fit in one.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    name = F.concat(
        F.substring(F.sha2(whole, 256), 1, 32), F.lpad(F.hex(F.length(text)), 8, "0")
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", name.alias("name"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "name")))
    return (
        rows.filter("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.transform(listed, lambda x: x["name"]).alias("turns"))
    )


def with_shared_openings(sequences: DataFrame, block: int = 100, longest: int = 6) -> DataFrame:
    """Every conversation with its first turns replaced by those of its block's first one.

    ``h`` = crc32 of the id, modulo ``longest``. The first ``h`` turns of conversation
    ``c - c % block`` (fewer if it has fewer, none if it is absent) come before the
    conversation's own turns after its first ``h``.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    base = sequences.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, longest - 1).alias("opening")
    )
    marked = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
    marked = marked.withColumn("h", shared.cast("int"))
    opening = F.coalesce(F.slice("opening", 1, F.col("h")), F.array().cast("array<string>"))
    # A slice may be longer than what is left.
    own = F.slice("turns", F.col("h") + 1, F.size("turns") + 1)
    return marked.join(base, "base", "left").select("conv_id", F.concat(opening, own).alias("turns"))


def _lists(pairs: DataFrame) -> DataFrame:
    """SHA-256 of each key's ids, ascending, joined by commas: ``(conv_id, ends_sha256)``.

    ``conv_id`` is the key's smallest id. Ids are range-sorted by key and id, so one key
    with very many ids is sorted and written out by many tasks; what one task then reads of
    it, in order, are ready pieces of its list. A digest of one list is sequential in itself.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            code = keys.indices.to_numpy(zero_copy_only=False)
            names = keys.dictionary.to_pylist()
            ids = batch.column(1).cast(pa.string()).to_pylist()
            numbers = batch.column(1).to_pylist()
            edges = np.flatnonzero(np.r_[True, code[1:] != code[:-1], True])
            rows = [
                (names[code[a]], numbers[a], ",".join(ids[a:b]))
                for low, high in zip(edges[:-1].tolist(), edges[1:].tolist())
                for a in range(low, high, _LISTED)
                for b in (min(a + _LISTED, high),)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))],
                    ["key", "first", "ids"],
                )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = digest = None
        for batch in batches:
            done = []
            for name, number, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if name != key:
                    if key is not None:
                        done.append((first, digest.hexdigest()))
                    key, first, digest = name, number, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if done:
                yield _pairs(done)
        if key is not None:
            yield _pairs([(first, digest.hexdigest())])

    def _pairs(rows):
        number, text = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(text, pa.string())], ["conv_id", "ends_sha256"]
        )

    ordered = pairs.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    listed = ordered.select("key", "conv_id").mapInArrow(pieces, "key string, first long, ids string")
    together = listed.repartition("key").sortWithinPartitions("key", "first")
    return together.mapInArrow(digests, "conv_id long, ends_sha256 string")


def _path(seq: Column | str, size: Column) -> Column:
    """The name of a trie head: a digest of the turns on the way to it."""
    return F.md5(F.substring(seq, F.lit(1), size))


def _shared_bytes(pairs: DataFrame) -> DataFrame:
    """Adds ``shared``: bytes of whole turns that ``low`` and ``high`` begin with."""

    def lengths(batches):
        for batch in batches:
            low, high = (batch.column(n).to_pylist() for n in ("low", "high"))
            sizes = []
            for a, b in zip(low, high):
                n = min(len(a), len(b))
                x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
                differ = np.flatnonzero(x != y)
                same = int(differ[0]) if len(differ) else n
                sizes.append(same - same % TURN_BYTES)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64())], [*batch.schema.names, "shared"]
            )

    schema = ", ".join(f"{n} {t}" for n, t in pairs.dtypes) + ", shared long"
    return pairs.mapInArrow(lengths, schema)


def _burst(
    sequences: DataFrame, rows: int, size: int
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Containers below the limits, the heads that burst, and sequences that end at heads.

    A container is named by ``head`` and holds the sequences that begin with the head's
    ``at`` bytes. An oversized one becomes a head: the turns that all its sequences share
    are its path (the smallest and the largest sequence tell how many), and every next turn
    opens a container. As equal sequences are one row, this always splits. Rows of
    containers that stay are not moved again.
    """
    pending, ready, bursts, ends = sequences, [], [], []
    while True:
        sizes = pending.groupBy("head").agg(
            F.count("*").alias("rows"),
            F.sum(F.octet_length("seq") - F.col("at")).alias("bytes"),
            F.min("seq").alias("low"),
            F.max("seq").alias("high"),
            F.first("above").alias("above"),
            F.first("at").alias("at"),
            F.first("heads").alias("heads"),
        )
        large = sizes.filter((F.col("rows") > 1) & ((F.col("rows") > rows) | (F.col("bytes") > size)))
        found = stored(_shared_bytes(large.drop("rows", "bytes")).drop("high"), "trie-heads")
        if found.isEmpty():
            ready.append(pending)
            break
        bursts.append(found)
        marked = stored(pending.join(found.select("head", "shared"), "head", "left"), "trie-rows")
        ready.append(marked.filter("shared IS NULL").select(*pending.columns))
        split = marked.filter("shared IS NOT NULL")
        ends.append(split.filter(F.octet_length("seq") == F.col("shared")).select(*pending.columns))
        at = (F.col("shared") + TURN_BYTES).cast("int")
        pending = split.filter(F.octet_length("seq") > F.col("shared")).select(
            _path("seq", at).alias("head"),
            F.col("head").alias("above"),
            at.alias("at"),
            F.array_append("heads", F.col("head")).alias("heads"),
            "seq",
            "conv_id",
            "n",
            "ends_sha256",
        )

    def union(parts):
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    if not bursts:
        return union(ready), None, None
    return union(ready), union(bursts), union(ends)


class _Sweep:
    """Nodes of containers whose sequences arrive in order.

    Keeps the path of open nodes. A node that is closed waits with its parent, whose
    smallest member is known only when the parent is closed; a container's limits bound
    what waits.
    """

    def __init__(self):
        self.head = self.above = None
        self.path = b""
        self.open: list[list] = []  # depth, min, n, children, leaves, saved, chars, ends, waiting
        self.done: list[tuple] = []

    def _close(self) -> None:
        depth, low, n, children, leaves, saved, chars, ends, waiting = self.open.pop()
        leaves = leaves or 1
        saved += (n - 1) * chars
        self.done += [(*row[:2], low, *row[2:], None, False) for row in waiting]
        row = (low, depth, n, children, leaves, saved, ends or _NONE)
        if not self.open:
            self.done.append((low, depth, None, *row[2:], self.above, True))
            return
        up = self.open[-1]
        up[1] = low if up[1] is None else min(up[1], low)
        up[2] += n
        up[3] += 1
        up[4] += leaves
        up[5] += saved
        up[8].append(row)

    def finish(self) -> None:
        while self.open:
            self._close()

    def add(self, head, above, at: int, seq: bytes, low: int, n: int, ends: str) -> None:
        top = at // TURN_BYTES
        if head != self.head:
            self.finish()
            self.head, self.above, self.path = head, above, seq[:at]
            self.open.append([top, None, 0, 0, 0, 0, _chars(seq, top), None, []])
        size = len(seq) // TURN_BYTES
        common = top
        limit = min(size, len(self.path) // TURN_BYTES)
        while common < limit and (
            seq[common * TURN_BYTES : (common + 1) * TURN_BYTES]
            == self.path[common * TURN_BYTES : (common + 1) * TURN_BYTES]
        ):
            common += 1
        while self.open[-1][0] > common:
            self._close()
        for depth in range(common + 1, size + 1):
            self.open.append([depth, None, 0, 0, 0, 0, _chars(seq, depth), None, []])
        last = self.open[-1]
        last[1] = low if last[1] is None else min(last[1], low)
        last[2] += n
        last[7] = ends
        self.path = seq


def _chars(seq: bytes, depth: int) -> int:
    """Code points of the text of turn ``depth``; the root has none."""
    at = depth * TURN_BYTES
    return int.from_bytes(seq[at - 4 : at], "big") if depth else 0


_SWEPT = f"{_NODE}, above string, top boolean"


def _swept(ready: DataFrame) -> DataFrame:
    """Nodes of all containers, each container sorted and swept in one task.

    The top node of a container has no parent yet; ``above`` names the head over it.
    """
    kinds = [pa.int64()] * 7 + [pa.string(), pa.string(), pa.bool_()]
    names = [part.split()[0] for part in _SWEPT.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def sweep(batches):
        state = _Sweep()
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                state.add(*row)
                if len(state.done) >= 20_000:
                    yield batch_of(state.done)
                    state.done = []
        state.finish()
        if state.done:
            yield batch_of(state.done)

    ordered = ready.repartition("head").sortWithinPartitions("head", "seq")
    ordered = ordered.select("head", "above", "at", "seq", "conv_id", "n", "ends_sha256")
    return ordered.mapInArrow(sweep, _SWEPT)


def _head_nodes(tops: DataFrame, heads: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes on the paths of burst heads, and each head's smallest member.

    Sums of the containers' tops go to every head above them, by the heads' own lists; the
    heads are few, as each holds more sequences than a container may.
    """
    own = tops.groupBy(F.col("above").alias("head")).agg(
        F.min("conv_id").alias("low"),
        F.sum("n_convs").alias("n"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.count("*").alias("children"),
    )
    ended = ends.select("head", F.col("conv_id").alias("end_low"), F.col("n").alias("end_n"), "ends_sha256")
    below = heads.groupBy(F.col("above").alias("head")).agg(F.count("*").alias("heads_below"))
    table = (
        heads.join(own, "head", "left").join(ended, "head", "left").join(below, "head", "left")
    )
    zero = F.lit(0).cast("bigint")
    table = table.select(
        "head", "above", "at", "shared", "ends_sha256",
        F.substring("low_seq", F.lit(1), F.col("shared").cast("int")).alias("path"),
        F.array_append("heads", F.col("head")).alias("heads"),
        F.least("low", "end_low").alias("low"),  # of those that are there
        (F.coalesce("n", zero) + F.coalesce("end_n", zero)).alias("n"),
        F.coalesce("leaves", zero).alias("leaves"),
        F.coalesce("saved", zero).alias("saved"),
        (F.coalesce("children", zero) + F.coalesce("heads_below", zero)).alias("children"),
    )
    table = stored(table, "trie-head-sums")
    total = (
        table.select(F.explode("heads").alias("head"), "low", "n", "leaves", "saved")
        .groupBy("head")
        .agg(*(f(c).alias(c) for f, c in ((F.min, "low"), (F.sum, "n"), (F.sum, "leaves"), (F.sum, "saved"))))
    )
    table = table.drop("low", "n", "leaves", "saved").join(total, "head")
    # Depths on a head's path, from its container's top to the head itself.
    depths = F.sequence((F.col("at") / TURN_BYTES).cast("int"), (F.col("shared") / TURN_BYTES).cast("int"))

    def chars(depth: Column) -> Column:
        text = F.hex(F.substring(F.col("path"), depth * TURN_BYTES - 3, F.lit(4)))
        return F.when(depth == 0, 0).otherwise(F.conv(text, 16, 10).cast("bigint"))

    table = table.withColumn(
        "saves", F.transform(depths, lambda d: (F.col("n") - 1) * chars(d))
    )
    table = table.withColumn("on_path", F.aggregate("saves", zero, lambda a, x: a + x))
    table = stored(table, "trie-head-totals")
    lower = (
        table.select(F.explode(F.slice("heads", F.lit(1), F.size("heads") - 1)).alias("head"), "on_path")
        .groupBy("head")
        .agg(F.sum("on_path").alias("lower"))
    )
    smallest = table.select(F.col("head").alias("above"), F.col("low").alias("above_low"))
    table = table.join(lower, "head", "left").join(smallest, "above", "left")
    nodes = table.select("*", F.posexplode(depths).alias("place", "node_depth"))
    last = F.col("place") == F.size("saves") - 1
    deeper = F.aggregate(
        F.slice("saves", F.col("place") + 1, F.size("saves")), zero, lambda a, x: a + x
    )
    nodes = nodes.select(
        F.col("low").alias("conv_id"),
        F.col("node_depth").cast("bigint").alias("depth"),
        F.when(F.col("place") == 0, F.col("above_low")).otherwise(F.col("low")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.coalesce("lower", zero) + deeper).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256"))
        .otherwise(_NONE)
        .alias("ends_sha256"),
    )
    return nodes, smallest


def prefix_trie(
    sequences: DataFrame,
    *,
    container_rows: int = CONTAINER_ROWS,
    container_bytes: int = CONTAINER_BYTES,
) -> DataFrame:
    """Nodes of the trie of ``sequences(conv_id, turns)`` (:func:`turn_sequences`).

    A node is a distinct sequence of first turns; the root is the empty one. Equal
    conversations are one row with a count before anything is built. Their turns' names lie
    in containers under trie heads; containers beyond ``container_rows`` sequences or
    ``container_bytes`` bytes burst by the next turn, until all can be sorted and swept by
    one task each. Rounds are stored, so lost executors cost no earlier one.

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in its subtree),
    ``saved_tokens`` (code points of each subtree node's last text, times its members less
    one, summed) and ``ends_sha256`` (of the ids that end here, ascending, joined by
    commas). A conversation without turns ends at the root. No conversations: no rows.
    """
    ship_package(sequences.sparkSession)
    seq = F.unhex(F.array_join("turns", ""))
    rows = stored(sequences.select("conv_id", seq.alias("seq")), "trie-sequences")
    distinct = rows.groupBy("seq").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    ends = _lists(rows.select(F.sha2("seq", 256).alias("key"), "conv_id"))
    # All begin in one container, under the root. Its name is stored, so that it is a join
    # key as any other.
    start = F.lit("").alias("head"), F.lit(None).cast("string").alias("above"), F.lit(0).alias("at")
    root = *start, F.array().cast("array<string>").alias("heads")
    distinct = distinct.join(ends, "conv_id").select(*root, "seq", "conv_id", "n", "ends_sha256")
    distinct = stored(distinct, "trie-distinct")
    ready, heads, ended = _burst(distinct, container_rows, container_bytes)
    names = [part.split()[0] for part in _NODE.split(", ")]
    swept = stored(_swept(ready), "trie-swept")
    if heads is None:
        return swept.select(*names)
    tops = swept.filter("top")
    nodes, smallest = _head_nodes(tops, heads.withColumnRenamed("low", "low_seq"), ended)
    under = tops.drop("parent_conv_id").join(smallest, "above").withColumnRenamed("above_low", "parent_conv_id")
    return (
        swept.filter("NOT top").select(*names)
        .unionByName(under.select(*names))
        .unionByName(nodes.select(*names))
    )
