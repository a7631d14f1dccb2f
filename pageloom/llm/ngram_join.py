"""Documents whose word n-gram sets have a high Jaccard similarity."""

from __future__ import annotations

import heapq
import itertools
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import give_back, hashed_words, mixed, rows_of, slices
from .graph import components
from .stages import ship_package, stored

# Texts of one slice, bytes.
_SLICE = 2 << 20
# Grams of a block of candidates; two blocks are searched together.
BLOCK_GRAMS = 1_000_000
# Documents looked at, and grams kept, to put frequent grams last in the common order.
ORDER_SAMPLE = 2_000
ORDER_GRAMS = 50_000
# Sets of a block that asks for its grams together; their numbers take two bytes.
BLOCK_SETS = 1 << 16
# Grams that one task compares, of the lowest 40 bits of their hash.
PART_GRAMS = 1_000_000
# Members of short lists above which they are counted rather than merged by a heap.
COUNTED = 100
# Members of lists that are gathered to be counted at once.
GATHERED = 4_000_000
# Members that are counted in the time of one binary search.
LOOKED_UP = 30
# Bits of a bitmap (Spark's size), bits for each member marked in them, and most bitmaps.
MAP_BITS, MARKS, MOST_MAPS = 1 << 15, 16, 2_048
# Blocks of a cluster, each two of which are searched together, before it is searched by list.
MOST_BLOCKS = 24
_SEED = np.uint64(0xA24BAED4963EE407)


def gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted set of hashed ``n``-word shingles of every text.

    A text with fewer words is one shingle; one without words has none.
    """
    words, counts = hashed_words(texts)
    factor = mixed(np.arange(1, n + 1, dtype=np.uint64) * _SEED) | np.uint64(1)
    if len(words) >= n:
        grams = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            grams += words[k : len(words) - n + 1 + k] * factor[k]
        grams = mixed(grams)
    ends = np.cumsum(counts)
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= n:
            yield np.unique(grams[end - count : end - n + 1])
        elif count:
            value = (words[end - count : end] * factor[:count]).sum(dtype=np.uint64)
            yield mixed(value.reshape(1) + np.array([count], np.uint64) * _SEED)
        else:
            yield np.zeros(0, np.uint64)


def sliced_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sets of :func:`gram_sets`, worked out for a bounded part of the texts at a time."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for _, part in slices([batch], "text", _SLICE):
        yield from gram_sets(part, n)


def set_key(grams: np.ndarray) -> int:
    """A 64-bit name of a set, the same for equal sets; signed, as Spark's longs are."""
    import xxhash

    value = xxhash.xxh3_64_intdigest(grams.tobytes())
    return value - (1 << 64) if value >> 63 else value


class Overlap:
    """The threshold ``100·|∩| ≥ percent·|∪|``."""

    def __init__(self, percent: int):
        self.percent = percent

    def least(self, size: int) -> int:
        """Grams a set of ``size`` must share with any partner."""
        return -(-self.percent * size // 100)

    def needed(self, size: int, other: int) -> int:
        return -(-self.percent * (size + other) // (100 + self.percent))

    def prefix(self, size: int) -> int:
        """So many first grams in a common order cannot all be missing in a partner."""
        return size - self.least(size) + 1


def linked(a: np.ndarray, b: np.ndarray, overlap: Overlap) -> bool:
    low, high = sorted((len(a), len(b)))
    if low < overlap.least(high) or not low:
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) >= overlap.needed(len(a), len(b))


class Lists:
    """Inverted lists of some sets, searched for sets with enough grams in common."""

    def __init__(self, sets: list[np.ndarray], overlap: Overlap, weight: float = 0.02):
        self.overlap, self.weight = overlap, weight
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.offsets = np.r_[0, np.cumsum(self.sizes)]
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.lexsort((owner, grams))
        grams, self.owner = grams[order], owner[order]
        # Where each gram of each set stands among the members, which list that is, and its end.
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        first = np.r_[True, grams[1:] != grams[:-1]][: len(grams)]
        self.list = np.cumsum(first) - 1
        self.ends = np.r_[np.flatnonzero(first)[1:], len(grams)]
        # Sorted, as the members are.
        self.codes = self.list * len(sets) + self.owner

    def _counts(self, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many of the lists hold each set; a bounded part of the members at a time."""
        counts = np.zeros(len(self.sizes), np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + GATHERED, side="right")))
            own = sizes[start:stop]
            before = ends[start:stop] - own - base
            at = np.repeat(first[start:stop] - before, own) + np.arange(own.sum())
            counts += np.bincount(self.owner[at], minlength=len(counts))
            start = stop
        return counts

    def _merged(self, first: np.ndarray, sizes: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets in at least ``bound`` of the lists, and how many hold them.

        A heap that skips: after ``n`` equal heads short of the bound, further lists are
        moved on by binary search to the next number that can still reach it. Where the
        lists are long altogether, their members are counted in an array instead.
        """
        if sizes.sum() > COUNTED:
            counts = self._counts(first, sizes)
            rows = np.flatnonzero(counts >= bound)
            return rows, counts[rows]
        lists = [self.owner[a : a + n].tolist() for a, n in zip(first.tolist(), sizes.tolist())]
        heads = [(x[0], 0, n) for n, x in enumerate(lists)]
        heapq.heapify(heads)
        found = []
        while len(heads) >= bound:
            top, popped = heads[0][0], []
            while heads and heads[0][0] == top:
                popped.append(heapq.heappop(heads))
            if len(popped) >= bound:
                found.append((top, len(popped)))
                target = top + 1
            else:
                for _ in range(min(bound - 1 - len(popped), len(heads))):
                    popped.append(heapq.heappop(heads))
                if not heads:
                    break
                target = heads[0][0]
            for _, i, n in popped:
                i = bisect_left(lists[n], target, i)
                if i < len(lists[n]):
                    heapq.heappush(heads, (lists[n][i], i, n))
        found = np.array(found, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    def search(self, query: int) -> list[int]:
        """Later sets that reach the required overlap with set ``query`` (DivideSkip).

        With threshold ``T``, the longest lists are set aside, ``T`` of them less one at
        most. The short ones are merged; sets found often enough there are then looked up
        in the long lists by binary search, all at once, or these are counted, if they have
        few members for the searches.
        """
        size = int(self.sizes[query])
        least = self.overlap.least(size)
        at = self.place[self.offsets[query] : self.offsets[query + 1]]
        # Only sets after the query, so that each pair is met once.
        sizes = self.ends[self.list[at]] - at - 1
        at, sizes = at[sizes > 0], sizes[sizes > 0]
        if not size or len(at) < least:
            return []
        order = np.argsort(sizes)
        at, sizes = at[order], sizes[order]
        aside = min(least - 1, int(least / (self.weight * int(sizes[-1]).bit_length() + 1)))
        short = len(at) - aside
        others, counts = self._merged(at[:short] + 1, sizes[:short], least - aside)
        needed = self.overlap.needed(size, self.sizes[others])
        able = (np.minimum(size, self.sizes[others]) >= needed) & (counts + aside >= needed)
        others, counts, needed = others[able], counts[able], needed[able]
        if aside and len(others):
            if sizes[short:].sum() <= LOOKED_UP * aside * len(others):
                counts = counts + self._counts(at[short:] + 1, sizes[short:])[others]
            else:
                wanted = (self.list[at[short:]][:, None] * len(self.sizes) + others).ravel()
                met = np.searchsorted(self.codes, wanted)
                met[met == len(self.codes)] = 0
                counts = counts + (self.codes[met] == wanted).reshape(aside, -1).sum(axis=0)
        return others[counts >= needed].tolist()


def _tokens(docs: DataFrame, n: int, percent: int, last: np.ndarray | None) -> DataFrame:
    """Rows ``(gram, key)`` of every text's prefix, frequent grams ordered last.

    A task emits equal sets once. Without ``last``, all grams of the sets.
    """
    overlap = Overlap(percent)
    shared = docs.sparkSession.sparkContext.broadcast(last) if last is not None else None

    def emit(batches):
        late = shared.value if shared else None
        seen: set[int] = set()
        for _, texts in slices(batches, "text", _SLICE):
            grams, keys, sizes = [], [], []
            for own in gram_sets(texts, n):
                key = set_key(own)
                if not len(own) or key in seen:
                    continue
                seen.add(key)
                keys.append(key)
                if late is None:
                    grams.append(own)
                else:
                    at = np.searchsorted(late, own)
                    at[at == len(late)] = 0
                    common = late[at] == own if len(late) else np.zeros(len(own), bool)
                    if common.any():
                        own = np.concatenate([own[~common], own[common]])
                    grams.append(own[: overlap.prefix(len(own))])
                sizes.append(len(grams[-1]))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(grams).view(np.int64)),
                        pa.array(np.repeat(np.array(keys, np.int64), sizes)),
                    ],
                    ["gram", "key"],
                )
        give_back()

    return docs.select("text").mapInArrow(emit, "gram long, key long")


def _frequent(docs: DataFrame, total: int, n: int, percent: int) -> np.ndarray:
    """Grams found often in a sample; they only come last in the order of grams."""
    part = max(1, total // ORDER_SAMPLE)
    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(part)) == 0)
    counts = _tokens(sample, n, percent, None).groupBy("gram").agg(F.count("*").alias("n"))
    top = counts.filter("n > 3").orderBy(F.desc("n"), "gram").limit(ORDER_GRAMS).select("gram")
    grams = np.array([r[0] for r in top.toLocalIterator()], np.int64)
    return np.sort(grams.view(np.uint64))


def _packed(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of bytes, cut at ``ends``, as one binary array."""
    width = rows.shape[1]
    offsets = np.r_[0, ends * width].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _as_bytes(values: np.ndarray, kind: str) -> np.ndarray:
    return values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)


def _requests(
    names: np.ndarray, known: np.ndarray, sets: list[np.ndarray], comps: np.ndarray | None, parts: int, block: int
) -> pa.RecordBatch:
    """What a block of sets asks of each part: five bytes of every gram and its set's number.

    With ``comps``, the component of each gram's set goes along.
    """
    grams = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    part = (grams >> np.uint64(40)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    asked, first = np.unique(part[order], return_index=True)
    ends = np.r_[first[1:], len(order)][: len(asked)]
    owner = int(block % parts)
    none = pa.nulls(len(asked), pa.binary())
    columns = [
        pa.array(asked.astype(np.int32)),
        pa.array(np.full(len(asked), block, np.int64)),
        none,
        none,
        _packed(_as_bytes(row[order], "<u2"), ends),
        _packed(_as_bytes(grams[order], "<u8")[:, :5], ends),
        none if comps is None else _packed(_as_bytes(comps[row[order]], "<i8"), ends),
    ]
    # The names take the way over one part, so that a block's answers meet them.
    header = [owner, block, names.astype("<i8").tobytes(), known.astype("<u4").tobytes(), b"", b"", None if comps is None else b""]
    joined = [pa.concat_arrays([c, pa.array([h], c.type)]) for c, h in zip(columns, header)]
    return pa.RecordBatch.from_arrays(joined, ["part", "block", "names", "known", "sets", "grams", "comps"])


def _counted(group: pa.Table) -> pa.Table:
    """A part's answers: of each block's sets, how many grams were asked for more than once.

    Where components are given, by how many grams another component asked for too.
    """
    group = group.combine_chunks()
    names, known, blocks = group["names"], group["known"], group["block"]
    asked = [np.frombuffer(x.as_buffer(), "<u2") for x in group["sets"]]
    row = np.repeat(np.arange(len(asked)), [len(x) for x in asked])
    sets = np.concatenate(asked).astype(np.int64)
    narrow = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in group["grams"]])
    wide = np.zeros((len(narrow) // 5, 8), np.uint8)
    wide[:, :5] = narrow.reshape(-1, 5)
    grams = wide.view("<u8").ravel()
    order = np.argsort(grams)
    grams = grams[order]
    equal = grams[1:] == grams[:-1]
    several = order[np.r_[False, equal] | np.r_[equal, False]] if len(grams) else order
    comps = [np.frombuffer(x.as_buffer(), "<i8") for x in group["comps"] if x.is_valid]
    if comps and len(grams):
        comps = np.concatenate(comps)[order]
        first = np.flatnonzero(np.r_[True, ~equal])
        differ = np.minimum.reduceat(comps, first) < np.maximum.reduceat(comps, first)
        several = order[np.repeat(differ, np.diff(np.r_[first, len(grams)]))]
    found, counts = np.unique((row[several] << 16) | sets[several], return_counts=True)
    ends = np.searchsorted(found >> 16, np.arange(len(asked)), side="right")
    answers = pa.table(
        {
            "block": blocks,
            "names": names,
            "known": known,
            "sets": _packed(_as_bytes(found & 0xFFFF, "<u2"), ends),
            "counts": _packed(_as_bytes(counts, "<u4"), ends),
        }
    )
    told = pc.or_(pc.is_valid(answers["names"]), pc.greater(pc.binary_length(answers["sets"]), 0))
    return answers.filter(told)


def _summed(group: pa.Table) -> pa.Table:
    """``(key, shared)`` of a block's sets, from the answers of all parts."""
    group = group.combine_chunks()
    read = lambda column, kind: [
        np.frombuffer(x.as_buffer(), kind) for x in group[column] if x.is_valid
    ]
    keys = np.concatenate(read("names", "<i8"))
    shared = np.concatenate(read("known", "<u4")).astype(np.int64)
    sets, counts = np.concatenate(read("sets", "<u2")), np.concatenate(read("counts", "<u4"))
    shared += np.bincount(sets, counts, len(keys)).astype(np.int64)
    return pa.table({"key": pa.array(keys), "shared": pa.array(shared)})


def _shared_counts(docs: DataFrame, grams: int, n: int, last: np.ndarray) -> DataFrame:
    """``(key, shared)``: at least how many grams of each set any other set may have too.

    The upper bound is what matters: a gram counts when it is in another block or set, when
    it is one of the frequent ones, or (rarely) when another gram's hash agrees in all bits
    that are kept; so sets with copies in other blocks always pass. Grams are dealt out by
    hash; what a block of sets asks of a part is one row, seven bytes a gram, and what the
    part answers is one row too, six bytes a set that shares a gram. Both are bounded by the
    grams. Frequent grams are not sent, so no gram fills a part.

    If ``docs`` has a column ``comp``, only grams of sets of another component count.
    """
    named = "comp" in docs.columns
    parts = max(1, grams // PART_GRAMS)
    shared = docs.sparkSession.sparkContext.broadcast(last)

    def request(batches):
        frequent = shared.value
        task, blocks = TaskContext.get().partitionId(), 0
        seen: set[int] = set()

        def block():
            # The same name when a lost task is run again, another one for an equal block.
            nonlocal blocks
            blocks += 1
            own = np.array(keys, np.int64)
            name = set_key(np.r_[own, task, blocks].view(np.uint64))
            return _requests(own, np.array(known), sets, np.array(comps) if named else None, parts, name)

        for batch, texts in slices(batches, "text", 2 * _SLICE):
            keys, sets, known, comps = [], [], [], []
            others = batch.column(1).to_pylist() if named else itertools.repeat(None)
            for own, comp in zip(gram_sets(texts, n), others):
                key = set_key(own)
                if not len(own) or key in seen:
                    continue
                seen.add(key)
                at = np.searchsorted(frequent, own)
                at[at == len(frequent)] = 0
                common = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
                keys.append(key)
                known.append(int(common.sum()))
                comps.append(comp)
                sets.append(own[~common] if common.any() else own)
                if len(keys) == BLOCK_SETS:
                    yield block()
                    keys, sets, known, comps = [], [], [], []
            if keys:
                yield block()
        give_back()

    asked = docs.select("text", *(["comp"] if named else [])).mapInArrow(
        request, "part int, block long, names binary, known binary, sets binary, grams binary, comps binary"
    )
    answers = asked.groupBy("part").applyInArrow(
        _counted, "block long, names binary, known binary, sets binary, counts binary"
    )
    found = answers.groupBy("block").applyInArrow(_summed, "key long, shared long")
    return found.groupBy("key").agg(F.max("shared").alias("shared"))


def _described(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, uid, size, key)`` of every document; key is null without words."""

    def describe(batches):
        for batch, texts in slices(batches, "text", _SLICE):
            sets = [(len(s), set_key(s) if len(s) else None) for s in gram_sets(texts, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s for s, _ in sets], pa.int64()), pa.array([k for _, k in sets], pa.int64())],
                ["doc_id", "uid", "size", "key"],
            )
        give_back()

    return docs.mapInArrow(describe, "doc_id long, uid long, size long, key long")


def _verified(pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b, text_a, text_b)`` that are linked."""

    def verify(batches):
        overlap = Overlap(percent)
        for batch in batches:
            sets = zip(sliced_sets(batch.column(2), n), sliced_sets(batch.column(3), n))
            good = pa.array([linked(a, b, overlap) for a, b in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(good), batch.column(1).filter(good)], ["a", "b"]
            )
        give_back()

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def _searched(cells: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between components inside each cell of rows ``(cell, key, comp, text)``.

    Each component is searched against the others; the largest one does not search itself.
    """

    def search(group: pa.Table) -> pa.Table:
        keys = group["key"].to_pylist()
        comps = group["comp"].to_pylist()
        sets = [own for chunk in group["text"].chunks for own in sliced_sets(chunk, n)]
        # A link inside the largest component joins nothing: its sets come last and only answer.
        largest, answering = Counter(comps).most_common(1)[0]
        order = sorted(range(len(comps)), key=lambda i: comps[i] == largest)
        keys, comps = [keys[i] for i in order], [comps[i] for i in order]
        lists = Lists([sets[i] for i in order], Overlap(percent))
        parent = {c: c for c in comps}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        links = []
        for i in range(len(keys) - answering):
            for j in lists.search(i):
                a, b = root(comps[i]), root(comps[j])
                if a != b:
                    parent[a] = b
                    links.append((keys[i], keys[j]))
        return pa.table(
            {
                "a": pa.array([a for a, _ in links], pa.int64()),
                "b": pa.array([b for _, b in links], pa.int64()),
            }
        )

    return cells.groupBy("cell").applyInArrow(search, "a long, b long")


def similar_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 75,
) -> DataFrame:
    """Connected components of documents whose shingle sets are similar.

    Texts are lower-cased (A-Z), cut into words at ASCII white space, and read as sets of
    ``n``-word shingles, hashed to 64 bits. Two link when ``100·|∩| ≥ percent·|∪|``. No
    link between different sets is lost; equal sets are one node from the start.

    1. A set can only link if ``percent`` of its grams occur in other sets: all grams are
       compared, and only such sets go on.
    2. Two linked sets share one of their first grams in any common order. The order puts
       grams that are frequent in a sample last, then goes by hash. Grams in the prefix
       of one set only are dropped by a partial aggregation.
    3. In each remaining list, sets that share much of their prefix with the list's
       smallest set are compared with it alone. That joins large groups of near copies
       with one comparison per member.
    4. A set can only join another component if ``percent`` of its grams occur in sets of
       other components; these are counted over the sets that are left, and only such sets
       and the lists with several components of them go on.
    5. The lists are searched: sets connected by such lists are a cluster, and T-occurrence search by DivideSkip (:class:`Lists`) finds
       the links inside it. Clusters of more than ``BLOCK_GRAMS`` are cut
       in blocks, each two of which are a task; those of very many blocks are searched
       list by list instead, equal lists once.

    Returns ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id in reach.
    A null or empty text, or one without words, has no shingles and is alone; null ids
    are never the smallest (a component of them alone has a null id); repeated rows give
    repeated rows; other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    plain = rows_of(docs, id_col, text_col).toDF("doc_id", "text")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = plain.select(F.col("doc_id").cast("long"), lowered.alias("text"))
    uid = F.coalesce("doc_id", F.xxhash64("text"))
    described = stored(_described(plain.select("doc_id", uid.alias("uid"), "text"), n), "sets")
    total, grams = described.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    last = _frequent(plain, total, n, percent)
    sizes = described.filter("size > 0").groupBy("key").agg(
        F.first("size").alias("size"), F.min("uid").alias("uid")
    )

    # Sets of which enough grams are found elsewhere, and their texts.
    least = F.ceil(F.col("size") * percent / 100)
    members = _shared_counts(plain, grams, n, last).join(sizes, "key").filter(F.col("shared") >= least)
    members = stored(members.select("uid", "key"), "members")
    fetched = _likely(plain.select(uid.alias("uid"), "text"), members).join(members, "uid")
    texts = stored(_same_key(fetched, n).dropDuplicates(["key"]), "candidates")

    # Grams of several sets' prefixes, and who has them.
    tokens = _tokens(texts, n, percent, last)
    common = tokens.groupBy("gram").agg(F.min("key").alias("rep"), F.max("key").alias("top"))
    common = common.filter("rep < top").select("gram", "rep")
    postings = stored(tokens.join(common, "gram").select("gram", "rep", "key"), "postings")

    # Most of a large group hangs on its smallest member.
    least = F.floor((F.col("size") * (100 - percent) + 199) / 200)
    pairs = postings.filter("key <> rep").groupBy("key", "rep").agg(F.count("*").alias("n"))
    pairs = pairs.join(sizes.select("key", "size"), "key").filter(F.col("n") >= least)
    pairs = pairs.select(F.col("key").alias("a"), F.col("rep").alias("b"))
    with_texts = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    with_texts = with_texts.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    stars = stored(_verified(with_texts, n, percent), "stars")
    first = components(stars, "first")

    # Lists that hold several components yet, each different list once.
    first = first.select(F.col("node").alias("key"), F.col("component").alias("comp"))
    owned = postings.select("gram", "key").join(first, "key", "left")
    owned = owned.withColumn("comp", F.coalesce("comp", "key"))
    open_ = owned.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    owned = stored(owned.join(open_.filter("low < high").select("gram"), "gram").distinct().join(sizes.select("key", "size"), "key"), "open")
    owned = stored(_narrowed(owned, texts, n, percent, last), "narrowed")
    heads = owned.groupBy("gram").agg(F.min("key").alias("b"))
    clusters = components(owned.join(heads, "gram").select(F.col("key").alias("a"), "b"), "clusters")
    clusters = clusters.select(F.col("node").alias("key"), F.col("component").alias("cell"))
    clusters = clusters.join(owned.select("key", "comp", "size").distinct(), "key")
    blocks = F.ceil(F.sum("size") / BLOCK_GRAMS).cast("int").alias("blocks")
    clusters = stored(clusters.join(clusters.groupBy("cell").agg(blocks), "cell"), "clusters")
    usual = clusters.filter(F.col("blocks") <= MOST_BLOCKS)
    huge = clusters.filter(F.col("blocks") > MOST_BLOCKS).select("key")
    cells = _block_cells(usual, "cell").union(_list_cells(owned.join(huge, "key")))
    found = _searched(cells.join(texts, "key").select("cell", "key", "comp", "text"), n, percent)
    links = stored(stars.union(stored(found, "found")), "links")
    final = components(links, "final").select(F.col("node").alias("key"), "component")

    members = described.join(final, "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    named = members.filter("size > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return members.join(named, "component", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _likely(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows whose ``uid`` may be among the members', so that the join moves few other texts.

    One bit for each hash, ``MARKS`` a member, in bitmaps of 4 kB that all tasks hold: 8 MB
    at most, beyond which more rows get through.
    """
    maps = max(1, min(MOST_MAPS, -(-MARKS * members.count() // MAP_BITS)))
    mark = F.pmod(F.xxhash64("uid"), F.lit(maps * MAP_BITS))
    place = F.pmod(mark, F.lit(MAP_BITS))
    number = F.floor(mark / MAP_BITS)
    bitmaps = members.groupBy(number.alias("number")).agg(F.bitmap_construct_agg(place).alias("bits"))
    byte = F.substring("bits", (F.floor(F.col("place") / 8) + 1).cast("int"), F.lit(1))
    marked = rows.withColumns({"number": number, "place": place}).join(F.broadcast(bitmaps), "number")
    bit = F.conv(F.hex(byte), 16, 10).cast("int")
    return marked.filter(F.getbit(bit, (F.col("place") % 8).cast("int")) == 1).select("uid", "text")


def _narrowed(owned: DataFrame, texts: DataFrame, n: int, percent: int, last: np.ndarray) -> DataFrame:
    """Rows of ``owned`` whose sets may link with another component, in lists of several."""
    left = owned.select("key", "comp", "size").distinct()
    grams = left.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    counts = _shared_counts(texts.join(left, "key").select("text", "comp"), grams, n, last)
    able = left.join(counts, "key").filter(F.col("shared") >= F.ceil(F.col("size") * percent / 100))
    owned = owned.join(able.select("key"), "key", "left_semi")
    lists = owned.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return owned.join(lists.filter("low < high").select("gram"), "gram", "left_semi")


def _list_cells(rows: DataFrame) -> DataFrame:
    """Cells of the lists ``(gram, key, comp, size)`` of clusters too large to be one.

    Equal lists are taken once. A list of more than ``BLOCK_GRAMS`` grams is cut in
    blocks by key, and each two blocks are a cell.
    """
    mark = F.xxhash64("key")
    lists = rows.groupBy("gram").agg(
        F.sum("size").alias("grams"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 24)).alias("s")
    )
    lists = lists.groupBy("grams", "x", "s").agg(F.min("gram").alias("gram")).select("gram", "grams")
    blocks = F.ceil(F.col("grams") / BLOCK_GRAMS).cast("int")
    rows = rows.join(lists, "gram").withColumn("blocks", blocks)
    return _block_cells(rows, "gram")


def _block_cells(rows: DataFrame, name: str) -> DataFrame:
    """Rows dealt to ``blocks`` blocks by key; each two blocks of a ``name`` are a cell."""
    own = F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks").cast("long")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cell = lambda j: F.xxhash64(name, F.least("own", j), F.greatest("own", j))
    rows = rows.withColumn("own", own)
    return rows.select(F.explode(F.transform(every, cell)).alias("cell"), "key", "comp")


def _same_key(fetched: DataFrame, n: int) -> DataFrame:
    """Rows whose text has the key it was fetched for: ids may repeat."""

    def check(batches):
        for batch, texts in slices(batches, "text", _SLICE):
            keys = [set_key(s) for s in gram_sets(texts, n)]
            good = pc.equal(pa.array(keys, pa.int64()), batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).filter(good), texts.filter(good).cast(pa.string())], ["key", "text"]
            )
        give_back()

    return fetched.select("uid", "key", "text").mapInArrow(check, "key long, text string")
