"""Language-model scores of documents by deleted interpolation of n-gram estimates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import give_back, hashed_words, mixed, rows_of, slices
from .stages import ship_package, stored

# Text of the documents that one task counts and scores together.
BLOCK_BYTES = 5 << 20
# Text of a block whose words are hashed at once: that takes some 40 times its size.
_SLICE = 1 << 20
# Tokens of a block whose estimates are worked out at once.
_STEP = 200_000
# Grams whose counts one task adds up.
PART_GRAMS = 2_000_000
# Contexts fall in buckets by the binary logarithm of their frequency.
BUCKETS = 16
# Steps of an octave at which estimates are told apart when weights are learned.
STEPS = 4
_FLOOR = 120 * STEPS
_END = mixed(np.array([1], np.uint64))[0]
_START = mixed(np.array([2], np.uint64))[0]
_FACTOR = np.uint64(0xD1342543DE82EF95)
_WIDTH = {0: 8, 1: 8, 2: 6}  # bytes kept of a gram's hash, by order; 0 is the start


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """:func:`hashed_words`, worked out for a bounded part of the texts at a time."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    found = [hashed_words(part) for _, part in slices([batch], "text", _SLICE)]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else hashed_words(texts)


class Block:
    """Tokens of some documents and the different grams among them."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.ids, self.held_out = table["doc_id"], table["held_out"]
        texts = table["text"].combine_chunks().cast(pa.large_string())
        words, sizes = _words(texts)
        self.sizes = sizes + 1
        ends = np.cumsum(self.sizes) - 1
        token = np.empty(int(self.sizes.sum()), np.uint64)
        inner = np.ones(len(token), bool)
        inner[ends] = False
        token[inner], token[ends] = words, _END
        self.row = np.repeat(np.arange(len(sizes)), self.sizes)
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[ends - self.sizes + 1] = _START
        pair = mixed(before * _FACTOR + token)
        trained = ~self.held_out.to_numpy(zero_copy_only=False).astype(bool)
        self.trained = trained
        weight = trained[self.row]
        self.grams, self.place, self.counts = {}, {}, {}
        for order, grams in ((1, token), (2, pair)):
            self.grams[order], self.place[order] = np.unique(grams, return_inverse=True)
            self.counts[order] = np.bincount(self.place[order], weight, len(self.grams[order]))
        self.grams[0], self.counts[0] = np.array([_START]), np.array([trained.sum()])
        # A context's count: the word's own, or the documents where it is the start.
        at = np.searchsorted(self.grams[1], before)
        at[at == len(self.grams[1])] = 0
        self.context = np.where(before == _START, -1, at)

    def parts(self, order: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The order in which grams are sent, and the end of each part in it."""
        part = (self.grams[order] >> np.uint64(48)) % np.uint64(parts)
        turn = np.argsort(part, kind="stable")
        return turn, np.searchsorted(part[turn], np.arange(parts), side="right")

    def with_totals(self, answers: pa.Table, parts: int) -> None:
        """Read the corpus counts of the block's grams."""
        self.total = {}
        names = zip(answers["gram_order"].to_pylist(), answers["part"].to_pylist())
        by = {name: x.as_buffer() for name, x in zip(names, answers["totals"])}
        for order in (0, 1, 2):
            turn, ends = self.parts(order, parts)
            total = np.zeros(len(turn), np.int64)
            start = 0
            for part, end in enumerate(ends.tolist()):
                if end > start:
                    total[turn[start:end]] = np.frombuffer(by[order, part], "<i8")
                start = end
            self.total[order] = total

    def spans(self) -> Iterator[slice]:
        """The tokens in slices of whole documents, to be worked on one by one."""
        ends, start = np.cumsum(self.sizes), 0
        while start < len(self.row):
            own, last = np.searchsorted(ends, [start, start + _STEP], side="right")
            stop = int(ends[max(own, last - 1)])
            yield slice(start, stop)
            start = stop

    def of_contexts(self, counts: dict[int, np.ndarray], span: slice) -> np.ndarray:
        context = self.context[span]
        return np.where(context < 0, counts[0][0], counts[1][context])


def _own_counts(row: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """How often each token's value of ``place`` occurs in its own row."""
    keys, back, counts = np.unique(row * np.int64(size) + place, return_inverse=True, return_counts=True)
    return counts[back]


def _requests(docs: DataFrame, parts: int) -> DataFrame:
    def asked(table: pa.Table) -> pa.Table:
        own, out = Block(table), []
        block = table["block"][0].as_py()
        for order in (0, 1, 2):
            turn, ends = own.parts(order, parts)
            width = _WIDTH[order]
            packed = own.grams[order][turn].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            counts = own.counts[order][turn].astype("<u4")
            start = 0
            for part, end in enumerate(ends.tolist()):
                if end > start:
                    out.append((part, block, order, packed[start:end].tobytes(), counts[start:end].tobytes()))
                start = end
        columns = list(zip(*out))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        names = ["part", "block", "gram_order", "grams", "counts"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    def request(table: pa.Table) -> pa.Table:
        out = asked(table)
        give_back()
        return out

    return docs.groupBy("block").applyInArrow(
        request, "part int, block long, gram_order int, grams binary, counts binary"
    )


def _answers(requests: DataFrame) -> DataFrame:
    """Corpus counts for every request, and with order 1 the words and tokens of the part."""

    def answered(table: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(6)]
        part = table["part"][0].as_py()
        for order in (0, 1, 2):
            rows = [i for i, o in enumerate(table["gram_order"].to_pylist()) if o == order]
            if not rows:
                continue
            width, of_order = _WIDTH[order], table.take(rows)
            narrow = [np.frombuffer(x.as_buffer(), np.uint8) for x in of_order["grams"]]
            counts = [np.frombuffer(x.as_buffer(), "<u4") for x in of_order["counts"]]
            sizes = [len(x) for x in counts]
            wide = np.zeros((sum(sizes), 8), np.uint8)
            wide[:, :width] = np.concatenate(narrow).reshape(-1, width)
            _, place = np.unique(wide.view("<u8").ravel(), return_inverse=True)
            sums = np.bincount(place, np.concatenate(counts)).astype("<i8")
            totals = np.split(sums[place], np.cumsum(sizes)[:-1])
            for n, (i, own) in enumerate(zip(rows, totals)):
                first = n == 0 and order == 1
                row = (table["block"][i].as_py(), part, order, own.tobytes(), int((sums > 0).sum()) if first else 0, int(sums.sum()) if first else 0)
                for column, value in zip(out, row):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        names = ["block", "part", "gram_order", "totals", "words", "tokens"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, out, kinds)})

    def answer(table: pa.Table) -> pa.Table:
        out = answered(table)
        give_back()
        return out

    return requests.groupBy("part").applyInArrow(
        answer, "block long, part int, gram_order int, totals binary, words long, tokens long"
    )


def _estimates(own: Block, span: slice, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of every training token of a span, its bigram and its unigram estimate."""
    some = np.flatnonzero(own.trained[own.row[span]])
    row = own.row[span][some]
    pair, word = own.place[2][span][some], own.place[1][span][some]
    context = own.context[span][some]
    both = own.total[2][pair] - _own_counts(row, pair, len(own.grams[2]))
    single = own.total[1][word] - _own_counts(row, word, len(own.grams[1]))
    mine = _own_counts(row, context + 1, len(own.grams[1]) + 1)
    left = own.of_contexts(own.total, span)[some] - mine
    two = np.where(left > 0, both / np.maximum(left, 1), 0.0)
    one = single / np.maximum(tokens - own.sizes[row], 1)
    bucket = np.minimum(np.log2(np.maximum(left, 0) + 1).astype(np.int64), BUCKETS - 1)
    level = [
        np.where(x > 0, np.maximum(np.round(STEPS * np.log2(np.maximum(x, 1e-300))), 1 - _FLOOR), -_FLOOR).astype(np.int64) + _FLOOR
        for x in (two, one)
    ]
    return (bucket * (2 * _FLOOR) + level[0]) * (2 * _FLOOR) + level[1], two, one


def _histogram(docs: DataFrame, answers: DataFrame, parts: int, tokens: int) -> DataFrame:
    """Estimates of the training tokens, each without its own document, in cells."""

    def estimated(table: pa.Table, answered: pa.Table) -> pa.Table:
        own = Block(table)
        own.with_totals(answered, parts)
        found = [_estimates(own, span, tokens) for span in own.spans()]
        cell, two, one = (np.concatenate(x) for x in zip(*found))
        cells, back, n = np.unique(cell, return_inverse=True, return_counts=True)
        return pa.table(
            {
                "bucket": cells // (4 * _FLOOR * _FLOOR), "cell": cells, "n": n,
                "two": np.bincount(back, two, len(cells)), "one": np.bincount(back, one, len(cells)),
            }
        )

    def estimate(table: pa.Table, answered: pa.Table) -> pa.Table:
        out = estimated(table, answered)
        give_back()
        return out

    found = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        estimate, "bucket long, cell long, n long, two double, one double"
    )
    sums = [F.sum(c).alias(c) for c in ("n", "two", "one")]
    return found.groupBy("bucket", "cell").agg(*sums)


def learn_weights(cells: list, words: int, rounds: int = 60) -> np.ndarray:
    """Mixture weights ``(bucket, [bigram, unigram, uniform])`` by expectation-maximisation."""
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    if not cells:
        weights[:] = [0.0, 0.0, 1.0]
        return weights
    bucket = np.array([c["bucket"] for c in cells])
    n = np.array([c["n"] for c in cells], float)
    each = np.array([[c["two"] / c["n"], c["one"] / c["n"], 1 / (words + 1)] for c in cells])
    for _ in range(rounds):
        share = weights[bucket] * each
        share *= (n / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1)
        sums += [0.0, 0.0, 1e-3]
        seen = np.bincount(bucket, n, BUCKETS) > 0
        weights[seen] = sums[seen] / sums[seen].sum(axis=1, keepdims=True)
    return weights


def scores(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out_col: str = "held_out"
) -> DataFrame:
    """Base-10 log probabilities of whole texts under a unigram and a bigram model.

    Tokens are the words between ASCII white space, lower-cased (A-Z), and one end per
    text. Rows whose ``held_out`` is not true are learned from, all of them. A token's
    probability mixes its bigram and unigram maximum-likelihood estimates and a uniform
    one, with weights by the frequency bucket of the context. The weights are learned by
    expectation-maximisation on deleted counts: each training document is held out in
    turn, its own counts taken off. For that, estimates are summed up in cells of a
    quarter octave; the driver gets these cells, whose number is fixed, and nothing else.

    Documents are dealt out to blocks. A block asks for the corpus counts of its different
    grams, by hash (64 bits for words, 48 and the part's number for bigrams), and the
    parts answer in the order asked: the model is never gathered anywhere. A hot gram is
    one number per block.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-0.1 unigrams) and ``score``. Null and empty
    texts are the end alone; a null ``held_out`` counts as false; null ids and repeated
    rows are scored row by row; other columns are not read. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    plain = rows_of(docs, id_col, text_col, held_out_col).toDF("doc_id", "text", "held_out")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = plain.select(F.col("doc_id").cast("long"), text.alias("text"), F.coalesce("held_out", F.lit(False)).alias("held_out"))
    size = plain.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    blocks, parts = max(1, size // BLOCK_BYTES), max(1, size // (8 * PART_GRAMS))
    plain = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    answers = stored(_answers(_requests(plain, parts)), "gram-counts")
    words, tokens = answers.agg(F.sum("words"), F.sum("tokens")).first()
    words, tokens = words or 0, tokens or 0
    asked = answers.select("block", "gram_order", "part", "totals")
    cells = stored(_histogram(plain, asked, parts, tokens), "estimates").collect()
    weights = learn_weights(cells, words)

    def scored(table: pa.Table, answered: pa.Table) -> pa.Table:
        own = Block(table)
        own.with_totals(answered, parts)
        single = own.total[1][own.place[1]]
        base, mixture = np.empty(len(single)), np.empty(len(single))
        for span in own.spans():
            context, one = own.of_contexts(own.total, span), single[span]
            two = np.where(context > 0, own.total[2][own.place[2][span]] / np.maximum(context, 1), 0.0)
            share = weights[np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)]
            mixture[span] = share[:, 0] * two + share[:, 1] * one / max(tokens, 1) + share[:, 2] / (words + 1)
            base[span] = np.log10((one + 0.1) / (tokens + 0.1 * (words + 1)))
        n = len(own.sizes)
        return pa.table(
            {
                "doc_id": own.ids, "held_out": own.held_out, "n_tokens": own.sizes,
                "n_known": np.bincount(own.row, single > 0, n).astype(np.int64),
                "train_tokens": np.full(n, tokens, np.int64),
                "base_score": np.bincount(own.row, base, n),
                "score": np.bincount(own.row, np.log10(np.maximum(mixture, 1e-300)), n),
            }
        )

    def score(table: pa.Table, answered: pa.Table) -> pa.Table:
        out = scored(table, answered)
        give_back()
        return out

    return plain.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
