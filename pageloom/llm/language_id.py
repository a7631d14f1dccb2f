"""Language identification by unigram piece models, summed over all segmentations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import rows_of, slices
from .stages import ship_package, stored

UNDETERMINED = "und"
# Letters that are scored as one word; longer runs are cut.
WORD_LETTERS = 48
# Code points of the longest piece that is looked up.
PIECE_LENGTH = 16
# Expected count that every piece has in every language beforehand.
PRIOR = 0.01
# A smaller probability of a word, or of a part of one, is worked out in logarithms.
_LEAST = 1e-200
# Text that is worked on at once.
SLICE_BYTES = 4 << 20
_SPACE = 0x2581  # the vocabulary's mark of a word's beginning
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOT = np.uint64(42)


class Pieces:
    """The public vocabulary's pieces, found in words by their hashes.

    Number 0 is the unknown piece: any single code point may be read as it.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = {
            t.lower()
            for t in (model.id_to_piece(i) for i in range(model.get_piece_size()))
            if not (t.startswith("<") and t.endswith(">"))
        }
        hashes = {}
        for text in sorted(t for t in texts if 0 < len(t) <= PIECE_LENGTH):
            value = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in text:
                    value = value * _STEP + np.uint64(ord(c))
            hashes.setdefault(int(value), text)
        self.hashes = np.sort(np.array(list(hashes), np.uint64))
        self.size = len(self.hashes) + 1
        self.used = np.zeros(1 << 22, bool)
        self.used[self.slot(self.hashes)] = True

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _STEP) >> _SLOT).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is none."""
        found = np.full(len(hashes), -1, np.int32)
        maybe = np.flatnonzero(self.used[self.slot(hashes)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        right = self.hashes[at] == hashes[maybe]
        found[maybe[right]] = at[right] + 1
        return found


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def letter_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-case runs of letters, at most ``WORD_LETTERS`` each, and their rows.

    No run crosses ASCII white space, so letters are looked for once in every different
    piece between it and not in every text.
    """
    lists = pc.ascii_split_whitespace(texts)
    chunk_row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    chunks = pc.list_flatten(lists).dictionary_encode()
    chunk = chunks.indices.to_numpy(zero_copy_only=False)
    plain = pc.replace_substring_regex(pc.utf8_lower(chunks.dictionary), r"\PL+", " ")
    long = pc.greater_equal(pc.utf8_length(plain), WORD_LETTERS)
    if pc.any(long).as_py():
        cut = pc.replace_substring_regex(plain.filter(long), r"(\pL{" + str(WORD_LETTERS) + "})", r"\1 ")
        plain = pc.replace_with_mask(plain, long, cut)
    lists = pc.ascii_split_whitespace(plain)
    words = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    filled = pc.greater(pc.binary_length(words), 0)
    if not pc.all(filled).as_py():
        words, owner = words.filter(filled), owner[filled.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    # The words of each different piece stand together; every use of it has them all.
    number = np.bincount(owner, minlength=len(plain))
    first = np.cumsum(number) - number
    uses = number[chunk]
    start = np.cumsum(uses) - uses
    at = np.arange(int(uses.sum())) + np.repeat(first[chunk] - start, uses)
    indices = coded.indices.to_numpy(zero_copy_only=False)[at]
    return pa.DictionaryArray.from_arrays(pa.array(indices), coded.dictionary), np.repeat(chunk_row, uses)


def _by_length(words: pa.Array):
    """Groups of words of one length: their numbers and code points, mark first."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), 20_000):
            some = rows[at : at + 20_000]
            joined = "".join(words.take(pa.array(some)).to_pylist())
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(-1, size)
            mark = np.full((len(some), 1), _SPACE, np.uint32)
            yield some, np.hstack([mark, points])


def _piece_numbers(points: np.ndarray, vocabulary: Pieces) -> list[list[np.ndarray]]:
    """``[i][k-1]``: number of the piece of ``k`` code points that ends before ``i+1``."""
    n, size = points.shape
    wide = points.astype(np.uint64)
    hashes = np.zeros((n, size), np.uint64)
    out: list[list[np.ndarray]] = [[] for _ in range(size)]
    for k in range(1, min(size, PIECE_LENGTH) + 1):
        hashes = hashes[:, : size - k + 1] * _STEP + wide[:, k - 1 :]
        found = vocabulary.find(hashes.ravel()).reshape(n, -1)
        for start in range(size - k + 1):
            number = found[:, start]
            out[start + k - 1].append(np.maximum(number, 0) if k == 1 else number)
    return out


def _forward(numbers: list[list[np.ndarray]], table: np.ndarray) -> list[np.ndarray]:
    """Probability of every prefix in every language, all segmentations summed.

    ``table`` is pieces by languages with a last row of zeros for "no such piece" (-1).
    """
    n = len(numbers[0][0])
    prefix = [np.ones((n, table.shape[1]))]
    for ends in numbers:
        total = np.zeros((n, table.shape[1]))
        for k, number in enumerate(ends, 1):
            rows = np.flatnonzero(number >= 0)
            if len(rows) == n:
                total += table[number] * prefix[-k]
            elif len(rows):
                total[rows] += table[number[rows]] * prefix[-k][rows]
        prefix.append(total)
    return prefix


def _log_forward(numbers: list[list[np.ndarray]], logs: np.ndarray) -> list[np.ndarray]:
    """As :func:`_forward`, in logarithms: for words whose probability a double cannot hold."""
    n, width = len(numbers[0][0]), logs.shape[1]
    prefix = [np.zeros((n, width))]
    for ends in numbers:
        total = np.full((n, width), -np.inf)
        for k, number in enumerate(ends, 1):
            some = np.flatnonzero(number >= 0)
            if len(some):
                total[some] = np.logaddexp(total[some], logs[number[some]] + prefix[-k][some])
        prefix.append(total)
    return prefix


def _part(numbers: list[list[np.ndarray]], rows: np.ndarray) -> list[list[np.ndarray]]:
    return [[number[rows] for number in ends] for ends in numbers]


def _logs(table: np.ndarray) -> np.ndarray:
    return np.log(table[:-1])  # all but the row of zeros


def word_scores(words: pa.Array, table: np.ndarray, vocabulary: Pieces) -> np.ndarray:
    """Natural-log probability of each word in each language; always finite."""
    scores = np.zeros((len(words), table.shape[1]))
    for rows, points in _by_length(words):
        numbers = _piece_numbers(points, vocabulary)
        last = _forward(numbers, table)[-1]
        small = np.flatnonzero((last < _LEAST).any(axis=1))
        scores[rows] = np.log(np.maximum(last, _LEAST))
        if len(small):
            scores[rows[small]] = _log_forward(_part(numbers, small), _logs(table))[-1]
    return scores


def expected_counts(
    words: pa.Array, counts: np.ndarray, table: np.ndarray, vocabulary: Pieces
) -> np.ndarray:
    """Expected uses of each piece, given counts of words (rows) by language."""
    out = np.zeros(table.shape)
    for rows, points in _by_length(words):
        numbers = _piece_numbers(points, vocabulary)
        prefix = _forward(numbers, table)
        small = (prefix[-1] < _LEAST).any(axis=1)
        if small.any():
            own = np.flatnonzero(small)
            _add_log_uses(out, _part(numbers, own), counts[rows[own]], _logs(table))
            kept = np.flatnonzero(~small)
            if not len(kept):
                continue
            numbers, rows = _part(numbers, kept), rows[kept]
            prefix = [p[kept] for p in prefix]
        weight = counts[rows] / prefix[-1]
        size = len(numbers)
        suffix = [np.zeros_like(weight) for _ in range(size)] + [np.ones_like(weight)]
        for end in range(size, 0, -1):
            for k, number in enumerate(numbers[end - 1], 1):
                some = np.flatnonzero(number >= 0)
                if not len(some):
                    continue
                through = table[number[some]] * suffix[end][some]
                suffix[end - k][some] += through
                use = through * prefix[end - k][some] * weight[some]
                for j in range(table.shape[1]):
                    out[:, j] += np.bincount(number[some], use[:, j], len(out))[: len(out)]
    return out


def _add_log_uses(
    out: np.ndarray, numbers: list[list[np.ndarray]], counts: np.ndarray, logs: np.ndarray
) -> None:
    """Add expected uses of pieces in words that only logarithms can hold."""
    prefix = _log_forward(numbers, logs)
    size = len(numbers)
    suffix = [np.full_like(prefix[0], -np.inf) for _ in range(size)] + [np.zeros_like(prefix[0])]
    for end in range(size, 0, -1):
        for k, number in enumerate(numbers[end - 1], 1):
            some = np.flatnonzero(number >= 0)
            if not len(some):
                continue
            through = logs[number[some]] + suffix[end][some]
            suffix[end - k][some] = np.logaddexp(suffix[end - k][some], through)
            use = np.exp(through + prefix[end - k][some] - prefix[-1][some]) * counts[some]
            for j in range(logs.shape[1]):
                out[:, j] += np.bincount(number[some], use[:, j], len(out))[: len(out)]


def _table(counts: np.ndarray) -> np.ndarray:
    """Piece probabilities by language from expected counts, and the row of zeros."""
    counts = counts + PRIOR
    return np.vstack([counts / counts.sum(axis=0), np.zeros((1, counts.shape[1]))])


class LanguageModel:
    """Languages, their piece probabilities and their shares of the words."""

    def __init__(self, path: str, languages: list[str], table: np.ndarray, prior: np.ndarray):
        self.path, self.languages, self.table, self.prior = path, languages, table, prior


def train(
    docs: DataFrame,
    vocabulary_path: str,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    rounds: int = 2,
) -> LanguageModel:
    """Learn piece probabilities per language by expectation-maximisation.

    Words are counted by language where they are read; the counts are stored once, dealt
    out by word, and every round adds up the expected uses of pieces in each part. The
    driver sees one number per piece and language only, bounded by the fixed vocabulary.
    All rows with a text and a language are used. Without any, there are no languages.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = rows_of(docs, text_col, lang_col).toDF("text", "lang").dropna()

    def count(batches):
        for batch, texts in slices(batches, "text", SLICE_BYTES):
            coded, row = letter_words(texts)
            lang = batch.column(1).dictionary_encode()
            if not len(coded):
                continue
            own = lang.indices.to_numpy(zero_copy_only=False)[row].astype(np.int64)
            word = coded.indices.to_numpy(zero_copy_only=False)
            pairs, n = np.unique(own * len(coded.dictionary) + word, return_counts=True)
            own, word = np.divmod(pairs, len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(own)), coded.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(n)],
                ["lang", "word", "n"],
            )

    counted = rows.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    counted = stored(counted.groupBy("word", "lang").agg(F.sum("n").alias("n")), "language-words")
    sums = counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in sums]
    if not languages:
        return LanguageModel(vocabulary_path, [], np.zeros((1, 0)), np.zeros(0))
    prior = np.array([r["n"] for r in sums], float)
    column = {lang: j for j, lang in enumerate(languages)}
    vocabulary = pieces(vocabulary_path)
    table = _table(np.zeros((vocabulary.size, len(languages))))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(table)

        def expect(batches):
            own, probabilities = pieces(vocabulary_path), shared.value
            total = np.zeros(probabilities.shape)
            for batch in batches:
                coded = batch.column(0).dictionary_encode()
                counts = np.zeros((len(coded.dictionary), len(column)))
                which = [column[x] for x in batch.column(1).to_pylist()]
                counts[coded.indices.to_numpy(zero_copy_only=False), which] += batch.column(2)
                total += expected_counts(coded.dictionary, counts, probabilities, own)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])],
                ["piece", "lang", "uses"],
            )

        uses = counted.select("word", "lang", "n").mapInArrow(expect, "piece long, lang long, uses double")
        counts = np.zeros((vocabulary.size, len(languages)))
        summed = uses.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        counts[summed["piece"], summed["lang"]] = summed["uses"]
        table = _table(counts)
    return LanguageModel(vocabulary_path, languages, table, prior / prior.sum())


def identify(
    docs: DataFrame,
    model: LanguageModel,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the most probable language of every text.

    Returns ``doc_id``, ``lang_pred``, ``score`` (posterior probability of that language,
    0 to 1) and ``nats_per_letter`` (how improbable the text is in it), then the columns
    named by ``keep``. Only the text is looked at. A null or empty text or one without a
    letter is ``und`` with score 0, as is everything when no language was learned. Ties go
    to the first language in alphabetical order. Rows are scored one by one, repeated ones
    too; null ids pass through.
    """
    ship_package(docs.sparkSession)
    keep = keep or []
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        own = shared.value
        vocabulary, width = pieces(own.path), len(own.languages)
        for batch, texts in slices(batches, "text", SLICE_BYTES):
            n = batch.num_rows
            coded, row = letter_words(texts)
            letters = np.zeros(n)
            total = np.zeros((n, width))
            if width and len(coded):
                total += np.log(own.prior)
                word = coded.indices.to_numpy(zero_copy_only=False)
                scores = word_scores(coded.dictionary, own.table, vocabulary)
                size = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)
                letters = np.bincount(row, size[word], n)
                for j in range(width):
                    total[:, j] += np.bincount(row, scores[word, j], n)
            known = letters > 0
            best = total.argmax(axis=1) if width else np.zeros(n, np.int64)
            top = total[np.arange(n), best] if width else np.zeros(n)
            share = 1 / np.exp(total - top[:, None]).sum(axis=1) if width else np.zeros(n)
            names = np.array([*own.languages, UNDETERMINED], object)
            arrays = [
                batch.column(0),
                pa.array(names[np.where(known, best, width)], pa.string()),
                pa.array(np.where(known, share, 0.0)),
                pa.array(np.where(known, -top / np.maximum(letters, 1), 0.0)),
            ]
            fields = ["doc_id", "lang_pred", "score", "nats_per_letter", *keep]
            arrays += [batch.column(batch.schema.get_field_index(name)) for name in keep]
            yield pa.RecordBatch.from_arrays(arrays, fields)

    plain = rows_of(docs, id_col, text_col, *(c for c in keep if c != "text"))
    plain = plain.toDF("doc_id", "text", *(c for c in keep if c != "text"))
    kinds = dict(plain.dtypes)
    schema = f"doc_id {kinds['doc_id']}, lang_pred string, score double, nats_per_letter double"
    schema += "".join(f", `{c}` {kinds[c]}" for c in keep)
    return plain.mapInArrow(score, schema)
