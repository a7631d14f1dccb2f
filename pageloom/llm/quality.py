"""A ledger of quality rules: failure bits and measurements, read by versioned policies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import rows_of

WINDOW_WORDS = 8
_SPACE = "[ \\t-\\r]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur at least twice in the text.

    The hash of every window is paired with its place and the pairs are sorted, so equal
    windows are neighbours. The places found are sorted again; each covers eight words,
    of which those before the next place are counted.
    """
    none = _number(0)

    def windows(codes: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(codes) - (WINDOW_WORDS - 1))
        return F.transform(
            places, lambda i: F.xxhash64(*(F.get(codes, i + (k - 1)) for k in range(WINDOW_WORDS)))
        )

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(sorted_pairs: Column) -> Column:
            n = F.size(sorted_pairs)
            hit = F.filter(
                sorted_pairs,
                lambda x, j: ((j > 0) & (F.get(sorted_pairs, j - 1)["h"] == x["h"]))
                | ((j < n - 1) & (F.get(sorted_pairs, j + 1)["h"] == x["h"])),
            )
            return F.array_sort(F.transform(hit, lambda x: x["i"]))

        def total(places: Column) -> Column:
            return F.aggregate(
                F.transform(
                    places,
                    lambda p, j: F.when(j + 1 < F.size(places), F.least(F.get(places, j + 1) - p, F.lit(WINDOW_WORDS))).otherwise(WINDOW_WORDS),
                ),
                none,
                lambda a, x: a + x,
            )

        return _let(_let(pairs, twice), total)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(covered(hashes))

    codes = F.transform(words, lambda w: F.xxhash64(w))
    found = _let(_let(codes, windows), counted)
    return F.when(F.size(words) > WINDOW_WORDS, found).otherwise(none)


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` holds; its place in ``RULES`` is its bit for ever."""

    name: str
    fails: Callable[[], Column]


# Only ever append: stored ledgers keep their bits.
RULES = (
    Rule("few_words", lambda: F.col("n_words") < 20),
    Rule("repeated_windows", lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule("symbol_words", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule("shouting", lambda: 2 * F.col("n_upper") > F.col("n_letters")),
    Rule("bang_words", lambda: 2 * F.col("n_bangs") > F.col("n_words")),
    Rule("bar_words", lambda: 4 * F.col("n_bars") > F.col("n_words")),
    Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("long_words", lambda: F.col("word_chars") > 25 * F.col("n_words")),
    Rule("short_words", lambda: 2 * F.col("word_chars") < 3 * F.col("n_words")),
)
BITS = {rule.name: 1 << i for i, rule in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_windows"]
# Policies by version: the rules whose failure rejects a document.
POLICIES = {
    1: BASE,
    2: sum(BITS.values()),
}
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_bangs", "n_bars",
)


def rule_ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Evaluate every rule once: measurements and a mask of the rules that fail.

    Words are runs of characters other than ASCII white space; lines end at ``\\n`` and
    count if they hold a word. ``fail_bits`` has bit *i* set where ``RULES[i]`` fails.
    Native expressions inside one projection per row; nothing is shuffled, and Spark
    reads only the id and the text. Windows are compared by 64-bit hashes.

    A null or empty text has zero in every measurement and so fails ``few_words`` only.
    Null ids and repeated rows pass through row by row; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, " \t\n\x0b\f\r", "") != "")
    solid = F.translate(text, " \t\n\x0b\f\r", "")
    # First what is shared by several measurements, so that each is computed once.
    parts = rows_of(docs, id_col, text_col).toDF("doc_id", "text").select(
        "doc_id",
        text.alias("text"),
        F.length(solid).alias("n_solid"),
        _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("r"))).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("x"),
    )

    def without(characters: str) -> Column:
        return F.length("text") - F.length(F.translate("text", characters, ""))

    def long(value: Column) -> Column:
        return value.cast("bigint")

    measured = parts.select(
        "doc_id",
        long(F.col("w.n")).alias("n_words"),
        long(F.col("n_solid")).alias("word_chars"),
        long(without("#*$%&|<>")).alias("n_symbols"),
        long(F.col("x.n") - F.col("x.d")).alias("n_dup_lines"),
        F.col("w.r").alias("n_repeat_words"),
        long(F.col("x.n")).alias("n_lines"),
        long(without("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_letters"),
        long(without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_upper"),
        long(without("!")).alias("n_bangs"),
        long(without("|")).alias("n_bars"),
    )
    bits = [F.when(rule.fails(), _number(BITS[rule.name])).otherwise(_number(0)) for rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total)


def apply_policy(ledger: DataFrame, version: int) -> DataFrame:
    """Add ``policy_bits`` (failures that this policy counts) and ``kept``.

    A stored ledger can be judged by any version without reading a text again.
    """
    counted = F.col("fail_bits").bitwiseAND(_number(POLICIES[version]))
    return ledger.withColumns({"policy_bits": counted, "kept": counted == 0})


def ablations(ledger: DataFrame, version: int) -> DataFrame:
    """Per rule of a policy: documents failing it, and those only it rejects.

    One pass of bitwise sums over the ledger with map-side combination. A rule without a
    failure has zeros; an empty ledger gives zeros for every rule.
    """
    policy = POLICIES[version]
    names = [rule.name for rule in RULES if BITS[rule.name] & policy]
    counted = F.col("fail_bits").bitwiseAND(_number(policy))
    sums = []
    for name in names:
        bit = _number(BITS[name])
        sums += [
            F.count(F.when(counted.bitwiseAND(bit) != 0, 1)).alias(f"fail_{name}"),
            F.count(F.when(counted == bit, 1)).alias(f"only_{name}"),
        ]
    totals = ledger.agg(F.count("*").alias("n"), F.count(F.when(counted != 0, 1)).alias("out"), *sums)
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"fail_{name}").alias("failing"),
                F.col(f"only_{name}").alias("only_this"),
                (F.col("out") - F.col(f"only_{name}")).alias("rejected_without"),
            )
            for name in names
        )
    )
    return totals.select(F.explode(rows).alias("r"), F.col("n").alias("documents")).select("r.*", "documents")
