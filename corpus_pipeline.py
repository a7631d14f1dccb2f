"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, packing.

Every stage gets the rows its predecessor kept, with the columns of ``documents``, and
returns those columns; the last returns packed pieces. ``run`` writes each stage's result
and reads it again, so lost executors cost no earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pageloom.llm import decontamination, language_id, ngram_join, packing, pii
from pageloom.llm.queries import EXAMPLE_KEY
from pageloom.llm.stages import stored
from pageloom.llm.tokens import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Posterior probability below which a text's language is not settled.
LEAST_SCORE = 0.5


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is settled; ``lang`` stays as it was given.

    Null, empty and letterless texts go, as nothing says what language they are in. Where
    no document has a language, none is learned and nothing can be rejected: all rows stay.
    """
    model = language_id.train(docs, vocabulary("piece_bpe_32k.model"))
    if not model.languages:
        return docs.select(*COLUMNS)
    found = language_id.identify(docs, model, keep=COLUMNS[1:])
    kept = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.filter(kept).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of every component the document with the smallest id, once.

    Rows are told apart by a 64-bit hash of id and text, so different texts of one id are
    documents of their own and rows with a null id take part; a null id counts as the
    largest. Of rows that are equal in both, one stays.
    """
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("uid"))
    found = ngram_join.similar_components(rows, id_col="uid")
    found = found.select(F.col("doc_id").alias("uid"), "component_id").distinct()
    keys = rows.select("uid", "doc_id").distinct().join(found, "uid")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).getField("uid")
    kept = keys.groupBy("component_id").agg(first.alias("uid")).select("uid")
    once = F.row_number().over(Window.partitionBy("uid").orderBy("lang", "source"))
    named = rows.join(stored(kept, "first"), "uid")
    return named.withColumn("n", once).filter("n = 1").select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item; rows with a null id are matched by text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    uid = F.coalesce("doc_id", F.xxhash64("text"))
    rows = docs.select(*COLUMNS).withColumn("uid", uid)
    found = decontamination.benchmark_matches(rows, benchmark, id_col="uid")
    # Stored first, so that its true size decides whether the join needs a shuffle.
    hit = stored(found.select(F.col("doc_id").alias("uid")).distinct(), "contaminated")
    return rows.join(hit, "uid", "left_anti").select(*COLUMNS)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal numbers, dates and addresses in every text."""
    found = pii.pseudonymize(docs, EXAMPLE_KEY, keep=["lang", "source"])
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", in_known_language),
    ("ngram_join", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("pseudonyms", with_pseudonyms),
    ("packing", packed),
]

# Tokenization, piece models and keyed permutations have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
