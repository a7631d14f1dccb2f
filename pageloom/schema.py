"""The record types that operators exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .functions.reuse import per_application

_texts = T.ArrayType(T.StringType())

PAGE_RECORD = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("meta_description", T.StringType()),
        T.StructField("meta_keywords", T.StringType()),
        T.StructField("headings", T.MapType(T.StringType(), _texts)),
        T.StructField("paragraphs", _texts),
        T.StructField("links", _texts),
        T.StructField("internal_links", _texts),
        T.StructField("external_links", _texts),
        T.StructField("images", _texts),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
RECORD_FIELDS = PAGE_RECORD.fieldNames()

FETCH = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Rows of the page table: lists and headings as JSON text, folders by run and attempt.
TABLE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("meta_description", T.StringType()),
        T.StructField("meta_keywords", T.StringType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("paragraphs", T.StringType()),
        T.StructField("headings", T.StringType()),
        T.StructField("links", T.StringType()),
        T.StructField("images", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("attempt", T.StringType()),
    ]
)

# Fields whose default is null; all others default to "", 0 or an empty collection.
NULLABLE_FIELDS = ("url", "status_code", "error")


def default_value(field: T.StructField) -> Column:
    kind = field.dataType
    if field.name in NULLABLE_FIELDS:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    return F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)


@per_application
def _record_columns(present: frozenset[str]) -> tuple[Column, ...]:
    columns = []
    for field in PAGE_RECORD:
        if field.name not in present:
            value = default_value(field)
        elif field.name in NULLABLE_FIELDS:
            value = F.col(field.name).cast(field.dataType)
        else:
            value = F.coalesce(F.col(field.name).cast(field.dataType), default_value(field))
        columns.append(value.alias(field.name))
    return tuple(columns)


def with_defaults(df: DataFrame, *extra: str) -> DataFrame:
    """Exactly the record fields (plus ``extra`` columns), absent values defaulted."""
    present = frozenset(df.columns) & frozenset(RECORD_FIELDS)
    return df.select(*extra, *_record_columns(present))
