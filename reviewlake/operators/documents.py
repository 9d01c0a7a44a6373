"""Document collections: conversion, update, delete, constraints, validation, search, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.expr import all_of
from reviewlake.functions.text import search_score

# Document fields that hold instants.
DATETIME_FIELDS = ("registration_date", "review_date", "created_at", "updated_at", "timestamp", "start_time",
                   "end_time")

# Seconds a document lives.
TTL_SECONDS = {"real_time_events": 7 * 24 * 3600, "user_sessions": 30 * 24 * 3600}


def parse_instant(text: Column) -> Column:
    """ISO text (with or without zone) or a bare date to timestamp; null when neither."""
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def convert_datetimes(df: DataFrame, fields: Sequence[str] = DATETIME_FIELDS) -> DataFrame:
    """Text in the named fields becomes a timestamp."""
    types = dict(df.dtypes)
    return df.withColumns({name: parse_instant(F.col(name)) for name in fields if types.get(name) == "string"})


def update_documents(df: DataFrame, where: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Rows that match get the changed values; the others stay."""
    hit = F.coalesce(where, F.lit(False))
    return df.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in changes.items()})


def delete_documents(df: DataFrame, where: Column) -> DataFrame:
    """Rows that do not match."""
    return df.where(~F.coalesce(where, F.lit(False)))


def collection_stats(df: DataFrame) -> DataFrame:
    """Documents, bytes as JSON and mean bytes."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.count("*").alias("document_count"), F.sum(size).alias("size_bytes"),
                  F.avg(size).alias("average_document_size"))


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one document."""
    return df.groupBy(*key).agg(F.count("*").alias("documents")).where(F.col("documents") > 1)


@dataclass(frozen=True)
class Field:
    """What a document field has to meet."""

    required: bool = False
    type: str | None = None
    minimum: float | None = None
    maximum: float | None = None


def validity(df: DataFrame, schema: Mapping[str, Field]) -> Column:
    """True for documents that meet a schema; types are checked by conversion."""
    conditions = []
    for name, rule in schema.items():
        if name not in df.columns:
            if rule.required:
                conditions.append(F.lit(False))
            continue
        value = F.col(name)
        if rule.required:
            conditions.append(value.isNotNull())
        if rule.type:
            conditions.append(value.isNull() | value.try_cast(rule.type).isNotNull())
        if rule.minimum is not None:
            conditions.append(value.isNull() | (value >= rule.minimum))
        if rule.maximum is not None:
            conditions.append(value.isNull() | (value <= rule.maximum))
    return F.coalesce(all_of(conditions), F.lit(False))


# What the collections require.
SCHEMAS = {
    "users": {"user_id": Field(True, "int"), "username": Field(True, "string"), "email": Field(True, "string"),
              "registration_date": Field(type="date"), "location": Field(type="string")},
    "products": {"product_id": Field(True, "int"), "name": Field(True, "string"), "category": Field(True, "string"),
                 "price": Field(type="double")},
    "reviews": {"review_id": Field(True, "int"), "user_id": Field(True, "int"), "product_id": Field(True, "int"),
                "rating": Field(True, "int", 1, 5), "review_date": Field(True, "timestamp")},
}


def text_search(df: DataFrame, text: str, key: str, query: str, limit: int = 10) -> DataFrame:
    """The `limit` documents with most search words, ties by key."""
    scored = df.withColumn("score", search_score(F.col(text), query)).where(F.col("score") > 0)
    return scored.orderBy(F.desc("score"), key).limit(limit)


def alive(df: DataFrame, field: str, seconds: int, as_of: Column) -> DataFrame:
    """Documents younger than their time to live."""
    return df.where(F.unix_micros(F.col(field)) > F.unix_micros(as_of) - seconds * 1_000_000)
