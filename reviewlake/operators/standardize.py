"""Uploaded tables: column aliases, required columns, row filters and configurable checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.expr import to_time

# Other names of the review columns, and the columns they stand for.
ALIASES = {
    "text": "review_text",
    "review": "review_text",
    "comment": "review_text",
    "content": "review_text",
    "description": "review_text",
    "feedback": "review_text",
    "message": "review_text",
    "body": "review_text",
    "date": "created_at",
    "timestamp": "created_at",
    "review_date": "created_at",
    "date_created": "created_at",
    "created": "created_at",
    "time": "created_at",
    "user": "user_id",
    "customer_id": "user_id",
    "reviewer_id": "user_id",
    "customer": "user_id",
    "reviewer": "user_id",
    "username": "user_id",
    "product": "product_id",
    "item_id": "product_id",
    "asin": "product_id",
    "item": "product_id",
    "product_name": "product_id",
    "score": "rating",
    "stars": "rating",
    "review_rating": "rating",
    "star_rating": "rating",
    "overall": "rating",
}

# Words that make an unknown column a candidate for a required one.
CANDIDATES = {
    "review_text": ["text", "review", "comment", "content", "description", "feedback"],
    "rating": ["rating", "score", "star", "overall"],
}


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower-cased, trimmed names with aliases resolved; of several for one column the first is kept."""
    names = [ALIASES.get(name.lower().strip(), name.lower().strip()) for name in df.columns]
    first = [at for at, name in enumerate(names) if names.index(name) == at]
    unique = df.toDF(*[f"c{at}" for at in range(len(names))])
    return unique.select(*[F.col(f"c{at}").alias(names[at]) for at in first])


def missing_columns(df: DataFrame, required: Sequence[str] = ("review_text", "rating")) -> dict[str, list[str]]:
    """Required columns that are absent, each with the columns that might be meant."""
    return {name: [column for column in df.columns
                   if any(word in column.lower() for word in CANDIDATES.get(name, [name]))]
            for name in required if name not in df.columns}


def valid_ratings(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Ratings as numbers between 1 and 5; other rows are dropped."""
    number = F.col(rating).try_cast("double")
    return df.withColumn(rating, number).where(F.col(rating).between(1, 5))


def with_text(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Rows with non-blank text."""
    return df.where(F.trim(F.col(text).cast("string")) != "")


def parse_dates(df: DataFrame, column: str = "created_at") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, to_time(F.col(column), dict(df.dtypes)[column]))


def standardize(df: DataFrame) -> DataFrame:
    """All of the above for an uploaded review table."""
    named = standardize_names(df)
    missing = missing_columns(named)
    if missing:
        raise ValueError("missing columns: " + "; ".join(
            f"{name} (candidates: {', '.join(found) or 'none'})" for name, found in missing.items()))
    return parse_dates(with_text(valid_ratings(named)))


def in_period(column: Column, start: Any = None, end: Any = None) -> Column:
    """Date range filter with open ends."""
    low = F.lit(True) if start is None else column >= F.lit(start).cast("timestamp")
    high = F.lit(True) if end is None else column < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    return low & high


def validate_data(df: DataFrame, data_type: str = "general", min_rows: int = 10,
                  max_bad_share: float = 0.1) -> DataFrame:
    """One row: rows, bad ratings, verdict and message."""
    required = ["rating", "review_text"] if data_type == "reviews" else []
    missing = [name for name in required if name not in df.columns]
    bad = F.lit(0).cast("bigint")
    if data_type == "reviews" and not missing:
        bad = F.count_if(~F.coalesce(F.col("rating").between(1, 5), F.lit(False)))
    counted = df.agg(F.count("*").alias("total_rows"), bad.alias("bad_ratings"))
    rows = F.col("total_rows")
    verdict = F.when(rows == 0, "no_rows").when(rows < min_rows, "few_rows")
    if missing:
        verdict = verdict.when(F.lit(True), "no_column")
    verdict = verdict.when(F.col("bad_ratings") > rows * max_bad_share, "bad_ratings").otherwise("enough")
    told = {"no_rows": F.lit("the table has no row"), "few_rows": F.format_string("%d rows, fewer than the least number", rows),
            "no_column": F.lit("not there: " + ", ".join(missing)),
            "bad_ratings": F.format_string("%d ratings are not from 1 to 5", "bad_ratings"), "enough": F.lit("enough good rows")}
    message = F.lit(None).cast("string")
    for code, text in told.items():
        message = F.when(F.col("verdict") == code, text).otherwise(message)
    return counted.withColumn("verdict", verdict).withColumn("message", message).withColumn(
        "is_valid", F.col("verdict") == "enough").drop("verdict")


def _kind(dtype: str) -> str:
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return "datetime"
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return "numeric"
    return "string"


def row_key(df: DataFrame) -> Column:
    """Fixed-size identity of a whole row."""
    return F.sha2(F.to_json(F.struct(*df.columns)), 256)


def validate_dataframe(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """(check, column, found, message) for every broken rule, from one aggregate pass.

    Rules: required_columns, non_null_columns, column_types, value_ranges, check_duplicates.
    """
    types = dict(df.dtypes)
    checks: list[tuple[str, str, Column, Column]] = []

    def add(check: str, column: str, found: Column, message: Column) -> None:
        checks.append((check, column, found.cast("bigint"), message))

    for name in rules.get("required_columns", []):
        if name not in types:
            add("required", name, F.lit(1), F.lit(f"{name} is not there"))
    for name in rules.get("non_null_columns", []):
        if name in types:
            count = F.count_if(F.col(name).isNull())
            add("non_null", name, count,
                F.format_string(f"{name.replace('%', '%%')}: %d rows without a value", count))
    for name, expected in rules.get("column_types", {}).items():
        if name in types and expected != _kind(types[name]):
            add("type", name, F.lit(1), F.lit(f"{name} holds no {expected} values"))
    for name, bounds in rules.get("value_ranges", {}).items():
        if name not in types:
            continue
        if bounds.get("min") is not None:
            add("minimum", name, F.count_if(F.col(name) < bounds["min"]),
                F.lit(f"{name} falls below {bounds['min']}"))
        if bounds.get("max") is not None:
            add("maximum", name, F.count_if(F.col(name) > bounds["max"]),
                F.lit(f"{name} rises above {bounds['max']}"))
    empty = F.when(F.count("*") == 0, 1).otherwise(0)
    add("empty", "", empty, F.lit("the table has no row"))
    wide = df.agg(F.array(*[F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"),
                                     found.alias("found"), message.alias("message"))
                            for check, column, found, message in checks]).alias("_checks"))
    result = wide.select(F.inline("_checks"))
    if rules.get("check_duplicates"):
        copies = (df.groupBy(row_key(df).alias("_row")).agg((F.count("*") - 1).alias("_extra"))
                  .agg(F.coalesce(F.sum("_extra"), F.lit(0)).cast("bigint").alias("found")))
        result = result.unionByName(copies.select(
            F.lit("duplicates").alias("check"), F.lit("").alias("column"), "found",
            F.format_string("%d rows are copies of another", "found").alias("message")))
    return result.where(F.col("found") > 0)


def clean_dataframe(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """Configured cleaning: remove_duplicates, fill_null_values, type_conversions."""
    result = df.dropDuplicates() if rules.get("remove_duplicates") else df
    types = dict(df.dtypes)
    for name, value in rules.get("fill_null_values", {}).items():
        if name in types:
            result = result.withColumn(name, F.coalesce(F.col(name), F.lit(value).cast(types[name])))
    for name, target in rules.get("type_conversions", {}).items():
        if name not in types:
            continue
        if target == "datetime":
            result = result.withColumn(name, to_time(F.col(name), types[name]))
        elif target == "numeric":
            result = result.withColumn(name, F.col(name).try_cast("double"))
        elif target == "string":
            result = result.withColumn(name, F.col(name).cast("string"))
    return result
