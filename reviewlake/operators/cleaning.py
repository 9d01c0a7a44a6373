"""Cleaning: duplicates, missing values, text, formats and outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from reviewlake.functions.expr import to_time
from reviewlake.functions.text import tidy_text
from reviewlake.operators.quality import date_columns, email_columns, string_columns
from reviewlake.operators.ranks import keep_first, quantile_values
from reviewlake.session import materialize


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, NumericType)]


def remove_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                      order_by: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or the first row by `order_by` per subset."""
    if subset is None:
        return df.dropDuplicates()
    return keep_first(df, subset, order_by or df.columns)


def _mode(df: DataFrame, name: str) -> Any:
    """Most frequent value, the smallest of several; `Unknown` when there is none."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_n"))
    found = counts.orderBy(F.desc("_n"), F.asc(name)).first()
    return "Unknown" if found is None else found[0]


def _statistics(df: DataFrame, wanted: Mapping[str, str]) -> dict[str, Any]:
    """One number per column: all means in one pass, all medians in another."""
    means = [name for name, how in wanted.items() if how == "mean"]
    medians = [name for name, how in wanted.items() if how == "median"]
    found: dict[str, Any] = {}
    if means:
        found |= df.agg(*[F.avg(name).alias(name) for name in means]).first().asDict()
    if medians:
        found |= {name: values.get(0.5) for name, values in quantile_values(df, medians, [0.5]).items()}
    return found | {name: _mode(df, name) for name, how in wanted.items() if how == "mode"}


def handle_missing_values(df: DataFrame, strategy: Mapping[str, Any] | None = None) -> DataFrame:
    """Fill or drop missing values column by column.

    Per column: `drop`, `mean`, `median`, `mode`, `auto` (median for numbers, else
    `Unknown`) or a value to fill in. Columns are taken in order, so a statistic
    does not see rows an earlier column dropped; the statistics between two drops
    are read together. Columns without nulls stay as they are.
    """
    strategy = strategy or {}
    types = dict(df.dtypes)
    numeric = set(numeric_columns(df))
    nulls = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns]).first().asDict()
    result = df
    fills: dict[str, Any] = {}
    waiting: dict[str, str] = {}
    for name in df.columns:
        if not nulls[name]:
            continue
        how = strategy.get(name, "auto")
        if how == "auto":
            how = "median" if name in numeric else "Unknown"
        if how == "drop":
            fills |= _statistics(result, waiting)
            waiting = {}
            result = result.where(F.col(name).isNotNull())
        elif how in ("mean", "median") and name not in numeric:
            raise ValueError(f"{how} needs a numeric column, {name!r} is {types[name]}")
        elif how in ("mean", "median", "mode"):
            waiting[name] = how
        else:
            fills[name] = how
    fills |= _statistics(result, waiting)

    def filled(name: str):
        value = fills[name]
        if value is None:
            return F.col(name)
        if name in numeric and types[name] not in ("double", "float") and value != int(value):
            return F.coalesce(F.col(name).cast("double"), F.lit(float(value))).alias(name)
        if name not in numeric and types[name] != "string":
            # A text such as Unknown has no place in a typed column.
            filler = F.lit(value).try_cast(types[name])
        else:
            filler = F.lit(value).cast(types[name])
        return F.coalesce(F.col(name), filler).alias(name)

    return result.select(*[filled(name) if name in fills else F.col(name) for name in df.columns])


def clean_text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Tidy text in all string columns except dates and mail addresses, whose characters carry meaning."""
    kept = set(date_columns(df)) | set(email_columns(df))
    chosen = columns if columns is not None else [name for name in string_columns(df) if name not in kept]
    return df.withColumns({name: tidy_text(F.col(name)) for name in chosen})


def standardize_formats(df: DataFrame) -> DataFrame:
    """Date-named columns to timestamps, mail addresses to trimmed lower case."""
    types = dict(df.dtypes)
    changes = {name: to_time(F.col(name), types[name]) for name in date_columns(df)}
    changes |= {name: F.trim(F.lower(F.col(name).cast("string"))) for name in email_columns(df)}
    return df.withColumns(changes)


def remove_outliers(df: DataFrame, exclude_columns: Sequence[str] = ()) -> DataFrame:
    """Drop rows beyond 1.5 interquartile ranges, column after column on what is left; nulls stay."""
    result = df
    for name in numeric_columns(df):
        if name in exclude_columns:
            continue
        found = quantile_values(result, [name], [0.25, 0.75])[name]
        if not found:
            continue
        low, high = found[0.25], found[0.75]
        reach = 1.5 * (high - low)
        inside = F.col(name).between(low - reach, high + reach)
        result = result.where(F.coalesce(inside, F.lit(True)))
    return result


def clean_dataset(df: DataFrame, config: Mapping[str, Any] | None = None) -> DataFrame:
    """All steps with switches: remove_duplicates, handle_missing, clean_text,
    standardize_formats, remove_outliers (off), missing_strategy, outlier_config.
    """
    config = config or {}
    result = df
    if config.get("remove_duplicates", True):
        result = remove_duplicates(result)
    if config.get("handle_missing", True):
        if config.get("remove_duplicates", True):
            # Several statistics follow; the duplicates are looked for once.
            result = materialize(result, "distinct")
        result = handle_missing_values(result, config.get("missing_strategy"))
    if config.get("standardize_formats", True):
        result = standardize_formats(result)
    if config.get("clean_text", True):
        result = clean_text_columns(result)
    if config.get("remove_outliers", False):
        result = remove_outliers(result, config.get("outlier_config", {}).get("exclude_columns", ()))
    return result
