"""Predicates, projections, limits, joins, sampling and set operations."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions.expr import all_of

_COMPARE: dict[str, Callable[[Column, Any], Column]] = {
    "==": lambda column, value: column == value,
    "!=": lambda column, value: column != value,
    ">": lambda column, value: column > value,
    ">=": lambda column, value: column >= value,
    "<": lambda column, value: column < value,
    "<=": lambda column, value: column <= value,
    "in": lambda column, value: column.isin(list(value)),
}


def predicate(filters: Iterable[tuple[str, str, Any]]) -> Column:
    """Conjunction of (column, operator, value) triples."""
    conditions = []
    for name, operator, value in filters:
        if operator not in _COMPARE:
            raise ValueError(f"unknown operator {operator!r}; use one of {sorted(_COMPARE)}")
        conditions.append(_COMPARE[operator](F.col(name), value))
    return all_of(conditions)


def project(df: DataFrame, columns: Sequence[str] | None, strict: bool = False) -> DataFrame:
    """Select columns; unknown names are dropped, or refused when `strict`."""
    if columns is None:
        return df
    missing = [name for name in columns if name not in df.columns]
    if missing and strict:
        raise ValueError(f"unknown columns: {missing}")
    return df.select(*[name for name in columns if name in df.columns])


def read_with(df: DataFrame, columns: Sequence[str] | None = None,
              filters: Iterable[tuple[str, str, Any]] = (), limit: int | None = None,
              strict: bool = False) -> DataFrame:
    """Filter, project and limit, in the order that lets the scan prune."""
    filters = list(filters)
    result = df.where(predicate(filters)) if filters else df
    result = project(result, columns, strict)
    return result if limit is None else result.limit(limit)


def page(df: DataFrame, order: Sequence[str], offset: int, limit: int, equals: Mapping[str, Any] | None = None,
         equals_ignoring_case: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """One page of the matching rows and their total count."""
    conditions = [F.col(name) == value for name, value in (equals or {}).items() if value is not None]
    conditions += [F.lower(name) == value.lower() for name, value in (equals_ignoring_case or {}).items() if value]
    found = df.where(all_of(conditions))
    return found.orderBy(*order).offset(offset).limit(limit), found.agg(F.count("*").alias("total"))


def find(df: DataFrame, where: Column, fields: Sequence[str] | None = None,
         sort: Sequence[Column] = (), skip: int = 0, limit: int | None = None) -> DataFrame:
    """Document search: condition on (nested) fields, projection, sort, skip, limit."""
    result = df.where(where)
    if sort:
        result = result.orderBy(*sort)
    if skip:
        result = result.offset(skip)
    if limit is not None:
        result = result.limit(limit)
    return result if fields is None else result.select(*[F.col(field).alias(field.split(".")[-1]) for field in fields])


def get_one(df: DataFrame, key: str, value: Any) -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys of `child` that `parent` lacks, with the number of rows affected.

    The child is reduced to its distinct keys before the anti join.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return keys.join(known, key, "left_anti")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def sample_rows(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """n rows by the smallest seeded hash of `key`: the same rows on every run and layout.

    Counts by the hash's first digits find the one bucket that is cut; what lies below it stays where it is, and only
    the rows of that bucket, a millionth, are ordered.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"-{seed}"))))
    bucket = F.substring("_hash", 1, 5)
    counts = hashed.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # at most 16^5 rows, whatever the table
    upto = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)))
    cut = upto.where(F.col("_upto") > n).orderBy("_bucket").limit(1).collect()
    if not cut:
        return df
    below = hashed.where(bucket < cut[0]["_bucket"])
    last = hashed.where(bucket == cut[0]["_bucket"]).orderBy("_hash", key).limit(n - cut[0]["_upto"] + cut[0]["_n"])
    return below.unionAll(last).drop("_hash")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Change rows between two snapshots: key, change (insert / update / delete) and the new values."""
    columns = [name for name in after.columns if name != key]
    old = before.select(F.col(key), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key), F.struct(*columns).alias("_new"))
    joined = old.join(new, key, "full")
    change = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "update"))
    return (joined.withColumn("change", change).where(F.col("change").isNotNull())
            .select(key, "change", "_new.*"))
