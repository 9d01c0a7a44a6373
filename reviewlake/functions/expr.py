"""Small column expressions shared by the operators."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once and use it many times inside `body`."""
    return F.transform(F.array(value), body)[0]


def lookup(entries: Mapping[str, Mapping[str, float | bool | None]], fields: str) -> Callable[[Column], Column]:
    """A function from a word to its entry, a struct of `fields` (DDL), or null.

    The entries are one literal: buckets by checksum, of which a word reads its own. Plans stay small, and a word costs
    the same whatever the number of entries.
    """
    size = max(1, len(entries))
    buckets: list[list[dict]] = [[] for _ in range(size)]
    for word, entry in entries.items():
        buckets[zlib.crc32(word.encode()) % size].append({"_word": word, **entry})
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<_word:string,{fields}>>>")

    def find(word: Column) -> Column:
        place = F.pmod(F.crc32(word.cast("binary")), F.lit(size)).cast("int")
        return F.get(F.filter(F.get(table, place), lambda entry: entry["_word"] == word), F.lit(0))
    return find


def all_of(conditions: Iterable[Column]) -> Column:
    """Conjunction; true for no conditions."""
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def any_of(conditions: Iterable[Column]) -> Column:
    """Disjunction; false for no conditions."""
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def flag(condition: Column) -> Column:
    """1 / 0, with 0 for unknown."""
    return F.when(condition, 1).otherwise(0)


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete days between two instants, rounded down (not a count of midnights)."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / DAY_MICROS)


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (a, b]; the lowest edge itself and anything outside is null."""
    chain = F
    for low, high, label in zip(edges, edges[1:], labels):
        inside = value > F.lit(low)
        if high != float("inf"):
            inside = inside & (value <= F.lit(high))
        chain = chain.when(inside, label)
    return chain


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are known; null when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y),
                        F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))


def smoothed_ratio(numerator: Column, denominator: Column) -> Column:
    """num / (den + 1e-5) with unreadable or missing numbers taken as 0."""
    def number(column: Column) -> Column:
        return F.coalesce(column.try_cast("double"), F.lit(0.0))
    return number(numerator) / (number(denominator) + 1e-5)


def short_id(payload: Column) -> Column:
    """First 8 hex digits of the md5 of a payload."""
    return F.substring(F.md5(payload), 1, 8)


def to_time(column: Column, type_name: str) -> Column:
    """Epoch seconds (numbers) or text to timestamp; unreadable values become null."""
    if type_name in ("timestamp", "date", "timestamp_ntz"):
        return column.cast("timestamp")
    if type_name in ("tinyint", "smallint", "int", "bigint", "float", "double") or type_name.startswith("decimal"):
        return F.timestamp_seconds(column)
    return F.coalesce(F.try_to_timestamp(column), F.try_to_timestamp(column, F.lit("yyyy/MM/dd")),
                      F.try_to_timestamp(column, F.lit("MM/dd/yyyy")),
                      F.timestamp_seconds(column.try_cast("bigint")))


def pick(columns: Iterable[str], names: Iterable[str]) -> str | None:
    """First column whose lower-cased name is one of `names`."""
    wanted = set(names)
    return next((column for column in columns if column.lower() in wanted), None)
