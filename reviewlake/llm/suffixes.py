"""Removal of repeated byte strings by content-chosen anchors with digest ranks, instead of sort-based prefix doubling.

A suffix array of all positions would sort every byte of the corpus again and again. Here Spark ranks only positions
that can still matter. Every string of `length` bytes has an anchor: the start of its least-hashed `CORE`-byte piece,
which depends on the string's content alone. Starts with one anchor form a block. Three rounds rank pairs of growing
reach around the anchor:

1. core of 24 bytes; all strings of a block together,
2. core of 91 bytes; up to ten neighbouring strings of a block together,
3. the full length; each string alone.

In each round a position has the rank pair (rank of its core, rank of the strings that extend it); ranks are named by
digests. Spark groups positions by the pair: a position whose pair occurs earlier repeats as a whole. Reranked with a
longer core are only the first positions of pairs whose core stands in several pairs. What is unique is done.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from reviewlake.llm.batches import Scratch, add_columns, make_rows, others
from reviewlake.session import materialize

#: Bytes of a string that counts as repeated, of an anchor's piece, and strings that the second round ranks together.
LENGTH, CORE, PART = 100, 24, 10

#: Bytes of texts, and of strings of which every one may become a row for each byte, that a task has in Python at a time.
HELD, HELD_STRINGS = 2 * 2 ** 20, 2 ** 19

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: byte -> 64-bit value
VALUES = np.array([xxhash.xxh64_intdigest(bytes([value]), 7) for value in range(256)], np.uint64)

_powers = np.ones((2, 1), np.uint64)


def powers(size: int) -> np.ndarray:
    """BASE and its inverse to the powers 0, 1, ..., size."""
    global _powers
    if _powers.shape[1] <= size:
        grown = np.empty((2, 2 * size + 1), np.uint64)
        grown[:, 0] = 1
        grown[0, 1:], grown[1, 1:] = BASE, INVERSE
        _powers = np.cumprod(grown, axis=1, dtype=np.uint64)
    return _powers


def core_hashes(data: np.ndarray, core: int) -> np.ndarray:
    """A 64-bit hash of each `core` bytes."""
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[data] * down[:len(data)], dtype=np.uint64)])
    hashes = (sums[core:] - sums[:-core]) * up[:len(data) - core + 1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(BASE)
    return hashes ^ hashes >> np.uint64(29)


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The leftmost place of the least hash among each `window` neighbours (by its upper half)."""
    least = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < window:
        least = np.minimum(least[:size - window], least[window - size:])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def place(first, count, before):
    """`count` starts from `first` on, of which the first stands `before` bytes ahead of the anchor, as one integer."""
    return first << 16 | count << 8 | before


NONE = np.empty(0, np.int64)


def blocks(data: bytes, length: int, core: int, whole: bool = True) -> tuple[np.ndarray, ...]:
    """For each block of a text: the core's hash and, if `whole`, the digest of all its strings and its place."""
    if len(data) < length:
        return NONE, NONE, NONE
    hashes = core_hashes(np.frombuffer(data, np.uint8), core)
    anchor = anchors(hashes, length - core + 1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    cores = hashes[anchor[first]].view(np.int64)
    if not whole:
        return cores, NONE, NONE
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    before = anchor[first] - first
    digest = xxhash.xxh64_intdigest
    wholes = [digest(data[start:end], ahead) for start, end, ahead in
              zip(first.tolist(), (first + count + (length - 1)).tolist(), before.tolist())]
    return cores, np.array(wholes, np.uint64).view(np.int64), place(first, count, before)


def parts(data: bytes, start: int, count: int, before: int, length: int, size: int):
    """The strings of a block, `size` at most together, cut where their distance to the anchor is a multiple of it.

    Yields core digest, digest and place of each part; `data` begins at `start`.
    """
    digest, at = xxhash.xxh64_intdigest, 0
    while at < count:
        step = (before - at) // size
        end = min(count, before - step * size + 1)
        inner = before - step * size  # from the start of `data` to the core, which all strings of the part share
        core = data[inner:inner - size + 1 + length]
        yield (signed(digest(core, step)), signed(digest(data[at:end - 1 + length], before - at)),
               place(start + at, end - at, before - at))
        at = end


def order_rows(df: DataFrame, id: str, text: str) -> DataFrame:
    """Adds `_ord` (bigint), which orders rows by id: the id itself if it is an integer without repetition or null.

    Else rows are numbered by id (null last), text and place in the input, and written to the shared folder.
    """
    if isinstance(df.schema[id].dataType, IntegralType):
        odd = df.groupBy(id).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(id).isNull())
        if odd.isEmpty():
            return df.withColumn("_ord", F.col(id).cast("bigint"))
    keys = [F.col(id).asc_nulls_last(), F.col("_digest"), F.col("_row")]
    told = df.withColumns({"_digest": F.sha2(F.coalesce(text, F.lit("")), 256), "_row": F.monotonically_increasing_id()})
    told = told.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_ord", F.monotonically_increasing_id())
    return materialize(told.drop("_digest", "_row"), "ordered")


def settle(scratch: Scratch, rows: DataFrame, rest: list[str]) -> tuple[DataFrame, DataFrame]:
    """Stored rows (_ord, place) whose pair (core, whole) occurs earlier; and the contested ones, with `rest`.

    Contested are the first rows of those pairs whose core stands in several pairs.
    """
    first = scratch.store(rows.groupBy("core", "whole").agg(F.min(F.struct("_ord", "place", *rest)).alias("first"),
                                                            F.count(F.lit(1)).alias("n")), "first")
    scratch.drop()
    again = scratch.store(rows.join(first.where("n > 1").select("core", "whole", "first"), ["core", "whole"]).where(
        F.struct("_ord", "place") > F.struct("first._ord", "first.place")).select("_ord", "place"), "repeated")
    several = repeated_cores(scratch, first)
    contested = scratch.store(first.select("core", "first.*").join(several, "core", "left_semi").drop("core"), "contested")
    scratch.drop(first, several)
    return again, contested


def repeated_cores(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """The cores of several rows. Stored, so that a join with them starts at its own shuffle, which Spark splits by
    size: a third of all rows may have one core."""
    return scratch.store(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "cores")


def repeated_places(docs: DataFrame, text: str, length: int = LENGTH, core: int = CORE, part: int = PART) -> DataFrame:
    """_ord and place of all strings that also start earlier; `docs` has _ord, unique, and the text."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select("_ord", F.coalesce(text, F.lit("")).alias("text"))

    def cores_only():
        return lambda texts: (np.concatenate([NONE, *[blocks(value.encode(), length, core, False)[0] for value in texts]]),)

    def first_round():
        def rows(ids, texts):
            found = [blocks(value.encode(), length, core) for value in texts]
            sizes = [len(cores) for cores, _, _ in found]
            return (np.repeat(np.array(ids, np.int64), sizes),
                    *[np.concatenate([NONE, *[each[column] for each in found]]) for column in range(3)])
        return rows

    cores = make_rows(docs, ["text"], "core bigint", cores_only)
    several = repeated_cores(scratch, cores)
    scratch.drop()
    every = make_rows(docs, ["_ord", "text"], "_ord bigint, core bigint, whole bigint, place bigint", first_round)
    ranked = scratch.store(every.join(several.hint("shuffle_hash"), "core", "left_semi"), "blocks")
    scratch.drop(several)
    again, contested = settle(scratch, ranked, [])
    scratch.drop(ranked)

    def cut_out():
        def rows(ids, texts, wanted):
            out = [], [], []
            for id, value, places in zip(ids, texts, wanted):
                data = value.encode()
                for at in places:
                    start, count = at >> 16, at >> 8 & 255
                    out[0].append(id)
                    out[1].append(at)
                    out[2].append(data[start:start + count - 1 + length])
            return out
        return rows

    wanted = contested.groupBy("_ord").agg(F.collect_list("place").alias("places"))
    strings = scratch.store(make_rows(docs.join(wanted.hint("shuffle_hash"), "_ord"), ["_ord", "text", "places"],
                                      "_ord bigint, home bigint, data binary", cut_out, HELD), "strings")
    scratch.drop(contested)

    def second_round():
        def rows(ids, homes, strings):
            out = [], [], [], [], []
            for id, home, data in zip(ids, homes, strings):
                for found in parts(data, home >> 16, home >> 8 & 255, home & 255, length, part):
                    for column, value in zip(out, (id, home, *found)):
                        column.append(value)
            return out
        return rows

    ranked = scratch.store(make_rows(strings, ["_ord", "home", "data"],
                                     "_ord bigint, home bigint, core bigint, whole bigint, place bigint", second_round, HELD_STRINGS), "parts")
    again_parts, contested = settle(scratch, ranked, ["home"])
    scratch.drop(ranked)

    def third_round():
        def rows(ids, homes, strings, wanted):
            out = [], [], [], []
            for id, home, data, places in zip(ids, homes, strings, wanted):
                base = home >> 16
                for at in places:
                    start = at >> 16
                    for first in range(start, start + (at >> 8 & 255)):
                        digest = xxhash.xxh3_128_intdigest(data[first - base:first - base + length])
                        out[0].append(id)
                        out[1].append(signed(digest >> 64))
                        out[2].append(signed(digest & (1 << 64) - 1))
                        out[3].append(place(first, 1, 0))
            return out
        return rows

    wanted = contested.groupBy("_ord", "home").agg(F.collect_list("place").alias("places"))
    ranked = scratch.store(make_rows(strings.join(wanted, ["_ord", "home"]), ["_ord", "home", "data", "places"],
                                     "_ord bigint, core bigint, whole bigint, place bigint", third_round, HELD_STRINGS), "single")
    scratch.drop(contested, strings)
    again_strings, contested = settle(scratch, ranked, [])
    scratch.drop(ranked, contested)
    return again.unionAll(again_parts).unionAll(again_strings)


FOUND = ("kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, "
         "kept_text string")


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, core: int = CORE,
                   part: int = PART, keep: list[str] | None = None) -> DataFrame:
    """Adds kept, n_bytes, n_removed, n_spans, spans, kept_text: each text's UTF-8 bytes without repeated ones.

    A byte goes if any string of `length` bytes that covers it also starts earlier: in a row with a smaller id, or
    earlier in the same row; overlaps count, and strings are judged on the input. spans are the maximal removed runs
    [start, end). kept_text is kept without the fragments of characters that a run's edge cuts through; it is null for
    a null text, which has no bytes. Rows with the same id, or without an id (which come last), are ordered by text,
    equal ones by their place in the input. Other columns stay, those named like new ones are replaced; an empty table
    gives an empty result.
    """
    if not core < length <= 255 or not 0 < part <= length - core + 1:
        raise ValueError("core < length <= 255 and part <= length - core + 1 are needed")
    kept = others(df, [name.split()[0] for name in FOUND.split(", ")], keep)
    # the caller's columns travel in one struct, by place, so that their names cannot meet ours
    row = F.struct(F.lit(0).alias("_"), *[df[name].alias(f"c{at}") for at, name in enumerate(kept)])
    ordered = order_rows(df.select(row.alias("row"), df[id].alias("id"), df[text].alias("text")), "id", "text")
    gone = repeated_places(ordered, "text", length, core, part)
    spans = gone.groupBy("_ord").agg(F.collect_list("place").alias("_places"))

    def start():
        def rows(texts, found):
            out = [], [], [], [], [], []
            for value, places in zip(texts, found):
                data = (value or "").encode()
                runs = merge(np.array(places or [], np.int64), length)
                edges = [0, *[edge for run in runs for edge in run], len(data)]
                left = [data[a:b] for a, b in zip(edges[::2], edges[1::2])]
                kept = b"".join(left)
                text = value and "".join(piece.decode(errors="ignore") for piece in left)
                for column, made in zip(out, (kept, len(data), len(data) - len(kept), len(runs),
                                              [{"start": a, "end": b} for a, b in runs], text)):
                    column.append(made)
            return out
        return rows
    joined = ordered.join(spans.hint("shuffle_hash"), "_ord", "left")
    found = add_columns(joined, ["text", "_places"], FOUND, start, ["row"], HELD)
    return found.select(*[F.col(f"row.c{at}").alias(name) for at, name in enumerate(kept)], *found.columns[1:])


def merge(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the strings at these places cover."""
    if not len(places):
        return []
    places = np.sort(places)
    start = places >> 16
    end = np.maximum.accumulate(start + (places >> 8 & 255) - 1 + length)
    fresh = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[fresh].tolist(), end[np.concatenate([fresh[1:] - 1, [len(end) - 1]])].tolist()))


def spans_column(name: str = "spans") -> Column:
    """Removed bytes, from spans."""
    return F.aggregate(name, F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
