"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns, drop_shuffles, started
from reviewlake.llm.components import connected_components
from reviewlake.session import materialize

BITS = 64

#: Distinct fingerprints of one bucket that are compared in one task; larger buckets are cut into blocks of this size.
BLOCK = 16_384


def shingle_hashes(text: str | None, shingle: int, seed: int = 42) -> list[int]:
    """XXH64 of each run of `shingle` words, joined by spaces; of the whole sequence if there are fewer words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and white space is x20, x09-x0D
    if not words:
        return []
    data = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(data, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(data[start:end], seed) for start, end in zip(starts, ends[shingle - 1:].tolist())]


def fingerprint(hashes: list[int]) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 without hashes. As a signed 64-bit integer."""
    if not hashes:
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 4, keep: list[str] | None = None) -> DataFrame:
    """Adds `fingerprint` (bigint): the SimHash of the A-Z-lower-cased words of each whole text.

    Null and empty texts, and texts without a word, have fingerprint 0. Row for row, without shuffle.
    """
    def start():
        return lambda texts: ([fingerprint(shingle_hashes(value, shingle)) for value in texts],)
    return add_columns(df, [text], "fingerprint bigint", start, keep, 4 * 2 ** 20)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 bit masks, of which at least one leaves out any `radius` given bits.

    Bit i has the vector 1 + i mod (2^(radius+1) - 1) in radius + 1 binary dimensions; mask v keeps the bits whose
    vector has an odd product with v. Any `radius` vectors leave a dimension free, so some v other than 0 has an even
    product with all of them: two fingerprints that differ in those bits agree under mask v.
    """
    size = (1 << radius + 1) - 1
    vectors = [1 + bit % size for bit in range(bits)]
    return [sum(1 << bit for bit, vector in enumerate(vectors) if (vector & mask).bit_count() & 1)
            for mask in range(1, size + 1)]


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def near_links(prints: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """a, b: links between distinct fingerprints (column `fingerprint`) that differ in `radius` bits at most.

    Of every bucket come as many links as connect what all its close pairs connect, not the pairs themselves. A
    bucket with more than `block` fingerprints is cut into blocks, and each two of them meet in a task of their own.

    Joins are merge joins: Spark takes a table of keys, which has 31 rows for each fingerprint, for as small as the
    fingerprints are, and would send it through the driver.
    """
    masks = [mask - (1 << BITS) if mask >> BITS - 1 else mask for mask in covering_masks(radius)]
    keyed = prints.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(table).cast("int").alias("table"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("key"))
        for table, mask in enumerate(masks)])).alias("k")).select("k.table", "k.key", "fingerprint")
    shared = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.hash("fingerprint"), F.col("blocks"))
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = (keyed.join(shared.hint("merge"), ["table", "key"]).withColumn("blocks", blocks).withColumn("own", own)
               .withColumn("other", met).select("table", "key", F.least("own", "other").alias("i"),
                                                F.greatest("own", "other").alias("j"), "fingerprint"))
    bucket = ["table", "key", "i", "j"]
    ordered = members.repartition(*bucket).sortWithinPartitions(*bucket)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = started(lambda: np.empty((0, 5), np.int64))
        for part in parts:
            rows = np.column_stack([column.to_numpy(zero_copy_only=False).astype(np.int64) for column in part.columns])
            rows = np.concatenate([rest, rows])
            whole = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1))
            cut = whole[-1] + 1 if len(whole) else 0  # the last bucket may go on in the next batch
            yield from linked(rows[:cut])
            rest = rows[cut:]
        yield from linked(rest)

    def linked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        edge = np.flatnonzero(np.concatenate([[True], (rows[1:, :4] != rows[:-1, :4]).any(axis=1), [True]]))
        values = rows[:, 4].view(np.uint64) if rows.flags.c_contiguous else np.ascontiguousarray(rows[:, 4]).view(np.uint64)
        found = [connect(values[start:end], radius) for start, end in zip(edge[:-1], edge[1:]) if end - start > 1]
        pairs = np.concatenate(found or [np.empty((0, 2), np.uint64)]).view(np.int64)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return ordered.mapInArrow(run, "a bigint, b bigint").distinct()


def connect(values: np.ndarray, radius: int) -> np.ndarray:
    """Links that connect what the pairs within `radius` bits connect, n - 1 at most.

    One value after the other is compared with all, until all values not yet compared are connected with each other:
    the pairs left then can add nothing. A dense group is done after a few values.
    """
    size = len(values)
    if size == 2:
        near = np.bitwise_count(values[0] ^ values[1]) <= radius
        return values.reshape(1, 2) if near else np.empty((0, 2), np.uint64)
    root, waiting = np.arange(size), np.ones(size, bool)
    waits = np.ones(size, np.int64)  # waiting values of each root
    out = []
    while True:
        largest = int(waits.argmax())
        left = np.flatnonzero(waiting & (root != largest))
        if not len(left):
            return np.array(out, np.uint64).reshape(-1, 2)
        at = int(left[0])
        waiting[at] = False
        waits[root[at]] -= 1
        near = np.flatnonzero(np.bitwise_count(values ^ values[at]) <= radius)
        target = root[at]
        for name in np.unique(root[near]):
            if name != target:
                out.append((values[at], values[near[root[near] == name][0]]))
                root[root == name] = target
                waits[target] += waits[name]
                waits[name] = 0


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """One row for each row: id, fingerprint (bigint), component_id, root (bigint).

    Rows are linked when their fingerprints differ in `radius` bits at most, equal texts and texts without a word
    included. component_id is the smallest id that a row reaches, itself included; null ids are passed over, and a
    component without any other has a null component_id. root is the component's smallest linked fingerprint. Repeated
    rows are rows of one component. Other columns are not read; an empty table gives an empty result.
    """
    spark = df.sparkSession
    prints = materialize(fingerprints(df, text, shingle, keep=[id]), "fingerprints")
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min(id).alias("first")), "distinct")
    components = connected_components(near_links(distinct, radius))
    drop_shuffles(spark)
    named = distinct.join(components.withColumnRenamed("node", "fingerprint").hint("merge"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))
    linked = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.select("fingerprint", "root").join(linked.hint("merge"), "root")
    return prints.join(named.hint("merge"), "fingerprint").select(id, "fingerprint", "component_id", "root")


def keep_first(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id.

    Of several rows with that id in a component, or of rows without an id in a component that has no other, the
    smallest row stays. Rows that share an id but are not linked are rows of different components.
    """
    found = materialize(near_duplicates(df, id, text, shingle, radius), "components")
    first = F.col(id) == F.col("component_id")
    ids = found.where(F.col(id).isNotNull()).groupBy(id).agg(F.count(F.lit(1)).alias("n"), F.count_if(first).alias("firsts"))
    once, often = ids.where("n = 1 AND firsts = 1").select(id), ids.where("n > 1 AND firsts > 0").select(id)
    kept = df.join(once.hint("merge"), id, "left_semi").select(*df.columns)

    def one_each(rows: DataFrame, members: DataFrame) -> DataFrame:
        """The smallest of `rows` for each root of `members`, which have the rows' ids and fingerprints."""
        roots = members.select(F.col(id).alias("_member"), F.col("fingerprint").alias("_print"), F.col("root").alias("_root")).distinct()
        prints = fingerprints(rows.select(F.struct(*df.columns).alias("_row"), F.col(id).alias("_id"), F.col(text).alias("_text")),
                              "_text", shingle)
        met = prints.join(roots.hint("merge"), (F.col("fingerprint") == F.col("_print")) & F.col("_id").eqNullSafe(F.col("_member")))
        return met.groupBy("_root").agg(F.min("_row").alias("_row")).select("_row.*")
    nameless = df.where(F.col(id).isNull())
    if not often.isEmpty():
        kept = kept.unionAll(one_each(df.join(often.hint("merge"), id, "left_semi").select(*df.columns),
                                      found.where(first).join(often.hint("merge"), id, "left_semi")))
    if not nameless.isEmpty():
        kept = kept.unionAll(one_each(nameless, found.where(F.col(id).isNull() & F.col("component_id").isNull())))
    return kept
