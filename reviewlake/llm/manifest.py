"""Merkle manifest of a dataset: a content-addressed store of digest-to-children records, and proofs by descent.

Digests are lowercase hex SHA-256 over concatenated text. A tree has `arity` children a node; the last run of a level may
have fewer, even one, and still becomes a node. The store holds one row for each segment, which is a node with all
records (digest -> children) of the `levels` levels below it, keyed by the node's digest, so that equal subtrees are
stored once. A request for a leaf descends from the root: the digits of its rank, to the base of the arity, choose a
child at every node, the children not chosen are collected, and each segment's part of the path is reversed at its end.

Spark builds level after level of segments (one shuffle for `levels` levels) and descends in the same steps: requests
that share a prefix descend it once, so no task and no join key sees more requests than one segment has leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reviewlake.llm.batches import fields
from reviewlake.llm.places import number_rows
from reviewlake.session import materialize

#: A path from a leaf to the root: at each level the digests left and right of the own one, as concatenated hex text.
PATH = "array<struct<before:string,after:string>>"

RECORDS = "array<struct<digest:binary,children:array<binary>>>"


def encode_field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value (numbers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encode_field(value) for value in values]), 256)


def node_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(child.hex() for child in children).encode()).digest()


def build_segment(nodes: list[bytes], whole: int, arity: int, levels: int) -> tuple[bytes, dict[bytes, list[bytes]]]:
    """The node over consecutive `nodes` and all records below it.

    `whole`: the nodes of the whole tree at this level. If they are more than one segment, each segment has `levels`
    levels, else as many as it takes until one node is left.
    """
    records: dict[bytes, list[bytes]] = {}
    height = levels if whole > arity ** levels else segment_height(whole, arity)
    for _ in range(height):
        runs = [nodes[at:at + arity] for at in range(0, len(nodes), arity)]
        nodes = [node_digest(run) for run in runs]
        records.update(zip(nodes, runs))
    return nodes[0], records


def segment_height(nodes: int, arity: int) -> int:
    """Levels until one node is left."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // arity), height + 1
    return height


def descend(records: dict[bytes, list[bytes]], node: bytes, height: int, arity: int, rank: int) -> tuple[bytes, list[dict]]:
    """The node that `rank` leads to from the top of a segment, and the path back up."""
    path = []
    for level in range(height - 1, -1, -1):
        digit, children = rank // arity ** level % arity, records[node]
        path.append({"before": "".join(child.hex() for child in children[:digit]),
                     "after": "".join(child.hex() for child in children[digit + 1:])})
        node = children[digit]
    path.reverse()
    return node, path


@dataclass(frozen=True)
class Forest:
    """Trees over groups. `store`: (node, records) with one row a digest; `tops`: (g, n, node) with one row a group."""
    store: DataFrame
    tops: DataFrame
    arity: int
    levels: int


@dataclass(frozen=True)
class Manifest:
    """`leaves`: (row, g, place, n) in order; `trees` over the leaves of each group; `crown` over the groups' tops.

    `roots`: (g, subroot, path), the path leading from a subroot to `root`, which is None without a leaf. All are
    stored tables.
    """
    leaves: DataFrame
    trees: Forest
    crown: Forest
    roots: DataFrame
    root: str | None


def build_forest(ranked: DataFrame, arity: int = 2, levels: int = 8) -> Forest:
    """`ranked`: (g, n, place, node) with hex digests, places from 0 to n - 1 in each group g."""
    span = arity ** levels
    schema = fields(f"node binary, records {RECORDS}")
    nodes = ranked.select("g", "n", "place", F.unhex("node").alias("node"))
    largest = nodes.agg(F.max("n")).first()[0] or 0  # one number: how many rounds there are
    tops, stores = [nodes.where("n = 1").select("g", "node")], []
    rounds = 0
    while largest > 1:
        blocks = (nodes.where("n > 1").groupBy("g", "n", F.floor(F.col("place") / span).alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct("place", "node"))).alias("nodes")))
        made = StructType([blocks.schema["g"], *fields("n bigint, place bigint").fields, *schema.fields])
        segments = materialize(blocks.select("g", "n", "block", F.col("nodes.node").alias("nodes"))
                               .mapInArrow(_building(made, arity, levels), made), f"segments-{rounds}")
        rounds += 1
        stores.append(segments.select("node", "records"))
        nodes, largest = segments.select("g", "n", "place", "node"), -(-largest // span)
        tops.append(nodes.where("n = 1").select("g", "node"))
    if not stores:
        stores = [ranked.sparkSession.createDataFrame([], schema)]
    store, top = stores[0], tops[0]
    for one in stores[1:]:
        store = store.unionAll(one)
    for one in tops[1:]:
        top = top.unionAll(one)
    counts = ranked.where("place = 0").select(F.col("g").alias("_g"), "n")
    top = top.join(counts, F.col("g").eqNullSafe(F.col("_g"))).select("g", "n", "node")
    return Forest(materialize(store.dropDuplicates(["node"]), "store"), materialize(top, "tops"), arity, levels)


def _building(schema: StructType, arity: int, levels: int):
    arrow = to_arrow_schema(schema)
    span = arity ** levels

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            wholes, nodes = part.column(1).to_pylist(), part.column(3)
            for at in range(0, part.num_rows, 64):  # a few segments at a time
                built = [build_segment(one, whole, arity, levels)
                         for one, whole in zip(nodes.slice(at, 64).to_pylist(), wholes[at:at + 64])]
                columns = [part.column(0).slice(at, 64).cast(arrow[0].type),
                           pa.array([-(-whole // span) for whole in wholes[at:at + 64]], arrow[1].type),
                           part.column(2).slice(at, 64).cast(arrow[2].type),
                           pa.array([node for node, _ in built], arrow[3].type),
                           pa.array([[{"digest": digest, "children": children} for digest, children in records.items()]
                                     for _, records in built], arrow[4].type)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
    return run


def prove(forest: Forest, asked: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """(g, place, payload, node, top, path) for requests `asked` (g, n, place, payload), each place at most once.

    node is the hex digest that the descent ends at, top that of the group. `above` (g, path) goes on from each
    group's top. Requests beyond a group's leaves get no row.
    """
    tops = forest.tops.select("g", "node", F.lower(F.hex("node")).alias("top"))
    if above is None:
        tops = tops.withColumn("path", F.array().cast(PATH))
    else:
        tops = tops.join(above.select(F.col("g").alias("_g"), "path"), F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    largest = forest.tops.agg(F.max("n")).first()[0] or 0
    found = _reach(forest, asked.where("place >= 0 AND place < n"), tops, largest)
    return found.select("g", "place", "payload", F.lower(F.hex("node")).alias("node"), "top", "path")


def _reach(forest: Forest, asked: DataFrame, tops: DataFrame, largest: int) -> DataFrame:
    """Requests for nodes of one level: those of the only node of a tree are answered by `tops`, others by a descent
    from the nodes that end the segments above."""
    span = forest.arity ** forest.levels
    at_top = (asked.where("n = 1").join(tops.withColumnRenamed("g", "_g"), F.col("g").eqNullSafe(F.col("_g")))
              .select("g", "place", "payload", "node", "top", "path"))
    if largest <= 1:
        return at_top
    block = F.floor(F.col("place") / span).alias("block")
    deeper = asked.where("n > 1")
    prefixes = deeper.select("g", F.ceil(F.col("n") / span).alias("n"), block).distinct()
    parents = materialize(prefixes, "prefixes").select("g", "n", F.col("block").alias("place"), F.lit(None).cast("int").alias("payload"))
    upper = _reach(forest, parents, tops, -(-largest // span)).select(
        F.col("g").alias("_g"), F.col("place").alias("_block"), "node", F.struct("top", "path").alias("above"))
    upper = materialize(upper, "reached")
    blocks = deeper.groupBy("g", "n", block).agg(
        F.collect_list(F.struct((F.col("place") % span).cast("int").alias("rank"), "place", "payload")).alias("asked"))
    joined = (blocks.join(upper, F.col("g").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_block")))
              .join(forest.store, "node").select("g", "asked", "above", "n", "node", F.col("asked.rank").alias("ranks"), "records"))
    schema = StructType([joined.schema["g"], joined.schema["asked"], joined.schema["above"],
                         *fields(f"found array<struct<node:binary,path:{PATH}>>").fields])
    answered = joined.mapInArrow(_descending(schema, forest.arity, forest.levels), schema)
    each = answered.select("g", "above", F.explode(F.arrays_zip("asked", "found")).alias("x"))
    below = each.select("g", "x.asked.place", "x.asked.payload", "x.found.node", "above.top",
                        F.concat("x.found.path", "above.path").alias("path"))
    return below.unionAll(at_top)


def _descending(schema: StructType, arity: int, levels: int):
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 16):  # a segment's answers are a few times its records
                some = part.slice(at, 16)
                found = []
                for whole, node, ranks, records in zip(*[some.column(of).to_pylist() for of in (3, 4, 5, 6)]):
                    children = {one["digest"]: one["children"] for one in records}
                    height = levels if whole > arity ** levels else segment_height(whole, arity)
                    answers = {rank: descend(children, node, height, arity, rank) for rank in set(ranks)}
                    found.append([{"node": answers[rank][0], "path": answers[rank][1]} for rank in ranks])
                columns = [some.column(of).cast(arrow[of].type) for of in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, arrow[3].type)], schema=arrow)
    return run


def build_manifest(df: DataFrame, digest: Column, order: Column, group: Column, carry: dict[str, Column],
                   arity: int = 2, levels: int = 8) -> Manifest:
    """Leaves of each group in ascending order (nulls first, then by digest), a tree for each group, a crown over their
    tops in the groups' order, nulls first.

    `carry`: what stays beside a leaf, in leaves.row. Rows that are equal in order and digest are leaves of their own.
    An empty table has no leaf, no group and no root.
    """
    kept = F.struct(*[column.alias(name) for name, column in carry.items()]) if carry else F.lit(None).cast("int")
    stored = materialize(df.select(digest.alias("digest"), order.alias("by"), group.alias("group"), kept.alias("carried")), "leaves")
    ranked = number_rows(stored, [F.col("by"), F.col("digest")], F.col("group"), "ranked")
    leaves = materialize(ranked, "placed")
    trees = build_forest(leaves.select("g", "n", "place", F.col("row.digest").alias("node")), arity, levels)
    subroots = materialize(number_rows(trees.tops, [F.col("g")], None, "subroots"), "placed-subroots")
    crown = build_forest(subroots.select("g", "n", "place", F.lower(F.hex("row.node")).alias("node")), arity, levels)
    paths = prove(crown, subroots.select("g", "n", "place", F.col("row").alias("payload")))
    root = crown.tops.select(F.lower(F.hex("node")).alias("root")).first()  # one row at most
    roots = paths.select(F.col("payload.g").alias("g"), F.col("node").alias("subroot"), "path")
    return Manifest(leaves, trees, crown, materialize(roots, "roots"), root[0] if root else None)


def prove_leaves(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """(carried, leaf, subroot, root, path) for `leaves` (default: all), rows of `manifest.leaves`: the digest that the
    descent ends at and the path from it to the root."""
    asked = (manifest.leaves if leaves is None else leaves).select("g", "n", "place", F.col("row.carried").alias("payload"))
    found = prove(manifest.trees, asked, manifest.roots)
    return found.select(F.col("payload").alias("carried"), F.col("node").alias("leaf"), F.col("top").alias("subroot"),
                        F.lit(manifest.root).cast("string").alias("root"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)
