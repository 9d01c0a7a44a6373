"""Merkle manifests against a plain tree: roots, proofs, tampering, arities, segments, odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from reviewlake.llm import manifest
from reviewlake.llm.queries import QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes, arity):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][at:at + arity]) for at in range(0, len(found[-1]), arity)])
    return found


def steps(found, place, arity):
    """(left, right) at each level below the top."""
    path = []
    for level in found[:-1]:
        first = place // arity * arity
        path.append((level[first:place], level[place + 1:first + arity]))
        place //= arity
    return path


def plain(rows, arity):
    """rows: (group, id, leaf) -> sorted (id, leaf, subroot, root, path)."""
    groups = {}
    for group, identity, leaf in rows:
        groups.setdefault(group, []).append((identity is not None, identity or 0, leaf, identity))
    order = sorted(groups, key=lambda group: (group is not None, (group or "").encode()))
    trees = {group: levels_of([one[2] for one in sorted(groups[group], key=lambda one: one[:3])], arity) for group in order}
    crown = levels_of([trees[group][-1][0] for group in order], arity)
    found = []
    for at, group in enumerate(order):
        for place, (_, _, leaf, identity) in enumerate(sorted(groups[group], key=lambda one: one[:3])):
            path = steps(trees[group], place, arity) + steps(crown, at, arity)
            found.append((identity, leaf, trees[group][-1][0], crown[-1][0], tuple(("".join(a), "".join(b)) for a, b in path)))
    return sorted(found, key=repr)


def got(spark, rows, arity, levels):
    df = spark.createDataFrame(rows, "grp string, id long, leaf string")
    made = manifest.build_manifest(df, F.col("leaf"), F.col("id"), F.col("grp"), {"id": F.col("id")}, arity, levels)
    found = manifest.prove_leaves(made).withColumn("folded", manifest.fold(F.col("leaf"), F.col("path"))).collect()
    assert all(row.folded == row.root == made.root for row in found)
    return sorted(((row.carried.id, row.leaf, row.subroot, row.root, tuple((x.before, x.after) for x in row.path)) for row in found),
                  key=repr), made


@pytest.mark.parametrize("arity, levels", [(2, 8), (2, 1), (2, 3), (3, 2), (5, 1)])
def test_trees(spark, arity, levels):
    random.seed(arity * 10 + levels)
    sizes = {None: 9, "": 1, "a": 2, "é": 27, "z": 70, "Z": 64}
    rows = [(group, at, h(f"{group}{at}")) for group, size in sizes.items() for at in range(size)]
    rows += [("z", None, h("null")), (None, None, h("null")), ("a", 1, h("again"))] + [("same", 5, h("copy"))] * 33
    random.shuffle(rows)
    assert got(spark, rows, arity, levels)[0] == plain(rows, arity)


def test_store_is_content_addressed(spark):
    rows = [("same", at, h("copy")) for at in range(64)] + [("twin", at, h("copy")) for at in range(64)]
    found, made = got(spark, rows, 2, 2)
    assert found == plain(rows, 2)
    assert made.trees.store.count() == 3  # one segment for each of three heights, of 2 x 21
    digests = [one.digest for row in made.trees.store.collect() for one in row.records]
    assert len(digests) == len(set(digests))


def test_small_and_empty(spark):
    for rows in ([("a", 1, h("x"))], [("a", 1, h("x")), ("b", 1, h("y"))], [("a", 1, h("x")), ("a", 2, h("y"))]):
        assert got(spark, rows, 2, 8)[0] == plain(rows, 2)
    found, made = got(spark, [], 2, 8)
    assert found == [] and made.root is None


def test_some_leaves(spark):
    rows = [("a", at, h(str(at))) for at in range(50)]
    df = spark.createDataFrame(rows, "grp string, id long, leaf string")
    made = manifest.build_manifest(df, F.col("leaf"), F.col("id"), F.col("grp"), {"id": F.col("id")}, 2, 2)
    some = manifest.prove_leaves(made, made.leaves.where("place IN (0, 17, 49)")).collect()
    wanted = {one[0]: one for one in plain(rows, 2)}
    assert sorted(row.carried.id for row in some) == [0, 17, 49]
    assert all((row.leaf, tuple((x.before, x.after) for x in row.path)) == (wanted[row.carried.id][1], wanted[row.carried.id][4]) for row in some)


def test_query_with_odd_rows(spark, tmp_path):
    rows = [(at, "src", random.choice(["en", "de", None]), at, f"text {at}") for at in range(60)]
    rows += [(None, None, None, None, None), (100, "", "", 9223372036854775807, "é" * 1000), (101, "s", "en", None, ""), (5, "src", "en", 5, "again")]
    rows += [(7, "s", "en", 1, "copy")] * 20
    df = spark.createDataFrame([(*row, "mine", 1) for row in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, leaf string, place int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()

    def leaf(row, more=0):
        identity, source, lang, n, text = row
        return h(*map(field, (identity, source, lang, None if n is None else n + more, text)))
    wanted = plain([(row[2], row[0], leaf(row)) for row in rows], 2)
    tampered = {leaf(row): leaf(row, 1) for row in rows if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0}
    assert tampered
    want = []
    for identity, digest, subroot, root, path in wanted:
        node = tampered.get(digest, digest)
        for before, after in path:
            node = h(before, node, after)
        want.append((identity, digest, subroot, root, h(*[a + b for a, b in path]), node, node == root))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
