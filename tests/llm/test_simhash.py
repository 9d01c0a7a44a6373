"""SimHash near-duplicates against plain loops over all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from reviewlake.llm import simhash
from reviewlake.llm.components import connected_components


def plain_fingerprint(text, size=4):
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    for mark in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(mark, " ")
    words = [word for word in lowered.split(" ") if word]
    if not words:
        return 0
    grams = [" ".join(words[at:at + size]) for at in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    root = list(range(len(values)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at
    for a, b in combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= radius:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [find(at) for at in range(len(values))]


def flipped(value, count):
    for bit in random.sample(range(64), count):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    random.seed(radius)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        bits = random.sample(range(64), radius)
        assert any(not any(mask >> bit & 1 for bit in bits) for mask in masks)
    assert min(mask.bit_count() for mask in masks) >= 30


def test_fingerprints():
    for text in ["", " ", None, "a", "A b", "one two three four", "a a a a a a a a", "ÄB äb x \x0b y\tz\r\nq", "w " * 70_000]:
        assert simhash.fingerprint(simhash.shingle_hashes(text, 4)) % 2 ** 64 == plain_fingerprint(text)


@pytest.mark.parametrize("dense", [True, False])
def test_links_of_one_bucket(dense):
    random.seed(3)
    for size in (2, 3, 40, 300):
        center = random.getrandbits(64)
        values = list({flipped(center, random.randint(0, 3 if dense else 9)) for _ in range(size)})
        links = simhash.connect(np.array(values, np.uint64), 4)
        assert len(links) < max(2, len(values))
        assert all((int(a) ^ int(b)).bit_count() <= 4 for a, b in links)
        place = {value: at for at, value in enumerate(values)}
        found = [set([at]) for at in range(len(values))]
        for a, b in links:
            a, b = found[place[int(a)]], found[place[int(b)]]
            if a is not b:
                a |= b
                for at in b:
                    found[at] = a
        assert [min(each) for each in found] == plain_components(values, 4)


@pytest.mark.parametrize("block", [16_384, 7])
def test_links_across_buckets_and_blocks(spark, block):
    random.seed(5)
    centers = [random.getrandbits(64) for _ in range(12)]
    values = sorted({flipped(center, random.randint(0, 6)) for center in centers for _ in range(25)})
    df = spark.createDataFrame([(value - 2 ** 64 if value >> 63 else value,) for value in values], "fingerprint long")
    components = {row.node: row.root for row in connected_components(simhash.near_links(df, 4, block)).collect()}
    want = plain_components(values, 4)
    signed = [value - 2 ** 64 if value >> 63 else value for value in values]
    groups = {}
    for at, first in enumerate(want):
        groups.setdefault(first, []).append(signed[at])
    for group in groups.values():
        assert {components.get(value, value) for value in group} == {min(group)}


def test_components(spark):
    random.seed(8)
    links = [(at, at + 1) for at in range(60)] + [(100, at) for at in range(101, 160)] + [(5, 5), (None, 3)]
    links += [(random.randint(200, 400), random.randint(200, 400)) for _ in range(120)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {}
    for a, b in links:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {node: new if name == old else name for node, name in root.items()}
    assert {row.node: row.root for row in rows} == root and len(rows) == len(root)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def documents(spark):
    random.seed(11)
    words = [f"w{at}" for at in range(300)]
    base = [" ".join(random.choice(words) for _ in range(120)) for _ in range(15)]
    rows = [(at, text, "x") for at, text in enumerate(base)]
    for at in range(60):
        text = base[at % 15].split()
        for _ in range(at % 4):
            text[random.randrange(120)] = "new"
        rows.append((100 + at, " ".join(text), "x"))
    rows += [(300, None, None), (299, "", "y"), (None, " \n", "z"), (7, base[7], "x"), (None, "only nameless", "b"), (None, "only nameless", "a")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, Component_id string")


def test_near_duplicates(spark):
    rows, df = documents(spark)
    values = [plain_fingerprint(row[1]) for row in rows]
    groups = plain_components(values, 4)
    first = {}
    for group, row in zip(groups, rows):
        if row[0] is not None:
            first[group] = min(first.get(group, row[0]), row[0])
    want = sorted(((row[0] or -1), value, first.get(group) or -1) for row, value, group in zip(rows, values, groups))
    got = simhash.near_duplicates(df).collect()
    assert sorted((row.doc_id or -1, row.fingerprint % 2 ** 64, row.component_id or -1) for row in got) == want
    kept = simhash.keep_first(df).collect()
    assert len(kept) == len(set(groups)) and {row.doc_id for row in kept} == {*first.values(), None}
    assert [row["Component_id"] for row in kept if row.doc_id is None] == ["a"]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_rows_that_share_an_id_but_no_text(spark):
    texts = {name: " ".join(f"{name}{at}" for at in range(60)) for name in "abcd"}
    rows = [(1, texts["a"]), (1, texts["b"]), (1, texts["b"]), (2, texts["c"]), (2, texts["a"]), (3, texts["b"]), (4, texts["d"]), (None, texts["d"])]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((row.doc_id, row.text[0]) for row in kept) == [(1, "a"), (1, "b"), (2, "c"), (4, "d")]


def test_no_table_of_rows_goes_through_the_driver(spark):
    import re

    from pyspark.sql import functions as F
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words and number "), (F.col("id") % 900).cast("string")).alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        links = simhash.near_links(simhash.fingerprints(rows).select("fingerprint").distinct())
        for df in (links, simhash.near_duplicates(rows), simhash.keep_first(rows)):
            df.collect()
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and not re.search("BroadcastExchange", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
