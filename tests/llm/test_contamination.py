"""Decontamination against a loop over all windows."""

import random
import re
import time

import numpy as np
import pytest

from reviewlake.llm import contamination

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def plain(text, items, size=13):
    have = words(text)
    hit, found = set(), set()
    for item, said in items:
        said = words(said)
        for at in range(max(1, len(said) - size + 1)) if said else ():
            gram = said[at:at + size]
            for place in range(len(have) - len(gram) + 1):
                if have[place:place + len(gram)] == gram:
                    hit |= set(range(place, place + len(gram)))
                    found.add("" if item is None else str(item))
    return len(have), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_against_all_windows(spark, block):
    random.seed(9)
    letters = ["a", "B", "c1", "é", "Ñ"]
    text = lambda n: " ".join(random.choice(letters) for _ in range(n))
    items = [(at, text(random.choice([2, 5, 13, 14, 30]))) for at in range(12)] + [(3, "a b"), (None, "c1 c1 c1"), (50, None), (51, "--")]
    docs = [(at, text(random.choice([0, 1, 4, 40, 300])), "x") for at in range(60)]
    docs += [(100 + at, text(20) + ", " + said + "! " + text(5), "x") for at, (_, said) in enumerate(items[:12])]
    docs += [(200, None, None), (201, "", None), (None, "a-b_A", None), (None, "a-b_A", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, Items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination(contamination.find_benchmark(df, bench, block_bytes=block)).collect()
    assert len(found) == len(docs)
    for row in found:
        count, hit, names = plain(row.text, items)
        assert (row.n_words, row.n_hit, row["items"]) == (count, hit, names)
        assert row.items_sha256 == contamination.items_digest(names)
        assert row.contaminated == (hit > 0 and 20 * hit >= count)


def test_removal(spark):
    bench = spark.createDataFrame([(1, " ".join(f"w{at}" for at in range(13)))], "item_id long, text string")
    inside = "Before " + ", ".join(f"W{at}" for at in range(13)) + " after."
    df = spark.createDataFrame([(1, inside), (2, "clean"), (3, None)], "doc_id long, text string")
    assert {row.doc_id: row.text for row in contamination.remove_spans(df, bench).collect()} == {
        1: "Before  after.", 2: "clean", 3: None}
    assert sorted(row.doc_id for row in contamination.remove_documents(df, bench).collect()) == [2, 3]
    assert contamination.remove_documents(df, bench.limit(0)).count() == 3
    assert contamination.remove_documents(df.limit(0), bench).count() == 0


NAMES = ["n_words", "spans", "items", "n_hit", "n_items", "items_sha256", "contaminated", "row", "item", "Text2", "window"]


def test_removal_keeps_columns_of_any_name(spark):
    bench = spark.createDataFrame([(1, " ".join(f"w{at}" for at in range(13)))], "item_id long, text string")
    texts = [" ".join(f"w{at}" for at in range(13)), "clean", "clean", None, ""]
    df = spark.createDataFrame([(at, text, *["mine"] * len(NAMES)) for at, text in enumerate(texts)],
                               "doc_id long, text string, " + ", ".join(f"{name} string" for name in NAMES))
    kept = contamination.remove_documents(df, bench)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(row) for row in df.collect() if row.doc_id > 0)
    cut = contamination.remove_spans(df, bench)
    assert cut.columns == df.columns
    assert all(set(row[2:]) == {"mine"} for row in cut.collect())


def test_large_benchmark_is_built_in_seconds():
    random.seed(3)
    words = [f"w{at}" for at in range(50_000)]
    items = [(str(at), " ".join(random.choices(words, k=2000))) for at in range(500)]
    began = time.monotonic()
    windows = contamination.Windows(items)
    assert time.monotonic() - began < 10 and sum(map(len, windows.digests.values())) == 500 * 1988
    spans, found = windows.scan(("x " + items[7][1] + " y").encode().split())
    assert spans == [(1, 2001)] and found == {"7"}


def test_equal_digests_are_verified(monkeypatch):
    monkeypatch.setattr(contamination.Windows, "digest", staticmethod(lambda columns: np.zeros(len(columns[0]), np.uint64)))
    windows = contamination.Windows([("a", "one two three"), ("b", "two three four"), ("c", "one two three")], 3)
    assert windows.scan(b"zero one two three".split()) == ([(1, 4)], {"a", "c"})
    assert windows.scan(b"three four two".split()) == ([], set())
