"""Resampling against plain Python: features, gains, weights, draws; odd inputs; long n-grams."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from reviewlake.llm import resampling
from reviewlake.llm.resampling import Settings

SCHEMA = "doc_id long, text string, N_Words string, score string, rank int, row int, g int, place int, _text string, bucket int"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [word for word in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if word]


def plain_features(text, settings):
    w = words(text)
    return [zlib.crc32(" ".join(w[at:at + n]).encode()) % settings.buckets
            for n in range(1, settings.longest + 1) for at in range(len(w) - n + 1)]


def plain(rows, target, settings):
    def counts(texts):
        return np.bincount(np.array([b for text in texts for b in plain_features(text, settings)], np.int64), minlength=settings.buckets)
    s, t = counts(text for _, text in rows), counts(target)
    gains = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + settings.buckets) / ((s[b] + 1) * (t.sum() + settings.buckets))))
             for b in range(settings.buckets)]
    found = []
    for identity, text in rows:
        f = plain_features(text, settings)
        weight = sum(gains[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{settings.seed}:{'' if identity is None else identity}".encode()).hexdigest()[:8], 16)
        found.append([identity, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((at for at, one in enumerate(found) if one[1] >= settings.least_words),
                  key=lambda at: (-found[at][4], found[at][0] is not None, found[at][0] or 0))
    drawn = {at: place + 1 for place, at in enumerate(able[:settings.percent * len(able) // 100])}
    return sorted((tuple(one) + (drawn.get(at),) for at, one in enumerate(found)), key=repr)


def texts():
    random.seed(5)
    some = [" ".join(random.choice(["red", "Blue", "größer", "x1", "İ", "the", "日本"]) for _ in range(random.randint(0, 60))) for _ in range(120)]
    return some + ["", " .,- ", "a", "One-two_three`four", "long " * 50_000, "same words " * 12, "same words " * 12]


def both(spark, rows, target, settings):
    df = spark.createDataFrame([(identity, text, "mine", "mine", -1, 1, 2, 3, "t", 4) for identity, text in rows], SCHEMA)
    items = spark.createDataFrame([(text,) for text in target], "text string")
    got = resampling.resample(df, items, settings=settings)
    assert got.columns == ["doc_id", "text", "row", "g", "place", "_text", "bucket", "n_words", "n_features", "weight", "score", "rank"]
    got = got.collect()
    assert all((row.row, row.g, row.place, row._text, row.bucket) == (1, 2, 3, "t", 4) for row in got)
    found = [(row.doc_id, row.n_words, row.n_features, row.weight, row.score, row["rank"]) for row in got]
    assert sorted(found, key=repr) == plain(rows, target, settings)


def test_against_plain_python(spark):
    rows = [(at, text) for at, text in enumerate(texts())] + [(900, None), (None, "nobody " * 30)]
    both(spark, rows, ["the red the blue", "größer", None, ""], Settings())
    both(spark, rows, ["the red the blue x1 the"], Settings(buckets=97, longest=4, percent=60, least_words=3, portion=200))


def test_copies_of_a_row_are_drawn_one_by_one(spark):
    rows = [(7, "same words " * 12)] * 40 + [(at, f"other text {at} " * 10) for at in range(20)]
    both(spark, rows, ["same words"], Settings())


def test_empty_sides(spark):
    both(spark, [(1, "a b " * 20), (2, None)], [], Settings(percent=100))
    df = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(df, spark.createDataFrame([("x",)], "text string")).count() == 0


def test_portions_hold_every_row_once():
    found = pa.array(["a" * size if size is not None else None for size in (5, None, 100, 0, 3, 3, 3, 50)])
    from reviewlake.llm.batches import portions
    cut = list(portions(found, 7))
    assert [start for start, _ in cut] == [0, *[end for _, end in cut[:-1]]] and cut[-1][1] == len(found)
    assert list(portions(pa.array([], pa.string()), 7)) == []
