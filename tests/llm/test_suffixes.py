"""Removal of repeated strings against a loop over all windows."""

import random

import pytest

from reviewlake.llm import suffixes


def plain(texts, length):
    """texts in order -> removed byte places of each."""
    seen, gone = set(), []
    for text in texts:
        data, places = (text or "").encode(), set()
        for at in range(len(data) - length + 1):
            window = data[at:at + length]
            if window in seen:
                places |= set(range(at, at + length))
            seen.add(window)
        gone.append(places)
    return gone


def runs(places):
    out = []
    for at in sorted(places):
        if out and out[-1][1] == at:
            out[-1][1] = at + 1
        else:
            out.append([at, at + 1])
    return [tuple(run) for run in out]


def check(spark, rows, length=100, core=24, part=10):
    """rows: doc_id, text; compares with the plain loop, rows in the order of the definition."""
    df = spark.createDataFrame([(id, text, "x") for id, text in rows], "doc_id long, text string, Spans string")
    got = suffixes.remove_repeats(df, length=length, core=core, part=part).collect()
    order = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0))
    want = []
    for (id, text), gone in zip(order, plain([text for _, text in order], length)):
        data = (text or "").encode()
        kept = bytes(value for at, value in enumerate(data) if at not in gone)
        want.append((-1 if id is None else id, kept, len(data), len(gone), runs(gone)))
    found = [(-1 if row.doc_id is None else row.doc_id, bytes(row.kept), row.n_bytes, row.n_removed,
              [(span.start, span.end) for span in row.spans]) for row in got]
    assert sorted(found) == sorted(want)
    return got


def text(size, letters="abcdefgh "):
    return "".join(random.choice(letters) for _ in range(size))


def test_shared_passages(spark):
    random.seed(2)
    passages = [text(size) for size in (100, 101, 130, 400, 99, 250)]
    rows = []
    for id in range(80):
        pieces = [text(random.randint(0, 200))]
        for _ in range(random.randint(0, 3)):
            passage = random.choice(passages)
            cut = random.randint(0, 60)
            pieces += [passage[cut:], text(random.randint(0, 90))]
        rows.append((id * 7 % 80, "".join(pieces)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "é" * 49), (205, "é" * 60), (206, "xé" * 700)]
    check(spark, rows)


@pytest.mark.parametrize("letters", ["a", "ab", "aé"])
def test_periodic_texts(spark, letters):
    random.seed(3)
    rows = [(at, text(random.randint(0, 400), letters)) for at in range(12)] + [(50, "ab" * 300), (51, "aab" * 200), (52, "a" * 99)]
    check(spark, rows)


@pytest.mark.parametrize("length, core, part", [(30, 8, 5), (12, 11, 2), (255, 24, 10), (50, 5, 1)])
def test_other_lengths(spark, length, core, part):
    random.seed(length)
    passage = text(3 * length)
    rows = [(at, text(length) + passage[random.randint(0, length):random.randint(length, 3 * length)] + text(20)) for at in range(25)]
    check(spark, rows, length, core, part)


def test_edits_of_one_text(spark):
    random.seed(5)
    base = text(3000)
    rows = []
    for id in range(40):
        edited = list(base)
        for _ in range(id % 6):
            edited[random.randrange(len(edited))] = "#"
        rows.append((id, "".join(edited)))
    check(spark, rows)


def test_equal_ids_and_no_ids(spark):
    random.seed(6)
    same, other = text(300), text(150)
    rows = [(1, same), (1, same), (1, same), (None, other), (None, other), (2, other + "tail")]
    got = check(spark, rows)
    assert sorted(row.n_removed for row in got) == [0, 0, 150, 150, 300, 300]
    assert check(spark, []) == []


def test_cut_characters(spark):
    passage = "ab" * 50  # the last byte of é is that of ©
    rows = spark.createDataFrame([(1, "é" + passage), (2, "©" + passage + "z"), (3, "ä" + passage + "z")], "doc_id long, text string")
    got = {row.doc_id: (row.kept_text, bytes(row.kept)) for row in suffixes.remove_repeats(rows).collect()}
    assert got[2] == ("z", b"\xc2z") and got[3] == ("ä", "ä".encode())
    rows = spark.createDataFrame([(1, "é" * 80), (2, "É" + "é" * 80)], "doc_id long, text string")
    got = {row.doc_id: (row.kept_text, bytes(row.kept)) for row in suffixes.remove_repeats(rows).collect()}
    assert got[2][0] == "É" and got[2][1].startswith("É".encode())


def test_wrong_settings(spark):
    with pytest.raises(ValueError):
        suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=300)


def test_columns_of_any_name_stay(spark):
    names = ["_digest", "_row", "_places", "_ord", "row", "id", "place", "core", "whole", "first"]
    rows = [(5, "x" * 150), (5, "x" * 150), (None, "y" * 120), (6, "y" * 130)]
    df = spark.createDataFrame([(*row, *[f"mine {at}"] * len(names)) for at, row in enumerate(rows)],
                               "doc_id long, text string, " + ", ".join(f"{name} string" for name in names))
    found = suffixes.remove_repeats(df)
    assert found.columns[:len(df.columns)] == df.columns
    got = sorted(found.collect(), key=lambda row: row._digest)
    assert [tuple(row[2:12]) for row in got] == [tuple([f"mine {at}"] * len(names)) for at in range(4)]
    assert [(row.n_bytes, row.n_removed) for row in got] == [(150, 149), (150, 150), (120, 120), (130, 129)]
