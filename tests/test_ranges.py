"""Files cut by byte ranges: JSON documents and delimited text against whole-file readers, at many range sizes."""

import csv
import io
import json
import random

import pytest

from reviewlake.operators.relational import union_all
from reviewlake.sources import files, ranges


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def thing(deep=0):
    kind = random.randint(0, 7 if deep < 4 else 4)
    if kind < 5:
        return [random.randint(-9, 99), None, True, 1.5, "".join(random.choice(['"', "\\", ",", "[", "]", "{", "}", "\n", "é", "a", " "]) for _ in range(random.randint(0, 12)))][kind]
    if kind == 5:
        return [thing(deep + 1) for _ in range(random.randint(0, 4))]
    return {random.choice(["a", "b,", "c[", 'd"']) + str(at): thing(deep + 1) for at in range(random.randint(0, 4))}


def element():
    return {"k": random.randint(0, 999), "v": thing()}


def wanted(document):
    """Records of a document and, for objects, the first filled list."""
    if isinstance(document, list):
        return document
    return next((value for value in document.values() if isinstance(value, list) and value), [document])


def plain(records):
    found = []
    for value in records:
        try:
            found.append(json.loads(value))
        except ValueError:
            found.append(f"bad: {value}")
    return sorted(json.dumps(one, sort_keys=True) for one in found)


@pytest.mark.parametrize("size", [200, 100_000])
def test_documents_of_any_shape(spark, tmp_path, small_ranges, size):
    random.seed(size)
    want = []
    for at in range(10):
        document = random.choice([
            lambda: [element() for _ in range(random.randint(0, 25))], lambda: [thing() for _ in range(random.randint(0, 9))],
            lambda: {"n": thing(3), "none": [], "rows, [": [element() for _ in range(random.randint(0, 25))], "z": [1, "x"], "t": {"u": [3]}},
            lambda: {"only": {"deep": [1, 2]}, "s": "[1,2]"}, lambda: {"empty": [], "x": 1}])()
        (tmp_path / f"d{at}.json").write_text(json.dumps(document, indent=random.choice([None, 1]), ensure_ascii=random.random() < 0.5),
                                              encoding=random.choice(["utf-8", "utf-8-sig"]))
        want += wanted(document)
    small_ranges(size)
    found = files._records(spark, str(tmp_path), files._first_filled)
    got, want = plain(row.value for row in found.collect()), sorted(json.dumps(one, sort_keys=True) for one in want)
    assert not set(got) ^ set(want) and got == want


def test_every_task_is_below_one_range(spark, tmp_path, small_ranges):
    rows = [{"a": at, "text": "x" * 50} for at in range(1000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    small_ranges(8192)
    cut = ranges.over_ranges(ranges.pieces(spark, str(tmp_path / "a.json"), ","), ranges.JSON_REPORT, ranges.JsonReport)
    assert cut.count() >= 8
    found, errors = files.ingest_json(spark, str(tmp_path / "a.json"))
    assert not errors and sorted((row.a, len(row.text)) for row in found.collect()) == [(at, 50) for at in range(1000)]


@pytest.mark.parametrize("size", [400, 100_000])
def test_bad_lines_are_kept_apart(spark, tmp_path, small_ranges, size):
    lines = [json.dumps({"a": at, "s": 'x, "[{'}) for at in range(1000)]
    lines[500:500] = ['{"a": 5, "s": "cut', "", "nonsense, more", "   "]
    (tmp_path / "l.json").write_text("\n".join(lines) + "\n")
    small_ranges(size)
    found, errors = files.ingest_json(spark, str(tmp_path / "l.json"))
    rows = found.cache().collect()
    assert not errors and sorted(row.a for row in rows if row.a is not None) == list(range(1000))
    assert sorted(row["_corrupt_record"] for row in rows if row.a is None) == ["nonsense, more", '{"a": 5, "s": "cut']


def test_broken_documents_say_so(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}, {"a":')
    (tmp_path / "b.json").write_text('{"list": [{"a": 3}], "b": ')
    rows = files.ingest_json(spark, str(tmp_path))[0].cache().collect()
    assert sorted(row.a for row in rows if row.a is not None) == [1, 2, 3]
    assert sorted(row["_corrupt_record"] for row in rows if row.a is None) == ["[", '{"a":', '{"list": [], "b":']


def test_names_with_spaces_and_folders(spark, tmp_path):
    for page in (1, 2):
        folder = tmp_path / "api run" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "p 1.json").write_text(json.dumps({"data": [{"v": page}], "other": [1]}))
        (folder / "p 2.json").write_text(json.dumps({"unknown": [1], "v": page * 10}))
    found, errors = files.ingest_paginated_api(spark, str(tmp_path / "api run"))
    assert not errors and sorted(row.v for row in found.collect()) == [1, 2, 10, 20]


CELLS = ["a", "b;c", 'say "x"', "two\nlines", "end;\n\n;x", "", '"', "é", "5 cm", "\n"]


@pytest.mark.parametrize("size", [60, 100_000])
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-16-le"])
def test_delimited_text(spark, tmp_path, small_ranges, size, encoding):
    random.seed(size)
    tables = []
    for name in ("a", "b"):
        rows = [[str(at)] + [random.choice(CELLS) for _ in range(3)] for at in range(30)]
        if encoding == "utf-16-le":
            rows = [[cell.replace("\n\n", "\n").strip("\n") for cell in row] for row in rows]
        out = io.StringIO()
        csv.writer(out, delimiter=";", lineterminator="\n").writerows([["id", "x", "y", "z"], *rows])
        (tmp_path / f"{name}.csv").write_bytes(out.getvalue().encode(encoding))
        tables += rows
    small_ranges(size)
    given = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1", "utf-16-le": "UTF-16LE"}[encoding]
    found = ranges.delimited_cells(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ";", given, True)
    assert sorted(row.cells for row in found.collect()) == sorted([cell.strip(" ").strip("\"' ") for cell in row] for row in tables)


def test_stray_and_unclosed_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x;5" wide;y\n"open;never\nz;w;v\n')
    (tmp_path / "b.csv").write_text('k;"two\nlines";l\n')
    found = ranges.delimited_cells(spark, [str(tmp_path / name) for name in ("a.csv", "b.csv")], ";", "UTF-8", False)
    assert sorted(row.cells for row in found.collect()) == [["k", "two\nlines", "l"], ["open;never"], ["x", '5" wide', "y"], ["z", "w", "v"]]


def test_many_quoted_cells(spark, tmp_path):
    rows = [[f"{at}, {place}" for place in range(5000)] for at in range(20)]
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL).writerows(rows)
    (tmp_path / "w.csv").write_text(out.getvalue())
    found = ranges.delimited_cells(spark, [str(tmp_path / "w.csv")], ",", "UTF-8", False)
    assert sorted(row.cells for row in found.collect()) == sorted(rows)


def test_union_of_nothing(spark, tmp_path):
    (tmp_path / "blank.json").write_text("  \n ")
    assert files._records(spark, str(tmp_path), files._first_filled).count() == 0
    assert union_all([spark.range(1), spark.range(1)]).count() == 2


def test_readers_get_long_pieces_in_portions(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ranges, "HELD", 100)
    sizes = [60, 30, 20, 500, 0, 40, 61, 1]
    values = pa.array([b"x" * 7] + [bytes([at]) * size for at, size in enumerate(sizes)], pa.binary()).slice(1)
    found = list(ranges._portions(values))
    assert [[len(value) for value in some] for some in found] == [[60, 30], [20], [500], [0, 40], [61, 1]]
    assert [value for some in found for value in some] == values.to_pylist()
    assert list(ranges._portions(values.slice(0, 0))) == []
