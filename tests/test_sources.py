"""Readers on small hand-made files, and the lake."""

import json

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import relational, standardize
from reviewlake.plans.transform import Job, execute_all_jobs, execute_job
from reviewlake.sources import files
from reviewlake.sources.lake import Lake, latest_versions


def read(outcome):
    frame, errors = outcome
    assert errors == []
    return frame


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_json_shapes(spark, tmp_path):
    listed = write(tmp_path / "a.json", json.dumps([{"a": 1}, {"a": 2, "b": "x"}]))
    wrapped = write(tmp_path / "b.json", json.dumps({"z": [], "first": [{"a": 1}], "b": [{"c": 1}, {"c": 2}]}))
    single = write(tmp_path / "c.json", json.dumps({"a": 1, "b": "x"}))
    assert read(files.ingest_json(spark, listed)).count() == 2
    assert read(files.ingest_json(spark, wrapped)).columns == ["a"]
    assert read(files.ingest_json(spark, single)).collect()[0].asDict() == {"a": 1, "b": "x"}


def test_unreadable_input_is_reported(spark, tmp_path):
    frame, errors = files.ingest_parquet(spark, str(tmp_path / "none.parquet"))
    assert frame is None and len(errors) == 1
    frames, errors = files.ingest_database(spark, "jdbc:unknown:nowhere", ["users", "orders"])
    assert frames == {} and len(errors) == 2


def test_xml(spark, tmp_path):
    path = write(tmp_path / "c.xml", '<Catalog><Product id="1"><Name>A</Name><Price>1.5</Price><Inventory><Stock>3</Stock>'
                                     "</Inventory></Product><Product><Name>B</Name></Product></Catalog>")
    flat = read(files.ingest_xml(spark, path, "Product"))
    assert flat.columns == ["Name", "Price"] and flat.collect()[0]["Price"] == "1.5"
    assert "Inventory" in read(files.ingest_xml(spark, path, "Product", flatten=False)).columns


def test_api_keys(spark, tmp_path):
    path = write(tmp_path / "r.json", json.dumps({"products": [{"a": 1}], "total": 1}))
    assert read(files.ingest_api_responses(spark, path)).count() == 1
    assert read(files.ingest_api_responses(spark, path, ["products"])).columns == ["a"]


def test_pages_stop_at_the_first_gap(spark, tmp_path):
    for page, rows in ((1, [1]), (2, [2, 3]), (4, [4])):
        folder = tmp_path / f"page={page}"
        folder.mkdir()
        write(folder / "p.json", json.dumps({"data": [{"a": row} for row in rows]}))
    found = read(files.ingest_paginated_api(spark, str(tmp_path)))
    assert sorted(row["a"] for row in found.collect()) == [1, 2, 3]
    some, told = files.ingest_paginated_api(spark, str(tmp_path), max_pages=1)
    assert some.count() == 1 and told == ["1 of 2 pages were not read"]


def test_many_pages(spark, tmp_path):
    for page in range(1, 16):
        (tmp_path / f"page={page}").mkdir()
        write(tmp_path / f"page={page}" / "p.json", json.dumps({("results" if page % 3 else "items"): [{"a": page}]}))
    assert read(files.ingest_paginated_api(spark, str(tmp_path))).count() == 15


def test_documents_differ(spark, tmp_path):
    write(tmp_path / "a.json", json.dumps({"data": [{"v": 1}, {"v": 2}], "n": 2}))
    write(tmp_path / "b.json", json.dumps({"results": [{"v": 3}]}))
    write(tmp_path / "c.json", json.dumps({"v": 9}, indent=1))
    write(tmp_path / "d.json", json.dumps([{"v": 4}, {"v": 5, "tags": [1]}], indent=2))
    for reader in (files.ingest_json, files.ingest_api_responses):
        assert sorted(row["v"] for row in read(reader(spark, str(tmp_path))).collect()) == [1, 2, 3, 4, 5, 9]


def test_json_lines_go_line_by_line(spark, tmp_path):
    path = write(tmp_path / "l.json", "\n".join(json.dumps({"a": at, "tags": [at]}) for at in range(50)) + "\n")
    assert read(files.ingest_json(spark, path)).columns == ["a", "tags"]
    assert read(files.ingest_json(spark, path)).count() == 50


def test_broken_json_is_reported(spark, tmp_path):
    write(tmp_path / "a.json", '{"a": 1')
    write(tmp_path / "b.json", '{"a": 2}')
    rows = read(files.ingest_json(spark, str(tmp_path))).cache().collect()
    assert sorted((row["a"] or 0, row["_corrupt_record"]) for row in rows) == [(0, '{"a": 1'), (2, None)]


def test_late_accent_and_files_of_two_encodings(spark, tmp_path):
    plain = "".join(f"text {at};5\n" for at in range(2000))
    write(tmp_path / "a.csv", "Text;Stars\n" + plain + "caf\u00e9;4\n", "latin-1")
    write(tmp_path / "b.csv", "Text;Stars\nna\u00efve;3\nText;Stars\n", "utf-8")
    write(tmp_path / "c.csv", "Stars;Text;More\n2;other order;x\n", "utf-8")
    rows = {(row["Text"], row["Stars"], row["More"]) for row in files.load_uploaded_data(spark, str(tmp_path)).collect()}
    assert {("caf\u00e9", "4", None), ("na\u00efve", "3", None), ("other order", "2", "x"), ("Text", "Stars", None)} <= rows
    assert len(rows) == 2004


def test_short_rows_are_padded(spark, tmp_path):
    path = write(tmp_path / "s.csv", "a,b,c\n1,x,y\nonly-one-cell\n2,z\n3,x,y,more\n")
    rows = files.load_uploaded_data(spark, path, count_cells=True).collect()
    assert sorted((row["a"], row["b"], row["c"], row["Column_4"], row["_cells"]) for row in rows) == [
        ("1", "x", "y", None, 3), ("2", "z", None, None, 2), ("3", "x", "y", "more", 4), ("only-one-cell", None, None, None, 1)]


@pytest.mark.parametrize(("encoding", "delimiter"), [("utf-8", ";"), ("utf-8-sig", ","), ("latin-1", "|"), ("utf-16", "\t")])
def test_messy_upload(spark, tmp_path, encoding, delimiter):
    rows = [["Text", "Stars", "junk"], [f'"so{delimiter} good é"', " 5", ""], ["bad", "2", ""], ["meh", "x", ""], ["", "", ""],
            ["short", "3"]]
    path = write(tmp_path / "u.txt", "\n".join(delimiter.join(row) for row in rows) + "\n", encoding)
    found = files.load_uploaded_data(spark, path)
    assert found.columns == ["Text", "Stars"]
    assert found.where("Stars = '5'").first()["Text"] == f"so{delimiter} good é"
    clean = standardize.standardize(found)
    assert sorted(row["rating"] for row in clean.collect()) == [2.0, 3.0, 5.0]


def test_upload_without_header(spark, tmp_path):
    path = write(tmp_path / "n.csv", "1,a,x\n2,b,y\n3,c,z\n")
    found = files.load_uploaded_data(spark, path)
    assert found.columns == ["Column_1", "Column_2", "Column_3"] and found.count() == 3


def test_upload_refuses_other_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        files.load_uploaded_data(spark, str(tmp_path / "x.pdf"))


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("a", 1)], "my_comment string, points int")
    with pytest.raises(ValueError, match="my_comment"):
        standardize.standardize(df)


def test_first_alias_wins(spark):
    df = spark.createDataFrame([(1, 2, "t")], "Score int, stars int, TEXT string")
    assert standardize.standardize_names(df).collect()[0].asDict() == {"rating": 1, "review_text": "t"}


def test_minimum_data(spark):
    few = spark.createDataFrame([(5, "a")] * 3, "rating int, review_text string")
    assert not standardize.validate_data(few, "reviews").first()["is_valid"]
    bad = spark.createDataFrame([(9, "a")] * 3 + [(5, "b")] * 10, "rating int, review_text string")
    assert "not from 1 to 5" in standardize.validate_data(bad, "reviews").first()["message"]
    assert standardize.validate_data(bad).first()["is_valid"]


def test_log_lines(spark, tmp_path):
    path = write(tmp_path / "a.log", "2024-01-01 10:00:00 [ERROR] Api-Gate - it broke - twice | user_id=U1 request_id=r9\nnoise\n")
    rows = files.read_logs(spark, path).collect()
    assert rows[0]["level"] == "ERROR" and rows[0]["user_id"] == "U1" and rows[1]["level"] is None


# Lake ---------------------------------------------------------------------------------------------


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.mark.parametrize("file_format", ["parquet", "json", "csv"])
def test_round_trip_keeps_types(spark, lake, file_format):
    df = spark.sql("SELECT 1 AS id, 'a, \"b\"' AS t, timestamp'2024-02-03 04:05:06.123456' AS created_at, CAST(NULL AS INT) AS n")
    lake.write_dataset(df, "d", "raw", ["year", "month"], file_format)
    back = lake.read_dataset("d", "raw")
    assert back.select(df.columns).collect() == df.collect() and back.first()["year"] == 2024
    assert lake.read_dataset("d", "raw", ["id"], [("month", "==", 2), ("id", "in", [1, 7])]).collect()[0]["id"] == 1


def test_append_replace_and_refusals(spark, lake):
    df = spark.range(3)
    lake.write_dataset(df, "d")
    lake.write_dataset(df, "d")
    assert lake.read_dataset("d").count() == 6 and lake.get_dataset_metadata("d")["row_count"] == 6
    with pytest.raises(ValueError, match="stored as"):
        lake.write_dataset(df, "d", file_format="csv")
    lake.write_dataset(df, "d", file_format="csv", overwrite=True)
    assert lake.read_dataset("d").count() == 3
    with pytest.raises(ValueError, match="layer"):
        lake.write_dataset(df, "d", "gold")
    with pytest.raises(KeyError):
        lake.read_dataset("missing")


def test_two_writers_lose_nothing(spark, lake):
    other = Lake(spark, lake.root)
    lake.write_dataset(spark.range(2), "d")
    entry = other._entry
    first = entry("d")
    other._entry = lambda name, layer=None: first  # the other writer looked before the next append
    lake.write_dataset(spark.range(3), "d")
    other.write_dataset(spark.range(4), "d")
    assert lake.read_dataset("d").count() == 9 and lake.get_dataset_metadata("d")["row_count"] == 9
    lake.compact_catalog()
    assert lake.read_dataset("d").count() == 9


def test_a_thousand_appends_are_one_scan(spark, lake):
    lake.write_dataset(spark.range(1), "d")
    entry = lake._entry("d")
    for at in range(1000):
        lake._record(dataset="e", layer="raw", kind="append", path=entry["paths"][0], format="parquet", compression="snappy",
                     partitions=[], schema=entry["schema"].json(), files=1, bytes=1, row_count=1, nulls=0, cells=1) if at < 3 else None
    paths = entry["paths"] * 1000
    df = lake._read_paths(paths, "parquet", entry["schema"])
    assert df._jdf.queryExecution().analyzed().toString().count("Relation") == 1
    assert lake.read_dataset("e").count() == 3


def test_target_size(spark, lake):
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), (F.col("id") % 2).alias("part"))
    lake.write_dataset(df, "d", "processed", ["part"])
    lake.optimize_dataset("d", "processed", target_bytes=1 << 20)
    many = lake.get_dataset_metadata("d")["total_files"]
    lake.optimize_dataset("d", "processed", target_bytes=1 << 30)
    assert lake.get_dataset_metadata("d")["total_files"] == 2 and many > 8


def test_appended_columns_are_merged(spark, lake):
    lake.write_dataset(spark.createDataFrame([(1, "a")], "k int, v string"), "d")
    lake.write_dataset(spark.createDataFrame([(2, 5)], "k int, n int"), "d")
    assert sorted(map(tuple, lake.read_dataset("d").collect())) == [(1, "a", None), (2, None, 5)]


def test_columns_unknown_to_the_dataset(spark, lake):
    lake.write_dataset(spark.range(1), "p")
    lake.write_dataset(spark.range(1), "j", file_format="json")
    assert lake.read_dataset("j", columns=["id", "x"]).columns == ["id"]
    with pytest.raises(ValueError, match="unknown columns"):
        lake.read_dataset("p", columns=["x"])


def test_upsert_and_compaction(spark, lake):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    lake.upsert(first, "d", ["k"], batch=1)
    lake.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "d", ["k"], batch=2)
    want = {1: "a", 2: "c", 3: "d"}
    assert {row["k"]: row["v"] for row in lake.latest("d", ["k"]).collect()} == want
    lake.optimize_dataset("d", "processed", ["k"])
    assert lake.read_dataset("d", "processed").count() == 3
    assert {row["k"]: row["v"] for row in lake.latest("d", ["k"]).collect()} == want


def test_latest_version_ignores_order(spark):
    rows = [(k, v) for v in (3, 1, 2) for k in range(5)]
    df = spark.createDataFrame(rows, "k int, _batch bigint")
    assert latest_versions(df, ["k"], keep_batch=True).agg(F.min("_batch")).first()[0] == 3


def test_retention_archives(spark, lake):
    lake.write_dataset(spark.range(2), "d", "curated")
    assert lake.cleanup_old_data(1, F.current_timestamp()) == []
    assert lake.cleanup_old_data(1, F.current_timestamp() + F.expr("interval 3 days")) == ["d (curated)"]
    assert [row["layer"] for row in lake.catalog().collect()] == ["archive"]


def test_snapshot_diff_counts_nulls(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "k int, v string")
    found = {row["k"]: row["change"] for row in relational.snapshot_diff(before, after, "k").collect()}
    assert found == {2: "update", 3: "update", 4: "delete", 5: "insert"}


# Jobs ---------------------------------------------------------------------------------------------


def test_jobs_record_problems(spark, tmp_path):
    source = write(tmp_path / "r.csv", "rating,t\n9,a\n5,b\n")
    rules = {"value_ranges": {"rating": {"max": 5}}}
    good = execute_job(spark, Job("file", source, str(tmp_path / "out"), "csv"), rules)
    assert good.status == "completed" and good.records_processed == 2 and "rises above 5" in good.errors[0]
    strict = execute_job(spark, Job("file", source, str(tmp_path / "strict"), "csv"), rules, allow_quality_issues=False)
    assert strict.status == "failed"
    log = execute_all_jobs(spark, [good, Job("queue", "x", "y", "csv"), Job("file", str(tmp_path / "no"), "y", "json")],
                           log_path=str(tmp_path / "log"))
    assert sorted(row["status"] for row in log.collect()) == ["completed", "failed", "failed"]
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3


def test_catalog_compaction_survives_a_crash(spark, lake, monkeypatch):
    lake.write_dataset(spark.range(2), "d")
    lake.write_dataset(spark.range(3), "e")
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "_forget", lambda self, base: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            lake.compact_catalog()
    assert lake.read_dataset("d").count() == 2 and lake.read_dataset("e").count() == 3
    lake.write_dataset(spark.range(4), "d")
    assert lake.read_dataset("d").count() == 6
    lake.compact_catalog()
    lake.compact_catalog()
    assert lake.read_dataset("d").count() == 6 and lake.read_dataset("e").count() == 3
    lake.drop_dataset("e", "raw")
    assert [row["dataset"] for row in lake.catalog().collect()] == ["d"]
