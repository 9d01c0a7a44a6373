"""Sources, sinks, the lake, documents, the warehouse and whole runs.

Each query writes what it reads from the stored tables first, below the shared
folder, so that the work grows with the tables.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from reviewlake import lens
from reviewlake.lens import with_sql
from reviewlake.functions.text import words
from reviewlake.operators import documents, relational, warehouse
from reviewlake.operators.features import FeatureConfig
from reviewlake.operators.standardize import standardize
from reviewlake.plans import transform
from reviewlake.plans.quality_queries import _dirty
from reviewlake.plans.registry import day, query, rounded, second
from reviewlake.plans.text_queries import FREQUENT, LABELS, WS, compound_sql, words_sql
from reviewlake.schemas import TABLES
from reviewlake.session import materialize, scratch_path
from reviewlake.sources import files, ranges
from reviewlake.sources.lake import (Lake, append_job_log, export, extract_tables, query_data, retained, write_files)


def _ok(outcome):
    frame, errors = outcome
    if errors:
        raise RuntimeError("; ".join(errors))
    return frame


def _lake(spark) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


# Sources ------------------------------------------------------------------------------------------

ORDERS_SQL = """SELECT o_orderstatus, o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total,
  strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM orders GROUP BY 1, 2"""


def _orders_summary(df):
    return df.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        day(F.max("o_orderdate")).alias("latest"))


@query("s01_csv_scan", ORDERS_SQL)
def s01(spark, base):
    path = scratch_path(spark, "csv")
    export(lens.table(spark, base, "orders"), path, "csv")
    return _orders_summary(_ok(files.ingest_csv(spark, path, TABLES["orders"])))


@query("s01_csv_inferred", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s01_inferred(spark, base):
    path = scratch_path(spark, "csv")
    export(lens.table(spark, base, "customer"), path, "csv")
    read = _ok(files.ingest_csv(spark, path))
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


WORD_ROWS = f"""SELECT item_id AS id, w, length(w) AS n FROM (SELECT item_id, unnest({words_sql('text')}) AS w FROM benchmark)"""


def _landed(spark, base, key: str, extra=(), partition: str | None = None) -> str:
    """Every benchmark item as one landed document {..., key: [{id, w, n}, ...]}, one file each."""
    item = lens.table(spark, base, "benchmark")
    entries = F.transform(words(F.col("text")), lambda w: F.struct(
        F.col("item_id").alias("id"), w.alias("w"), F.length(w).cast("bigint").alias("n")))
    if partition:
        entries = F.when(F.col("page") == 6, F.slice(entries, 1, 0)).otherwise(entries)
    body = F.struct(F.lit("2024-01-31").alias("export_date"), F.array().cast("array<string>").alias("errors"),
                    *extra, entries.alias(key))
    path = scratch_path(spark, "landed")
    paged = item.withColumn("page", (F.col("item_id") % 8 + 1).cast("int"))
    rows = paged.select(F.to_json(body).alias("value"), *([partition] if partition else []))
    writer = rows.write.option("maxRecordsPerFile", 1)
    (writer.partitionBy(partition) if partition else writer).text(path)
    return path


@query("s02_json_document", f"SELECT id, count(*) AS words, CAST(sum(n) AS BIGINT) AS letters FROM ({WORD_ROWS}) GROUP BY 1")
def s02(spark, base):
    rows = _ok(files.ingest_json(spark, _landed(spark, base, "activities")))
    return rows.groupBy("id").agg(F.count("*").alias("words"), F.sum("n").alias("letters"))


def _entries():
    return F.transform(words(F.col("text")), lambda w: F.struct(
        F.col("item_id").alias("id"), w.alias("w"), F.length(w).cast("bigint").alias("n")))


def _mixed(spark, base, *keys: str) -> str:
    """One landed document an item, whose list stands under a key by turns; under no key where that is empty."""
    place = F.pmod(F.col("item_id"), F.lit(len(keys)))
    body = F.coalesce(*[F.when(place == at, F.to_json(F.struct(F.lit("x").alias("a"), F.col("e").alias(key))) if key
                               else F.to_json(F.col("e"))) for at, key in enumerate(keys)])
    path = scratch_path(spark, "landed")
    (lens.table(spark, base, "benchmark").withColumn("e", _entries()).select(body.alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))
    return path


COUNTED = f"SELECT id, count(*) AS words, CAST(sum(n) AS BIGINT) AS letters FROM ({WORD_ROWS}) GROUP BY 1"


def _counted(rows):
    return rows.groupBy("id").agg(F.count("*").alias("words"), F.sum("n").alias("letters"))


@query("s02_mixed_documents", COUNTED)
def s02_mixed(spark, base):
    return _counted(_ok(files.ingest_json(spark, _mixed(spark, base, "activities", "entries", ""))))


@query("s02_json_lines", COUNTED)
def s02_lines(spark, base):
    path = scratch_path(spark, "lines")
    rows = lens.table(spark, base, "benchmark").select(F.explode(_entries()).alias("e"))
    rows.select(F.to_json("e").alias("value")).write.text(path)
    return _counted(_ok(files.ingest_json(spark, path)))


@query("s07_mixed_keys", COUNTED)
def s07_mixed(spark, base):
    return _counted(_ok(files.ingest_api_responses(spark, _mixed(spark, base, "results", "items", "data", "records", ""))))


@query("s08_many_pages", COUNTED)
def s08_many(spark, base):
    path = scratch_path(spark, "pages")
    page = (F.col("item_id") % 16 + 1).cast("int").alias("page")
    (lens.table(spark, base, "benchmark").select(F.to_json(F.struct(_entries().alias("results"))).alias("value"), page)
     .write.option("maxRecordsPerFile", 1).partitionBy("page").text(path))
    return _counted(_ok(files.ingest_paginated_api(spark, path)))


@query("s09_late_accents", """
SELECT CAST(c_custkey AS VARCHAR) AS "Customer", c_name || CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN ' é' ELSE '' END AS "Comment"
FROM customer""")
def s09_accents(spark, base):
    customers = lens.table(spark, base, "customer")
    last = customers.agg(F.max("c_custkey")).scalar()
    path = scratch_path(spark, "upload")
    (customers.orderBy("c_custkey").select(F.col("c_custkey").alias("Customer"), F.concat("c_name", F.when(
        F.col("c_custkey") == last, " é").otherwise("")).alias("Comment"))
     .write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path))
    return files.load_uploaded_data(spark, path)


@query("s09_short_rows", """
SELECT CAST(c_custkey AS VARCHAR) AS "Customer", CAST(1 + c_custkey % 5 AS VARCHAR) AS "Stars",
       CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS "Comment" FROM customer""")
def s09_short(spark, base):
    key = F.col("c_custkey")
    line = F.concat_ws(";", key.cast("string"), (key % 5 + 1).cast("string"), F.when(key % 10 != 0, F.col("c_mktsegment")))
    path = scratch_path(spark, "upload")
    head = spark.createDataFrame([("Customer;Stars;Comment",)], "value string")
    head.write.text(path)
    lens.table(spark, base, "customer").select(line.alias("value")).write.mode("append").text(path)
    return files.load_uploaded_data(spark, path)


@contextmanager
def _small_splits(spark, ranges: int, path: str):
    """Files below `path` are read in about so many ranges, as large ones are at the usual size."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", max(1024, size // ranges))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _customers():
    return F.struct(F.col("c_custkey").alias("id"), F.concat(F.lit('"['), F.col("c_name"), F.lit(',{"}\\')).alias("name"),
                    F.array(F.struct(F.col("c_acctbal").alias("v"))).alias("tags"))


CUSTOMERS_SQL = """SELECT CAST(c_custkey AS BIGINT) AS id, '"[' || c_name || ',{"}' || chr(92) AS name, c_acctbal AS v FROM customer"""


def _read_customers(rows):
    return rows.select(F.col("id").cast("bigint").alias("id"), "name", F.col("tags")[0]["v"].cast("double").alias("v"))


@query("s02_split_array", CUSTOMERS_SQL)
def s02_split_array(spark, base):
    """One array a nation, plain or below a key, on one line or on many, each read in several ranges."""
    path = scratch_path(spark, "arrays")
    kind = F.col("c_nationkey") % 4
    items = F.collect_list(_customers())
    lists = lens.table(spark, base, "customer").groupBy("c_nationkey").agg(items.alias("items")).select(
        F.when(kind == 0, F.to_json("items")).when(kind == 1, F.to_json("items", {"pretty": "true"}))
        .when(kind == 2, F.to_json(F.struct(F.lit("a, [b]").alias("note"), F.col("items"), F.array(F.lit(1)).alias("z"))))
        .otherwise(F.to_json(F.struct(F.expr("array()").alias("none"), F.col("items")), {"pretty": "true"})).alias("value"))
    lists.write.option("maxRecordsPerFile", 1).text(path)
    with _small_splits(spark, 75, path):
        return _read_customers(_ok(files.ingest_json(spark, path)))


@query("s02_bad_lines", """
SELECT CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey AS BIGINT) END AS id, CASE WHEN c_custkey % 10 = 0 THEN '{"id": ' || c_custkey || ', "name": "cut' END AS bad
FROM customer""")
def s02_bad_lines(spark, base):
    path = scratch_path(spark, "lines")
    key = F.col("c_custkey")
    lens.table(spark, base, "customer").select(F.when(key % 10 != 0, F.to_json(_customers())).otherwise(
        F.concat(F.lit('{"id": '), key.cast("string"), F.lit(', "name": "cut'))).alias("value")).write.text(path)
    with _small_splits(spark, 40, path):
        rows = _ok(files.ingest_json(spark, path))
    # bad lines may be told from good ones once the rows are stored
    return materialize(rows, "rows").select(F.col("id").cast("bigint").alias("id"), F.col("_corrupt_record").alias("bad"))


@query("s09_quoted_breaks", """
SELECT CAST(c_custkey AS VARCHAR) AS "Customer", CASE WHEN c_custkey % 3 = 0 THEN c_name || ';' || chr(10) || chr(10) || 'said "no"' || chr(10) || c_mktsegment ELSE c_name || ' 5" wide' END AS "Comment",
       c_mktsegment AS "Segment" FROM customer""")
def s09_quoted_breaks(spark, base):
    """Cells that hold separators, line ends, blank lines and doubled quotes, or a quote that opens nothing."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    broken = F.concat(F.lit('"'), name, F.lit(';\n\nsaid ""no""\n'), F.col("c_mktsegment"), F.lit('"'))
    line = F.concat_ws(";", key, F.when(F.col("c_custkey") % 3 == 0, broken).otherwise(F.concat(name, F.lit(' 5" wide'))), "c_mktsegment")
    path = scratch_path(spark, "upload")
    spark.createDataFrame([("Customer;Comment;Segment",)], "value string").write.text(path)
    lens.table(spark, base, "customer").select(line.alias("value")).write.mode("append").text(path)
    with _small_splits(spark, 60, path):
        return files.load_uploaded_data(spark, path)


@query("s09_many_quotes", """
SELECT l_orderkey // 1500 AS line, count(*) AS cells, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem GROUP BY 1""")
def s09_many_quotes(spark, base):
    """Lines of some thousand quoted cells, each with a separator in it."""
    cell = F.concat(F.lit('"'), F.col("l_orderkey").cast("string"), F.lit(";"), F.col("l_quantity").cast("string"), F.lit('"'))
    lines = lens.table(spark, base, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 1500).alias("line")).agg(F.collect_list(cell).alias("cells"))
    path = scratch_path(spark, "upload")
    lines.select(F.concat_ws(";", F.col("line").cast("string"), "cells").alias("value")).write.text(path)
    found = ranges.delimited_cells(spark, [path], ";", "UTF-8", False)
    pair = F.transform(F.slice("cells", F.lit(2), F.size("cells")), lambda x: F.split(x, ";"))

    def total(at, kind):
        return F.aggregate(pair, F.lit(0).cast(kind), lambda sum_, x: sum_ + x[at].cast(kind))
    return found.select(F.col("cells")[0].cast("bigint").alias("line"), (F.size("cells") - 1).cast("bigint").alias("cells"),
                        total(0, "bigint").alias("keys"), total(1, "double").alias("quantity"))


@query("s03_parquet_scan", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def s03(spark, base):
    rows = _ok(files.ingest_parquet(spark, f"{base}/supplier.parquet"))
    return rows.where("s_acctbal > 0").select("s_suppkey", "s_name", "s_acctbal")


@query("s04_xml_scan", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def s04(spark, base):
    path = scratch_path(spark, "xml")
    part = lens.table(spark, base, "part").select("p_partkey", "p_name", "p_brand", "p_size", F.struct(
        F.col("p_retailprice").alias("price")).alias("inventory"))
    part.write.format("xml").option("rootTag", "catalog").option("rowTag", "product").save(path)
    return _ok(files.ingest_xml(spark, path, "product"))


@query("s05_delimited_scan", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def s05(spark, base):
    path = scratch_path(spark, "delimited")
    customers = lens.table(spark, base, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    customers.write.option("header", True).option("sep", "|").csv(path)
    return _ok(files.ingest_delimited(spark, path, "|", "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"))


@query("s07_api_responses", f"SELECT w, count(*) AS uses FROM ({WORD_ROWS}) GROUP BY 1")
def s07(spark, base):
    rows = _ok(files.ingest_api_responses(spark, _landed(spark, base, "items", [F.lit("ok").alias("status")])))
    return rows.groupBy("w").agg(F.count("*").alias("uses"))


@query("s08_paged_api", f"SELECT id, count(*) AS words FROM ({WORD_ROWS}) WHERE id % 8 + 1 <= 5 GROUP BY 1")
def s08(spark, base):
    path = _landed(spark, base, "results", partition="page")
    return _ok(files.ingest_paginated_api(spark, path)).groupBy("id").agg(F.count("*").alias("words"))


@query("s09_messy_upload", """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(1 + c_custkey % 5 AS DOUBLE) AS rating, c_name || ', ' || c_mktsegment AS review_text
FROM customer""")
def s09(spark, base):
    key = F.col("c_custkey")
    path = scratch_path(spark, "upload")
    upload = lens.table(spark, base, "customer").select(
        key.alias("Customer"), F.concat(F.lit("  "), (key % 5 + 1).cast("string")).alias("Stars"),
        F.concat("c_name", F.lit(", "), "c_mktsegment").alias("Comment"), F.lit("").alias("nothing"))
    (upload.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
     .option("ignoreLeadingWhiteSpace", False).option("emptyValue", "").csv(path))
    return standardize(files.load_uploaded_data(spark, path)).select("user_id", "rating", "review_text")


@query("s10_lake_read", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN (3, 4) AND o_totalprice >= 200000""")
def s10(spark, base):
    lake = _lake(spark)
    orders = lens.table(spark, base, "orders").withColumn("created_at", F.col("o_orderdate"))
    lake.write_dataset(orders, "orders", "processed", ["year", "month"])
    return lake.read_dataset("orders", "processed", ["o_orderkey", "o_custkey", "o_totalprice"], [
        ("year", "==", 1997), ("month", "in", [3, 4]), ("o_totalprice", ">=", 200000.0)])


@query("s11_store_lookup", """
SELECT 'lake' AS store, count(*) AS "rows" FROM supplier UNION ALL SELECT 'session', count(*) FROM customer WHERE c_acctbal > 1000""")
def s11(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.table(spark, base, "supplier"), "suppliers", "curated")
    lens.table(spark, base, "customer").createOrReplaceTempView("reviewlake_customers")
    found = lake.retrieve("suppliers").agg(F.count("*").alias("rows")).select(F.lit("lake").alias("store"), "rows")
    other = lake.retrieve("reviewlake_customers", ["c_custkey"], [("c_acctbal", ">", 1000.0)])
    return found.unionByName(other.agg(F.count("*").alias("rows")).select(F.lit("session").alias("store"), "rows"))


@query("s12_query_builder", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_totalprice < 50000""")
def s12(spark, base):
    return relational.read_with(lens.table(spark, base, "orders"), ["o_orderkey", "o_orderpriority"], [
        ("o_orderstatus", "!=", "F"), ("o_orderpriority", "in", ["1-URGENT", "2-HIGH"]), ("o_totalprice", "<", 50000.0)])


@query("s13_parameter_query", """
SELECT user_id, event_type, CAST(max(CAST(props->>'$.k' AS INTEGER)) AS INTEGER) AS top FROM events
WHERE value >= 25 AND event_type = 'purchase' GROUP BY 1, 2""")
def s13(spark, base):
    lens.table(spark, base, "events").createOrReplaceTempView("reviewlake_events")
    rows = query_data(spark, "SELECT user_id, event_type, props AS metadata FROM reviewlake_events "
                      "WHERE value >= :low AND event_type = :kind", {"low": 25, "kind": "purchase"}, {"metadata": "k int"})
    return rows.groupBy("user_id", "event_type").agg(F.max("metadata.k").alias("top"))


@query("s14_table_export", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50")
def s14(spark, base):
    lens.table(spark, base, "customer").createOrReplaceTempView("reviewlake_customers")
    return relational.read_with(spark.table("reviewlake_customers").orderBy("c_custkey"), ["c_custkey", "c_name"], limit=50)


@query("s15_extract_tables", """
SELECT 'customer' AS "table", least(count(*), 100) AS csv_rows, least(count(*), 100) AS json_rows FROM customer
UNION ALL SELECT 'supplier', least(count(*), 100), least(count(*), 100) FROM supplier""")
def s15(spark, base):
    path = scratch_path(spark, "extract")
    tables = {name: lens.table(spark, base, name) for name in ("customer", "supplier")}
    written = extract_tables(tables, path)
    parts = [spark.read.schema(TABLES[name]).option("header", True).csv(csv).agg(F.count("*").alias("csv_rows")).select(
        F.lit(name).alias("table"), "csv_rows",
        spark.read.schema(TABLES[name]).json(jsons).agg(F.count("*")).scalar().alias("json_rows"))
        for name, (csv, jsons) in written.items()]
    return relational.union_all(parts)


@query("s16_file_validation", """
SELECT 5 AS columns, count(*) AS "rows", count(*) FILTER (c_custkey % 100 = 7) AS bad_rows FROM customer""")
def s16(spark, base):
    path = scratch_path(spark, "files")
    bad = F.col("c_custkey") % 100 == 7
    rows = lens.table(spark, base, "customer").withColumn(
        "c_nationkey", F.when(bad, "unknown").otherwise(F.col("c_nationkey").cast("string")))
    rows.repartition(4, "c_custkey").write.option("header", True).csv(path)
    found = files.validate_files(spark, path, "csv", TABLES["customer"])
    return found.groupBy("columns").agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))


@query("s19_log_lines", """
SELECT CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level, event_type AS component, count(*) AS lines,
       count(DISTINCT user_id) FILTER (event_id % 2 = 0) AS users, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest
FROM events GROUP BY 1, 2""")
def s19(spark, base):
    path = scratch_path(spark, "logs")
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    line = F.concat(second("ts"), F.when(kind == "error", " [ERROR] ").otherwise(" [INFO] "), kind, F.lit(" - handled "), kind,
                    F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" | user_id="), user, F.lit(" request_id=r"), user))
                    .otherwise(F.lit("")))
    lens.table(spark, base, "events").select(line.alias("value")).write.text(path)
    return files.read_logs(spark, path).groupBy("level", "component").agg(
        F.count("*").alias("lines"), F.countDistinct("user_id").alias("users"), second(F.max("timestamp")).alias("latest"))


# Sinks --------------------------------------------------------------------------------------------


@query("k01_processed_parquet", "SELECT event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1")
def k01(spark, base):
    path = scratch_path(spark, "processed") + ".parquet"
    write_files(lens.table(spark, base, "events"), path)
    return spark.read.schema(TABLES["events"]).parquet(path).groupBy("event_type").agg(
        F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total"))


def _round_trip(spark, base, file_format, compression):
    lake = _lake(spark)
    events = lens.table(spark, base, "events").withColumn("created_at", F.col("ts"))
    lake.write_dataset(events, "events", "raw", ["year", "month", "day"], file_format, compression)
    rows = lake.read_dataset("events", "raw")
    return rows.groupBy("year", "month", "day").agg(
        F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total"), second(F.max("created_at")).alias("latest"))


PARTITIONS_SQL = """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  count(*) AS events, round(sum(value), 2) AS total, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM events GROUP BY 1, 2, 3"""


@query("k02_lake_parquet", PARTITIONS_SQL)
def k02(spark, base):
    return _round_trip(spark, base, "parquet", "snappy")


@query("k03_lake_json", PARTITIONS_SQL)
def k03(spark, base):
    return _round_trip(spark, base, "json", "gzip")


@query("k04_lake_csv", PARTITIONS_SQL)
def k04(spark, base):
    return _round_trip(spark, base, "csv", "none")


@query("k05_layered_write", """
SELECT 'appended' AS mode, count(*) * 2 AS "rows" FROM supplier UNION ALL SELECT 'replaced', count(*) FROM supplier WHERE s_acctbal > 0""")
def k05(spark, base):
    lake = _lake(spark)
    rows = lens.table(spark, base, "supplier")
    lake.write_dataset(rows, "suppliers", "processed")
    lake.write_dataset(rows, "suppliers", "processed")
    appended = lake.read_dataset("suppliers", "processed").agg(F.count("*").alias("rows"))
    lake.write_dataset(rows.where("s_acctbal > 0"), "suppliers", "curated", overwrite=True)
    replaced = lake.read_dataset("suppliers", "curated").agg(F.count("*").alias("rows"))
    return (appended.select(F.lit("appended").alias("mode"), "rows")
            .unionByName(replaced.select(F.lit("replaced").alias("mode"), "rows")))


UPSERT_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'shipped' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS total FROM orders"""


def _upserted(spark, base):
    lake = _lake(spark)
    orders = lens.table(spark, base, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
    lake.upsert(orders, "orders", ["o_orderkey"], batch=1)
    changed = orders.where("o_orderkey % 4 = 0").withColumns({"status": F.lit("shipped"), "total": F.col("total") + 1})
    lake.upsert(changed, "orders", ["o_orderkey"], batch=2)
    return lake


@query("k06_upsert", UPSERT_SQL)
def k06(spark, base):
    return _upserted(spark, base).latest("orders", ["o_orderkey"])


@query("k06_same_batch", """
SELECT o_custkey AS k, max(o_orderkey) AS last_order FROM orders GROUP BY 1""")
def k06_same_batch(spark, base):
    """Several rows of a key in one batch: the last one stays."""
    lake = _lake(spark)
    rows = lens.table(spark, base, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("last_order"))
    lake.upsert(rows.orderBy("last_order"), "customers", ["k"], batch=1)
    return lake.latest("customers", ["k"])


@query("k08_dataset_save", "SELECT lang, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS letters FROM documents GROUP BY 1")
def k08(spark, base):
    path = scratch_path(spark, "saved")
    write_files(lens.table(spark, base, "documents"), path)
    return spark.read.schema(TABLES["documents"]).parquet(path).groupBy("lang").agg(
        F.count("*").alias("documents"), F.sum(F.length("text").cast("bigint")).alias("letters"))


@query("k09_reviews_by_date", with_sql("texts") + """
SELECT CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month, CAST(day(created_at) AS INTEGER) AS day,
       count(*) AS reviews FROM texts GROUP BY 1, 2, 3""")
def k09(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.texts(spark, base), "reviews", "raw", ["year", "month", "day"])
    return lake.read_dataset("reviews", "raw").groupBy("year", "month", "day").agg(F.count("*").alias("reviews"))


@query("k10_exports", """
SELECT n_name, n_regionkey, 'csv' AS format FROM nation UNION ALL SELECT n_name, n_regionkey, 'json' FROM nation""")
def k10(spark, base):
    nation = lens.table(spark, base, "nation").select("n_name", "n_regionkey")
    parts = []
    for file_format in ("csv", "json"):
        path = export(nation, scratch_path(spark, file_format), file_format)
        reader = spark.read.schema("n_name string, n_regionkey int").option("header", True)
        parts.append(reader.format(file_format).load(path).withColumn("format", F.lit(file_format)))
    return relational.union_all(parts)


@query("k11_job_log", """
SELECT status, CAST(count(*) * 2 AS BIGINT) AS jobs FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'failed' END AS status
FROM orders) GROUP BY 1""")
def k11(spark, base):
    path = scratch_path(spark, "job-log")
    rows = lens.table(spark, base, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"))
    append_job_log(spark, rows, path)
    append_job_log(spark, rows, path)
    return spark.read.schema("job_id string, status string").parquet(path).groupBy("status").agg(F.count("*").alias("jobs"))


# Lake management ----------------------------------------------------------------------------------


@query("l01_catalog", """
SELECT 'orders' AS dataset, 'processed' AS layer, count(*) AS row_count, 1.0::DOUBLE AS quality_score FROM orders
UNION ALL SELECT 'suppliers', 'raw', count(*) * 2, 1.0 FROM supplier""")
def l01(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.table(spark, base, "orders"), "orders", "processed")
    for _ in range(2):
        lake.write_dataset(lens.table(spark, base, "supplier"), "suppliers", "raw")
    return lake.catalog().select("dataset", "layer", "row_count", "quality_score")


@query("l02_list_datasets", """
SELECT 'suppliers' AS dataset, 'parquet' AS format, count(*) AS row_count FROM supplier""")
def l02(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.table(spark, base, "customer"), "customers", "raw")
    lake.write_dataset(lens.table(spark, base, "supplier"), "suppliers", "curated")
    return lake.list_datasets("curated").select("dataset", "format", "row_count")


@query("l04_compaction", UPSERT_SQL)
def l04(spark, base):
    lake = _upserted(spark, base)
    lake.optimize_dataset("orders", "processed", ["o_orderkey"])
    return lake.read_dataset("orders", "processed").drop("_batch", "_row")


@query("l07_retention", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def l07(spark, base):
    return retained(lens.table(spark, base, "events"), "ts", 7, F.lit("2024-01-31").cast("timestamp")).select("event_id")


@query("l07_archive_old", """SELECT 'archive' AS layer, count(*) AS row_count FROM supplier""")
def l07_archive(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.table(spark, base, "supplier"), "suppliers", "processed")
    lake.cleanup_old_data(30, F.current_timestamp() + F.expr("interval 60 days"))
    return lake.catalog().select("layer", "row_count")


@query("l08_migration", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def l08(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.table(spark, base, "customer"), "customers", "raw", file_format="json")
    lake.copy_dataset("customers", "raw", "curated")
    return lake.read_dataset("customers", "curated").groupBy("c_mktsegment").agg(F.count("*").alias("customers"))


@query("l09_backup", "SELECT 'customers_20240131' AS dataset, 'gzip' AS compression, count(*) AS row_count FROM customer")
def l09(spark, base):
    lake = _lake(spark)
    lake.write_dataset(lens.table(spark, base, "customer"), "customers", "processed")
    lake.backup("customers", "processed", "20240131")
    return lake.list_datasets("archive").select("dataset", "compression", "row_count")


# Documents ----------------------------------------------------------------------------------------


@query("d01_insert_documents", "SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS created_at FROM events")
def d01(spark, base):
    lake = _lake(spark)
    docs = lens.table(spark, base, "events").select("event_id", F.struct("event_type", "value").alias("body"),
                                                    F.date_format("ts", "yyyy-MM-dd").alias("created_at"))
    lake.write_dataset(documents.convert_datetimes(docs), "events", "raw")
    return lake.read_dataset("events", "raw").select("event_id", day("created_at").alias("created_at"))


@query("d02_update_documents", """
SELECT event_id, CASE WHEN value > 100 THEN 'large' ELSE event_type END AS event_type,
       CASE WHEN value > 100 THEN value * 2 ELSE value END AS value FROM events""")
def d02(spark, base):
    events = lens.table(spark, base, "events").select("event_id", "event_type", "value")
    return documents.update_documents(events, F.col("value") > 100, {
        "event_type": F.lit("large"), "value": F.col("value") * 2})


@query("d03_delete_documents", "SELECT event_id FROM events WHERE NOT (event_type = 'error' OR value < 5)")
def d03(spark, base):
    events = lens.table(spark, base, "events")
    return documents.delete_documents(events, (F.col("event_type") == "error") | (F.col("value") < 5)).select("event_id")


@query("d04_collection_stats")
def d04(spark, base):
    return rounded(documents.collection_stats(lens.table(spark, base, "events")), "average_document_size", digits=4)


@query("d04_customer_stats", """
SELECT count(*) AS document_count, CAST(sum(size) AS BIGINT) AS size_bytes, round(avg(size), 4) AS average_document_size
FROM (SELECT strlen(CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_mktsegment': c_mktsegment}) AS VARCHAR)) AS size FROM customer)""")
def d04_customers(spark, base):
    rows = lens.table(spark, base, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return rounded(documents.collection_stats(rows), "average_document_size", digits=4)


@query("d05_unique_violations", "SELECT user_id, event_type, count(*) AS documents FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def d05(spark, base):
    return documents.unique_violations(lens.table(spark, base, "events"), ["user_id", "event_type"])


@query("d06_schema_validation", with_sql("dirty") + """
SELECT coalesce(review_id IS NOT NULL AND user_id IS NOT NULL AND rating BETWEEN 1 AND 5 AND created_at IS NOT NULL
       AND length(user_email) > 0, false) AS valid, count(*) AS documents FROM dirty GROUP BY 1""")
def d06(spark, base):
    docs = _dirty(spark, base).withColumnRenamed("created_at", "review_date")
    return (docs.groupBy(documents.validity(docs, documents.SCHEMAS["reviews"]).alias("valid"))
            .agg(F.count("*").alias("documents")))


@query("x17_live_documents", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 7 DAY AND event_type = 'purchase'")
def x17(spark, base):
    live = documents.alive(lens.table(spark, base, "events"), "ts", documents.TTL_SECONDS["real_time_events"],
                           F.lit("2024-01-30").cast("timestamp"))
    return live.where("event_type = 'purchase'").select("event_id")


# Warehouse ----------------------------------------------------------------------------------------


@query("n01_dim_products", """
SELECT md5(CAST(p_partkey AS VARCHAR)) AS product_key, p_partkey AS product_id, p_name AS name, p_type AS category FROM part""")
def n01_products(spark, base):
    products = lens.table(spark, base, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"))
    return warehouse.dimension(products, "product_id", ["name", "category"], "product")


@query("n01_dim_users", "SELECT md5(CAST(c_custkey AS VARCHAR)) AS user_key, c_custkey AS user_id, c_mktsegment AS segment FROM customer")
def n01_users(spark, base):
    users = lens.table(spark, base, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return warehouse.dimension(users, "user_id", ["segment"], "user")


@query("n01_dim_categories", "SELECT DISTINCT md5(p_type) AS category_key, p_type AS category, 'product' AS kind FROM part")
def n01_categories(spark, base):
    kinds = lens.table(spark, base, "part").select(F.col("p_type").alias("category"), F.lit("product").alias("kind"))
    return warehouse.dimension(kinds, "category", ["kind"], "category")


@query("n01_dim_date", with_sql("product_ratings") + """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT unnest(generate_series(min(created_at), max(created_at), INTERVAL 1 DAY)) AS d FROM product_ratings)""")
def n01_date(spark, base):
    return warehouse.date_dimension(lens.product_ratings(spark, base)).withColumn("date", day("date"))


@query("n01_fact_reviews", with_sql("ratings") + """
SELECT md5(CAST(product_id AS VARCHAR)) AS product_key, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
       count(DISTINCT md5(CAST(user_id AS VARCHAR))) AS users, CAST(sum(rating) AS BIGINT) AS rating FROM ratings GROUP BY 1, 2""")
def n01_facts(spark, base):
    facts = warehouse.review_facts(lens.ratings(spark, base), ["rating"])
    return facts.groupBy("product_key", "date_key").agg(F.countDistinct("user_key").alias("users"), F.sum("rating").alias("rating"))


@query("n02_length_buckets", """
SELECT CASE WHEN n <= 0 THEN NULL WHEN n <= 50 THEN '0-50' WHEN n <= 150 THEN '50-150' WHEN n <= 500 THEN '150-500'
            WHEN n <= 1000 THEN '500-1000' ELSE '1000+' END AS bucket, count(*) AS reviews
FROM (SELECT length(text) AS n FROM documents) GROUP BY 1""")
def n02(spark, base):
    return (lens.docs(spark, base).groupBy(warehouse.length_bucket(F.col("review_text")).alias("bucket"))
            .agg(F.count("*").alias("reviews")))


@query("n05_alerts", """
SELECT 'data_freshness_hours' AS alert, round(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') / 3600000000.0, 6) AS value,
       6.0::DOUBLE AS threshold, date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') / 3600000000.0 > 6 AS raised FROM events
UNION ALL SELECT 'error_rate_percent', round(avg(CAST(event_type = 'error' AS INTEGER)) * 100, 6), 5.0,
       avg(CAST(event_type = 'error' AS INTEGER)) * 100 > 5 FROM events""")
def n05(spark, base):
    found = warehouse.alerts(lens.table(spark, base, "events"), F.lit("2024-02-01").cast("timestamp"), "ts",
                             F.col("event_type") == "error")
    return rounded(found, "value", digits=6)


@query("n06_privacy", """
SELECT c_custkey, sha256(c_name) AS pseudonym, 'C***@example.com' AS email, regexp_replace(regexp_replace(c_name, '[a-z]', 'x', 'g'),
       '[0-9]', 'n', 'g') AS shape FROM (SELECT c_custkey, c_name FROM customer)""")
def n06(spark, base):
    mail = F.concat("c_name", F.lit("@example.com"))
    return lens.table(spark, base, "customer").select(
        "c_custkey", warehouse.anonymize(F.col("c_name")).alias("pseudonym"), warehouse.mask_email(mail).alias("email"),
        F.replace(warehouse.mask_letters_digits(F.col("c_name")), F.lit("X"), F.lit("C")).alias("shape"))


@query("n06_mask_text", r"""
SELECT doc_id AS review_id, regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[email]', 'g') AS masked
FROM documents WHERE contains(text, '@')""")
def n06_text(spark, base):
    held = lens.docs(spark, base).where(F.contains("review_text", F.lit("@")))
    return held.select("review_id", warehouse.mask_text_emails(F.col("review_text")).alias("masked"))


@query("n07_spam_removal", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(toxic, 0) <> 1")
def n07(spark, base):
    labels = lens.table(spark, base, "labels").select("doc_id", (F.col("toxic") == 1).alias("is_spam"))
    rows = lens.table(spark, base, "documents").select("doc_id").join(labels, "doc_id", "left")
    return warehouse.without_spam(rows).select("doc_id")


def _period_sql(period: str) -> str:
    return with_sql("product_ratings") + f"""
SELECT strftime(date_trunc('{period}', created_at), '%Y-%m-%d') AS {period}, count(*) AS total_reviews,
       round(avg(rating), 8) AS average_rating, round(avg(sentiment_score), 8) AS average_sentiment,
       count(DISTINCT product_id) AS products FROM product_ratings GROUP BY 1"""


@query("n08_weekly_trends", _period_sql("week"))
def n08_week(spark, base):
    found = warehouse.period_trends(lens.product_ratings(spark, base), "week").withColumn("week", day("week"))
    return rounded(found, "average_rating", "average_sentiment")


@query("n08_monthly_insights", _period_sql("month"))
def n08_month(spark, base):
    found = warehouse.period_trends(lens.product_ratings(spark, base), "month").withColumn("month", day("month"))
    return rounded(found, "average_rating", "average_sentiment")


@query("n08_top_rated", with_sql("product_ratings") + """
SELECT product_id, round(avg(rating), 8) AS average_rating, count(*) AS total_reviews FROM product_ratings GROUP BY 1
HAVING count(*) >= 5 ORDER BY avg(rating) DESC, count(*) DESC, product_id LIMIT 10""")
def n08_top(spark, base):
    return rounded(warehouse.top_rated_products(lens.product_ratings(spark, base)), "average_rating")


@query("n08_seasonality", with_sql("product_ratings") + """
SELECT CAST(month(created_at) AS INTEGER) AS month, count(*) AS total_reviews, round(avg(rating), 8) AS average_rating,
       round(count(*) / CAST((SELECT count(*) FROM product_ratings) AS DOUBLE), 8) AS share FROM product_ratings GROUP BY 1""")
def n08_seasons(spark, base):
    return rounded(warehouse.seasonality(lens.product_ratings(spark, base)), "average_rating", "share")


@query("n09_change_capture", """
WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 3),
a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders
      WHERE o_orderkey % 11 <> 4)
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'insert'
  WHEN a.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change, a.o_orderstatus, a.o_totalprice
FROM b FULL JOIN a ON b.o_orderkey = a.o_orderkey
WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""")
def n09(spark, base):
    key = F.col("o_orderkey")
    orders = lens.table(spark, base, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    before = orders.where(key % 10 != 3)
    after = orders.where(key % 11 != 4).withColumn(
        "o_orderstatus", F.when(key % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return relational.snapshot_diff(before, after, "o_orderkey")


# Whole runs ---------------------------------------------------------------------------------------

TRANSFORMED = with_sql("dirty") + f"""
, clean AS (SELECT row_key AS doc_id, user_id, product_id, created_at, coalesce(rating, (SELECT median(rating) FROM
  (SELECT * FROM dirty WHERE review_text IS NOT NULL))) AS rating,
  nullif(regexp_replace(regexp_replace(regexp_replace(review_text, '^[{WS}]+|[{WS}]+$', '', 'g'), '[{WS}]+', ' ', 'g'),
         '[^\\p{{L}}\\p{{N}}_{WS}.,!?-]', '', 'g'), '') AS text FROM dirty),
cleaned AS (SELECT doc_id AS id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')),
  '(http|www)[^{WS}]+', '', 'g'), '[^{WS}]+@[^{WS}]+', '', 'g'), '[^a-z0-9{WS}.!?,;:]', '', 'g'), '[{WS}]+', ' ', 'g')) AS c FROM clean),
{compound_sql(FREQUENT)}
SELECT k.doc_id AS row_key, CAST(rating AS DOUBLE) AS rating,
       CASE WHEN length(coalesce(text, '')) < 5 THEN 0 ELSE score END AS sentiment_score,
       CASE WHEN length(coalesce(text, '')) < 5 THEN 'neutral' ELSE {LABELS} END AS sentiment_label,
       CAST(len({words_sql('text')}) AS INTEGER) AS word_count, CAST(year(created_at) AS INTEGER) AS year
FROM clean k JOIN scored s ON k.doc_id = s.id"""


def _config():
    return transform.TransformConfig(
        order=["row_key"], lexicon=FREQUENT, as_of=F.lit("2024-02-01").cast("timestamp"),
        features=FeatureConfig())


@query("z01_transform_dataset", TRANSFORMED)
def z01(spark, base):
    result = transform.transform_dataset(_dirty(spark, base), "reviews", scratch_path(spark, "transformed"), _config())
    if not result.success:
        raise RuntimeError(result.error)
    return result.data.select("row_key", F.col("rating").cast("double").alias("rating"), "sentiment_score",
                              "sentiment_label", F.coalesce("word_count", F.lit(None)).alias("word_count"), "year")


@query("z02_review_cleaning", with_sql("dirty") + """
SELECT count(*) AS "rows", round(avg(r), 8) AS mean_rating, count(*) FILTER (e = lower(e)) AS lower_emails FROM (
  SELECT CAST(coalesce(rating, (SELECT median(rating) FROM dirty)) AS DOUBLE) AS r, lower(trim(user_email)) AS e FROM dirty)""")
def z02(spark, base):
    cleaned = transform.clean_reviews(_dirty(spark, base), transform.TransformConfig())
    return cleaned.agg(F.count("*").alias("rows"), F.round(F.avg("rating"), 8).alias("mean_rating"),
                       F.count_if(F.col("user_email") == F.lower("user_email")).alias("lower_emails"))


@query("z03_many_datasets", with_sql("dirty") + """
SELECT count(*) AS "rows", true AS first_succeeded, false AS second_succeeded FROM dirty""")
def z03(spark, base):
    config = _config()
    config.enable_sentiment_analysis = config.enable_feature_engineering = False
    # A median of text is refused.
    broken = lens.docs(spark, base).select(F.when(F.col("language") != "en", F.col("language")).alias("rating"))
    found = transform.transform_datasets({"dirty": _dirty(spark, base), "broken": broken}, None, config)
    rows = found["dirty"].data.agg(F.count("*").alias("rows"))
    return rows.select("rows", F.lit(found["dirty"].success).alias("first_succeeded"),
                       F.lit(found["broken"].success).alias("second_succeeded"))


@query("z04_ingestion_jobs", """
SELECT 'csv' AS format_type, 'completed' AS status, count(*) AS records_processed FROM orders
UNION ALL SELECT 'parquet', 'completed', count(*) FROM supplier UNION ALL SELECT 'excel', 'failed', 0""")
def z04(spark, base):
    source, target = scratch_path(spark, "orders"), scratch_path(spark, "ingested")
    export(lens.table(spark, base, "orders"), source, "csv")
    jobs = [transform.Job("file", source, f"{target}/orders", "csv", {"schema": TABLES["orders"]}),
            transform.Job("file", f"{base}/supplier.parquet", f"{target}/suppliers", "parquet"),
            transform.Job("file", source, f"{target}/orders", "excel")]
    log = transform.execute_all_jobs(spark, jobs, {"check_duplicates": True}, f"{target}/log")
    return log.select("format_type", "status", "records_processed")


@query("z04_side_by_side", """
SELECT CAST(c_nationkey % 6 AS INTEGER) AS part, 'completed' AS status, count(*) AS records FROM customer GROUP BY 1
UNION ALL SELECT -1, 'failed', 0""")
def z04_side_by_side(spark, base):
    """Six jobs and one without a source, three at a time; each part is read back from what its job wrote."""
    source, target = scratch_path(spark, "customers"), scratch_path(spark, "ingested")
    lens.table(spark, base, "customer").withColumn("part", (F.col("c_nationkey") % 6).cast("int")).write.partitionBy("part").parquet(source)
    jobs = [transform.Job("file", f"{source}/part={part}", f"{target}/{part}", "parquet", job_id=str(part)) for part in range(6)]
    jobs.append(transform.Job("file", f"{source}/none", f"{target}/none", "parquet", job_id="-1"))
    log = transform.execute_all_jobs(spark, jobs, workers=3)
    return log.select(F.col("job_id").cast("int").alias("part"), "status", F.col("records_processed").cast("bigint").alias("records"))
