"""Readers: CSV, delimited, JSON, XML, Parquet, logs, database tables, API responses, messy uploads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from reviewlake.operators import relational
from reviewlake.session import materialize, scratch_path
from reviewlake.sources import ranges

Outcome = tuple[DataFrame | None, list[str]]


def attempt(read: Callable[[], DataFrame], what: str) -> Outcome:
    """The frame and no messages, or no frame and the reason."""
    try:
        return read(), []
    except Exception as error:  # noqa: BLE001 - unreadable input is an answer
        return None, [f"Error reading {what}: {str(error).splitlines()[0]}"]


def ingest_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> Outcome:
    """CSV with header; types are inferred unless a schema is given."""
    return ingest_delimited(spark, path, ",", schema)


def ingest_delimited(spark: SparkSession, path: str, delimiter: str = "|",
                     schema: StructType | str | None = None) -> Outcome:
    """Delimited text with header."""
    reader = (spark.read.option("header", True).option("sep", delimiter)
              .option("multiLine", False).option("escape", '"'))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return attempt(lambda: reader.csv(path), f"delimited file {path}")


def ingest_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> Outcome:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return attempt(lambda: reader.parquet(path), f"Parquet file {path}")


def _base(spark: SparkSession, path: str) -> str | None:
    """The folder that columns of folder names are counted from; none for a single file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return path if system.exists(place) and system.getFileStatus(place).isDirectory() else None


def _text(spark: SparkSession, names: Sequence[str], base: str | None, whole: bool) -> DataFrame:
    """(value, file, folder) of the lines of files, or of whole files."""
    reader = spark.read if base is None else spark.read.option("basePath", base)
    text = reader.text([ranges.path_of(name) for name in names], wholetext=whole)
    return text.select(F.trim("value", F.lit(" \t\r\n\ufeff")).alias("value"), F.col("_metadata.file_path").alias("file"),
                       ranges.folder_of(text).alias("folder")).where("value <> ''")


def _records(spark: SparkSession, path: str, choose: Callable[[DataFrame, DataFrame], DataFrame], glob: str | None = None) -> DataFrame:
    """(value, folder): the text of each record.

    Files of lines give their lines. Any other file is one document: a top-level list gives its elements, an object
    those of the list that `choose` finds, from (file, nth) of all elements and (file, text) outside of lists, as
    (file, nth); a document without one is a record as a whole. Lists are cut range by range (see `ranges`), whatever
    the size of the file. What is broken outside of a list is one more record, which no reader takes for JSON.
    """
    found, base = ranges.json_files(spark, path, glob), _base(spark, path)
    parts = [_text(spark, found.lines, base, False).select("value", "folder")] if found.lines else []
    if found.documents:
        elements, outside = ranges.json_elements(spark, found, base)
        lists = outside.where(F.startswith("text", F.lit("["))).select("file", F.lit(1).cast("bigint").alias("nth"))
        chosen = materialize(lists.unionAll(choose(elements, outside.where(~F.startswith("text", F.lit("["))))), "chosen")
        parts.append(elements.join(chosen, ["file", "nth"]).select(F.col("text").alias("value"), "folder"))
        broken = outside.join(chosen, "file", "left_semi").where(F.try_parse_json("text").isNull())
        folders = elements.select("folder").limit(0)
        parts.append(broken.select(F.col("text").alias("value"), F.lit(None).cast(folders.schema["folder"].dataType).alias("folder")))
        whole = [row["file"] for row in outside.join(chosen, "file", "left_anti").select("file").collect()]
        if whole:
            parts.append(_text(spark, whole, base, True).select("value", "folder"))
    return relational.union_all(parts) if parts else spark.createDataFrame([], "value string, folder struct<_none:int>")


def _read_records(records: DataFrame, schema: StructType | str | None = None) -> DataFrame:
    """Records as rows, by Spark's JSON reader over one record a line; a record that is no object has a column `value`.

    Records that are no JSON come back in `_corrupt_record`.
    """
    spark, value = records.sparkSession, F.col("value")
    line = (F.when(F.startswith("value", F.lit("{")) | F.try_parse_json("value").isNull(), value)
            .otherwise(F.concat(F.lit('{"value": '), value, F.lit("}"))))
    path = scratch_path(spark, "records")
    records.select(F.translate(line, "\r\n", "  ").alias("value")).write.text(path)
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def _first_filled(elements: DataFrame, outside: DataFrame) -> DataFrame:
    """The first list with an element."""
    return elements.join(outside, "file", "left_semi").groupBy("file").agg(F.min("nth").alias("nth"))


def ingest_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> Outcome:
    """Each document for itself: a top-level list gives its elements, an object its first non-empty list, anything
    else one row. The lines of a JSON lines file are rows. Bad lines and elements stand in `_corrupt_record`."""
    return attempt(lambda: _read_records(_records(spark, path, _first_filled), schema), f"JSON file {path}")


def ingest_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> Outcome:
    """One JSON object per line: the splittable form for large data."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return attempt(lambda: reader.json(path), f"JSON lines {path}")


def ingest_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None,
               flatten: bool = True) -> Outcome:
    """Children of the root as rows. `flatten` keeps only the leaf elements, as text."""
    def read() -> DataFrame:
        reader = spark.read.option("rowTag", row_tag)
        if schema is not None:
            reader = reader.schema(schema)
        elif flatten:
            reader = reader.option("inferSchema", False)
        df = reader.xml(path)
        if not flatten:
            return df
        leaves = [field.name for field in df.schema.fields
                  if not isinstance(field.dataType, (StructType, ArrayType)) and not field.name.startswith("_")]
        return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in leaves])
    return attempt(read, f"XML file {path}")


# Keys of an API response that hold the records.
RECORD_KEYS = ("data", "results", "items", "records")


def _known_list(names: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The list under the first of the names that holds one, an empty one too."""
    def choose(elements: DataFrame, outside: DataFrame) -> DataFrame:
        fields = F.try_variant_get(F.try_parse_json("text"), "$", "map<string,variant>")
        # lists are empty here, and stand in the order that elements count them by
        lists = F.filter(F.json_object_keys("text"), lambda key: F.startswith(F.schema_of_variant(F.element_at(fields, key)), F.lit("ARRAY")))
        nth = F.coalesce(*[F.nullif(F.array_position(lists, name), F.lit(0)) for name in names])
        return outside.select("file", nth.cast("bigint").alias("nth")).where("nth IS NOT NULL")
    return choose


def ingest_api_responses(spark: SparkSession, path: str, keys: Sequence[str] = RECORD_KEYS,
                         glob: str | None = None) -> Outcome:
    """Landed API responses, each for itself: a list as it is, else the first known key holding a list, else one row."""
    return attempt(lambda: _read_records(_records(spark, path, _known_list(keys), glob)), f"API responses {path}")


def ingest_paginated_api(spark: SparkSession, path: str, page_param: str = "page", max_pages: int | None = None,
                         keys: Sequence[str] = RECORD_KEYS) -> Outcome:
    """Landed pages in folders `<page_param>=N`: pages 1, 2, ... before the first empty or missing one.

    `max_pages` ends the reading earlier; a message then says how many pages were left.
    """
    told: list[str] = []

    def read() -> DataFrame:
        records = _records(spark, path, _known_list(keys))
        records = records.select("value", F.col("folder").getField(page_param).cast("int").alias("_page"))
        filled = records.where("_page > 0").select("_page").distinct()
        # the first page that does not follow its predecessor ends them; one row for each page
        order = Window.orderBy("_page")
        last = filled.select("_page", F.row_number().over(order).alias("nth")).where("_page = nth").agg(
            F.max("_page")).first()[0] or 0
        kept = min(last, max_pages) if max_pages is not None else last
        if kept < last:
            told.append(f"{last - kept} of {last} pages were not read")
        return _read_records(records.where(F.col("_page").between(1, kept)))
    frame, errors = attempt(read, f"pages {path}")
    return frame, errors + told


def ingest_database(spark: SparkSession, url: str, tables: Sequence[str] | None = None, catalog: str | None = None,
                    partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
                    **options: str) -> tuple[dict[str, DataFrame], list[str]]:
    """One table, several, or every table `catalog` (a query with column `name`) lists, with errors per table.

    `partitioning` maps a table to (column, lower, upper, partitions) for parallel reads.
    """
    def source(**more: str) -> DataFrame:
        return spark.read.format("jdbc").option("url", url).options(**options, **more).load()

    if tables is None:
        if catalog is None:
            raise ValueError("name the tables or the catalog query")
        tables = [row[0] for row in source(query=catalog).collect()]
    frames: dict[str, DataFrame] = {}
    errors: list[str] = []
    for table in tables:
        more: dict[str, str] = {"dbtable": table}
        if partitioning and table in partitioning:
            column, low, high, parts = partitioning[table]
            more |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                     "numPartitions": str(parts)}
        frame, problems = attempt(lambda: source(**more), f"table {table}")
        errors += problems
        if frame is not None:
            frames[table] = frame
    return frames, errors


# Messy uploads ------------------------------------------------------------------------------------

# Separators tried on an upload, in the order that decides between equal ones.
DELIMITERS = (",", "\t", ";", "|", ":", " ")
EXTENSIONS = (".csv", ".tsv", ".txt")


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(file, encoding, first): judged over all bytes of each file, in one distributed pass.

    A byte order mark or zero bytes tell UTF-16; a file of valid UTF-8 is that; any other is ISO-8859-1. first is the
    first line with content, one character a byte.
    """
    raw = (spark.read.option("encoding", "ISO-8859-1").option("sep", "\x01").option("quote", "\x02").schema("line string")
           .csv(path).select("line", F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")))
    data = F.encode("line", "ISO-8859-1")
    zero = F.lit("\0")
    facts = raw.groupBy("file").agg(
        F.bool_and(F.is_valid_utf8(data.cast("string"))).alias("utf8"),
        F.bool_or(F.startswith("line", F.lit("\u00ff\u00fe")) | F.startswith("line", F.lit("\u00fe\u00ff"))).alias("marked"),
        F.bool_or(F.contains("line", zero)).alias("zeros"),
        F.sum(F.when(F.substring("line", 1, 1) == zero, 1).otherwise(0)).alias("zero_first"),
        F.count(F.lit(1)).alias("lines"),
        F.min_by("line", F.when((F.col("start") == 0) & (F.trim("line") != ""), F.col("at"))).alias("first"))
    encoding = (F.when(F.col("marked"), "UTF-16").when(F.col("zeros") & (F.col("zero_first") * 2 > F.col("lines")), "UTF-16BE")
                .when(F.col("zeros"), "UTF-16LE").when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1"))
    return facts.select("file", encoding.alias("encoding"), "first").where(F.col("first").isNotNull())


def best_delimiter(lines: DataFrame, delimiters: Sequence[str] = DELIMITERS) -> str | None:
    """The separator whose usual number in a line, times the share of lines that have this number, is largest."""
    tried = F.explode(F.array(*[F.struct(F.lit(at).alias("at"), F.regexp_count("line", F.lit(f"\\Q{one}\\E")).alias("uses"))
                                for at, one in enumerate(delimiters)])).alias("t")
    counts = lines.select(tried).groupBy("t.at", "t.uses").agg(F.count(F.lit(1)).alias("n"))
    usual = counts.groupBy("at").agg(F.max_by("uses", F.struct("n", "uses")).alias("uses"), F.max("n").alias("n"),
                                     F.sum("n").alias("all"))
    best = usual.where("uses > 0").select("at", (F.col("uses") * F.col("n") / F.col("all")).alias("score")).orderBy(
        F.desc("score"), "at").first()
    return None if best is None else delimiters[best["at"]]


def looks_like_header(cells: Sequence[str]) -> bool:
    """No cell is a number."""
    return all(not cell.replace(".", "").replace("-", "").isdigit() for cell in cells)


def load_uploaded_data(spark: SparkSession, path: str, min_filled: float = 0.1, count_cells: bool = False) -> DataFrame:
    """Delimited upload of unknown encoding and separator; rows and columns without content are dropped.

    Every file is judged by all of its bytes, the separator by all lines. The first line of a file is left out if it
    looks like a header, and names the columns of that file; files with other headers are joined by name, and those
    without one take the names of the only header there is. A quoted cell may hold separators and line ends. Short rows
    are padded. `count_cells` adds `_cells`, by which rows of an odd width can be told.
    """
    lower = path.rstrip("/").lower()
    if not lower.endswith(EXTENSIONS) and "." in lower.rsplit("/", 1)[-1]:
        raise ValueError(f"unsupported file format: {path}")
    facts = file_facts(spark, path).orderBy("file").collect()  # one row for each file, as in Spark's own listing
    if not facts:
        raise ValueError(f"no content in {path}")
    order = ("\t", ",", ";", "|") if lower.endswith(".tsv") else DELIMITERS
    groups: dict[tuple[str, str | None], list[str]] = {}
    delimiter = best_delimiter(relational.union_all([
        _lines(spark, [fact["file"] for fact in facts if fact["encoding"] == encoding], encoding)
        for encoding in sorted({fact["encoding"] for fact in facts})]), order)
    if delimiter is None:
        raise ValueError(f"no separator found in {path}")
    for fact in facts:
        first = _tidy(fact["first"].encode("latin-1", "replace").decode(fact["encoding"], "ignore"))
        header = first if looks_like_header(ranges.cut_cells(first, delimiter)) else None
        groups.setdefault((fact["encoding"], header), []).append(fact["file"])
    headers = {header for _, header in groups if header is not None}
    usual = headers.pop() if len(headers) == 1 else None  # names the columns of files without a header, too
    tables = [split_cells(ranges.delimited_cells(spark, names, delimiter, encoding, header is not None),
                          ranges.cut_cells(header or usual, delimiter) if header or usual else [])
              for (encoding, header), names in groups.items()]
    table = tables[0]
    for other in tables[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    return _filled(table, min_filled, count_cells)


def _tidy(line: str) -> str:
    return line.replace("\ufeff", "").strip(" \r\n\0")


def _lines(spark: SparkSession, names: Sequence[str], encoding: str) -> DataFrame:
    """Lines with content of files of one encoding."""
    wide = encoding.startswith("UTF-16")  # line ends are not single bytes: read file by file
    return (spark.read.option("encoding", encoding).option("sep", "\x01").option("quote", "\x02").option("multiLine", wide)
            .schema("line string").csv([ranges.path_of(name) for name in names])
            .select(F.trim(F.regexp_replace("line", "[\ufeff\r]", "")).alias("line")).where(F.col("line") != ""))


def split_cells(found: DataFrame, header: Sequence[str]) -> DataFrame:
    """Cells to columns named by the header, others by their place; `_cells` is the number of a row's cells."""
    stored = materialize(found, "cells")
    widest = max(len(header), stored.agg(F.max(F.size("cells"))).first()[0] or 0)
    names, seen = [], set()
    for at in range(widest):
        name = header[at] if at < len(header) and header[at] else f"Column_{at + 1}"
        names.append(name if name.lower() not in seen else f"{name}_{at + 1}")
        seen.add(names[-1].lower())
    return stored.select(F.size("cells").alias("_cells"), *[F.nullif(F.get("cells", F.lit(at)), F.lit("")).alias(name)
                                                            for at, name in enumerate(names)])


def _filled(table: DataFrame, min_filled: float, count_cells: bool) -> DataFrame:
    """Without columns and rows that have no content."""
    names = [name for name in table.columns if name != "_cells"]
    quoted = {name: F.col("`" + name.replace("`", "``") + "`") for name in names}
    counts = table.agg(F.count("*").alias("rows"), *[F.count(quoted[name]).alias(f"n{at}") for at, name in enumerate(names)]).first()
    kept = [name for at, name in enumerate(names) if counts[f"n{at}"] > 0]
    if not kept or sum(counts[f"n{at}"] for at in range(len(names))) <= min_filled * counts["rows"] * len(names):
        raise ValueError("hardly any cell has content")
    some = F.coalesce(*[quoted[name] for name in kept]).isNotNull()
    return table.where(some).select(*[quoted[name] for name in kept], *(["_cells"] if count_cells else []))


# Validation summaries and logs --------------------------------------------------------------------


def validate_files(spark: SparkSession, path: str, file_format: str, ddl: str) -> DataFrame:
    """(file, rows, bad_rows, columns, size_mb, status) per file of a folder."""
    schema = StructType.fromDDL(ddl)
    corrupt = "_corrupt_record"
    full = StructType([*schema.fields, StructField(corrupt, StringType())])
    reader = spark.read.schema(full).option("columnNameOfCorruptRecord", corrupt).option("mode", "PERMISSIVE")
    if file_format == "csv":
        reader = reader.option("header", True)
    df = reader.format(file_format).load(path)
    # The number of filled cells makes Spark parse whole lines, which finds the bad ones.
    filled = F.size(F.array_compact(F.array(*[F.col(name).cast("string") for name in schema.names])))
    per_file = df.select(corrupt, filled.alias("filled"), F.col("_metadata.file_name").alias("file"),
                         F.col("_metadata.file_size").alias("size")).groupBy("file").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(corrupt).isNotNull() & (F.col("filled") >= 0)).alias("bad_rows"), F.max("size").alias("size"))
    return per_file.select("file", "rows", "bad_rows", F.lit(len(schema.fields)).alias("columns"),
                           (F.col("size") / (1024 * 1024)).alias("size_mb"),
                           F.when(F.col("bad_rows") > 0, "error").otherwise("valid").alias("status"))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """`ts [LEVEL] Component - message | user_id=... request_id=...` lines as a table."""
    line = F.col("value")
    pattern = r"^(\S+ \S+) \[(\w+)\] (.+?) - (.*?)(?: \| (.*))?$"

    def part(at: int) -> Column:
        return F.nullif(F.regexp_extract(line, pattern, at), F.lit(""))

    def tag(name: str) -> Column:
        return F.nullif(F.regexp_extract(part(5), rf"{name}=(\S+)", 1), F.lit(""))

    return spark.read.text(path).select(
        F.try_to_timestamp(part(1)).alias("timestamp"), part(2).alias("level"), part(3).alias("component"),
        part(4).alias("message"), tag("user_id").alias("user_id"), tag("request_id").alias("request_id"))
