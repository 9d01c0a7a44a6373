"""Records of text files that Spark splits into byte ranges, where a record may hold the separator of its lines.

Spark's text reader cuts files into ranges and pieces at a separator. Whether a separator is one between records depends
on all that stands before it in the file: on quotes, and in JSON on brackets. So a first pass lets each range report
what it does to the state of a reader that enters it, for each way it can be entered. Folding these reports, one for
each range, gives the state at every range's start, and a second pass cuts the records. What a range leaves open at its
ends is joined with its neighbours' ends, which is all that is shuffled. No task holds more than a range and no row more
than a record.

The driver holds the reports of all ranges, which are as many as the splits in the plan of the scan it holds anyway.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from reviewlake.session import materialize

#: a range: its file and where Spark's split of the file begins
Place = tuple[str, int]

#: How a record of a range stands to its neighbours: whole, going on from the left, to the right, or both.
WHOLE, FROM_LEFT, TO_RIGHT, THROUGH = range(4)

PIECES = "file string, start bigint"

#: Bytes of pieces that a reader gets at a time, unless one piece is longer.
HELD = 2 * 2 ** 20


def pieces(spark: SparkSession, paths: str | Sequence[str], separator: str | None = None, glob: str | None = None,
           base: str | None = None) -> DataFrame:
    """(value as bytes, file, start, folder): the pieces between separators (default: line ends) in their order.

    folder holds the values of the columns that the folders are named by; `base` is the folder they begin at.
    """
    reader = spark.read
    for option, value in (("lineSep", separator), ("pathGlobFilter", glob), ("basePath", base)):
        reader = reader.option(option, value) if value is not None else reader
    text = reader.text(paths if isinstance(paths, str) else list(paths))
    return text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"), folder_of(text).alias("folder"))


def folder_of(text: DataFrame) -> Column:
    """The columns beside `value`, which the folders of the files are named by."""
    return F.struct(F.lit(None).cast("int").alias("_none"), *[F.col(f"`{name}`") for name in text.columns if name != "value"])


def path_of(file: str) -> str:
    """What a reader takes for the file that `_metadata.file_path` names."""
    return unquote(file)


def _runs(part: pa.RecordBatch) -> Iterator[tuple[Place, int, int]]:
    """Consecutive rows of one range: (range, first row, end)."""
    starts, files = part.column(2).to_numpy(), part.column(1).dictionary_encode()
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), part.num_rows]):
        if first < end:
            yield (files.dictionary[int(codes[first])].as_py(), int(starts[first])), first, end


def _portions(values: pa.Array) -> Iterator[list[bytes]]:
    """The values as lists of about HELD bytes."""
    upto = np.cumsum(np.asarray(pc.binary_length(values), np.int64))
    start = 0
    while start < len(upto):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + HELD, "right")))
        yield values.slice(start, end - start).to_pylist()
        start = end


def over_ranges(found: DataFrame, outputs: str, begin: Callable[[Place], object]) -> DataFrame:
    """(file, start, folder, outputs): one reader for each range, which `begin` makes.

    A reader has `read(values)`, which gives rows while it gets a range's pieces portion by portion, and `end()`, which
    gives the last ones. Python holds the rows of one portion, however long the pieces of a batch are.
    """
    schema = StructType([*[found.schema[name] for name in ("file", "start", "folder")], *_parse_datatype_string(outputs).fields])
    arrow = to_arrow_schema(schema)

    def batch(place: Place, folder: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([place[0]] * len(rows), arrow[0].type), pa.array([place[1]] * len(rows), arrow[1].type),
                   folder.take(pa.array([0] * len(rows))).cast(arrow[2].type)]
        made = list(zip(*rows))
        return pa.RecordBatch.from_arrays(columns + [pa.array(made[at], field.type) for at, field in enumerate(list(arrow)[3:])],
                                          schema=arrow)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, folder, reader = None, None, None
        for part in parts:
            for at, first, end in _runs(part):
                if at != place:
                    if reader is not None and (rows := list(reader.end())):
                        yield batch(place, folder, rows)
                    place, folder, reader = at, part.column(3).slice(first, 1), begin(at)
                for values in _portions(part.column(0).slice(first, end - first)):
                    if rows := list(reader.read(values)):
                        yield batch(place, folder, rows)
        if reader is not None and (rows := list(reader.end())):
            yield batch(place, folder, rows)

    return found.select("value", "file", "start", "folder").mapInArrow(run, schema)


def join_ends(records: DataFrame, text: str = "text") -> DataFrame:
    """Whole records of (file, start, folder, seq, edge, text, ...): what ranges left open is put together in order.

    A record that goes on to the right begins a group, in which its parts follow one another. Other columns are the
    first part's. Only the open ends, two a range at most, are shuffled.
    """
    others = [name for name in records.columns if name not in ("file", "start", "folder", "seq", "edge", text)]
    order = Window.partitionBy("file").orderBy("start", "seq")
    group = F.sum((F.col("edge") == TO_RIGHT).cast("int")).over(order)
    open_ends = records.where(F.col("edge") != WHOLE).withColumn("group", group)
    part = F.struct("start", "seq", text)
    joined = open_ends.groupBy("file", "group").agg(
        F.min_by(F.struct("start", "folder", "seq", *others), F.struct("start", "seq")).alias("first"),
        F.sort_array(F.collect_list(part)).alias("parts"))
    kept = records.where(F.col("edge") == WHOLE).select("file", "start", "folder", "seq", *others, text)
    return kept.unionAll(joined.select("file", "first.start", "first.folder", "first.seq", *[F.col(f"first.{name}") for name in others],
                                       F.array_join(F.transform("parts", lambda x: x[text]), "").alias(text)))


# JSON documents -----------------------------------------------------------------------------------

#: What surrounds an element: the separators that no element begins or ends with.
BLANK = ", \t\r\n"

QUOTE, BACKSLASH, COMMA, OPEN, CLOSE = 34, 92, 44, (91, 123), (93, 125)


def structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of brackets and commas in bytes of JSON, which of them stand in strings, and whether the end does.

    A piece never ends within an escape: the only separators are commas, and an escaped comma is no JSON.
    """
    quotes = np.flatnonzero(data == QUOTE)
    if len(quotes):
        after = quotes[(quotes > 0) & (data[quotes - 1] == BACKSLASH)]
        if len(after):  # quotes after an odd number of backslashes are escaped
            other = np.flatnonzero(data != BACKSLASH)
            before = np.searchsorted(other, after) - 1
            length = after - 1 - np.where(before >= 0, other[before], -1)
            quotes = np.setdiff1d(quotes, after[length % 2 == 1], assume_unique=True)
    marks = np.flatnonzero((data == COMMA) | (data == OPEN[0]) | (data == OPEN[1]) | (data == CLOSE[0]) | (data == CLOSE[1]))
    return marks, (np.searchsorted(quotes, marks) + inside) % 2 == 1, (len(quotes) + inside) % 2 == 1


def _steps(kinds: np.ndarray) -> np.ndarray:
    """+1 for an opening bracket, -1 for a closing one."""
    return np.isin(kinds, OPEN).astype(np.int64) - np.isin(kinds, CLOSE)


def unmatched(kinds: np.ndarray) -> tuple[int, bytes]:
    """Closing brackets that close what stands before, and the opening ones that stay open."""
    steps = _steps(kinds)
    depth = np.cumsum(steps)
    if not len(depth):
        return 0, b""
    closes = max(0, -int(depth.min()))
    lowest_after = np.minimum.accumulate(depth[::-1])[::-1]
    return closes, kinds[(steps == 1) & (lowest_after >= depth)].astype(np.uint8).tobytes()


def followed(before: tuple[int, bytes], after: tuple[int, bytes]) -> tuple[int, bytes]:
    """What two reports of brackets say together."""
    closes, opens = before
    return closes + max(0, after[0] - len(opens)), opens[:max(0, len(opens) - after[0])] + after[1]


def edges(line: bytes) -> bytes:
    """First character of a line, last one that is no comma, last one; nothing for a blank line."""
    line = line.strip()
    return line and line[:1] + (line.rstrip(b", \t\r")[-1:] or line[-1:]) + line[-1:]


def merged(before: bytes, after: bytes) -> bytes:
    """Edges of a line of two parts."""
    return before[:1] + after[1:] if before and after else before or after


def complete(line: bytes) -> bool:
    """Whether a line begins and ends as an object or a list does."""
    return line[:1] in (b"{", b"[") and line[2:] in (b"}", b"]")


class JsonReport:
    """First pass: what a range does to a reader that enters it outside or inside a string, and how its lines look."""

    def __init__(self, place: Place):
        self.first, self.ends = place[1] == 0, [(False, (0, b"")), (True, (0, b""))]
        self.breaks = self.lines = self.complete = 0
        self.head, self.line = b"", b""

    def read(self, values: list[bytes]) -> Iterable[tuple]:
        data = b",".join(values) + b","
        if self.first:
            data, self.first = data.removeprefix(b"\xef\xbb\xbf"), False
        array = np.frombuffer(data, np.uint8)
        for way, (inside, brackets) in enumerate(self.ends):
            marks, quoted, at_end = structure(array, inside)
            self.ends[way] = (at_end, followed(brackets, unmatched(array[marks[~quoted]])))
        head, *rest = data.split(b"\n")
        self.line = merged(self.line, edges(head))
        for line in rest:
            if not self.breaks:
                self.head = self.line
            elif self.line:
                self.lines += 1
                self.complete += complete(self.line)
            self.breaks, self.line = self.breaks + 1, edges(line)
        return ()

    def end(self) -> Iterable[tuple]:
        (end0, (closes0, opens0)), (end1, (closes1, opens1)) = self.ends
        head, tail = (self.head, self.line) if self.breaks else (self.line, b"")
        yield end0, closes0, opens0, end1, closes1, opens1, self.breaks, self.lines, self.complete, head, tail


JSON_REPORT = ("end0 boolean, closes0 bigint, opens0 binary, end1 boolean, closes1 bigint, opens1 binary, "
               "breaks bigint, lines bigint, complete bigint, head binary, tail binary")


@dataclass(frozen=True)
class JsonFiles:
    """What the first pass found: files whose lines are records, other files, and the state at each range's start."""
    lines: list[str]
    documents: list[str]
    states: dict[Place, tuple[bool, bytes]]


def json_files(spark: SparkSession, path: str, glob: str | None = None) -> JsonFiles:
    """A file counts as lines if it has several and at least half of them begin and end as an object or a list does."""
    reports = over_ranges(pieces(spark, path, ",", glob), JSON_REPORT, JsonReport).drop("folder").collect()
    states, counts, inside, stack, file, line = {}, {}, False, b"", None, b""

    def count(file: str, lines: int, whole: int) -> None:
        before = counts.get(file, (0, 0))
        counts[file] = (before[0] + lines, before[1] + whole)

    def finish(file: str | None) -> None:
        if file is not None and line.strip(b","):  # the last piece of a file is not followed by a comma
            count(file, 1, complete(line[:1] + line[1:2] * 2))

    for row in sorted(reports, key=lambda row: (row["file"], row["start"])):
        if row["file"] != file:
            finish(file)
            file, inside, stack, line = row["file"], False, b"", b""
        states[file, row["start"]] = (inside, stack)
        way = int(inside)
        stack = followed((0, stack), (row[f"closes{way}"], bytes(row[f"opens{way}"])))[1]
        inside = row[f"end{way}"]
        line = merged(line, bytes(row["head"]))
        count(file, row["lines"], row["complete"])
        if row["breaks"]:
            count(file, int(bool(line)), int(complete(line)))
            line = bytes(row["tail"])
    finish(file)
    of_lines = [file for file, (lines, whole) in counts.items() if lines > 1 and 2 * whole >= lines]
    others = sorted(set(counts) - set(of_lines))
    return JsonFiles(sorted(of_lines), others, {place: state for place, state in states.items() if place[0] in set(others)})


class JsonCutter:
    """Second pass: the elements of a top-level list, or of every list right below a top-level object.

    Rows are (nth, seq, edge, text): nth counts the lists that open in this range from 1; 0 is the one that the range
    begins in. The row with nth -1 has the number of lists opened as seq, and the text outside of them, in which the
    lists are empty.
    """

    def __init__(self, state: tuple[bool, bytes], first: bool):
        self.inside, self.stack = state
        self.first = first
        self.level = self._level()
        self.in_list = self.level is not None and len(self.stack) >= self.level and self.stack[self.level - 1] == OPEN[0]
        self.opened, self.seq = 0, 0
        self.from_left = self.in_list
        self.pending: list[bytes] = []
        self.outside: list[bytes] = []

    def _level(self) -> int | None:
        """Depth of the elements' list: 1 in a list, 2 in an object; unknown before the first bracket."""
        return None if not self.stack else 1 if self.stack[0] == OPEN[0] else 2

    def _cut(self, to_right: bool) -> tuple:
        edge = (THROUGH if to_right else FROM_LEFT) if self.from_left else (TO_RIGHT if to_right else WHOLE)
        row = (self.opened, self.seq, edge, b"".join(self.pending).decode("utf-8", "replace"))
        self.pending, self.from_left, self.seq = [], False, self.seq + 1
        return row

    def read(self, values: list[bytes]) -> Iterable[tuple]:
        data = b",".join(values) + b","
        if self.first:
            data, self.first = data.removeprefix(b"\xef\xbb\xbf"), False
        array = np.frombuffer(data, np.uint8)
        marks, quoted, self.inside = structure(array, self.inside)
        marks = marks[~quoted]
        kinds = array[marks]
        if self.level is None:
            opening = np.flatnonzero(np.isin(kinds, OPEN))
            if len(opening):
                self.level = 1 if kinds[opening[0]] == OPEN[0] else 2
        level = self.level or 1
        steps = _steps(kinds)
        depth = np.cumsum(steps) + len(self.stack)
        # what happens at the level of the list: it opens, a comma stands in it, it closes
        events = ((steps == 1) & (depth == level)) | ((steps == 0) & (depth == level)) | ((steps == -1) & (depth == level - 1))
        at = 0
        for place, kind in zip(marks[events].tolist(), kinds[events].tolist()):
            if kind == OPEN[0] and not self.in_list:
                self.outside.append(data[at:place + 1])
                self.in_list, self.opened, at = True, self.opened + 1, place + 1
            elif self.in_list and kind in (COMMA, CLOSE[0]):
                self.pending.append(data[at:place])
                yield self._cut(False)
                at = place + 1 if kind == COMMA else place
                self.in_list = kind == COMMA
        (self.pending if self.in_list else self.outside).append(data[at:])
        self.stack = followed((0, self.stack), unmatched(kinds))[1]

    def end(self) -> Iterable[tuple]:
        if self.in_list:
            yield self._cut(True)
        yield -1, self.opened, WHOLE, b"".join(self.outside).decode("utf-8", "replace")


def json_elements(spark: SparkSession, found: JsonFiles, base: str | None) -> tuple[DataFrame, DataFrame]:
    """Elements (file, folder, nth, text) and outsides (file, text) of the documents.

    nth counts a file's lists from 1. Blank elements, as in an empty list, are left out.
    """
    states = spark.sparkContext.broadcast(found.states)
    cut = over_ranges(pieces(spark, [path_of(file) for file in found.documents], ",", base=base), "nth bigint, seq bigint, edge int, text string",
                      lambda place: JsonCutter(states.value[place], place[1] == 0))
    stored = materialize(cut, "json-elements")
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored.where("nth = -1").select("file", "start", F.coalesce(F.sum("seq").over(order), F.lit(0)).alias("before"))
    counted = stored.where("nth >= 0").join(ranges, ["file", "start"]).withColumn("nth", F.col("nth") + F.col("before")).drop("before")
    whole = join_ends(counted).withColumn("text", F.trim("text", F.lit(BLANK))).where("text <> ''")
    outside = (stored.where("nth = -1").groupBy("file")
               .agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
               .select("file", F.trim(F.array_join("parts.text", ""), F.lit(BLANK)).alias("text")))
    return whole.select("file", "folder", "nth", "text"), outside


# Delimited text -----------------------------------------------------------------------------------


def ends_quoted(line: str, quoted: bool, opening: re.Pattern) -> bool:
    """Whether a line of delimited text ends within a quoted cell, if it begins within one or not.

    A quote opens a cell at its beginning only, and a doubled one does not close it: linear in the line.
    """
    at = 0
    while True:
        if quoted:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            quoted, at = False, at + 1
        found = opening.search(line, at)
        if found is None:
            return False
        quoted, at = True, found.end()


def opening_quote(delimiter: str) -> re.Pattern:
    """A quote at the beginning of a cell."""
    spaces = "" if delimiter == " " else " *"
    return re.compile(f'(?:^|{re.escape(delimiter)}){spaces}"')


def cut_cells(record: str, delimiter: str) -> list[str]:
    """Cells of a record; spaces and quotes around a cell are cut. Quoted cells may hold separators and line ends."""
    csv.field_size_limit(sys.maxsize)
    # the reader takes lines; a lone carriage return in a cell is not one
    rows = csv.reader(record.strip(" \n").replace("\0", "").splitlines(keepends=True) if "\n" in record else [record.strip(" ").replace("\0", "")],
                      delimiter=delimiter, skipinitialspace=not delimiter.isspace())
    return [cell.strip(" ").strip("\"' ") for row in rows for cell in row]


def _decoded(values: list[bytes], encoding: str) -> list[str]:
    return [value.decode(encoding, "replace").replace("\ufeff", "").replace("\r", "") for value in values]


class QuoteReport:
    """First pass: whether a range ends within a quoted cell, if it begins outside and if it begins within one."""

    def __init__(self, delimiter: str, encoding: str):
        self.opening, self.encoding, self.ends = opening_quote(delimiter), encoding, [False, True]

    def read(self, values: list[bytes]) -> Iterable[tuple]:
        for line in _decoded([value for value in values if b'"' in value], self.encoding):
            self.ends = [ends_quoted(line, quoted, self.opening) for quoted in self.ends]
        return ()

    def end(self) -> Iterable[tuple]:
        yield tuple(self.ends)


class RecordCutter:
    """Second pass: (seq, edge, text, cells) of each record; cells are cut where the record is whole."""

    def __init__(self, delimiter: str, encoding: str, quoted: bool, by_line: bool, skip: bool):
        self.delimiter, self.encoding, self.opening = delimiter, encoding, opening_quote(delimiter)
        self.quoted = self.from_left = quoted
        self.by_line, self.skip = by_line, skip
        self.seq, self.pending = 0, []

    def _row(self, to_right: bool) -> tuple:
        edge = (THROUGH if to_right else FROM_LEFT) if self.from_left else (TO_RIGHT if to_right else WHOLE)
        text = "\n".join(self.pending) + ("\n" if to_right else "")
        self.pending, self.from_left, self.seq = [], False, self.seq + 1
        whole = edge == WHOLE
        return self.seq, edge, None if whole else text, cut_cells(text, self.delimiter) if whole else None

    def read(self, values: list[bytes]) -> Iterable[tuple]:
        for line in _decoded(values, self.encoding):
            self.pending.append(line)
            if not self.by_line and (self.quoted or '"' in line):
                self.quoted = ends_quoted(line, self.quoted, self.opening)
            if self.quoted:
                continue
            if self.skip or (not self.from_left and not any(line.strip() for line in self.pending)):
                self.skip = self.skip and not any(line.strip() for line in self.pending)  # the header is the first with content
                self.pending = []
            else:
                yield self._row(False)

    def end(self) -> Iterable[tuple]:
        if self.quoted:
            yield self._row(True)


def delimited_cells(spark: SparkSession, files: Sequence[str], delimiter: str, encoding: str, header: bool) -> DataFrame:
    """(cells array<string>): the records of files of one encoding, without the first one of each if that is a header.

    A quoted cell may hold line ends, over ranges of a file too. A file whose last quote is never closed is read line
    by line.
    """
    paths = [path_of(file) for file in files]
    if encoding.startswith("UTF-16"):  # line ends are not single bytes: files are read one by one, without blank lines
        text = (spark.read.option("encoding", encoding).option("sep", "\x01").option("quote", "\x02").option("multiLine", True)
                .schema("value string").csv(paths))
        lines = text.select(F.encode("value", "UTF-8").alias("value"), F.col("_metadata.file_path").alias("file"),
                            F.col("_metadata.file_block_start").alias("start"), folder_of(text).alias("folder"))
        encoding = "UTF-8"
    else:
        lines = pieces(spark, paths)
    reports = over_ranges(lines, "end0 boolean, end1 boolean", lambda place: QuoteReport(delimiter, encoding)).drop("folder").collect()
    states, quoted, file, unclosed = {}, False, None, set()
    for row in sorted(reports, key=lambda row: (row["file"], row["start"])):
        if quoted and row["file"] != file:
            unclosed.add(file)
        quoted = quoted and row["file"] == file
        file = row["file"]
        states[file, row["start"]] = quoted
        quoted = row[f"end{int(quoted)}"]
    if quoted:
        unclosed.add(file)
    known = spark.sparkContext.broadcast((states, unclosed))

    def begin(place: Place) -> RecordCutter:
        by_line = place[0] in known.value[1]
        return RecordCutter(delimiter, encoding, known.value[0][place] and not by_line, by_line, header and place[1] == 0)

    records = over_ranges(lines, "seq bigint, edge int, text string, cells array<string>", begin)
    stored = materialize(records, "records")
    open_ends = join_ends(stored.where(F.col("edge") != WHOLE).drop("cells")).select("text")
    schema = _parse_datatype_string("cells array<string>")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([cut_cells(text, delimiter) for text in part.column(0).to_pylist()],
                                                       pa.list_(pa.string()))], schema=to_arrow_schema(schema))
    return stored.where(F.col("edge") == WHOLE).select("cells").unionAll(open_ends.mapInArrow(cut, schema))
