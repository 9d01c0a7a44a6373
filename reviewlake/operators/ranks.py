"""Exact order statistics without a single-task window: quantiles, ranks, rolling rows.

Quantiles are selected: a sketch brackets each one, a count says how many values lie below the bracket, and only the
few values inside are ever ordered. Ranks (`Runs`) order the distinct values of all columns in cells, and rolling rows
work on range partitions; offsets are summed up from a table with one row per cell or partition. What is cut is written
to the shared folder, so offsets and rows always come from the same evaluation.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.session import materialize, shuffle_partitions

#: Cells that a sketch cuts the values between two bounds into, and the accuracy of its ranks (one part in so many).
CELLS, ACCURACY = 256, 10_000

#: Values between the bounds of a quantile that are ordered at once; more of them are sketched and counted again.
INSIDE = 1_000_000


def _number(column: str) -> Column:
    """As a double; NaN is null."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def _cells(values: Column, accuracy: int) -> Column:
    levels = F.expr(f"array({', '.join(f'{at / CELLS!r}D' for at in range(CELLS + 1))})")
    return F.percentile_approx(values, levels, F.lit(accuracy))


def _bounds(cuts: Column, skipped: Column, counted: Column) -> tuple[Column, Column]:
    """Bounds from a sketch of `counted` values, which stand at the places from `skipped` on: the cells that the places
    `first` and `last` fall into, and one more on either side."""
    def cell(place: str) -> Column:
        return F.floor((F.col(place) - skipped) / counted * CELLS)
    return (F.get(cuts, F.greatest(F.lit(0), cell("first") - 1).cast("int")),
            F.get(cuts, F.least(F.lit(CELLS), cell("last") + 2).cast("int")))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (),
              inside: int = INSIDE, accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles with linear interpolation: (by..., name, p, value). Nulls and NaN are left out.

    Every round is one aggregate over (group, column, value), reduced before the shuffle: a sketch first, then the
    counts below and up to the bounds it gave. A sketch that missed is noticed by the counts, and more than `inside`
    values between the bounds are sketched again, so the result does not rest on the sketch. Only what then lies
    between the bounds is shuffled and ordered. Nothing is written but one row for each quantile.
    """
    levels = [float(p) for p in probabilities]
    keys = [*by, "_c"]
    pairs = F.array(*[F.struct(F.lit(at).alias("_c"), _number(column).alias("_v")) for at, column in enumerate(columns)])
    rows = df.select(*by, F.explode(pairs).alias("x")).select(*by, "x.*").where("_v IS NOT NULL")
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), _cells(F.col("_v"), accuracy).alias("cuts"))
    place = F.col("p") * (F.col("n") - 1)
    low, high = _bounds(F.col("cuts"), F.lit(0), F.col("n"))
    state = (sketch.select("*", F.posexplode(F.array(*[F.lit(p) for p in levels])).alias("k", "p"))
             .withColumns({"first": F.floor(place), "last": F.ceil(place), "share": place - F.floor(place)})
             .withColumns({"low": low, "high": high}).drop("cuts"))
    state, before = materialize(state, "brackets"), math.inf
    while True:
        near = _with_bounds(rows, state, by)
        counts = near.groupBy(*keys).agg(F.array(*[F.struct(
            F.lit(k).alias("k"), F.count_if(F.col("_v") < F.col("_b")[k]["low"]).alias("below"),
            F.count_if(F.col("_v") <= F.col("_b")[k]["high"]).alias("upto")) for k in range(len(levels))]).alias("x"))
        counts = counts.select(*keys, F.inline("x"))
        state = materialize(_by_group(state.drop("below", "upto"), counts, [*keys, "k"]), "brackets")
        held = (F.col("below") <= F.col("first")) & (F.col("last") < F.col("upto"))
        many = (F.col("upto") - F.col("below") > inside) & (F.col("low") < F.col("high"))
        missed, crowded = state.agg(F.count_if(~held), F.sum(F.when(many, F.col("upto") - F.col("below")))).first()
        # what is crowded by few values, which no more cuts part, is added up before it is shuffled
        if not missed and (not crowded or crowded >= before):
            break
        before = math.inf if missed else crowded
        accuracy = min(10 * accuracy, 1_000_000)  # a miss widens to all values; what is crowded is cut again
        wide = state.withColumns({"low": F.when(held, F.col("low")).otherwise(F.lit(-math.inf)),
                                  "high": F.when(held, F.col("high")).otherwise(F.lit(math.inf)),
                                  "below": F.when(held, F.col("below")).otherwise(F.lit(0)),
                                  "upto": F.when(held, F.col("upto")).otherwise(F.col("n")), "again": many | ~held})
        again = _with_bounds(rows, wide, by).groupBy(*keys).agg(F.array(*[F.struct(
            F.lit(k).alias("k"), _cells(F.when(_within(k), F.col("_v")), accuracy).alias("cuts")) for k in range(len(levels))]).alias("x"))
        low, high = _bounds(F.col("cuts"), F.col("below"), F.col("upto") - F.col("below"))
        state = materialize(_by_group(wide, again.select(*keys, F.inline("x")), [*keys, "k"]).withColumns({
            "low": F.when(F.col("again"), low).otherwise(F.col("low")),
            "high": F.when(F.col("again"), high).otherwise(F.col("high"))}).drop("cuts", "again"), "brackets")
    # how often each value between the bounds occurs, for brackets of more than one value
    open_ = [F.when(_within(k) & (F.col("_b")[k]["low"] < F.col("_b")[k]["high"]), F.lit(k)) for k in range(len(levels))]
    between = (near.where(F.coalesce(*open_).isNotNull()).select(*keys, "_v", F.explode(F.array_compact(F.array(*open_))).alias("k"))
               .groupBy(*keys, "k", "_v").agg(F.count(F.lit(1)).alias("held")))
    found = _by_group(between, state.select(*keys, "k", "below", "first", "last"), [*keys, "k"])
    order = Window.partitionBy(*keys, "k").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = found.withColumn("_upto", F.col("below") + F.sum("held").over(order))

    def at(wanted: str) -> Column:
        holds = (F.col(wanted) >= F.col("_upto") - F.col("held")) & (F.col(wanted) < F.col("_upto"))
        return F.max(F.when(holds, F.col("_v")))
    picked = upto.groupBy(*keys, "k").agg(at("first").alias("_a"), at("last").alias("_z"))
    names = F.array(*[F.lit(column) for column in columns])
    a, z = F.coalesce("_a", "low"), F.coalesce("_z", "low")  # a bracket of one value is that value
    return _by_group(state, picked, [*keys, "k"], "left").select(
        *by, F.get(names, F.col("_c")).alias("name"), "p", (a + (z - a) * F.col("share")).alias("value"))


def _within(k: int) -> Column:
    return (F.col("_v") >= F.col("_b")[k]["low"]) & (F.col("_v") <= F.col("_b")[k]["high"])


def _with_bounds(rows: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with `_b`, the bounds of the quantiles of their group and column."""
    bounds = state.groupBy(*by, "_c").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "low", "high"))),
                                                      lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"))).alias("_b"))
    return _by_group(rows, bounds if by else F.broadcast(bounds), [*by, "_c"])  # without groups, one row for each column


def _by_group(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null."""
    named = right.select(*[F.col(key).alias(f"_key_{key}") for key in keys], *[name for name in right.columns if name not in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return left.join(named, same, how).drop(*[f"_key_{key}" for key in keys])


def quantile_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, dict[float, float]]:
    """The same as numbers on the driver: len(columns) x len(probabilities) of them."""
    found: dict[str, dict[float, float]] = {column: {} for column in columns}
    for row in quantiles(df, columns, probabilities).collect():
        found[row["name"]][row["p"]] = row["value"]
    return found


#: Values that are made distinct together, distinct values that are ordered together, and bounds that a chunk proposes.
CHUNK, CELL, POINTS = 1 << 21, 250_000, 32


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Doubles with NaN for null, and without a negative zero."""
    return column.to_numpy().astype(np.float64) + 0.0


def _distinct(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, column...) in order of the chunks -> (chunk, name, values, counts, size, points), a row for each chunk and column."""
    def close(chunk: int, waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        table, rows = pa.Table.from_batches(waiting), []
        for name in range(table.num_columns - 1):
            column = _numbers(table.column(name + 1))
            values, counts = np.unique(column[~np.isnan(column)], return_counts=True)
            if len(values):
                points = values[np.arange(POINTS) * len(values) // POINTS]
                rows.append((chunk, name, values.tobytes(), counts.astype(np.int64).tobytes(), len(values), points.tolist()))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                          ["chunk", "name", "values", "counts", "size", "points"])

    waiting, current = [], None
    for part in parts:
        chunks = part.column(0).to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
        for start, end in zip(bounds, bounds[1:]):
            if start == end:
                continue
            if waiting and chunks[start] != current:
                yield close(current, waiting)
                waiting = []
            current = int(chunks[start])
            waiting.append(part.slice(start, end - start))
    if waiting:
        yield close(current, waiting)


def _cut(cuts: dict[int, list[float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(chunk, name, values, counts) -> the same in cells, between whose bounds the values of a column lie."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows: list[tuple] = []
            for row in part.to_pylist():
                values, counts = np.frombuffer(row["values"]), np.frombuffer(row["counts"], np.int64)
                places = np.searchsorted(values, cuts.get(row["name"], []), side="left")
                for cell, (start, end) in enumerate(zip([0, *places], [*places, len(values)])):
                    if start < end:
                        rows.append((row["chunk"], row["name"], cell, values[start:end].tobytes(), counts[start:end].tobytes()))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                             ["chunk", "name", "cell", "values", "counts"])
    return run


def _merge(table: pa.Table) -> pa.Table:
    """The pieces of one cell -> the same with `less` (smaller values in the cell) and `ties` (rows of the same value)."""
    pieces = [np.frombuffer(value.as_py()) for value in table.column("values")]
    counts = np.concatenate([np.frombuffer(value.as_py(), np.int64) for value in table.column("counts")])
    values, place = np.unique(np.concatenate(pieces), return_inverse=True)
    ties = np.zeros(len(values), np.int64)
    np.add.at(ties, place, counts)
    less, bounds = np.cumsum(ties) - ties, np.cumsum([0, *map(len, pieces)])
    places = [place[start:end] for start, end in zip(bounds, bounds[1:])]
    return pa.table({
        "chunk": table.column("chunk"), "name": table.column("name"), "cell": table.column("cell"), "values": table.column("values"),
        "less": pa.array([less[at].tobytes() for at in places], pa.binary()),
        "ties": pa.array([ties[at].tobytes() for at in places], pa.binary()),
        "held": pa.array(np.full(len(pieces), ties.sum(), np.int64))})


def _ranks_of(left: pa.Table, right: pa.Table) -> pa.Table:
    """Ranks of the rows of one chunk: (chunk, at, column...) and the pieces of the chunk -> (at, rank...)."""
    pieces: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for row in right.to_pylist():
        less, ties = np.frombuffer(row["less"], np.int64), np.frombuffer(row["ties"], np.int64)
        rank = (row["before"] + less + (ties + 1) / 2) / row["total"]
        pieces.setdefault(row["name"], []).append((np.frombuffer(row["values"]), rank))
    arrays = [left.column(1).combine_chunks()]
    for name in range(left.num_columns - 2):
        column = _numbers(left.column(name + 2))
        missing, ranks = np.isnan(column), np.zeros(len(column))
        if name in pieces:
            values, known = (np.concatenate(side) for side in zip(*pieces[name]))
            order = np.argsort(values, kind="stable")
            ranks[~missing] = known[order][np.searchsorted(values[order], column[~missing])]
        arrays.append(pa.array(ranks, mask=missing))
    return pa.table(arrays, names=["at", *[f"r{name}" for name in range(left.num_columns - 2)]])


class Runs:
    """The distinct values of columns in order, each with the number of smaller ones and of its rows, for ranks and quantiles.

    `rows` is stored and has `_at`, a number of the row, from `monotonically_increasing_id` when it was stored. If `_at` is older
    than that, a second such number is `_place`: chunks are rows that are stored together. They send each of their values once, in
    cells of a range of one column. So a frequent value costs as much as a rare one, and a cell is small whatever the table.
    What a cell knows of its values goes back to the chunks they came from.
    """

    def __init__(self, rows: DataFrame, columns: Sequence[str], chunk: int = CHUNK, cell: int = CELL):
        self.columns = list(columns)
        bits = max(4, int(math.log2(max(1, chunk // max(1, len(self.columns))))))
        place = "_place" if "_place" in rows.columns else "_at"
        self.numbers = rows.select(F.shiftright(place, min(bits, 33)).alias("chunk"), F.col("_at").alias("at"),
                                   *[F.col(f"`{name}`").cast("double").alias(f"c{at}") for at, name in enumerate(self.columns)])
        stored = materialize(self.numbers.drop("at").mapInArrow(
            _distinct, "chunk long, name int, values binary, counts binary, size long, points array<double>"), "distinct-values")
        sizes = {row["name"]: math.ceil(row["n"] / cell) for row in stored.groupBy("name").agg(F.sum("size").alias("n")).collect()}
        cells, cuts = max(sizes.values(), default=1), {}
        if cells > 1:
            levels = F.expr(f"array({', '.join(f'{at / cells!r}D' for at in range(1, cells))})")
            points = stored.where(F.col("name").isin([name for name, n in sizes.items() if n > 1])).select("name", F.explode("points").alias("x"))
            cuts = {row["name"]: sorted(set(row["cuts"])) for row in points.groupBy("name").agg(
                F.percentile_approx("x", levels, F.lit(ACCURACY)).alias("cuts")).collect()}
        self.pieces = materialize(
            stored.mapInArrow(_cut(cuts), "chunk long, name int, cell int, values binary, counts binary").groupBy("name", "cell")
            .applyInArrow(_merge, "chunk long, name int, cell int, values binary, less binary, ties binary, held long"), "pieces")
        # one row for each column and cell
        held = self.pieces.groupBy("name", "cell").agg(F.first("held").alias("held"))
        before = Window.partitionBy("name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        self.cells = materialize(held.select("name", "cell", "held", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
                                             F.sum("held").over(Window.partitionBy("name")).alias("total")), "cells")

    def ranks(self, suffix: str = "_percentile") -> DataFrame:
        """(_at, rank...): average rank of ties divided by the number of values."""
        placed = self.pieces.join(F.broadcast(self.cells.drop("held")), ["name", "cell"]).select(
            "chunk", "name", "before", "total", "values", "less", "ties")
        schema = "at long, " + ", ".join(f"r{at} double" for at in range(len(self.columns)))
        found = self.numbers.groupBy("chunk").cogroup(placed.groupBy("chunk")).applyInArrow(_ranks_of, schema)
        return found.select(F.col("at").alias("_at"), *[F.col(f"r{at}").alias(f"{name}{suffix}") for at, name in enumerate(self.columns)])

    def quantiles(self, probabilities: Sequence[float]) -> dict[str, dict[float, float]]:
        """Exact quantiles with linear interpolation on the driver, as `quantile_values` has them."""
        cells: dict[int, list] = {}
        for row in self.cells.collect():
            cells.setdefault(row["name"], []).append(row)
        wanted: dict[tuple[int, int], set[int]] = {}
        for name, held in cells.items():
            for p in probabilities:
                place = float(p) * (held[0]["total"] - 1)
                for at in (math.floor(place), math.ceil(place)):
                    cell = next(row for row in held if row["before"] <= at < row["before"] + row["held"])
                    wanted.setdefault((name, cell["cell"]), set()).add(at - cell["before"])

        def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                rows: list[tuple] = []
                for row in part.to_pylist():
                    less, ties = np.frombuffer(row["less"], np.int64), np.frombuffer(row["ties"], np.int64)
                    values = np.frombuffer(row["values"])
                    for at in wanted.get((row["name"], row["cell"]), ()):
                        rows += [(row["name"], row["cell"], at, value) for value in values[(less <= at) & (at < less + ties)].tolist()]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                                 ["name", "cell", "at", "value"])
        names = sorted({name for name, _ in wanted})
        picked = self.pieces.where(F.col("name").isin(names)).select("name", "cell", "values", "less", "ties").mapInArrow(
            pick, "name int, cell int, at long, value double").distinct()
        values = {(row["name"], row["cell"], row["at"]): row["value"] for row in picked.collect()} if wanted else {}
        found: dict[str, dict[float, float]] = {column: {} for column in self.columns}
        for name, held in cells.items():
            for p in probabilities:
                place = float(p) * (held[0]["total"] - 1)
                ends = []
                for at in (math.floor(place), math.ceil(place)):
                    cell = next(row for row in held if row["before"] <= at < row["before"] + row["held"])
                    ends.append(values[name, cell["cell"], at - cell["before"]])
                found[self.columns[name]][float(p)] = ends[0] + (ends[1] - ends[0]) * (place - math.floor(place))
        return found


def numbered(df: DataFrame) -> DataFrame:
    """Stored, with `_at`, a number of the row."""
    return materialize(df.withColumn("_at", F.monotonically_increasing_id()), "rows")


def by_number(rows: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows and what was found for their `_at`, which goes."""
    for other in others:
        rows = rows.join(other, "_at", "left")
    return rows.drop("_at")


def percentile_rank(df: DataFrame, columns: Sequence[str], suffix: str = "_percentile") -> DataFrame:
    """Average rank of ties divided by the number of non-null values, per column.

    The ranks of all columns come back to their rows in one join, and the number of shuffles does not depend on the number of columns.
    """
    rows = numbered(df)
    return by_number(rows, Runs(rows, columns).ranks(suffix))


def dense_rank_of_counts(stats: DataFrame, count: str, rank: str) -> DataFrame:
    """Dense rank by descending count.

    Only the distinct counts are ordered. k distinct counts need at least
    k(k+1)/2 rows, so there are fewer than 1.5 million for 10^12 rows: one small
    sort and a small broadcast.
    """
    order = Window.orderBy(F.desc(count))
    ranks = stats.select(count).distinct().withColumn(rank, F.dense_rank().over(order).cast("double"))
    return stats.join(F.broadcast(ranks), count, "left")


def ordered_index(df: DataFrame, order: Sequence[str], index: str = "_index") -> DataFrame:
    """Add the 0-based global position by `order` (unique, or ties are arbitrary but fixed)."""
    position = F.monotonically_increasing_id()
    # Written first: the ranges are drawn from a sample, which would evaluate the rows a second time.
    df = materialize(df, "unordered")
    ranged = (df.repartitionByRange(shuffle_partitions(df), *order).sortWithinPartitions(*order)
              .withColumn("_at", position))
    stored = materialize(ranged, "ordered")
    part, place = F.shiftright(F.col("_at"), 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    # One row per partition: the only thing that is ordered as a whole.
    parts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (stored.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(index, F.col("_before") + place).drop("_part", "_before", "_at"))


def rolling_table(rows: DataFrame, value: str, order: Sequence[str], size: int = 7, block: int = 100_000,
                  prefix: str | None = None) -> DataFrame:
    """(_at, mean, deviation) over the last `size` rows by `order` (deviation 0 for one row); only these columns are ordered.

    Rows are cut into equal blocks of the global order; each block also gets the
    last rows of the one before, so that no window spans two tasks.
    """
    prefix = prefix or f"{value}_rolling"
    block = max(block, size)
    indexed = ordered_index(rows.select(F.col("_at").alias("_row"), F.col(value).alias("_value"), *[
        F.col(name).alias(f"_order_{at}") for at, name in enumerate(order)]), [f"_order_{at}" for at in range(len(order))])
    own = F.floor(F.col("_index") / block)
    late = F.col("_index") % block >= block - (size - 1)
    blocks = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
    spread = indexed.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    frame = Window.partitionBy("_block").orderBy("_index").rowsBetween(-(size - 1), 0)
    return (spread
            .withColumn(f"{prefix}_mean_{size}", F.avg("_value").over(frame))
            .withColumn(f"{prefix}_std_{size}", F.coalesce(F.stddev_samp("_value").over(frame), F.lit(0.0)))
            .where(F.col("_block") == F.col("_own"))
            .select(F.col("_row").alias("_at"), f"{prefix}_mean_{size}", f"{prefix}_std_{size}"))


def rolling_rows(df: DataFrame, value: str, order: Sequence[str], size: int = 7,
                 block: int = 100_000, prefix: str | None = None) -> DataFrame:
    """Mean and sample deviation over the last `size` rows by `order` (deviation 0 for one row)."""
    rows = numbered(df)
    return by_number(rows, rolling_table(rows, value, order, size, block, prefix))


def first_occurrence(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(column, order...) of the row that holds each value of a column first.

    One pass for all columns: the rows are expanded to (column, value) and reduced
    by a minimum before and after the shuffle, so a frequent value costs nothing extra.
    """
    place = F.struct(*[F.col(name) for name in order])
    pairs = F.array(*[F.struct(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"))
                      for column in columns])
    expanded = df.select(place.alias("_place"), F.explode(pairs).alias("_pair"))
    return (expanded.groupBy("_pair.column", "_pair.value").agg(F.min("_place").alias("_place"))
            .select("column", "_place.*"))


def duplicate_flags(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add `<column>_duplicate`: true when an earlier row by `order` has the same value (nulls are equal).

    `order` must identify a row. The first rows are joined back on it, which is
    spread evenly whatever the values look like.
    """
    firsts = first_occurrence(df, columns, order)
    marks = firsts.groupBy(*order).agg(*[
        F.max(F.col("column") == column).alias(f"_{column}") for column in columns])
    condition = [df[name].eqNullSafe(marks[name]) for name in order]
    joined = df.join(marks, condition, "left").drop(*[marks[name] for name in order])
    return joined.select(*df.columns, *[
        (~F.coalesce(F.col(f"_{column}"), F.lit(False))).alias(f"{column}_duplicate") for column in columns])


def keep_first(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per distinct `subset`: the first by `order`. Reduced map-side, so copies do not pile up."""
    row = F.struct(*[F.col(column) for column in df.columns])
    place = F.struct(*[F.col(name) for name in order])
    return (df.groupBy(*[F.col(name).alias(f"_key_{name}") for name in subset])
            .agg(F.min_by(row, place).alias("_row")).select("_row.*"))


def hash_rank_split(df: DataFrame, label: str, key: Column, share: float = 0.8,
                    buckets: int = 1 << 20, flag: str = "is_train") -> DataFrame:
    """Mark the first ceil(share * n) rows of every label in md5 order of `key`.

    Counts per (label, leading hash digits) find the one bucket per label that is
    cut; only its rows are ranked, a millionth of the label.
    """
    digits = 1
    while 16 ** digits < buckets:
        digits += 1
    hashed = df.withColumn("_hash", F.md5(key)).withColumn("_bucket", F.substring("_hash", 1, digits))
    counts = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    ordered = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(label)
    cuts = (counts.withColumn("_upto", F.sum("_n").over(ordered))
            .withColumn("_keep", F.ceil(F.round(F.sum("_n").over(whole) * share, 6)))
            .where((F.col("_upto") >= F.col("_keep")) & (F.col("_upto") - F.col("_n") < F.col("_keep")))
            .select(F.col(label).alias("_cut_label"), F.col("_bucket").alias("_cut"),
                    (F.col("_keep") - F.col("_upto") + F.col("_n")).alias("_rest")))
    same = hashed[label].eqNullSafe(F.col("_cut_label"))
    # One row per label.
    joined = hashed.join(F.broadcast(cuts), same, "left").drop("_cut_label")
    ranked_part = joined.where(F.col("_bucket") == F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash"))
    ranked = ranked_part.withColumn(flag, rank <= F.col("_rest"))
    others = joined.where(F.col("_bucket") != F.col("_cut")).withColumn(flag, F.col("_bucket") < F.col("_cut"))
    return others.unionByName(ranked).drop("_hash", "_bucket", "_cut", "_rest")
