"""Places of rows in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.session import materialize


def number_rows(stored: DataFrame, order: list[Column], group: Column | None = None, label: str = "places") -> DataFrame:
    """(row, g, place, n): each row as a struct, its group, its place there by ascending `order`, from 0, and
    the number of the group's rows.

    `stored` is a stored table, so that a lost task deals out the same rows again. Ranges are cut by group, order and
    last the place in the stored table, so rows that are equal in all of `order` spread over ranges, too. The offsets
    come from a table with one row for each range and group that meet. Nulls of a group are a group.
    """
    row = stored.select(F.struct("*").alias("row"), F.struct((F.lit(0) if group is None else group).alias("key")).alias("g"),
                        *[column.alias(f"_{at}") for at, column in enumerate(order)],
                        F.monotonically_increasing_id().alias("_tie"))
    by = ["g", *[f"_{at}" for at in range(len(order))], "_tie"]
    # places in the ranges as they stand, written with the rows, so that offsets and rows are of one evaluation
    dealt = (row.repartitionByRange(*by).sortWithinPartitions(*by).select("row", "g")
             .withColumn("_at", F.monotonically_increasing_id()))
    ranged = materialize(dealt, label).withColumn("_part", F.shiftright("_at", 33))
    parts = ranged.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("g").alias("_g"), F.col("_part").alias("_of"), "_first",
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(whole).alias("n"))
    return (ranged.join(offsets, (F.col("_part") == F.col("_of")) & F.col("g").eqNullSafe(F.col("_g")))
            .select("row", "g", (F.col("_before") + F.col("_at") - F.col("_first")).alias("place"), "n"))

