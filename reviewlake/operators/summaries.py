"""Grouped and global summaries of reviews, sentiment, ratings, events and jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.expr import flag, pearson
from reviewlake.operators.cleaning import numeric_columns
from reviewlake.operators.ranks import quantiles
from reviewlake.session import materialize


def _is(label: str, column: str = "sentiment_label") -> Column:
    return F.col(column) == label


def _labels() -> list[Column]:
    return [F.count_if(_is(label)).alias(f"{label}_reviews") for label in ("positive", "negative", "neutral")]


def mode_of(value: Column) -> Column:
    """Most frequent value, the smallest of several (for columns with few values)."""
    return F.mode(value, True)


# Joined summaries -------------------------------------------------------------------------------


def product_review_summary(products: DataFrame, reviews: DataFrame,
                           describe: Sequence[str] = ("product_name", "category", "brand")) -> DataFrame:
    """Every product with its review figures. Reviews are reduced to one row per product before the join."""
    per_product = reviews.groupBy("product_id").agg(
        F.count("review_id").alias("total_reviews"), F.avg("rating").alias("average_rating"), *_labels(),
        F.max("created_at").alias("latest_review_date"))
    counts = ["total_reviews", "positive_reviews", "negative_reviews", "neutral_reviews"]
    return (products.select("product_id", *describe).join(per_product, "product_id", "left")
            .withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in counts}))


def user_engagement_summary(users: DataFrame, reviews: DataFrame, activity: DataFrame,
                            describe: Sequence[str] = ("username", "location")) -> DataFrame:
    """Every user with review and activity figures, each side reduced per user first (no fan-out)."""
    per_user = reviews.groupBy("user_id").agg(
        F.countDistinct("review_id").alias("total_reviews"), F.avg("rating").alias("average_rating_given"),
        F.countDistinct("product_id").alias("products_reviewed"))
    per_activity = activity.groupBy("user_id").agg(
        F.countDistinct("activity_id").alias("total_activities"),
        F.max("activity_timestamp").alias("last_activity_date"))
    counts = ["total_reviews", "products_reviewed", "total_activities"]
    return (users.select("user_id", *describe)
            .join(per_user, "user_id", "left").join(per_activity, "user_id", "left")
            .withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in counts}))


def daily_review_trends(reviews: DataFrame) -> DataFrame:
    """Reviews, mean rating and labels per day, newest first."""
    return (reviews.groupBy(F.to_date("created_at").alias("review_date"))
            .agg(F.count("*").alias("total_reviews"), F.avg("rating").alias("average_rating"),
                 F.count_if(_is("positive")).alias("positive_count"),
                 F.count_if(_is("negative")).alias("negative_count"),
                 F.count_if(_is("neutral")).alias("neutral_count"))
            .orderBy(F.desc("review_date")))


# Whole tables -------------------------------------------------------------------------------------


def table_stats(df: DataFrame) -> DataFrame:
    """(column, rows, minimum, maximum, average, distinct_values) per numeric column."""
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("value"))
                      for name in numeric_columns(df)])
    # Distinct values are counted in a long form: one shuffle of pre-aggregated pairs for all columns.
    values = (df.select(F.explode(pairs).alias("_pair")).groupBy("_pair.column", "_pair.value")
              .agg(F.count("*").alias("n")))
    return values.groupBy("column").agg(
        F.sum("n").alias("rows"), F.min("value").alias("minimum"), F.max("value").alias("maximum"),
        (F.sum(F.col("value") * F.col("n")) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("average"),
        F.count("value").alias("distinct_values"))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) of several tables."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
               for name, df in frames.items()]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result


# Per key ------------------------------------------------------------------------------------------


def product_analytics(reviews: DataFrame) -> DataFrame:
    """Per product: reviews, mean rating, label counts, latest review, verified reviews."""
    return reviews.groupBy("product_id").agg(
        F.count("*").alias("total_reviews"), F.avg("rating").alias("average_rating"),
        F.max("created_at").alias("latest_review"), F.count_if("verified_purchase").alias("verified_reviews"),
        F.count_if(_is("positive")).alias("positive"), F.count_if(_is("negative")).alias("negative"),
        F.count_if(_is("neutral")).alias("neutral"))


def user_analytics(reviews: DataFrame) -> DataFrame:
    """Per user: reviews, mean rating, distinct products, labels given, span of the reviews in days."""
    span = F.unix_micros(F.max("created_at")) - F.unix_micros(F.min("created_at"))
    return reviews.groupBy("user_id").agg(
        F.count("*").alias("total_reviews"), F.avg("rating").alias("average_rating_given"),
        F.countDistinct("product_id").alias("products_reviewed_count"),
        F.count_if(_is("positive")).alias("positive_given"), F.count_if(_is("negative")).alias("negative_given"),
        F.count_if(_is("neutral")).alias("neutral_given"),
        (span / 86_400_000_000).alias("review_frequency_days"))


#: Named analyses over a review table.
ANALYSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "product_analytics": product_analytics, "user_analytics": user_analytics}


def run_analytics(name: str, reviews: DataFrame) -> DataFrame:
    if name not in ANALYSES:
        raise ValueError(f"unknown analysis {name!r}; use one of {sorted(ANALYSES)}")
    return ANALYSES[name](reviews)


def aggregate(df: DataFrame, stages: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply a list of stages (group, add fields, project) in order."""
    for stage in stages:
        df = stage(df)
    return df


def monthly_product_summary(reviews: DataFrame) -> DataFrame:
    """Mean rating and sentiment and review count per product and month."""
    ts = F.col("created_at")
    return reviews.groupBy("product_id", F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.avg("rating").alias("rating"), F.avg("sentiment_score").alias("sentiment_score"),
        F.count("review_id").alias("review_count"))


def product_summary(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        F.avg("rating").alias("rating"), F.avg("sentiment_score").alias("sentiment_score"),
        F.count("review_id").alias("review_count"))


# Global figures and distributions -----------------------------------------------------------------


def overview(reviews: DataFrame) -> DataFrame:
    """Total, mean rating with its distance to 3, distinct products and users."""
    return reviews.agg(
        F.count("*").alias("total_reviews"), F.avg("rating").alias("average_rating"),
        (F.avg("rating") - 3).alias("rating_delta"), F.countDistinct("product_id").alias("unique_products"),
        F.countDistinct("user_id").alias("unique_users"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value, nulls left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.col("count") * 100 / total)


def daily(df: DataFrame, value: str, mean: str, std: str, ts: str = "created_at") -> DataFrame:
    """Mean, sample deviation and count per day."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        F.avg(value).alias(mean), F.stddev_samp(value).alias(std), F.count(value).alias("review_count"))


def sentiment_over_time(df: DataFrame) -> DataFrame:
    """Daily sentiment with a band of one deviation."""
    days = daily(df, "sentiment_score", "avg_sentiment", "sentiment_std")
    mean, std = F.bround("avg_sentiment", 3), F.bround("sentiment_std", 3)
    return days.select("date", mean.alias("avg_sentiment"), std.alias("sentiment_std"), "review_count",
                       (mean + std).alias("upper"), (mean - std).alias("lower"))


def rating_trends(df: DataFrame) -> DataFrame:
    return daily(df, "rating", "avg_rating", "rating_std")


def rating_by_category(df: DataFrame, category: str = "category") -> DataFrame:
    return (df.groupBy(category).agg(F.avg("rating").alias("avg_rating"), F.count("rating").alias("review_count"),
                                     F.stddev_samp("rating").alias("rating_std"))
            .orderBy("avg_rating", category))


def mean_by(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias(value))


def box_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whisker ends and extremes of a value per group."""
    quarter = quantiles(df, [value], [0.25, 0.5, 0.75], by=[group])
    wide = quarter.groupBy(group).agg(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
        for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    ends = df.groupBy(group).agg(F.min(value).alias("minimum"), F.max(value).alias("maximum"))
    return (wide.join(ends, group)
            .withColumns({"lower_fence": F.col("q1") - reach, "upper_fence": F.col("q3") + reach}))


def sentiment_summary(analyzed: DataFrame, emotions: Sequence[str]) -> DataFrame:
    """Counts and percentages of the labels, mean score and confidence, mean emotions (where there are any)."""
    total = F.count("*")
    labels = {label: F.count_if(_is(label)) for label in ("positive", "negative", "neutral")}
    return analyzed.agg(
        total.alias("total_reviews"),
        *[count.alias(f"{label}_count") for label, count in labels.items()],
        *[F.try_divide(count * 100, total).alias(f"{label}_percentage") for label, count in labels.items()],
        F.avg("sentiment_score").alias("average_sentiment_score"),
        F.avg("sentiment_confidence").alias("average_confidence"),
        *[F.avg(F.col(f"emotions.{name}")).alias(f"emotion_{name}") for name in emotions])


def _share(condition: Column) -> Column:
    return F.avg(flag(condition))


def sentiment_metrics(df: DataFrame) -> DataFrame:
    score = F.col("sentiment_score")
    return df.agg(F.avg(score).alias("avg_sentiment"), F.stddev_samp(score).alias("sentiment_std"),
                  _share(score > 0.1).alias("positive_ratio"), _share(score < -0.1).alias("negative_ratio"),
                  _share(F.abs(score) <= 0.1).alias("neutral_ratio"))


def rating_metrics(df: DataFrame) -> DataFrame:
    """Mean, deviation, counts per rating, shares of high and low ratings."""
    rating = F.col("rating")
    return df.agg(F.avg(rating).alias("avg_rating"), F.stddev_samp(rating).alias("rating_std"),
                  *[F.count_if(rating == k).alias(f"rating_{k}") for k in range(1, 6)],
                  _share(rating >= 4).alias("high_rating_ratio"), _share(rating <= 2).alias("low_rating_ratio"))


def analytics_summary(reviews: DataFrame, products: DataFrame, users: DataFrame, digits: int = 2) -> DataFrame:
    """Review figures with the number of products and users."""
    rating = F.col("rating")
    return reviews.agg(
        F.count("*").alias("total_reviews"), F.bround(F.avg(rating), digits).alias("average_rating"),
        *[F.count_if(rating == k).alias(f"rating_{k}") for k in range(1, 6)]).select(
        "*", products.agg(F.count("*")).scalar().alias("total_products"),
        users.agg(F.count("*")).scalar().alias("total_users"))


def review_batch(df: DataFrame, group: str | None = None, digits: int = 2) -> DataFrame:
    """Review figures of a batch of events, in total or per device / location."""
    rating = F.col("rating")
    grouped = df.groupBy(group) if group else df.groupBy()
    return grouped.agg(F.count("*").alias("total_reviews"), F.bround(F.avg(rating), digits).alias("average_rating"),
                       *[F.count_if(rating == k).alias(f"rating_{k}") for k in range(1, 6)])


def purchase_batch(df: DataFrame, group: str | None = None, digits: int = 2) -> DataFrame:
    """Orders, revenue and mean order value of a batch of purchases, in total or per payment method."""
    amount = F.coalesce(F.col("total_amount"), F.col("amount")) if "total_amount" in df.columns else F.col("amount")
    grouped = df.groupBy(group) if group else df.groupBy()
    return grouped.agg(F.count("*").alias("total_orders"), F.bround(F.sum(amount), digits).alias("total_revenue"),
                       F.bround(F.avg(amount), digits).alias("average_order_value"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest value: (bin, low, high, count)."""
    value = F.col(column).cast("double")
    bounds = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    numbered = df.where(value.isNotNull()).select(F.least(
        F.lit(bins), F.when(low == high, 1).otherwise(F.width_bucket(value, low, high, F.lit(bins)))).alias("bin"))
    counts = numbered.groupBy("bin").agg(F.count("*").alias("count"))
    width = (high - low) / bins
    return counts.select("bin", (low + (F.col("bin") - 1) * width).alias("low"),
                         (low + F.col("bin") * width).alias("high"), "count")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, count, mean, std, min, q25, q50, q75, max) per column, quartiles exact."""
    quarter = quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("name").agg(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(label)
        for p, label in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    moments = df.agg(F.array(*[F.struct(
        F.lit(name).alias("name"), F.count(name).alias("count"), F.avg(name).alias("mean"),
        F.stddev_samp(name).alias("std"), F.min(name).cast("double").alias("min"),
        F.max(name).cast("double").alias("max")) for name in columns]).alias("_m")).select(F.inline("_m"))
    return moments.join(quarter, "name", "left")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, correlation) of the given or all plain numeric columns, over the rows that have both.

    Each task multiplies its rows' matrix with itself, block after block of rows, with masks for what is missing, and
    sends one row for each pair; the plan does not grow with the columns. Values are centred by the columns' means
    first, so that the sums of squares keep their digits. Null where a column of the pair does not vary.
    """
    hidden = ("tfidf", "feature_", "cluster_", "pca_")
    if columns is None:
        columns = [name for name in numeric_columns(df) if not any(part in name.lower() for part in hidden)]
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, correlation double")
    value = [F.col(f"`{name}`").cast("double") for name in columns]
    values = df.select(F.array(*[F.when(~F.isnan(one), one) for one in value]).alias("v"))
    means = (values.mapInArrow(_column_sums(len(columns)), "at int, n bigint, x double").groupBy("at")
             .agg((F.sum("x") / F.nullif(F.sum("n"), F.lit(0))).alias("mean")))
    centre = np.zeros(len(columns))
    for row in means.where("mean IS NOT NULL").collect():  # one number for each column
        centre[row["at"]] = row["mean"]
    sums = values.mapInArrow(_pair_sums(centre), PAIR_SUMS).groupBy("a", "b").agg(
        *[F.sum(name).alias(name) for name in ("n", "x", "y", "xx", "yy", "xy")])
    n = F.nullif(F.col("n").cast("double"), F.lit(0.0))
    x2, y2 = (F.col(f"{c}{c}") - F.col(c) * F.col(c) / n for c in "xy")
    covered = F.col("xy") - F.col("x") * F.col("y") / n
    # what is left of equal values is far below their squares
    varied = (x2 > 1e-13 * F.col("xx")) & (y2 > 1e-13 * F.col("yy"))
    correlation = F.when(varied, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), covered / (F.sqrt(x2) * F.sqrt(y2)))))
    names = F.array(*[F.lit(name) for name in columns])
    return sums.select(F.get(names, F.col("a")).alias("feature_a"), F.get(names, F.col("b")).alias("feature_b"),
                       correlation.alias("correlation"))


PAIR_SUMS = "a int, b int, n bigint, x double, y double, xx double, yy double, xy double"


def _matrix(part: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows of a batch of arrays; NaN where a value is missing."""
    return np.asarray(part.column(0).flatten().cast(pa.float64()).fill_null(np.nan)).reshape(-1, width)


def _column_sums(width: int):
    """For each column, the values that are known and their sum."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = np.zeros(width, np.int64), np.zeros(width)
        for part in parts:
            matrix = _matrix(part, width)
            known += (~np.isnan(matrix)).sum(axis=0)
            total += np.nansum(matrix, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(known), pa.array(total)], names=["at", "n", "x"])
    return run


def _pair_sums(centre: np.ndarray):
    """For each pair of columns a < b: rows that have both, and sums of the values, squares and products over them."""
    width = len(centre)
    first, second = np.triu_indices(width, 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, width, width))
        for part in parts:
            matrix = _matrix(part, width)
            for at in range(0, len(matrix), 4096):
                block = matrix[at:at + 4096] - centre
                known = ~np.isnan(block)
                block, mask = np.where(known, block, 0.0), known.astype(np.float64)
                total[0] += mask.T @ mask
                total[1] += block.T @ mask          # [a, b]: the sum of a where b is known
                total[2] += (block * block).T @ mask
                total[3] += block.T @ block
        columns = [first, second, total[0][first, second], total[1][first, second], total[1][second, first],
                   total[2][first, second], total[2][second, first], total[3][first, second]]
        yield pa.RecordBatch.from_arrays([pa.array(one.astype(kind)) for one, kind in zip(
            columns, ("i4", "i4", "i8", "f8", "f8", "f8", "f8", "f8"))], names=["a", "b", "n", "x", "y", "xx", "yy", "xy"])
    return run


def rating_sentiment_correlation(df: DataFrame) -> DataFrame:
    rating, score = F.col("rating").cast("double"), F.col("sentiment_score")
    return df.agg(pearson(rating, score).alias("correlation"),
                  (_share(score > 0.1) * 100).alias("positive_percentage"),
                  (_share(score < -0.1) * 100).alias("negative_percentage"))


def review_insights(df: DataFrame) -> DataFrame:
    """Score, helpfulness and length figures."""
    # Written once: the median reads its input several times, which may be a join of texts.
    df = materialize(df.select("rating", "helpfulness_ratio", "review_length"), "insights")
    length = quantiles(df, ["review_length"], [0.5]).select(F.max("value")).scalar()
    return df.agg(
        F.avg("rating").alias("average_score"), mode_of(F.col("rating")).alias("most_common_score"),
        (_share(F.col("rating") >= 4) * 100).alias("positive_percentage"),
        F.avg("helpfulness_ratio").alias("average_helpfulness"),
        F.count_if(F.col("helpfulness_ratio") > 0.5).alias("highly_helpful"),
        F.max("helpfulness_ratio").alias("max_helpfulness"),
        F.avg("review_length").alias("average_length"),
        F.count_if(F.col("review_length") > 100).alias("long_reviews")).select("*", length.alias("median_length"))


def job_summary(jobs: DataFrame) -> DataFrame:
    """Jobs by status, success rate and records over a job log."""
    status = F.col("status")
    return jobs.agg(
        F.count("*").alias("total_jobs"), F.count_if(status == "completed").alias("completed_jobs"),
        F.count_if(status == "failed").alias("failed_jobs"),
        F.coalesce(F.try_divide(F.count_if(status == "completed"), F.count("*")), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.sum("records_processed"), F.lit(0)).alias("total_records_processed"))
