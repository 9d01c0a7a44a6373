"""Customer features and user / product / review segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions import text as T
from reviewlake.functions.dates import is_weekend
from reviewlake.functions.expr import flag, pick, smoothed_ratio, whole_days


def customer_features(reviews: DataFrame, as_of: Column, users: DataFrame | None = None) -> DataFrame:
    """About 40 columns per user in one aggregation: volume, ratings, time, text, sentiment, scores.

    `as_of` is the instant the age of the last review is measured from.
    """
    have = set(reviews.columns)
    rating, total = F.col("rating"), F.count("rating")
    columns = [
        total.alias("total_reviews"), F.bround(F.avg(rating), 4).alias("avg_rating"),
        F.coalesce(F.bround(F.stddev_samp(rating), 4), F.lit(0.0)).alias("rating_std"),
        F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"),
        F.countDistinct("product_id").alias("unique_products"),
        *[F.count_if(rating == k).alias(f"rating_{k}_count") for k in range(1, 6)]]
    ts = "timestamp" if "timestamp" in have else "created_at"
    timed = ts in have
    if timed:
        columns += [(whole_days(F.max(ts), F.min(ts)) + 1).alias("days_active"), F.count(ts).alias("_dated"),
                    whole_days(as_of, F.max(ts)).alias("last_review_days_ago"),
                    F.avg(flag(is_weekend(F.col(ts)))).alias("weekend_review_ratio")]
    texted = "review_text" in have
    if texted:
        length = F.coalesce(F.length("review_text"), F.lit(0))
        columns += [F.avg(length).alias("avg_text_length"),
                    F.coalesce(F.stddev_samp(length), F.lit(0.0)).alias("text_length_std"),
                    F.min(length).alias("min_text_length"), F.max(length).alias("max_text_length"),
                    F.sum(length).alias("total_text_length"), F.count_if(length < 50).alias("short_reviews"),
                    F.count_if((length >= 50) & (length < 200)).alias("medium_reviews"),
                    F.count_if(length >= 200).alias("long_reviews")]
    felt = "sentiment_score" in have
    if felt:
        score = F.col("sentiment_score")
        columns += [F.avg(score).alias("avg_sentiment"),
                    F.coalesce(F.stddev_samp(score), F.lit(0.0)).alias("sentiment_std"),
                    F.avg(flag(score > 0)).alias("positive_sentiment_ratio"),
                    F.avg(flag(score < 0)).alias("negative_sentiment_ratio")]
    stats = reviews.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(*columns)

    n = F.col("total_reviews")
    diversity = F.try_divide(F.col("unique_products"), n)
    stats = stats.withColumns({
        "rating_range": F.col("max_rating") - F.col("min_rating"), "product_diversity": diversity,
        "repeat_purchase_ratio": 1 - diversity, "rating_consistency": 1 / (1 + F.col("rating_std")),
        **{f"rating_{k}_ratio": F.try_divide(F.col(f"rating_{k}_count"), n) for k in range(1, 6)},
        "review_frequency_consistency": F.lit(1.0),
        "reviews_per_day": F.col("_dated") / F.col("days_active") if timed else n.cast("double"),
        **({} if timed else {"days_active": F.lit(1), "last_review_days_ago": F.lit(0),
                             "weekend_review_ratio": F.lit(0.5)}),
        **({"short_review_ratio": F.try_divide(F.col("short_reviews"), n),
            "long_review_ratio": F.try_divide(F.col("long_reviews"), n)} if texted else
           {name: F.lit(0) for name in ("avg_text_length", "text_length_std", "min_text_length", "max_text_length",
                                        "total_text_length", "short_reviews", "medium_reviews", "long_reviews",
                                        "short_review_ratio", "long_review_ratio")}),
        **({} if felt else {"avg_sentiment": F.lit(0.0), "sentiment_std": F.lit(0.0),
                            "positive_sentiment_ratio": F.lit(0.5), "negative_sentiment_ratio": F.lit(0.5)}),
    }).drop("_dated")
    stats = stats.withColumns({
        "engagement_score": n * 0.3 + F.col("avg_text_length") * 0.001 + F.col("product_diversity") * 10
                            + F.col("reviews_per_day") * 5,
        "review_quality_score": F.col("avg_text_length") * 0.01 + F.col("rating_consistency") * 2
                                + (5 - F.abs(F.col("avg_rating") - 3)) * 0.5})
    if users is not None:
        stats = stats.join(users, "user_id", "left")
    return stats.fillna(0)


def frequency_consistency(reviews: DataFrame, user: str = "user_id", ts: str = "created_at") -> DataFrame:
    """Per user 1 / (1 + cv) of the whole-day gaps between consecutive reviews; 1 below three reviews.

    Two reviews of one date are less than a day apart, so only the last and first
    review of neighbouring dates make a gap above zero. Reviews are reduced to
    (user, date) before the window, whose groups are bounded by the calendar.
    """
    dates = (reviews.where(F.col(ts).isNotNull() & F.col(user).isNotNull())
             .groupBy(user, F.to_date(ts).alias("_date"))
             .agg(F.count("*").alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")))
    before = F.lag("_last").over(Window.partitionBy(user).orderBy("_date"))
    gaps = dates.withColumn("_gap", whole_days(F.col("_first"), before))
    n = F.sum("_n")
    sums = gaps.groupBy(user).agg(
        n.alias("reviews"), F.sum("_gap").alias("_sum"), F.sum(F.col("_gap") * F.col("_gap")).alias("_squares"))
    count = F.col("reviews") - 1
    mean = F.col("_sum") / count
    variance = F.greatest(F.lit(0.0), (F.col("_squares") - F.col("_sum") * mean) / (count - 1))
    cv = F.when(mean > 0, F.sqrt(variance) / mean).otherwise(0.0)
    consistency = F.when(F.col("reviews") < 3, 1.0).otherwise(1 / (1 + cv))
    return sums.select(user, "reviews", consistency.alias("review_frequency_consistency"))


def segmentation_features(df: DataFrame) -> DataFrame:
    """review_length, helpfulness_ratio and is_positive where they are missing."""
    names = df.columns
    text = pick(names, ["text", "review_text", "review"])
    helpful = pick(names, ["helpfulnessnumerator", "helpful_votes"])
    votes = pick(names, ["helpfulnessdenominator", "total_votes"])
    score = pick(names, ["score", "rating", "stars"])
    extra: dict[str, Column] = {}
    if "review_length" not in names and text:
        extra["review_length"] = T.word_count(F.coalesce(F.col(text), F.lit("")))
    if "helpfulness_ratio" not in names and helpful and votes:
        extra["helpfulness_ratio"] = smoothed_ratio(F.col(helpful), F.col(votes))
    if "is_positive" not in names and score:
        extra["is_positive"] = flag(F.col(score).try_cast("double") >= 4)
    return df.withColumns(extra)


def _group_means(df: DataFrame, key: str, score: str, extra: tuple[str, ...], digits: int) -> DataFrame:
    def mean(name: str, alias: str) -> Column:
        value = F.avg(name) if name in df.columns else F.lit(0.0)
        return F.bround(value, digits).alias(alias)

    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.bround(F.avg(score), digits).alias("avg_score"), F.bround(F.stddev_samp(score), digits).alias("score_std"),
        F.count(score).alias("review_count"), mean("review_length", "avg_review_length"),
        mean("helpfulness_ratio", "avg_helpfulness"), mean("sentiment_score", "avg_sentiment"),
        *[mean(name, "positive_ratio") for name in extra])


def user_segment_features(df: DataFrame, user: str = "user_id", score: str = "rating", digits: int = 3) -> DataFrame:
    """Means per user with at least two reviews."""
    return _group_means(df, user, score, (), digits).where(F.col("review_count") >= 2)


def product_segment_features(df: DataFrame, product: str = "product_id", score: str = "rating",
                             digits: int = 3) -> DataFrame:
    """Means per product with at least three reviews."""
    return _group_means(df, product, score, ("is_positive",), digits).where(F.col("review_count") >= 3)


def review_segment_features(df: DataFrame, score: str = "rating") -> DataFrame:
    """Numbers of every review that describe its style and tone."""
    number = F.coalesce(F.col(score).try_cast("double"), F.lit(3.0)).alias("score")
    columns = [number]
    if "review_length" in df.columns:
        columns.append(F.coalesce("review_length", F.lit(0)).alias("review_length"))
    if "helpfulness_ratio" in df.columns:
        columns.append(F.coalesce("helpfulness_ratio", F.lit(0.0)).alias("helpfulness_ratio"))
    if "sentiment_score" in df.columns:
        columns += [F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"),
                    F.abs(F.coalesce("sentiment_score", F.lit(0.0))).alias("sentiment_magnitude")]
    return df.select("review_id", *columns)


def segment_count(groups: int, per_segment: int) -> int:
    """Three or four segments, depending on how many members there are."""
    return min(4, max(3, groups // per_segment))


def name_user_segments(clustered: DataFrame) -> DataFrame:
    """(cluster, members, means, name) of clustered users."""
    means = clustered.groupBy("cluster").agg(
        F.count("*").alias("users"), F.avg("avg_score").alias("avg_score"), F.avg("review_count").alias("avg_reviews"))
    score, reviews = F.col("avg_score"), F.col("avg_reviews")
    # Names of the segments and their limits.
    name = (F.when((score >= 4.5) & (reviews >= 10), "Super Fans").when(score >= 4.5, "Happy Customers")
            .when(score <= 2.5, "Harsh Critics").when(reviews >= 15, "Prolific Reviewers")
            .otherwise("Moderate Users"))
    return means.withColumn("segment", name)


def name_product_segments(clustered: DataFrame) -> DataFrame:
    """(cluster, members, means, name) of clustered products."""
    means = clustered.groupBy("cluster").agg(
        F.count("*").alias("products"), F.avg("avg_score").alias("avg_score"),
        F.avg("review_count").alias("avg_reviews"), F.avg("score_std").alias("score_std"))
    score, reviews, std = F.col("avg_score"), F.col("avg_reviews"), F.col("score_std")
    # Names of the segments and their limits.
    name = (F.when((score >= 4.5) & (std <= 0.5), "Universally Loved").when(score <= 2.5, "Poorly Received")
            .when(std >= 1.5, "Controversial").when(reviews >= 50, "Popular Products")
            .otherwise("Average Products"))
    return means.withColumn("segment", name)


def name_review_segments(clustered: DataFrame, score: str = "score") -> DataFrame:
    """(cluster, members, means, name) of clustered reviews."""
    means = clustered.groupBy("cluster").agg(
        F.count("*").alias("reviews"), F.avg(score).alias("avg_score"),
        F.avg("review_length").alias("avg_length"), F.avg("sentiment_score").alias("avg_sentiment"))
    length, tone = F.col("avg_length"), F.abs("avg_sentiment")
    # Names of the segments and their limits.
    name = (F.when((length >= 100) & (tone >= 0.3), "Detailed & Emotional").when(length <= 20, "Brief Reviews")
            .when(tone >= 0.5, "Emotional Reviews").when(F.col("avg_score") >= 4.5, "Enthusiastic Reviews")
            .otherwise("Balanced Reviews"))
    return means.withColumn("segment", name)
