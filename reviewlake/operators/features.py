"""Feature engineering for reviews: text, time, user, product, interaction, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import dates, text as T
from reviewlake.functions.expr import cut, flag, pearson, pick, smoothed_ratio, to_time, whole_days
from reviewlake.operators.cleaning import numeric_columns
from reviewlake.operators.ranks import Runs, by_number, dense_rank_of_counts, numbered, quantile_values, rolling_table
from reviewlake.session import materialize

INF = float("inf")


@dataclass(frozen=True)
class FeatureConfig:
    """Switches of `engineer_features`."""

    enable_text_features: bool = True
    enable_tfidf_features: bool = True
    enable_topic_modeling: bool = True
    max_tfidf_features: int = 1000
    num_topics: int = 10
    enable_temporal_features: bool = True
    enable_user_features: bool = True
    enable_product_features: bool = True
    enable_interaction_features: bool = True
    enable_statistical_features: bool = True


def extract_basic_text_features(df: DataFrame, text_column: str = "review_text") -> DataFrame:
    """12 text measures, computed in the scan stage.

    The flattened text, its lower-case form and its words are made once and shared.
    """
    text = F.col(text_column)
    staged = (df.withColumn("_flat", T.flatten(text)).withColumn("_lower", F.lower("_flat"))
              .withColumn("_words", T.split_flat(F.col("_lower"))))
    n = F.size("_words")
    staged = staged.withColumns({
        "text_length": F.length(text), "word_count": n, "sentence_count": T.sentence_count(text),
        "_syllables": T.syllables_of_flat(F.col("_lower")),
        "avg_word_length": F.when(n > 0, (F.length("_flat") - n + 1) / n).otherwise(0.0),
        "exclamation_count": T.occurrences(text, "!"), "question_count": T.occurrences(text, r"\?"),
        "capital_ratio": T.capital_ratio(text), "digit_count": T.occurrences(text, r"\p{Nd}"),
        "special_char_count": T.special_char_count(text),
        "unique_word_ratio": T.unique_ratio(F.col("_words")), "stopword_ratio": T.stop_ratio(F.col("_words"))})
    return staged.withColumn("readability_score", T.reading_ease(
        F.col("word_count"), F.col("sentence_count"), F.col("_syllables"))).drop(
        "_flat", "_lower", "_words", "_syllables")


def extract_temporal_features(df: DataFrame, date_column: str = "created_at") -> DataFrame:
    """17 calendar, cycle, age and season columns."""
    ts = F.col(date_column)
    latest = df.agg(F.max(date_column)).scalar()
    return df.withColumns({**dates.calendar(ts), **dates.age(ts, latest), **dates.seasons(ts)})


def _rating_stats(prefix: str, rating: str | None, key: str) -> list[Column]:
    columns = [F.count(key).alias(f"{prefix}_review_count")]
    if rating:
        columns += [F.bround(F.avg(rating), 3).alias(f"{prefix}_avg_rating"),
                    F.coalesce(F.bround(F.stddev_samp(rating), 3), F.lit(0.0)).alias(f"{prefix}_rating_std"),
                    F.min(rating).alias(f"{prefix}_min_rating"), F.max(rating).alias(f"{prefix}_max_rating")]
    return columns


def user_features(df: DataFrame, user: str = "user_id", rating: str | None = "rating",
                  date: str | None = "created_at") -> DataFrame:
    """One row per user: counts, rating statistics, flags, activity span, experience level."""
    columns = _rating_stats("user", rating, user)
    if date:
        span = whole_days(F.max(date), F.min(date))
        columns += [span.alias("user_activity_span_days"),
                    (F.count(date) / (span + 1)).alias("user_review_frequency")]
    stats = df.where(F.col(user).isNotNull()).groupBy(user).agg(*columns)
    extra = {"user_experience_level": cut(F.col("user_review_count"), [0, 2, 5, 10, INF],
                                          ["novice", "casual", "regular", "expert"])}
    if rating:
        extra |= {"user_rating_range": F.col("user_max_rating") - F.col("user_min_rating"),
                  "user_is_harsh_reviewer": flag(F.col("user_avg_rating") < 3),
                  "user_is_generous_reviewer": flag(F.col("user_avg_rating") > 4)}
    return stats.withColumns(extra)


def extract_user_features(df: DataFrame, user: str = "user_id", rating: str | None = "rating",
                          date: str | None = "created_at") -> DataFrame:
    """User features on every row (null where the user is unknown)."""
    return df.join(user_features(df, user, rating, date), user, "left")


def product_features(df: DataFrame, product: str = "product_id", rating: str | None = "rating",
                     date: str | None = "created_at") -> DataFrame:
    """One row per product: counts, rating statistics, flags, popularity rank, age, size class."""
    columns = _rating_stats("product", rating, product)
    if date:
        columns += [F.min(date).alias("_first"), F.max(date).alias("_last")]
    stats = df.where(F.col(product).isNotNull()).groupBy(product).agg(*columns)
    extra = {"product_category": cut(F.col("product_review_count"), [0, 5, 20, 50, INF],
                                     ["niche", "moderate", "popular", "bestseller"])}
    if rating:
        mean, std = F.col("product_avg_rating"), F.col("product_rating_std")
        extra |= {"product_rating_range": F.col("product_max_rating") - F.col("product_min_rating"),
                  "product_is_controversial": flag(std > 1.5), "product_is_highly_rated": flag(mean > 4),
                  "product_is_poorly_rated": flag(mean < 2.5)}
    if date:
        latest = df.agg(F.max(date)).scalar()
        extra |= {"product_age_days": whole_days(latest, F.col("_first")),
                  "product_days_since_last_review": whole_days(latest, F.col("_last"))}
    ranked = dense_rank_of_counts(stats.withColumns(extra), "product_review_count", "product_popularity_rank")
    return ranked.drop("_first", "_last")


def extract_product_features(df: DataFrame, product: str = "product_id", rating: str | None = "rating",
                             date: str | None = "created_at") -> DataFrame:
    """Product features on every row (null where the product is unknown)."""
    return df.join(product_features(df, product, rating, date), product, "left")


def extract_interaction_features(df: DataFrame) -> DataFrame:
    """Combinations of text, rating, user, product and time columns, as far as they are present."""
    have = set(df.columns)
    extra: dict[str, Column] = {}
    if {"word_count", "rating"} <= have:
        words, rating = F.col("word_count"), F.col("rating")
        median = quantile_values(df, ["word_count"], [0.5])["word_count"].get(0.5)
        long = words > F.lit(median)
        extra |= {"word_count_rating_ratio": words / (rating + 1),
                  "is_detailed_positive": flag(long & (rating >= 4)),
                  "is_detailed_negative": flag(long & (rating <= 2))}
    if {"user_avg_rating", "product_avg_rating"} <= have:
        gap = F.col("user_avg_rating") - F.col("product_avg_rating")
        extra |= {"user_product_rating_diff": gap, "user_harsher_than_average": flag(gap < -0.5),
                  "user_more_generous_than_average": flag(gap > 0.5)}
    if {"days_since_latest", "rating"} <= have:
        extra["recent_review_rating_interaction"] = F.col("rating") * F.exp(-F.col("days_since_latest") / 30)
    if {"readability_score", "word_count"} <= have:
        extra["complexity_score"] = F.col("word_count") / (F.col("readability_score") + 1)
    return df.withColumns(extra)


def zscores_and_outliers(df: DataFrame, columns: Sequence[str], quartiles: dict[str, dict[float, float]] | None = None) -> DataFrame:
    """z-score (null for a constant column) and 1.5 IQR flag per column; all statistics are read once.

    `quartiles` are those of `quantile_values`, if they are known.
    """
    moments = df.agg(*[aggregate for name in columns for aggregate in (
        F.avg(name).alias(f"{name}_m"), F.stddev_samp(name).alias(f"{name}_s"))]).first()
    quartiles = quantile_values(df, columns, [0.25, 0.75]) if quartiles is None else quartiles
    extra: dict[str, Column] = {}
    for name in columns:
        mean, std = moments[f"{name}_m"], moments[f"{name}_s"]
        value = F.col(name)
        extra[f"{name}_zscore"] = (value - F.lit(mean)) / F.lit(std) if std else F.lit(None).cast("double")
        if quartiles[name]:
            low, high = quartiles[name][0.25], quartiles[name][0.75]
            reach = 1.5 * (high - low)
            extra[f"{name}_is_outlier"] = flag((value < low - reach) | (value > high + reach))
        else:
            extra[f"{name}_is_outlier"] = F.lit(0)
    return df.withColumns(extra)


def _statistical_features(rows: DataFrame, columns: Sequence[str] | None, order: Sequence[str] | None) -> list[DataFrame]:
    """Rows with `_at` and their z-scores and flags, and what else there is for each `_at`."""
    if columns is None:
        columns = [name for name in numeric_columns(rows) if not name.endswith("_id") and name not in ("rating", "_at", "_place")]
    found = [rows]
    if columns:
        runs = Runs(rows, columns)
        found = [zscores_and_outliers(rows, columns, runs.quantiles([0.25, 0.75])), runs.ranks()]
    if {"created_at", "rating"} <= set(rows.columns):
        found.append(rolling_table(rows, "rating", order or ["created_at"], 7))
    return found


def extract_statistical_features(df: DataFrame, columns: Sequence[str] | None = None,
                                 order: Sequence[str] | None = None) -> DataFrame:
    """z-score, percentile rank and outlier flag of every number but ids and the rating;
    rolling rating figures when there is a `created_at`.
    """
    return by_number(*_statistical_features(numbered(df), columns, order))


def engineer_features(df: DataFrame, text_column: str = "review_text", user_column: str = "user_id",
                      product_column: str = "product_id", rating_column: str = "rating",
                      date_column: str = "created_at", config: FeatureConfig | None = None,
                      order: Sequence[str] | None = None, statistics: Sequence[str] | None = None) -> DataFrame:
    """All feature groups in order: text, tf-idf, topics, time, user, product, interaction, statistics.

    tf-idf stays one vector column. `statistics` limits the columns of the last
    group; `order` makes its rolling figures independent of ties in time.

    Rows are numbered and stored with the text measures. The other groups work on numbers, keys and dates alone; texts,
    vectors and whatever else the rows hold meet them in one join at the end.
    """
    config = config or FeatureConfig()
    have = set(df.columns)
    rating = rating_column if rating_column in have else None
    date = date_column if date_column in have else None
    result, tables = df, []
    models = text_column in have and (config.enable_tfidf_features or config.enable_topic_modeling)
    if text_column in have and config.enable_text_features:
        result = extract_basic_text_features(result, text_column)
    if models:
        from reviewlake.operators import text_models
        result = result.withColumn("_plain", text_models.plain_words(F.col(text_column)))
    # Written once: models, medians, moments and ranks of the later groups read the rows several times.
    rows = numbered(result)
    names = [name for name in rows.columns if name not in ("_at", "_plain")]
    keys = {user_column, product_column, rating_column, date_column, "created_at", "rating", "word_count", "readability_score",
            "days_since_latest", "user_avg_rating", "product_avg_rating", *(order or ()), *(statistics or ())}
    light = [name for name in names if name in keys or name in numeric_columns(rows)]
    heavy = rows.select("_at", *[name for name in names if name not in light])
    result = rows.select("_at", *light)
    if models:
        counted = text_models.counted_words(rows.select("_at", "_plain"), config.max_tfidf_features if config.enable_tfidf_features else 0,
                                            config.enable_topic_modeling)
        if config.enable_tfidf_features:
            tfidf = text_models.extract_tfidf_features(counted, text_column, config.max_tfidf_features, counts="_terms")[0]
            heavy = heavy.join(tfidf.select("_at", "tfidf"), "_at", "left")
            names.append("tfidf")
        if config.enable_topic_modeling:
            topics = text_models.extract_topic_features(counted, text_column, config.num_topics, counts="_topic_terms")
            topics = topics.drop(*[name for name in counted.columns if name != "_at"])
            result = result.join(topics, "_at", "left")
            names += topics.columns[1:]
    if date and config.enable_temporal_features:
        result = extract_temporal_features(result, date)
    if user_column in have and config.enable_user_features:
        result = extract_user_features(result, user_column, rating, date)
    if product_column in have and config.enable_product_features:
        result = extract_product_features(result, product_column, rating, date)
    if config.enable_interaction_features or config.enable_statistical_features:
        # Written once: the joins stand behind all that is read of the rows from here on.
        result = materialize(result.withColumn("_place", F.monotonically_increasing_id()), "joined")
    if config.enable_interaction_features:
        result = extract_interaction_features(result)
    if config.enable_statistical_features:
        result, *tables = _statistical_features(result, statistics, order)
    first = result.columns[:result.columns.index("_at")]  # keys of joins stand first
    for table in tables:
        result = result.join(table, "_at", "left")
    last = [name for name in result.columns if name not in {"_at", "_place", *first, *names}]
    return result.join(heavy, "_at", "left").select(*first, *[name for name in names if name not in first], *last)


def feature_importance(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                       chunk: int = 60) -> DataFrame:
    """(feature, correlation, variance, missing_ratio, importance_score), best first, nulls last.

    One aggregate per `chunk` columns keeps the generated code small.
    """
    columns = list(columns or [name for name in numeric_columns(df) if name != target])
    y = F.col(target).cast("double")
    result = None
    for start in range(0, len(columns), chunk):
        entries = []
        for name in columns[start:start + chunk]:
            x = F.col(name).cast("double")
            entries.append(F.struct(
                F.lit(name).alias("feature"), F.abs(pearson(x, y)).alias("correlation"),
                F.var_samp(x).alias("variance"),
                (F.count_if(x.isNull()) / F.count("*")).alias("missing_ratio")))
        part = df.agg(F.array(*entries).alias("_f")).select(F.inline("_f"))
        result = part if result is None else result.unionByName(part)
    score = F.col("correlation") * (1 - F.col("missing_ratio")) * F.least(F.lit(1.0), F.col("variance"))
    return result.withColumn("importance_score", score).orderBy(F.desc_nulls_last("importance_score"), "feature")


def select_top_features(df: DataFrame, target: str, top_k: int = 50,
                        columns: Sequence[str] | None = None) -> DataFrame:
    """The `top_k` most important features."""
    return feature_importance(df, target, columns).limit(top_k)


def review_insight_features(df: DataFrame) -> DataFrame:
    """Helpfulness, lengths, date parts, rating flags and sentiment classes, found by column name."""
    names, types = df.columns, dict(df.dtypes)
    helpful = pick(names, ["helpfulnessnumerator", "helpful_votes"])
    votes = pick(names, ["helpfulnessdenominator", "total_votes"])
    text = pick(names, ["text", "review_text", "review"])
    summary = pick(names, ["summary", "title", "headline"])
    time = pick(names, ["time", "timestamp", "created_at", "review_date"])
    score = pick(names, ["score", "rating", "stars"])
    extra: dict[str, Column] = {}
    if helpful and votes:
        extra["helpfulness_ratio"] = smoothed_ratio(F.col(helpful), F.col(votes))
    if text:
        extra |= {"review_length": T.word_count(F.col(text)), "review_char_count": F.length(text)}
    if summary:
        extra["summary_length"] = T.word_count(F.col(summary))
    if time:
        ts = to_time(F.col(time), types[time])
        extra |= {"review_date": ts, "review_year": F.year(ts), "review_month": F.month(ts),
                  "review_day_of_week": dates.day_of_week(ts)}
    if score:
        number = F.col(score).try_cast("double")
        extra |= {"is_positive": flag(number >= 4), "is_negative": flag(number <= 2)}
    if "sentiment_score" in names:
        extra |= {"sentiment_magnitude": F.abs("sentiment_score"),
                  "sentiment_category": cut(F.col("sentiment_score"), [-1, -0.1, 0.1, 1],
                                            ["Negative", "Neutral", "Positive"])}
    return df.withColumns(extra)
