"""Quality rules: the two known scores, edge cases and custom rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import cleaning, profile, quality

def as_of():
    return F.lit("2025-01-01").cast("timestamp")


def score(spark, passed: int, total: int) -> float:
    """Score when only unique_identifiers is below 1."""
    rows = [(rule.name, rule.severity, rule.name != "unique_identifiers",
             passed / total if rule.name == "unique_identifiers" else 1.0) for rule in quality.DEFAULT_RULES]
    results = spark.createDataFrame(rows, "rule_name string, severity string, passed boolean, pass_rate double")
    row = quality.overall_score(results).first()
    assert (row["critical_issues"], row["high_issues"]) == (1, 0)
    return row["overall_score"]


def test_known_scores(spark):
    assert score(spark, 59, 900) == pytest.approx(0.8539930555555555, abs=1e-12)
    assert score(spark, 354, 2015) == pytest.approx(0.8712003722084367, abs=1e-12)


@pytest.fixture(scope="module")
def reviews(spark):
    good = datetime(2024, 5, 1)
    rows = [
        (1, 10, 5, "fine text", "a@b.com", good), (2, 10, 0, "  ", "a@b.com", good),
        (3, 11, 6, "x", "broken", datetime(2027, 1, 1)), (4, None, None, None, None, None),
        (5, 12, 3, "y", "c@d.org", datetime(1850, 1, 1)), (5, 12, 3, "y", "c@d.org", datetime(1850, 1, 1))]
    return spark.createDataFrame(rows, "review_id int, user_id int, rating int, review_text string, user_email string, "
                                       "created_at timestamp")


def test_rules(reviews):
    found = {row["rule_name"]: row for row in quality.check_data_quality(reviews, "r", as_of=as_of()).collect()}
    passed = {name: row["total_count"] - row["failed_count"] for name, row in found.items()}
    assert passed == {
        "no_null_values": 5, "no_empty_strings": 5, "valid_email_format": 4, "valid_date_format": 5,
        "valid_rating_range": 3, "consistent_data_types": 6, "unique_identifiers": 4, "reasonable_dates": 2}
    assert not found["unique_identifiers"]["passed"] and found["consistent_data_types"]["passed"]
    assert '"rating":3' in found["valid_rating_range"]["details"]


def test_empty_table_has_rate_zero(reviews):
    found = quality.check_data_quality(reviews.where("false"), "r", as_of=as_of()).collect()
    assert {row["pass_rate"] for row in found} == {0.0}


def test_broken_rule_fails_alone(reviews):
    rules = quality.add_rule(quality.DEFAULT_RULES, quality.Rule(
        "broken", "validity", "low", lambda df, rule, context: {"x": F.col("no_such_column") > 1}))
    found = {row["rule_name"]: row for row in quality.check_data_quality(reviews, "r", rules, as_of()).collect()}
    assert found["broken"]["pass_rate"] == 0.0 and "error" in found["broken"]["details"]
    assert found["no_null_values"]["pass_rate"] == pytest.approx(5 / 6)


def test_rule_list_edits():
    rules = quality.change_rule(quality.DEFAULT_RULES, "no_null_values", enabled=False, threshold=0.5)
    assert not next(rule for rule in rules if rule.name == "no_null_values").enabled
    assert len(quality.remove_rule(rules, "no_null_values")) == len(rules) - 1


def test_date_columns_by_word(spark):
    df = spark.createDataFrame([(1.0, 1)], "sentiment_score double, created_at int")
    assert quality.date_columns(df) == ["created_at"]
    assert quality.date_columns(df, anywhere=True) == ["sentiment_score", "created_at"]


def test_mixed_types(spark):
    df = spark.createDataFrame([("1", "a", "2024-01-01"), ("x", "b", "2024-02-01"), (None, "", None)],
                               "mixed string, text string, day string")
    rules = [quality.Rule(name, "consistency", "high", quality.CONSISTENT_TYPES, 1, (name,)) for name in df.columns]
    found = {row["rule_name"]: row["passed"] for row in quality.check_data_quality(df, "m", rules, as_of()).collect()}
    assert found == {"mixed": False, "text": True, "day": True}


def test_many_columns(spark):
    """A wide table with many text columns stays within a moderate plan."""
    wide = spark.range(5).select(*[F.when(F.col("id") % (i + 2) > 0, F.col("id").cast("string")).alias(f"t{i}_id" if i < 2 else f"t{i}")
                                   for i in range(60)])
    assert quality.check_data_quality(wide, "w", as_of=as_of(), order_by=["t5", "t4"]).count() == 8


# Cleaning -----------------------------------------------------------------------------------------


def test_missing_values_see_earlier_drops(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (None, 100.0, "b"), (2, None, "b"), (3, 3.0, None), (4, 3.0, "a")],
                               "k int, v double, t string")
    rows = cleaning.handle_missing_values(df, {"k": "drop", "v": "median", "t": "mode"}).orderBy("k").collect()
    assert [tuple(row) for row in rows] == [(1, 1.0, "a"), (2, 3.0, "b"), (3, 3.0, "a"), (4, 3.0, "a")]


def test_missing_values_defaults_and_constants(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, True), (None, None, True)], "n int, t string, b boolean")
    rows = cleaning.handle_missing_values(df, {"t": "none"}).collect()
    assert [row["n"] for row in rows] == [1.0, 2.0, 1.5] and [row["t"] for row in rows] == ["a", "none", "none"]
    with pytest.raises(ValueError, match="numeric"):
        cleaning.handle_missing_values(df, {"t": "mean"})


def test_clean_text_spares_mail_and_dates(spark):
    df = spark.createDataFrame([(" A#b  c ", "X@Y.COM ", "2024-01-01 10:00:00")], "t string, email string, created string")
    row = cleaning.clean_dataset(df, {"remove_duplicates": False}).first()
    assert (row["t"], row["email"], row["created"]) == ("Ab c", "x@y.com", datetime(2024, 1, 1, 10))


def test_outliers_column_after_column(spark):
    df = spark.createDataFrame([(float(i), None if i == 3 else float(i % 4)) for i in range(20)] + [(1000.0, 2.0), (5.0, -50.0)],
                               "a double, b double")
    kept = cleaning.remove_outliers(df)
    assert kept.count() == 20 and kept.where("b IS NULL").count() == 1


def test_profile_of_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (1, None), (2, "")], "user_id int, t string")
    assert profile.duplicate_rows(df).first()[0] == 2
    assert {row["what"]: row["duplicates"] for row in profile.uniqueness(df).collect()} == {"rows": 2, "user_id": 3}


def test_insights_read_their_input_once(spark):
    from reviewlake.operators import summaries
    rows = spark.range(30).select((F.col("id") % 5 + 1).cast("int").alias("rating"), (F.col("id") / 30).alias("helpfulness_ratio"),
                                  (F.col("id") * 7).alias("review_length"))
    read = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            read.add(part.num_rows)
            yield part
    found = summaries.review_insights(rows.mapInArrow(seen, rows.schema)).first()
    assert (found["median_length"], found["long_reviews"], found["average_score"]) == (101.5, 15, 3.0) and read.value == 30
