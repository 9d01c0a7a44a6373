"""Quality rules, scores, profiles and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake import lens
from reviewlake.lens import with_sql
from reviewlake.operators import cleaning, profile, quality, warehouse
from reviewlake.plans.registry import query, rounded, second

AS_OF = "TIMESTAMP '2024-02-01'"


def _as_of():
    return F.lit("2024-02-01").cast("timestamp")


EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# The columns of `dirty` that are checked; row_key and total_votes never have problems.
CHECKED = ["review_id", "user_id", "product_id", "rating", "review_text", "user_email", "created_at",
           "helpful_votes", "total_votes"]


def _dirty(spark, base):
    return lens.dirty(spark, base)


CONDITIONS = {
    "no_null_values": " AND ".join(f"{name} IS NOT NULL" for name in ["row_key", *CHECKED]),
    "no_empty_strings": "coalesce(trim(review_text) <> '', true) AND coalesce(trim(user_email) <> '', true)",
    "valid_email_format": f"regexp_matches(user_email, '{EMAIL}')",
    "valid_date_format": "created_at IS NOT NULL",
    "valid_rating_range": "coalesce(rating BETWEEN 1 AND 5, false)",
    "reasonable_dates": f"coalesce(created_at BETWEEN TIMESTAMP '1900-01-01' AND {AS_OF} + INTERVAL 365 DAY, false)",
}
META = {rule.name: rule for rule in quality.DEFAULT_RULES}


def _rule_sql(name: str, passed: str, source: str = "dirty") -> str:
    rule = META[name]
    return f"""SELECT '{name}' AS rule_name, '{rule.check_type}' AS check_type, '{rule.severity}' AS severity,
      passed / CAST(total AS DOUBLE) >= {rule.threshold} AS passed, round(passed / CAST(total AS DOUBLE), 8) AS pass_rate,
      total - passed AS failed_count, total AS total_count
      FROM (SELECT {passed} AS passed, count(*) AS total FROM {source})"""


def _unique_sql(columns: list[str], order: str) -> str:
    firsts = ", ".join(f"row_number() OVER (PARTITION BY {name} ORDER BY {order}) = 1 AS f{at}"
                       for at, name in enumerate(columns))
    both = " AND ".join(f"f{at}" for at in range(len(columns)))
    return f"marked AS (SELECT {both} AS first FROM (SELECT {firsts} FROM dirty))"


KINDS = """kinds AS (SELECT max(CASE WHEN TRY_CAST(nullif(trim(user_email), '') AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END)
  + max(CASE WHEN TRY_CAST(nullif(trim(user_email), '') AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS emails FROM dirty)"""

RULES_SQL = (with_sql("dirty") + ",\n" + _unique_sql(["review_id", "user_id", "product_id"], "row_key") + ", " + KINDS + "\n"
             + " UNION ALL ".join(_rule_sql(name, f"count(*) FILTER ({condition})")
                                  for name, condition in CONDITIONS.items())
             + " UNION ALL " + _rule_sql("unique_identifiers", "count(*) FILTER (first)", "marked")
             + " UNION ALL " + _rule_sql("consistent_data_types",
                                         "CASE WHEN max(emails) = 1 THEN count(*) ELSE 0 END",
                                         "dirty CROSS JOIN kinds"))
RESULT = ["rule_name", "check_type", "severity", "passed", "pass_rate", "failed_count", "total_count"]


def _results(spark, base):
    rules = quality.change_rule(quality.DEFAULT_RULES, "consistent_data_types", columns=("user_email",))
    return quality.check_data_quality(_dirty(spark, base), "dirty", rules, _as_of(), ["row_key"])


@query("q09_quality_rules", RULES_SQL)
def q09(spark, base):
    return rounded(_results(spark, base).select(*RESULT), "pass_rate")


def _one(name: str):
    number = {"no_null_values": "q01", "no_empty_strings": "q02", "valid_email_format": "q03", "valid_date_format": "q04",
              "valid_rating_range": "q05", "reasonable_dates": "q08"}[name]

    @query(f"{number}_{name}", with_sql("dirty") + "\n" + _rule_sql(name, f"count(*) FILTER ({CONDITIONS[name]})"))
    def run(spark, base):
        results = quality.check_data_quality(_dirty(spark, base), "dirty", [META[name]], _as_of(), ["row_key"])
        return rounded(results.select(*RESULT), "pass_rate")


for _name in CONDITIONS:
    _one(_name)


@query("q01_null_counts", with_sql("dirty") + " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) FILTER ({name} IS NULL) AS missing_count,
        round(count(*) FILTER ({name} IS NULL) * 100.0 / count(*), 8) AS missing_percentage FROM dirty
        HAVING count(*) FILTER ({name} IS NULL) > 0""" for name in CHECKED))
def q01_counts(spark, base):
    return rounded(profile.missing_values(_dirty(spark, base)), "missing_percentage")


def _kinds_sql(name: str, value: str) -> str:
    number = f"TRY_CAST(nullif(trim({value}), '') AS DOUBLE) IS NOT NULL"
    return f"""SELECT '{name}' AS "column", count(DISTINCT {number}) <= 1 AS consistent FROM orders"""


@query("q06_consistent_types", " UNION ALL ".join([
    _kinds_sql("o_orderpriority", "o_orderpriority"), _kinds_sql("o_orderstatus", "o_orderstatus"),
    _kinds_sql("mixed", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderstatus END")]))
def q06(spark, base):
    orders = lens.table(spark, base, "orders").select(
        "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string"))
        .otherwise(F.col("o_orderstatus")).alias("mixed"))
    rules = [quality.Rule(name, "consistency", "high", quality.CONSISTENT_TYPES, 0.99, (name,)) for name in orders.columns]
    results = quality.check_data_quality(orders, "orders", rules, _as_of(), ["mixed"])
    return results.select(F.col("rule_name").alias("column"), F.col("passed").alias("consistent"))


@query("q07_unique_identifiers", with_sql("dirty") + ",\n" + _unique_sql(["review_id", "user_id", "product_id"], "row_key")
       + "\n" + _rule_sql("unique_identifiers", "count(*) FILTER (first)", "marked"))
def q07(spark, base):
    results = quality.check_data_quality(_dirty(spark, base), "dirty", [META["unique_identifiers"]], _as_of(), ["row_key"])
    return rounded(results.select(*RESULT), "pass_rate")


@query("q07_duplicate_counts", with_sql("dirty") + " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) - count(DISTINCT {name}) - CAST(count(*) > count({name}) AS INTEGER)
        AS duplicates FROM dirty""" for name in ("review_id", "user_id", "product_id")))
def q07_counts(spark, base):
    return quality.duplicate_counts(_dirty(spark, base), ["review_id", "user_id", "product_id"])


WEIGHT = "CASE severity WHEN 'critical' THEN 1.0 WHEN 'high' THEN 0.8 WHEN 'medium' THEN 0.6 WHEN 'low' THEN 0.4 ELSE 0.2 END"


@query("q10_overall_score", f"""
SELECT round(sum(pass_rate * {WEIGHT}) / sum({WEIGHT}), 6) AS overall_score,
       count(*) FILTER (NOT passed AND severity = 'critical') AS critical_issues,
       count(*) FILTER (NOT passed AND severity = 'high') AS high_issues,
       count(*) FILTER (NOT passed AND severity = 'medium') AS medium_issues,
       count(*) FILTER (NOT passed AND severity = 'low') AS low_issues FROM ({RULES_SQL})""")
def q10(spark, base):
    return rounded(quality.overall_score(_results(spark, base)), "overall_score", digits=6)


@query("q11_custom_rules", with_sql("dirty") + """
SELECT 'helpful_within_total' AS rule_name, count(*) FILTER (coalesce(helpful_votes <= total_votes, false)) AS passed_rows,
       count(*) AS total_count FROM dirty""")
def q11(spark, base):
    def helpful_within_total(df, rule, context):
        return {"helpful_votes": F.coalesce(F.col("helpful_votes") <= F.col("total_votes"), F.lit(False))}

    rules = quality.add_rule(quality.DEFAULT_RULES, quality.Rule(
        "helpful_within_total", "accuracy", "medium", helpful_within_total, 0.9))
    for rule in quality.DEFAULT_RULES:
        rules = quality.remove_rule(rules, rule.name)
    results = quality.check_data_quality(_dirty(spark, base), "dirty", rules, _as_of(), ["row_key"])
    return results.select("rule_name", (F.col("total_count") - F.col("failed_count")).alias("passed_rows"), "total_count")


@query("a24_quality_metrics", f"""
SELECT round(sum(pass_rate * {WEIGHT}) / sum({WEIGHT}), 6) AS overall_score, count(*) AS total_checks,
       count(*) FILTER (passed) AS passed_checks, count(*) FILTER (NOT passed) AS failed_checks,
       count(*) FILTER (NOT passed AND severity = 'critical') AS critical_issues,
       count(*) FILTER (NOT passed AND severity <> 'critical') AS warning_issues FROM ({RULES_SQL})""")
def a24(spark, base):
    return rounded(quality.quality_metrics(_results(spark, base)), "overall_score", digits=6)


@query("a24_scores_by_type", f"""
SELECT check_type, round(avg(pass_rate) * 100, 6) AS score, count(*) FILTER (NOT passed) AS failed_checks
FROM ({RULES_SQL}) GROUP BY 1""")
def a24_types(spark, base):
    return rounded(quality.score_by(_results(spark, base), "check_type"), "score", digits=6)


@query("k07_report_json", RULES_SQL)
def k07(spark, base):
    df = _dirty(spark, base)
    report = quality.report_json(df, _results(spark, base), "dirty")
    parsed = report.select(F.from_json("report", "check_results array<struct<rule_name string, check_type string, "
                                       "severity string, passed boolean, pass_rate double, failed_count bigint, "
                                       "total_count bigint>>").alias("r")).select(F.inline("r.check_results"))
    return rounded(parsed, "pass_rate")


# Profiles -----------------------------------------------------------------------------------------


@query("q12_quick_score", with_sql("dirty") + f"""
, n AS (SELECT {' + '.join(f"avg(CAST({name} IS NULL AS INTEGER))" for name in CHECKED)} AS rates, count(*) AS total FROM dirty),
d AS (SELECT count(*) AS kinds FROM (SELECT DISTINCT {', '.join(CHECKED)} FROM dirty))
SELECT round((1 - rates / 9.0) * 40 + (1 - (total - kinds) / CAST(total AS DOUBLE)) * 20 + 21.25 + 13.5, 6) AS quality_score
FROM n CROSS JOIN d""")
def q12(spark, base):
    return rounded(profile.quick_score(_dirty(spark, base).select(*CHECKED)), "quality_score", digits=6)


NUMERIC = ["review_id", "user_id", "product_id", "rating", "helpful_votes", "total_votes"]
TYPES = {"review_id": "bigint", "user_id": "bigint", "product_id": "int", "rating": "int", "review_text": "string",
         "user_email": "string", "created_at": "timestamp", "helpful_votes": "int", "total_votes": "int"}


def _profile_sql(name: str) -> str:
    number = f"CAST({name} AS DOUBLE)" if name in NUMERIC else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{name}' AS "column", '{TYPES[name]}' AS type, count(*) FILTER ({name} IS NULL) AS missing,
      round(count(*) FILTER ({name} IS NULL) * 100.0 / count(*), 8) AS missing_percentage,
      round(avg({number}), 8) AS mean, round(stddev_samp({number}), 8) AS std, min({number}) AS minimum,
      max({number}) AS maximum, count(DISTINCT {name}) AS "unique",
      CASE WHEN count(*) FILTER ({name} IS NULL) * 100.0 / count(*) > 50 THEN 'Poor'
           WHEN count(*) FILTER ({name} IS NULL) * 100.0 / count(*) > 20 THEN 'Fair'
           WHEN count(*) FILTER ({name} IS NULL) * 100.0 / count(*) > 5 THEN 'Good' ELSE 'Excellent' END AS grade FROM dirty"""


@query("q13_column_profile", with_sql("dirty") + " UNION ALL ".join(_profile_sql(name) for name in CHECKED))
def q13(spark, base):
    return rounded(profile.column_profile(_dirty(spark, base).select(*CHECKED)), "missing_percentage", "mean", "std")


@query("q14_missing_values", with_sql("dirty") + " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) FILTER ({name} IS NULL) AS missing_count,
        round(count(*) FILTER ({name} IS NULL) * 100.0 / count(*), 8) AS missing_percentage FROM dirty
        HAVING count(*) FILTER ({name} IS NULL) > 0""" for name in CHECKED) + " ORDER BY 2 DESC, 1")
def q14(spark, base):
    return rounded(profile.missing_values(_dirty(spark, base).select(*CHECKED)), "missing_percentage")


KNOWN = " + ".join(f"CAST({name} IS NOT NULL AS INTEGER)" for name in CHECKED)


@query("q15_row_completeness", with_sql("dirty") + f"""
SELECT round(({KNOWN}) * 100 / 9.0, 8) AS completeness, count(*) AS "rows" FROM dirty GROUP BY 1""")
def q15(spark, base):
    return rounded(profile.row_completeness(_dirty(spark, base).select(*CHECKED)), "completeness")


@query("q15_completeness_classes", with_sql("dirty") + f"""
SELECT count(*) FILTER ({KNOWN} = 9) AS complete_rows, count(*) FILTER ({KNOWN} BETWEEN 5 AND 8) AS partial_rows,
       count(*) FILTER ({KNOWN} < 5) AS poor_rows FROM dirty""")
def q15_classes(spark, base):
    return profile.completeness_classes(_dirty(spark, base).select(*CHECKED))


@query("q16_validity_issues", with_sql("dirty") + f"""
SELECT * FROM (
  SELECT 'rating_out_of_range' AS issue, 'rating' AS "column", count(*) FILTER (NOT coalesce(rating BETWEEN 1 AND 5, false)) AS count FROM dirty
  UNION ALL SELECT 'more_helpful_than_votes', 'helpful_votes/total_votes', count(*) FILTER (helpful_votes > total_votes) FROM dirty
  UNION ALL SELECT 'after_today', 'created_at', count(*) FILTER (created_at > {AS_OF}) FROM dirty
  UNION ALL SELECT 'very_long_text', 'review_text', count(*) FILTER (length(review_text) > 10000) FROM dirty)
WHERE count > 0""")
def q16(spark, base):
    return profile.validity_issues(_dirty(spark, base), _as_of()).drop("meaning")


@query("q17_uniqueness", """
WITH r AS (SELECT o_custkey AS user_id, o_orderstatus, o_orderpriority FROM orders)
SELECT 'rows' AS what, (SELECT count(*) FROM r) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r)) AS duplicates
UNION ALL SELECT 'user_id', count(*) - count(DISTINCT user_id) FROM r""")
def q17(spark, base):
    orders = lens.table(spark, base, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderstatus", "o_orderpriority")
    return profile.uniqueness(orders)


@query("q18_issues", """
WITH r AS (SELECT l_quantity, l_extendedprice, l_discount, CASE WHEN l_linenumber > 4 THEN l_tax END AS tax, 1 AS one FROM lineitem)
SELECT 'mostly_missing' AS issue, '' AS "column" FROM r HAVING count(*) FILTER (tax IS NULL) * 100.0 / count(*) > 20
UNION ALL SELECT 'constant', 'one' UNION ALL SELECT 'repeated_rows', '' FROM r
HAVING count(*) > (SELECT count(*) FROM (SELECT DISTINCT * FROM r))
""" + "".join(f"""UNION ALL SELECT 'far_values', '{name}' FROM r, (SELECT quantile_cont({name}, 0.25) AS a,
quantile_cont({name}, 0.75) AS b FROM r) HAVING count(*) FILTER ({name} < a - 1.5 * (b - a) OR {name} > b + 1.5 * (b - a)) > count(*) * 0.05
""" for name in ("l_quantity", "l_extendedprice", "l_discount", "tax", "one")))
def q18(spark, base):
    rows = lens.table(spark, base, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount",
        F.when(F.col("l_linenumber") > 4, F.col("l_tax")).alias("tax"), F.lit(1).alias("one"))
    return profile.quality_issues(rows).select("issue", "column")


@query("q19_lake_quality", with_sql("dirty") + f"""
SELECT count(*) AS row_count, round(1 - sum(9 - ({KNOWN})) / (count(*) * 9.0), 8) AS data_quality_score FROM dirty""")
def q19(spark, base):
    return rounded(profile.null_free_share(_dirty(spark, base).select(*CHECKED)), "data_quality_score")


# Cleaning -----------------------------------------------------------------------------------------


@query("c01_remove_duplicates", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def c01(spark, base):
    return cleaning.remove_duplicates(
        lens.table(spark, base, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


FILLED = """, kept AS (SELECT * FROM dirty WHERE review_id IS NOT NULL),
s AS (SELECT avg(user_id) AS users, median(rating) AS ratings, median(helpful_votes) AS helpful FROM kept),
m AS (SELECT total AS total FROM (SELECT total_votes AS total, count(*) AS n FROM kept WHERE total_votes > 2 GROUP BY 1
      ORDER BY n DESC, 1 LIMIT 1))
SELECT row_key, review_id, round(coalesce(CAST(user_id AS DOUBLE), users), 6) AS user_id,
       CAST(coalesce(rating, ratings) AS DOUBLE) AS rating,
       CAST(coalesce(helpful_votes, helpful) AS DOUBLE) AS helpful_votes,
       CASE WHEN total_votes > 2 THEN total_votes ELSE total END AS total_votes,
       coalesce(CASE WHEN row_key % 9 <> 0 THEN user_email END, 'none@example.com') AS user_email,
       coalesce(CASE WHEN row_key % 17 <> 0 THEN CAST(product_id AS VARCHAR) END, 'Unknown') AS product
FROM kept CROSS JOIN s CROSS JOIN m"""


@query("c02_missing_values", with_sql("dirty") + FILLED)
def c02(spark, base):
    rows = _dirty(spark, base).select(
        "row_key", "review_id", "user_id", "rating", "helpful_votes",
        F.when(F.col("total_votes") > 2, F.col("total_votes")).alias("total_votes"),
        F.when(F.col("row_key") % 9 != 0, F.col("user_email")).alias("user_email"),
        F.when(F.col("row_key") % 17 != 0, F.col("product_id").cast("string")).alias("product"))
    filled = cleaning.handle_missing_values(rows, {
        "review_id": "drop", "user_id": "mean", "rating": "median", "total_votes": "mode",
        "user_email": "none@example.com"})
    return filled.withColumns({"user_id": F.round(F.col("user_id").cast("double"), 6),
                               "rating": F.col("rating").cast("double"),
                               "helpful_votes": F.col("helpful_votes").cast("double")})


@query("c03_clean_text_columns", """
SELECT o_orderkey, regexp_replace(o_orderpriority, '[^\\p{L}\\p{N}_\\s.,!?-]', '', 'g') || '-x' AS priority,
       nullif(regexp_replace(o_orderstatus, 'F', '', 'g'), '') AS status FROM orders""")
def c03(spark, base):
    orders = lens.table(spark, base, "orders").select(
        "o_orderkey", F.concat(F.lit("  "), F.replace("o_orderpriority", F.lit(" "), F.lit(" \t ")), F.lit("-#x@ "))
        .alias("priority"), F.replace("o_orderstatus", F.lit("F"), F.lit("  ")).alias("status"))
    return cleaning.clean_text_columns(orders)


@query("c04_formats", with_sql("dirty") + """
SELECT row_key, lower(trim(user_email)) AS user_email, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM dirty""")
def c04(spark, base):
    rows = _dirty(spark, base).select("row_key", "user_email",
                                      F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))
    return cleaning.standardize_formats(rows).withColumn("created_at", second("created_at"))


@query("c05_outliers", """
WITH a AS (SELECT quantile_cont(o_totalprice, 0.25) AS x, quantile_cont(o_totalprice, 0.75) AS y FROM orders),
one AS (SELECT o_orderkey, o_totalprice, o_totalprice * o_totalprice AS squared FROM orders, a
        WHERE o_totalprice BETWEEN x - 1.5 * (y - x) AND y + 1.5 * (y - x)),
b AS (SELECT quantile_cont(squared, 0.25) AS x, quantile_cont(squared, 0.75) AS y FROM one)
SELECT o_orderkey FROM one, b WHERE squared BETWEEN x - 1.5 * (y - x) AND y + 1.5 * (y - x)""")
def c05(spark, base):
    orders = lens.table(spark, base, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_totalprice") * F.col("o_totalprice")).alias("squared"))
    return cleaning.remove_outliers(orders, ["o_orderkey"]).select("o_orderkey")


WS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
CLEANED = with_sql("dirty") + f"""
, d AS (SELECT DISTINCT * FROM dirty), s AS (SELECT median(rating) AS ratings, median(user_id) AS users,
  median(review_id) AS reviews, median(helpful_votes) AS helpful FROM d)
SELECT row_key, CAST(coalesce(rating, ratings) AS DOUBLE) AS rating, lower(trim(user_email)) AS user_email,
       CAST(coalesce(user_id, users) AS DOUBLE) AS user_id, CAST(coalesce(helpful_votes, helpful) AS DOUBLE) AS helpful_votes,
       length(nullif(regexp_replace(regexp_replace(regexp_replace(review_text, '^[{WS}]+|[{WS}]+$', '', 'g'), '[{WS}]+', ' ', 'g'),
       '[^\\p{{L}}\\p{{N}}_{WS}.,!?-]', '', 'g'), '')) AS text_length
FROM d CROSS JOIN s"""


@query("c06_clean_dataset", CLEANED)
def c06(spark, base):
    cleaned = cleaning.clean_dataset(_dirty(spark, base), {"missing_strategy": {"review_text": "drop"}})
    return cleaned.select("row_key", F.col("rating").cast("double").alias("rating"), "user_email",
                          F.col("user_id").cast("double").alias("user_id"),
                          F.col("helpful_votes").cast("double").alias("helpful_votes"),
                          F.length("review_text").cast("bigint").alias("text_length"))


# Configured rules ---------------------------------------------------------------------------------


@query("n03_format_rules", """
SELECT 'user_id_format' AS rule_name, count(*) FILTER (regexp_matches(c_name, '^[A-Za-z0-9_-]+$')) AS passed_rows FROM customer
UNION ALL SELECT 'product_id_format', count(*) FILTER (c_custkey % 3 <> 0) FROM customer
UNION ALL SELECT 'review_text_length', count(*) FILTER (length(c_name || repeat('x', CAST(c_custkey % 10000 AS INTEGER))) BETWEEN 10 AND 5000)
FROM customer""")
def n03(spark, base):
    key = F.col("c_custkey")
    rows = lens.table(spark, base, "customer").select(
        F.col("c_name").alias("user_id"),
        F.concat(F.when(key % 3 == 0, "P").otherwise("PROD_"), key.cast("string")).alias("product_id"),
        F.concat("c_name", F.repeat(F.lit("x"), (key % 10000).cast("int"))).alias("review_text"))
    results = quality.check_data_quality(rows, "customers", warehouse.FORMAT_RULES, _as_of())
    return results.select("rule_name", (F.col("total_count") - F.col("failed_count")).alias("passed_rows"))


@query("n04_batch_gate", f"""
SELECT rule_name, round(1 - pass_rate, 6) AS invalid_share, 1 - pass_rate > 0.05 AS rejected FROM ({RULES_SQL})""")
def n04(spark, base):
    return rounded(quality.gate(_results(spark, base)), "invalid_share", digits=6)


@query("n04_quarantine", with_sql("dirty") + """
SELECT CASE WHEN user_id IS NOT NULL AND rating IS NOT NULL AND trim(review_text) <> '' AND created_at IS NOT NULL
            THEN 'accepted' ELSE 'quarantined' END AS outcome, count(*) AS "rows" FROM dirty GROUP BY 1""")
def n04_quarantine(spark, base):
    rows = _dirty(spark, base)
    complete = (F.col("user_id").isNotNull() & F.col("rating").isNotNull() & (F.trim("review_text") != "")
                & F.col("created_at").isNotNull())
    good, bad = quality.split_valid(rows, complete)
    return (good.select(F.lit("accepted").alias("outcome")).unionAll(bad.select(F.lit("quarantined").alias("outcome")))
            .groupBy("outcome").agg(F.count("*").alias("rows")))
