"""Rule-based data quality: all row rules of a table in one aggregate pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.expr import all_of, to_time
from reviewlake.operators.ranks import first_occurrence

# Fixed values.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DATE_WORDS = ("date", "time", "created", "updated")
SEVERITY_WEIGHTS = {"critical": 1.0, "high": 0.8, "medium": 0.6, "low": 0.4, "info": 0.2}
EARLIEST = "1900-01-01"

#: A check returns, per column it looks at, the condition a good row meets.
Check = Callable[[DataFrame, "Rule", "Context"], dict[str, Column]]


@dataclass(frozen=True)
class Context:
    """What the checks depend on besides the rows."""

    as_of: Column
    order_by: tuple[str, ...]
    #: Match name parts anywhere (`sentiment_score` counts as a date) instead of whole words.
    anywhere: bool = False


@dataclass(frozen=True)
class Rule:
    """A named check with its type, severity and the share of rows that must pass."""

    name: str
    check_type: str
    severity: str
    check: Check | str
    threshold: float = 0.95
    columns: tuple[str, ...] = field(default=())
    enabled: bool = True
    description: str = ""


def _chosen(df: DataFrame, rule: Rule, detected: Sequence[str]) -> list[str]:
    return [name for name in rule.columns if name in df.columns] if rule.columns else list(detected)


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, dtype in df.dtypes if dtype == "string"]


def date_columns(df: DataFrame, anywhere: bool = False) -> list[str]:
    """Columns named after a date or time."""
    def matches(name: str) -> bool:
        lower = name.lower()
        if anywhere:
            return any(word in lower for word in DATE_WORDS)
        parts = lower.replace("-", "_").split("_")
        return any(word in parts or any(part in (word + "stamp", word + "s") for part in parts) for word in DATE_WORDS)
    return [name for name in df.columns if matches(name)]


def email_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if "email" in name.lower()]


def rating_columns(df: DataFrame, anywhere: bool = False) -> list[str]:
    return [name for name in df.columns if (("rating" in name.lower()) if anywhere else name.lower() == "rating")]


def id_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name.lower() == "id" or name.lower().endswith("_id")]


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def not_null(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
    return {name: F.col(name).isNotNull() for name in _chosen(df, rule, df.columns)}


def not_blank(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
    return {name: F.coalesce(F.trim(F.col(name).cast("string")) != "", F.lit(True))
            for name in _chosen(df, rule, string_columns(df))}


def email_format(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
    return {name: _known(F.col(name).rlike(EMAIL)) for name in _chosen(df, rule, email_columns(df))}


def date_format(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
    types = dict(df.dtypes)
    return {name: to_time(F.col(name), types[name]).isNotNull()
            for name in _chosen(df, rule, date_columns(df, context.anywhere))}


def rating_range(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
    return {name: _known(F.col(name).try_cast("double").between(1, 5))
            for name in _chosen(df, rule, rating_columns(df, context.anywhere))}


def date_range(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
    types = dict(df.dtypes)
    last = context.as_of + F.expr("interval 365 days")
    return {name: _known(to_time(F.col(name), types[name]).between(F.lit(EARLIEST).cast("timestamp"), last))
            for name in _chosen(df, rule, date_columns(df, context.anywhere))}


#: Checks that are not a condition on one row.
CONSISTENT_TYPES = "consistent types"
UNIQUE = "unique"

# Names, kinds, severities and thresholds of the rules.
DEFAULT_RULES = (
    Rule("no_null_values", "completeness", "high", not_null, 0.95),
    Rule("no_empty_strings", "completeness", "medium", not_blank, 0.98),
    Rule("valid_email_format", "validity", "high", email_format, 0.99),
    Rule("valid_date_format", "validity", "high", date_format, 0.99),
    Rule("valid_rating_range", "validity", "critical", rating_range, 0.99),
    Rule("consistent_data_types", "consistency", "high", CONSISTENT_TYPES, 0.99),
    Rule("unique_identifiers", "uniqueness", "critical", UNIQUE, 1.0),
    Rule("reasonable_dates", "timeliness", "medium", date_range, 0.95),
)


def add_rule(rules: Sequence[Rule], rule: Rule) -> tuple[Rule, ...]:
    return (*rules, rule)


def remove_rule(rules: Sequence[Rule], name: str) -> tuple[Rule, ...]:
    return tuple(rule for rule in rules if rule.name != name)


def change_rule(rules: Sequence[Rule], name: str, **changes) -> tuple[Rule, ...]:
    """Enable, disable, re-threshold or point a rule at other columns."""
    return tuple(replace(rule, **changes) if rule.name == name else rule for rule in rules)


def lexical_kind(column: Column) -> Column:
    """What the text of a cell is, as one bit: number 1, boolean 2, date 4, other text 8, blank 0."""
    text = F.trim(column)
    return (F.when(text.isNull() | (text == ""), 0)
            .when(text.try_cast("double").isNotNull(), 1)
            .when(F.lower(text).isin("true", "false"), 2)
            .when(text.rlike(r"^\d{4}-\d{2}-\d{2}") & F.try_to_timestamp(text).isNotNull(), 4)
            .otherwise(8))


def _mixed_columns(df: DataFrame, rule: Rule) -> Column:
    """How many string columns hold more than one kind of value (an aggregate)."""
    mixed = [F.when(F.bit_count(F.bit_or(lexical_kind(F.col(name)))) > 1, 1).otherwise(0)
             for name in _chosen(df, rule, string_columns(df))]
    return sum(mixed, F.lit(0))


def unique_rows(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row: how many rows are the first by `order_by` in every id column.

    Works on the first rows per (column, value) alone; the table is not joined back.
    """
    firsts = first_occurrence(df, columns, order_by)
    in_all = firsts.groupBy(*order_by).agg(F.countDistinct("column").alias("_columns"))
    return in_all.agg(F.count_if(F.col("_columns") == len(columns)).alias("passed_rows"))


def duplicate_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, duplicates): rows beyond the first per value; null is a value like any other."""
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
                      for name in columns])
    counted = (df.select(F.explode(pairs).alias("_pair")).groupBy("_pair.column", "_pair.value")
               .agg((F.count("*") - 1).alias("_extra")))
    return counted.groupBy("column").agg(F.sum("_extra").alias("duplicates"))


def _details(counts: dict[str, Column], what: str) -> Column:
    if not counts:
        return F.lit('{"message":"No columns to check"}')
    return F.to_json(F.struct(
        F.array(*[F.lit(name) for name in counts]).alias("columns_checked"),
        F.struct(*[count.alias(name) for name, count in counts.items()]).alias(what)))


def check_data_quality(df: DataFrame, dataset_name: str = "dataset", rules: Sequence[Rule] = DEFAULT_RULES,
                       as_of: Column | None = None, order_by: Sequence[str] | None = None,
                       anywhere: bool = False) -> DataFrame:
    """Results of all enabled rules, one row each.

    Columns: dataset_name, rule_name, check_type, severity, passed, pass_rate,
    failed_count, total_count, details (JSON). A rule that cannot be evaluated is
    reported as failed. `order_by` says which of several equal ids comes first
    (default: all columns).
    """
    context = Context(F.current_timestamp() if as_of is None else as_of,
                      tuple(order_by or df.columns), anywhere)
    total = F.count("*")
    prepared: list[tuple[Rule, Column, Column]] = []
    for rule in (rule for rule in rules if rule.enabled):
        try:
            if rule.check == UNIQUE:
                columns = _chosen(df, rule, id_columns(df))
                passed = (unique_rows(df, columns, context.order_by).scalar() if columns else total)
                details = _details({name: F.lit(None).cast("bigint") for name in columns}, "duplicate_counts")
            elif rule.check == CONSISTENT_TYPES:
                mixed = _mixed_columns(df, rule)
                passed = F.when(mixed == 0, total).otherwise(F.lit(0).cast("bigint"))
                details = F.to_json(F.struct(mixed.alias("total_issues")))
            else:
                conditions = rule.check(df, rule, context)
                df.select(*conditions.values())  # unresolvable checks fail here
                passed = F.count_if(all_of(conditions.values()))
                details = _details({name: F.count_if(~good) for name, good in conditions.items()}, "failed_counts")
        except Exception as error:  # noqa: BLE001 - a broken rule is a result, not a crash
            passed = F.lit(0).cast("bigint")
            details = F.to_json(F.struct(F.lit(str(error).splitlines()[0]).alias("error")))
        prepared.append((rule, passed, details))
    rows = [F.struct(F.lit(rule.name).alias("rule_name"), F.lit(rule.check_type).alias("check_type"),
                     F.lit(rule.severity).alias("severity"), F.lit(rule.threshold).alias("threshold"),
                     passed.alias("passed_count"), details.alias("details"))
            for rule, passed, details in prepared]
    results = df.agg(total.alias("total_count"), F.array(*rows).alias("_results"))
    rate = F.coalesce(F.try_divide(F.col("passed_count"), F.col("total_count")), F.lit(0.0))
    global_check = F.col("rule_name").isin([rule.name for rule in rules if rule.check == CONSISTENT_TYPES])
    return (results.select("total_count", F.inline("_results"))
            .select(F.lit(dataset_name).alias("dataset_name"), "rule_name", "check_type", "severity",
                    F.when(global_check, F.col("passed_count") == F.col("total_count"))
                    .otherwise(rate >= F.col("threshold")).alias("passed"),
                    rate.alias("pass_rate"),
                    (F.col("total_count") - F.col("passed_count")).alias("failed_count"),
                    "total_count", "details"))


def _weight(severity: Column) -> Column:
    return F.coalesce(*[F.when(severity == name, weight) for name, weight in SEVERITY_WEIGHTS.items()])


def _score_columns() -> list[Column]:
    weight = _weight(F.col("severity"))
    failed = {name: F.count_if(~F.col("passed") & (F.col("severity") == name)).alias(f"{name}_issues")
              for name in ("critical", "high", "medium", "low")}
    score = F.coalesce(F.try_divide(F.sum(F.col("pass_rate") * weight), F.sum(weight)), F.lit(0.0))
    return [score.alias("overall_score"), *failed.values()]


def overall_score(results: DataFrame) -> DataFrame:
    """One row: weighted score and the number of failed rules by severity."""
    return results.agg(*_score_columns())


def quality_metrics(results: DataFrame) -> DataFrame:
    """One row: checks in total, passed, failed and failed by severity, with the score."""
    weight = _weight(F.col("severity"))
    failed = ~F.col("passed")
    return results.agg(
        F.try_divide(F.sum(F.col("pass_rate") * weight), F.sum(weight)).alias("overall_score"),
        F.count("*").alias("total_checks"), F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(failed).alias("failed_checks"),
        F.count_if(failed & (F.col("severity") == "critical")).alias("critical_issues"),
        F.count_if(failed & ~F.col("severity").isin("critical")).alias("warning_issues"))


def score_by(results: DataFrame, column: str) -> DataFrame:
    """Mean pass rate in percent and failed checks per check type or severity."""
    return results.groupBy(column).agg((F.avg("pass_rate") * 100).alias("score"),
                                       F.count_if(~F.col("passed")).alias("failed_checks"))


def report_json(df: DataFrame, results: DataFrame, dataset_name: str = "dataset") -> DataFrame:
    """The whole report as one JSON document: header, score and one entry per rule."""
    entries = results.select(
        "rule_name", "check_type", "severity", "passed", "pass_rate", "failed_count", "total_count", "details")
    # One entry per rule: bounded by the rule list.
    body = entries.agg(F.sort_array(F.collect_list(F.struct(*entries.columns))).alias("check_results"),
                       F.max("total_count").alias("total_rows"), *_score_columns())
    return body.select(F.to_json(F.struct(
        F.lit(dataset_name).alias("dataset_name"), "total_rows", F.lit(len(df.columns)).alias("total_columns"),
        "overall_score", "critical_issues", "high_issues", "medium_issues", "low_issues",
        "check_results")).alias("report"))


def gate(results: DataFrame, reject_threshold: float = 0.05) -> DataFrame:
    """Accept or reject a batch per rule by its share of invalid rows."""
    share = 1 - F.col("pass_rate")
    return results.select("rule_name", share.alias("invalid_share"), (share > reject_threshold).alias("rejected"))


def split_valid(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition, and the others for quarantine."""
    good = _known(condition)
    return df.where(good), df.where(~good)
