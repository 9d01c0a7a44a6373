"""Quality rules as a ledger of failure bits, judged by versioned policies and compared by bitwise aggregation."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns

#: Words of a window that counts as repeated when a text has it twice.
WINDOW = 8

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "n_upper bigint, n_lower bigint, n_letters bigint")

SYMBOLS, SPACES = list(b"#*$%&|<>"), list(b" \t\n\x0b\x0c\r")
UPPER, LOWER = list(range(65, 91)), list(range(97, 123))


def repeated_words(words: list[bytes], window: int) -> int:
    """Words in windows that the text has twice or more, the first time included."""
    size = len(words) - window + 1
    if size < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words], np.uint64)
    if len(number) == len(words):
        return 0
    keys = np.zeros(size, np.uint64)
    for step in range(window):
        keys = (keys ^ keys >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + ids[step:step + size]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    suspects = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    places: dict[tuple, list[int]] = {}  # equal digests are confirmed by their words
    for at in suspects:
        places.setdefault(tuple(ids[at:at + window].tolist()), []).append(at)
    change = np.zeros(len(words) + 1, np.int64)
    for each in places.values():
        if len(each) > 1:
            np.add.at(change, each, 1)
            np.add.at(change, np.array(each) + window, -1)
    return int((np.cumsum(change) > 0).sum())


def measure(df: DataFrame, text: str = "text", window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """Adds the measurements of each whole text; null and empty texts have zeros.

    Words are runs of characters other than space and x09-x0D; lines are parts between line feeds, of which those
    with a word count. n_upper and n_lower are A-Z and a-z, n_letters these and all non-ASCII characters. Row for row,
    without shuffle; repeated rows stay and columns named like new ones are replaced.
    """
    def start():
        def rows(texts):
            return tuple(zip(*[_measure(value or "", window) for value in texts])) or ([],) * 9
        return rows
    return add_columns(df, [text], MEASURES, start, keep)


def _measure(text: str, window: int) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [line for line in data.split(b"\n") if line.strip()]
    upper, lower = int(counts[UPPER].sum()), int(counts[LOWER].sum())
    return (len(words), len(text) - int(counts[SPACES].sum()), int(counts[SYMBOLS].sum()), len(lines),
            len(lines) - len(set(lines)), repeated_words(words, window), upper, lower,
            upper + lower + int(counts[0xC0:].sum()))


def share(part: str, whole: str, percent: int) -> Column:
    """part is over `percent` % of whole."""
    return 100 * F.col(part) > percent * F.col(whole)


#: Rules in the order of their bits, which never changes: new rules go to the end. True where a text fails.
RULES: dict[str, Column | object] = {
    "few_words": lambda: F.col("n_words") < 20,
    "repeated_windows": lambda: share("n_repeat_words", "n_words", 30),
    "symbols": lambda: share("n_symbols", "word_chars", 3),
    "repeated_lines": lambda: share("n_dup_lines", "n_lines", 30),
    "upper_case": lambda: 100 * F.col("n_upper") > 60 * (F.col("n_upper") + F.col("n_lower")),
    "short_words": lambda: F.col("word_chars") < 2 * F.col("n_words"),
    "long_words": lambda: F.col("word_chars") > 15 * F.col("n_words"),
    "few_letters": lambda: 2 * F.col("n_letters") < F.col("word_chars"),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def ledger(measured: DataFrame) -> DataFrame:
    """Adds failures: the sum of the bits of the rules that the row's measurements fail. Each rule runs once."""
    failed = F.lit(0).cast("bigint")
    for name, rule in RULES.items():
        failed = failed.bitwiseOR(F.when(rule(), F.lit(bit(name))).otherwise(F.lit(0)).cast("bigint"))
    return measured.withColumn("failures", failed)


@dataclass(frozen=True)
class Policy:
    """Which rules count, and how many of them a kept row may fail; a row that fails a `strict` rule goes anyway."""

    name: str
    version: int
    rules: tuple[str, ...]
    strict: tuple[str, ...] = field(default=())
    allowed: int = 0

    def keeps(self, failures: Column, without: str | None = None) -> Column:
        strict = sum(bit(name) for name in self.strict if name != without)
        counted = sum(bit(name) for name in set(self.rules) | set(self.strict) if name != without)
        return (failures.bitwiseAND(F.lit(strict)) == 0) & (F.bit_count(failures.bitwiseAND(F.lit(counted))) <= self.allowed)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(RULES), strict=("few_words", "repeated_windows"))
LENIENT = Policy("lenient", 1, tuple(RULES), strict=("few_words", "repeated_windows"), allowed=1)


def apply_policies(judged: DataFrame, *policies: Policy) -> DataFrame:
    """Adds a boolean for each policy, named kept_<name>_v<version>, from the stored failure bits alone."""
    return judged.withColumns({f"kept_{policy.name}_v{policy.version}": policy.keeps(F.col("failures")) for policy in policies})


def ablations(judged: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: rows that fail it, rows that fail no other counted rule, rows kept without it.

    Rows are first counted by failure bits, so that at most 2^rules rows are compared with the rules.
    """
    counts = judged.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    names = [name for name in RULES if name in policy.rules or name in policy.strict]
    counted = sum(bit(name) for name in names)
    kept = F.when(policy.keeps(F.col("failures")), F.col("n")).otherwise(0)
    facts = F.array(*[F.struct(
        F.lit(name).alias("rule"),
        F.when(F.col("failures").bitwiseAND(F.lit(bit(name))) != 0, F.col("n")).otherwise(0).alias("failed"),
        F.when(F.col("failures").bitwiseAND(F.lit(counted)) == bit(name), F.col("n")).otherwise(0).alias("failed_alone"),
        kept.alias("kept"),
        F.when(policy.keeps(F.col("failures"), name), F.col("n")).otherwise(0).alias("kept_without")) for name in names])
    return counts.select(F.explode(facts).alias("fact")).groupBy("fact.rule").agg(
        *[F.sum(f"fact.{name}").alias(name) for name in ("failed", "failed_alone", "kept", "kept_without")])
