"""Quality measurements against plain Python, policies and ablations against loops."""

import random
import re

from reviewlake.llm import rules

SPACE = " \t\n\x0b\x0c\r"


def plain(text):
    text = text or ""
    words = [word for word in re.split(f"[{SPACE}]+", text) if word]
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    windows = [tuple(words[at:at + 8]) for at in range(len(words) - 7)]
    hit = {at + step for at, window in enumerate(windows) if windows.count(window) > 1 for step in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
            sum(line in lines[:at] for at, line in enumerate(lines)), len(hit))


def texts():
    random.seed(1)
    some = [" ".join(random.choice("ab") for _ in range(random.randint(0, 60))) for _ in range(60)]
    some += ["\n".join(random.choice(["x y", "x y ", " ", "", "é#"]) for _ in range(random.randint(0, 30))) for _ in range(30)]
    return some + [None, "", " \n\t", "a b c", "\x85 x\x1cy", "Z" * 100_000, "ONE TWO " * 400, "日本語 #1"]


def test_measures(spark):
    some = texts()
    df = spark.createDataFrame([(at, text, 5) for at, text in enumerate(some)], "doc_id long, text string, N_words int")
    got = rules.measure(df).collect()
    assert len(got) == len(some)
    for row in got:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_lines, row.n_dup_lines, row.n_repeat_words) == plain(some[row.doc_id])
    assert rules.measure(df.limit(0)).count() == 0


def test_policies_and_ablations(spark):
    some = texts() + ["Clean words stand here one after the other, " * 1 + " ".join(f"word{at}" for at in range(40))]
    df = spark.createDataFrame([(at, text) for at, text in enumerate(some)], "doc_id long, text string")
    judged = rules.apply_policies(rules.ledger(rules.measure(df)), rules.BASE, rules.STANDARD, rules.LENIENT)
    rows = judged.collect()
    for row in rows:
        failed = {name for name in rules.RULES if row.failures & rules.bit(name)}
        assert ("few_words" in failed) == (row.n_words < 20)
        assert ("repeated_windows" in failed) == (100 * row.n_repeat_words > 30 * row.n_words)
        assert row.kept_base_v1 == (not failed & {"few_words", "repeated_windows"})
        assert row.kept_standard_v1 == (not failed)
        assert row.kept_lenient_v1 == (row.kept_base_v1 and len(failed) <= 1)
    assert rows[-1].kept_standard_v1
    for policy in (rules.BASE, rules.STANDARD, rules.LENIENT):
        column = f"kept_{policy.name}_v{policy.version}"
        for fact in rules.ablations(judged, policy).collect():
            left = rules.Policy("x", 1, tuple(n for n in policy.rules if n != fact.rule),
                                tuple(n for n in policy.strict if n != fact.rule), policy.allowed)
            again = rules.apply_policies(judged, left).where("kept_x_v1").count()
            assert fact.kept == sum(row[column] for row in rows) and fact.kept_without == again
            assert fact.failed == sum(bool(row.failures & rules.bit(fact.rule)) for row in rows)


def test_bits_are_stable():
    assert list(rules.RULES)[:2] == ["few_words", "repeated_windows"] and rules.bit("symbols") == 4
