"""Text functions against plain Python on awkward texts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake.functions import sentiment
from reviewlake.functions import text as T
from reviewlake.operators.features import extract_basic_text_features


def random_texts() -> list[str]:
    rng = random.Random(3)
    alphabet = "aeiouy bcd EÉé ß.,!?-_@#1 9\t\n  "
    pieces = ["http://x.y/z?a=1", "www.a.b", "joe@mail.com", "@x", "a@", "@@y", "don't", "the", "unhappy", "so, so!", "free", "e", "ee"]
    out = ["", " ", "!!!", "The end.", "a" * 50, "@foo@bar x", "http", "https://only"]
    for _ in range(300):
        words = [rng.choice(pieces) if rng.random() < 0.3 else "".join(rng.choices(alphabet, k=rng.randint(1, 12)))
                 for _ in range(rng.randint(1, 30))]
        out.append(rng.choice(["", " "]) + " ".join(words))
    return out


TEXTS = random_texts()


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").repartition(4).cache()


def values(df, expression) -> list:
    return [row["v"] for row in df.select("id", expression.alias("v")).orderBy("id").collect()]


def syllables(word: str) -> int:
    word = word.lower()
    groups = len(re.findall("[aeiouy]+", word))
    return max(1, groups - word.endswith("e"))


def clean(text: str) -> str:
    text = text.lower()
    text = re.sub(r"http\S+|www\S+|https\S+", "", text)
    text = re.sub(r"\S+@\S+", "", text)
    text = re.sub(r"[^a-zA-Z0-9\s.!?,;:]", "", text)
    return re.sub(r"\s+", " ", text).strip()


def test_words(texts):
    assert values(texts, T.word_count(F.col("t"))) == [len(text.split()) for text in TEXTS]
    found = values(texts, T.avg_word_length(F.col("t")))
    assert found == pytest.approx([sum(map(len, text.split())) / max(len(text.split()), 1) for text in TEXTS])


def test_syllables(texts):
    assert values(texts, T.syllable_count(F.col("t"))) == [sum(map(syllables, text.split())) for text in TEXTS]


def test_clean(texts):
    assert values(texts, T.clean_text(F.col("t"))) == [clean(text) for text in TEXTS]


def test_long_word_is_fast(spark):
    long = spark.range(1).select(F.repeat(F.lit("x"), 2_000_000).alias("t"))
    assert long.select(F.length(T.clean_text(F.col("t")))).first()[0] == 2_000_000


def test_keywords(texts):
    def expected(text: str) -> list[str]:
        words = [word for word in re.split(r"[ .!?,;:]+", clean(text)) if len(word) > 3 and word not in T.STOP_WORDS]
        return [word for word, _ in sorted(Counter(words).items(), key=lambda item: -item[1])[:4]]
    assert values(texts, T.extract_keywords(T.clean_text(F.col("t")), 4)) == [expected(text) for text in TEXTS]


def test_keyword_base_forms(spark):
    df = spark.createDataFrame([("boats boat boats cars",)], "t string")
    words = T.extract_keywords(F.col("t"), 2, lambda token: F.regexp_replace(token, "s$", ""))
    assert df.select(words).first()[0] == ["boat", "car"]


def test_emotions(spark):
    df = spark.createDataFrame([("I am unhappy and sad, not happy",), ("plain",), (None,)], "t string")
    first, second, third = [row[0] for row in df.select(T.detect_emotions(F.col("t"))).collect()]
    assert first["joy"] == pytest.approx(2 / 4) and first["sadness"] == pytest.approx(2 / 4)
    assert sum(second) == 0 and third is None


def test_table_features_match_single_functions(texts):
    rows = extract_basic_text_features(texts, "t").orderBy("id").collect()
    for name, expression in (("word_count", T.word_count(F.col("t"))), ("readability_score", T.flesch_reading_ease(F.col("t"))),
                             ("unique_word_ratio", T.unique_word_ratio(F.col("t"))), ("avg_word_length", T.avg_word_length(F.col("t"))),
                             ("stopword_ratio", T.stopword_ratio(F.col("t")))):
        assert [row[name] for row in rows] == pytest.approx(values(texts, expression)), name
    assert [row["digit_count"] for row in rows] == [len(re.findall(r"\d", text)) for text in TEXTS]
    assert [row["special_char_count"] for row in rows] == [len(re.findall(r"[^a-zA-Z0-9\s]", text)) for text in TEXTS]
    assert [row["capital_ratio"] for row in rows] == pytest.approx(
        [sum(map(str.isupper, text)) / max(len(text), 1) for text in TEXTS])


# Sentiment ----------------------------------------------------------------------------------------

SENTENCES = [
    ("This product is absolutely amazing! I love it so much!", 1), ("Terrible quality, broke after one day.", -1),
    ("Excellent service and fast shipping. Highly recommended!", 1), ("Worst purchase ever. Waste of money.", -1),
    ("Good build but the screen is awful and horrible", -1), ("The box is blue", 0), ("not good", -1), ("", 0)]


def score(spark, *texts: str) -> list[float]:
    df = spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "id int, t string")
    return values(df, sentiment.compound(T.clean_text(F.col("t"))))


def test_signs(spark):
    found = score(spark, *[text for text, _ in SENTENCES])
    assert [(value > 0.05) - (value < -0.05) for value in found] == [sign for _, sign in SENTENCES]


def norm(value: float) -> float:
    return round(value / (value * value + 15) ** 0.5, 4)


def test_rules(spark):
    plain, very, barely, turned, far, stressed, asked, contrast = score(
        spark, "good", "very good", "barely good", "not good", "not so very good", "good!!!!!", "good??", "good but bad")
    assert plain == norm(2)
    assert very == norm(2.293) and barely == norm(1.707)
    assert turned == norm(2 * -0.74)
    assert far == norm(((2 + 0.293) + 0.293 * 0.95) * -0.74)
    assert stressed == norm(2 + 4 * 0.292) and asked == norm(2 + 0.36)
    assert contrast == norm(2 * 0.5 - 2 * 1.5)


def test_phrases_and_neighbours(spark):
    kiss, bomb, twice, stop, least, at_least, never_so, never_it_so, doubt, without = score(
        spark, "a kiss of death", "not the bomb", "to die for to die for", "the bus stop is good", "least good", "at least good",
        "never so good", "never was this good", "without doubt good", "without good")
    assert kiss == norm(-1.5) and bomb == norm(3 * -0.74) and twice == norm(6) and stop == norm(2)
    assert least == norm(2 * -0.74) and at_least == norm(2)
    assert never_so == norm(2.293 * 1.25) and never_it_so == norm(2 * 1.25)
    assert doubt == norm(2) and without == norm(2 * -0.74)


def test_longest_phrases_from_the_left(spark):
    phrases = ["a b", "a b c", "b c d", "c d", "d e"]
    df = spark.createDataFrame([("a b c d e",), ("b c d e",), ("a b d e a",), ("x",), ("",), ("a a b a b c",)], "t string")
    found = [row[0] for row in df.select(sentiment.join_phrases(F.filter(F.split("t", " "), lambda w: w != ""), phrases)).collect()]
    assert found == [["a b c", "d e"], ["b c d", "e"], ["a b", "d e", "a"], ["x"], [], ["a", "a b", "a b c"]]


def test_many_phrases_in_a_long_text(spark):
    import time
    lexicon = sentiment.Lexicon(valence={f"w{at} x{at % 50}": 1.0 for at in range(7500)})
    df = spark.createDataFrame([(" ".join(f"w{at % 7500} x{at % 50}" for at in range(30_000)),)], "c string")
    began = time.monotonic()
    column = sentiment.compound(F.col("c"), lexicon)
    assert time.monotonic() - began < 1
    assert df.select(column).first()[0] == pytest.approx(1, abs=1e-3)


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("splendid\t3.1\t0.5\t[3]\nOdd  one\t1\t1\nmeh\t-0.4\t1\nno number\tx\n")
    lexicon = sentiment.Lexicon.read(spark, str(path))
    df = spark.createDataFrame([("splendid",), ("good",), ("odd one",), ("odd",)], "t string")
    assert [row[0] for row in df.select(sentiment.compound(F.col("t"), lexicon)).collect()] == [norm(3.1), 0.0, norm(1), 0.0]


def test_short_text_is_neutral(spark):
    df = spark.createDataFrame([("good",), (None,), ("good one",)], "t string")
    rows = sentiment.analyze_dataframe(df, "t").collect()
    assert [(row["sentiment_label"], row["sentiment_score"]) for row in rows[:2]] == [("neutral", 0.0)] * 2
    assert rows[0]["emotions"] is None and rows[0]["emotion_joy"] == 0.0 and rows[1]["keywords"] == []
    assert rows[2]["sentiment_label"] == "positive" and rows[2]["word_count"] == 2


def test_subjectivity(spark):
    df = spark.createDataFrame([("good cheap table",), ("table",)], "t string")
    assert [row[0] for row in df.select(sentiment.subjectivity(F.col("t"))).collect()] == [0.5, 0.0]


def test_a_full_size_lexicon_makes_a_small_plan(spark):
    import time
    words = {f"word{at}": (at % 9 - 4) or 1.5 for at in range(7500)}
    lexicon = sentiment.Lexicon(valence=words)
    started = time.monotonic()
    df = spark.createDataFrame([("word4 not word8 unknown",), ("very word3",)], "c string").select(
        sentiment.compound(F.col("c"), lexicon).alias("score"), sentiment.subjectivity(F.col("c"), lexicon).alias("share"))
    assert time.monotonic() - started < 1
    first, second = df.collect()
    total = 1.5 + sentiment.NEGATION_FACTOR * words["word8"]
    assert first["score"] == pytest.approx(total / (total * total + 15) ** 0.5, abs=1e-4) and first["share"] == 0.5
    total = words["word3"] - sentiment.BOOST
    assert second["score"] == pytest.approx(total / (total * total + 15) ** 0.5, abs=1e-4)


def test_a_text_ends_in_the_beginning_of_a_longer_phrase(spark):
    # "a b" is found when three words are asked for, as the text has no third
    df = spark.createDataFrame([("x a b",), ("a b",), ("a b c",), ("a b x",)], "t string")
    found = [row[0] for row in df.select(sentiment.join_phrases(F.split("t", " "), ["a b", "a b c"])).collect()]
    assert found == [["x", "a b"], ["a b"], ["a b c"], ["a b", "x"]]


def test_spread_reads_split_sizes_of_any_unit(spark):
    from reviewlake.session import spread
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("16m", "134217728b", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert spread(spark.range(10), "id").count() == 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cleaned_characters_and_noun_bases(spark):
    """Ranges and endings stand for the negated class and the patterns."""
    every = ["".join(map(chr, [*range(1, 0xd800), *range(0xe000, 0x11000)])), *random_texts()]
    texts = spark.createDataFrame([(text,) for text in every], "t string")
    low = F.lower(T.flatten(F.col("t")))
    kept = F.regexp_replace(T._where(T._where(low, ["http", "www"], "(?:http|www)[^ ]+"), ["@"], "(?<![^ ])[^ ][^ @]*@[^ ]+"), "[^a-z0-9 .!?,;:]+", "")
    assert texts.where(T.clean_text(F.col("t")) != F.trim(F.regexp_replace(kept, " {2,}", " "))).count() == 0
    words = ["", "s", "ss", "is", "ties", "ies", "boxes", "boxes\n", "glasses\r\n", "glass", "bus\u2028", "churches", "as ", "cats", "cat\U0001f600s", "cats\n\n", None]
    found = spark.createDataFrame([(word,) for word in words], "w string").select("w", T.noun_base(F.col("w")).alias("a"), T._noun_base_by_pattern(F.col("w")).alias("b")).collect()
    assert all(row["a"] == row["b"] for row in found) and found[4]["a"] == "ty" and found[6]["a"] == "box" and found[13]["a"] == "cat"
