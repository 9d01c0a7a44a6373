"""Scalar functions, text measures, sentiment and text models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlake import lens
from reviewlake.functions import dates, expr, sentiment
from reviewlake.functions import text as T
from reviewlake.lens import with_sql
from reviewlake.operators import features, quality, summaries, text_models
from reviewlake.operators.documents import parse_instant, text_search
from reviewlake.plans.registry import query, r8, rounded
from reviewlake.session import materialize, scratch_path, spread

# SQL pieces ---------------------------------------------------------------------------------------

WS = r"\t-\r\x1c-\x20\x{85}\p{Z}"


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{WS}]+'), lambda w: w <> '')"


def count_sql(text: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '{pattern}')) AS INTEGER)"


def in_sql(values) -> str:
    return "(" + ", ".join("'" + value.replace("'", "''") + "'" for value in values) + ")"


SENTENCES = "CAST(length(text) - length(translate(text, '.!?', '')) AS INTEGER)"
SYLLABLES = ("CAST(coalesce(list_sum(list_transform(" + words_sql("lower(text)") + ", lambda w: greatest(1, "
             "len(regexp_extract_all(w, '[aeiouy]+')) - CASE WHEN w LIKE '%e' THEN 1 ELSE 0 END))), 0) AS INTEGER)")
CLEAN = (f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), "
         f"'(http|www)[^{WS}]+', '', 'g'), '[^{WS}]+@[^{WS}]+', '', 'g'), "
         f"'[^a-z0-9{WS}.!?,;:]', '', 'g'), '[{WS}]+', ' ', 'g'))")


def _documents(spark, base):
    return spread(lens.docs(spark, base), "review_id")


def _text(name: str, expression, sql: str, digits: int | None = None):
    """A query of one text function over all documents."""
    twin = f"SELECT doc_id AS review_id, {sql if digits is None else f'round({sql}, {digits})'} AS value FROM documents"

    @query(name, twin)
    def run(spark, base):
        value = expression(F.col("review_text"))
        return _documents(spark, base).select(
            "review_id", (value if digits is None else F.round(value, digits)).alias("value"))


_text("f01_text_length", F.length, "CAST(length(text) AS INTEGER)")
_text("f01_word_count", T.word_count, f"CAST(len({words_sql('text')}) AS INTEGER)")
_text("f01_mark_counts", lambda text: T.occurrences(text, "!") + T.occurrences(text, r"\?")
      + T.occurrences(text, r"\p{Nd}"), count_sql("text", r"[!?\p{Nd}]"))
_text("f02_avg_word_length", T.avg_word_length,
      f"coalesce(list_avg(list_transform({words_sql('text')}, lambda w: length(w))), 0)", 8)
_text("f03_capital_ratio", T.capital_ratio,
      "CASE WHEN length(text) > 0 THEN len(regexp_extract_all(text, '\\p{Lu}')) / CAST(length(text) AS DOUBLE) ELSE 0 END", 8)
_text("f04_special_chars", T.special_char_count, count_sql("text", f"[^a-zA-Z0-9{WS}]"))
_text("f05_sentence_count", T.sentence_count, SENTENCES)
_text("f06_syllables", T.syllable_count, SYLLABLES)
_text("f07_reading_ease", T.flesch_reading_ease,
      f"CASE WHEN {SENTENCES} > 0 AND len({words_sql('text')}) > 0 THEN greatest(0.0, least(100.0, 206.835 - 1.015 * "
      f"len({words_sql('text')}) / CAST({SENTENCES} AS DOUBLE) - 84.6 * {SYLLABLES} / CAST(len({words_sql('text')}) AS DOUBLE))) "
      f"ELSE 0.0 END", 9)
_text("f08_unique_word_ratio", T.unique_word_ratio,
      f"coalesce(len(list_distinct({words_sql('lower(text)')})) / nullif(CAST(len({words_sql('text')}) AS DOUBLE), 0), 0)", 8)
_text("f09_stopword_ratio", T.stopword_ratio,
      f"coalesce(len(list_filter({words_sql('lower(text)')}, lambda w: w IN {in_sql(T.STOP_WORDS)})) "
      f"/ nullif(CAST(len({words_sql('text')}) AS DOUBLE), 0), 0)", 8)
_text("f16_clean_text", T.clean_text, CLEAN)
_text("f16_tidy_text", T.tidy_text,
      f"nullif(regexp_replace(regexp_replace(regexp_replace(text, '^[{WS}]+|[{WS}]+$', '', 'g'), '[{WS}]+', ' ', 'g'), "
      f"'[^\\p{{L}}\\p{{N}}_{WS}.,!?-]', '', 'g'), '')")
_text("f22_short_id", expr.short_id, "substr(md5(text), 1, 8)")


@query("f05_sentences_by_boundary")
def f05_boundary(spark, base):
    return _documents(spark, base).select(
        "review_id", T.sentence_count_by_boundary(F.col("review_text")).alias("sentences"))


CALENDAR_SQL = """CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
  CAST(week(ts) AS INTEGER) AS week_of_year, CAST(quarter(ts) AS INTEGER) AS quarter"""
CYCLES_SQL = """round(sin(2 * pi() * month(ts) / 12), 8) AS month_sin, round(cos(2 * pi() * month(ts) / 12), 8) AS month_cos,
  round(sin(2 * pi() * (isodow(ts) - 1) / 7), 8) AS day_of_week_sin,
  round(cos(2 * pi() * (isodow(ts) - 1) / 7), 8) AS day_of_week_cos"""
SEASONS_SQL = """CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend, CAST(month(ts) IN (11, 12) AS INTEGER) AS is_holiday_season,
  CAST(month(ts) IN (6, 7, 8) AS INTEGER) AS is_summer"""


@query("f10_calendar", f"SELECT o_orderkey, {CALENDAR_SQL} FROM (SELECT o_orderkey, o_orderdate AS ts FROM orders)")
def f10(spark, base):
    parts = dates.calendar(F.col("o_orderdate"))
    return lens.table(spark, base, "orders").select("o_orderkey", *[
        value.alias(name) for name, value in parts.items() if "sin" not in name and "cos" not in name])


@query("f11_cycles", f"SELECT o_orderkey, {CYCLES_SQL} FROM (SELECT o_orderkey, o_orderdate AS ts FROM orders)")
def f11(spark, base):
    parts = dates.calendar(F.col("o_orderdate"))
    return lens.table(spark, base, "orders").select("o_orderkey", *[
        r8(value).alias(name) for name, value in parts.items() if "sin" in name or "cos" in name])


@query("f12_age", """
WITH d AS (SELECT event_id, CAST(floor(date_diff('microsecond', ts, (SELECT max(ts) FROM events)) / 86400000000.0) AS BIGINT)
           AS days FROM events)
SELECT event_id, days AS days_since_latest, round(days / 7.0, 8) AS weeks_since_latest,
       round(days / CAST(30.44 AS DOUBLE), 8) AS months_since_latest FROM d""")
def f12(spark, base):
    events = lens.table(spark, base, "events")
    parts = dates.age(F.col("ts"), events.agg(F.max("ts")).scalar())
    return rounded(events.select("event_id", *[value.alias(name) for name, value in parts.items()]),
                   "weeks_since_latest", "months_since_latest")


@query("f13_seasons", f"SELECT o_orderkey, {SEASONS_SQL} FROM (SELECT o_orderkey, o_orderdate AS ts FROM orders)")
def f13(spark, base):
    parts = dates.seasons(F.col("o_orderdate"))
    return lens.table(spark, base, "orders").select("o_orderkey", *[value.alias(name) for name, value in parts.items()])


@query("f14_bins", with_sql("product_ratings") + """
SELECT CASE WHEN sentiment_score > -1 AND sentiment_score <= -0.1 THEN 'Negative'
            WHEN sentiment_score > -0.1 AND sentiment_score <= 0.1 THEN 'Neutral'
            WHEN sentiment_score > 0.1 AND sentiment_score <= 1 THEN 'Positive' END AS sentiment_category,
       count(*) AS reviews FROM product_ratings GROUP BY 1""")
def f14(spark, base):
    category = expr.cut(F.col("sentiment_score"), [-1, -0.1, 0.1, 1], ["Negative", "Neutral", "Positive"])
    return (lens.product_ratings(spark, base).groupBy(category.alias("sentiment_category"))
            .agg(F.count("*").alias("reviews")))


@query("f15_decay", with_sql("texts") + """
SELECT review_id, round(rating * exp(-days / 30.0), 8) AS decayed, round(days / (rating + 1.0), 8) AS ratio FROM (
  SELECT review_id, rating, floor(date_diff('microsecond', created_at, (SELECT max(created_at) FROM texts))
         / 86400000000.0) AS days FROM texts)""")
def f15(spark, base):
    aged = features.extract_temporal_features(lens.texts(spark, base).select("review_id", "rating", "created_at"))
    days, rating = F.col("days_since_latest"), F.col("rating")
    return aged.select("review_id", r8(rating * F.exp(-days / 30)).alias("decayed"), r8(days / (rating + 1)).alias("ratio"))


@query("f17_epoch_seconds", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS created_at FROM events")
def f17(spark, base):
    events = lens.table(spark, base, "events").select("event_id", F.unix_seconds("ts").alias("time"))
    ts = expr.to_time(F.col("time"), "bigint")
    return events.select("event_id", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query("f18_iso_instants", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN event_id % 3 = 1
       THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created_at FROM events""")
def f18(spark, base):
    key = F.col("event_id") % 3
    text = (F.when(key == 0, F.date_format("ts", "yyyy-MM-dd"))
            .when(key == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon"))
    parsed = parse_instant(F.col("text"))
    return (lens.table(spark, base, "events").select("event_id", text.alias("text"))
            .select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("created_at")))


@query("f19_smoothed_ratio", with_sql("product_ratings") + """
SELECT round(helpful_votes / (total_votes + 1e-5), 6) AS ratio, count(*) AS reviews FROM product_ratings GROUP BY 1""")
def f19(spark, base):
    ratio = expr.smoothed_ratio(F.col("helpful_votes"), F.col("total_votes"))
    return (lens.product_ratings(spark, base).groupBy(F.round(ratio, 6).alias("ratio"))
            .agg(F.count("*").alias("reviews")))


@query("f20_flags", with_sql("product_ratings") + """
SELECT CAST(rating >= 4 AS INTEGER) AS is_positive, CAST(rating <= 2 AS INTEGER) AS is_negative,
       round(sum(abs(sentiment_score)), 4) AS magnitude FROM product_ratings GROUP BY 1, 2""")
def f20(spark, base):
    rating = F.col("rating")
    return lens.product_ratings(spark, base).groupBy(
        expr.flag(rating >= 4).alias("is_positive"), expr.flag(rating <= 2).alias("is_negative")).agg(
        F.round(F.sum(F.abs("sentiment_score")), 4).alias("magnitude"))


@query("f21_json_metadata", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, event_type FROM events")
def f21(spark, base):
    events = lens.table(spark, base, "events").select(
        "event_id", F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), "event_type").alias("metadata"))
    encoded = events.withColumn("metadata", F.to_json("metadata"))
    decoded = encoded.withColumn("metadata", F.from_json("metadata", "k int, event_type string"))
    return decoded.select("event_id", "metadata.k", "metadata.event_type")


@query("f23_email_pattern", with_sql("dirty") + """
SELECT row_key, regexp_matches(trim(user_email), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$') AS valid FROM dirty""")
def f23(spark, base):
    return lens.dirty(spark, base).select("row_key", F.trim("user_email").rlike(quality.EMAIL).alias("valid"))


@query("f25_array_functions", """
SELECT p_type AS category, CAST(max(CASE WHEN list_contains(string_split(p_name, ' '), 'red') THEN 1 ELSE 0 END) AS INTEGER) AS has_red,
       count(DISTINCT p_brand) AS brands, CAST(sum(len(list_filter(string_split(p_name, ' '), lambda w: length(w) > 4))) AS BIGINT)
       AS long_words FROM part GROUP BY 1""")
def f25(spark, base):
    docs = lens.table(spark, base, "part").select(F.col("p_type").alias("category"), F.struct(
        F.split("p_name", " ").alias("tags"), F.col("p_brand").alias("brand")).alias("specifications"))
    long = F.size(F.filter("specifications.tags", lambda word: F.length(word) > 4))
    return docs.groupBy("category").agg(
        F.max(F.array_contains("specifications.tags", "red").cast("int")).alias("has_red"),
        F.countDistinct("specifications.brand").alias("brands"), F.sum(long).alias("long_words"))


# Sentiment ----------------------------------------------------------------------------------------


def _levels_sql(word: str, lexicon: sentiment.Lexicon) -> str:
    cases = " ".join(f"WHEN {word} IN {in_sql(listed)} THEN CAST({value} AS DOUBLE)"
                     for value, listed in _levels(lexicon).items())
    return f"CASE {cases} ELSE 0.0 END"


def _levels(lexicon: sentiment.Lexicon) -> dict[float, list[str]]:
    """Words by valence; intensity words carry none themselves."""
    levels: dict[float, list[str]] = {}
    for word, value in sorted(lexicon.valence.items()):
        if value and word not in lexicon.stronger and word not in lexicon.weaker:
            levels.setdefault(float(value), []).append(word)
    return dict(sorted(levels.items()))


def _phrases_sql(words: str, lexicon: sentiment.Lexicon) -> str:
    """A list of words in which each phrase is one word: every word between two spaces, phrases written with ~."""
    text = f"'  ' || array_to_string({words}, '  ') || '  '"
    for phrase in sorted(lexicon.phrases(), key=lambda one: (-len(one.split()), one)):
        text = f"replace({text}, ' {phrase.replace(' ', '  ')} ', ' {phrase.replace(' ', '~')} ')"
    return f"list_transform(list_filter(string_split({text}, ' '), lambda w: w <> ''), lambda w: replace(w, '~', ' '))"


def compound_sql(lexicon: sentiment.Lexicon) -> str:
    """Steps from the cleaned text `c` of `cleaned` to `scored` (id, c, score)."""
    steps = [f"""tokens AS (SELECT id, c, {_phrases_sql("ws", lexicon)} AS ws FROM (
                 SELECT id, c, list_filter(list_transform(string_split(c, ' '), lambda w: trim(w, '.!?,;:')), lambda w: w <> '') AS ws FROM cleaned))""",
             f"v0 AS (SELECT *, list_transform(ws, lambda w: {_levels_sql('w', lexicon)}) AS v FROM tokens)"]

    def among(distance: int, words) -> str:
        return f"(i > {distance} AND ws[i - {distance}] IN {in_sql(words)})"
    for distance, damping in enumerate(sentiment.DAMPING, 1):
        before = f"ws[i - {distance}]"
        boost = (f"CASE WHEN {before} IN {in_sql(lexicon.stronger)} THEN {sentiment.BOOST * damping} "
                 f"WHEN {before} IN {in_sql(lexicon.weaker)} THEN {-sentiment.BOOST * damping} ELSE 0.0 END")
        nearer = range(1, distance)
        special = "".join(f"WHEN {before} IN {in_sql(first)} AND ({' OR '.join(among(at, words) for at in nearer)}) THEN {factor} "
                          for first, words, factor in ((lexicon.never, lexicon.emphatic, sentiment.EMPHASIS_FACTOR),
                                                       (lexicon.without, lexicon.doubt, 1.0)) if nearer)
        turn = f"CASE {special}WHEN {before} IN {in_sql(lexicon.negations)} THEN {sentiment.NEGATION_FACTOR} ELSE 1.0 END"
        steps.append(f"""v{distance} AS (SELECT id, c, ws, list_transform(v, lambda x, i:
            CASE WHEN x = 0 OR i <= {distance} THEN x WHEN {before} IN {in_sql(sorted(lexicon.valence))} THEN x
                 ELSE CAST((x + sign(x) * ({boost})) * ({turn}) AS DOUBLE) END) AS v FROM v{distance - 1})""")
    steps.append(f"""v4 AS (SELECT id, c, ws, list_transform(v, lambda x, i: CASE WHEN {among(1, lexicon.least)}
            AND NOT {among(1, sorted(lexicon.valence))} AND NOT {among(2, lexicon.softening)} THEN x * {sentiment.NEGATION_FACTOR} ELSE x END) AS v FROM v3)""")
    steps.append("""summed AS (SELECT id, c, coalesce(list_sum(list_transform(v, lambda x, i: x * CASE
            WHEN list_position(ws, 'but') > 0 AND i < list_position(ws, 'but') THEN 0.5
            WHEN list_position(ws, 'but') > 0 AND i > list_position(ws, 'but') THEN 1.5 ELSE 1.0 END)), 0) AS s,
            length(c) - length(replace(c, '!', '')) AS calls, length(c) - length(replace(c, '?', '')) AS asks FROM v4)""")
    steps.append("""stressed AS (SELECT id, c, s + sign(s) * (least(calls, 4) * 0.292 + CASE WHEN asks > 3 THEN 0.96
            WHEN asks > 1 THEN asks * 0.18 ELSE 0 END) AS s FROM summed)""")
    steps.append("scored AS (SELECT id, c, round(s / sqrt(s * s + 15), 4) AS score FROM stressed)")
    return ",\n".join(steps)


CLEANED = f"WITH cleaned AS (SELECT doc_id AS id, {CLEAN} AS c FROM documents),\n"
LABELS = "CASE WHEN score >= 0.05 THEN 'positive' WHEN score <= -0.05 THEN 'negative' ELSE 'neutral' END"

#: A lexicon of frequent words of the test texts, so that every rule of the scorer has something to do.
FREQUENT = sentiment.Lexicon(
    valence={"the": 1.5, "of": -0.5, "de": 2.0, "der": -1.5, "in": 0.5, "que": -2.5, "is": 3.0, "le": 1.0},
    negations=("and", "la", "die", "not", "no"), stronger=("to", "en", "und", "that"), weaker=("a", "ci", "ein", "it"))

#: The same with phrases, and with frequent words for the rules of neighbours.
FREQUENT_PHRASES = sentiment.Lexicon(
    valence={**FREQUENT.valence, "to the": -2.0, "la de": 2.5, "a the and": 1.25, "a the": -3.0, "des les": 0.0},
    negations=FREQUENT.negations, stronger=FREQUENT.stronger, weaker=FREQUENT.weaker, least=("er", "con", "for"), softening=("an", "re"),
    never=("and", "la"), emphatic=("an", "er", "los"), without=("die", "no"), doubt=("er", "en", "se"))


@query("t01_clean_text", f"SELECT doc_id AS review_id, {CLEAN} AS cleaned FROM documents")
def t01(spark, base):
    return _documents(spark, base).select("review_id", T.clean_text(F.col("review_text")).alias("cleaned"))


def _scored(spark, base, lexicon):
    cleaned = _documents(spark, base).select("review_id", T.clean_text(F.col("review_text")).alias("c"))
    scored = cleaned.select("review_id", sentiment.compound(F.col("c"), lexicon).alias("score"))
    return scored.select("review_id", sentiment.sentiment_label(F.col("score")).alias("label"), "score",
                         F.abs("score").alias("confidence"))


@query("t02_lexicon_sentiment", CLEANED + compound_sql(sentiment.Lexicon())
       + f"SELECT id AS review_id, {LABELS} AS label, score, abs(score) AS confidence FROM scored")
def t02(spark, base):
    return _scored(spark, base, None)


@query("t02_lexicon_rules", CLEANED + compound_sql(FREQUENT)
       + f"SELECT id AS review_id, {LABELS} AS label, score, abs(score) AS confidence FROM scored")
def t02_rules(spark, base):
    return _scored(spark, base, FREQUENT)


@query("t02_phrases", CLEANED + compound_sql(FREQUENT_PHRASES)
       + f"SELECT id AS review_id, {LABELS} AS label, score, abs(score) AS confidence FROM scored")
def t02_phrases(spark, base):
    return _scored(spark, base, FREQUENT_PHRASES)


@query("t03_stream_sentiment", CLEANED + compound_sql(FREQUENT) + f""",
found AS (SELECT id, list_filter(ws, lambda w: w IN {in_sql(sorted(FREQUENT.valence))}) AS hits FROM tokens)
SELECT s.id AS review_id, score AS polarity, CASE WHEN score > 0.1 THEN 'positive' WHEN score < -0.1 THEN 'negative'
       ELSE 'neutral' END AS label, round(CASE WHEN len(hits) > 0 THEN len(list_filter(hits, lambda w: w IN
       {in_sql(sorted(w for w, v in FREQUENT.valence.items() if abs(v) >= sentiment.STRONG))})) / len(hits) ELSE 0 END, 8) AS subjectivity
FROM scored s JOIN found f ON s.id = f.id""")
def t03(spark, base):
    cleaned = _documents(spark, base).select("review_id", T.clean_text(F.col("review_text")).alias("c"))
    score = sentiment.compound(F.col("c"), FREQUENT)
    return cleaned.select("review_id", score.alias("polarity"), r8(sentiment.subjectivity(F.col("c"), FREQUENT)).alias("subjectivity")
                          ).withColumn("label", lens.label_of(F.col("polarity"), 0.1))


def _emotion_sql(emotion: str) -> str:
    return " + ".join(f"(length(c) - length(replace(c, '{word}', ''))) / {len(word)}" for word in T.EMOTIONS[emotion])


EMOTION_COUNTS = "counted AS (SELECT id, c, " + ", ".join(
    f"CAST({_emotion_sql(name)} AS DOUBLE) AS {name}" for name in T.EMOTIONS) + " FROM cleaned)"
EMOTION_TOTAL = " + ".join(T.EMOTIONS)


@query("t04_emotions", CLEANED + EMOTION_COUNTS + " SELECT id AS review_id, " + ", ".join(
    f"round(coalesce({name} / nullif({EMOTION_TOTAL}, 0), 0), 8) AS {name}" for name in T.EMOTIONS) + " FROM counted")
def t04(spark, base):
    found = _documents(spark, base).select(
        "review_id", T.detect_emotions(T.clean_text(F.col("review_text"))).alias("e"))
    return found.select("review_id", *[r8(f"e.{name}").alias(name) for name in T.EMOTIONS])


KEYWORDS = f"""tokens AS (SELECT id, list_transform(list_filter(regexp_split_to_array(c, '[ .!?,;:]+'), lambda w: length(w) > 3
    AND w NOT IN {in_sql(T.STOP_WORDS)}), lambda w: CASE WHEN regexp_matches(w, '(ss|us|is)$') THEN w
    WHEN regexp_matches(w, 'ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '(ch|sh|x|z|ss)es$')
    THEN regexp_replace(w, 'es$', '') ELSE regexp_replace(w, 's$', '') END) AS ws FROM cleaned),
placed AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM tokens),
ranked AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, min(i)) AS n FROM placed GROUP BY 1, 2)"""


@query("t05_keywords", CLEANED + KEYWORDS + """
SELECT t.id AS review_id, coalesce(string_agg(r.w, ' ' ORDER BY r.n), '') AS keywords FROM tokens t
LEFT JOIN (SELECT * FROM ranked WHERE n <= 10) r ON t.id = r.id GROUP BY 1""")
def t05(spark, base):
    words = T.extract_keywords(T.clean_text(F.col("review_text")))
    return _documents(spark, base).select("review_id", F.array_join(words, " ").alias("keywords"))


@query("o03_top_keywords", CLEANED + KEYWORDS + "SELECT id AS review_id, w AS keyword FROM ranked WHERE n <= 3")
def o03(spark, base):
    words = T.extract_keywords(T.clean_text(F.col("review_text")), 3)
    return _documents(spark, base).select("review_id", F.explode(words).alias("keyword"))


@query("t06_clean_counts", CLEANED + """
counts AS (SELECT id, CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END AS w,
           length(c) - length(translate(c, '.!?', '')) AS s FROM cleaned)
SELECT id AS review_id, CAST(w AS INTEGER) AS word_count, CAST(s AS INTEGER) AS sentence_count FROM counts""")
def t06(spark, base):
    cleaned = _documents(spark, base).select("review_id", T.clean_text(F.col("review_text")).alias("c"))
    return cleaned.select("review_id", T.word_count(F.col("c")).alias("word_count"),
                          T.sentence_count(F.col("c")).alias("sentence_count"))


def _analyzed(spark, base, lexicon=FREQUENT):
    return sentiment.analyze_dataframe(_documents(spark, base), "review_text", lexicon)


@query("t07_analyze_table", CLEANED + compound_sql(FREQUENT) + ",\n" + EMOTION_COUNTS + f"""
SELECT s.id AS review_id, language, CASE WHEN short THEN 'neutral' ELSE {LABELS} END AS sentiment_label,
       CASE WHEN short THEN 0 ELSE score END AS sentiment_score,
       CASE WHEN short THEN 0 ELSE abs(score) END AS sentiment_confidence,
       round(coalesce(joy / nullif({EMOTION_TOTAL}, 0), 0), 8) AS emotion_joy,
       CAST(CASE WHEN short OR s.c = '' THEN 0 ELSE len(string_split(s.c, ' ')) END AS INTEGER) AS word_count
FROM scored s JOIN counted e ON s.id = e.id JOIN (SELECT doc_id, lang AS language, length(text) < 5 AS short FROM documents)
     ON doc_id = s.id""")
def t07(spark, base):
    return _analyzed(spark, base).select("review_id", "language", "sentiment_label", "sentiment_score",
                                         "sentiment_confidence", r8("emotion_joy").alias("emotion_joy"), "word_count")


@query("a21_sentiment_summary", CLEANED + compound_sql(FREQUENT) + ",\n" + EMOTION_COUNTS + f""",
r AS (SELECT CASE WHEN short THEN 'neutral' ELSE {LABELS} END AS label, CASE WHEN short THEN 0 ELSE score END AS score,
      short, e.* FROM scored s JOIN counted e ON s.id = e.id
      JOIN (SELECT doc_id, length(text) < 5 AS short FROM documents) ON doc_id = s.id)
SELECT count(*) AS total_reviews, """ + ", ".join(
    f"count(*) FILTER (label = '{label}') AS {label}_count, round(count(*) FILTER (label = '{label}') * 100.0 / count(*), 8) "
    f"AS {label}_percentage" for label in ("positive", "negative", "neutral")) + """,
 round(avg(score), 8) AS average_sentiment_score, round(avg(abs(score)), 8) AS average_confidence, """ + ", ".join(
    f"round(avg(CASE WHEN NOT short THEN coalesce({name} / nullif({EMOTION_TOTAL}, 0), 0) END), 8) AS emotion_{name}"
    for name in T.EMOTIONS) + " FROM r")
def a21(spark, base):
    summary = summaries.sentiment_summary(_analyzed(spark, base), list(T.EMOTIONS))
    return rounded(summary, *[name for name in summary.columns if not name.endswith(("_count", "_reviews"))])


@query("t12_text_search", """
WITH s AS (SELECT doc_id AS review_id, len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'),
           lambda w: w IN ('best', 'no', 'with'))) AS score FROM documents)
SELECT review_id, CAST(score AS INTEGER) AS score FROM s WHERE score > 0 ORDER BY score DESC, review_id LIMIT 25""")
def t12(spark, base):
    found = text_search(_documents(spark, base), "review_text", "review_id", "best with NO", 25)
    return found.select("review_id", "score")


@query("t13_label_from_score", with_sql("texts") + """
SELECT review_id, CASE WHEN sentiment_score > 0.1 THEN 'Positive' WHEN sentiment_score < -0.1 THEN 'Negative'
       ELSE 'Neutral' END AS sentiment_label FROM texts""")
def t13(spark, base):
    return lens.texts(spark, base).select(
        "review_id", F.initcap(lens.label_of(F.col("sentiment_score"))).alias("sentiment_label"))


# Text measures of a table -------------------------------------------------------------------------


@query("e01_text_features", f"""
SELECT doc_id AS review_id, CAST(length(text) AS INTEGER) AS text_length, CAST(len({words_sql('text')}) AS INTEGER) AS word_count,
       {SENTENCES} AS sentence_count,
       round(coalesce(list_avg(list_transform({words_sql('text')}, lambda w: length(w))), 0), 8) AS avg_word_length,
       {count_sql('text', '!')} AS exclamation_count, {count_sql('text', '[?]')} AS question_count,
       round(len(regexp_extract_all(text, '\\p{{Lu}}')) / CAST(length(text) AS DOUBLE), 8) AS capital_ratio,
       {count_sql('text', '[0-9]')} AS digit_count, {count_sql('text', f'[^a-zA-Z0-9{WS}]')} AS special_char_count,
       round(coalesce(len(list_distinct({words_sql('lower(text)')})) / nullif(CAST(len({words_sql('text')}) AS DOUBLE), 0), 0), 8)
       AS unique_word_ratio,
       round(coalesce(len(list_filter({words_sql('lower(text)')}, lambda w: w IN {in_sql(T.STOP_WORDS)}))
       / nullif(CAST(len({words_sql('text')}) AS DOUBLE), 0), 0), 8) AS stopword_ratio,
       round(CASE WHEN {SENTENCES} > 0 AND len({words_sql('text')}) > 0 THEN greatest(0.0, least(100.0, 206.835 - 1.015 *
       len({words_sql('text')}) / CAST({SENTENCES} AS DOUBLE) - 84.6 * {SYLLABLES} / CAST(len({words_sql('text')}) AS DOUBLE)))
       ELSE 0.0 END, 9) AS readability_score FROM documents""")
def e01(spark, base):
    found = features.extract_basic_text_features(_documents(spark, base).select("review_id", "review_text"))
    found = rounded(found, "avg_word_length", "capital_ratio", "unique_word_ratio", "stopword_ratio")
    return rounded(found, "readability_score", digits=9).drop("review_text")


# Models -------------------------------------------------------------------------------------------


@query("e02_tfidf")
def e02(spark, base):
    rows, vocabulary = text_models.extract_tfidf_features(_documents(spark, base), "review_text", 1000)
    weights = vector_to_array("tfidf")
    return rows.select("review_id", F.size(weights).alias("width"),
                       F.size(F.filter(weights, lambda w: w > 0)).alias("terms"),
                       F.round(F.aggregate(weights, F.lit(0.0), lambda a, w: a + w * w), 6).alias("squared_length"),
                       F.lit(len(vocabulary)).alias("vocabulary"))


@query("e03_topics")
def e03(spark, base):
    rows = text_models.extract_topic_features(_documents(spark, base), "review_text", 10)
    return rows.groupBy("dominant_topic").agg(
        F.count("*").alias("reviews"), F.round(F.avg("dominant_topic_weight"), 4).alias("weight"))


def _labelled(spark, base):
    """Texts with a label made of the two stored ones."""
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    labels = lens.table(spark, base, "labels").select(F.col("doc_id").alias("review_id"), label.alias("label"))
    return _documents(spark, base).join(labels, "review_id").select("review_id", "review_text", "label")


@query("t08_train_classifier")
def t08(spark, base):
    rows = materialize(_labelled(spark, base), "labelled")
    _, metrics = text_models.train_sentiment_model(rows, "review_text", "label", "review_id", 2000)
    return rows.groupBy("label").agg(F.count("*").alias("reviews")).select(
        "*", *[F.lit(float(value)).alias(name) for name, value in metrics.items()])


@query("t09_model_scores")
def t09(spark, base):
    rows = materialize(_labelled(spark, base), "labelled")
    model, _ = text_models.train_sentiment_model(rows, "review_text", "label", "review_id", 2000)
    scored = text_models.score_with_model(model, _documents(spark, base), "review_text")
    return scored.select("review_id", "ml_label", F.round("ml_score", 6).alias("ml_score"),
                         F.round("ml_confidence", 6).alias("ml_confidence"))


@query("t10_ensemble", with_sql("texts") + """
, c AS (SELECT review_id, 0.4 * sentiment_score + 0.6 * (rating - 3) / 2.0 AS score,
        0.4 * abs(sentiment_score) + 0.6 * abs((rating - 3) / 2.0) AS confidence FROM texts)
SELECT review_id, CASE WHEN score >= 0.05 THEN 'positive' WHEN score <= -0.05 THEN 'negative' ELSE 'neutral' END
       AS sentiment_label, round(score, 6) AS sentiment_score, round(confidence, 6) AS sentiment_confidence FROM c""")
def t10(spark, base):
    model = (F.col("rating") - 3) / 2
    first = F.col("sentiment_score")
    combined = sentiment.ensemble(first, model, F.abs(first), F.abs(model))
    rows = lens.texts(spark, base).select("review_id", *[value.alias(name) for name, value in combined.items()])
    return rounded(rows, "sentiment_score", "sentiment_confidence", digits=6)


@query("t11_model_files")
def t11(spark, base):
    rows = materialize(_labelled(spark, base), "labelled")
    model, _ = text_models.train_sentiment_model(rows, "review_text", "label", "review_id", 500)
    path = scratch_path(spark, "model")
    text_models.save_model(model, path)
    scored = text_models.score_with_model(text_models.load_model(path), rows, "review_text")
    return scored.groupBy("label", "ml_label").agg(F.count("*").alias("reviews"))
