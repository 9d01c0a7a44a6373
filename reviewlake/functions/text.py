"""Text measures, cleaning, emotions and keywords as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.expr import any_of, let

# Fixed value: the characters that separate words (Unicode white space).
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

# Common English words that carry no topic.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't
cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()

# The words looked for per emotion (found anywhere inside the text).
EMOTIONS = {
    "joy": ["happy", "joy", "excited", "pleased", "delighted", "thrilled", "amazing", "wonderful", "fantastic",
            "excellent"],
    "anger": ["angry", "mad", "furious", "annoyed", "irritated", "frustrated", "terrible", "awful", "horrible",
              "worst"],
    "sadness": ["sad", "disappointed", "upset", "depressed", "unhappy", "miserable", "poor", "bad", "unsatisfied"],
    "fear": ["scared", "afraid", "worried", "anxious", "concerned", "nervous", "uncertain", "doubtful"],
    "surprise": ["surprised", "shocked", "amazed", "astonished", "unexpected", "incredible", "unbelievable"],
    "disgust": ["disgusted", "revolted", "repulsed", "gross", "nasty", "disgusting", "yuck"],
}


def flatten(text: Column) -> Column:
    """Single blanks between the words, none around them."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def split_flat(flat: Column) -> Column:
    """Words of a flattened text; none for an empty one."""
    return F.array_remove(F.split(flat, " "), "")


def words(text: Column) -> Column:
    """White-space separated words; none for blank text."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def avg_word_length(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))
    return F.when(word_count(text) > 0, letters / word_count(text)).otherwise(0.0)


def capital_ratio(text: Column) -> Column:
    return F.when(F.length(text) > 0, occurrences(text, r"\p{Lu}") / F.length(text)).otherwise(0.0)


def special_char_count(text: Column) -> Column:
    """Characters that are neither ASCII letters or digits nor white space."""
    return occurrences(text, f"[^a-zA-Z0-9{SPACE}]")


def sentence_count(text: Column) -> Column:
    """Number of `.`, `!` and `?`."""
    return occurrences(text, "[.!?]")


def sentence_count_by_boundary(text: Column) -> Column:
    """Sentences by locale rules instead of by end marks."""
    return F.size(F.sentences(text))


def syllables_of_flat(lower_flat: Column) -> Column:
    """Sum over the words of max(1, vowel groups - 1 if it ends in e).

    Counted over the whole text: all vowel groups, less the words ending in e,
    plus one for each word this would leave without a syllable.
    """
    padded = F.concat(F.lit(" "), lower_flat, F.lit(" "))
    bare = " (?:[^aeiouy ]++|[^aeiouy ]*+[aeiouy]*e)(?= )"
    return occurrences(lower_flat, "[aeiouy]+") - occurrences(padded, "e ") + occurrences(padded, bare)


def syllable_count(text: Column) -> Column:
    return syllables_of_flat(F.lower(flatten(text)))


def reading_ease(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """206.835 - 1.015 words/sentence - 84.6 syllables/word, held within 0..100."""
    score = 206.835 - 1.015 * n_words / n_sentences - 84.6 * n_syllables / n_words
    return F.when((n_words > 0) & (n_sentences > 0),
                  F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))).otherwise(0.0)


def flesch_reading_ease(text: Column) -> Column:
    return reading_ease(word_count(text), sentence_count(text), syllable_count(text))


def unique_ratio(lower: Column) -> Column:
    """Distinct share of an array of words."""
    return F.when(F.size(lower) > 0, F.size(F.array_distinct(lower)) / F.size(lower)).otherwise(0.0)


def stop_ratio(lower: Column) -> Column:
    """Share of stop words in an array of words."""
    hits = F.size(F.filter(lower, lambda word: word.isin(STOP_WORDS)))
    return F.when(F.size(lower) > 0, hits / F.size(lower)).otherwise(0.0)


def unique_word_ratio(text: Column) -> Column:
    return unique_ratio(words(F.lower(text)))


def stopword_ratio(text: Column) -> Column:
    return stop_ratio(words(F.lower(text)))


def _where(text: Column, marks: list[str], pattern: str) -> Column:
    """Remove a pattern from the texts that hold one of its marks; the others are only searched."""
    held = F.contains(text, F.lit(marks[0]))
    for mark in marks[1:]:
        held = held | F.contains(text, F.lit(mark))
    return F.when(held, F.regexp_replace(text, pattern, "")).otherwise(text)


def clean_text(text: Column) -> Column:
    """Lower case without links, mail addresses and unusual characters, single spaces."""
    result = let(F.lower(flatten(F.coalesce(text, F.lit("")))),
                 lambda low: _where(low, ["http", "www"], "(?:http|www)[^ ]+"))
    # Anchored at the start of a word, so that a long word is scanned only once.
    result = let(result, lambda low: _where(low, ["@"], "(?<![^ ])[^ ][^ @]*@[^ ]+"))
    # The complement of [a-z0-9 .!?,;:] by ranges: Java takes twenty times as long for the negated class.
    result = F.regexp_replace(result, r"[\x00-\x1f\x22-\x2b\x2d\x2f<=>@\x5b-\x60\x7b-\x{10ffff}]+", "")
    return F.trim(F.regexp_replace(result, " {2,}", " "))


def tidy_text(text: Column) -> Column:
    """Trimmed, single spaces, only word characters and . , ! ? -; blank becomes null."""
    result = F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")
    result = F.regexp_replace(result, f"[{SPACE}]+", " ")
    result = F.regexp_replace(result, r"[^\p{L}\p{N}_" + SPACE + r".,!?-]", "")
    return F.nullif(result, F.lit(""))


def emotion_counts(lower: Column) -> dict[str, Column]:
    """How often the words of each emotion occur inside a lower-case text."""
    def found(word: str) -> Column:
        # The cheap search comes first: nearly all words are absent.
        rest = F.octet_length(F.replace(lower, F.lit(word), F.lit("")))
        return F.when(F.contains(lower, F.lit(word)), (F.octet_length(lower) - rest) / len(word)).otherwise(0.0)

    return {emotion: sum((found(word) for word in listed[1:]), found(listed[0]))
            for emotion, listed in EMOTIONS.items()}


def detect_emotions(text: Column) -> Column:
    """Struct of emotion shares; all 0 when no emotion word occurs."""
    def shares(found: Column) -> Column:
        total = sum((found[name] for name in list(EMOTIONS)[1:]), found[next(iter(EMOTIONS))])
        return F.struct(*[F.coalesce(F.try_divide(found[name], total), F.lit(0.0)).alias(name)
                          for name in EMOTIONS])

    def counted(lower: Column) -> Column:
        return let(F.struct(*[count.alias(name) for name, count in emotion_counts(lower).items()]), shares)

    return F.when(text.isNotNull(), let(F.lower(text), counted))


def token_runs(tokens: Column) -> Column:
    """Distinct tokens as array<struct<n, first, token>> (count, first position).

    Sorts the tokens with their positions and measures the runs of equal tokens,
    so the work grows with n log n and stays inside the row.
    """
    ordered = F.sort_array(F.transform(tokens, lambda token, at: F.struct(token.alias("token"), at.alias("at"))))

    def runs(sorted_tokens: Column) -> Column:
        n = F.size(sorted_tokens)
        starts = F.filter(
            F.transform(sorted_tokens, lambda item, at: F.when(
                F.get(sorted_tokens, at - 1)["token"].eqNullSafe(item["token"]), -1).otherwise(at)),
            lambda at: at >= 0)
        return let(starts, lambda begin: F.transform(begin, lambda at, i: F.struct(
            (F.coalesce(F.get(begin, i + 1), n) - at).alias("n"),
            F.get(sorted_tokens, at)["at"].alias("first"),
            F.get(sorted_tokens, at)["token"].alias("token"))))

    return let(ordered, runs)


def keyword_tokens(cleaned: Column) -> Column:
    """Words longer than 3 letters that are no stop words, without punctuation."""
    tokens = F.split(cleaned, "[ .!?,;:]+")
    return F.filter(tokens, lambda token: (F.length(token) > 3) & ~token.isin(STOP_WORDS))


def _noun_base_by_pattern(token: Column) -> Column:
    """The same by patterns, whose `$` also stands before a line break at the end."""
    return (F.when(token.rlike("(ss|us|is)$"), token).when(token.rlike("ies$"), F.regexp_replace(token, "ies$", "y"))
            .when(token.rlike("(ch|sh|x|z|ss)es$"), F.regexp_replace(token, "es$", ""))
            .otherwise(F.regexp_replace(token, "s$", "")))


def noun_base(token: Column) -> Column:
    """The singular of an English noun by its ending; other words mostly stay as they are."""
    def ends(*endings: str) -> Column:
        return any_of(F.endswith(token, F.lit(ending)) for ending in endings)

    def without(size: int) -> Column:
        return F.left(token, F.length(token) - size)
    breaks = any_of(F.endswith(token, F.lit(mark)) for mark in "\n\r\x85\u2028\u2029")
    return (F.when(~ends("s"), F.when(breaks, _noun_base_by_pattern(token)).otherwise(token))
            .when(ends("ss", "us", "is"), token).when(ends("ies"), F.concat(without(3), F.lit("y")))
            .when(ends("ches", "shes", "xes", "zes", "sses"), without(2)).otherwise(without(1)))


def extract_keywords(cleaned: Column, top_k: int = 10, lemma: Callable[[Column], Column] | None = noun_base) -> Column:
    """Most frequent keywords, ties by first appearance. `lemma` maps a token column to its base form."""
    tokens = keyword_tokens(cleaned)
    if lemma is not None:
        tokens = F.transform(tokens, lemma)

    def best(runs: Column) -> Column:
        # Only runs as frequent as the last one kept have to be ordered.
        least = F.get(F.sort_array(F.transform(runs, lambda run: run["n"]), False), top_k - 1)
        return let(F.coalesce(least, F.lit(0)), lambda low: F.sort_array(F.transform(
            F.filter(runs, lambda run: run["n"] >= low),
            lambda run: F.struct((-run["n"]).alias("n"), run["first"].alias("first"), run["token"].alias("token")))))

    return F.transform(F.slice(let(token_runs(tokens), best), 1, top_k), lambda run: run["token"])


def truncate(text: Column, max_length: int = 100) -> Column:
    """Text cut to `max_length` characters with a trailing ellipsis."""
    return F.when(F.length(text) > max_length,
                  F.concat(F.substring(text, 1, max_length - 3), F.lit("..."))).otherwise(text)


def search_score(text: Column, query: str) -> Column:
    """How many words of the text are search terms."""
    terms = sorted({term for term in query.lower().split() if term})
    tokens = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.size(F.filter(tokens, lambda token: token.isin(terms)))
