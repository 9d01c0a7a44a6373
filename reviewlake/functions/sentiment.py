"""Lexicon sentiment with negation, intensity words, contrast and punctuation.

Follows the published rule set of Hutto & Gilbert (2014) on cleaned, lower-case
text, as one expression per row: no shuffle and no Python in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import text as T
from reviewlake.functions.expr import let, lookup

# Own small lexicon, word -> valence from -4 to 4.
LEXICON = {word: valence for valence, listed in {
    4: "outstanding superb",
    3: "amazing wonderful fantastic excellent perfect perfectly awesome delighted thrilled love best incredible",
    2: "happy joy excited pleased great good recommend recommended satisfied exceeded amazed comfortable beautiful "
       "impressive quality",
    1: "decent fast works value fair improvement fine okay astonished unexpected surprised",
    -1: "average cheap issues mixed uncertain doubtful concerned expensive slow",
    -2: "bad poor sad upset unhappy disappointed disappointing annoyed irritated frustrated worried anxious nervous "
        "afraid scared unsatisfied unhelpful broke regret waste shocked gross depressed",
    -3: "terrible awful horrible angry mad furious nasty disgusted disgusting miserable revolted repulsed yuck hate",
    -4: "worst",
}.items() for word in listed.split()}

# Fixed values of the published rules: phrases with a valence of their own.
IDIOMS = {
    "the bomb": 3, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2, "kiss of death": -1.5, "to die for": 3,
    "beating heart": 3.1, "broken heart": -2.9, "cut the mustard": 2, "hand to mouth": -2, "back handed": -2,
    "blow smoke": -2, "upper hand": 1, "break a leg": 2, "cooking with gas": 2, "in the black": 2, "in the red": -2,
    "on the ball": 2, "under the weather": -2,
}

# Words that turn the valence of what follows around.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither neednt
never none nope nor not nothing nowhere oughtnt shant shouldnt wasnt werent without wont wouldnt rarely seldom
despite
""".split()

# Words that strengthen or weaken what follows.
STRONGER = """
absolutely amazingly awfully completely considerably decidedly deeply enormously entirely especially exceptionally
extremely fabulously fully greatly highly hugely incredibly intensely majorly more most particularly purely quite
really remarkably so substantially thoroughly totally tremendously unbelievably unusually utterly very
""".split()
WEAKER = "almost barely hardly kinda less little marginally occasionally partly scarcely slightly somewhat sorta".split()

# Fixed values of the published rules.
BOOST = 0.293
DAMPING = (1.0, 0.95, 0.9)
NEGATION_FACTOR = -0.74
NORMALIZER = 15
EMPHASIS_FACTOR = 1.25

#: Word lists whose words count together with a neighbour.
ROLES = ("least", "softening", "never", "emphatic", "without", "doubt")

#: Least absolute valence of a strong opinion.
STRONG = 2


@dataclass(frozen=True)
class Lexicon:
    """Word lists of the scorer; `read` loads the published tab separated file format.

    Entries of `valence` may be phrases: words with one space between them. `least` turns what follows unless a word of
    `softening` stands before it. A `never` followed by a word of `emphatic` stresses instead of turning, and `without`
    followed by `doubt` does neither.
    """

    valence: dict[str, float] = field(default_factory=lambda: {**LEXICON, **IDIOMS})
    negations: tuple[str, ...] = tuple(NEGATIONS)
    stronger: tuple[str, ...] = tuple(STRONGER)
    weaker: tuple[str, ...] = tuple(WEAKER)
    least: tuple[str, ...] = ("least",)
    softening: tuple[str, ...] = ("at", "very")
    never: tuple[str, ...] = ("never",)
    emphatic: tuple[str, ...] = ("so", "this")
    without: tuple[str, ...] = ("without",)
    doubt: tuple[str, ...] = ("doubt",)

    def phrases(self) -> list[str]:
        return sorted(entry for entry in self.valence if " " in entry)

    @staticmethod
    def read(spark: SparkSession, path: str, limit: int = 100_000) -> Lexicon:
        """Lines of `word or phrase <tab> valence ...` in any folder that Spark reads, beside the published idioms.

        A lexicon of more than `limit` entries is refused, since it becomes part of the plan.
        """
        parts = F.split("value", "\t")
        lines = spark.read.text(path).select(F.regexp_replace(F.lower(F.trim(parts[0])), " +", " ").alias("word"), F.get(parts, F.lit(1)).try_cast("double").alias("valence"))
        rows = lines.where(F.col("valence").isNotNull()).limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} words in {path}")
        return Lexicon(valence={**IDIOMS, **{row["word"]: row["valence"] for row in rows}})


def sentiment_tokens(cleaned: Column) -> Column:
    """Words without the punctuation around them."""
    return F.array_remove(F.split(F.trim(cleaned, F.lit(" .!?,;:")), "[.!?,;:]* [.!?,;:]*"), "")


def join_phrases(tokens: Column, phrases: list[str]) -> Column:
    """Tokens in which the words of each phrase are one token; leftmost and longest phrases go first.

    A token that begins no phrase is looked up once. Places of phrases are gathered first, which are few, and the
    tokens between them are taken as slices, so that the work grows with the text.
    """
    if not phrases:
        return tokens
    sizes = {phrase: len(phrase.split(" ")) for phrase in phrases}
    longest: dict[str, int] = {}
    for phrase, size in sizes.items():
        first = phrase.split(" ")[0]
        longest[first] = max(longest.get(first, 0), size)
    begins = lookup({word: {"size": size} for word, size in longest.items()}, "size:int")
    is_phrase = lookup({phrase: {"known": True} for phrase in phrases}, "known:boolean")

    def words(at: Column, size: Column | int) -> Column:
        return F.array_join(F.slice(tokens, at + 1, F.lit(size) if isinstance(size, int) else size), " ")

    def size_at(at: Column) -> Column:
        def tried(most: Column) -> Column:
            # the last words of a text may be a shorter phrase than the one that is tried
            found = [F.when((most >= size) & (at + size <= F.size(tokens)) & is_phrase(words(at, size)).isNotNull(), size)
                     for size in sorted(set(sizes.values()), reverse=True)]
            return F.when(most.isNotNull(), F.coalesce(*found))
        return let(begins(F.get(tokens, at))["size"], tried)

    places = F.when(F.size(tokens) > 1, F.sequence(F.lit(0), F.size(tokens) - 2)).otherwise(F.array().cast("array<int>"))
    candidates = F.filter(F.transform(places, lambda at: F.struct(at.alias("at"), size_at(at).cast("int").alias("size"))),
                          lambda found: found["size"].isNotNull())
    nothing = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,size:int>>").alias("chosen"))

    def choose(done: Column, found: Column) -> Column:
        taken = F.struct((found["at"] + found["size"]).alias("end"), F.concat(done["chosen"], F.array(found)).alias("chosen"))
        return F.when(found["at"] >= done["end"], taken).otherwise(done)

    def joined(chosen: Column) -> Column:
        def end(k: Column) -> Column:
            before = F.get(chosen, k)
            return F.coalesce(before["at"] + before["size"], F.lit(0))
        parts = F.transform(chosen, lambda found, k: F.concat(
            F.slice(tokens, end(k - 1) + 1, found["at"] - end(k - 1)), F.array(words(found["at"], found["size"]))))
        rest = end(F.size(chosen) - 1)
        return F.when(F.size(chosen) == 0, tokens).otherwise(
            F.concat(F.flatten(parts), F.slice(tokens, rest + 1, F.size(tokens) - rest)))
    return let(F.aggregate(candidates, nothing, choose)["chosen"], joined)


def lexicon_tokens(cleaned: Column, lexicon: Lexicon) -> Column:
    """Words and the lexicon's phrases of a cleaned text."""
    return let(sentiment_tokens(cleaned), lambda tokens: join_phrases(tokens, lexicon.phrases()))


def token_facts(tokens: Column, lexicon: Lexicon) -> Column:
    """What the lexicon says of each token: its valence, whether it has one, how it strengthens, how it turns, and what
    it is to its neighbours; or null.

    Intensity words carry no valence of their own.
    """
    entries: dict[str, dict] = {}
    for word, value in lexicon.valence.items():
        intense = word in lexicon.stronger or word in lexicon.weaker
        entries[word] = {"valence": float(value) if value and not intense else None, "known": True,
                         "strong": abs(value) >= STRONG}
    for words, name, value in ((lexicon.weaker, "boost", -BOOST), (lexicon.stronger, "boost", BOOST),
                               (lexicon.negations, "turn", NEGATION_FACTOR)):
        for word in words:
            entries.setdefault(word, {})[name] = value
    for name in ROLES:
        for word in getattr(lexicon, name):
            entries.setdefault(word, {})[name] = True
    return F.transform(tokens, lookup(entries, "valence:double,known:boolean,strong:boolean,boost:double,turn:double,"
                                      + ",".join(f"{name}:boolean" for name in ROLES)))


def token_valence(facts: Column, fact: Column, at: Column) -> Column:
    """Valence of one token after intensity words and negations among the three tokens before it."""
    def before(distance: int) -> Column:
        return F.get(facts, at - distance)

    def role(distance: int, name: str) -> Column:
        return F.coalesce(before(distance)[name], F.lit(False))

    def turned(distance: int) -> Column:
        """The factor of the token at a distance, with regard to those between."""
        plain = F.coalesce(before(distance)["turn"], F.lit(1.0))
        if distance == 1:
            return plain
        stressed, doubted = F.lit(False), F.lit(False)
        for nearer in range(1, distance):
            stressed, doubted = stressed | role(nearer, "emphatic"), doubted | role(nearer, "doubt")
        return (F.when(role(distance, "never") & stressed, EMPHASIS_FACTOR)
                .when(role(distance, "without") & doubted, 1.0).otherwise(plain))

    def adjusted(valence: Column, distance: int) -> Column:
        boost = F.coalesce(before(distance)["boost"] * DAMPING[distance - 1], F.lit(0.0))
        return F.when(role(distance, "known"), valence).otherwise((valence + F.signum(valence) * boost) * turned(distance))

    def step(distance: int, valence: Column) -> Column:
        if distance > len(DAMPING):
            is_least = role(1, "least") & ~role(1, "known") & ~role(2, "softening")
            return valence * F.when(is_least, NEGATION_FACTOR).otherwise(1.0)
        return let(adjusted(valence, distance), lambda value: step(distance + 1, value))

    return F.when(fact["valence"].isNotNull(), step(1, fact["valence"])).otherwise(0.0)


def compound(cleaned: Column, lexicon: Lexicon | None = None) -> Column:
    """Overall score in -1..1, rounded to 4 digits."""
    lexicon = lexicon or Lexicon()

    def total(tokens: Column) -> Column:
        return let(F.array_position(tokens, "but"), lambda contrast: summed(tokens, contrast))

    def summed(tokens: Column, contrast: Column) -> Column:
        def weight(at: Column) -> Column:
            return (F.when((contrast > 0) & (at + 1 < contrast), 0.5)
                    .when((contrast > 0) & (at + 1 > contrast), 1.5).otherwise(1.0))

        def added(facts: Column) -> Column:
            valences = F.transform(facts, lambda fact, at: token_valence(facts, fact, at) * weight(at))
            return F.aggregate(valences, F.lit(0.0), lambda a, b: a + b)
        return let(token_facts(tokens, lexicon), added)

    calls, asks = T.occurrences(cleaned, "!"), T.occurrences(cleaned, r"\?")
    emphasis = F.least(calls, F.lit(4)) * 0.292 + F.when(asks > 3, 0.96).when(asks > 1, asks * 0.18).otherwise(0.0)

    def score(base: Column) -> Column:
        return let(base + F.signum(base) * emphasis,
                   lambda value: F.round(value / F.sqrt(value * value + NORMALIZER), 4))

    return let(let(lexicon_tokens(cleaned, lexicon), total), score)


def subjectivity(cleaned: Column, lexicon: Lexicon | None = None) -> Column:
    """Share of the lexicon words found that are strong opinions (an approximation)."""
    lexicon = lexicon or Lexicon()

    def share(facts: Column) -> Column:
        hits = F.filter(facts, lambda fact: F.coalesce(fact["known"], F.lit(False)))
        return let(hits, lambda found: F.when(
            F.size(found) > 0, F.size(F.filter(found, lambda fact: fact["strong"])) / F.size(found)).otherwise(0.0))

    return let(token_facts(lexicon_tokens(cleaned, lexicon), lexicon), share)


def sentiment_label(score: Column, threshold: float = 0.05) -> Column:
    """positive from the threshold up, negative from its mirror down, else neutral."""
    return (F.when(score >= threshold, "positive")
            .when(score <= -threshold, "negative").otherwise("neutral"))


def analyze_dataframe(df: DataFrame, text_column: str, lexicon: Lexicon | None = None,
                      min_length: int = 5, with_emotions: bool = True, top_k: int = 10) -> DataFrame:
    """Add label, score, confidence, emotions, keywords and counts to every row.

    Text shorter than `min_length` is neutral with score 0 and no emotions.
    """
    raw = F.coalesce(F.col(text_column), F.lit(""))
    usable = F.length(raw) >= min_length
    staged = df.withColumn("_clean", F.when(usable, T.clean_text(raw)))
    staged = staged.withColumn("_score", F.coalesce(compound(F.col("_clean"), lexicon), F.lit(0.0)))
    clean, score = F.col("_clean"), F.col("_score")
    emotions = F.when(usable, T.detect_emotions(clean))
    result = staged.select(
        *[F.col(column) for column in df.columns],
        sentiment_label(score).alias("sentiment_label"),
        score.alias("sentiment_score"),
        F.abs(score).alias("sentiment_confidence"),
        emotions.alias("emotions"),
        F.coalesce(T.extract_keywords(clean, top_k), F.array().cast("array<string>")).alias("keywords"),
        F.coalesce(T.word_count(clean), F.lit(0)).alias("word_count"),
        F.coalesce(T.sentence_count(clean), F.lit(0)).alias("sentence_count"))
    if with_emotions:
        result = result.withColumns({f"emotion_{name}": F.coalesce(F.col(f"emotions.{name}"), F.lit(0.0))
                                     for name in T.EMOTIONS})
    return result


def ensemble(lexicon_score: Column, model_score: Column, lexicon_confidence: Column,
             model_confidence: Column) -> dict[str, Column]:
    """0.4 lexicon + 0.6 model, labelled at +-0.05."""
    score = 0.4 * lexicon_score + 0.6 * model_score
    return {"sentiment_label": sentiment_label(score), "sentiment_score": score,
            "sentiment_confidence": 0.4 * lexicon_confidence + 0.6 * model_confidence}
