"""Target-distribution importance resampling: hashed word n-grams, counted and weighed by Arrow kernels in Spark tasks.

A text is lower-cased and split by Arrow (`ascii_lower`, `split_pattern_regex`), its words are flattened and
dictionary-encoded, and n-grams are pairs of shifted dictionary indices. Only distinct pairs of a portion are ever
spelled out: their CRC continues that of the shorter n-gram. `take` turns features into gains, and a segment sum gives
each document's weight. Spark deals out the texts, adds up the counts of each task and orders the scores by ranges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reviewlake.llm.batches import fields, free_name, others, portions
from reviewlake.llm.places import number_rows
from reviewlake.session import materialize

#: What stands between words: ASCII but for letters and digits (capitals are lower-cased first).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000       # features are counted by their CRC modulo this
    longest: int = 2            # words of the longest n-gram
    least_words: int = 20       # texts of fewer words are weighed, but not drawn
    percent: int = 25           # of the texts that can be drawn
    seed: int = 7
    portion: int = 4 * 2 ** 20  # bytes of text whose words are encoded together


def hashed_features(texts: pa.Array, settings: Settings) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each text, and for each n-gram length the buckets of all n-grams and their texts' places."""
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=BETWEEN)
    flat, of = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.not_equal(flat, "")
    flat, of = flat.filter(filled), np.asarray(of.filter(filled)).astype(np.int64)
    encoded = pc.dictionary_encode(flat)
    words = [word.encode() for word in encoded.dictionary.to_pylist()]
    word = np.asarray(encoded.indices).astype(np.int64)
    crcs = [zlib.crc32(one) for one in words]
    follows = [b" " + one for one in words]
    gram, found = word, []
    for length in range(1, settings.longest + 1):
        if length > 1:
            inside = of[:len(of) - length + 1] == of[length - 1:]
            # n-grams of a length are known at the places where all of their words are in one text
            longer = np.full(max(len(of) - length + 1, 0), -1, np.int64)
            pair = pc.dictionary_encode(pa.array(gram[:len(longer)][inside] * max(len(words), 1) + word[length - 1:][inside]))
            longer[inside] = np.asarray(pair.indices)
            spelled = pair.dictionary.to_numpy()
            crcs = [zlib.crc32(follows[last], crcs[first])
                    for first, last in zip((spelled // max(len(words), 1)).tolist(), (spelled % max(len(words), 1)).tolist())]
            gram = longer
        known = gram >= 0
        bucket = np.array(crcs, np.int64) % settings.buckets
        found.append((pa.array(bucket).take(pa.array(gram[known])).to_numpy(), of[:len(gram)][known]))
    return np.bincount(of, minlength=len(texts)), found


def count_features(df: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(bucket, n): n-grams of 1 to `longest` words of every whole text, repeats counted, by bucket.

    Null and empty texts have none. A task sends one row a bucket at most, whatever its rows.
    """
    schema = fields("bucket int, n bigint")
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(settings.buckets, np.int64)
        for part in parts:
            texts = part.column(0)
            for start, end in portions(texts, settings.portion):
                for bucket, _ in hashed_features(texts.slice(start, end - start), settings)[1]:
                    counts += np.bincount(bucket, minlength=settings.buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], schema=arrow)

    return df.select(F.col(text).cast("string")).mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def learn_gains(source: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
                settings: Settings = Settings()) -> np.ndarray:
    """Gain of each bucket: floored 1000 times the log ratio of its smoothed shares in `target` and in `source`.

    The driver gets one number a bucket and side, however large the tables are. With an empty side its shares are
    those of the smoothing alone.
    """
    def counts(df: DataFrame, column: str) -> np.ndarray:
        found = np.zeros(settings.buckets, np.int64)
        for row in count_features(df, column, settings).collect():
            found[row["bucket"]] = row["n"]
        return found

    s, t = counts(source, text), counts(target, target_text)
    ratio = (t + 1.0) * (float(s.sum()) + settings.buckets) / ((s + 1.0) * (float(t.sum()) + settings.buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(df: DataFrame, gains: np.ndarray, text: str = "text", keep: list[str] | None = None,
          settings: Settings = Settings()) -> DataFrame:
    """The `keep` columns (default: all) with n_words, n_features and weight, the floored mean of the features' gains.

    A text without a word, null or empty, weighs 0. Input columns of these names are replaced.
    """
    new = fields("n_words bigint, n_features bigint, weight bigint")
    kept = others(df, new.names, keep)
    source = df.select(*[df[name] for name in kept], df[text].cast("string").alias(free_name(df)))
    schema = StructType(source.schema.fields[:len(kept)] + new.fields)
    arrow = to_arrow_schema(schema)
    gain = pa.array(gains)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(part.num_columns - 1)
            for start, end in portions(texts, settings.portion):
                n_words, found = hashed_features(texts.slice(start, end - start), settings)
                n_features, total = np.zeros(end - start, np.int64), np.zeros(end - start, np.int64)
                for bucket, of in found:
                    # segment sums by differences of running sums, in integers
                    counted = np.bincount(of, minlength=end - start)
                    upto = np.concatenate([[0], np.cumsum(gain.take(pa.array(bucket)).to_numpy())])
                    ends = np.cumsum(counted)
                    total += upto[ends] - upto[ends - counted]
                    n_features += counted
                weight = total // np.maximum(n_features, 1)
                columns = [column.slice(start, end - start).cast(field.type) for column, field in zip(part.columns[:len(kept)], arrow)]
                made = [pa.array(values.astype(np.int64)) for values in (n_words, n_features, weight)]
                yield pa.RecordBatch.from_arrays(columns + made, schema=arrow)

    return source.mapInArrow(run, schema)


def gumbel(identity: Column, seed: int) -> Column:
    """A draw that depends on `seed` and the id alone: 1000 standard Gumbel units, floored. A null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(df: DataFrame, target: DataFrame, identity: str = "doc_id", text: str = "text", target_text: str = "text",
             keep: list[str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """The `keep` columns (default: all) with n_words, n_features, weight, score and rank.

    Drawn are the highest scores (weight and Gumbel noise, which is sampling without replacement by weight), a
    `percent` of the rows with `least_words` words, floored. rank is 1, 2, 3... in that order, null in rows that are
    not drawn. Ties go to the smaller id, nulls first; rows of the same id and score keep the place they are stored
    at, so exact copies of a row are drawn one by one. Input columns with these names are replaced.
    """
    gains = learn_gains(df, target, text, target_text, settings)
    names = others(df, ["n_words", "n_features", "weight", "score", "rank"], keep)
    # the caller's columns travel in one struct, by place, so that their names cannot meet ours
    row = F.struct(df[identity].alias("id"), *[df[name].alias(f"c{at}") for at, name in enumerate(names)])
    weighed = weigh(df.select(row.alias("row"), df[text].alias("text")), gains, "text", ["row"], settings)
    stored = materialize(weighed.withColumn("score", F.col("weight") + gumbel(F.col("row.id"), settings.seed)), "weighed")
    placed = number_rows(stored, [-F.col("score"), F.col("row.id")], F.col("n_words") >= settings.least_words, "scored")
    drawn = F.col("g.key") & (F.col("place") < F.floor(F.lit(settings.percent) * F.col("n") / 100))
    return placed.select(*[F.col(f"row.row.c{at}").alias(name) for at, name in enumerate(names)],
                         *[F.col(f"row.{name}").alias(name) for name in ("n_words", "n_features", "weight", "score")],
                         F.when(drawn, F.col("place") + 1).alias("rank"))
