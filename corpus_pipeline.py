"""The corpus pipeline: each stage works on what its predecessor kept, through tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import bpe, contamination, languages, simhash, suffixes
from reviewlake.llm.queries import RANKS, table
from reviewlake.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those in which no language has three tenths of the letters."""
    held = F.coalesce(languages.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return languages.keep_identified(docs, languages.train(docs.where(~held)), least=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose what 100-byte strings that also start earlier cover; n_chars is that of the rest."""
    # the columns travel in one struct, so that none of them meets a column of the operator
    row = F.struct(*[docs[name] for name in docs.columns if name != "text"], F.lit(0).alias("_"))
    held = docs.select(row.alias("row"), docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    found = suffixes.remove_repeats(held, length=100, keep=["row"])
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[new.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a word in twenty or more go; the others stay as they are."""
    return contamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each kept text, with the digests that prove the way back."""
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = bpe.round_trip(docs, vocabulary, keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [("language", identify), ("near_copies", drop_near_copies), ("repeats", drop_repeats),
                                   ("decontamination", decontaminate), ("bpe", encode)]

#: Learned languages, fingerprints and byte-level merges have no SQL form; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
