"""What Python holds in a task, and what tasks leave in a worker."""

import gc
import random

import public_tokenizers as P
from pyspark.sql import functions as F

from reviewlake.llm import bpe, suffixes
from reviewlake.llm.queries import RANKS


def test_other_steps_find_no_coder(spark):
    """The ranks and pieces that encoding remembers do not stay in the workers while another step runs."""
    vocabulary = bpe.Vocabulary(spark, P.path(RANKS), P.PATTERN)
    docs = spark.createDataFrame([(at, f"word{at} and more") for at in range(64)], "doc_id long, text string").repartition(8)
    assert bpe.round_trip(docs, vocabulary).where("round_trip_ok").count() == 64
    found = spark.createDataFrame([(at, "abc " * 40) for at in range(64)], "doc_id long, text string").repartition(8)
    suffixes.remove_repeats(found).collect()
    left = suffixes.make_rows(docs, ["text"], "n long", lambda: lambda texts: ([_coders_here()] * len(texts),))
    assert left.agg(F.max("n")).first()[0] == 0


def _coders_here():
    return sum(type(thing).__name__ == "Coder" for thing in gc.get_objects())


def test_repeats_hold_texts_in_portions(spark, monkeypatch):
    """No step of the removal of repeats has all texts or strings of a batch in Python."""
    random.seed(4)
    passage = "".join(random.choice("abcdefgh ") for _ in range(300_000))
    rows = [(at, passage[:first] + "#" + passage[first:]) for at, first in enumerate(range(0, 300_000, 10_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    plain_add, plain_make = suffixes.add_columns, suffixes.make_rows

    def watched(start, place, most):
        def begin():
            rows = start()

            def checked(*columns):
                held = sum(len(value) for value in columns[place])
                assert held <= most, f"{held} bytes at a time"
                return rows(*columns)
            return checked
        return begin

    def add(df, inputs, outputs, start, *rest):
        return plain_add(df, inputs, outputs, watched(start, 0, 2 * 2 ** 20), *rest)

    def make(df, inputs, outputs, start, *rest):
        place, most = (inputs.index("data"), 2 ** 19) if "data" in inputs else (inputs.index("text"), 4 * 2 ** 20)
        return plain_make(df, inputs, outputs, watched(start, place, most), *rest)
    monkeypatch.setattr(suffixes, "add_columns", add)
    monkeypatch.setattr(suffixes, "make_rows", make)
    got = {row.doc_id: (row.n_removed, row.n_spans) for row in suffixes.remove_repeats(docs).collect()}
    # all that stands before and after the inserted character is in the first text
    assert got[0] == (0, 0) and all(got[at] == (300_000, 2) for at in range(1, 30))
