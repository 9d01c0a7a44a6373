"""Benchmark decontamination: a broadcast hash set of the benchmark's word n-grams, scanned over document windows."""

from __future__ import annotations

import uuid
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns, kept_in_worker, others
from reviewlake.session import materialize

#: Words of a window.
WINDOW = 13

#: Bytes of benchmark text whose n-grams are broadcast at once.
BLOCK_BYTES = 16 << 20

#: Byte -> lower-case letter, digit or byte of a non-ASCII character; every other byte parts words.
WORD_BYTES = bytes(value + 32 if 65 <= value <= 90 else value if 48 <= value <= 57 or 97 <= value <= 122 or value >= 128
                   else 32 for value in range(256))

BASE = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of texts that a task has in Python at a time.
HELD = 4 * 2 ** 20

HITS = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Windows:
    """The n-grams of some benchmark items: all their words as numbers in one array, and for each length of n-grams
    the sorted digests with the places in that array, by which hits are verified."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        numbers = [np.array([self.number.setdefault(word, len(self.number) + 1) for word in words_of(text)], np.uint64)
                   for _, text in items]
        self.names = [item for item, _ in items]
        self.words = np.concatenate([np.zeros(0, np.uint64), *numbers])
        sizes = np.array([len(each) for each in numbers], np.int64)
        self.begins = np.cumsum(sizes) - sizes
        self.digests: dict[int, np.ndarray] = {}
        self.places: dict[int, np.ndarray] = {}
        for size in sorted({min(each, window) for each in sizes.tolist()} - {0}):
            some = np.flatnonzero(np.minimum(sizes, window) == size)
            counts = sizes[some] - size + 1
            firsts = np.repeat(self.begins[some] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            keys = self.digest([self.words[firsts + step] for step in range(size)])
            order = np.argsort(keys, kind="stable")
            self.digests[size], self.places[size] = keys[order], firsts[order]

    def owners(self, size: int, place: int, gram: np.ndarray) -> set[str]:
        """The items with an n-gram, among those whose digests begin at a place."""
        found, digests = set(), self.digests[size]
        end = int(np.searchsorted(digests, digests[place], "right"))
        for at in self.places[size][place:end].tolist():
            if np.array_equal(self.words[at:at + size], gram):
                found.add(self.names[int(np.searchsorted(self.begins, at, "right")) - 1])
        return found

    @staticmethod
    def digest(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            out = (out ^ (out >> np.uint64(29))) * BASE + column
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit word spans [start, end) and the items that occur."""
        number = self.number.get
        ids = np.array([number(word, 0) for word in words], np.uint64)
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        found, items = [], set()
        for size, digests in self.digests.items():
            starts = np.flatnonzero(known[size:] - known[:-size] == size) if size <= len(ids) else ()
            if not len(starts):
                continue
            keys = self.digest([ids[starts + step] for step in range(size)])
            place = np.minimum(np.searchsorted(digests, keys), len(digests) - 1)
            hit = digests[place] == keys
            for at, first in zip(starts[hit].tolist(), place[hit].tolist()):
                owners = self.owners(size, first, ids[at:at + size])
                if owners:
                    found.append((at, at + size))
                    items |= owners
        return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def find_benchmark(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds n_words, spans (word positions [start, end) that benchmark windows cover) and items (sorted ids).

    Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. A window is `window` consecutive words
    of an item; an item with fewer words is one window, one without words has none. Null texts have no words, null
    item ids are the empty id, several rows of one id are one item. Repeated rows and other columns stay; columns
    named like new ones are replaced; empty tables give empty results.

    The benchmark's size is counted first. It is broadcast in blocks of at most about `block_bytes`, one pass of the
    documents each, with the rows stored in between, so that neither driver nor executors hold more than a block of any
    benchmark. A worker builds its table once: 16 bytes a window and 8 a word, beside the distinct words.
    """
    spark = df.sparkSession
    tests = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = tests.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = total // block_bytes + 1
    kept = others(df, ["n_words", "spans", "items"], keep)
    found = df.select(*dict.fromkeys([*kept, text]))
    for block in range(blocks):
        some = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([tuple(row) for row in some.collect()])
        last = block == blocks - 1
        found = add_columns(found, [text] if block == 0 else [text, "spans", "items"], HITS, _scan(sent, window),
                            kept if last else list(dict.fromkeys([*kept, text])), HELD)
        found = found if last else materialize(found, "scanned")
    return found


def _scan(sent, window):
    name = uuid.uuid4().hex

    def start():
        windows = kept_in_worker(("windows", name), lambda: Windows(sent.value, window))

        def rows(texts, spans=None, items=None):
            counts, places, names = [], [], []
            for at, text in enumerate(texts):
                words = words_of(text)
                found, said = windows.scan(words)
                if spans is not None:
                    found = merged(found + [(span["start"], span["end"]) for span in spans[at]])
                    said |= set(items[at])
                counts.append(len(words))
                places.append([{"start": first, "end": end} for first, end in found])
                names.append(sorted(said))
            return counts, places, names
        return rows
    return start


def contamination(found: DataFrame, per_words: int = 20) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated (a word in `per_words` or more is hit)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return (found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("bigint"))
            .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (per_words * F.col("n_hit") >= F.col("n_words"))))


def _held(df: DataFrame, text: str) -> DataFrame:
    """Rows in one column, so that no column of theirs meets one of ours."""
    return df.select(F.struct(*[df[name] for name in df.columns]).alias("row"), df[text].alias("text"))


def remove_documents(df: DataFrame, benchmark: DataFrame, per_words: int = 20, text: str = "text", **names) -> DataFrame:
    """The rows that are not contaminated, with their columns, whatever those are named."""
    found = contamination(find_benchmark(_held(df, text), benchmark, "text", keep=["row"], **names), per_words)
    return found.where(~F.col("contaminated")).select("row.*")


def remove_spans(df: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """All rows, their texts without the words that benchmark windows cover and what stands between those words."""
    def start():
        def rows(texts, spans):
            return ([without_words(value, places) for value, places in zip(texts, spans)],)
        return rows
    found = find_benchmark(_held(df, text), benchmark, "text", keep=["row", "text"], **names)
    clean = add_columns(found, ["text", "spans"], "text string", start, ["row"])
    return clean.select(*[F.col("text" if name == text else f"row.`{name}`").alias(name) for name in df.columns])


def without_words(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    data = text.encode()
    mark = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], mark.view(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for span in spans:
        out.append(data[at:first[span["start"]]])
        at = end[span["end"] - 1]
    return b"".join([*out, data[at:]]).decode()


def items_digest(items: list[str]) -> str:
    """What items_sha256 is, in Python."""
    return sha256(",".join(sorted(items)).encode()).hexdigest()
