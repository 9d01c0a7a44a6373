"""Byte-level BPE by a hierarchical-bitmap rank queue, and its inverse."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns, kept_in_worker

#: Pieces whose ids one Python worker remembers beside those of its last batch, and the longest such piece.
REMEMBERED, REMEMBERED_LENGTH = 250_000, 64

#: A rank is `group` (high bits) and a bit of the group's 256-bit word.
GROUP_BITS, GROUP_MASK = 8, 255

#: A pair of ids is one integer: left << PAIR_BITS | right. BARRIER is no id and pairs with none.
PAIR_BITS = 20
BARRIER = (1 << PAIR_BITS) - 1

#: Bytes of new pieces that are merged together.
TOGETHER = 4_000


class Pieces(dict):
    """Ids by piece. A new piece gets an empty list, and stands in `empty` until that is filled.

    `age` sets what is known aside; a piece that is asked for again comes back from there, the rest goes next time.
    """

    def __init__(self):
        super().__init__()
        self.empty: dict[str, list[int]] = {}
        self.aside: dict[str, list[int]] = {}

    def __missing__(self, piece: str) -> list[int]:
        ids = self.aside.get(piece)
        if ids is None:
            ids = self.empty[piece] = []
        self[piece] = ids
        return ids

    def age(self) -> None:
        self.aside = dict(self)
        self.clear()


class Coder:
    """Ids of texts and bytes of ids, by the ranks and the tables made from them.

    Pieces that are not remembered are merged together. Their positions form linked lists with a barrier between
    pieces. Every mergeable pair stands in the bucket of its rank, and two levels of bitmaps say which buckets hold
    anything, so that find-first-set gives the least rank. Entries whose pair has changed since are skipped. Since no
    pair crosses a barrier, each piece sees its own pairs in the order of their ranks, as if it were alone. A piece of
    n bytes takes n log n time at most, however long.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if len(ranks) >= BARRIER:
            raise ValueError("too many ranks")
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in ranks.values()}
        self.own = {rank: rank for rank in ranks.values()}  # one object for each rank, so that ids share few of them
        self.single = [ranks[bytes([value])] for value in range(256)]
        self.remembered = Pieces()
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << PAIR_BITS | right] = rank

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece (of one byte at least)."""
        single, pair = self.single, self.pairs.get
        ids = [BARRIER]
        for piece in pieces:
            ids.extend([single[value] for value in piece])
            ids.append(BARRIER)
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank_at = [pair(left << PAIR_BITS | right, -1) for left, right in zip(ids, ids[1:])]
        rank_at.append(-1)
        buckets: dict[int, list[int]] = {}
        for at, rank in enumerate(rank_at):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(at)
                else:
                    buckets[rank] = [at]
        words: dict[int, int] = {}
        for rank in buckets:
            words[rank >> GROUP_BITS] = words.get(rank >> GROUP_BITS, 0) | 1 << (rank & GROUP_MASK)
        groups = sum(1 << group for group in words)
        while groups:
            group = (groups & -groups).bit_length() - 1
            word = words[group]
            rank = self.own[group << GROUP_BITS | (word & -word).bit_length() - 1]
            words[group] = word = word & word - 1
            if not word:
                groups &= groups - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            fresh = []  # ranks whose buckets are new
            for done, at in enumerate(bucket, 1):
                if rank_at[at] != rank:
                    continue
                gone = after[at]
                right = after[gone]
                left = before[at]
                ids[at], after[at], before[right], rank_at[gone] = rank, right, at, -1
                rank_at[at] = new = pair(rank << PAIR_BITS | ids[right], -1)
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(at)
                    else:
                        buckets[new] = [at]
                        fresh.append(new)
                rank_at[left] = other = pair(ids[left] << PAIR_BITS | rank, -1)
                if other >= 0:
                    if other in buckets:
                        buckets[other].append(left)
                    else:
                        buckets[other] = [left]
                        fresh.append(other)
                if 0 <= new < rank or 0 <= other < rank:  # a smaller rank goes first; the rest waits in its bucket
                    if done < len(bucket):
                        buckets[rank] = bucket[done:]
                        fresh.append(rank)
                    break
            for rank in fresh:
                group = rank >> GROUP_BITS
                words[group] = words.get(group, 0) | 1 << (rank & GROUP_MASK)
                groups |= 1 << group
        out, at = [], 1
        for _ in pieces:
            found = []
            while ids[at] != BARRIER:
                found.append(ids[at])
                at = after[at]
            out.append(found)
            at += 1
        return out

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; pieces that several texts share are merged once."""
        known = self.remembered
        if len(known) > REMEMBERED:
            known.age()
        cut = [list(map(known.__getitem__, self.split(text))) for text in texts]  # lists of ids, new ones still empty
        together, size = [], 0
        for piece, ids in known.empty.items():
            data = piece.encode()
            if data in self.ranks:
                ids.append(self.ranks[data])
                continue
            together.append((data, ids))
            size += len(data)
            if size >= TOGETHER:
                self._fill(together)
                together, size = [], 0
        self._fill(together)
        for piece in known.empty:
            if len(piece) > REMEMBERED_LENGTH:
                del known[piece]
        known.empty.clear()
        for pieces in cut:
            yield list(chain.from_iterable(pieces))

    def _fill(self, together: list[tuple[bytes, list[int]]]) -> None:
        for (_, ids), found in zip(together, self.merge([data for data, _ in together])):
            ids.extend(found)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Vocabulary:
    """Ranks that go to the tasks: the lines of a rank file (base64 token, rank) and the splitting pattern.

    A vocabulary has a fixed size; more than `limit` bytes are refused rather than broadcast.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, limit: int = 32 << 20):
        with open(path, "rb") as file:
            data = file.read(limit + 1)
        if len(data) > limit:
            raise ValueError(f"{path} is larger than {limit} bytes")
        self.sent, self.pattern = spark.sparkContext.broadcast(data), pattern

    def coder(self) -> Coder:
        """The worker's coder; it and the pieces it remembers outlive tasks, until a task of another step begins."""
        def make():
            lines = map(bytes.split, self.sent.value.splitlines())
            return Coder({base64.b64decode(token): int(rank) for token, rank in lines}, self.pattern)
        return kept_in_worker(("coder", hash((self.sent.value, self.pattern))), make)


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `ids`, the token ids of each whole text; null and empty texts have none.

    Row for row, without shuffle. Columns named like the new one are replaced; repeated rows stay. Memory is
    bounded by the longest text, whatever its pre-tokens are.
    """
    def start():
        coder = vocabulary.coder()
        return lambda texts: (list(coder.encode([value or "" for value in texts])),)
    return add_columns(df, [text], "ids array<int>", start, keep)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Adds `decoded`, the bytes of the ids; null and empty arrays give no bytes, unknown ids an error."""
    def start():
        coder = vocabulary.coder()
        return lambda rows: ([coder.decode(values or []) for values in rows],)
    return add_columns(df, [ids], "decoded binary", start, keep)


def round_trip(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encodes and decodes each text in one pass; adds n_tokens, ids_sha256, decoded_sha256, round_trip_ok.

    The digests are those of the ids as decimals joined by commas and of the decoded bytes.
    """
    def start():
        coder = vocabulary.coder()

        def rows(texts):
            counts, of_ids, of_bytes, same = [], [], [], []
            texts = [value or "" for value in texts]
            for value, ids in zip(texts, coder.encode(texts)):
                back = coder.decode(ids)
                counts.append(len(ids))
                of_ids.append(sha256(",".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(sha256(back).hexdigest())
                same.append(back == value.encode())
            return counts, of_ids, of_bytes, same
        return rows
    return add_columns(df, [text], "n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip_ok boolean",
                       start, keep)


def token_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows and tokens for each value of `by`, from n_tokens."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens"))
