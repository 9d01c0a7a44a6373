"""Language identification: script ranges, per-word scores, and Viterbi with a switching penalty."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns, free_name, portions, started

#: A word: a letter, then letters and marks. Longer ones, as of scripts without spaces, are cut.
WORD = r"\p{L}[\p{L}\p{M}]{0,31}"

#: First code points of letter ranges and their scripts.
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
           (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
           (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "other"),
           (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
           (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
           (0xFB00, "latin"), (0xFB13, "other"), (0xFF21, "latin"), (0xFF5B, "other"), (0xFF66, "kana"),
           (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han")]
STARTS = np.array([start for start, _ in SCRIPTS])
NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF = np.array([NAMES.index(name) for _, name in SCRIPTS])

#: Character n-grams of 1 to ORDERS letters are counted in so many slots for each order.
ORDERS, SLOTS = 4, 1 << 16

#: Weight of all languages' counts in one language's; evidence against a word's language outside its scripts.
SMOOTHING, FOREIGN = 100.0, 30.0

#: Words that a worker remembers; words of one Viterbi run, unless one text is longer; words that training counts
#: before it turns them to n-grams; distinct words whose n-grams are made at once; bytes of texts in Python at a time.
REMEMBERED, TOGETHER, COUNTED, SCORED, HELD = 300_000, 200_000, 500_000, 20_000, 4 * 2 ** 20

BREAK = 10  # a line feed stands before and after each word


def ngram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of all words, begin and end included, and the word that each belongs to (ascending)."""
    points = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32).astype(np.uint64)
    edge = points == BREAK
    word = np.cumsum(edge) - 1  # an edge belongs to the word after it
    inner = np.cumsum(np.concatenate([[0], edge]))
    keys, slots, owners = np.zeros(len(points), np.uint64), [], []
    for order in range(1, ORDERS + 1):
        size = len(points) - order + 1
        if size <= 0:
            break
        keys = (keys[:size] * np.uint64(0x100000001B3)) ^ points[order - 1:]
        if order == 1:
            fits = ~edge
        else:
            fits = inner[order - 1:order - 1 + size] == inner[1:size + 1]  # no edge inside
            if order == 2:
                fits = ~(edge[:size] & edge[1:])
        found = np.flatnonzero(fits)
        mixed = keys[found] * np.uint64(0x9E3779B97F4A7C15)
        slots.append((mixed >> np.uint64(48)).astype(np.int64) + (order - 1) * SLOTS)
        owners.append(word[found])
    slots, owners = np.concatenate(slots), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return slots[order], owners[order]


def scripts_of(words: list[str]) -> np.ndarray:
    """The script of each word's first letter."""
    first = np.fromiter((ord(word[0]) for word in words), np.int64, len(words))
    return SCRIPT_OF[np.searchsorted(STARTS, first, side="right") - 1]


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> "Model":
    """Counts n-grams and scripts over all rows with a language and a text.

    The counts have at most ORDERS * SLOTS + scripts numbers for each language, whatever the input's size; tasks add
    up their own rows first.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = started(lambda: regex.compile(WORD).findall)
        words: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}

        seen = 0

        def count():
            for name, counted in words.items():
                own = sums.setdefault(name, np.zeros(ORDERS * SLOTS + len(NAMES)))
                known = list(counted)
                for at in range(0, len(known), SCORED):
                    some = known[at:at + SCORED]
                    slots, owners = ngram_slots(some)
                    times = np.fromiter((counted[word] for word in some), np.int64, len(some))
                    own += np.bincount(slots, times[owners], len(own))
                    own += np.bincount(ORDERS * SLOTS + scripts_of(some), times, len(own))
            words.clear()
        for part in (part.slice(begin, end - begin) for part in parts for begin, end in portions(part.column(1), HELD)):
            for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = find(value.lower())
                if found:
                    words.setdefault(name, Counter()).update(found)
                    seen += len(found)
                    if seen > COUNTED:
                        count()
                        seen = 0
        count()
        for name, own in sums.items():
            place = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(place)), pa.array(place.astype(np.int32)),
                                              pa.array(own[place].astype(np.int64))], ["lang", "place", "n"])

    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    counts = (known.mapInArrow(run, "lang string, place int, n bigint").groupBy("lang", "place")
              .agg(F.sum("n").alias("n")).toArrow())
    return Model.of(counts.column("lang").to_pylist(), counts.column("place").to_numpy(), counts.column("n").to_numpy())


class Model:
    """langs (sorted), table (n-gram slots x langs: log shares), allowed (scripts x langs)."""

    def __init__(self, langs: list[str], table: np.ndarray, allowed: np.ndarray):
        self.langs, self.table, self.allowed = langs, table, allowed

    @staticmethod
    def of(names: list[str], places: np.ndarray, counts: np.ndarray) -> "Model":
        langs = sorted(set(names))
        own = np.zeros((len(langs), ORDERS * SLOTS + len(NAMES)))
        number = {name: at for at, name in enumerate(langs)}
        own[[number[name] for name in names], places] = counts
        grams = own[:, :ORDERS * SLOTS].reshape(len(langs), ORDERS, SLOTS)
        scripts = own[:, ORDERS * SLOTS:]
        everywhere = grams.sum(axis=0) + 0.5
        everywhere /= everywhere.sum(axis=1, keepdims=True)
        shares = (grams + SMOOTHING * everywhere) / (grams.sum(axis=2, keepdims=True) + SMOOTHING)
        table = np.log(shares).reshape(len(langs), ORDERS * SLOTS).T / ORDERS
        allowed = scripts >= 0.01 * np.maximum(1, scripts.sum(axis=1, keepdims=True))
        return Model(langs, np.ascontiguousarray(table, np.float32), allowed.T | ~allowed.any(axis=0)[:, None])

    def scores(self, words: list[str]) -> np.ndarray:
        """Log scores, words x langs, relative to the best; languages outside the word's script fall back."""
        slots, owners = ngram_slots(words)
        out = np.add.reduceat(self.table[slots], np.searchsorted(owners, np.arange(len(words))), axis=0)
        out = out - FOREIGN * ~self.allowed[scripts_of(words)]
        return (out - out.max(axis=1, keepdims=True)).astype(np.float32)


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The labels that maximise scores minus `penalty` for each change, where a `first` word may follow any label.

    The sequence is cut into about sqrt(n) chunks that advance together: once from every entry label, which links the
    chunks, and once from the right entry, which keeps the way back.
    """
    size, labels = scores.shape
    if not size or labels == 1:
        return np.zeros(size, np.int64)
    length = int(np.sqrt(size)) + 1
    chunks = -(-size // length)
    padded = np.zeros((chunks * length, labels))
    padded[:size] = scores
    cost = np.zeros(chunks * length)
    cost[:size] = np.where(first, 0.0, penalty)
    steps = np.ascontiguousarray(padded.reshape(chunks, length, labels).transpose(1, 2, 0))  # step, label, chunk
    del padded
    cost = np.ascontiguousarray(cost.reshape(chunks, length).T)
    reach = np.repeat(np.where(np.eye(labels, dtype=bool), 0.0, -1e15)[:, :, None], chunks, axis=2)  # label, entry, chunk
    for at in range(length):
        switched = reach.max(axis=0) - cost[at]
        reach = np.maximum(reach, switched) + steps[at][:, None, :]
    entry, value = np.zeros((labels, chunks)), np.zeros(labels)
    for chunk in range(chunks):
        entry[:, chunk] = value
        value = (reach[:, :, chunk] + value).max(axis=1)
        value -= value.max()
    small = np.min_scalar_type(labels)
    back = np.empty((length, labels, chunks), small)
    here = np.arange(labels)[:, None]
    for at in range(length):
        switched = entry.max(axis=0) - cost[at]
        back[at] = np.where(entry >= switched, here, entry.argmax(axis=0))
        entry = np.maximum(entry, switched) + steps[at]
    state = np.repeat(here, chunks, axis=1)
    del steps
    ways = np.empty((length, labels, chunks), small)
    for at in range(length - 1, -1, -1):
        ways[at] = state
        state = np.take_along_axis(back[at], state, axis=0)
    ends = np.empty(chunks, np.int64)
    end = int(entry[:, -1].argmax())
    for chunk in range(chunks - 1, -1, -1):
        ends[chunk] = end
        end = int(state[end, chunk])
    return ways[:, ends, np.arange(chunks)].T.reshape(-1)[:size].astype(np.int64)


class Words(dict):
    """Numbers of words by word, and the words that have no scores yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Labeller:
    """Labels texts; remembers the scores of words."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self.find = regex.compile(WORD).findall
        self.forget()

    def forget(self):
        self.words, self.known = Words(), np.empty((0, len(self.model.langs)), np.float32)

    def label(self, texts: list[str]) -> Iterator[tuple[str, float, list[dict]]]:
        some, size = [], 0
        for text in texts:
            found = self.find(text.lower())
            some.append(found)
            size += len(found)
            if size >= TOGETHER:
                yield from self._label(some)
                some, size = [], 0
        yield from self._label(some)

    def _label(self, texts: list[list[str]]) -> Iterator[tuple[str, float, list[dict]]]:
        langs = self.model.langs
        if not langs:
            yield from (("und", 0.0, []) for _ in texts)
            return
        if len(self.words) > REMEMBERED:
            self.forget()
        flat = [word for words in texts for word in words]
        numbers = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        if self.words.new:
            fresh = [self.model.scores(self.words.new[at:at + SCORED]) for at in range(0, len(self.words.new), SCORED)]
            self.known = np.concatenate([self.known, *fresh])
            self.words.new = []
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(counts)
        first = np.zeros(len(flat), bool)
        first[(ends - counts)[counts > 0]] = True
        path = best_path(self.known[numbers], first, self.penalty)
        text_of = np.repeat(np.arange(len(texts)), counts)
        letters = np.fromiter(map(len, flat), np.int64, len(flat))
        by = np.bincount(text_of * len(langs) + path, letters, len(texts) * len(langs)).reshape(len(texts), len(langs))
        starts = np.flatnonzero(first | np.concatenate([[True], path[1:] != path[:-1]])[:len(path)])
        spans: list[list[dict]] = [[] for _ in texts]
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(flat)]):
            base = int(ends[text_of[start]] - counts[text_of[start]])
            spans[text_of[start]].append({"start": start - base, "end": end - base, "lang": langs[path[start]]})
        for at in range(len(texts)):
            if counts[at]:
                most = int(by[at].argmax())
                yield langs[most], float(by[at, most] / by[at].sum()), spans[at]
            else:
                yield "und", 0.0, []


OUT = "lang_pred string, score double, lang_spans array<struct<start:bigint,end:bigint,lang:string>>"


def identify(df: DataFrame, model: Model, text: str = "text", penalty: float = 4.0,
             keep: list[str] | None = None) -> DataFrame:
    """Adds lang_pred, score, lang_spans to each row, by its whole text alone.

    lang_spans are runs of words [start, end) in one language, as Viterbi labels them; a change costs `penalty`.
    lang_pred is the language of most letters (of equal ones the first by name), score its share of them. Null texts
    and texts without a letter are `und` with score 0. A text whose script no language was learned with gets the
    language that fits best. Repeated rows stay; columns named like new ones are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast((model.langs, model.table, model.allowed))

    def start():
        labeller = Labeller(Model(*sent.value), penalty)

        def rows(texts):
            return tuple(zip(*labeller.label([value or "" for value in texts]))) or ([], [], [])
        return rows
    return add_columns(df, [text], OUT, start, keep, HELD)


def remainder(id: Column, modulus: int) -> Column:
    """crc32 of an id's text, modulo."""
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(modulus))


def keep_identified(df: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose text has a language with at least the share `least` of its letters, with their columns."""
    # the text is sent once; the other columns travel in one struct, so that none of them meets a new one
    row = F.struct(*[df[name] for name in df.columns if name != text], F.lit(0).alias(free_name(df)))
    inner = df.select(row.alias("_row"), F.col(text).alias("_text"))
    found = identify(inner, model, "_text").where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.select(*[F.col("_text" if name == text else f"_row.`{name}`").alias(name) for name in df.columns])
