"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value statistics over them."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns
from reviewlake.llm.languages import remainder
from reviewlake.session import materialize

#: A token: letters and marks, apostrophes inside.
TOKEN = r"\p{L}[\p{L}\p{M}]*(?:['’]\p{L}[\p{L}\p{M}]*)*"


@dataclass(frozen=True)
class Settings:
    """sample: labelled rows that the model is fitted on at most; tokens: those with a weight at most (by |z|).

    prior: texts that are added to each unit's, dealt to the classes as all units are, so that units of few texts have
    a small weight; levels: least |log-odds / deviation| of a unit with a weight, of which the one that foretells other
    texts best is taken; folds: parts of the rows for that; drift: score of every other token; significant: largest
    chance of a segment's score by accident; stems: lengths of the beginnings that stand for a token without a weight
    of its own.
    """

    sample: int = 200_000
    tokens: int = 200_000
    prior: float = 3.0
    levels: tuple[float, ...] = (2.0, 2.5, 3.0, 3.5, 4.0, 5.0)
    folds: int = 5
    drift: float = -0.15
    stems: tuple[int, ...] = (7, 6, 5, 4)
    significant: float = 0.01


@dataclass(frozen=True)
class Model:
    """weights of tokens, drift of the others, the extreme-value parameters and the logistic curve over them."""

    weights: dict[str, float]
    drift: float
    decay: float
    log_k: float
    intercept: float
    slope: float
    significant: float
    stems: tuple[int, ...]


class Weights(dict):
    """Weight of a token: its own, else that of its longest beginning with one, else None. Remembers tokens."""

    def __init__(self, known: dict[str, float], stems: tuple[int, ...], most: int = 400_000):
        super().__init__()
        self.known, self.stems, self.most = known, stems, most

    def __missing__(self, token: str) -> float | None:
        if len(self) > self.most:
            self.clear()
        weight = self.known.get(token)
        for size in self.stems:
            if weight is None and len(token) > size:
                weight = self.known.get(token[:size] + "-")
        self[token] = weight
        return weight


class LevelWeights(dict):
    """A token's weights at each level, chosen as Weights does; None for a token without any. Remembers tokens."""

    def __init__(self, place: dict[str, int], odds: np.ndarray, z: np.ndarray, settings: Settings, most: int = 80_000):
        super().__init__()
        self.place, self.odds, self.z, self.settings, self.most = place, odds, z, settings, most

    def __missing__(self, token: str) -> list[float | None] | None:
        if len(self) > self.most:
            self.clear()
        found: list[float | None] = [None] * len(self.settings.levels)
        for unit in units(token, self.settings.stems):
            at = self.place.get(unit)
            if at is not None:
                for level, least in enumerate(self.settings.levels):
                    if found[level] is None and abs(self.z[at]) >= least:
                        found[level] = float(self.odds[at])
        self[token] = out = None if found.count(None) == len(found) else found
        return out


def units(token: str, stems: tuple[int, ...]) -> list[str]:
    """What is counted for a token: itself and its beginnings, which end with a hyphen."""
    return [token] + [token[:size] + "-" for size in stems if len(token) > size]


def segments(hits: list[tuple[int, float]], drift: float, size: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end) of `size` tokens with their scores, in linear time.

    hits: places and weights of the tokens that do not score `drift`. A segment is maximal if no part of it scores
    more and none that holds it has all of its parts as positive as it is (Ruzzo and Tompa's definition).
    """
    found: list[tuple[int, int, float, float]] = []  # start, end, total before, total at the end
    total, last, links = 0.0, 0, []  # links: the nearest earlier segment with a smaller total before it
    for at, weight in hits:
        before = total + drift * (at - last)
        total, last = before + weight, at + 1
        if weight <= 0:
            continue
        start, low, high = at, before, total
        while True:
            place = len(found) - 1
            while place >= 0 and found[place][2] >= low:
                place = links[place]
            if place < 0 or found[place][3] >= high:
                found.append((start, at + 1, low, high))
                links.append(place)
                break
            start, low = found[place][0], found[place][2]
            del found[place:], links[place:]
    return [(start, end, high - low) for start, end, low, high in found]


def token_places(text: str, find, weights: Weights) -> tuple[int, list[tuple[int, float]]]:
    found = list(map(weights.__getitem__, find(text.lower())))
    return len(found), [(at, weight) for at, weight in enumerate(found) if weight is not None]


def excess(size: int, scores: list[float], decay: float, log_k: float) -> list[float]:
    """Each segment's score above what the best one of so many tokens has by accident, in extreme-value units."""
    return [decay * score - log_k - math.log(size) for score in scores]


def statistic(size: int, scores: list[float], decay: float, log_k: float) -> float:
    """A text's evidence: how far its segments together are above accident; 0 without any."""
    return min(50.0, sum(max(0.0, each) for each in excess(size, scores, decay, log_k)))


def _counted(batches, find, stems) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, toxics, folds = (column.to_pylist() for column in batch.columns)
        for fold in sorted(set(folds)):
            tokens: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for value, toxic, own in zip(texts, toxics, folds):
                if own == fold:
                    tokens[toxic].update(set(find((value or "").lower())))  # once a text: a text that repeats itself proves no more
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for toxic, counted in tokens.items():
                for token, times in counted.items():
                    for unit in units(token, stems):
                        counts[toxic][unit] += times
            found = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([fold] * len(found), pa.int32()),
                                              pa.array([counts[1][t] for t in found], pa.int64()),
                                              pa.array([counts[0][t] for t in found], pa.int64())], ["unit", "fold", "toxic", "clean"])


def labelled_rows(documents: DataFrame, labels: DataFrame, fit: Column, sample: int, folds: int, text: str, id: str) -> DataFrame:
    """Text, toxic and fold of at most `sample` labelled rows (those of least hash), which are broadcast by id.

    An id counts as toxic if one of its labels says so; null ids and labels are left out.
    """
    known = (labels.where(fit & F.col(id).isNotNull() & F.col("toxic").isNotNull()).groupBy(id)
             .agg((F.max("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64(id), id).limit(sample)
             .select(F.col(id).alias("_id"), F.col("toxic").alias("_toxic")))
    fold = F.pmod(F.xxhash64("_id"), F.lit(folds))
    return documents.join(F.broadcast(known), documents[id] == F.col("_id")).select(
        documents[text].alias("text"), F.col("_toxic").alias("toxic"), fold.cast("int").alias("fold"))


def log_odds(toxic, clean, n1: float, n0: float, prior: float, log, sqrt):
    """Log-odds of a unit in toxic and clean texts and their number of deviations, of columns or arrays."""
    one, none = prior * n1 / (n1 + n0), prior * n0 / (n1 + n0)
    a, b = toxic + one, clean + none
    odds = log(a / (n1 + one)) - log(b / (n0 + none))
    return odds, odds / sqrt(1 / a + 1 / b)


def growth(clean: np.ndarray, odds: np.ndarray, n0: float, drift: float) -> float:
    """The decay of segment scores, by how often a clean text's token has each weight.

    Tokens that only a beginning scores are counted with it.
    """
    share, score = np.append(clean / n0, 0.0), np.append(odds, drift)
    share /= max(1.0, 2 * share.sum())
    share[-1] = 1 - share.sum()
    return root_of_growth(share, score)


#: Widths of the bins in which scores (in units of their decay) and statistics are counted.
SCORE_BIN, STATISTIC_BIN = 0.02, 0.01


def train(documents: DataFrame, labels: DataFrame, fit: Column, settings: Settings = Settings(), text: str = "text",
          id: str = "doc_id") -> Model:
    """Fits a model on the labelled rows that `fit` (over the labels' id) admits.

    All rows give the log-odds of units. For the extreme-value parameters, the curve and the level, each fold is
    scored by the log-odds of the other folds, so that these see weights of other texts.
    """
    rows = labelled_rows(documents, labels, fit, settings.sample, settings.folds, text, id)
    stems, drift, levels, folds = settings.stems, settings.drift, settings.levels, range(settings.folds)

    def count(batches):
        yield from _counted(batches, regex.compile(TOKEN).findall, stems)
    kinds = ("toxic", "clean")
    counts = materialize(rows.select("text", "toxic", "fold").mapInArrow(count, "unit string, fold int, toxic bigint, clean bigint")
                         .groupBy("unit").agg(*[F.sum(F.when(F.col("fold") == fold, F.col(kind)).otherwise(0)).alias(f"{kind}{fold}")
                                                for kind in kinds for fold in folds]), "token-counts")
    sums = counts.where(~F.endswith("unit", F.lit("-"))).agg(*[F.sum(name).alias(name) for name in counts.columns[1:]]).first()
    own = {kind: [float(sums[f"{kind}{fold}"] or 0) for fold in folds] for kind in kinds}
    n1, n0 = sum(own["toxic"]), sum(own["clean"])
    if not n1 or not n0:  # nothing to tell apart
        return Model({}, drift, 1.0, 0.0, -3.0, 0.0, settings.significant, stems)
    every = {kind: sum((F.col(f"{kind}{fold}") for fold in folds), F.lit(0)) for kind in kinds}
    sizes = [(n1 - one, n0 - none) for one, none in zip(own["toxic"], own["clean"])]  # of all folds but one
    parted = [fold for fold in folds if sizes[fold][0] and sizes[fold][1]]
    z = [log_odds(every["toxic"], every["clean"], n1, n0, settings.prior, F.log, F.sqrt)[1]]
    z += [log_odds(every["toxic"] - F.col(f"toxic{fold}"), every["clean"] - F.col(f"clean{fold}"), *sizes[fold],
                   settings.prior, F.log, F.sqrt)[1] for fold in parted]
    z = F.array_max(F.array(*[F.abs(each) for each in z]))
    top = (counts.withColumn("z", z).where(F.col("z") >= min(levels)).orderBy(F.desc("z"), "unit").limit(settings.tokens)
           .drop("z").toArrow())
    names = top["unit"].to_pylist()
    seen = {kind: np.stack([top[f"{kind}{fold}"].to_numpy().astype(float) for fold in folds]) for kind in kinds}
    toxic, clean = seen["toxic"].sum(axis=0), seen["clean"].sum(axis=0)
    odds, deviations = log_odds(toxic, clean, n1, n0, settings.prior, np.log, np.sqrt)
    sets, decays = {}, {}
    for fold in folds:
        if fold in parted:
            sets[fold] = log_odds(toxic - seen["toxic"][fold], clean - seen["clean"][fold], *sizes[fold], settings.prior, np.log, np.sqrt)
        else:  # the other folds have one class only
            sets[fold] = np.zeros(len(names)), np.zeros(len(names))
        for level, least in enumerate(levels):
            has = np.abs(sets[fold][1]) >= least
            decays[fold, level] = growth((clean - seen["clean"][fold])[has], sets[fold][0][has], max(1.0, sizes[fold][1]), drift)
    sent = rows.sparkSession.sparkContext.broadcast((names, sets, decays))

    def scored(batches):
        names, sets, decays = sent.value
        place = {name: at for at, name in enumerate(names)}
        find, weights = regex.compile(TOKEN).findall, {fold: LevelWeights(place, *each, settings) for fold, each in sets.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                out: tuple[list, ...] = [], [], [], []
                for value, label, fold in zip(*(column.slice(start, 500).to_pylist() for column in batch.columns)):
                    found = list(map(weights[fold].__getitem__, find((value or "").lower())))
                    hits = [(at, each) for at, each in enumerate(found) if each is not None]
                    for level in range(len(levels)):
                        parts = segments([(at, each[level]) for at, each in hits if each[level] is not None], drift, len(found))
                        out[0].append(level)
                        out[1].append(label)
                        out[2].append(len(found))
                        out[3].append([part[2] * decays[fold, level] for part in parts])
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                                                  pa.array(out[3], pa.list_(pa.float32()))], ["level", "toxic", "size", "scores"])
    cross = materialize(rows.select("text", "toxic", "fold").mapInArrow(
        scored, "level int, toxic int, size bigint, scores array<float>"), "cross-fitted")
    log_ks = accidents(cross, len(levels))
    best = None
    for level, (intercept, slope, loss) in sorted(curves(cross, log_ks).items(), reverse=True):
        if best is None or loss < best[0] - 1e-9:
            best = loss, level, intercept, slope
    _, level, intercept, slope = best
    has = np.abs(deviations) >= levels[level]
    decay = growth(clean[has], odds[has], n0, drift)
    weights = {name: float(each) for name, each, taken in zip(names, odds, has) if taken}
    return Model(weights, drift, decay, log_ks[level], intercept, slope, settings.significant, stems)


def accidents(cross: DataFrame, levels: int) -> list[float]:
    """Log K of each level: clean segments that score s or more are K * tokens * exp(-s), counted from the median on.

    Scores are in units of their decay; the median is that of a histogram, whose edges are counted exactly.
    """
    clean = cross.where((F.col("toxic") == 0) & (F.col("size") > 0))
    sizes = {row.level: row.n for row in clean.groupBy("level").agg(F.sum("size").alias("n")).collect()}

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            scores = batch.column(1)
            level = np.repeat(batch.column(0).to_numpy(), scores.value_lengths().to_numpy())
            bin = np.floor(np.minimum(scores.flatten().to_numpy(), 200.0) / SCORE_BIN).astype(np.int64)
            for (one, other), n in zip(*(each.tolist() for each in np.unique(np.stack([level, bin], axis=1), axis=0, return_counts=True))):
                seen[one, other] += n
        yield pa.RecordBatch.from_arrays([pa.array([key[0] for key in seen], pa.int32()), pa.array([key[1] for key in seen], pa.int64()),
                                          pa.array(list(seen.values()), pa.int64())], ["level", "bin", "n"])
    bins = (clean.select("level", "scores").mapInArrow(count, "level int, bin bigint, n bigint")
            .groupBy("level", "bin").agg(F.sum("n").alias("n")).collect())
    out = []
    for level in range(levels):
        found = sorted((row.bin, row.n) for row in bins if row.level == level)
        total, passed, least, above = sum(n for _, n in found), 0, 1.0, 0
        for bin, n in found:
            if 2 * (passed + n) > total:
                least, above = bin * SCORE_BIN, total - passed
                break
            passed += n
        out.append(math.log((above + 1) / (sizes.get(level, 0) + 1)) + least)
    return out


def curves(cross: DataFrame, log_ks: list[float]) -> dict[int, tuple[float, float, float]]:
    """Intercept, slope and mean loss of the logistic curve of each level, over a histogram of the texts' statistics."""
    log_k = F.element_at(F.array(*[F.lit(each) for each in log_ks]), F.col("level") + 1)
    accident = log_k + F.log(F.greatest(F.lit(1), F.col("size")))
    x = F.least(F.lit(50.0), F.aggregate(F.transform("scores", lambda score: F.greatest(F.lit(0.0), score - accident)), F.lit(0.0),
                                         lambda total, each: total + each))
    bins = cross.groupBy("level", "toxic", F.round(x / STATISTIC_BIN).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for level in {row.level for row in bins}:
        found = [row for row in bins if row.level == level]
        x, y, n = (np.array([value(row) for row in found], float) for value in
                   (lambda row: row.bin * STATISTIC_BIN, lambda row: row.toxic, lambda row: row.n))
        intercept, slope = logistic(x, y, n)
        p = 1 / (1 + np.exp(-np.clip(intercept + slope * x, -30, 30)))
        out[level] = intercept, slope, float(-(n * np.log(np.where(y > 0, p, 1 - p))).sum() / n.sum())
    return out


def root_of_growth(share: np.ndarray, score: np.ndarray) -> float:
    """The positive decay at which sum(share * exp(decay * score)) is 1; such a one exists for a negative mean."""
    if not (score[share > 0] > 0).any() or (share * score).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    value = lambda decay: float(np.log(share[share > 0] @ np.exp(decay * score[share > 0])))
    while value(high) < 0:
        low, high = high, 2 * high
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope over `n` rows each, by Newton's method, with Platt's targets so that separable rows stay finite."""
    ones, rows = (n * y).sum(), n.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (rows - ones + 2))
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (target - p)) - 1e-6 * beta
        curve = (design * (n * (p * (1 - p) + 1e-9))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


OUT = "score double, toxic_passages array<struct<start:bigint,end:bigint,score:double,p_value:double>>"


def score_texts(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds score (0 to 1) and toxic_passages to each row, by its whole text alone.

    Passages are the maximal scoring token segments [start, end) whose score has at most the model's `significant`
    chance by accident in a clean text of this length. Null and empty texts have none, and the score of texts without
    evidence. Row for row; repeated rows stay and columns named like new ones are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model, find = sent.value, regex.compile(TOKEN).findall
        weights = Weights(model.weights, model.stems)

        def rows(texts):
            scores, passages = [], []
            for value in texts:
                size, hits = token_places(value or "", find, weights)
                found = segments(hits, model.drift, size)
                each = [score for _, _, score in found]
                x = statistic(max(1, size), each, model.decay, model.log_k)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.intercept + model.slope * x)))))
                chance = [-math.expm1(-math.exp(min(30.0, -value))) for value in
                          excess(max(1, size), each, model.decay, model.log_k)]
                passages.append([{"start": a, "end": b, "score": score, "p_value": p}
                                 for (a, b, score), p in zip(found, chance) if p <= model.significant])
            return scores, passages
        return rows
    return add_columns(df, [text], OUT, start, keep)


def held_out(id: Column) -> Column:
    """Rows that the contract keeps from training: crc32 of the id's text modulo 3 is 1."""
    return F.coalesce(remainder(id, 3) == 1, F.lit(False))
