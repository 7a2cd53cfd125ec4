"""Toxic passages by maximum-scoring segments.

A token's score is its log-odds of toxic against other text, with Dirichlet priors that step from the
first four letters of a word over longer beginnings to the word, less a cost per token, so that
ordinary text drifts down. A linear scan finds all maximal segments of a text. Extreme-value
statistics turn segment scores into evidence: the chance of a score over x falls with exp(-decay * x),
where decay solves sum(p * exp(decay * score)) = 1 over the tokens of clean texts, and grows with the
text's length. A logistic curve turns a text's summed evidence into its score.

Counts are kept in hashed slots, so the model has one size whatever the vocabulary. Folds come from
crc32 of the document's id modulo 5: 0 is held out, 1 to 3 give the counts, 4 the calibration.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, table
from siltline.llm.contamination import words_of

SLOTS = 1 << 20  # per level of the model
LEVELS = (4, 5, 6, 7, None)  # letters of a word that a level looks at
STRENGTH = 10.0  # tokens that a prior is worth
COST = 0.5  # per token
LEAST = 2.0  # segments below this score are not reported
STEP = 0.05  # bins of the calibration


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _slots(word: bytes) -> list[int]:
    letters = word.decode("utf-8", "replace")
    return [xxhash.xxh64_intdigest(letters[:n], seed=i) & (SLOTS - 1) for i, n in enumerate(LEVELS)]


class _WordSlots(dict):
    def __missing__(self, word: bytes) -> list[int]:
        self[word] = found = _slots(word)
        return found


@dataclass
class ToxicModel:
    """Slot scores by level (log-odds with that level's prior below it) and the calibration."""

    toxic: np.ndarray  # counts: level, slot
    other: np.ndarray
    rate: float  # of toxic tokens among all counted
    decay: float = 1.0  # Gumbel: chance of a segment over x in n tokens is about size * n * exp(-decay * x)
    size: float = 1.0
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)  # of evidence, length and one

    def word_score(self, word: bytes) -> float:
        share, wider = self.rate, math.inf
        for level, slot in enumerate(_slots(word)):
            t, o = float(self.toxic[level, slot]), float(self.other[level, slot])
            if t + o < 0.7 * wider:  # else the level sees the tokens of the one before again
                share, wider = (t + STRENGTH * share) / (t + o + STRENGTH), t + o
        return math.log(share / (1 - share)) - math.log(self.rate / (1 - self.rate)) - COST


class _WordScores(dict):
    def __init__(self, model: ToxicModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        self[word] = found = self.model.word_score(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))


def best_segment(scores: np.ndarray) -> float:
    if not len(scores):
        return 0.0
    total = np.cumsum(scores)
    before = np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))
    return max(0.0, float((total - before).max()))


def maximal_segments(scores: np.ndarray, least: float = LEAST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of at least ``least``, in linear time.

    Candidates stand on a stack with the totals before and behind them; a new positive token is merged
    with every candidate that ends lower and begins lower.
    """
    if best_segment(scores) < least:
        return []
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    # stack: start, end, total before, total behind, and the nearest candidate with a lower begin
    stack: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, before, behind = i, i + 1, float(totals[i]), float(totals[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= behind:
                stack.append((start, end, before, behind, j))
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, b - a) for s, e, a, b, _ in stack if b - a >= least]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per level, slot and label the tokens of this task."""
    slots, counts = _WordSlots(), np.zeros((2, len(LEVELS), SLOTS), np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            words = words_of(text.as_py())
            if len(slots) > 300_000:
                slots.clear()
            if words:
                found = np.array([slots[w] for w in words])
                for level in range(len(LEVELS)):
                    np.add.at(counts[int(toxic), level], found[:, level], 1)
    for level in range(len(LEVELS)):
        held = np.flatnonzero(counts[:, level].any(axis=0))
        for at in range(0, len(held), 50_000):
            some = held[at:at + 50_000]
            yield pa.RecordBatch.from_pydict({
                "level": np.full(len(some), level, np.int32), "slot": some.astype(np.int32),
                "other": counts[0, level, some], "toxic": counts[1, level, some],
            })


BINS = np.arange(-8.0, 20.05, 0.05)


def _measured(batches: Iterator[pa.RecordBatch], model: ToxicModel) -> Iterator[pa.RecordBatch]:
    """Per text its label, length, best segment and segments; behind them one row with how many tokens
    of this task's clean texts score in each bin."""
    scores, counts = _WordScores(model), np.zeros(len(BINS) - 1, np.int64)
    for batch in batches:
        values = [scores.of(words_of(t.as_py())) for t in batch.column(0)]
        for v, toxic in zip(values, batch.column(1).to_pylist()):
            if not toxic:
                counts += np.histogram(np.clip(v, BINS[0], BINS[-1]), BINS)[0]
        yield pa.RecordBatch.from_pydict({
            "toxic": batch.column(1), "n": pa.array([len(v) for v in values], pa.int64()),
            "best": pa.array([best_segment(v) for v in values], pa.float64()),
            "segments": pa.array([[s for _, _, s in maximal_segments(v)] for v in values], pa.list_(pa.float64())),
            "tokens": pa.nulls(len(values), pa.list_(pa.int64())),
        })
    yield pa.RecordBatch.from_pydict({
        "toxic": pa.nulls(1, pa.int32()), "n": pa.nulls(1, pa.int64()), "best": pa.nulls(1, pa.float64()),
        "segments": pa.nulls(1, pa.list_(pa.float64())), "tokens": pa.array([counts.tolist()], pa.list_(pa.int64())),
    })


def evidence(segments: list[float], best: float, n: int, model: ToxicModel) -> float:
    """Summed log of how much rarer than chance the significant segments are; of the best, if none is."""
    chance = math.log(model.size * max(n, 1))
    beyond = [x for s in segments if (x := model.decay * s - chance) > 0]
    return sum(beyond) if beyond else model.decay * best - chance


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """A model from the labelled rows outside fold 0.

    Rows with null id, label or text are not learnt from; without any labelled row of both kinds every
    text scores the same. Repeated labels count as often as they stand.
    """
    spark, place = docs.sparkSession, Workspace(docs.sparkSession, "toxicity")
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def labelled(part: Column) -> DataFrame:
        """Text and label of the rows in some folds; sorted and merged at any size of the labels."""
        return texts.where(part).hint("merge").join(known.where(part), "doc_id").select("text", "toxic")

    number = fold(F.col("doc_id"))
    summed = (
        labelled(number.isin(1, 2, 3)).mapInArrow(_counted, "level int, slot int, other long, toxic long")
        .groupBy("level", "slot").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    )
    # At most one row per level and slot, however large the corpus.
    got = summed.toArrow()
    counts = np.zeros((2, len(LEVELS), SLOTS), np.float32)
    where = got.column("level").to_numpy(), got.column("slot").to_numpy()
    counts[0][where], counts[1][where] = got.column("other").to_numpy(), got.column("toxic").to_numpy()
    other, toxic = counts[0, -1].sum(dtype=float), counts[1, -1].sum(dtype=float)
    model = ToxicModel(counts[1], counts[0], (toxic + 1) / (toxic + other + 2))

    shared = spark.sparkContext.broadcast(model)
    scored = place.keep(
        labelled(number == 4).mapInArrow(lambda b: _measured(b, shared.value), "toxic int, n long, best double, segments array<double>, tokens array<long>"),
        "calibration",
    )
    tokens = scored.where("tokens IS NOT NULL").select(F.posexplode("tokens").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n"))
    model.decay = _decay(tokens.where("n > 0").collect())  # as many rows as bins at most
    _calibrate(model, scored.where("tokens IS NULL").drop("tokens"))
    place.drop("calibration")
    return model


def _decay(rows: list) -> float:
    """The positive root of sum(p * exp(decay * score)) = 1; 1 where scores never rise or never fall."""
    score, n = np.array([(BINS[r["bin"]] + BINS[r["bin"] + 1]) / 2 for r in rows]), np.array([r["n"] for r in rows], float)
    if not len(score) or score.max() <= 0 or (score * n).sum() >= 0:
        return 1.0
    low, high = 0.0, 20.0
    for _ in range(80):
        middle = (low + high) / 2
        over = (n / n.sum() * np.exp(np.minimum(middle * score, 300))).sum() > 1
        low, high = (low, middle) if over else (middle, high)
    return max(low, 0.05)


def _calibrate(model: ToxicModel, scored: DataFrame) -> None:
    length = F.log(F.greatest("n", F.lit(1)))
    middle = scored.where("toxic = 0").agg(F.percentile_approx(F.col("best") * model.decay - length, 0.5, 10_000)).first()[0]
    if middle is not None:
        model.size = math.exp(min(max(middle - 0.3665, -30.0), 30.0))  # 0.3665: the median of a standard Gumbel law
    chance = F.log(F.lit(model.size) * F.greatest("n", F.lit(1)))
    beyond = F.filter(F.transform("segments", lambda s: s * model.decay - chance), lambda x: x > 0)
    total = F.when(F.size(beyond) > 0, F.aggregate(beyond, F.lit(0.0), lambda t, x: t + x)).otherwise(F.col("best") * model.decay - chance)
    bins = F.round(F.when(total > 0, F.log1p(total)).otherwise(total / 10) / STEP), F.round(length / (5 * STEP))
    # As many rows as bins at most: both axes are logarithmic and end.
    rows = scored.groupBy(F.greatest(bins[0], F.lit(-100)).alias("x"), bins[1].alias("n"), "toxic").count().collect()
    x = np.array([(r["x"] * STEP, r["n"] * 5 * STEP, 1.0) for r in rows]).reshape(-1, 3)
    model.weights = _logistic(x, np.array([r["toxic"] for r in rows], float), np.array([r["count"] for r in rows], float))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """Weights by Newton's method, with a weak pull to zero."""
    beta = np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (w * (y - p)) - 0.01 * beta
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        step = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])), float(beta[1]), float(beta[2])


def score_of(scores: np.ndarray, model: ToxicModel) -> tuple[float, list[tuple[int, int, float]]]:
    """The text's score, and its significant segments with what each goes beyond chance."""
    found = maximal_segments(scores)
    total = evidence([s for _, _, s in found], best_segment(scores), len(scores), model)
    chance = math.log(model.size * max(len(scores), 1))
    passages = [(a, b, x) for a, b, s in found if (x := model.decay * s - chance) > 0]
    x = math.log1p(total) if total > 0 else max(total / 10, -100 * STEP)
    raised = model.weights[0] * x + model.weights[1] * math.log(max(len(scores), 1)) + model.weights[2]
    return 1 / (1 + math.exp(-min(max(raised, -40), 40))), passages


def passages(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Per row: doc_id, score, and the toxic passages as (first word, end, evidence).

    Null and empty texts have no words and score what an empty text does; equal texts score the same;
    an empty table gives no rows. Of other columns none is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the corpus

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _WordScores(shared.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))
        for batch in batches:
            found = [score_of(scores.of(words_of(t.as_py())), shared.value) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "score": pa.array([s for s, _ in found], pa.float64()),
                "passages": pa.array([[{"start": a, "end": b, "evidence": x} for a, b, x in p] for _, p in found], kind),
            })

    schema = "doc_id long, score double, passages array<struct<start: int, end: int, evidence: double>>"
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(look, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with their columns, that score below ``threshold``."""
    shared, at = docs.sparkSession.sparkContext.broadcast(fit(docs, labels)), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _WordScores(shared.value)
        for batch in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else None for t in batch.column(at))
            kept = [score_of(scores.of(words_of(t)), shared.value)[0] < threshold for t in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score; labels are learnt from outside the held-out fold only."""
    docs = table(spark, folder, "documents")
    found = passages(docs, fit(docs, table(spark, folder, "labels")))
    return found.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("passages").alias("n_passages"),
    )
