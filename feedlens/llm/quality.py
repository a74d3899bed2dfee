"""Quality classifier: naive Bayes support vectors.

Features are indicators of byte n-grams (one to three bytes, hashed to a fixed number of places)
and of word n-grams that repeat one word.
Each indicator is scaled by its class log-count ratio, rows are scaled to length one, and a linear
model with hinge loss is fitted by dual coordinate descent. A logistic curve, fitted on rows that
the model has not seen, turns margins into scores from 0 to 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import id_remainder, map_batches, read_table
from feedlens.session import lookup_join, materialize, measured

SAMPLE = 4000
SAMPLE_BYTES = 256 << 20
PLACE_BITS = 18
RUNS = (2, 3, 4, 6, 9, 14)
PLACES = 256 + (1 << 16) + (1 << PLACE_BITS) + len(RUNS)
KEEP_SCORE = 0.7
FOLDS, HELD_OUT = 4, 2


def features(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Sorted places of the n-grams that occur; ``seen`` is an all-false scratch mask."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    seen[raw] = True
    if len(raw) > 1:
        pairs = raw[:-1] << 8 | raw[1:]
        seen[256 + pairs] = True
        triples = (pairs[:-1] << 8 | raw[2:]) * np.uint32(2654435761) >> np.uint32(32 - PLACE_BITS)
        seen[256 + (1 << 16) + triples] = True
    seen[PLACES - len(RUNS):] = [longest_run(text or "") >= n for n in RUNS]
    places = np.flatnonzero(seen)
    seen[places] = False
    return places.astype(np.int32)


def longest_run(text: str) -> int:
    """Words in the longest run of one word."""
    words = text.split()
    same = bytes(map(eq, words, words[1:]))
    return max(map(len, same.split(b"\0"))) + 1 if words else 0


@dataclass(frozen=True)
class Model:
    """Weights on scaled indicators, with the ratios folded in, and the logistic curve."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        if not len(places):
            return self.bias
        ratios = self.ratios[places]
        size = float(np.sqrt((ratios * ratios).sum(dtype=np.float64)))
        return float(self.weights[places].sum(dtype=np.float64)) / max(size, 1e-9) + self.bias

    def score(self, places: np.ndarray) -> float:
        value = self.slope * self.margin(places) + self.offset
        return float(1 / (1 + np.exp(-np.clip(value, -40, 40))))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of (1 + documents with the n-gram) in class 1 over class 0, each as a share."""
    counts = np.ones((2, PLACES))
    for places, label in zip(rows, good, strict=True):
        counts[int(label), places] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0]).astype(np.float32)


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray,
                            costs: np.ndarray, passes: int = 30,
                            seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge-loss linear model; one multiplier per row between 0 and its cost.

    Every step solves one multiplier exactly and moves the weights with it; a constant feature
    stands for the bias.
    """
    weights, bias = np.zeros(PLACES), 0.0
    multipliers = np.zeros(len(rows))
    squares = np.array([float(v @ v) + 1 for _, v in rows])
    draw = np.random.default_rng(seed)
    for _ in range(passes):
        largest = 0.0
        for i in draw.permutation(len(rows)):
            places, values = rows[i]
            gradient = signs[i] * (weights[places] @ values + bias) - 1
            before = multipliers[i]
            multipliers[i] = min(max(before - gradient / squares[i], 0.0), costs[i])
            step = (multipliers[i] - before) * signs[i]
            if step:
                weights[places] += step * values
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margins to the share of class 1, by Newton's method;
    targets are drawn in a little from 0 and 1."""
    ones = good.sum()
    target = np.where(good, (ones + 1) / (ones + 2), 1 / (len(good) - ones + 2))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -40, 40)))
        weight = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * margins).sum() + 1e-3 * slope, (p - target).sum()])
        hessian = np.array([[(weight * margins * margins).sum() + 1e-3, (weight * margins).sum()],
                            [(weight * margins).sum(), weight.sum()]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


def fit(rows: list[np.ndarray], good: np.ndarray, cost: float = 4.0) -> Model:
    """Fit on rows of places; every fifth row only sets the curve. With one class or none the
    score is that class's smoothed share everywhere."""
    check = np.arange(len(rows)) % 5 == 4
    if len({*good[~check]}) < 2 or not check.any():
        share = (good.sum() + 1) / (len(good) + 2)
        flat = np.zeros(PLACES, np.float32)
        return Model(flat, flat, 0.0, 0.0, float(np.log(share / (1 - share))))
    used = np.flatnonzero(~check)
    ratios = log_count_ratios([rows[i] for i in used], good[used])
    scaled = []
    for i in used:
        values = ratios[rows[i]].astype(np.float64)
        scaled.append((rows[i], values / max(np.linalg.norm(values), 1e-9)))
    share = good[used].mean()
    costs = np.where(good[used], cost * 0.5 / share, cost * 0.5 / (1 - share))
    weights, bias = dual_coordinate_descent(scaled, np.where(good[used], 1.0, -1.0), costs)
    draft = Model(ratios, (weights * ratios).astype(np.float32), bias, 1.0, 0.0)
    margins = np.array([draft.margin(rows[i]) for i in np.flatnonzero(check)])
    slope, offset = logistic_curve(margins, good[check])
    return Model(ratios, draft.weights, bias, slope, offset)


def _features():
    seen = np.zeros(PLACES, bool)

    def run(batch: pa.RecordBatch):
        return [[features(t, seen) for t in batch.column("text").to_pylist()]]

    return run


def _bounded(made: DataFrame, limit: int = SAMPLE_BYTES) -> list:
    """One row per id (of rows that repeat an id the least features), ``limit`` bytes at most:
    those with the smallest hash of their id."""
    folded = materialize(made.groupBy("doc_id", "quality").agg(F.min("places").alias("places")),
                         "features")
    table = folded.table
    if not folded.fits(limit):
        sizes = table.orderBy(F.xxhash64("doc_id"), "doc_id").select(
            "doc_id", F.size("places").alias("n")).collect()  # as many as the sample has
        total = np.cumsum([4 * row["n"] + 64 for row in sizes])
        table = table.filter(F.col("doc_id").isin(
            [row["doc_id"] for row, size in zip(sizes, total, strict=True) if size <= limit]))
    return table.collect()


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents, those with the smallest hash of their id.

    Only ids whose crc32 modulo 4 is not 2 are used. Labels without id or quality are left out;
    of several labels of one id the lowest counts. Their features are held to ``SAMPLE_BYTES``.
    """
    usable = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
              .filter(id_remainder("doc_id", FOLDS) != HELD_OUT)
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = lookup_join(documents.select("doc_id", "text"), measured(picked), ["doc_id"])
    made = map_batches(rows, _features, "places array<int>", keep=("doc_id", "quality"))
    found = sorted(_bounded(made), key=lambda r: r["doc_id"])
    order = np.random.default_rng(7).permutation(len(found))
    return fit([np.array(found[i]["places"], np.int32) for i in order],
               np.array([found[i]["quality"] == 1 for i in order], bool))


def _score(shared):
    def make():
        model, seen = shared.value, np.zeros(PLACES, bool)

        def run(batch: pa.RecordBatch):
            return [[model.score(features(t, seen)) for t in batch.column("text").to_pylist()]]

        return run

    return make


def with_scores(documents: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` and the ``score`` of each row's text; null counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(*dict.fromkeys((*keep, "text")))
    return map_batches(rows, _score(shared), "score double", keep=keep)


def score_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row ``doc_id, held_out, score, predicted``.

    A score is the likelihood of quality 1, from the text alone; ``predicted`` is 1 from 0.7 on.
    Null and empty texts get the score of a text without n-grams; repeated rows are scored each;
    without usable labels every score is 0.5. Other columns are not read.
    """
    scored = with_scores(documents, train(documents, labels, sample), ("doc_id",))
    return scored.select("doc_id", (id_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents predicted to be good, all their columns."""
    packed = documents.select(F.struct("*").alias("row"), "text")
    scored = with_scores(packed, train(documents, labels, sample), ("row",))
    return scored.filter(F.col("score") >= KEEP_SCORE).select("row.*")


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
