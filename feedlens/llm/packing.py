"""Packing by cutting-stock column generation.

Documents are cut into whole sequences and one rest each. The rests, rounded up to a grid of a few
tokens, form a histogram of bounded size; a linear program over patterns (which rests share a
sequence) is solved on it by column generation: the simplex method prices a new pattern with a
knapsack dynamic program over the duals, until no pattern helps. Rounded patterns make a table of
slots, and the documents, ranked within their length class, take the slots with their number.
Only the histogram and the slots pass through the driver; both are bounded by the sequence length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import flat_batches, map_batches, read_table, stored
from feedlens.llm.subwords import default_path, vocabulary
from feedlens.session import lookup_join

LENGTH = 2048
GRAIN = 8
END_ID = 1
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
LOOKUP_BYTES = 32 << 20


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best total value of sizes (with repetition) within a capacity, and how many of each."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        usable = int(np.searchsorted(sizes, room, side="right"))
        if usable:
            gains = values[:usable] + best[room - sizes[:usable]]
            top = int(np.argmax(gains))
            if gains[top] > best[room] + 1e-12:
                best[room], choice[room] = gains[top], top
    taken, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            taken[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), taken


def solve_patterns(histogram: dict[int, int], capacity: int,
                   rounds: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """Basis of the linear program: patterns over the sorted sizes and how often each is used.

    ``rounds`` bounds the simplex steps; every step leaves a feasible plan, so the bound can cost
    padding but no rows.
    """
    sizes = np.array(sorted(histogram))
    demand = np.array([float(histogram[s]) for s in sizes])
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(basis))
    used = inverse @ demand
    for _ in range(rounds):
        value, pattern = knapsack(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-9:
            break
        direction = inverse @ pattern
        able = direction > 1e-9
        ratios = np.where(able, used / np.where(able, direction, 1), np.inf)
        leaving = int(np.argmin(ratios))
        step = ratios[leaving]
        used = used - step * direction
        used[leaving] = step
        used = np.maximum(used, 0)
        row = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, row)
        inverse[leaving] = row
        basis[:, leaving] = pattern
    return [(basis[:, i].astype(np.int64), float(used[i])) for i in range(len(sizes))]


def best_fit(left: Counter, capacity: int) -> list[Counter]:
    """Sequences for the few rests that rounding leaves, longest first into the fullest that has
    room."""
    bins: list[Counter] = []
    room: dict[int, list[int]] = {}
    for size in sorted(left.elements(), reverse=True):
        fitting = [r for r, open_ in room.items() if r >= size and open_]
        if fitting:
            at = room[min(fitting)].pop()
            space = min(fitting) - size
        else:
            at, space = len(bins), capacity - size
            bins.append(Counter())
        bins[at][size] += 1
        room.setdefault(space, []).append(at)
    return bins


def round_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns with their numbers of sequences; each size has as many places as rests."""
    left, plan = Counter(histogram), Counter()
    sizes = sorted(histogram)
    for pattern, used in solve_patterns(histogram, capacity) if histogram else []:
        named = {s: int(n) for s, n in zip(sizes, pattern, strict=True) if n}
        times = min([int(used + 1e-6)] + [left[s] // n for s, n in named.items()])
        if times:
            plan[tuple(sorted(named.items()))] += times
            left.subtract({s: n * times for s, n in named.items()})
    for counts in best_fit(+left, capacity):
        plan[tuple(sorted(counts.items()))] += 1
    return [(dict(pattern), times) for pattern, times in sorted(plan.items())]


@dataclass(frozen=True)
class Slots:
    """Places of one size class: from ``starts[i]`` on, ``each[i]`` per sequence from ``base[i]``,
    the first at place ``order[i]`` of its sequence."""

    starts: np.ndarray
    each: np.ndarray
    base: np.ndarray
    order: np.ndarray

    def place(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and order within it for ranks of the class."""
        i = np.searchsorted(self.starts, ranks, side="right") - 1
        within = ranks - self.starts[i]
        return self.base[i] + within // self.each[i], self.order[i] + within % self.each[i]


def slot_table(plan: list[tuple[dict[int, int], int]]) -> dict[int, Slots]:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in plan:
        order = 0
        for size, each in sorted(pattern.items(), reverse=True):
            before = rows.setdefault(size, [])
            start = before[-1][0] + before[-1][4] if before else 0
            before.append((start, each, sequence, order, each * times))
            order += each
        sequence += times
    return {size: Slots(*(np.array(column, np.int64) for column in list(zip(*found))[:4]))
            for size, found in rows.items()}


def _cut(path: str, length: int, grain: int, end_id: int):
    def make():
        words = vocabulary(path)
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()

        def run(batch: pa.RecordBatch):
            out: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                ids = np.append(words.encode(text), end_id).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start:start + length]
                    size = -(-len(piece) // grain)
                    row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), size,
                           part, seen[size])
                    seen[size] += 1
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            return out

        return run

    return make


def _place(shared):
    def make():
        slots = shared.value

        def run(batch: pa.RecordBatch):
            sizes = batch.column("size").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, order = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                sequence[rows], order[rows] = slots[int(size)].place(ranks[rows])
            return [sequence, order]

        return run

    return make


def pack(documents: DataFrame, path: str | None = None, length: int = LENGTH, grain: int = GRAIN,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens.

    Returns per piece ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A
    document's tokens are its ids and ``end_id``; a null text has none but that. Documents are cut
    only at multiples of ``length``; pieces of a sequence follow each other without gaps from
    offset 0. Rounding rests up to ``grain`` tokens is what costs padding beyond the optimum of
    the program: half a grain per piece. Rows that repeat are packed each; other columns are not
    read; an empty table gives no rows.
    """
    if length % grain:
        raise ValueError("length must be a multiple of grain")
    path = path or default_path()
    cut = stored(flat_batches(documents.select("doc_id", "text"), _cut(path, length, grain, end_id),
                              f"{PIECE}, size int, part int, rank long"), "pieces")
    counts = stored(cut.groupBy("size", "part").agg(F.count("*").alias("n")), "counts")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n"))
                 .collect()}
    capacity = length // grain
    whole = histogram.pop(capacity, 0)
    plan = round_patterns(histogram, capacity) + [({capacity: 1}, whole)] * bool(whole)
    shared = documents.sparkSession.sparkContext.broadcast(slot_table(plan))
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select("size", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                                   .alias("before")), "offsets")
    ranked = (lookup_join(cut, offsets, ["size", "part"], limit=LOOKUP_BYTES)
              .withColumn("rank", F.col("rank") + F.col("before")))
    kept = tuple(name.split()[0] for name in PIECE.split(", "))
    placed = map_batches(ranked, _place(shared), "sequence_id long, place long", keep=kept)
    before = (Window.partitionBy("sequence_id").orderBy("place")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.select(*kept, "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(read_table(spark, sf_dir, "documents"), default_path())
