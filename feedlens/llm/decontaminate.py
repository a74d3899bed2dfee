"""Benchmark decontamination with suffix arrays.

The training documents are cut into shards, blocks of whole documents that lie in one task. Each
shard gets a suffix array over word numbers; every suffix of the benchmark texts is searched in it
by bisection. That gives all places where at least a window of a benchmark text occurs, and the
length of the longest verbatim match at each. No rows are shuffled. The benchmark is the query
set: it goes to the tasks in slices of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import map_batches, read_table, stored
from feedlens.session import lookup_join, materialize

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
SLICE_BYTES = 16 << 20
MATCHES = "array<struct<item_id:bigint,doc_start:bigint,item_start:bigint,words:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; null has none.

    The pattern runs on UTF-8 bytes, where every byte of a sign beyond ASCII belongs to a word.
    """
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Benchmark:
    """A slice of benchmark items: their words as numbers and their windows, equal ones once."""

    numbers: dict[bytes, int] = field(default_factory=dict)
    ids: list[list[int]] = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    window: int = WINDOW

    @classmethod
    def of(cls, items: list[tuple[int, str | None]], window: int = WINDOW) -> Benchmark:
        made, seen = cls(window=window), {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            key = tuple(words)
            if key not in seen:
                seen[key] = len(made.ids)
                made.ids.append([])
                made.texts.append(np.array([made.numbers.setdefault(w, len(made.numbers) + 1)
                                            for w in words], np.int64))
            made.ids[seen[key]].append(item_id)
        return made

    @property
    def shortest(self) -> int:
        """Words of the shortest window."""
        return min((min(len(t), self.window) for t in self.texts), default=self.window)

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts one after another, each closed by 0, and item, start and window of each
        suffix that begins a window."""
        item, start, width, base = [], [], [], []
        at = 0
        for i, text in enumerate(self.texts):
            need = min(len(text), self.window)
            count = len(text) - need + 1
            item.append(np.full(count, i))
            start.append(np.arange(count))
            base.append(np.arange(at, at + count))
            width.append(np.full(count, need))
            at += len(text) + 1
        flat = np.concatenate([np.append(t, 0) for t in self.texts])
        return flat, np.concatenate(base), np.concatenate(width), np.stack(
            [np.concatenate(item), np.concatenate(start)])


def suffix_array(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` numbers or more.

    By prefix doubling: suffixes ordered by their first k numbers get ranks, and pairs of ranks
    k apart order them by 2k.
    """
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth and len(sequence):
        pair = rank * (len(sequence) + 1)
        pair[:-k] += rank[k:] + 1
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        fresh = np.empty_like(rank)
        fresh[order] = np.cumsum(np.append(0, sorted_pair[1:] != sorted_pair[:-1]))
        if fresh.max() == len(sequence) - 1:
            break
        rank, k = fresh, 2 * k
    return order


def bisect(sequence: np.ndarray, array: np.ndarray, queries: np.ndarray, starts: np.ndarray,
           widths: np.ndarray, right: bool) -> np.ndarray:
    """First place in the suffix array whose suffix, cut to the width, is not below the query
    (with ``right``: is above it); for all queries at once."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array), np.int64)
    padded = np.append(sequence, np.zeros(int(widths.max(initial=0)) + 1, np.int64))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        at, q, w = array[middle], starts[open_], widths[open_]
        sign = np.zeros(len(open_), np.int64)
        for k in range(int(w.max())):
            difference = np.sign(padded[at + k] - queries[np.minimum(q + k, len(queries) - 1)])
            sign = np.where((sign == 0) & (k < w), difference, sign)
        below = sign <= 0 if right else sign < 0
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
    return low


def common_length(sequence: np.ndarray, at: np.ndarray, queries: np.ndarray,
                  start: np.ndarray) -> np.ndarray:
    """Numbers that agree from the two places on; 0 in either sequence ends a match."""
    length = np.zeros(len(at), np.int64)
    going = np.arange(len(at))
    while going.size:
        a, q = at[going] + length[going], start[going] + length[going]
        same = (a < len(sequence)) & (q < len(queries))
        same[same] = (sequence[a[same]] == queries[q[same]]) & (queries[q[same]] != 0)
        going = going[same]
        length[going] += 1
    return length


def pair_blocks(low: np.ndarray, high: np.ndarray, array: np.ndarray, size: int = 1 << 20):
    """All pairs of a query and a place in its range of the suffix array, in blocks of a bounded
    size: ``(query numbers, places in the sequence)``."""
    bounds = np.concatenate([[0], np.cumsum(high - low)])
    for start in range(0, int(bounds[-1]), size):
        pair = np.arange(start, min(start + size, int(bounds[-1])))
        query = np.searchsorted(bounds, pair, side="right") - 1
        yield query, array[low[query] + pair - bounds[query]]


class ShardSearch:
    """Search of a benchmark slice in the suffix array of one shard."""

    def __init__(self, benchmark: Benchmark):
        self.benchmark = benchmark
        if benchmark.texts:
            self.flat, self.base, self.width, self.where = benchmark.suffixes()

    def matches(self, documents: list[list[bytes]]) -> list[list[tuple[int, int, int, int]]]:
        """Per document ``(text number, start in document, start in text, words)``.

        Runs of words that the benchmark does not know end a match, as do document ends; runs of
        known words shorter than the shortest window hold no match and are left out of the array.
        """
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in documents]
        if not self.benchmark.texts:
            return found
        get = self.benchmark.numbers.get
        numbers = [np.fromiter((get(w, 0) for w in d), np.int64, len(d)) for d in documents]
        lengths = np.array([len(n) + 1 for n in numbers])
        whole = np.concatenate([np.append(n, 0) for n in numbers])
        change = np.flatnonzero(np.diff(np.concatenate([[False], whole != 0, [False]])))
        runs = change.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= self.benchmark.shortest]
        if not len(runs):
            return found
        sequence = np.concatenate([np.append(whole[a:b], 0) for a, b in runs])
        places = np.concatenate([np.arange(a, b + 1) for a, b in runs])
        array = suffix_array(sequence, int(self.width.max()))
        low = bisect(sequence, array, self.flat, self.base, self.width, False)
        high = bisect(sequence, array, self.flat, self.base, self.width, True)
        ends = np.cumsum(lengths)
        for query, at in pair_blocks(low, high, array):
            before = (at > 0) & (self.where[1][query] > 0)
            before[before] = sequence[at[before] - 1] == self.flat[self.base[query[before]] - 1]
            query, at = query[~before], at[~before]  # a match that starts earlier covers the rest
            length = common_length(sequence, at, self.flat, self.base[query])
            document = np.searchsorted(ends, places[at], side="right")
            offset = places[at] - (ends - lengths)[document]
            for d, *match in zip(document.tolist(), self.where[0][query].tolist(), offset.tolist(),
                                 self.where[1][query].tolist(), length.tolist(), strict=True):
                found[d].append(tuple(match))
        return found


def _search(shared, window: int):
    def make():
        search = ShardSearch(Benchmark.of(shared.value, window))
        ids = search.benchmark.ids

        def run(batch: pa.RecordBatch):
            documents = [words_of(t) for t in batch.column("text").to_pylist()]
            matches = [[{"item_id": item, "doc_start": at, "item_start": start, "words": n}
                        for number, at, start, n in found for item in ids[number]]
                       for found in search.matches(documents)]
            return [[len(d) for d in documents], matches]

        return run

    return make


def _count_words():
    return lambda batch: [[len(words_of(t)) for t in batch.column("text").to_pylist()]]


def benchmark_slices(benchmark: DataFrame, limit: int = SLICE_BYTES):
    """The benchmark as lists of ``(item_id, text)`` of about ``limit`` bytes, one at a time."""
    size = benchmark.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    slices = -(-size // limit) or 1
    for i in range(slices):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i)
        yield [(r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()]


def find_leaks(documents: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",),
               window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` of each row, ``n_words`` and ``matches``.

    A match is a longest verbatim run of at least a window of an item: ``item_id``, first word in
    the document and in the item, words. A window is ``window`` consecutive words, or the whole
    item if it is shorter; items without words have none. Null and empty texts have no words and
    no matches. Items with equal words each match. Other columns are not read.

    A benchmark larger than ``slice_bytes`` is searched slice by slice: the rows are stored once,
    and a slice's pass only writes the matches that it found.
    """
    spark = documents.sparkSession
    kept = tuple(dict.fromkeys((*keep, "text")))
    slices = benchmark_slices(benchmark.select("item_id", "text"), slice_bytes)

    def searched(rows: DataFrame, items: list, keep: tuple[str, ...]) -> DataFrame:
        return map_batches(rows, _search(spark.sparkContext.broadcast(items), window),
                           f"n_words long, matches {MATCHES}", keep=keep)

    first = next(slices)
    second = next(slices, None)
    if second is None:
        return searched(documents.select(*kept), first, kept).select(*keep, "n_words", "matches")
    number = F.monotonically_increasing_id()
    rows = stored(documents.select(*kept).withColumn("search_row", number), "searched")
    parts = [stored(searched(rows.select("search_row", "text"), items, ("search_row",))
                    .filter(F.size("matches") > 0).select("search_row", "matches"), "leaks")
             for items in chain((first, second), slices)]
    found = materialize(reduce(DataFrame.unionByName, parts).groupBy("search_row").agg(
        F.flatten(F.collect_list("matches")).alias("matches")), "leaks")
    joined = lookup_join(rows, found, ["search_row"], "left")
    counted = map_batches(joined, _count_words, "n_words long", keep=(*kept, "matches"))
    none = F.array().cast(MATCHES)
    return counted.select(*keep, "n_words", F.coalesce("matches", none).alias("matches"))


def _hits():
    def run(batch: pa.RecordBatch):
        covered, items = [], []
        for matches in batch.column("matches").to_pylist():
            end = total = 0
            for at, words in sorted({(m["doc_start"], m["words"]) for m in matches or []}):
                total += max(0, at + words - max(at, end))
                end = max(end, at + words)
            covered.append(total)
            items.append(sorted({str(m["item_id"]) for m in matches or []}))
        digest = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
        return [covered, [len(i) for i in items], digest, [n > 0 for n in covered]]

    return run


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``; see
    ``find_leaks``."""
    return map_batches(find_leaks(documents, benchmark), _hits,
                       "n_hit long, n_items long, items_sha256 string, contaminated boolean",
                       keep=("doc_id", "n_words"))


def clean_rows(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any match, all their columns."""
    packed = documents.select(F.struct("*").alias("row"), "text")
    return (find_leaks(packed, benchmark, keep=("row",))
            .filter(F.size("matches") == 0).select("row.*"))


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark words in all documents."""
    return contamination(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"))
