"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. On each level runs of one symbol become one, then deterministic coin
tossing labels every symbol from itself and its left neighbour: the position and value of the
lowest bit in which the two differ, repeated until labels are small. Local maxima of the labels,
and minima away from them, begin new phrases of two to a few symbols, and equal phrases get equal
names. Whether a phrase begins at a place depends on a few symbols around it only, so equal
substrings share all phrases of their interior wherever they stand.

A fingerprint is the name of the whole text and a sketch of its phrases: the smallest hashes among
the phrase names of the levels whose phrases are long enough to tell texts apart.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import flat_batches, mix64, read_table

SKETCH = 64
SKETCH_LEVEL = 3
CHUNK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
LOWEST = -(1 << 63)


def toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: twice the lowest differing bit to the left, plus its value.

    Neighbours must differ; at the first symbol of a text the bit counts as number 0.
    """
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[:1] = 0
    changed = symbols ^ left
    changed[first] = 1
    lowest = changed & (~changed + symbols.dtype.type(1))
    bit = np.bitwise_count(lowest - symbols.dtype.type(1))
    value = (symbols & lowest) != 0
    return ((bit << 1) | value).astype(np.uint8)


def phrase_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin, as a mask; the first symbol of a text always begins one."""
    labels = toss(symbols, first)
    for _ in range(3):  # 128 labels become 14, then 8, then 6
        labels = toss(labels, first)
    last = np.append(first[1:], len(labels)) - 1
    left, right = np.zeros_like(labels), np.zeros_like(labels)
    left[1:], right[:-1] = labels[:-1], labels[1:]
    left[first] = right[last] = 0  # other texts of the batch have no say
    peak = (labels > left) & (labels > right)
    valley = (labels < left) & (labels < right)
    beside = np.zeros(len(labels), bool)
    beside[:-1] = peak[1:]
    beside[last] = False
    beside[1:] |= peak[:-1]
    starts = peak | (valley & ~beside)
    starts[first] = True
    after = first[first < len(starts) - 1] + 1
    after = after[~np.isin(after, first)]
    starts[after] = False  # a text's first phrase has two symbols at least
    return starts


def name_runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of equal symbols as one symbol; returns them and the new firsts."""
    begins = np.empty(len(symbols), bool)
    begins[1:] = symbols[1:] != symbols[:-1]
    begins[first] = True
    if begins.all():
        return symbols, first
    at = np.flatnonzero(begins)
    lengths = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    named = symbols[at]
    long = lengths > 1
    named[long] = mix64(named[long] + lengths[long] * _STEP)
    return named, np.searchsorted(at, first)


def parse(symbols: np.ndarray, first: np.ndarray):
    """The levels of many texts at once: ``(names, firsts)`` from the single signs on, until every
    text is one symbol."""
    while True:
        yield symbols, first
        if len(symbols) == len(first):
            return
        symbols, first = name_runs(symbols, first)
        at = np.flatnonzero(phrase_starts(symbols, first))
        lengths = np.diff(np.append(at, len(symbols)))
        within = np.arange(len(symbols)) - np.repeat(at, lengths)
        mixed = mix64(symbols + within.astype(np.uint64) * _STEP)
        named = mix64(np.add.reduceat(mixed, at) + lengths.astype(np.uint64))
        symbols, first = named, np.searchsorted(at, first)


def _fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of texts of which none is empty."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts])
    first = np.cumsum(sizes) - sizes
    sketches: list[list[np.ndarray]] = [[] for _ in texts]
    names = np.zeros(len(texts), np.uint64)
    symbols = mix64(flat.astype(np.uint64) + _STEP)
    for level, (symbols, first) in enumerate(parse(symbols, first)):
        ends = np.append(first[1:], len(symbols))
        alone = ends - first == 1
        fresh = alone & (names == 0)
        names[fresh] = symbols[first[fresh]]
        if level < SKETCH_LEVEL:
            continue
        hashed = (mix64(symbols ^ _STEP) >> np.uint64(32)).astype(np.uint32)
        for i in np.flatnonzero(~alone | fresh):
            part = hashed[first[i]:ends[i]]
            if len(part) > 2 * SKETCH:
                part = np.unique(part)[:SKETCH]
            sketches[i].append(part)
    out = []
    for name, text, parts in zip(names, texts, sketches, strict=True):
        if not parts:  # too short for the levels of the sketch
            parts = [np.array([name >> np.uint64(32)], np.uint32)]
        lowest = np.unique(np.concatenate(parts))[:SKETCH]
        out.append(f"{int(name) ^ len(text):016x}:" + lowest.astype(">u4").tobytes().hex())
    return out


def fingerprints(texts: list[str | None]) -> list[str]:
    """Fingerprint of each text: 16 digits for the whole, a colon, and up to 64 phrase hashes.
    A null or empty text has the empty string."""
    out = [""] * len(texts)
    block: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if text:
            block.append(i)
            size += len(text)
        if block and (size >= CHUNK or i == len(texts) - 1):
            for at, made in zip(block, _fingerprints([texts[b] for b in block]), strict=True):
                out[at] = made
            block, size = [], 0
    return out


def likeness(one: str, two: str) -> float:
    """Share of common phrases of two texts, estimated from their fingerprints; 0 to 1.

    Two empty texts are alike; an empty one and another are not.
    """
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    a, b = ({f[i:i + 8] for i in range(17, len(f), 8)} for f in (one, two))
    union = sorted(a | b)
    if len(a) == SKETCH or len(b) == SKETCH:
        union = union[:SKETCH]
    return sum(v in a and v in b for v in union) / len(union)


def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) replaced by as many first signs of the other."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _compare():
    waiting: list[tuple] = []  # the row before, whose successor comes next: (bucket, id, text)

    def run(batch: pa.RecordBatch):
        out: list[list] = [[] for _ in range(7)]
        rows = waiting + list(zip(*(batch.column(c).to_pylist()
                                    for c in ("bucket", "doc_id", "text", "ahead")), strict=True))
        waiting[:] = rows[-1:]
        pairs = [(a[1], a[2], b[2]) for a, b in zip(rows, rows[1:])
                 if a[0] == b[0] and not a[3]]
        own = [p[1] for p in pairs]
        changed = [edited(a, b) for _, a, b in pairs]
        nexts = [p[2] for p in pairs]
        line = own + nexts[-1:]
        made = fingerprints(line)
        # rows follow each other, so the next text's fingerprint is mostly the next row's
        after = [made[i + 1] if nexts[i] is line[i + 1] else None for i in range(len(own))]
        missing = [i for i, a in enumerate(after) if a is None]
        for i, f in zip(missing, fingerprints([nexts[i] for i in missing]), strict=True):
            after[i] = f
        for (doc_id, text, _), other, mine, theirs, following in zip(
                pairs, changed, made, fingerprints(changed), after, strict=False):
            digest = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
            row = (doc_id, len(text), digest, mine, theirs, likeness(mine, theirs),
                   likeness(mine, following))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    return run


def with_successor(documents: DataFrame) -> DataFrame:
    """Rows dealt into runs of neighbouring ids, each run followed by a copy (``ahead``) of the
    first row after it; the last run by the table's first row.

    Columns ``bucket, doc_id, text, ahead``, whole buckets in a partition, in order. The ids at
    which runs begin are quantiles of the ids, so they are ids of rows, and those rows know that
    they are also the end of the run before.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                            F.coalesce("doc_id", F.lit(LOWEST)).alias("order"))
    runs = 4 * partitions
    found = rows.agg(F.min("order").alias("low"), F.percentile_approx(
        "order", [i / runs for i in range(1, runs)], 10 * runs).alias("at")).first()
    begins = sorted({found["low"], *(found["at"] or [])} - {None})
    table = F.lit(begins) if begins else F.array().cast("array<bigint>")
    steps = [1 << i for i in reversed(range(max(1, len(begins)).bit_length()))]
    place = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: at + F.when(
        F.get(table, at + step) <= F.col("order"), step).otherwise(0))  # by halving
    placed = rows.withColumn("bucket", place).withColumn(
        "begins", F.get(table, "bucket") == F.col("order"))
    bucket = F.col("bucket")
    before = F.when(bucket == 0, len(begins) - 1).otherwise(bucket - 1)
    own = F.struct(bucket, F.lit(False).alias("ahead"))
    where = F.when(F.col("begins"), F.array(own, F.struct(before.alias("bucket"),
                                                          F.lit(True).alias("ahead"))))
    return (placed.withColumn("w", F.explode(F.coalesce(where, F.array(own))))
            .select("w.bucket", "doc_id", "text", "w.ahead", "order")
            .repartition(partitions, "bucket")
            .sortWithinPartitions("bucket", "ahead", "order", "text")
            .select("bucket", "doc_id", "text", "ahead"))


def compare_with_edits(documents: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and how alike they and the next are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The edited text has its last half replaced by the start of the next document, in
    ascending ``doc_id`` (null first, equal ids by text; after the last comes the first). Null
    texts count as empty. Other columns are not read; an empty table gives no rows.
    """
    return flat_batches(with_successor(documents), _compare, RESULT)


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_with_edits(read_table(spark, sf_dir, "documents"))
