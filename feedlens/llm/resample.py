"""Importance resampling towards the word distribution of a target table.

Every document gets a weight, the log ratio of its hashed features under the target and under the
corpus, read from one array of gains per bucket. With a Gumbel number per document the highest
scores are a draw without replacement. The cutoff is found by weighted median-of-medians selection:
each partition gives the median of its remaining keys, the median of those weighted by the remaining
rows is the next probe, and counting around it discards a quarter of the remaining rows at least.
Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import discard, flat_batches, map_batches, read_table, stored

BUCKETS = 10_000
#: Bytes to bytes: A-Z to lower case, all signs of ASCII but letters and digits to a blank.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20
                   for b in bytes(range(256)).lower())
#: The order of a draw: best score first, then the smaller id; rows of one id by their features and
#: their place in the stored table, so that no two rows are equal.
KEYS = ("down", "no_id", "id", "n_features", "row")


def feature_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def features(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by a blank."""
    found = list(words)
    for n in range(2, longest + 1):
        found += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return found


def _count_buckets(longest: int, buckets: int):
    def make():
        def run(batch: pa.RecordBatch):
            counted = Counter()
            for text in batch.column("text").to_pylist():
                counted.update(features(feature_words(text), longest))
            places = np.fromiter((zlib.crc32(f) % buckets for f in counted), np.int64, len(counted))
            sums = np.bincount(places, np.fromiter(counted.values(), np.int64, len(counted)),
                               buckets)
            used = np.flatnonzero(sums)
            return [used, sums[used].astype(np.int64)]
        return run
    return make


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``text`` values fall into each bucket; ``buckets`` numbers."""
    counted = flat_batches(texts.select("text"), _count_buckets(longest, buckets),
                           "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, rounded down, per bucket."""
    size = len(source)
    all_source, all_target = float(source.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(gain: np.ndarray, longest: int):
    class Gain(dict):
        """Feature to gain, remembered while the number of features stays bounded."""

        def __missing__(self, feature: bytes) -> int:
            if len(self) >= 500_000:
                self.clear()
            value = self[feature] = int(gain[zlib.crc32(feature) % len(gain)])
            return value

    def make():
        known = Gain()

        def run(batch: pa.RecordBatch):
            n_words, n_features, weight = [], [], []
            for text in batch.column("text").to_pylist():
                words = feature_words(text)
                found = features(words, longest)
                n_words.append(len(words))
                n_features.append(len(found))
                weight.append(sum(map(known.__getitem__, found)))
            return [n_words, n_features, weight]
        return run
    return make


def gumbel(seed: int) -> Column:
    """Thousandths of a Gumbel number that only the seed and ``doc_id`` decide, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digits = F.substring(F.sha2(name.cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def _sides(columns: list[np.ndarray], probe: tuple) -> np.ndarray:
    """Per row -1, 0 or 1: before, at or after the probe in the order of the columns."""
    side = np.zeros(len(columns[0]), np.int8)
    for values, at in zip(columns, probe, strict=True):
        side = np.where(side == 0, (values > at).astype(np.int8) - (values < at), side)
    return side


def _median(columns: list[np.ndarray]) -> list[int] | None:
    """The lower median of the rows in the order of the columns."""
    n = len(columns[0])
    if not n:
        return None
    middle = np.lexsort(columns[::-1])[(n - 1) // 2]
    return [int(c[middle]) for c in columns]


def _halves(low: tuple | None, high: tuple | None, probe: tuple | None):
    """Per partition: the remaining rows before and after the probe, and the median of each."""
    def run(batches):
        parts = [[batch.column(k).to_numpy(zero_copy_only=False) for k in KEYS]
                 for batch in batches]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else []
        if not columns:
            return
        inside = np.ones(len(columns[0]), bool)
        if low:
            inside &= _sides(columns, low) > 0
        if high:
            inside &= _sides(columns, high) < 0
        columns = [c[inside] for c in columns]
        side = _sides(columns, probe) if probe else np.full(len(columns[0]), -1, np.int8)
        halves = [[c[side == s] for c in columns] for s in (-1, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(h[0])], pa.int64()) for h in halves]
            + [pa.array([_median(h)], pa.list_(pa.int64())) for h in halves],
            ["n_before", "n_after", "before", "after"])
    return run


def weighted_median(medians: list[tuple[int, list[int]]]) -> tuple:
    """The lowest median that half of the rows' partitions do not exceed."""
    total, reached = sum(n for n, _ in medians), 0
    for n, key in sorted(medians, key=lambda m: m[1]):
        reached += n
        if 2 * reached >= total:
            return tuple(key)
    raise ValueError("no rows")


def cutoff(keys: DataFrame, wanted: int) -> tuple:
    """The key of the row at place ``wanted`` (from 1) in the order of ``KEYS``, exactly.

    A round reads the remaining rows once; the driver gets two medians per partition. Rounds
    remove a quarter of the remaining rows at least (half, as a rule), and the rest is written
    anew whenever it has shrunk to a quarter, so that all rounds together read the keys a few
    times.
    """
    def halves(table, low=None, high=None, probe=None):
        schema = "n_before long, n_after long, before array<long>, after array<long>"
        return table.mapInArrow(_halves(low, high, probe), schema).collect()

    table, low, high, probe = keys.select(*KEYS), None, None, None
    found = [(r["n_before"], r["before"]) for r in halves(table) if r["n_before"]]
    size = written = sum(n for n, _ in found)
    temporary = None
    while True:
        probe = weighted_median(found)
        rows = halves(table, low, high, probe)
        before = sum(r["n_before"] for r in rows)
        if wanted == before + 1:
            break
        if wanted <= before:
            high, size = probe, before
            found = [(r["n_before"], r["before"]) for r in rows if r["n_before"]]
        else:
            low, wanted, size = probe, wanted - before - 1, size - before - 1
            found = [(r["n_after"], r["after"]) for r in rows if r["n_after"]]
        if 4 * size <= written:
            rest = stored(table.filter(_between(low, high)), "remaining")
            if temporary is not None:
                discard(temporary)
            table = temporary = rest
            written, low, high = size, None, None
    if temporary is not None:
        discard(temporary)
    return probe


def _between(low: tuple | None, high: tuple | None) -> Column:
    key = F.struct(*KEYS)
    inside = F.lit(True)
    if low:
        inside = inside & (key > _literal(low))
    if high:
        inside = inside & (key < _literal(high))
    return inside


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip(KEYS, key, strict=True)])


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their ``rank``, 1, 2, 3 ... in the order of ``KEYS``.

    One exchange by ranges; a row's rank is its place in its range after the rows of the ranges
    before. The driver gets one count per range.
    """
    index = F.monotonically_increasing_id()
    dealt = stored(winners.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
                   .withColumn("part", F.shiftright(index, 33).cast("int"))
                   .withColumn("at", index.bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    shifts, total = [], 0
    for row in sizes:
        shifts.append((row["part"], total))
        total += row["n"]
    shift = winners.sparkSession.createDataFrame(shifts, "part int, shift long")
    return (dealt.join(F.broadcast(shift), "part")
            .withColumn("rank", F.col("at") + F.col("shift") + 1))


def resample(documents: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
             longest: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """Draw documents whose words are distributed like those of ``target``.

    Returns ``doc_id, n_features, weight, score, rank`` for every row of ``documents``; ``rank`` is
    null unless the row is among the ``percent`` per cent highest scores of the rows with at least
    ``least_words`` words (rounded down). Ties go to the smaller ``doc_id``, null ids last; rows
    that repeat an id and have the same score are ordered by their features and then by place, which
    no returned column tells. A null or empty text has no features and weight 0; a null id counts
    as an empty one in the Gumbel number. An empty target weighs all buckets alike, an empty table
    gives no rows. Of ``target`` only ``text`` is read, of ``documents`` also the integer
    ``doc_id``.
    """
    source = documents.select("doc_id", "text")
    gain = gains(bucket_counts(source, longest, buckets), bucket_counts(target, longest, buckets))
    weighed = map_batches(source, _weigh(gain, longest),
                          "n_words long, n_features long, weight long", keep=("doc_id",))
    score = F.col("weight") + gumbel(seed)
    keys = stored(weighed.withColumn("score", score).select(
        "doc_id", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("down"),
        F.col("doc_id").isNull().cast("long").alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.monotonically_increasing_id().alias("row")), "keys")
    eligible = keys.filter(F.col("n_words") >= least_words)
    wanted = eligible.count() * percent // 100
    returned = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return keys.select(*returned, F.lit(None).cast("long").alias("rank"))
    last = cutoff(eligible, wanted)
    drawn = (F.col("n_words") >= least_words) & (F.struct(*KEYS) <= _literal(last))
    winners = ranked(keys.filter(drawn)).select(*returned, "rank")
    return winners.unionByName(keys.filter(~drawn)
                               .select(*returned, F.lit(None).cast("long").alias("rank")))


def op11_resample(spark, sf_dir: str) -> DataFrame:
    """A tenth of the documents with 20 words or more, drawn towards the benchmark's words."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Eight steps of the check sum's polynomial for each byte, in DuckDB's SQL.
CRC_TABLE = """SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT range AS i FROM range(256)))"""


def crc_sql(text: str) -> str:
    """DuckDB's SQL for the crc32 of a text's UTF-8; needs ``t`` of ``CRC_TABLE`` in scope."""
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(
        range(length(hex({text})) // 2),
        lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_sql(text: str) -> str:
    """DuckDB's SQL for the list of a text's words."""
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


SQL = f"""
WITH crc AS ({CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql('text')} AS words FROM documents),
dw AS (SELECT r, unnest(words) AS w FROM d),
bw AS (SELECT unnest({words_sql('text')}) AS w FROM benchmark),
named AS (SELECT w, {crc_sql('w')} % 10000 AS bucket
          FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN named USING (w) GROUP BY bucket),
g AS (SELECT bucket, count(*) AS n FROM bw JOIN named USING (w) GROUP BY bucket),
sizes AS (SELECT (SELECT count(*) FROM dw) AS all_s, (SELECT count(*) FROM bw) AS all_t),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(g.n, 0) + 1)::DOUBLE * (all_s + 10000)
             / ((s.n + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
         FROM s LEFT JOIN g USING (bucket), sizes),
weighed AS (SELECT r, sum(gain)::BIGINT AS weight
            FROM dw JOIN named USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
        ::DOUBLE / 4294967296)))::BIGINT AS score FROM d LEFT JOIN weighed USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, r)
           AS place FROM scored WHERE n_features >= 20),
drawn AS (SELECT r, place FROM placed
          WHERE place <= (SELECT count(*) FROM placed) * 10 // 100)
SELECT doc_id, n_features, weight, score, place AS rank FROM scored LEFT JOIN drawn USING (r)
"""
