"""Sharding by histogram sort.

Rows are ordered by the hash of their text, then by id, so that equal texts stand together. The
boundaries between shards are found by counting: each round sums the exact bytes below evenly
spaced probes inside every interval that still holds a boundary, and keeps the one sub-interval
around the target. When every boundary meets the tolerance, or its interval is a single key, the
rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import read_table, stored

PROBE_BITS = 6
LOW, HIGH, BITS = -(1 << 63), (1 << 63) - 1, 64


def aligned(low: int, high: int) -> tuple[int, int]:
    """Start and log2 of the length of the smallest binary interval that holds both numbers."""
    if low < 0 <= high:
        return LOW, BITS
    bits = (low ^ high).bit_length()
    return low >> bits << bits, bits


@dataclass(frozen=True)
class Boundary:
    """Rows with a key below the boundary lie in shards before it.

    The key is ``(hash, id)``. The boundary lies in the ``2 ** bits`` values from ``low`` on: of
    hashes while ``fixed`` is None, then of ids under that one hash. ``below`` counts the bytes of
    the rows under ``low``.
    """

    target: int
    low: int = LOW
    bits: int = BITS
    below: int = 0
    fixed: int | None = None
    done: bool = False

    @property
    def span(self) -> tuple:
        return self.low, self.bits, self.fixed

    @property
    def step(self) -> int:
        """log2 of the distance of two probes."""
        return max(0, self.bits - PROBE_BITS)

    def inside(self) -> Column:
        last = self.low + (1 << self.bits) - 1
        if self.fixed is None:
            return F.col("key").between(self.low, last)
        return (F.col("key") == self.fixed) & F.col("tie").between(self.low, last)

    def cell(self) -> Column:
        """Number of the sub-interval that a row inside lies in."""
        value = F.col("key" if self.fixed is None else "tie")
        return F.shiftright(value, self.step) - F.lit(self.low >> self.step)

    def narrowed(self, cells: dict[int, tuple], slack: int) -> Boundary:
        """The boundary after a round, given each sub-interval's bytes, lowest and highest key."""
        at, i = self.below, None
        for i in sorted(cells):
            if at + cells[i][0] > self.target:
                break
            at += cells[i][0]
        else:  # nothing lies above the target
            return replace(self, done=True)
        size, (low, low_tie), (high, high_tie) = cells[i]
        below, above = self.target - at, at + size - self.target
        first, last = (low, high) if self.fixed is None else (low_tie, high_tie)
        if below <= slack:
            return replace(self, low=first, below=at, done=True)
        single = (low, low_tie) == (high, high_tie)
        if (above <= slack or single and above < below) and last < HIGH:
            return replace(self, low=last + 1, below=at + size, done=True)
        if single:
            return replace(self, low=first, below=at, done=True)
        if low == high:
            start, bits = aligned(low_tie, high_tie)
            return Boundary(self.target, start, bits, at, low)
        start, bits = aligned(first, last)
        return replace(self, low=start, bits=bits, below=at)

    def reached(self) -> Column:
        """Whether a row's key is at or above the boundary."""
        if self.fixed is None:
            return F.col("key") >= self.low
        return (F.col("key") > self.fixed) | ((F.col("key") == self.fixed)
                                              & (F.col("tie") >= self.low))


def find_boundaries(keyed: DataFrame, shards: int, tolerance: float = 0.001) -> list[Boundary]:
    """Boundaries between ``shards`` runs of nearly equal bytes; ``keyed`` has key, tie, size.

    The driver holds at most ``64 * shards`` sums in a round. A boundary is at most ``tolerance``
    of a mean shard off its target, unless the rows of one hash and one id are larger than that.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = int(total * tolerance / shards)
    found = [Boundary(total * i // shards) for i in range(1, shards)]
    while spans := list({b.span: b for b in found if not b.done}.values()):
        cell = F.lit(None).cast("struct<span:int,cell:bigint>")
        for i, b in enumerate(spans):
            cell = F.when(b.inside(), F.struct(F.lit(i).alias("span"), b.cell().alias("cell"))
                          ).otherwise(cell)
        sums: dict[tuple, dict[int, tuple]] = {b.span: {} for b in spans}
        place = F.struct("key", "tie")
        counted = (keyed.select(cell.alias("c"), "size", "key", "tie").filter("c IS NOT NULL")
                   .groupBy("c.span", "c.cell")
                   .agg(F.sum("size").alias("bytes"), F.min(place).alias("low"),
                        F.max(place).alias("high")))
        for row in counted.collect():
            sums[spans[row["span"]].span][row["cell"]] = (
                row["bytes"], tuple(row["low"]), tuple(row["high"]))
        found = [b if b.done else b.narrowed(sums[b.span], slack) for b in found]
    return found


def shard_rows(documents: DataFrame, shards: int = 24, tolerance: float = 0.001) -> DataFrame:
    """Rows dealt to ``shards`` shards of nearly equal bytes.

    Returns ``doc_id, size, text_crc32, shard, slot``; a size is the UTF-8 bytes of the text (none
    for null) plus 8. Equal texts stand together and share a shard unless a boundary falls among
    them. Slots count from 0 without gaps, in the order of the exchange. Null ids come first among
    equal texts; rows that repeat both text and id stay in one shard. An empty table gives no rows.
    Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = stored(documents.select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
        F.coalesce("doc_id", F.lit(LOW)).alias("tie")), "keyed")
    found = find_boundaries(keyed, shards, tolerance)
    shard = reduce(lambda a, b: a + b, [b.reached().cast("int") for b in found], F.lit(0))
    index = F.monotonically_increasing_id()
    dealt = stored(keyed.withColumn("shard", shard)
                   .repartitionByRange("shard", "key", "tie")
                   .sortWithinPartitions("shard", "key", "tie")
                   .withColumn("part", F.shiftright(index, 33))
                   .withColumn("at", index.bitwiseAND(F.lit((1 << 33) - 1))), "dealt")
    runs = dealt.groupBy("shard", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(runs.select("shard", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0))
                                                   - F.col("start")).alias("shift")), "offsets")
    return dealt.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    dealt = shard_rows(read_table(spark, sf_dir, "documents"), shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
