"""One row per key within a batch, and merging a batch into what is there."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.times import instant
from feedlens.schema import BRONZE_COLS, COUNT_COLS
from feedlens.session import BROADCAST_BYTES, materialize, measured

KEY = "item_id"


def total_counts() -> Column:
    return sum((F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in COUNT_COLS),
               start=F.lit(0).cast("bigint"))


def dedup_batch(batch: DataFrame) -> DataFrame:
    """One row per key: the one with the highest counts, then the greatest in column order.

    A ``max`` over whole rows, not a window: copies of a hot key are folded before the shuffle.
    """
    others = [c for c in batch.columns if c != KEY]
    best = F.max(F.struct(total_counts().alias("_total"), *others)).alias("_best")
    return (batch.groupBy(KEY).agg(best)
            .select(*[F.col(KEY) if c == KEY else F.col(f"_best.{c}") for c in batch.columns]))


def dedup_stored(batch: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``dedup_batch`` of a stored batch: only rows of repeated keys move.

    Keys are counted by themselves, and the repeated ones sent to all tasks; where these do not
    fit, all rows are grouped.
    """
    repeated = materialize(batch.groupBy(KEY).count().filter("count > 1").select(KEY), "repeated")
    if not repeated.bytes:
        return batch
    if not repeated.fits(limit):
        return dedup_batch(batch)
    keys = F.broadcast(repeated.table)
    return batch.join(keys, KEY, "left_anti").unionByName(
        dedup_batch(batch.join(keys, KEY, "left_semi")))


def existing_keys(incoming: DataFrame, stored: DataFrame,
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """Those keys of ``stored`` that can matter to ``incoming``.

    A batch measured to be small is broadcast over the stored keys, which then need no shuffle.
    """
    keys = stored.select(KEY)
    if measured(incoming.select(KEY)).fits(limit):
        return keys.join(F.broadcast(incoming.select(KEY)), KEY, "left_semi")
    return keys


def not_in(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose key is not stored yet."""
    return rows.join(stored.select(KEY), KEY, "left_anti")


def merge_feed(target: DataFrame, incoming: DataFrame, as_of: datetime | Column) -> DataFrame:
    """A batch merged into Bronze, as one outer join on the key.

    A known item only gets the three counts refreshed, a new one is added with ``as_of`` as its
    ingestion time. Keys are unique on both sides.
    """
    old = target.select(KEY, F.struct(*target.columns).alias("_old"))
    new = (incoming.select(*BRONZE_COLS).withColumn("ingestion_time", instant(as_of))
           .select(KEY, F.struct(*target.columns).alias("_new")))

    def merged(name: str) -> Column:
        first, second = ("_new", "_old") if name in COUNT_COLS else ("_old", "_new")
        return F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}")) \
                .otherwise(F.col(f"{second}.{name}")).alias(name)

    return old.join(new, KEY, "full_outer").select(*[merged(c) for c in target.columns])
