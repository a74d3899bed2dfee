"""The presentation table: one row per item, with engagement as of now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.upsert import total_counts
from feedlens.schema import ENTITY_KINDS, GOLD_COLS
from feedlens.session import Measured, lookup_join


def engagement() -> Column:
    """Reactions, comments and reposts added up as BIGINT, missing ones as 0."""
    return total_counts()


def engaged(bronze: DataFrame) -> DataFrame:
    """``item_id`` and ``engagement`` of rows with counts."""
    return bronze.select("item_id", engagement().alias("engagement"))


def gold_items(silver: DataFrame, bronze: DataFrame | Measured) -> DataFrame:
    """Silver rows with their entities spread and the counts that Bronze holds today.

    A measured table of ``engaged`` rows takes the place of Bronze in a look-up.
    """
    joined = (lookup_join(silver, bronze, ["item_id"], "left") if isinstance(bronze, Measured)
              else silver.join(engaged(bronze), "item_id", "left"))
    return (joined.withColumns({k: F.col(f"entities.{k}") for k in ENTITY_KINDS})
            .withColumn("engagement", F.coalesce("engagement", F.lit(0).cast("bigint")))
            .select(*GOLD_COLS))
