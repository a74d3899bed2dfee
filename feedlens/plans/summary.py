"""Counts and sums of Gold that add up, so that the read queries need not read its rows.

One row per quarter of an hour (UTC; every time zone is some quarters away) and combination of the
labels that metrics group by, with the number of items, and the sum, number and highest of
their engagements. ``created_at`` is the start of the quarter, so that hours and days of any zone can be
taken from it. The counting functions of :mod:`feedlens.plans.metrics` take such a table in place of
Gold. Summaries of different rows add up: a store keeps one per day and rebuilds the days that
a batch touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.schema import GOLD_SCHEMA

LABELS = ("item_type", "source", "sentiment", "topic", "theme", "action_bucket", "speaker",
          "company", "location")
QUARTER_SECONDS = 900
SUMMARY_SCHEMA = T.StructType([
    GOLD_SCHEMA["created_at"], *[GOLD_SCHEMA[c] for c in LABELS],
    T.StructField("items", T.LongType()), GOLD_SCHEMA["engagement"],
    T.StructField("engaged", T.LongType()), T.StructField("max_engagement", T.LongType())])


def summarize(gold: DataFrame, *more: str) -> DataFrame:
    """Gold rows as a summary; ``more`` columns are grouped by as well."""
    seconds = F.unix_seconds("created_at")
    quarter = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(QUARTER_SECONDS)))
    return gold.groupBy(quarter.alias("created_at"), *LABELS, *more).agg(
        F.count("*").alias("items"), F.sum("engagement").alias("engagement"),
        F.count("engagement").alias("engaged"), F.max("engagement").alias("max_engagement"))


# ---- aggregates that read Gold and a summary alike ----------------------------------------------

def summed(table: DataFrame) -> bool:
    """Whether a table is a summary."""
    return "items" in table.columns


def total(table: DataFrame) -> Column:
    """The number of items."""
    return F.coalesce(F.sum("items"), F.lit(0)) if summed(table) else F.count("*")


def total_if(table: DataFrame, condition: Column) -> Column:
    """The number of items that meet a condition on the labels."""
    if summed(table):
        return F.coalesce(F.sum(F.when(condition, F.col("items"))), F.lit(0))
    return F.count_if(condition)


def mean_engagement(table: DataFrame) -> Column:
    if summed(table):
        return F.sum("engagement") / F.nullif(F.sum("engaged"), F.lit(0))
    return F.avg("engagement")


def highest_engagement(table: DataFrame) -> Column:
    return F.max("max_engagement" if summed(table) else "engagement")


def share_if(table: DataFrame, condition: Column) -> Column:
    """The share of items that meet a condition, as a decimal with five places."""
    if summed(table):
        return (total_if(table, condition).cast("decimal(20,1)") / total(table)
                .cast("decimal(20,0)")).cast("decimal(15,5)")
    return F.avg(F.when(condition, F.expr("1.0")).otherwise(F.lit(0)))
