"""Places on the map: find a known place in a location and add up the mood there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.plans.summary import total
from feedlens.schema import PLACES, SENTIMENTS

Place = tuple[str, float, float]
RADIUS_BASE = 120
RADIUS_PER_ITEM = 55


def usable_location(gold: DataFrame) -> DataFrame:
    location = F.col("location")
    return gold.filter(location.isNotNull() & (F.trim(location) != "")
                       & (F.lower(location) != "unknown"))


def location_moods(gold: DataFrame) -> DataFrame:
    """Items by cleaned location and sentiment."""
    return (usable_location(gold)
            .groupBy(F.lower(F.trim("location")).alias("location"), "sentiment")
            .agg(total(gold).alias("items")))


def find_place(column: str, places: Sequence[Place] = PLACES) -> Column:
    """``struct<lat, lon>`` of the first listed place whose name is in ``column``, or null.

    Case and accents are ignored. The list is short and ordered, so it is one CASE expression.
    """
    def quoted(name: str) -> str:
        return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return F.expr("CASE " + " ".join(
        f"WHEN contains({column} COLLATE UNICODE_CI_AI, {quoted(name)} COLLATE UNICODE_CI_AI) "
        f"THEN named_struct('lat', {lat}D, 'lon', {lon}D)" for name, lat, lon in places) + " END")


def place_mood(gold: DataFrame, places: Sequence[Place] = PLACES) -> DataFrame:
    """One row per place on the map: items, count per sentiment, leading mood, name and radius.

    Names that share coordinates are one place, shown under the smallest of the locations.

    The search runs once per distinct location. It is tied to the count, which is never 0, as
    the optimizer would otherwise move the filter below the grouping and search in every item.
    """
    spot = F.when(F.col("items") > 0, find_place("location", places))
    spots = (location_moods(gold).withColumn("spot", spot)
             .filter(F.col("spot").isNotNull())
             .select("spot.*", "location", "sentiment", "items"))
    per_place = spots.groupBy("lat", "lon").agg(
        F.sum("items").alias("items"), F.min("location").alias("location"),
        *[F.sum(F.when(F.col("sentiment") == s, F.col("items")).otherwise(0)).alias(s)
          for s in SENTIMENTS])
    most = F.greatest(*SENTIMENTS)
    return per_place.select(
        "lat", "lon", F.initcap("location").alias("place"), "items", *SENTIMENTS,
        F.coalesce(*[F.when((most > 0) & (F.col(s) == most), F.lit(s)) for s in SENTIMENTS])
         .alias("mood"),
        (F.lit(RADIUS_BASE) + F.lit(RADIUS_PER_ITEM) * F.col("items")).alias("radius"))


def top_locations(gold: DataFrame, n: int = 12) -> DataFrame:
    return (usable_location(gold).groupBy("location").agg(total(gold).alias("items"))
            .orderBy(F.desc("items"), "location").limit(n))
