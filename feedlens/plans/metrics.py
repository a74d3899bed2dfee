"""The read queries: each takes the Gold table and returns a small or ordered table.

Those that count or add up also take a summary of Gold (see :mod:`feedlens.plans.summary`) and give
the same rows from it; lists, threads and ``last_hour`` need Gold itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.display import safe_link, short_local_time, shorten
from feedlens.functions.times import event_day, hour, instant, local_hour
from feedlens.plans.summary import (highest_engagement, mean_engagement, share_if, summed, total,
                                    total_if)
from feedlens.schema import (ENTITY_KINDS, LEAD_BUCKET, LEAD_TOPIC, LOCAL_ZONE, PROBLEM_TOPICS,
                             SENTIMENTS)

RECENT_COLS = ("created_at", "item_type", "sentiment", "topic", "theme", "speaker", "company",
               "engagement", "action_bucket", "recommended_action", "text_en", "original_text",
               "url")


# ---- counts -------------------------------------------------------------------------------------

def count_by(gold: DataFrame, *keys: str, keep_null: bool = True) -> DataFrame:
    """``items`` per key, largest first."""
    if not keep_null:
        gold = gold.filter(F.col(keys[0]).isNotNull())
    return gold.groupBy(*keys).agg(total(gold).alias("items")).orderBy(F.desc("items"), *keys)


def total_items(gold: DataFrame) -> DataFrame:
    return gold.agg(total(gold).alias("total_items"))


def sentiment_mix(gold: DataFrame) -> DataFrame:
    return count_by(gold, "sentiment")


def theme_by_sentiment(gold: DataFrame, keep_null: bool = True) -> DataFrame:
    return count_by(gold, "theme", "sentiment", keep_null=keep_null)


def theme_counts(gold: DataFrame) -> DataFrame:
    return count_by(gold, "theme", keep_null=False)


def bucket_counts(gold: DataFrame, keep_null: bool = False) -> DataFrame:
    return count_by(gold, "action_bucket", keep_null=keep_null)


def source_flag_count(gold: DataFrame, source: str = "sample") -> DataFrame:
    """How many items come from one source, such as the made-up sample."""
    return gold.agg(total_if(gold, F.col("source") == source).alias("items"))


# ---- over time ----------------------------------------------------------------------------------

def hourly_sentiment(gold: DataFrame, zone: str | None = None) -> DataFrame:
    """Items per hour and sentiment, in UTC or on the clock of ``zone``."""
    at = F.col("created_at")
    return (gold.groupBy((hour(at) if zone is None else local_hour(at, zone)).alias("hour"),
                         "sentiment")
            .agg(total(gold).alias("items")))


def running_sentiment(gold: DataFrame, zone: str | None = None) -> DataFrame:
    """Running total per sentiment over the hours.

    The window only sees one row per hour and sentiment, so its groups are as long as the
    calendar and not as the feed.
    """
    so_far = (Window.partitionBy("sentiment").orderBy("hour")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (hourly_sentiment(gold, zone)
            .select("hour", "sentiment", F.sum("items").over(so_far).alias("cumulative_items"))
            .orderBy("hour", "sentiment"))


def daily_summary(gold: DataFrame) -> DataFrame:
    return (gold.groupBy(F.to_date("created_at").alias("day"))
            .agg(total(gold).alias("items"), F.sum("engagement").alias("engagement"),
                 F.round(mean_engagement(gold), 4).alias("avg_engagement"),
                 highest_engagement(gold).alias("max_engagement"))
            .orderBy("day"))


def sentiment_by_day(gold: DataFrame, start: date) -> DataFrame:
    """Share of each sentiment per event day and its change from the day with items before it."""
    days = gold.groupBy(event_day(F.col("created_at"), start).alias("day")).agg(
        total(gold).alias("items"),
        *[total_if(gold, F.col("sentiment") == s).alias(s) for s in SENTIMENTS])
    shares = {f"{s}_share": F.round(F.col(s) / F.col("items"), 6) for s in SENTIMENTS}
    # One row per day is left here, so a window over all of them is a short one.
    by_day = Window.orderBy("day")
    changes = {f"{s}_change": F.round(F.col(f"{s}_share") - F.lag(f"{s}_share").over(by_day), 6)
               for s in SENTIMENTS}
    return (days.withColumns(shares).withColumns(changes)
            .select("day", "items", *shares, *changes).orderBy("day"))


def on_event_day(gold: DataFrame, day: int, start: date) -> DataFrame:
    """Items of one event day, as a range of times that the scan can use."""
    midnight = F.lit(start).cast("timestamp")
    first = F.timestamp_add("DAY", F.lit(day - 1), midnight)
    last = F.timestamp_add("DAY", F.lit(day), midnight)
    return gold.filter((F.col("created_at") >= first) & (F.col("created_at") < last))


def last_hour(gold: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Items of the hour up to ``as_of``."""
    now = instant(as_of)
    return gold.filter((F.col("created_at") > now - F.expr("INTERVAL 1 HOUR"))
                       & (F.col("created_at") <= now))


# ---- what resonated -----------------------------------------------------------------------------

def resonance(gold: DataFrame, key: str = "theme", keep_null: bool = True) -> DataFrame:
    """Mentions, engagement and positive share per key, by mentions times the rounded share."""
    if not keep_null:
        gold = gold.filter(F.col(key).isNotNull())
    positive = share_if(gold, F.col("sentiment") == "positive")
    return (gold.groupBy(key)
            .agg(total(gold).alias("mentions"), F.sum("engagement").alias("engagement"),
                 F.round(positive, 2).alias("positive_share"))
            .orderBy(F.desc(F.col("mentions") * F.col("positive_share")), key))


def top_theme(gold: DataFrame) -> DataFrame:
    """The theme with the most positive items, then the most items; ``other`` does not count."""
    return (gold.filter(F.col("theme").isNotNull() & (F.col("theme") != "other"))
            .groupBy("theme")
            .agg(total_if(gold, F.col("sentiment") == "positive").alias("positive_items"),
                 total(gold).alias("items"))
            .orderBy(F.desc("positive_items"), F.desc("items"), "theme").limit(1))


def mood_share(gold: DataFrame) -> DataFrame:
    """Total, and the positive and negative percentage rounded half up; null without items."""
    def percent(sentiment: str) -> Column:
        share = (100 * total_if(gold, F.col("sentiment") == sentiment)
                 / F.nullif(total(gold), F.lit(0)))
        return F.round(share, 0).cast("bigint")

    return gold.agg(total(gold).alias("total"), percent("positive").alias("positive_pct"),
                    percent("negative").alias("negative_pct"))


def top_entities(gold: DataFrame, n: int = 10, kinds: Sequence[str] = ENTITY_KINDS) -> DataFrame:
    """The ``n`` most named values of each kind.

    Ranked after counting; Spark keeps only ``n`` rows per kind and task before the shuffle.
    """
    named = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in kinds])
    order = Window.partitionBy("kind").orderBy(F.desc("items"), "name")
    counted = ["items"] if summed(gold) else []
    return (gold.select(F.inline(named), *counted).filter(F.col("name").isNotNull())
            .groupBy("kind", "name").agg(total(gold).alias("items"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
            .select("kind", "rank", "name", "items"))


def thread_rollup(gold: DataFrame) -> DataFrame:
    """Replies and engagement per post.

    Posts and comments meet under the post's key in one grouping; the comments of a hot post are
    folded before the shuffle, and no join is needed.
    """
    is_post = F.col("item_type") == "post"
    return (gold.groupBy(F.when(is_post, F.col("item_id"))
                          .otherwise(F.col("parent_id")).alias("post_id"))
            .agg(F.count_if(is_post).alias("posts"),
                 F.count_if(~is_post).alias("replies"),
                 F.sum(F.when(is_post, F.col("engagement"))).alias("post_engagement"),
                 F.coalesce(F.sum(F.when(~is_post, F.col("engagement"))), F.lit(0))
                 .alias("reply_engagement"))
            .filter(F.col("posts") > 0).drop("posts"))


# ---- lists --------------------------------------------------------------------------------------

def newest(table: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` newest rows of any layer."""
    top = table.orderBy(F.desc("created_at"), "item_id").limit(n)
    return top.select(*columns) if columns else top


def recent_items(gold: DataFrame, n: int = 50) -> DataFrame:
    return newest(gold, n, RECENT_COLS)


def wall(gold: DataFrame, n: int = 200, zone: str = LOCAL_ZONE) -> DataFrame:
    """The newest items ready to show: local time, shortened texts, safe links."""
    return newest(gold, n).select(
        short_local_time(F.col("created_at"), zone).alias("time"), "item_type", "sentiment",
        "topic", "theme", "speaker", "company", "engagement", "action_bucket",
        "recommended_action", shorten(F.col("text_en")).alias("text_en"),
        shorten(F.col("original_text")).alias("original_text"),
        safe_link(F.col("url")).alias("link"))


def is_problem() -> Column:
    return (F.col("sentiment") == "negative") | F.col("topic").isin(*PROBLEM_TOPICS)


def is_lead() -> Column:
    return (F.col("action_bucket") == LEAD_BUCKET) | (F.col("topic") == LEAD_TOPIC)


def top_problems(gold: DataFrame, n: int = 20) -> DataFrame:
    return (gold.filter(is_problem()).orderBy(F.desc("engagement"), "item_id").limit(n)
            .select("topic", "recommended_action", "text_en", "engagement"))


def open_leads(gold: DataFrame) -> DataFrame:
    """Every lead, newest first."""
    return (gold.filter(is_lead()).orderBy(F.desc("created_at"), "item_id")
            .select("created_at", "company", "recommended_action", "text_en", "url"))
