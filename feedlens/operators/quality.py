"""Checks of a feed table, masking, and the link from a comment to its post."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedlens.functions.actions import REPLY_OBJECT
from feedlens.functions.text import has_text, mask
from feedlens.schema import BUCKETS, ITEM_TYPES, SENTIMENTS, SOURCES, THEMES, TOPICS
from feedlens.sources.files import REJECTED

DOMAINS = {"item_type": ITEM_TYPES, "sentiment": SENTIMENTS, "topic": TOPICS, "theme": THEMES,
           "action_bucket": BUCKETS, "source": SOURCES}


def quality_report(feed: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS) -> DataFrame:
    """``rule`` and ``failures``: missing keys, repeated keys, orphan comments, unknown values.

    Each row counts once under its own key and, for a comment, once more under its post's key, so
    that one grouping finds repeats and orphans without a join; a hot post is folded before the
    shuffle. A null is not an unknown value.
    """
    checked = {c: d for c, d in domains.items() if c in feed.columns}
    flags = {"null_key": ~has_text(F.col("item_id"))}
    flags |= {f"domain_{c}": F.coalesce(~F.col(c).isin(*d), F.lit(False))
              for c, d in checked.items()}
    own = F.struct(F.col("item_id").alias("key"), F.lit(1).alias("own"), F.lit(0).alias("refs"),
                   *[flag.cast("int").alias(name) for name, flag in flags.items()])
    parent = F.struct(F.col("parent_id").alias("key"), F.lit(0).alias("own"),
                      F.lit(1).alias("refs"), *[F.lit(0).alias(name) for name in flags])
    uses = F.when(F.col("parent_id").isNotNull(), F.array(own, parent)).otherwise(F.array(own))
    per_key = (feed.select(F.inline(uses)).groupBy("key")
               .agg(*[F.sum(c).alias(c) for c in ("own", "refs", *flags)]))
    known = F.col("key").isNotNull()
    rules = {
        "duplicate_key": F.sum(F.when(known & (F.col("own") > 1), F.col("own") - 1)
                               .otherwise(0)),
        "orphan_comment": F.sum(F.when(F.col("own") == 0, F.col("refs")).otherwise(0)),
        **{name: F.sum(name) for name in flags},
    }
    totals = per_key.agg(*[F.coalesce(total, F.lit(0).cast("bigint")).alias(name)
                           for name, total in rules.items()])
    return totals.unpivot([], list(rules), "rule", "failures")


def rejected_rows(raw: DataFrame) -> DataFrame:
    """How many raw rows a normalising run drops for want of text, which corrupt lines are."""
    return raw.agg(F.count_if(~has_text(F.col("text"))).alias("rejected"),
                   F.count("*").alias("rows"))


def reject_causes(raw: DataFrame) -> dict[str, Column]:
    """Aggregates over raw rows read with ``rejects``: how many fall to which cause.

    ``corrupt_line`` cannot be read at all, ``wrong_type`` has a value that is no number where one
    is due (kept, the value is null), ``no_text`` is dropped for want of text, ``no_key`` gets a key
    made from its content. A row counts under each cause that it has, but a corrupt line under no
    other.
    """
    rejected = F.col(REJECTED.name).isNotNull()
    values = [F.col(c) for c in raw.columns if c != REJECTED.name]
    corrupt = rejected & F.coalesce(*[v.cast("string") for v in values]).isNull()
    text = has_text(F.col("text"))
    flags = {"corrupt_line": corrupt, "wrong_type": rejected & ~corrupt,
             "no_text": ~corrupt & ~text,
             "no_key": text & ~F.coalesce(has_text(F.col("item_id")), F.lit(False))}
    return {cause: F.count_if(flag).alias(cause) for cause, flag in flags.items()}


def reject_report(raw: DataFrame) -> DataFrame:
    """``cause`` and ``rows`` of raw rows read with ``rejects``."""
    causes = reject_causes(raw)
    return raw.agg(*causes.values()).unpivot([], list(causes), "cause", "rows")


def counting_rejects(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """Raw rows as a run takes them, and the counts by cause, which are there once the rows have
    been written: no pass of their own."""
    seen = Observation("rejects")
    return raw.observe(seen, *reject_causes(raw).values()).drop(REJECTED.name), seen


def unknown_buckets(replies: DataFrame) -> DataFrame:
    """``bucket`` and ``replies`` for the buckets of a ``reply`` column that are not among the
    known ones, so that a prompt that drifts is seen."""
    named = F.get_json_object(F.regexp_extract("reply", REPLY_OBJECT, 0), "$.bucket")
    return (replies.select(named.alias("bucket"))
            .filter(F.col("bucket").isNotNull() & ~F.col("bucket").isin(*BUCKETS))
            .groupBy("bucket").agg(F.count("*").alias("replies")))


def mask_text(feed: DataFrame, columns: Sequence[str], where: Column, pattern: str = r"(?s).+",
              replacement: str = "***") -> DataFrame:
    """``feed`` with ``pattern`` replaced in ``columns`` of the rows that meet ``where``."""
    return feed.withColumns({
        c: F.when(where, mask(F.col(c), pattern, replacement)).otherwise(F.col(c))
        for c in columns})


def with_post(feed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Comments with ``columns`` of the post they belong to, prefixed ``post_``; null if missing.

    A post with very many comments is a hot key on the left, which AQE cuts into many tasks.
    """
    posts = feed.filter(F.col("item_type") == "post").select(
        F.col("item_id").alias("parent_id"), *[F.col(c).alias(f"post_{c}") for c in columns])
    return feed.filter(F.col("item_type") == "comment").join(posts, "parent_id", "left")
