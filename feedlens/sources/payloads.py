"""Landed REST responses, flattened on the executors.

Each landed row is one response. Comment and metadata responses carry the ``post_id`` that they
were asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.identity import pseudonym, surrogate_key
from feedlens.functions.text import clean_markup, has_text
from feedlens.functions.times import from_millis, instant
from feedlens.schema import BRONZE_COLS, BRONZE_SCHEMA, FeedConfig

POSTS_PAYLOAD = (
    "elements ARRAY<STRUCT<id: STRING, author: STRING, commentary: STRING, "
    "publishedAt: BIGINT, createdAt: BIGINT>>")
COMMENTS_PAYLOAD = (
    "post_id STRING, elements ARRAY<STRUCT<id: STRING, commentUrn: STRING, actor: STRING, "
    "message: STRUCT<text: STRING>, created: STRUCT<time: BIGINT>, "
    "likesSummary: STRUCT<totalLikes: INT>, commentsSummary: STRUCT<aggregatedTotalComments: INT>>>")
METADATA_PAYLOAD = (
    "post_id STRING, reactionSummaries MAP<STRING, STRUCT<count: INT>>, "
    "commentSummary STRUCT<count: INT>")


def reaction_total(summaries: Column) -> Column:
    """All counts of a reaction map added up; a missing map or count is 0. A sum beyond the range of
    the column is its largest number."""
    none = F.lit(0).cast("bigint")
    total = F.aggregate(F.map_values(summaries), none,
                        lambda acc, r: acc + F.coalesce(r["count"].cast("bigint"), none))
    return F.least(F.coalesce(total, none), F.lit(2 ** 31 - 1)).cast("int")


def flatten_metadata(pages: DataFrame) -> DataFrame:
    return pages.select(
        "post_id", reaction_total(F.col("reactionSummaries")).alias("reactions"),
        F.coalesce("commentSummary.count", F.lit(0)).alias("comments"))


def within_lookback(posts: DataFrame, config: FeedConfig) -> DataFrame:
    """Posts inside the configured time span; those of unknown time stay."""
    at = F.col("created_at")
    if config.lookback_from is not None:
        posts = posts.filter(at.isNull() | (at >= instant(config.lookback_from)))
    if config.lookback_to is not None:
        posts = posts.filter(at.isNull() | (at < instant(config.lookback_to)))
    return posts


def flatten_posts(pages: DataFrame, config: FeedConfig) -> DataFrame:
    """One row per post that has an id and is recent enough, with or without text."""
    posts = (pages.select(F.explode("elements").alias("p"))
             .filter(has_text(F.col("p.id")))
             .select(F.col("p.id").alias("item_id"), F.col("p.author").alias("author"),
                     clean_markup(F.col("p.commentary")).alias("text"),
                     F.coalesce(from_millis(F.col("p.publishedAt")),
                                from_millis(F.col("p.createdAt"))).alias("created_at")))
    return within_lookback(posts, config)


def flatten_comments(pages: DataFrame) -> DataFrame:
    """One row per comment with text; without any id it gets the key that a file row would get."""
    c = "c."
    return (pages.select("post_id", F.explode("elements").alias("c"))
            .select(
                F.coalesce(F.when(F.col(c + "commentUrn") != "", F.col(c + "commentUrn")),
                           F.concat("post_id", F.lit("#comment:"), F.coalesce(
                               F.nullif(F.col(c + "id"), F.lit("")),
                               surrogate_key(F.col(c + "actor"), F.col(c + "message.text")))),
                           surrogate_key(F.col(c + "actor"), F.col(c + "message.text")),
                           ).alias("item_id"),
                F.col("post_id").alias("parent_id"), F.col(c + "actor").alias("author"),
                clean_markup(F.col(c + "message.text")).alias("text"),
                from_millis(F.col(c + "created.time")).alias("created_at"),
                F.coalesce(c + "likesSummary.totalLikes", F.lit(0)).alias("reactions"),
                F.coalesce(c + "commentsSummary.aggregatedTotalComments", F.lit(0))
                 .alias("comments"))
            .filter(has_text(F.col("text"))))


def _with_counts(posts: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row per post with the counts of its metadata, 0 where it has none.

    Posts and counts are stacked and grouped by id: one shuffle, and a post landed many times
    folds into one row before it.
    """
    body = F.struct("created_at", "text", "author")
    none = F.lit(None).cast("int")
    stacked = posts.select("item_id", body.alias("post"), none.alias("reactions"),
                           none.alias("comments")).unionByName(
        flatten_metadata(metadata).withColumnRenamed("post_id", "item_id"),
        allowMissingColumns=True)
    return (stacked.groupBy("item_id")
            .agg(F.max("post").alias("post"),
                 F.coalesce(F.max("reactions"), F.lit(0)).alias("reactions"),
                 F.coalesce(F.max("comments"), F.lit(0)).alias("comments"))
            .filter(F.col("post").isNotNull())
            .select("item_id", "post.*", "reactions", "comments"))


def payload_feed(posts: DataFrame, comments: DataFrame, metadata: DataFrame,
                 config: FeedConfig) -> DataFrame:
    """Landed posts, comments and counts as one feed in the Bronze contract.

    A post without text gives no row, but its comments stay; comments of a post that is too old
    are dropped with it.
    """
    kept = flatten_posts(posts, config)
    replies = comments.join(kept.select(F.col("item_id").alias("post_id")), "post_id", "left_semi")
    before, after = config.post_url
    post_rows = (_with_counts(kept, metadata).filter(has_text(F.col("text")))
                 .withColumns({"item_type": F.lit("post"),
                               "parent_id": F.lit(None).cast("string"),
                               "post_id": F.col("item_id")}))
    comment_rows = flatten_comments(replies).withColumns(
        {"item_type": F.lit("comment"), "post_id": F.col("parent_id")})
    return (post_rows.unionByName(comment_rows)
            .withColumns({
                "author": pseudonym(F.col("author"), config.organisation_prefix),
                "author_headline": F.lit(None).cast("string"),
                "lang": F.lit(None).cast("string"),
                "reposts": F.lit(0),
                "url": F.concat(F.lit(before), "post_id", F.lit(after)),
                "source": F.lit("linkedin_api")})
            .select(*[F.col(c).cast(BRONZE_SCHEMA[c].dataType) for c in BRONZE_COLS]))
