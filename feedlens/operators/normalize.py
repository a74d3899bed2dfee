"""Raw file rows to the Bronze contract."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.identity import pseudonym, surrogate_key
from feedlens.functions.text import has_text
from feedlens.functions.times import parse_time
from feedlens.schema import BRONZE_COLS, BRONZE_DEFAULTS, FeedConfig


def quoted(keyword: str) -> str:
    """A keyword as a pattern of the JVM's regex engine that stands for itself."""
    return "\\Q" + keyword.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def unrelated_post(keywords: tuple[str, ...]) -> Column:
    """A post out of a file that names none of the keywords, in whatever case."""
    names_one = F.col("text").rlike("(?i)" + "|".join(map(quoted, keywords)))
    return ((F.col("source") == BRONZE_DEFAULTS["source"]) & (F.col("item_type") != "comment")
            & ~names_one)


def keep_tracked(feed: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    """The feed without unrelated posts; without keywords nothing is unrelated."""
    return feed.filter(~unrelated_post(keywords)) if keywords else feed


def normalize(raw: DataFrame, config: FeedConfig, as_of: datetime | Column) -> DataFrame:
    """Rows with text in the Bronze contract, each column by its rule, and only tracked ones.

    All rules read the raw row: the key of a row without one comes from the author as given.
    """
    rules = {
        "item_id": F.coalesce("item_id", surrogate_key(F.col("author"), F.col("text"))),
        "author": pseudonym(F.col("author"), config.organisation_prefix),
        "created_at": parse_time(F.col("created_at"), as_of),
    }

    def rule(name: str) -> Column:
        if name in BRONZE_DEFAULTS:
            return F.coalesce(name, F.lit(BRONZE_DEFAULTS[name]))
        return rules.get(name, F.col(name))

    rows = raw.filter(has_text(F.col("text"))).select(*[rule(c).alias(c) for c in BRONZE_COLS])
    return keep_tracked(rows, config.keywords)
