"""Columns made for reading: safe links, shortened texts, short local times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_LIMIT = 400
ELLIPSIS = "…"
TIME_FORMAT = "dd MMM HH:mm"


def safe_link(url: Column) -> Column:
    return F.when(url.startswith("https://"), url)


def shorten(text: Column, limit: int = TEXT_LIMIT) -> Column:
    """The first ``limit`` characters and an ellipsis where there are more; null as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(ELLIPSIS))) \
            .otherwise(text)


def short_local_time(ts: Column, zone: str) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, zone), TIME_FORMAT)
