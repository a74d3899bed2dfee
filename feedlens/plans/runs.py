"""The pipeline as functions: Bronze, Silver, Gold, or all three."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame

from feedlens.operators.enrich import Enrichment, enriched
from feedlens.operators.normalize import normalize
from feedlens.schema import FeedConfig
from feedlens.sources.files import read_drop
from feedlens.sources.payloads import payload_feed
from feedlens.sources.store import FeedStore

Moment = datetime | Column


def incoming_from_folder(store: FeedStore, folder: str, config: FeedConfig,
                         as_of: Moment) -> DataFrame:
    """The drop folder's files in the Bronze contract."""
    return normalize(read_drop(store.spark, folder), config, as_of)


def incoming_from_payloads(posts: DataFrame, comments: DataFrame, metadata: DataFrame,
                           config: FeedConfig) -> DataFrame:
    """Landed responses in the Bronze contract."""
    return payload_feed(posts, comments, metadata, config)


def run_bronze(store: FeedStore, incoming: DataFrame, batch: int, as_of: Moment) -> int:
    """Merge ``incoming`` and return the number of new items; an empty one changes nothing."""
    return store.upsert(incoming, batch, as_of)


def run_silver(store: FeedStore, using: Enrichment, batch: int) -> None:
    """Enrich the batch's new items, and earlier ones that have no Silver row yet."""
    if batch not in store.batches("silver", committed=True):
        by_day = not store.without_silver(batch) or store.done(batch).fits()
        rows, in_place = enriched(store.pending(batch), using)
        store.write_silver(rows, batch, stay=by_day and in_place)


def run_gold(store: FeedStore, batch: int | None = None) -> None:
    """Bring Gold up to date, for the days touched by ``batch`` or for all."""
    store.write_gold(batch)


def run_all(store: FeedStore, incoming: DataFrame, using: Enrichment, as_of: Moment,
            run: str | None = None) -> int:
    """One batch through all layers; returns the number of new items.

    A run that failed is continued by calling it again under the same ``run`` name with the same
    input; without a name every call is a run of its own.
    """
    batch = store.claim(run or f"run-{uuid4().hex}")
    new = run_bronze(store, incoming, batch, as_of)
    run_silver(store, using, batch)
    run_gold(store, batch)
    return new
