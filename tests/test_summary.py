"""A summary gives the same answers as the rows of Gold that it was made from."""

import random
import re
from datetime import date, datetime, timedelta

import pytest

from feedlens.operators.places import location_moods, place_mood, top_locations
from feedlens.plans import metrics
from feedlens.plans.summary import LABELS, SUMMARY_SCHEMA, summarize
from feedlens.schema import GOLD_SCHEMA, SENTIMENTS, THEMES

START = date(2026, 3, 27)
METRICS = {
    "total_items": metrics.total_items, "sentiment_mix": metrics.sentiment_mix,
    "theme_by_sentiment": metrics.theme_by_sentiment, "theme_counts": metrics.theme_counts,
    "bucket_counts": lambda g: metrics.bucket_counts(g, keep_null=True),
    "source_flag_count": metrics.source_flag_count,
    "hourly_utc": metrics.hourly_sentiment,
    "hourly_local": lambda g: metrics.hourly_sentiment(g, "Europe/Madrid"),
    "hourly_nepal": lambda g: metrics.hourly_sentiment(g, "Asia/Kathmandu"),
    "running": metrics.running_sentiment, "daily_summary": metrics.daily_summary,
    "sentiment_by_day": lambda g: metrics.sentiment_by_day(g, START),
    "event_day": lambda g: metrics.sentiment_mix(metrics.on_event_day(g, 3, START)),
    "resonance": metrics.resonance,
    "resonance_by_speaker": lambda g: metrics.resonance(g, "speaker", keep_null=False),
    "top_theme": metrics.top_theme, "mood_share": metrics.mood_share,
    "top_entities": metrics.top_entities, "location_moods": location_moods,
    "place_mood": place_mood, "top_locations": top_locations,
}


def gold_rows(n, seed=4):
    pick = random.Random(seed)
    some = lambda *values: pick.choice(values)
    for i in range(n):
        row = {"item_id": f"k{i}", "item_type": some("post", "comment"),
               "created_at": some(None, *[datetime(2026, 3, 28) + timedelta(
                   minutes=pick.randrange(4000))] * 9),
               "sentiment": some(*SENTIMENTS, None), "theme": some(*THEMES[:3], None),
               "topic": some("logistics", None), "source": some("file", "sample"),
               "speaker": some("Ann", "Bo", None), "company": some("Acme", None),
               "location": some("Port Vell", " unknown", "Madrid", "wtc", None),
               "engagement": some(None, pick.randrange(100)),
               "action_bucket": some("monitor", "content", None)}
        yield tuple(row.get(c) for c in GOLD_SCHEMA.names)


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(list(gold_rows(600)), GOLD_SCHEMA).cache()


@pytest.fixture(scope="module")
def summary(gold):
    return summarize(gold).cache()


def same(one, two):
    assert one.columns == two.columns and one.dtypes == two.dtypes
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


@pytest.mark.parametrize("name", METRICS)
def test_metric_from_a_summary(gold, summary, name):
    same(METRICS[name](gold), METRICS[name](summary))


@pytest.mark.parametrize("name", METRICS)
def test_metric_of_nothing(spark, name):
    nothing = spark.createDataFrame([], GOLD_SCHEMA)
    same(METRICS[name](nothing), METRICS[name](summarize(nothing)))


def test_summaries_of_parts_add_up(gold, summary):
    parts = [summarize(gold.filter(f"hash(item_id) % 3 = {i}")) for i in (-2, -1, 0, 1, 2)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    for metric in ("sentiment_mix", "daily_summary", "resonance", "mood_share"):
        same(METRICS[metric](together), METRICS[metric](summary))
    assert summary.columns == SUMMARY_SCHEMA.names


def test_a_stored_summary_follows_the_batches_and_reads_no_gold(spark, feed, tmp_path):
    from conftest import at
    from test_upsert import silver_rows

    from feedlens.sources.store import FeedStore

    store = FeedStore(spark, str(tmp_path)).create()
    for number in range(3):
        rows = [{"item_id": f"k{number}{i}", "created_at": at(f"2026-01-0{number + 1}T0{i}:20"),
                 "sentiment": SENTIMENTS[i % 4]} for i in range(5)]
        known = [{"item_id": "k00", "created_at": at("2026-01-01T00:20"), "reactions": number}]
        store.upsert(feed(*[{k: v for k, v in r.items() if k != "sentiment"} for r in rows],
                          *(known if number else [])), number, at("2026-01-09"))
        store.write_silver(silver_rows(spark, *rows), number)
        store.write_gold(number)
    for metric in ("daily_summary", "hourly_local", "total_items"):
        same(METRICS[metric](store.gold()), METRICS[metric](store.summary()))
    answer = METRICS["daily_summary"](store.summary())
    assert all("/summary/" in file for file in answer.inputFiles())
    text = answer._jdf.queryExecution().executedPlan().toString()
    assert not re.search("original_text|text_en", text) and set(LABELS) < set(GOLD_SCHEMA.names)
