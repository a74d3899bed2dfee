from datetime import date

import pytest
from conftest import at, table
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators.places import place_mood, top_locations
from feedlens.operators.quality import mask_text, quality_report, with_post
from feedlens.plans import metrics
from feedlens.schema import GOLD_COLS

TYPES = {"created_at": T.TimestampType(), "engagement": T.LongType()}
SCHEMA = T.StructType([T.StructField(c, TYPES.get(c, T.StringType())) for c in GOLD_COLS])
START = date(2026, 9, 22)


@pytest.fixture(scope="module")
def gold(spark):
    def make(*rows):
        filled = [{"item_id": f"i{k}", "item_type": "post", "engagement": 1,
                   "created_at": at("2026-09-22T10:00"), **row} for k, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r.get(c) for c in GOLD_COLS) for r in filled], SCHEMA)
    return make


def many(gold):
    moods = ["positive", "negative", "neutral", "mixed", "positive", "positive", None]
    return gold(*[{"sentiment": moods[k % 7], "theme": ["agents", "other", None][k % 3],
                   "created_at": at(f"2026-09-2{2 + k % 3}T{k % 24:02d}:30"), "engagement": k}
                  for k in range(60)])


def test_running_totals(gold):
    rows = many(gold)
    running = metrics.running_sentiment(rows)
    last = running.groupBy("sentiment").agg(F.max("cumulative_items").alias("n"))
    assert table(last) == table(metrics.sentiment_mix(rows), "sentiment", "items")
    default_frame = metrics.hourly_sentiment(rows).select(
        "hour", "sentiment",
        F.sum("items").over(Window.partitionBy("sentiment").orderBy("hour")).alias("n"))
    assert table(default_frame) == table(running)
    hours = [r["hour"] for r in running.collect()]
    assert hours == sorted(hours)


def test_two_utc_hours_fold_into_one_local_hour(gold):
    rows = gold(*[{"sentiment": "neutral", "created_at": at(f"2026-10-25T0{h}:30")}
                  for h in (0, 1, 2)])
    assert table(metrics.running_sentiment(rows, "Europe/Madrid")) == [
        (at("2026-10-25T02:00"), "neutral", 2), (at("2026-10-25T03:00"), "neutral", 3)]


def test_buckets_with_and_without_null(gold):
    rows = gold({"action_bucket": "content"}, {"action_bucket": None}, {"action_bucket": None})
    assert table(metrics.bucket_counts(rows)) == [("content", 1)]
    assert [tuple(r) for r in metrics.bucket_counts(rows, keep_null=True).collect()] == [
        (None, 2), ("content", 1)]


def test_resonance_orders_by_rounded_share(gold):
    rows = gold(*[{"theme": "a", "sentiment": "positive" if k == 0 else None} for k in range(3)],
                *[{"theme": "b", "sentiment": "positive" if k < 2 else "mixed"} for k in range(2)],
                {"theme": "c", "sentiment": "negative"})
    got = [(r[0], r[1], r[2], float(r[3])) for r in metrics.resonance(rows).collect()]
    assert got == [("b", 2, 2, 1.0), ("a", 3, 3, 0.33), ("c", 1, 1, 0.0)]


def test_top_theme_ignores_other_and_breaks_ties(gold):
    rows = gold({"theme": "other", "sentiment": "positive"}, {"theme": "b"}, {"theme": "a"},
                {"theme": None, "sentiment": "positive"})
    assert metrics.top_theme(rows).first()["theme"] == "a"


def test_mood_share_rounds_half_up(gold):
    rows = gold(*[{"sentiment": "positive" if k == 0 else "negative"} for k in range(8)])
    assert tuple(metrics.mood_share(rows).first()) == (8, 13, 88)
    assert tuple(metrics.mood_share(rows.limit(0)).first()) == (0, None, None)


def test_days(gold):
    rows = gold({"sentiment": "positive", "created_at": at("2026-09-22T00:00")},
                {"sentiment": "negative", "created_at": at("2026-09-22T23:59:59")},
                {"sentiment": "positive", "created_at": at("2026-09-23T00:00")})
    by_day = {r["day"]: r for r in metrics.sentiment_by_day(rows, START).collect()}
    assert (by_day[1]["positive_share"], by_day[1]["positive_change"]) == (0.5, None)
    assert (by_day[2]["positive_share"], by_day[2]["positive_change"]) == (1.0, 0.5)
    shares = [sum(r[f"{s}_share"] for s in ("positive", "negative", "neutral", "mixed"))
              for r in metrics.sentiment_by_day(many(gold).filter("sentiment IS NOT NULL"),
                                                START).collect()]
    assert all(abs(s - 1) < 1e-5 for s in shares)
    assert table(metrics.on_event_day(rows, 2, START), "item_id") == [("i2",)]
    assert table(metrics.last_hour(rows, at("2026-09-23T00:30")), "item_id") == [("i1",), ("i2",)]
    assert [r["items"] for r in metrics.daily_summary(rows).collect()] == [2, 1]


def test_problems_and_leads(gold):
    rows = gold({"sentiment": "negative", "engagement": 5}, {"topic": "logistics"},
                {"topic": "session complaint", "engagement": 9}, {"topic": "session praise"},
                {"action_bucket": "follow_up", "company": "A"},
                {"topic": "sponsor & lead signal", "company": "B",
                 "created_at": at("2026-09-23T10:00")})
    assert [r["engagement"] for r in metrics.top_problems(rows).collect()] == [9, 5, 1]
    assert [r["company"] for r in metrics.open_leads(rows).collect()] == ["B", "A"]


def test_threads_and_posts_of_comments(gold):
    rows = gold({"item_id": "p", "engagement": 5}, {"item_id": "q"},
                {"item_id": "c", "item_type": "comment", "parent_id": "p", "engagement": 2},
                {"item_id": "d", "item_type": "comment", "parent_id": "p"},
                {"item_id": "e", "item_type": "comment", "parent_id": "gone"})
    assert table(metrics.thread_rollup(rows)) == [("p", 2, 5, 3), ("q", 0, 1, 0)]
    assert table(with_post(rows, ["engagement"]), "item_id", "post_engagement") == [
        ("c", 5), ("d", 5), ("e", None)]


def test_entities_ranked_per_kind(gold):
    rows = gold({"speaker": "x", "company": "k"}, {"speaker": "y"}, {"speaker": "y"}, {})
    assert table(metrics.top_entities(rows, 1)) == [("company", 1, "k", 1), ("speaker", 1, "y", 2)]


def test_places(gold):
    rows = gold(*[{"location": loc, "sentiment": mood} for loc, mood in [
        ("World Trade Center Barcelona", "positive"), (" WTC ", "negative"),
        ("Port de Barcelona", "mixed"), ("wtc", "negative"), ("GRÀCIA", "neutral"),
        ("22@ district", "mixed"), ("Madrid", "positive"), ("Unknown", "positive"), ("  ", None),
        (None, None)]])
    got = table(place_mood(rows), "place", "lat", "items", "mood", "radius")
    assert got == [("22@ District", 41.402, 1, "mixed", 175), ("Gràcia", 41.4036, 1, "neutral", 175),
                   ("Port De Barcelona", 41.3716, 4, "negative", 340)]
    tied = gold({"location": "wtc", "sentiment": "mixed"}, {"location": "wtc",
                                                           "sentiment": "negative"})
    assert table(place_mood(tied), "mood") == [("negative",)]
    assert [r["location"] for r in top_locations(rows, 2).collect()] == [" WTC ", "22@ district"]
    assert table(place_mood(rows, (("o'ma\\d", 1.0, 2.0), ("mad", 3.0, 4.0))), "lat") == [(3.0,)]


def test_quality_report(gold):
    rows = gold({"item_id": "p", "topic": "logistics"}, {"item_id": "p", "topic": "weather"},
                {"item_id": None}, {"item_id": " "},
                {"item_id": "c", "item_type": "comment", "parent_id": "p", "source": "fax"},
                {"item_id": "d", "item_type": "comment", "parent_id": "gone"},
                {"item_id": "e", "item_type": "comment", "parent_id": "gone"})
    assert dict(table(quality_report(rows))) == {
        "duplicate_key": 1, "orphan_comment": 2, "null_key": 2, "domain_item_type": 0,
        "domain_sentiment": 0, "domain_topic": 1, "domain_theme": 0, "domain_action_bucket": 0,
        "domain_source": 1}
    assert {r[1] for r in table(quality_report(rows.limit(0)))} == {0}


def test_masking(gold):
    rows = gold({"text_en": "mail a@b.c\nnow", "source": "file"}, {"text_en": "keep"})
    assert table(mask_text(rows, ["text_en"], F.col("source") == "file"), "text_en") == [
        ("***",), ("keep",)]
    assert table(mask_text(rows, ["text_en"], F.col("source") == "file", r"\S+@\S+", "<m>"),
                 "text_en") == [("keep",), ("mail <m>\nnow",)]


def test_wall_shows_safe_short_columns(gold):
    rows = gold({"text_en": "x" * 500, "url": "http://plain"}, {"url": "https://ok"})
    wall = metrics.wall(rows).collect()
    assert [(r["time"], len(r["text_en"]), r["link"]) for r in wall] == [
        ("22 Sep 12:00", 401, None), ("22 Sep 12:00", 0, "https://ok")]
