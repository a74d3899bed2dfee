import hashlib

from conftest import at, table
from pyspark.sql import functions as F

from feedlens.functions.display import safe_link, short_local_time, shorten
from feedlens.functions.text import clean_markup, has_text, phrase_key, strip, terms
from feedlens.functions.times import event_day, from_millis, instant, local_hour
from feedlens.operators.normalize import normalize
from feedlens.schema import FeedConfig

NOW = at("2026-09-30T12:00:00")
CONFIG = FeedConfig(keywords=("My Event", "C++ (talks)"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_blank_texts_are_dropped(raw):
    rows = raw(*[{"item_id": str(i), "text": t, "source": "sample"}
                 for i, t in enumerate([None, "", "  ", "\t\n", "\u00a0", " x "])])
    assert table(normalize(rows, CONFIG, NOW), "item_id", "text") == [("5", " x ")]


def test_defaults_and_surrogate_key(raw):
    rows = raw({"text": "about my event", "author": "ann"}, {"text": "My Event again"})
    assert table(normalize(rows, CONFIG, NOW), "item_id", "item_type", "source", "reactions") == \
        sorted([(sha("ann|about my event"), "post", "file", 0),
                (sha("My Event again"), "post", "file", 0)])


def test_pseudonyms(raw):
    authors = [None, " ", "urn:li:organization:5", "urn:li:person:5"]
    rows = raw(*[{"item_id": str(i), "text": "x", "source": "sample", "author": a}
                 for i, a in enumerate(authors)])
    assert table(normalize(rows, CONFIG, NOW), "item_id", "author") == [
        ("0", None), ("1", None), ("2", "urn:li:organization:5"),
        ("3", sha("urn:li:person:5")[:16])]


def test_times(raw):
    times = ["2026-09-22T07:40:00Z", "2026-09-22", "soon", None, "2026-09-22T09:40:00+02:00"]
    rows = raw(*[{"item_id": str(i), "text": "x", "source": "sample", "created_at": t}
                 for i, t in enumerate(times)])
    assert [r[1] for r in table(normalize(rows, CONFIG, NOW), "item_id", "created_at")] == [
        at("2026-09-22T07:40"), at("2026-09-22"), NOW, NOW, at("2026-09-22T07:40")]


def test_keyword_filter(raw):
    cases = [("hit", "file", "post", "MY EVENT!"), ("literal", None, None, "c++ (TALKS)"),
             ("miss", "file", "post", "other"), ("default miss", None, None, "ctalks"),
             ("comment", "file", "comment", "other"), ("sample", "sample", "post", "other")]
    rows = raw(*[{"item_id": i, "source": s, "item_type": t, "text": x} for i, s, t, x in cases])
    assert {r[0] for r in table(normalize(rows, CONFIG, NOW), "item_id")} == {
        "hit", "literal", "comment", "sample"}
    assert normalize(rows, FeedConfig(), NOW).count() == len(cases)


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def test_text_functions(spark):
    marked = "  {hashtag|\\#|AI} and {hashtag|#|Web} by @[Ann Lee](urn:li:person:1) \\(ok\\) \\d\t"
    assert one(spark, clean_markup, marked) == "#AI and #Web by @Ann Lee (ok) \\d"
    assert one(spark, clean_markup, None) is None
    assert one(spark, strip, "\u00a0 a b\n") == "a b"
    assert one(spark, has_text, None) is False
    assert one(spark, terms, "L'Àgora, d'Ús 22@ x_y") == ["l", "àgora", "d", "ús", "22", "x", "y"]
    assert one(spark, terms, None) == []
    assert one(spark, phrase_key, " World-Trade  CENTER") == "world trade center"


def test_time_functions(spark):
    assert one(spark, from_millis, 1_758_526_800_123, "bigint") == at("2025-09-22T07:40:00.123")
    assert one(spark, from_millis, 0, "bigint") is None
    assert spark.range(1).select(instant(NOW)).first()[0] == NOW
    hours = spark.createDataFrame([("2026-10-25 00:30:00",), ("2026-10-25 01:30:00",)], "v string")
    folded = hours.select(local_hour(F.col("v").cast("timestamp"), "Europe/Madrid")).distinct()
    assert [r[0] for r in folded.collect()] == [at("2026-10-25T02:00")]
    days = spark.createDataFrame([("2026-09-21 23:59:59",), ("2026-09-22 00:00:00",),
                                  ("2026-09-23 10:00:00",)], "v string")
    assert [r[0] for r in days.select(event_day(F.col("v").cast("timestamp"),
                                                at("2026-09-22").date())).collect()] == [0, 1, 2]


def test_display_functions(spark):
    assert one(spark, safe_link, "http://x") is None
    assert one(spark, safe_link, "https://x") == "https://x"
    assert one(spark, shorten, "a" * 400) == "a" * 400
    assert one(spark, shorten, "a" * 401) == "a" * 400 + "…"
    assert one(spark, shorten, None) == ""
    assert one(spark, lambda c: short_local_time(c.cast("timestamp"), "Europe/Madrid"),
               "2026-09-22 07:40:00") == "22 Sep 09:40"
