"""Table contracts, value domains and run configuration."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import types as T

# ---- fixed values: column contracts and value domains -----------------------------------------

BRONZE_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("author_headline", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("reactions", T.IntegerType()),
    T.StructField("comments", T.IntegerType()),
    T.StructField("reposts", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
])

GOLD_COLS = ("item_id", "item_type", "parent_id", "created_at", "sentiment", "topic", "theme",
             "speaker", "company", "location", "engagement", "author_headline", "text_en",
             "original_text", "action_bucket", "recommended_action", "url", "source")

# What a raw row without these values gets.
BRONZE_DEFAULTS = {"item_type": "post", "source": "file", "reactions": 0, "comments": 0,
                   "reposts": 0}

ITEM_TYPES = ("post", "comment")
SENTIMENTS = ("positive", "negative", "neutral", "mixed")
TOPICS = ("session praise", "session complaint", "logistics", "networking & hiring",
          "sponsor & lead signal", "general chatter")
THEMES = ("agents", "genai & llms", "data & infrastructure", "ethics & regulation",
          "industry use cases", "startups & funding", "talent & careers", "other")
BUCKETS = ("amplify", "fix_ops", "follow_up", "content", "monitor")
SOURCES = ("linkedin_api", "file", "sample")
ENTITY_KINDS = ("speaker", "company", "location")
PROBLEM_TOPICS = ("session complaint", "logistics")
LEAD_TOPIC = "sponsor & lead signal"
LEAD_BUCKET = "follow_up"
ORGANISATION_PREFIX = "urn:li:organization"
POST_URL = ("https://www.linkedin.com/feed/update/", "/")
LOCAL_ZONE = "Europe/Madrid"

# Places on the map in matching order: the first name found in a location wins.
PLACES = (
    ("world trade center", 41.3716, 2.1797),
    ("wtc", 41.3716, 2.1797),
    ("port of barcelona", 41.3716, 2.1797),
    ("port de barcelona", 41.3716, 2.1797),
    ("puerto de barcelona", 41.3716, 2.1797),
    ("port vell", 41.3758, 2.1830),
    ("pier01", 41.3810, 2.1860),
    ("palau de mar", 41.3810, 2.1860),
    ("barceloneta", 41.3797, 2.1892),
    ("drassanes", 41.3755, 2.1760),
    ("montjuic", 41.3641, 2.1585),
    ("poblenou", 41.4035, 2.1960),
    ("22@", 41.4020, 2.1940),
    ("eixample", 41.3910, 2.1649),
    ("gracia", 41.4036, 2.1560),
    ("placa catalunya", 41.3870, 2.1700),
    ("ciutat vella", 41.3833, 2.1777),
    ("el born", 41.3849, 2.1817),
    ("ciutadella", 41.3880, 2.1870),
    ("sagrada familia", 41.4036, 2.1744),
    ("fira", 41.3553, 2.1277),
    ("diagonal", 41.3947, 2.1490),
    ("upc", 41.3890, 2.1130),
    ("barcelona", 41.3874, 2.1686),
)

# ---- end of fixed values ------------------------------------------------------------------------

COUNT_COLS = ("reactions", "comments", "reposts")
BRONZE_COLS = tuple(BRONZE_SCHEMA.fieldNames())

# What a dropped file may hold: the same columns, with the time still as text.
RAW_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "created_at" else f.dataType)
    for f in BRONZE_SCHEMA
])

ENTITIES_TYPE = T.StructType([T.StructField(kind, T.StringType()) for kind in ENTITY_KINDS])

SILVER_SCHEMA = T.StructType(
    [BRONZE_SCHEMA[c] for c in ("item_id", "item_type", "parent_id", "created_at",
                                "author_headline", "lang", "source", "url")]
    + [T.StructField("original_text", T.StringType()),
       T.StructField("sentiment", T.StringType()),
       T.StructField("topic", T.StringType()),
       T.StructField("theme", T.StringType()),
       T.StructField("entities", ENTITIES_TYPE),
       T.StructField("text_en", T.StringType()),
       T.StructField("action_bucket", T.StringType()),
       T.StructField("recommended_action", T.StringType())])

_GOLD_TYPES = {**{f.name: f.dataType for f in SILVER_SCHEMA},
               **{f.name: f.dataType for f in ENTITIES_TYPE}, "engagement": T.LongType()}
GOLD_SCHEMA = T.StructType([T.StructField(c, _GOLD_TYPES[c]) for c in GOLD_COLS])


@dataclass(frozen=True)
class FeedConfig:
    """Settings of one event feed.

    ``keywords`` filter posts from plain files; empty keeps every post. ``lookback_from`` and
    ``lookback_to`` bound the posts taken from landed payloads. ``event_start`` is day 1.
    """

    keywords: tuple[str, ...] = ()
    event_start: date | None = None
    lookback_from: datetime | None = None
    lookback_to: datetime | None = None
    zone: str = LOCAL_ZONE
    post_url: tuple[str, str] = POST_URL
    organisation_prefix: str = ORGANISATION_PREFIX
