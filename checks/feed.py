"""The feed that the registered queries run on, derived from the given tables."""

from __future__ import annotations

from datetime import date, datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.text import terms
from feedlens.operators.classify import learn_bayes, list_weights
from feedlens.operators.enrich import Enrichment, prepare_enrichment
from feedlens.operators.sentiment import learn_lexicon
from feedlens.operators.translate import text_hash
from feedlens.schema import BRONZE_COLS, BUCKETS, THEMES, TOPICS
from feedlens.session import materialize

LANGUAGES = ("de", "en", "es", "fr")
EVENT_START = date(2024, 1, 1)
AS_OF = datetime(2024, 2, 1)
SPLIT = datetime(2024, 1, 8)
LOCATIONS = ("World Trade Center", "Port Vell", "Montjuïc", "unknown", " ", None, " Gràcia ",
             "WTC Barcelona", "Madrid")


SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "benchmark": "item_id BIGINT, text STRING",
}


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with its schema declared so that no file is opened to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def choose(number: Column, values: tuple) -> Column:
    """One of ``values`` by a number that is not negative."""
    options = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(options, (number % len(values)).cast("int"))


def one_of(number: str, values: tuple) -> str:
    options = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"get(array({options}), CAST({number} % {len(values)} AS INT))"


FEED = f"""
SELECT item_id, item_type, parent_id, CAST(user_id AS STRING) AS author, author_headline, text,
       lang, CAST(ts AS TIMESTAMP) AS created_at, CAST(floor(value) AS INT) AS reactions,
       CAST(get_json_object(props, '$.k') AS INT) AS comments, reposts, url, source,
       CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative'
                       WHEN 'click' THEN 'mixed' ELSE 'neutral' END AS sentiment,
       {one_of("event_id", TOPICS)} AS topic, {one_of("user_id", THEMES)} AS theme,
       IF(user_id % 11 <> 0, {one_of("(user_id + event_id)", BUCKETS)}, NULL) AS action_bucket,
       {one_of("user_id", LOCATIONS)} AS location,
       IF(user_id % 3 <> 0, concat('Speaker ', user_id % 17), NULL) AS speaker,
       IF(user_id % 3 <> 0, concat('Company ', user_id % 17), NULL) AS company
FROM (
  SELECT doc_id * 5 AS event_id, concat('doc:', doc_id) AS item_id, 'post' AS item_type,
         CAST(NULL AS STRING) AS parent_id, source AS author_headline, text, lang,
         CAST(n_chars % 7 AS INT) AS reposts, concat('https://feed.example/', doc_id) AS url,
         'file' AS source
  FROM {{documents}}
  UNION ALL
  SELECT conv_id * 8 + turn, concat('conv:', conv_id, ':', turn),
         IF(turn = 0, 'post', 'comment'), IF(turn <> 0, concat('conv:', conv_id, ':0'), NULL),
         role, text, NULL, 0, NULL, 'linkedin_api'
  FROM {{conversations}})
LEFT JOIN {{events}} USING (event_id)"""


@cache
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts, conversations as posts with comments; times and counts from events."""
    return spark.sql(FEED, **{name: table(spark, sf_dir, name)
                              for name in ("documents", "conversations", "events")})


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select(*BRONZE_COLS)


@cache
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as Silver rows with the derived labels, an English text and an action."""
    return feed(spark, sf_dir).selectExpr(
        "item_id", "item_type", "parent_id", "created_at", "author_headline", "lang", "source",
        "url", "text AS original_text", "sentiment", "topic", "theme",
        "struct(speaker, company, location) AS entities",
        "CASE WHEN lang = 'en' THEN text END AS text_en", "action_bucket",
        "concat('Do: ', action_bucket) AS recommended_action")


@cache
def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as Gold rows, without joining the layers."""
    return feed(spark, sf_dir).selectExpr(
        "item_id", "item_type", "parent_id", "created_at", "sentiment", "topic", "theme",
        "speaker", "company", "location",
        "CAST(reactions AS BIGINT) + comments + reposts AS engagement", "author_headline",
        "CASE WHEN lang = 'en' THEN text END AS text_en", "text AS original_text",
        "action_bucket", "concat('Do: ', action_bucket) AS recommended_action", "url", "source")


# ---- tables that enrichment looks things up in --------------------------------------------------

def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents rated by the labels table: good and not toxic is positive, the rest negative."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.when(good, "positive").otherwise("negative").alias("rating"), "text")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn_lexicon(rated(spark, sf_dir))


def language_model(spark: SparkSession, sf_dir: str):
    return learn_bayes(table(spark, sf_dir, "documents").select(
        "text", F.col("lang").alias("label")), LANGUAGES)


def label_terms(spark: SparkSession, sf_dir: str, labels: tuple[str, ...]) -> DataFrame:
    """Each benchmark passage lends its words to one label."""
    return (table(spark, sf_dir, "benchmark")
            .select(choose(F.col("item_id"), labels).alias("label"),
                    F.explode(terms(F.col("text"))).alias("term"))
            .distinct())


def label_weights(spark: SparkSession, sf_dir: str, labels: tuple[str, ...]):
    return list_weights(label_terms(spark, sf_dir, labels), labels)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark passage names many things: phrases of two to six of its words, every four
    words one, through the whole passage."""
    words = table(spark, sf_dir, "benchmark").select("item_id", terms(F.col("text")).alias("w"))
    numbered = words.filter("size(w) > 0").select("item_id", "w", F.explode(F.expr(
        "sequence(0L, CAST((size(w) - 1) div 4 AS BIGINT))")).alias("k"))
    phrase = F.expr("array_join(slice(w, CAST(4 * k + 1 AS INT), CAST(2 + k % 5 AS INT)), ' ')")
    return numbered.select(
        phrase.alias("phrase"), choose(F.col("item_id") + F.col("k"),
                                       ("speaker", "company", "location")).alias("kind"),
        F.concat(F.lit("Name "), F.col("item_id"), F.lit("."), F.col("k")).alias("name"))


def memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of the labelled documents that are not English."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    return (table(spark, sf_dir, "documents").filter(F.col("lang") != "en")
            .join(labelled, "doc_id", "left_semi")
            .select("lang", text_hash(F.col("text")).alias("text_hash"),
                    F.concat(F.lit("In English: "), "text").alias("text_en"))
            .distinct())


def enrichment(spark: SparkSession, sf_dir: str) -> Enrichment:
    return prepare_enrichment(
        lexicon(spark, sf_dir), label_weights(spark, sf_dir, TOPICS),
        label_weights(spark, sf_dir, THEMES), language_model(spark, sf_dir),
        gazetteer(spark, sf_dir), materialize(memory(spark, sf_dir), "memory"))
