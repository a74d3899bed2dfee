"""Registered queries, each over the whole tables of a data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feed as fx
from feedlens.functions.actions import parse_reply, suggest_action
from feedlens.functions.identity import surrogate_key
from feedlens.functions.text import clean_markup
from feedlens.functions.times import instant
from feedlens.operators.classify import (add_counts, bayes_from_counts, classify, count_terms,
                                         fill_language, learn_bayes)
from feedlens.operators.enrich import enrich
from feedlens.operators.entities import match_entities, prepare_gazetteer
from feedlens.operators.gold import gold_items
from feedlens.operators.infer import infer, infer_once
from feedlens.operators.normalize import keep_tracked, normalize
from feedlens.operators.places import location_moods, place_mood, top_locations
from feedlens.operators.quality import (counting_rejects, mask_text, quality_report,
                                        rejected_rows, unknown_buckets, with_post)
from feedlens.operators.sentiment import score_sentiment
from feedlens.operators.translate import pending_translations, translate
from feedlens.operators.upsert import dedup_batch, merge_feed, not_in
from feedlens.plans import metrics
from feedlens.plans.runs import (incoming_from_folder, incoming_from_payloads, run_all,
                                 run_bronze)
from feedlens.schema import (COUNT_COLS, LOCAL_ZONE, TOPICS, FeedConfig)
from feedlens.session import hadoop_path, materialize, scratch_path
from feedlens.sources.files import preview_json, read_drop, read_json, write_json
from feedlens.sources.payloads import (COMMENTS_PAYLOAD, METADATA_PAYLOAD, POSTS_PAYLOAD,
                                       flatten_comments, flatten_metadata, flatten_posts,
                                       payload_feed)
from feedlens.sources.store import FeedStore
from feedlens.streaming.ingest import run_stream

KEYWORDS = ("MIT License", "worthless", "disgusting", "C++ (notes)")
CONFIG = FeedConfig(event_start=fx.EVENT_START, lookback_from=fx.SPLIT)
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def on_gold(name: str, metric) -> None:
    QUERIES[name] = lambda spark, sf_dir: metric(fx.gold(spark, sf_dir))


# ---- read queries -------------------------------------------------------------------------------

on_gold("total_items", metrics.total_items)
on_gold("sentiment_mix", metrics.sentiment_mix)
on_gold("theme_by_sentiment", metrics.theme_by_sentiment)
on_gold("theme_by_sentiment_named", lambda g: metrics.theme_by_sentiment(g, keep_null=False))
on_gold("theme_counts", metrics.theme_counts)
on_gold("bucket_counts", metrics.bucket_counts)
on_gold("bucket_counts_all", lambda g: metrics.bucket_counts(g, keep_null=True))
on_gold("source_flag_count", lambda g: metrics.source_flag_count(g, "linkedin_api"))
on_gold("hourly_sentiment_utc", metrics.hourly_sentiment)
on_gold("hourly_sentiment_local", lambda g: metrics.hourly_sentiment(g, LOCAL_ZONE))
on_gold("hourly_running_utc", metrics.running_sentiment)
on_gold("resonance_by_theme", metrics.resonance)
on_gold("resonance_by_speaker", lambda g: metrics.resonance(g, "speaker", keep_null=False))
on_gold("top_theme", metrics.top_theme)
on_gold("mood_share", metrics.mood_share)
on_gold("sentiment_by_day", lambda g: metrics.sentiment_by_day(g, fx.EVENT_START))
on_gold("daily_summary", metrics.daily_summary)
on_gold("top_entities", metrics.top_entities)
on_gold("thread_rollup", metrics.thread_rollup)
on_gold("recent_items", metrics.recent_items)
on_gold("wall", metrics.wall)
on_gold("top_problems", metrics.top_problems)
on_gold("open_leads", metrics.open_leads)
on_gold("location_moods", location_moods)
on_gold("place_mood", place_mood)
on_gold("top_locations", top_locations)
on_gold("event_day_two", lambda g: metrics.sentiment_mix(
    metrics.on_event_day(g, 2, fx.EVENT_START)))


@query
def hourly_running_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: raw rows, normalised, one row per key, joined to labels, running totals."""
    feed = dedup_batch(normalize(raw_rows(spark, sf_dir), CONFIG, fx.AS_OF))
    return metrics.running_sentiment(gold_items(fx.silver(spark, sf_dir), feed), LOCAL_ZONE)


@query
def last_hour(spark, sf_dir):
    gold = fx.gold(spark, sf_dir)
    newest = gold.agg(F.max("created_at")).scalar()
    return metrics.last_hour(gold, newest).select("item_id", "created_at")


# ---- sources and normalising --------------------------------------------------------------------

def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a file would hold it: time as text; documents leave defaults to be filled."""
    is_doc = F.col("source") == "file"
    return fx.bronze(spark, sf_dir).withColumns({
        "created_at": F.col("created_at").cast("string"),
        "item_type": F.when(~is_doc, F.col("item_type")),
        "source": F.when(~is_doc, F.col("source")),
        "reactions": F.when(F.col("reactions") > 5, F.col("reactions"))})


@query
def feed_normalized(spark, sf_dir):
    return normalize(raw_rows(spark, sf_dir), CONFIG, fx.AS_OF)


@query
def surrogate_keys(spark, sf_dir):
    rows = raw_rows(spark, sf_dir).withColumn(
        "author", F.when(F.col("parent_id").isNull(), F.col("author")))
    return rows.select("item_id", surrogate_key(F.col("author"), F.col("text")).alias("key"))


@query
def keyword_filter(spark, sf_dir):
    return keep_tracked(fx.bronze(spark, sf_dir), KEYWORDS).select("item_id", "source")


@query
def markup_clean(spark, sf_dir):
    marked = F.concat(F.lit(" \\#1 {hashtag|\\#|Feed} "), "text",
                      F.lit(" by @[Ann Lee](urn:li:person:7) \\(ok\\) \n"))
    return fx.bronze(spark, sf_dir).select("item_id", clean_markup(marked).alias("text"))


def drop_folder(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed as files: documents as CSV with few columns, conversations as JSON lines."""
    folder = scratch_path(spark, "drop")
    rows = raw_rows(spark, sf_dir)
    talks, documents = rows.filter(F.col("source").isNotNull()), rows.filter("source IS NULL")
    write_json(talks, f"{folder}/json")
    documents.select("text", "item_id", "author", "created_at", *COUNT_COLS).write.options(
        header=True, quoteAll=True, escape='"', emptyValue="").csv(f"{folder}/csv")
    return folder + "/{json,csv}"


def dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed with what the files of ``drop_folder`` hold."""
    rows = raw_rows(spark, sf_dir)
    return rows.withColumns({name: F.when(F.col("source").isNotNull(), F.col(name))
                             for name in ("lang", "url", "author_headline")})


@query
def read_files(spark, sf_dir):
    return read_drop(spark, drop_folder(spark, sf_dir)).select(
        "item_id", "item_type", "parent_id", "author", "text", "created_at", *COUNT_COLS)


@query
def rejected_count(spark, sf_dir):
    """Raw rows with system prompts blanked out, which a normalising run drops."""
    rows = raw_rows(spark, sf_dir)
    blank = rows.withColumn("text", F.when(F.col("author_headline") == "system", F.lit(" \t"))
                            .otherwise(F.col("text")))
    return rejected_rows(blank)


@query
def reject_counts(spark, sf_dir):
    """The feed as JSON lines of which some are broken, have words for a count, no key or no text;
    the counts are taken while a batch is written."""
    kind = F.length("text") % 11
    line = F.to_json(F.struct(
        F.when(kind != 7, F.col("item_id")).alias("item_id"),
        F.when(F.col("author_headline") != "system", F.col("text")).otherwise(" ").alias("text"),
        F.when(kind == 5, F.lit("many")).otherwise(F.coalesce("comments", F.lit(0)).cast("string"))
        .alias("comments")))
    number = F.regexp_replace(line, '"comments":"([0-9-]+)"', '"comments":$1')
    folder = scratch_path(spark, "damaged")
    raw_rows(spark, sf_dir).select(F.when(kind == 3, F.concat(F.lit("{broken "), "item_id"))
                                   .otherwise(number)).write.text(folder)
    rows, seen = counting_rejects(read_json(spark, [folder], rejects=True))
    rows.write.parquet(scratch_path(spark, "taken"))
    return spark.createDataFrame(list(seen.get.items()), "cause STRING, rows BIGINT")


@query
def reply_buckets(spark, sf_dir):
    """Unknown buckets among replies."""
    bucket = F.when(F.length("text") % 3 == 0, F.lit("escalate")).when(
        F.length("text") % 3 == 1, F.lit("monitor"))
    reply = F.concat(F.lit("So: "), F.to_json(F.struct(bucket.alias("bucket"))), F.lit(" ok"))
    return unknown_buckets(fx.bronze(spark, sf_dir).select(reply.alias("reply")))


def landed(rows: DataFrame, schema) -> DataFrame:
    """Rows as landed JSON text, read back with the payload's schema."""
    body = F.to_json(F.struct(*rows.columns))
    return rows.select(F.inline(F.array(F.from_json(body, schema))))


def millis(name: str):
    return F.unix_millis(F.col(name))


def post_pages(spark, sf_dir) -> DataFrame:
    """One response per post, with a second element that has no id; no text for user posts."""
    p = fx.bronze(spark, sf_dir).filter("item_type = 'post'")
    text = F.when(F.col("author_headline") != "user", F.col("text"))
    is_doc = F.col("source") == "file"
    element = F.struct(F.col("item_id").alias("id"), "author", text.alias("commentary"),
                       F.when(is_doc, millis("created_at")).alias("publishedAt"),
                       millis("created_at").alias("createdAt"))
    return landed(p.select(F.array(element, element.withField("id", F.lit(None).cast("string"))).alias("elements")),
                  POSTS_PAYLOAD)


def comment_pages(spark, sf_dir) -> DataFrame:
    c = fx.bronze(spark, sf_dir).filter("item_type = 'comment'")
    element = F.struct(
        F.col("item_id").alias("id"),
        F.when(F.col("author_headline") == "user", F.col("item_id")).alias("commentUrn"),
        F.concat(F.lit("urn:li:organization:"), "author").alias("actor"),
        F.struct("text").alias("message"), F.struct(millis("created_at").alias("time"))
        .alias("created"), F.struct(F.col("reactions").alias("totalLikes")).alias("likesSummary"),
        F.struct(F.col("comments").alias("aggregatedTotalComments")).alias("commentsSummary"))
    return landed(c.select(F.col("parent_id").alias("post_id"), F.array(element)
                           .alias("elements")), COMMENTS_PAYLOAD)


def metadata_pages(spark, sf_dir) -> DataFrame:
    p = fx.bronze(spark, sf_dir).filter("item_type = 'post' AND source = 'file'")
    summaries = F.create_map(F.lit("LIKE"), F.struct(F.col("reactions").alias("count")),
                             F.lit("PRAISE"), F.struct(F.col("reposts").alias("count")))
    return landed(p.select(F.col("item_id").alias("post_id"),
                           summaries.alias("reactionSummaries"),
                           F.struct(F.col("comments").alias("count")).alias("commentSummary")),
                  METADATA_PAYLOAD)


@query
def payload_posts(spark, sf_dir):
    return flatten_posts(post_pages(spark, sf_dir), CONFIG)


@query
def payload_comments(spark, sf_dir):
    return flatten_comments(comment_pages(spark, sf_dir))


@query
def payload_reactions(spark, sf_dir):
    return flatten_metadata(metadata_pages(spark, sf_dir))


@query
def payload_items(spark, sf_dir):
    return payload_feed(post_pages(spark, sf_dir), comment_pages(spark, sf_dir),
                        metadata_pages(spark, sf_dir), CONFIG)


# ---- upsert and layers --------------------------------------------------------------------------

@query
def dedup_rows(spark, sf_dir):
    """The feed, the feed again, and the feed with other counts, as one batch."""
    rows = fx.bronze(spark, sf_dir)
    later = rows.withColumn("reactions", F.col("reactions") + F.col("reposts") - 3)
    return dedup_batch(rows.unionByName(rows).unionByName(later))


def stored(spark, sf_dir) -> DataFrame:
    """What was there before: the items created before the split."""
    return (fx.bronze(spark, sf_dir).filter(F.col("created_at") < instant(fx.SPLIT))
            .withColumn("ingestion_time", instant(fx.SPLIT)))


def delivered(spark, sf_dir) -> DataFrame:
    """The whole feed delivered again, with more reactions and an edited text."""
    return fx.bronze(spark, sf_dir).withColumns({
        "reactions": F.col("reactions") + 3, "text": F.concat(F.lit("edited: "), "text")})


@query
def upsert_merge(spark, sf_dir):
    return merge_feed(stored(spark, sf_dir), delivered(spark, sf_dir), fx.AS_OF)


@query
def new_items(spark, sf_dir):
    new = not_in(delivered(spark, sf_dir), stored(spark, sf_dir))
    return new.agg(F.count("*").alias("new_items"))


@query
def silver_pending(spark, sf_dir):
    done = fx.silver(spark, sf_dir).filter(F.col("created_at") < instant(fx.SPLIT))
    return not_in(fx.bronze(spark, sf_dir), done).select("item_id", "text")


@query
def gold_table(spark, sf_dir):
    """Counts exist for the stored items only; the others have no engagement yet."""
    return gold_items(fx.silver(spark, sf_dir), stored(spark, sf_dir))


@query
def store_upsert(spark, sf_dir):
    """Two batches through the stored Bronze table, the second delivered twice."""
    store = FeedStore(spark, scratch_path(spark, "store")).create()
    run_bronze(store, stored(spark, sf_dir).drop("ingestion_time"), 0, fx.SPLIT)
    for _ in range(2):
        run_bronze(store, delivered(spark, sf_dir), 1, fx.AS_OF)
    return store.bronze()


@query
def bronze_preview(spark, sf_dir):
    store = FeedStore(spark, scratch_path(spark, "store")).create()
    run_bronze(store, fx.bronze(spark, sf_dir), 0, fx.AS_OF)
    return store.preview("bronze")


@query
def silver_preview(spark, sf_dir):
    return metrics.newest(fx.silver(spark, sf_dir), 50).select("*", "entities.*").drop("entities")


@query
def gold_preview(spark, sf_dir):
    return metrics.newest(fx.gold(spark, sf_dir), 50)


@query
def json_preview(spark, sf_dir):
    folder = scratch_path(spark, "preview")
    write_json(raw_rows(spark, sf_dir), folder)
    return preview_json(spark, folder)


@query
def all_layers(spark, sf_dir):
    """Files to Gold in one go."""
    store = FeedStore(spark, scratch_path(spark, "run")).create()
    incoming = incoming_from_folder(store, drop_folder(spark, sf_dir), CONFIG, fx.AS_OF)
    run_all(store, incoming, fx.enrichment(spark, sf_dir), fx.AS_OF)
    return store.gold()


def arriving_files(spark, sf_dir, least: int) -> int:
    """In how many files of about 64 MB of text the feed arrives, ``least`` of a small one."""
    sizes = [fx.table(spark, sf_dir, name).agg(F.sum(F.octet_length("text"))).first()[0] or 0
             for name in ("documents", "conversations")]
    return max(least, -(-sum(sizes) // (64 << 20)))


def arrive(rows: DataFrame, folder: str, files: int) -> int:
    """Write rows as JSON lines to ``files`` files or more, by the tasks that have them, next to
    what is there; returns how many files came."""
    where, found = hadoop_path(rows.sparkSession, f"{folder}/*.json")
    before = len(where.globStatus(found) or [])
    most = max(1, -(-rows.count() // files))
    rows.write.mode("append").option("maxRecordsPerFile", most).json(folder)
    return len(where.globStatus(found)) - before


@query
def stream_upsert(spark, sf_dir):
    """The feed as arriving files, half of them per micro-batch, merged into the stored Bronze
    table."""
    base = scratch_path(spark, "stream")
    rows, files = raw_rows(spark, sf_dir), arriving_files(spark, sf_dir, 4)
    write_json(rows.repartition(files, "item_id"), f"{base}/drop")
    store = FeedStore(spark, f"{base}/store")
    run_stream(store, f"{base}/drop", CONFIG, fx.AS_OF, f"{base}/progress",
               files_per_batch=-(-files // 2)).awaitTermination()
    return store.bronze()


@query
def mixed_runs(spark, sf_dir):
    """One store: a batch of some files, a stream over all of them, and the batch once more."""
    base = scratch_path(spark, "mixed")
    rows, files = raw_rows(spark, sf_dir), arriving_files(spark, sf_dir, 4)
    write_json(rows.repartition(files, "item_id"), f"{base}/drop")
    store = FeedStore(spark, f"{base}/store").create()
    part = normalize(rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(3)) == 0), CONFIG, fx.AS_OF)
    run_bronze(store, part, store.claim("first"), fx.AS_OF)
    run_stream(store, f"{base}/drop", CONFIG, fx.AS_OF, f"{base}/progress",
               files_per_batch=-(-files // 2)).awaitTermination()
    run_bronze(store, part, store.claim("again"), fx.AS_OF)
    return store.bronze()


@query
def stream_all_layers(spark, sf_dir):
    """Some files as a stream that fills Bronze only, the others with enrichment, in more than
    one micro-batch; the second catches up."""
    base = scratch_path(spark, "stream")
    rows = dropped_rows(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(2)))
    store, using = FeedStore(spark, f"{base}/store"), fx.enrichment(spark, sf_dir)
    files = max(2, -(-arriving_files(spark, sf_dir, 2) // 2))
    for part, enrichment in ((0, None), (1, using)):
        came = arrive(rows.filter(F.col("part") == part).drop("part"), f"{base}/drop", files)
        run_stream(store, f"{base}/drop", CONFIG, fx.AS_OF, f"{base}/progress", enrichment,
                   files_per_batch=max(1, -(-came // 2))).awaitTermination()
    return store.gold()


def two_batch_store(spark, sf_dir) -> FeedStore:
    """A store after two batches through all layers."""
    store = FeedStore(spark, scratch_path(spark, "run")).create()
    rows, using = dropped_rows(spark, sf_dir), fx.enrichment(spark, sf_dir)
    half = F.pmod(F.xxhash64("item_id"), F.lit(2))
    for part in (0, 1):
        run_all(store, normalize(rows.filter(half == part), CONFIG, fx.AS_OF), using, fx.AS_OF)
    return store


@query
def summary_metrics(spark, sf_dir):
    """Read queries answered from the summary that a store keeps, after two batches."""
    table = two_batch_store(spark, sf_dir).summary()
    text = "string"
    moods = metrics.theme_by_sentiment(table).select(
        F.lit("theme").alias("metric"), F.col("theme").alias("key"), "sentiment", "items")
    hours = metrics.hourly_sentiment(table, LOCAL_ZONE).select(
        F.lit("hour"), F.col("hour").cast(text), "sentiment", "items")
    running = metrics.running_sentiment(table).select(
        F.lit("running"), F.col("hour").cast(text), "sentiment", "cumulative_items")
    days = metrics.daily_summary(table).select(
        F.lit("day"), F.col("day").cast(text), F.col("max_engagement").cast(text), "engagement")
    named = metrics.top_entities(table).select(
        F.concat(F.lit("top "), "kind"), "name", F.col("rank").cast(text), "items")
    total = metrics.total_items(table).select(
        F.lit("total"), F.lit(None).cast(text), F.lit(None).cast(text), "total_items")
    return moods.union(hours).union(running).union(days).union(named).union(total)


@query
def newest_stored(spark, sf_dir):
    """The newest rows of a stored Gold table, found by day."""
    return two_batch_store(spark, sf_dir).newest_gold(50, metrics.RECENT_COLS)


@query
def two_batches_all_layers(spark, sf_dir):
    """Two batches through all layers."""
    return two_batch_store(spark, sf_dir).gold()


@query
def payload_all_layers(spark, sf_dir):
    """Landed responses through all layers."""
    store = FeedStore(spark, scratch_path(spark, "run")).create()
    incoming = incoming_from_payloads(post_pages(spark, sf_dir), comment_pages(spark, sf_dir),
                                      metadata_pages(spark, sf_dir), CONFIG)
    run_all(store, incoming, fx.enrichment(spark, sf_dir), fx.AS_OF)
    return store.gold()


@query
def empty_drop(spark, sf_dir):
    """A drop folder with foreign files only gives no rows, and a run on it no items."""
    folder = scratch_path(spark, "foreign")
    raw_rows(spark, sf_dir).select("text").write.text(folder)
    store = FeedStore(spark, scratch_path(spark, "run")).create()
    rows = read_drop(spark, folder)
    new = run_bronze(store, normalize(rows, CONFIG, fx.AS_OF), 0, fx.AS_OF)
    return rows.agg(F.count("*").alias("rows"), F.lit(new).cast("bigint").alias("new_items"),
                    F.lit(len(rows.columns)).cast("bigint").alias("columns"))


# ---- enrichment ---------------------------------------------------------------------------------

@query
def lexicon_learn(spark, sf_dir):
    return fx.lexicon(spark, sf_dir)


@query
def sentiment_score(spark, sf_dir):
    return score_sentiment(fx.bronze(spark, sf_dir), fx.lexicon(spark, sf_dir))


@query
def classify_terms(spark, sf_dir):
    return classify(fx.bronze(spark, sf_dir), fx.label_weights(spark, sf_dir, TOPICS),
                    "general chatter", need_hit=True)


@query
def classify_bayes(spark, sf_dir):
    return classify(fx.bronze(spark, sf_dir), fx.language_model(spark, sf_dir))


@query
def bayes_incremental(spark, sf_dir):
    """The language model from two batches of documents, each counted by itself."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    parts = [materialize(count_terms(docs.filter(F.pmod("doc_id", F.lit(2)) == i), fx.LANGUAGES),
                         "counts").table for i in (0, 1)]
    model = bayes_from_counts(add_counts(*parts), fx.LANGUAGES)
    return classify(fx.bronze(spark, sf_dir), model)


@query
def classify_bayes_held_out(spark, sf_dir):
    """Learned on the documents of even id, applied to those of odd id."""
    docs = fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc:"), "doc_id").alias("item_id"), "text", "lang")
    even, odd = (docs.filter(F.col("doc_id") % 2 == i) for i in (0, 1))
    model = learn_bayes(even.withColumn("label", F.col("lang")), fx.LANGUAGES)
    return classify(odd, model).join(odd.select("item_id", "lang"), "item_id")


@query
def detect_language(spark, sf_dir):
    return fill_language(fx.bronze(spark, sf_dir), fx.language_model(spark, sf_dir)).select(
        "item_id", "lang", "text")


@query
def entity_match(spark, sf_dir):
    return match_entities(fx.bronze(spark, sf_dir),
                          prepare_gazetteer(fx.gazetteer(spark, sf_dir)))


@query
def translate_memory(spark, sf_dir):
    return translate(fx.bronze(spark, sf_dir), fx.memory(spark, sf_dir)).select(
        "item_id", "lang", "text_en")


@query
def translate_pending(spark, sf_dir):
    return pending_translations(fx.bronze(spark, sf_dir), fx.memory(spark, sf_dir))


@query
def reply_parse(spark, sf_dir):
    """Replies with words around the JSON, unknown buckets, and none at all for mixed items."""
    body = F.to_json(F.struct(F.coalesce("action_bucket", F.lit("escalate")).alias("bucket"),
                              F.concat(F.lit("Answer "), "author").alias("action")))
    reply = F.when(F.col("sentiment") == "mixed", "I cannot tell.").otherwise(
        F.concat(F.lit("Sure:\n"), body, F.lit("\nDone.")))
    bucket, action = parse_reply(reply)
    return fx.feed(spark, sf_dir).select("item_id", bucket.alias("bucket"),
                                         action.alias("action"))


@query
def action_rules(spark, sf_dir):
    bucket, action = suggest_action(F.col("topic"), F.col("sentiment"))
    return fx.feed(spark, sf_dir).select("item_id", bucket.alias("bucket"),
                                         action.alias("action"))


@query
def infer_batch(spark, sf_dir):
    def load():
        """A stand-in for a model: answers with the length of the prompt."""
        return lambda prompts: ('{"bucket": "monitor", "action": "Read '
                                + prompts.str.len().astype("string") + ' characters"}')

    replies = infer(fx.bronze(spark, sf_dir).select("item_id", "text"), load, "Post: ")
    bucket, action = parse_reply(F.col("reply"))
    return replies.select("item_id", bucket.alias("bucket"), action.alias("action"))


@query
def infer_once_batches(spark, sf_dir):
    """Replies of a stand-in model in two runs, each distinct prompt asked once; it fails on batches
    with a very long text, and answers that text when it is asked alone."""
    def load():
        def reply(prompts):
            if len(prompts) > 1 and prompts.str.len().max() > 20_000:
                raise ValueError("too long for a batch")
            return ('{"bucket": "monitor", "action": "Read '
                    + prompts.str.len().astype("string") + ' characters"}')
        return reply

    path, rows = scratch_path(spark, "answers"), fx.bronze(spark, sf_dir).select("item_id", "text")
    infer_once(rows.filter(F.col("item_id").startswith("conv:")), load, path, "Post: ").write \
        .format("noop").mode("overwrite").save()
    bucket, action = parse_reply(F.col("reply"))
    return infer_once(rows, load, path, "Post: ").select(
        "item_id", bucket.alias("bucket"), action.alias("action"))


@query
def enrich_all(spark, sf_dir):
    rows = enrich(fx.bronze(spark, sf_dir), fx.enrichment(spark, sf_dir))
    return rows.select("item_id", "lang", "sentiment", "topic", "theme", "entities.speaker",
                       "entities.company", "entities.location", "text_en", "action_bucket",
                       "recommended_action", "original_text")


# ---- quality ------------------------------------------------------------------------------------

@query
def quality_check(spark, sf_dir):
    """Posts before the split are missing, topics are renamed and documents come twice."""
    rows = fx.feed(spark, sf_dir)
    kept = rows.filter((F.col("item_type") == "comment")
                       | (F.col("created_at") >= instant(fx.SPLIT)))
    twice = rows.filter("source = 'file'").withColumn("topic", F.upper("topic"))
    return quality_report(kept.unionByName(twice))


@query
def mask_members(spark, sf_dir):
    masked = mask_text(fx.bronze(spark, sf_dir), ["text"], F.col("source") == "linkedin_api",
                       r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "<mail>")
    return masked.select("item_id", "text")


@query
def comments_with_post(spark, sf_dir):
    return with_post(fx.bronze(spark, sf_dir), ["author", "text"]).select(
        "item_id", "parent_id", "post_author", "post_text")
