import json

from conftest import at, table

from feedlens.schema import BRONZE_COLS, FeedConfig
from feedlens.sources.payloads import (COMMENTS_PAYLOAD, METADATA_PAYLOAD, POSTS_PAYLOAD,
                                       payload_feed)

T0 = 1_790_000_000_000
OLD = 1_700_000_000_000
CONFIG = FeedConfig(lookback_from=at("2026-01-01"), lookback_to=at("2027-01-01"))


def landed(spark, folder, name, schema, *responses):
    path = folder / f"{name}.json"
    path.write_text("\n".join(json.dumps(r) for r in responses))
    return spark.read.schema(schema).json(str(path))


def feed_of(spark, folder):
    posts = landed(spark, folder, "posts", POSTS_PAYLOAD, {"elements": [
        {"id": "p1", "author": "urn:li:person:1", "commentary": "{hashtag|\\#|AI} hi",
         "publishedAt": T0, "createdAt": OLD},
        {"id": "p2", "author": "urn:li:organization:2", "commentary": " ", "createdAt": T0},
        {"id": "p3", "commentary": "old", "createdAt": OLD},
        {"commentary": "no id", "createdAt": T0},
        {"id": "p4", "commentary": "no time", "createdAt": 0}]},
        {"elements": [{"id": "p1", "author": "urn:li:person:1", "commentary": "#AI hi",
                       "publishedAt": T0}]},
        {"elements": []}, {})
    comments = landed(
        spark, folder, "comments", COMMENTS_PAYLOAD,
        {"post_id": "p1", "elements": [
            {"id": "7", "actor": "urn:li:person:9", "message": {"text": "one"},
             "created": {"time": T0}, "likesSummary": {"totalLikes": 3},
             "commentsSummary": {"aggregatedTotalComments": 2}},
            {"id": "8", "commentUrn": "urn:c:8", "message": {"text": "two"}},
            {"id": "9", "message": {"text": "  "}}, {"id": "10"}]},
        {"post_id": "p2", "elements": [{"id": "1", "message": {"text": "on a textless post"}}]},
        {"post_id": "p3", "elements": [{"id": "1", "message": {"text": "on an old post"}}]})
    metadata = landed(
        spark, folder, "metadata", METADATA_PAYLOAD,
        {"post_id": "p1", "reactionSummaries": {"LIKE": {"count": 4}, "PRAISE": {"count": 1},
                                                "EMPTY": {}}, "commentSummary": {"count": 2}},
        {"post_id": "p2", "reactionSummaries": {"LIKE": {"count": 4}}})
    return payload_feed(posts, comments, metadata, CONFIG)


def test_posts_and_comments_become_one_feed(spark, tmp_path):
    rows = feed_of(spark, tmp_path)
    assert rows.columns == list(BRONZE_COLS)
    assert table(rows, "item_id", "item_type", "parent_id", "text", "reactions", "comments") == [
        ("p1", "post", None, "#AI hi", 5, 2),
        ("p1#comment:7", "comment", "p1", "one", 3, 2),
        ("p2#comment:1", "comment", "p2", "on a textless post", 0, 0),
        ("p4", "post", None, "no time", 0, 0),
        ("urn:c:8", "comment", "p1", "two", 0, 0)]
    by_id = {r["item_id"]: r for r in rows.collect()}
    assert by_id["p1#comment:7"]["url"].endswith("/p1/")
    assert by_id["p1"]["created_at"] == at("2026-09-21T14:13:20")
    assert len(by_id["p1"]["author"]) == 16 and by_id["p4"]["author"] is None
    assert {r["source"] for r in by_id.values()} == {"linkedin_api"}
    assert by_id["p4"]["lang"] is None and by_id["p4"]["created_at"] is None


def test_large_reaction_sums_and_blank_comment_ids(spark):
    from pyspark.sql import functions as F

    from feedlens.sources.payloads import flatten_comments, reaction_total
    big = spark.sql("SELECT map('A', named_struct('count', 2147483647), "
                    "'B', named_struct('count', 5)) AS m")
    assert big.select(reaction_total(F.col("m"))).first()[0] == 2147483647
    element = "named_struct('id', '', 'commentUrn', '', 'actor', '{0}', 'message', named_struct('text', '{0}'), " \
              "'created', named_struct('time', 0L), 'likesSummary', named_struct('totalLikes', 1), " \
              "'commentsSummary', named_struct('aggregatedTotalComments', 0))"
    pages = spark.sql("SELECT 'p' AS post_id, array(" + ", ".join(
        element.format(t) for t in ("one", "two")) + ") AS elements")
    keys = {r["item_id"] for r in flatten_comments(pages).collect()}
    assert len(keys) == 2 and all(k.startswith("p#comment:") for k in keys)
