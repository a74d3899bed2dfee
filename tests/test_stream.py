import json
import os

from conftest import at, table
from pyspark.sql import functions as F

from feedlens.operators.classify import learn_bayes, list_weights
from feedlens.operators.enrich import prepare_enrichment
from feedlens.operators.normalize import normalize
from feedlens.plans.runs import run_all
from feedlens.schema import FeedConfig
from feedlens.sources.files import read_drop, read_paths
from feedlens.sources.store import FeedStore
from feedlens.streaming.ingest import run_stream

NOW = at("2026-10-01")
CONFIG = FeedConfig()


def put(folder, name, *rows):
    path = folder / name
    if name.endswith(".csv"):
        path.write_text("text,item_id,reactions\n" + "\n".join(
            f'"{r["text"]}",{r["item_id"]},{r["reactions"]}' for r in rows))
    else:
        path.write_text("\n".join(json.dumps(r) for r in rows))
    arrived = 1_790_000_000 + int(name[0])
    os.utime(path, (arrived, arrived))


def row(key, reactions, text="t"):
    return {"item_id": key, "text": text, "reactions": reactions, "source": "file"}


def test_files_one_at_a_time_equal_one_batch(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    store = FeedStore(spark, str(tmp_path / "stream"))

    def take_in():
        run_stream(store, str(drop), CONFIG, NOW, str(tmp_path / "progress"),
                   files_per_batch=1).awaitTermination()

    put(drop, "1.json", row("a", 1), row("b", 1))
    put(drop, "2.csv", row("b", 5), row("c", 2, "line\nbreak"))
    take_in()
    first_files = set(store.items().inputFiles())
    put(drop, "3.jsonl", row("a", 9), row("d", 0))
    (drop / "4.txt").write_text("ignored")
    take_in()
    take_in()
    assert first_files < set(store.items().inputFiles())

    whole = FeedStore(spark, str(tmp_path / "batch")).create()
    whole.upsert(normalize(read_drop(spark, str(drop)), CONFIG, NOW), 0, NOW)
    columns = ("item_id", "reactions", "text", "created_at", "source")
    assert table(store.bronze(), *columns) == table(whole.bronze(), *columns)
    assert [r[0] for r in table(store.bronze(), "item_id")] == ["a", "b", "c", "d"]


def small_enrichment(spark):
    lists = spark.createDataFrame([("logistics", "queue")], "label STRING, term STRING")
    languages = learn_bayes(spark.createDataFrame([("en", "the queue")],
                                                  "label STRING, text STRING"), ("en",))
    return prepare_enrichment(
        spark.createDataFrame([("bad", -500)], "term STRING, weight BIGINT"),
        list_weights(lists, ("logistics",)), list_weights(lists, ("logistics",)), languages,
        spark.createDataFrame([("acme", "company", "Acme")],
                              "phrase STRING, kind STRING, name STRING"),
        spark.createDataFrame([], "lang STRING, text_hash STRING, text_en STRING"))


def test_stream_through_all_layers(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    store = FeedStore(spark, str(tmp_path / "store"))
    using = small_enrichment(spark)
    put(drop, "1.json", row("a", 1, "bad queue at Acme"))
    put(drop, "2.json", row("b", 2), row("a", 7, "edited"))
    run_stream(store, str(drop), CONFIG, NOW, str(tmp_path / "progress"), using,
               files_per_batch=1).awaitTermination()
    columns = ("item_id", "engagement", "sentiment", "topic", "company", "action_bucket",
               "original_text")
    want = [("a", 7, "negative", "logistics", "Acme", "fix_ops", "bad queue at Acme"),
            ("b", 2, "neutral", "general chatter", None, "monitor", "t")]
    assert table(store.gold(), *columns) == want
    # The last micro-batch again, as after a failure before its commit.
    again = normalize(read_paths(spark, [str(drop / "2.json")]), CONFIG, NOW)
    run = store.read("runs").filter("batch = 1").first()["run"]
    assert run_all(store, again, using, NOW, run) == 1
    assert table(store.gold(), *columns) == want


def test_batch_and_streams_share_a_store(spark, feed, tmp_path):
    """A batch run, a stream, the stream with a lost checkpoint, and a batch run again."""
    drop = tmp_path / "drop"
    drop.mkdir()
    store = FeedStore(spark, str(tmp_path / "store")).create()
    using = small_enrichment(spark)
    first = feed(row("a", 1), row("b", 1))

    def stream(progress):
        run_stream(store, str(drop), CONFIG, NOW, str(tmp_path / progress), using).awaitTermination()

    assert run_all(store, first, using, NOW) == 2
    put(drop, "1.json", row("z", 3))
    stream("progress")
    assert [r[0] for r in table(store.gold(), "item_id")] == ["a", "b", "z"]
    put(drop, "2.json", row("y", 4), row("a", 8))
    stream("other progress")
    assert run_all(store, first, using, NOW) == 0
    columns = ("item_id", "engagement")
    assert table(store.gold(), *columns) == [("a", 1), ("b", 1), ("y", 4), ("z", 3)]
    assert table(store.bronze(), "item_id", "reactions") == table(store.gold(), *columns)
    assert len(store.batches("runs")) == len(store.batches("items")) == 4


def test_items_of_a_bronze_only_stream_are_enriched_later(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    store = FeedStore(spark, str(tmp_path / "store"))
    progress = str(tmp_path / "progress")
    put(drop, "1.json", row("a", 1), row("b", 1))
    run_stream(store, str(drop), CONFIG, NOW, progress).awaitTermination()
    put(drop, "2.json", row("c", 1))
    run_stream(store, str(drop), CONFIG, NOW, progress, small_enrichment(spark)).awaitTermination()
    assert [r[0] for r in table(store.silver(), "item_id")] == ["a", "b", "c"]
    assert [r[0] for r in table(store.gold(), "item_id")] == ["a", "b", "c"]
    assert not store.without_silver(9)


def test_files_arrive_without_moving_rows(spark, tmp_path):
    from checks import queries
    rows = spark.range(100).selectExpr("id", "concat('text ', id) AS text").coalesce(1)
    folder = str(tmp_path / "drop")
    assert queries.arrive(rows, folder, 4) == 4
    assert queries.arrive(rows.limit(0), folder, 4) <= 1
    assert queries.arrive(rows, folder, 3) == 3
    assert spark.read.json(folder).count() == 200


def test_files_that_arrive_grow_in_number_not_in_size(spark, tmp_path):
    from checks.queries import arriving_files
    for name, key in (("documents", "doc_id"), ("conversations", "conv_id")):
        spark.range(0, 160, 1, 4).select(F.col("id").alias(key), F.expr(
            "repeat('abcdefgh', 131072)").alias("text")).write.parquet(f"{tmp_path}/{name}.parquet")
    assert arriving_files(spark, str(tmp_path), 4) == 5
    assert arriving_files(spark, "/root/testdata/sf0.001", 4) == 4
