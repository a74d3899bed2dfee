import pytest
from conftest import table
from pyspark.sql import functions as F

from feedlens.functions.actions import parse_reply, suggest_action
from feedlens.operators.classify import classify, fill_language, learn_bayes, list_weights
from feedlens.operators.enrich import enrich, prepare_enrichment
from feedlens.operators.entities import match_entities, prepare_gazetteer
from feedlens.operators.infer import infer
from feedlens.operators.scoring import combine, frequent_weights, item_terms, score_items
from feedlens.operators.sentiment import learn_lexicon, lexicon_weights, score_sentiment
from feedlens.operators.translate import pending_translations, text_hash, translate
from feedlens.schema import SILVER_SCHEMA
from feedlens.session import lookup_join, materialize


def items(spark, *texts, lang=None):
    rows = [(f"i{k}", text, lang) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id STRING, text STRING, lang STRING")


LEXICON = [("good", 700), ("great", 900), ("bad", -700), ("awful", -900)]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "term STRING, weight BIGINT")


def test_sentiment_rules(spark, lexicon):
    scored = score_sentiment(items(spark, "Good, good!", "a bad day", "good but bad", "good good "
                                   "good bad", "nothing", None, ""), lexicon)
    assert table(scored) == [
        ("i0", 1400, 0, "positive"), ("i1", 0, 700, "negative"), ("i2", 700, 700, "mixed"),
        ("i3", 2100, 700, "positive"), ("i4", 0, 0, "neutral"), ("i5", 0, 0, "neutral"),
        ("i6", 0, 0, "neutral")]


def test_learned_lexicon(spark):
    rated = spark.createDataFrame(
        [("positive", "good good plain")] * 5 + [("negative", "bad plain plain")] * 5
        + [("positive", "rare")], "rating STRING, text STRING")
    words = dict(table(learn_lexicon(rated, min_support=5)))
    assert words["good"] > 0 > words["bad"] and "rare" not in words
    assert words["plain"] < 0


def test_term_lists(spark):
    lists = spark.createDataFrame(
        [("b", "two"), ("b", "both"), ("a", "one"), ("a", "both"), ("a", "one")],
        "label STRING, term STRING")
    weights = list_weights(lists, ("b", "a"))
    got = classify(items(spark, "one", "two two one", "both", "none"), weights, "rest",
                   need_hit=True)
    assert table(got) == [("i0", "a"), ("i1", "b"), ("i2", "b"), ("i3", "rest")]


def test_bayes_against_hand_count(spark):
    labelled = spark.createDataFrame([("x", "u u v"), ("y", "v w"), ("y", "w")],
                                     "label STRING, text STRING")
    model = learn_bayes(labelled, ("x", "y"))
    import math
    weights = {r["term"]: r["weights"] for r in model.table.collect()}
    assert weights["u"] == [round(1e6 * math.log(3 / 6)), round(1e6 * math.log(1 / 6))]
    assert weights[""] == [round(1e6 * math.log(2 / 5)), round(1e6 * math.log(3 / 5))]
    assert table(classify(items(spark, "u", "w", "unknown", ""), model)) == [
        ("i0", "x"), ("i1", "y"), ("i2", "y"), ("i3", "y")]
    known = items(spark, "u", lang="y").union(items(spark, "u").withColumn("item_id", F.lit("n")))
    assert table(fill_language(known, model), "item_id", "lang") == [("i0", "y"), ("n", "x")]


def test_large_weights_take_the_shuffle_and_agree(spark, lexicon):
    rows = items(spark, "good bad good", "awful " * 50, "x", None)
    combined = combine({"tone": lexicon_weights(lexicon)})
    small, large = score_items(rows, combined), score_items(rows, combined, limit=0)
    assert table(small) == table(large)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_large_weights_move_only_the_terms_that_are_not_frequent(spark):
    """Some weights fit, and only the rows of the other terms go through a shuffle by term."""
    lists = [("ab"[i % 2], f"t{i:03}") for i in range(200)] + [("a", "often"), ("b", "twice")]
    weights = combine({"score": list_weights(
        spark.createDataFrame(lists, "label STRING, term STRING"), ("a", "b"))})
    rows = items(spark, *[f"often often unlisted twice t{i:03} t{i:03} new{i}" for i in range(200)],
                 None, "")
    expected = table(score_items(rows, weights))
    assert expected[0] == ("i0", [4, 1])
    for limit in (60, 400, 3000):
        large = score_items(rows, weights, limit=limit)
        assert table(large) == expected
        near = frequent_weights(item_terms(rows), weights, limit)
        if limit == 60:
            assert near is None or near.count() < 4
        else:
            assert {"often", "unlisted", "twice"} <= {r["term"] for r in near.collect()}
            moved = item_terms(rows).join(near, "term", "left_anti").count()
            assert moved <= 600 < item_terms(rows).count() - 600
            plan = large._jdf.queryExecution().optimizedPlan().toString()
            assert "LeftAnti" in plan and "broadcast" in plan


GAZETTEER = [("World Trade Center", "location", "WTC"), ("world trade", "location", "Trade"),
             ("acme", "company", "Acme"), ("Acme", "company", "Acme Ltd"),
             ("Ann Lee", "speaker", "Ann Lee"), ("bob", "speaker", "Bob")]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_entities_earliest_then_longest_then_smallest(spark, limit):
    gazetteer = prepare_gazetteer(
        spark.createDataFrame(GAZETTEER, "phrase STRING, kind STRING, name STRING"))
    rows = items(spark, "Bob met ann lee at the World-Trade center of ACME", "trade center",
                 "world trade", None, "bobs")
    assert table(match_entities(rows, gazetteer, limit=limit)) == [
        ("i0", "Bob", "Acme", "WTC"), ("i2", None, None, "Trade")]


def test_names_of_any_script_and_length(spark):
    names = [("3M", "company"), ("22@", "location"), ("Łódź", "location"), ("Москва", "location"),
             ("Bank of New York Mellon", "company"), ("Bank", "company"), ("!!", "speaker")]
    gazetteer = prepare_gazetteer(spark.createDataFrame(
        [(n, k, n) for n, k in names], "phrase STRING, kind STRING, name STRING"))
    assert (gazetteer.longest, gazetteer.rejected) == (5, 1)
    rows = items(spark, "I'm here, m", "at 3M in 22@", "w Łódź", "в москва", "the bank OF new york "
                 "mellon", "L\u0301odz")
    assert table(match_entities(rows, gazetteer)) == [
        ("i1", None, "3M", "22@"), ("i2", None, None, "Łódź"), ("i3", None, None, "Москва"),
        ("i4", None, "Bank of New York Mellon", None)]


def test_lexicon_keeps_every_term_by_default(spark):
    rated = spark.createDataFrame([("positive", "a b"), ("negative", "c")],
                                  "rating STRING, text STRING")
    assert {r[0] for r in table(learn_lexicon(rated))} == {"a", "b", "c"}


def test_two_translations_of_one_text_do_not_double_an_item(spark):
    rows = items(spark, "hola", lang="es")
    memory = spark.createDataFrame([("es", "hola", "hi"), ("es", "hola", "hello")],
                                   "lang STRING, text STRING, text_en STRING").select(
        "lang", text_hash(F.col("text")).alias("text_hash"), "text_en")
    assert table(translate(rows, memory), "item_id", "text_en") == [("i0", "hello")]


def test_a_filter_on_the_reply_asks_the_model_once(spark):
    from feedlens.functions.actions import parse_reply
    from feedlens.operators.infer import infer

    replies = infer(items(spark, "a", "b"), lambda: lambda prompts: prompts)
    bucket, _ = parse_reply(F.col("reply"))
    kept = replies.withColumn("bucket", bucket).filter("bucket IS NULL")
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_translation_memory(spark, limit):
    rows = (items(spark, "hello", "hola", lang="en").withColumn(
        "lang", F.when(F.col("item_id") == "i1", "es").otherwise("en"))
        .union(spark.createDataFrame([("i2", "hola", "ca"), ("i3", "adeu", "ca"),
                                      ("i4", "adeu", "ca"), ("i5", "none", None)],
                                     "item_id STRING, text STRING, lang STRING")))
    memory = spark.createDataFrame([("es", "hola", "hello!"), ("en", "hello", "wrong")],
                                   "lang STRING, text STRING, text_en STRING").select(
        "lang", text_hash(F.col("text")).alias("text_hash"), "text_en")
    assert table(translate(rows, memory, limit), "item_id", "text_en") == [
        ("i0", "hello"), ("i1", "hello!"), ("i2", None), ("i3", None), ("i4", None), ("i5", None)]
    assert table(pending_translations(rows, memory), "lang", "text", "items") == [
        ("ca", "adeu", 2), ("ca", "hola", 1), (None, "none", 1)]


def test_a_large_memory_moves_only_items_that_it_translates(spark):
    """English items and those without a translation stay in their tasks."""
    rows = items(spark, *[f"text {i}" for i in range(30)]).withColumn(
        "lang", F.when(F.col("text") < "text 2", "en").when(F.col("text") < "text 28", "es"))
    known = {"text 22": "long " * 200, "text 25": "longer " * 200}
    memory = spark.createDataFrame([("es", *pair) for pair in known.items()],
                                   "lang STRING, text STRING, text_en STRING").select(
        "lang", text_hash(F.col("text")).alias("text_hash"), "text_en")
    done = translate(rows, memory, 400)
    assert table(done) == table(translate(rows, memory)) and done.count() == 30
    assert dict(table(done.filter("lang = 'es' AND text_en IS NOT NULL"), "text", "text_en")) == known
    text = done._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in text and "Join LeftSemi" in text and "Join LeftAnti" in text


def test_reply_parsing(spark):
    replies = ['Sure: {"bucket": "content", "action": "Send slides"} ok',
               '{"bucket": "panic", "action": "Run"}', "no json", "{broken", None,
               '{"bucket": "monitor",\n "action": null}']
    rows = spark.createDataFrame([(str(i), r) for i, r in enumerate(replies)],
                                 "item_id STRING, reply STRING")
    bucket, action = parse_reply(F.col("reply"))
    assert table(rows.select("item_id", bucket.alias("b"), action.alias("a"))) == [
        ("0", "content", "Send slides"), ("1", None, "Run"), ("2", None, None),
        ("3", None, None), ("4", None, None), ("5", "monitor", None)]


def test_action_rules(spark):
    rows = spark.createDataFrame(
        [("logistics", "negative"), ("logistics", "positive"), ("sponsor & lead signal", "mixed"),
         ("general chatter", "neutral"), (None, None)], "topic STRING, sentiment STRING")
    bucket, _ = suggest_action(F.col("topic"), F.col("sentiment"))
    assert [r[0] for r in rows.select(bucket).collect()] == [
        "fix_ops", "amplify", "follow_up", "monitor", "monitor"]


def test_enrich_all(spark, lexicon, feed):
    def weights(labels, *pairs):
        return list_weights(spark.createDataFrame(list(pairs), "label STRING, term STRING"),
                            labels)

    languages = learn_bayes(spark.createDataFrame(
        [("en", "good the queue"), ("es", "la cola mala")], "label STRING, text STRING"),
        ("en", "es"))
    memory = spark.createDataFrame([("es", "la cola", "the queue")],
                                   "lang STRING, text STRING, text_en STRING").select(
        "lang", text_hash(F.col("text")).alias("text_hash"), "text_en")
    tables = dict(lexicon=lexicon, topics=weights(("session praise", "logistics"),
                                                  ("logistics", "queue"), ("logistics", "cola")),
                  themes=weights(("agents", "other"), ("agents", "bots")), languages=languages,
                  gazetteer=spark.createDataFrame(GAZETTEER,
                                                  "phrase STRING, kind STRING, name STRING"),
                  memory=memory)
    rows = feed({"item_id": "a", "text": "the bad queue of Acme bots"},
                {"item_id": "b", "text": "la cola"}, {"item_id": "c", "text": "the", "lang": "en"})
    done = enrich(rows, prepare_enrichment(**tables))
    assert [(f.name, f.dataType) for f in done.schema] == [
        (f.name, f.dataType) for f in SILVER_SCHEMA]
    assert table(done, "item_id", "lang", "sentiment", "topic", "theme", "entities.company",
                 "text_en", "action_bucket") == [
        ("a", "en", "negative", "logistics", "agents", "Acme", "the bad queue of Acme bots",
         "fix_ops"),
        ("b", "es", "neutral", "logistics", "other", None, "the queue", "monitor"),
        ("c", "en", "neutral", "general chatter", "other", None, "the", "monitor")]

    def shouting():
        return lambda prompts: ('{"bucket": "content", "action": "' + prompts.str.upper()
                                + '"}')

    asked = enrich(rows, prepare_enrichment(
        **tables, reply=lambda df: infer(df, shouting, "do: ", partitions=2)))
    assert table(asked, "item_id", "action_bucket", "recommended_action")[2] == (
        "c", "content", "DO: THE")


def test_hot_key_is_cut_when_the_table_is_large(spark):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        rows = spark.range(0, 90000, 1, 12).select(
            key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        lookup = materialize(spark.range(90000).select(
            F.col("id").alias("k"), (F.col("id") * 2).alias("value")), "lookup").table
        joined = lookup_join(rows, lookup, ["k"], "left", limit=0)
        out = joined.agg(F.count("*"), F.sum("value"), F.max("payload"))
        assert out.collect()[0][0] == 90000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def crowded(spark, feed):
    """Random texts over few words, many overlapping phrases, and an enrichment for them."""
    import random
    pick = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    phrases = [(" ".join(pick.choices(words, k=pick.randrange(1, 6))),
                pick.choice(["speaker", "company", "location"]), f"N{i}") for i in range(150)]
    phrases += [(" ".join(words * 4)[:140].rsplit(" ", 1)[0], "company", "long")]
    rows = feed(*[{"item_id": f"i{i}", "text": " ".join(pick.choices(words, k=pick.randrange(40)))}
                  for i in range(120)], {"item_id": "long", "text": " ".join(words * 5)},
                {"item_id": "null", "text": None})

    def weights(labels):
        return list_weights(spark.createDataFrame(
            [(pick.choice(labels), word) for word in words for _ in range(2)],
            "label STRING, term STRING"), labels)

    using = prepare_enrichment(
        spark.createDataFrame([(w, pick.randrange(-500, 500)) for w in words],
                              "term STRING, weight BIGINT"), weights(("logistics", "networking")),
        weights(("agents", "other")), learn_bayes(spark.createDataFrame(
            [("en", "w1 w2 w3"), ("es", "w4 w5 w6")], "label STRING, text STRING"), ("en", "es")),
        spark.createDataFrame(phrases, "phrase STRING, kind STRING, name STRING"),
        spark.createDataFrame([], "lang STRING, text_hash STRING, text_en STRING"))
    return rows, using, phrases


def test_one_pass_equals_separate_look_ups(crowded):
    rows, using, _ = crowded
    assert table(enrich(rows, using)) == table(enrich(rows, using, limit=0))


def test_phrases_against_brute_force(crowded):
    rows, using, phrases = crowded
    found = {r["item_id"]: r for r in match_entities(rows, using.gazetteer).collect()}
    for item in rows.collect():
        words = (item["text"] or "").split()
        for kind in ("speaker", "company", "location"):
            places = [(at, -len(p.split()), name) for p, k, name in phrases if k == kind
                      for at in range(len(words)) if words[at:at + len(p.split())] == p.split()]
            expected = min(places)[2] if places else None
            got = found[item["item_id"]][kind] if item["item_id"] in found else None
            assert got == expected


def test_enrichment_splits_once_and_moves_no_texts(crowded):
    from feedlens.operators.enrich import labels_of
    rows, using, _ = crowded
    using.gazetteer.phrases
    one = labels_of(rows, using)._jdf.queryExecution().executedPlan().toString()
    assert one.count("Exchange hashpartitioning(item_id") == 1
    assert one.count("regexp_extract_all") == 1 and "SortMergeJoin" not in one
    whole = enrich(rows, using)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in whole and "Exchange hashpartitioning(item_id" not in whole
    assert "regexp_extract_all" not in whole


def test_a_long_phrase_makes_no_rows_for_other_texts(crowded):
    rows, using, phrases = crowded
    sizes = {r["size"] for r in using.gazetteer.phrases.prefixes.select(
        F.explode("sizes").alias("size")).collect()}
    assert max(sizes) > 30
    one_word = rows.filter("item_id <> 'long'").select(
        "item_id", F.split("text", " ").alias("words"), F.lit(1).alias("pos"),
        F.get(F.split("text", " "), F.lit(0)).alias("term"))
    from feedlens.operators.entities import with_phrases
    found = with_phrases(one_word, using.gazetteer.phrases, "inner")
    assert found.count() <= 6 * one_word.count()


def test_counts_of_batches_add_up_exactly(spark):
    from feedlens.operators.classify import add_counts, bayes_from_counts, count_terms

    rows = [("en", "the good the bad"), ("es", "la cola"), ("en", None), (None, "lost words"),
            ("es", "la mala the"), ("fr", "not a label")]
    schema, labels = "label STRING, text STRING", ("en", "es")
    whole = table(learn_bayes(spark.createDataFrame(rows, schema), labels).table)
    for cut in (0, 2, 6):
        parts = [count_terms(spark.createDataFrame(part, schema), labels)
                 for part in (rows[:cut], rows[cut:])]
        assert table(bayes_from_counts(add_counts(*parts), labels).table) == whole


def test_python_holds_few_prompts_at_a_time(spark, tmp_path):
    from feedlens.operators.infer import infer_once

    def load():
        return lambda prompts: prompts.str.len().astype("string") + f" of {len(prompts)}"

    name, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", None
    before = spark.conf.get(name)
    spark.conf.set(name, 10_000)
    try:
        rows = spark.range(0, 5000, 1, 1).select(
            F.col("id").alias("item_id"), F.concat(F.lit("text "), "id").alias("text"))
        for found in (infer(rows, load), infer_once(rows, load, str(tmp_path / "answers"))):
            sizes = {int(r["reply"].split()[-1]) for r in found.collect()}
            assert max(sizes) <= 2000
    finally:
        spark.conf.set(name, before)


def test_one_call_per_distinct_prompt(spark, tmp_path):
    from feedlens.operators.infer import failures, infer_once

    log, path = str(tmp_path / "calls"), str(tmp_path / "answers")

    def model(broken):
        def load():
            def reply(prompts):
                with open(log, "a") as file:
                    file.writelines(f"{p}\n" for p in prompts)
                if any(broken and broken in p for p in prompts):
                    raise RuntimeError("no answer")
                return prompts.str.upper()
            return reply
        return load

    def asked():
        with open(log) as file:
            lines = file.read().split("\n")[:-1]
        open(log, "w").close()
        return sorted(lines)

    rows = items(spark, *["same"] * 1000, "other", None)
    done = infer_once(rows, model(None), path, "do: ")
    assert done.columns == [*rows.columns, "reply"] and done.count() == 1002
    assert asked() == ["do: other", "do: same"]
    assert {r["reply"] for r in done.collect()} == {"DO: SAME", "DO: OTHER", None}
    more = items(spark, "same", "bad", "good", "fine")
    assert table(infer_once(more, model("bad"), path, "do: ", partitions=1), "text", "reply") == [
        ("bad", None), ("fine", "DO: FINE"), ("good", "DO: GOOD"), ("same", "DO: SAME")]
    assert set(asked()) == {"do: bad", "do: fine", "do: good"}
    assert [r["error"] for r in failures(spark, path).collect()] == ["RuntimeError: no answer"]
    assert table(infer_once(more, model(None), path, "do: "), "text", "reply")[0] == ("bad", "DO: BAD")
    assert asked() == ["do: bad"] and failures(spark, path).count() == 0
    infer_once(more, model(None), path, "do: ").collect()
    assert asked() == []
