import zlib

import numpy as np

from feedlens.llm import quality as ql


def test_held_out_rows_of_a_data_set(spark):
    """Learned on three quarters of the ids, right on the others."""
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet")
              .collect()}
    rows = ql.op5_quality(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows
              if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == q for p, q in judged]) > 0.95
    assert np.mean([p for p, q in judged if q]) > 0.97


def test_labels_of_held_out_rows_are_not_learned(spark, make_docs):
    pairs = [(i, f"good text number {i}" if i % 2 else f"BAD!! TEXT!! {i}") for i in range(400)]
    right = spark.createDataFrame([(i, i % 2, 0) for i in range(400)],
                                  "doc_id bigint, quality int, toxic int")
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = spark.createDataFrame([(i, (i + 1) % 2 if i in held else i % 2, 0) for i in range(400)],
                                  "doc_id bigint, quality int, toxic int")
    docs = make_docs(*pairs)
    scores = [sorted(map(tuple, ql.score_quality(docs, t).collect())) for t in (right, wrong)]
    assert scores[0] == scores[1]
    assert all(p == i % 2 for i, _, _, p in scores[0])
    kept = ql.keep_good(docs, right)
    assert kept.columns == docs.columns and kept.count() == 200


def test_edges(spark, edge_docs):
    none = spark.createDataFrame([(None, 1, 0), (4, None, 0)],
                                 "doc_id bigint, quality int, toxic int")
    rows = ql.score_quality(edge_docs, none).collect()
    assert len(rows) == 12 and {r["score"] for r in rows} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 11)],
                                "doc_id bigint, quality int, toxic int")
    assert {r["predicted"] for r in ql.score_quality(edge_docs, one).collect()} == {1}
    assert ql.score_quality(edge_docs.limit(0), one).count() == 0


def test_descent_reaches_the_optimum_of_the_dual():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(40, 5))
    signs = np.where(x[:, 0] + 0.5 * draw.normal(size=40) > 0, 1.0, -1.0)
    rows = [(np.arange(5), v) for v in x]
    weights, bias = ql.dual_coordinate_descent(rows, signs, np.full(40, 1.0), passes=2000)
    margins = signs * (x @ weights[:5] + bias)

    def primal(w, b):
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * (x @ w + b)).sum()

    best = primal(weights[:5], bias)
    for _ in range(300):
        assert primal(weights[:5] + draw.normal(0, 0.05, 5), bias + draw.normal(0, 0.05)) > best - 1e-3
    assert (margins > 0).mean() > 0.7


def test_repeated_words_and_places():
    seen = np.zeros(ql.PLACES, bool)
    assert ql.longest_run("a b b b c") == 3 and ql.longest_run("") == 0 and ql.longest_run("x") == 1
    one, two = ql.features("abc", seen), ql.features("abc abc", seen)
    assert set(one) < set(two) and not seen.any()
    assert len(ql.features(None, seen)) == 0
