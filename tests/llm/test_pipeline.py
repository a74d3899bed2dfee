import corpus_pipeline as cp
from feedlens.llm.near_dedup import near_duplicates
from feedlens.llm.quality import keep_good
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_dedup import brute as grouped


def test_stages_take_effect_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for _, stage in cp.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], sf_dir).cache())
        assert steps[-1].columns == columns
    rows = [[(r["doc_id"], r["text"]) for r in s.select("doc_id", "text").collect()] for s in steps]
    good, unique, clean, masked = rows[1:]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet")
              .collect()}
    assert set(good) < set(rows[0])
    assert sorted(good) == sorted((r["doc_id"], r["text"]) for r in keep_good(
        docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect())
    assert sum(labels.get(i) == 1 for i, _ in good) >= 0.97 * sum(
        labels.get(i) == 1 for i, _ in rows[0])
    groups = grouped(good)
    assert sorted(unique) == sorted((i, t) for i, t in good if groups[i][2])
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet")
             .select("item_id", "text").collect()]
    leaks = {r[0] for r in contaminated(unique, items) if r[5]}
    assert leaks and sorted(clean) == sorted((i, t) for i, t in unique if i not in leaks)
    assert {i for i, _ in masked} == {i for i, _ in clean}
    packed = cp.STAGES[-1][1](spark, steps[-1], sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in masked}
    key = lambda df: sorted(tuple(r[c] for c in ("doc_id", "start", "ids_crc32"))
                            for r in df.collect())
    assert key(cp.run(spark, sf_dir)) == key(packed)
    assert near_duplicates(steps[-1]).filter("NOT kept").count() == 0


def test_stages_on_edges(spark, edge_docs, sf_dir):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            result = stage(spark, rows, sf_dir)
            assert result.count() >= 0
