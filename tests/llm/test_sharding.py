import zlib

from feedlens.llm import sharding as sh


def check(rows, texts, shards):
    """Contract of the ``bytes`` law; returns the bytes per shard."""
    expected = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                      for i, t in texts if i is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows
                  if r["doc_id"] is not None) == expected
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    return [sum(r["size"] for r in rows if r["shard"] == s) for s in range(shards)]


def test_whole_table(spark, sf_dir, corpus):
    rows = sh.op9_sharding(spark, sf_dir).collect()
    sizes = check(rows, corpus, 24)
    largest = max(r["size"] for r in rows)
    assert max(sizes) - min(sizes) <= 2 * largest
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_hot_text_is_split_and_equal_texts_stay_together(make_docs):
    pairs = [(i, "one very common text") for i in range(3000)]
    pairs += [(5000 + i, f"text {i % 700} " * (i % 13)) for i in range(1500)]
    rows = sh.shard_rows(make_docs(*pairs), 24).collect()
    sizes = check(rows, pairs, 24)
    assert max(sizes) <= 1.02 * sum(sizes) / 24 + 200
    spread = {}
    for r in rows:
        spread.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) - 1 for s in spread.values()) <= 23


def test_edges(edge_docs):
    rows = sh.shard_rows(edge_docs, 4).collect()
    assert len(rows) == 12 and sum(r["doc_id"] is None for r in rows) == 1
    assert sh.shard_rows(edge_docs.limit(0), 4).count() == 0
    alone = sh.shard_rows(edge_docs.filter("doc_id = 10"), 4).collect()
    assert len({r["shard"] for r in alone}) == 1
