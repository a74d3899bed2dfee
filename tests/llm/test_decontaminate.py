import hashlib
import random
import re

import numpy as np

from feedlens.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(documents, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in documents:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in sizes:
                if (key := tuple(w[i:i + n])) in windows and len(key) == n:
                    hit |= set(range(i, i + n))
                    found |= windows[key]
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def test_whole_table_against_brute_force(spark, sf_dir, corpus):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet")
             .select("item_id", "text").collect()]
    got = rows(dc.op2_decontamination(spark, sf_dir))
    assert got == brute(corpus, items)
    assert any(r[5] for r in got)


def test_repeats_short_items_and_slices(spark, make_docs):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choices("ab", k=n))
    items = [(i, text(draw.choice([1, 2, 3, 7, 12, 30]))) for i in range(12)]
    items += [(90, None), (91, "!!"), (92, "aaa bbb"), (92, "aaa bbb"), (93, "AAA, bbb"),
              (None, "x y z")]
    pairs = [(i, text(draw.choice([0, 1, 9, 40, 200]))) for i in range(30)]
    pairs += [(50, "Aaa--BBB"), (51, "aaa 1 bbb"), (52, "aaa"), (53, "bbb aaa"), (54, "aa a bbb")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs, expected = make_docs(*pairs), brute(pairs, [i for i in items if i[0] is not None])
    whole = dc.find_leaks(docs, benchmark.filter("item_id IS NOT NULL"))
    assert rows(dc.contamination(docs, benchmark.filter("item_id IS NOT NULL"))) == expected
    sliced = dc.find_leaks(docs, benchmark.filter("item_id IS NOT NULL"), slice_bytes=200)
    same = lambda df: sorted((r["doc_id"], sorted(map(tuple, r["matches"])))
                             for r in df.collect())
    assert same(whole) == same(sliced)


def test_longest_match_and_place(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(30))
    text = "before " + " ".join(f"w{i}" for i in range(4, 21)) + " after w1 w2"
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = dc.find_leaks(make_docs((1, text)), benchmark).first()["matches"]
    assert [tuple(m) for m in found] == [(7, 1, 4, 17)]


def test_edges(spark, edge_docs):
    benchmark = spark.createDataFrame([(1, "no id here"), (2, "long word " * 8)],
                                      "item_id bigint, text string")
    got = {r["doc_id"]: r for r in dc.contamination(edge_docs, benchmark).collect()}
    assert got[1]["n_words"] == 0 and not got[2]["contaminated"]
    assert got[None]["n_hit"] == 3 and got[7]["n_hit"] == 40000
    assert dc.contamination(edge_docs.limit(0), benchmark).count() == 0
    none = dc.contamination(edge_docs, benchmark.limit(0)).collect()
    assert len(none) == 12 and not any(r["contaminated"] for r in none)
    kept = dc.clean_rows(edge_docs, benchmark)
    assert kept.columns == edge_docs.columns and kept.count() == 10


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(1)
    sequence = draw.integers(0, 3, 300)
    order = dc.suffix_array(sequence, 400)
    assert [list(sequence[i:]) for i in order] == sorted(list(sequence[i:]) for i in range(300))


def test_repeated_words_take_bounded_time_and_memory():
    import time

    from feedlens.llm.decontaminate import Benchmark, ShardSearch

    began = time.time()
    for n_item, n_doc in ((2000, 2000), (200, 20_000)):
        search = ShardSearch(Benchmark.of([(1, "aa " * n_item)], 10))
        found = search.matches([[b"aa"] * n_doc])[0]
        covered = set()
        for _, at, _, n in found:
            covered.update(range(at, at + n))
        assert len(covered) == n_doc and len(found) <= n_item + n_doc
        assert max(n for *_, n in found) == min(n_item, n_doc)
    assert time.time() - began < 20


def test_slices_store_texts_once_and_give_the_same(spark, make_docs, monkeypatch):
    from feedlens.llm import decontaminate as dc

    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame(
        [(i, " ".join(words[i:i + 12])) for i in range(0, 48, 3)] + [(99, None), (98, "zz")],
        "item_id long, text string")
    docs = make_docs((1, " ".join(words)), (2, None), (3, "zz top"), (4, " ".join(words[20:40])),
                     (4, " ".join(words[20:40])), (None, " ".join(words[5:30])), (6, "clean"))
    written, store = [], dc.stored
    monkeypatch.setattr(dc, "stored", lambda df, name: written.append(df.columns) or store(df, name))

    def rows(size):
        return sorted(repr((r["doc_id"], r["n_words"], sorted(map(tuple, r["matches"]))))
                      for r in dc.find_leaks(docs, items, slice_bytes=size).collect())

    assert rows(200) == rows(1 << 20)
    assert sum("text" in columns for columns in written) == 1 and len(written) > 4
    assert dc.find_leaks(docs.limit(0), items, slice_bytes=200).count() == 0
