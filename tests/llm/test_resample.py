import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from feedlens.llm import resample as rs

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    def buckets_of(text):
        words = words_of(text)
        runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1)
                for i in range(len(words) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    source = [b for _, text in docs for b in buckets_of(text)]
    wanted = [b for text in target for b in buckets_of(text)]
    s, t = np.bincount(source, minlength=buckets), np.bincount(wanted, minlength=buckets)
    rows = []
    for doc_id, text in docs:
        found = buckets_of(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (len(source) + buckets)
                                                / ((s[b] + 1) * (len(wanted) + buckets))))
                     for b in found)
        name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append([doc_id, len(found), weight, score, None])
    able = [r for r, (_, text) in zip(rows, docs, strict=True) if len(words_of(text)) >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(able[:len(able) * percent // 100], 1):
        row[4] = place
    return sorted(map(tuple, rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("river bank stone water",), (None,), ("",)], "text string")


def test_whole_table(spark, sf_dir, corpus):
    goal = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert got(rs.op11_resample(spark, sf_dir)) == brute_force(corpus, goal)


def test_draw_prefers_the_target(make_docs, target):
    pairs = [(i, "river water " * 15 if i % 10 == 0 else "plain other " * 15) for i in range(200)]
    rows = rs.resample(make_docs(*pairs), target).collect()
    assert all(r["doc_id"] % 10 == 0 for r in rows if r["rank"]) and len(rows) == 200
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 21))


def test_edges_and_longer_runs(spark, edge_docs, target):
    pairs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    goal = ["river bank stone water", None, ""]
    assert got(rs.resample(edge_docs, target)) == brute_force(pairs, goal)
    found = got(rs.resample(edge_docs, target, percent=70, least_words=1, longest=3, buckets=64))
    assert found == brute_force(pairs, goal, 70, 1, 3, 64)
    assert rs.resample(edge_docs.limit(0), target).collect() == []
    assert len(got(rs.resample(edge_docs, target.limit(0), percent=100, least_words=0))) == 12


def test_hot_copies_and_ties(spark, make_docs, target):
    same = "river bank of the same text " * 5
    pairs = [(i % 50 if i % 3 else None, same) for i in range(900)]
    pairs += [(1000 + i, f"w{i} " * (i % 40)) for i in range(300)]
    docs = make_docs(*pairs).repartition(13)
    found = got(rs.resample(docs, target, percent=35))
    expected = brute_force(pairs, ["river bank stone water"], 35)
    assert found == expected


@pytest.mark.parametrize("parts", [1, 7])
def test_cutoff_is_the_exact_place(spark, parts):
    rng = np.random.default_rng(parts)
    keys = [(int(a), int(b), int(c), int(d), i) for i, (a, b, c, d) in enumerate(
        zip(rng.integers(-5, 5, 500), rng.integers(0, 2, 500), rng.integers(0, 9, 500),
            rng.integers(0, 3, 500)))]
    table = spark.createDataFrame(keys, ", ".join(f"{k} long" for k in rs.KEYS)).repartition(parts)
    for place in (1, 2, 137, 250, 499, 500):
        assert rs.cutoff(table, place) == sorted(keys)[place - 1]


def test_weighted_median_discards_a_quarter():
    rng = np.random.default_rng(5)
    for _ in range(50):
        groups = [sorted(rng.integers(0, 1000, rng.integers(1, 40)).tolist()) for _ in range(9)]
        medians = [(len(g), [g[(len(g) - 1) // 2]]) for g in groups]
        probe, flat = rs.weighted_median(medians)[0], sum(groups, [])
        assert sum(v <= probe for v in flat) * 4 >= len(flat)
        assert sum(v >= probe for v in flat) * 4 >= len(flat)


def test_gain_of_absent_words_is_finite(spark):
    zeros = np.zeros(4, np.int64)
    assert rs.gains(zeros, zeros).tolist() == [0, 0, 0, 0]
