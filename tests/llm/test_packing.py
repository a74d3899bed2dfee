import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from feedlens.llm import packing as pk
from feedlens.llm.subwords import default_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def check(rows, pairs, library, length):
    """The contract; returns sequences and tokens."""
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in pairs}
    copies = Counter(i for i, _ in pairs)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        covered = Counter()
        for r in pieces:
            part = ids[i][r["start"]:r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids[i]) and len(part) == r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            covered.update(range(r["start"], r["start"] + r["length"]))
        assert covered == {k: copies[i] for k in range(len(ids[i]))}
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    assert set(by_sequence) == set(range(len(by_sequence)))
    return len(by_sequence), sum(r["length"] for r in rows)


def test_whole_table(spark, sf_dir, corpus, library):
    sequences, tokens = check(pk.op3_packing(spark, sf_dir).collect(), corpus, library, 2048)
    assert sequences <= 1.01 * tokens / 2048 + 2


def test_small_sequences_and_edges(edge_docs, make_docs, library):
    from tests.llm.conftest import EDGE_TEXTS

    check(pk.pack(edge_docs, length=64).collect(), EDGE_TEXTS, library, 64)
    assert pk.pack(edge_docs.limit(0)).count() == 0
    draw = random.Random(2)
    pairs = [(i, "the cat " * draw.randrange(40)) for i in range(400)]
    sequences, tokens = check(pk.pack(make_docs(*pairs), length=64, grain=1).collect(), pairs,
                              library, 64)
    assert sequences <= 1.02 * tokens / 64 + 1
    with pytest.raises(ValueError):
        pk.pack(edge_docs, length=100, grain=8)


def test_knapsack_against_all_choices():
    draw = np.random.default_rng(3)
    for _ in range(30):
        sizes = np.sort(draw.choice(np.arange(1, 12), 4, replace=False))
        values = draw.random(4)
        best, taken = pk.knapsack(sizes, values, 14)
        options = np.stack(np.meshgrid(*[np.arange(15)] * 4), -1).reshape(-1, 4)
        options = options[options @ sizes <= 14]
        assert abs(best - (options @ values).max()) < 1e-9
        assert taken @ sizes <= 14 and abs(taken @ values - best) < 1e-9


def test_program_reaches_its_bound_and_plans_hold_all_rests():
    draw = np.random.default_rng(1)
    histogram = {int(s): int(n) for s, n in zip(range(3, 60), draw.integers(1, 400, 57))}
    patterns = pk.solve_patterns(histogram, 64)
    sizes = np.array(sorted(histogram))
    assert all(p @ sizes <= 64 for p, used in patterns if used > 1e-9)
    supply = sum(p * used for p, used in patterns)
    assert np.allclose(supply, [histogram[s] for s in sizes])
    plan = pk.round_patterns(histogram, 64)
    placed = Counter()
    for pattern, times in plan:
        assert sum(s * n for s, n in pattern.items()) <= 64
        placed.update({s: n * times for s, n in pattern.items()})
    assert placed == histogram
    # every rest over half a sequence needs one of its own, and no plan beats the program
    assert sum(t for _, t in plan) <= sum(u for _, u in patterns) + len(sizes)


def test_slots_are_used_once():
    plan = [({5: 2, 3: 1}, 4), ({5: 1}, 3), ({3: 4}, 2)]
    slots = pk.slot_table(plan)
    seen = Counter()
    for size, count in ((5, 11), (3, 12)):
        sequence, order = slots[size].place(np.arange(count))
        seen.update(zip(sequence.tolist(), order.tolist()))
    assert max(seen.values()) == 1 and len(seen) == 23
