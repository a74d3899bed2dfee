import hashlib
import random
from itertools import groupby

import numpy as np
import pytest

from feedlens.llm import fingerprint as fp


def brute(pairs):
    """The contract's edited texts, by one sorted list."""
    rows = sorted(((i, t or "") for i, t in pairs),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + other[:half]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), text, changed, other))
    return out


def check(df, pairs):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
               "near_edited", "near_next"]
    assert df.columns == columns
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in df.collect()), key=key)
    expected = []
    for i, n, digest, text, changed, other in brute(pairs):
        mine, theirs, following = fp.fingerprints([text, changed, other])
        expected.append((i, n, digest, mine, theirs, fp.likeness(mine, theirs),
                         fp.likeness(mine, following)))
    assert got == sorted(expected, key=key)
    return got


def test_whole_table(spark, sf_dir, corpus):
    rows = check(fp.op1_fingerprints(spark, sf_dir), corpus)
    assert np.mean([r[5] for r in rows]) > 0.2 > 0.05 > np.mean([r[6] for r in rows])


def test_edges(edge_docs, make_docs):
    from tests.llm.conftest import EDGE_TEXTS

    check(fp.compare_with_edits(edge_docs), EDGE_TEXTS)
    check(fp.compare_with_edits(make_docs((5, "alone here"))), [(5, "alone here")])
    assert fp.compare_with_edits(edge_docs.limit(0)).count() == 0


def test_equal_texts_have_equal_fingerprints_wherever_they_stand():
    texts = ["a", "ab", "aaaaaaaa", "abcabcabcabc" * 9, "some words and more words " * 30]
    alone = [fp.fingerprints([t])[0] for t in texts]
    assert fp.fingerprints(texts[::-1] + texts) == alone[::-1] + alone
    assert len(set(alone)) == len(alone)
    assert fp.fingerprints([None, ""]) == ["", ""]


def test_phrases_of_a_shared_passage_do_not_depend_on_the_offset():
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=draw.randrange(2, 9)))
    passage = " ".join(word() for _ in range(300))
    names = []
    for before in ("", "x", "other start ", " ".join(word() for _ in range(50))):
        flat = np.frombuffer((before + passage).encode("utf-32-le"), np.uint32)
        levels = fp.parse(fp.mix64(flat.astype(np.uint64)), np.array([0]))
        names.append([set(symbols.tolist()) for symbols, _ in levels][1:6])
    for level in range(5):
        for other in names[1:]:
            shared = len(names[0][level] & other[level]) / len(names[0][level])
            assert shared > 1 - 0.02 * 3 ** level


def test_likeness_follows_the_shared_part():
    draw = random.Random(9)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(1200)]
    whole = " ".join(words[:600])
    for kept, low, high in ((600, 1, 1), (540, 0.6, 0.95), (300, 0.15, 0.55), (0, 0, 0.02)):
        other = " ".join(words[:kept] + words[600:1200 - kept])
        one, two = fp.fingerprints([whole, other])
        assert low <= fp.likeness(one, two) <= high
    assert fp.likeness("", "") == 1.0 and fp.likeness("", one) == 0.0


@pytest.mark.parametrize("seed", range(3))
def test_phrases_are_short_and_neighbouring_labels_differ(seed):
    symbols = np.random.default_rng(seed).integers(0, 1 << 62, 4000).astype(np.uint64)
    first = np.array([0, 1000, 1001, 2500])
    starts = np.flatnonzero(fp.phrase_starts(symbols, first))
    lengths = np.diff(np.append(starts, 4000))
    assert lengths.max() <= 12 and set(first) <= set(starts)
    labels = fp.toss(symbols, first)
    for _ in range(3):
        labels = fp.toss(labels, first)
    assert labels.max() <= 5
    inner = np.setdiff1d(np.arange(1, 4000), first)
    assert (labels[inner] != labels[inner - 1]).all()


M = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15


def plain_mix(x):
    x &= M
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & M
    x ^= x >> 29
    x = x * 0xC4CEB9FE1A85EC53 & M
    return x ^ x >> 32


def plain_toss(symbols):
    labels = [symbols[0] & 1]
    for left, own in zip(symbols, symbols[1:]):
        bit = next(b for b in range(64) if (left ^ own) >> b & 1)
        labels.append(2 * bit + (own >> bit & 1))
    return labels


def plain_phrases(symbols):
    """The symbols cut into phrases, one sign after the other, from the definition."""
    labels = symbols
    for _ in range(4):
        labels = plain_toss(labels)
    at = lambda i: labels[i] if 0 <= i < len(labels) else 0
    peak = lambda i: 0 <= i < len(labels) and at(i - 1) < at(i) > at(i + 1)
    valley = lambda i: at(i - 1) > at(i) < at(i + 1)
    phrases = [[symbols[0]]]
    for i in range(1, len(symbols)):
        if i > 1 and (peak(i) or valley(i) and not peak(i - 1) and not peak(i + 1)):
            phrases.append([])
        phrases[-1].append(symbols[i])
    return phrases


def plain_fingerprint(text):
    symbols = [plain_mix(ord(c) + STEP) for c in text]
    hashes, level = set(), 0
    while True:
        if level >= fp.SKETCH_LEVEL:
            hashes |= {plain_mix(s ^ STEP) >> 32 for s in symbols}
        if len(symbols) == 1:
            break
        runs = [(symbol, len(list(group))) for symbol, group in groupby(symbols)]
        symbols = [s if n == 1 else plain_mix(s + n * STEP) for s, n in runs]
        symbols = [plain_mix(sum(plain_mix(s + i * STEP) for i, s in enumerate(phrase))
                             + len(phrase)) for phrase in plain_phrases(symbols)]
        level += 1
    lowest = sorted(hashes or {symbols[0] >> 32})[:fp.SKETCH]
    return f"{symbols[0] ^ len(text):016x}:" + "".join(f"{h:08x}" for h in lowest)


def test_fingerprints_against_a_parse_sign_by_sign():
    draw = random.Random(23)
    texts = ["a", "ab", "aa", "aba", "aaaaaaa", "é" * 40 + "b" * 3, "\U0001f600\n\t "]
    for alphabet in ("ab", "abc ", "abcdefghijklmnopqrstuvwxyz .,", "éàü漢字\U0001f600"):
        texts += ["".join(draw.choices(alphabet, k=draw.choice((1, 2, 3, 7, 40, 300, 2500))))
                  for _ in range(25)]
    assert fp.fingerprints(texts) == [plain_fingerprint(t) for t in texts]
