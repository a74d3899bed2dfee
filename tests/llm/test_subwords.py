import random

import pytest
from tokenizers import Tokenizer

from feedlens.llm import subwords as sw

SIGNS = [" ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", "​", "　", " ", "'s",
         "'re", "'ll", "'", "a", "B", "\xe9", "漢", "\U0001f600", "1", "\xb2", "٣", "!",
         "-", "<|endoftext|>", "<|endof", "the", " hello", "́", "﻿", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(sw.default_path())


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def random_texts(n):
    draw = random.Random(1)
    return ["".join(draw.choices(SIGNS, k=draw.randrange(1, 14))) for _ in range(n)]


def test_ids_agree_with_the_library(library, corpus):
    words = sw.vocabulary(sw.default_path())
    for text in random_texts(1500) + [t for _, t in corpus]:
        assert words.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_counts_at_every_prefix(library):
    counter = sw.prefix_counter(sw.default_path())
    for text in random_texts(300) + ["The quick  brown\n\n fox's den, they're  ", "x" * 40]:
        expected = [count(library, text[:k]) for k in range(1, len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == expected, repr(text)


def test_whole_table(spark, sf_dir, corpus, library):
    got = {r["doc_id"]: r for r in sw.op4_token_counts(spark, sf_dir).collect()}
    assert len(got) == len(corpus)
    for i, text in corpus:
        n = count(library, text)
        row = got[i]
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), n)
        assert row["over_limit"] == (n > 512)
        assert count(library, text[:row["budget_chars"]]) <= 512
        assert (row["budget_chars"] == len(text)) == (n <= 512)


def test_stored_prefixes_and_edges(edge_docs, library):
    rows = sw.token_counts(edge_docs, budget=3, store_prefixes=True).collect()
    assert len(rows) == 12
    texts = {1: "", 2: "", 4: "one", 6: "é ñ 漢字 😀 ok", 9: "a,b;c.d"}
    for r in rows:
        if r["doc_id"] in texts:
            text = texts[r["doc_id"]]
            assert r["prefix_tokens"] == [count(library, text[:k])
                                          for k in range(1, len(text) + 1)]
            assert r["n_bytes"] == len(text.encode())
    assert sw.token_counts(edge_docs.limit(0)).count() == 0
