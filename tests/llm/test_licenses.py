import re
import time

import pytest

from feedlens.llm import licenses as ls

WORDS = re.compile(ls.WORD)
FULL_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(text):
    """The report of one text, by trying every template at every place."""
    words = words_of(text)
    base, every, score = [], set(), 0.0
    for t in ls.TEMPLATES:
        for start in range(-len(t.words), len(words)):
            if all(start + at >= 0 and tuple(words[start + at:start + at + len(p)]) == p
                   for at, p in t.phrases):
                same = sum(0 <= start + i < len(words) and words[start + i] == w
                           for i, w in enumerate(t.words))
                score = max(score, same / len(t.words))
                every.add(t.label)
                if t.base:
                    base.append((start, t.label))
    return (len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
            ",".join(sorted({label for _, label in base})), ",".join(sorted(every)), score)


def check(docs, pairs):
    rows = ls.license_report(docs).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(
        repr((i, *brute_force(text))) for i, text in pairs)
    return rows


def test_whole_table(spark, sf_dir, corpus):
    rows = ls.op12_license_scan(spark, sf_dir).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(
        repr((i, *brute_force(text))) for i, text in corpus)


def test_notices(make_docs):
    pairs = [(1, "x. " + FULL_MIT + "."), (2, FULL_MIT.replace("associated", "linked")),
             (3, FULL_MIT.replace("charge", "cost")), (4, "MIT-License; mit\nlicense MIT License"),
             (5, "the GNU Lesser General Public License"), (6, "gnu general public license"),
             (7, "This work is licensed under CC BY-NC 4.0."), (8, "cc by nc nc by cc by"),
             (9, "free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU General Public License as published"), (10, "mit é license mité license"),
             (11, "MIT LICENſE apache liKense")]
    rows = {r["doc_id"]: r for r in check(make_docs(*pairs), pairs)}
    assert (rows[1]["labels"], rows[1]["score"]) == ("mit", 1.0)
    assert rows[2]["labels"] == "mit" and rows[2]["score"] < 1 and rows[3]["labels"] == ""
    assert (rows[4]["n_base"], rows[4]["first_word"], rows[4]["last_word"]) == (3, 0, 4)
    assert rows[5]["labels"] == "gpl,lgpl" and rows[5]["base_labels"] == "gpl"
    assert rows[7]["labels"] == "cc-by-nc" and rows[7]["base_labels"] == ""


def test_edges(edge_docs):
    pairs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(edge_docs, pairs)
    assert ls.license_report(edge_docs.limit(0)).collect() == []


def test_many_places_in_one_text_take_linear_time(make_docs):
    def seconds(n):
        docs = make_docs((1, "mit license " * n + "apache gnu general public license " * n))
        began = time.time()
        row = ls.license_report(docs).first()
        assert (row["n_base"], row["last_word"]) == (2 * n, 2 * n + 5 * n - 3)
        return time.time() - began
    seconds(10)
    assert seconds(40_000) < 20


def test_frequencies_change_no_result(make_docs):
    common = [(i, "the terms of the license under the software public") for i in range(60)]
    rare = [(100, "mit license"), (101, "gnu general public license"), (102, FULL_MIT)]
    check(make_docs(*common, *rare), common + rare)
    check(make_docs(*rare), rare)


@pytest.mark.parametrize("text, phrases", [
    ("a [b c] d", ((1, ("b", "c")),)), ("[a b] c [d]", ((0, ("a", "b")), (3, ("d",))))])
def test_template_brackets(text, phrases):
    assert ls.Template.of("x", text).phrases == phrases


def test_no_python_in_the_plan(spark, sf_dir):
    plan = ls.op12_license_scan(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_templates_have_two_key_words():
    assert all(sum(len(p) for _, p in t.phrases) >= 2 for t in ls.TEMPLATES)
