import random

from feedlens.llm import near_dedup as nd
from feedlens.llm.common import WordCodes


def brute(pairs, threshold=85):
    sets = {}
    for i, t in pairs:
        words = (t or "").translate({c: c + 32 for c in range(65, 91)})
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
        sets[i] = ({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                   else {tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= threshold * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= threshold * (len(x) + len(y) - common):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_whole_table_against_brute_force(spark, sf_dir, corpus):
    assert result(nd.op10_near_duplicates(spark, sf_dir)) == brute(corpus)


def test_star_and_chain_of_near_copies(make_docs):
    """A base whose copies link with it alone, a chain, and equal texts."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    base = [word() for _ in range(150)]
    pairs = [(500, " ".join(base))]
    for i in range(60):
        copy = list(base)
        for at in (5 + draw.randrange(70), 80 + draw.randrange(60)):
            copy[at] = word()
        pairs.append((i, " ".join(copy)))
    chain = [word() for _ in range(160)]
    for i in range(25):
        pairs.append((1000 - i, " ".join(chain)))
        chain[(i * 6) % 155] = word()
    pairs += [(2000 + i, "The Same text, again and again!") for i in range(40)]
    expected = brute(pairs)
    assert len({v[1] for v in expected.values()}) < 30
    assert result(nd.near_duplicates(make_docs(*pairs))) == expected


def test_groups_around_the_threshold(make_docs):
    """Random edits, cuts and growth of one text: links of every kind among one bucket's sets."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    base = [word() for _ in range(100)]
    pairs = []
    for i in range(220):
        copy = list(draw.choice([base, base, base[6:], base[:-7], base + [word()] * 3]))
        for _ in range(draw.randrange(5)):
            at = draw.randrange(len(copy))
            copy[at:at + draw.randrange(2)] = [word() for _ in range(draw.randrange(2))]
        pairs.append((i, " ".join(copy)))
        if i % 9 == 0:
            base = list(draw.choice([base, copy]))
    expected = brute(pairs)
    assert 5 < len({v[1] for v in expected.values()}) < 200
    assert result(nd.near_duplicates(make_docs(*pairs))) == expected


def test_edges(spark, edge_docs):
    rows = nd.near_duplicates(edge_docs)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted(map(tuple, rows.collect()), key=str)
    assert (None, 1, None, True) in got
    assert got.count((10, 2, 10, True)) == 2
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
            (6, 1, 6, True)} <= set(got)
    assert nd.near_duplicates(edge_docs.limit(0)).count() == 0


def test_minimum_and_maximum_agree_as_often_as_the_sets():
    codes, draw = WordCodes(), random.Random(1)
    hits = total = 0
    for _ in range(60):
        words = [str(draw.random()) for _ in range(120)]
        other = list(words)
        other[60] = "changed"
        sets = [nd.shingle_set(" ".join(w), codes) for w in (words, other)]
        one, two = nd.signatures(sets)
        hits += (one == two).sum()
        total += len(one)
    assert abs(hits / total - 111 / 121) < 0.02


def test_work_in_a_group_just_under_the_threshold_is_linear(make_docs, monkeypatch):
    """Sets scattered around one centre, no two of them linked: every set costs a bounded share."""
    draw = random.Random(23)
    word = lambda: "".join(draw.choices("abcdefgh", k=7))
    base, pairs = [word() for _ in range(120)], []
    for i in range(800):
        copy = list(base)
        for at in draw.sample(range(2, 117, 5), 3):
            copy[at] = word()
        pairs.append((i, " ".join(copy)))
    work = {}
    linked, measured = nd._linked, nd._measured

    def counted(made):
        def call(rows, sets, threshold):
            work[made.__name__] = work.get(made.__name__, 0) + rows.count()
            return made(rows, sets, threshold)
        return call

    monkeypatch.setattr(nd, "_linked", counted(linked))
    monkeypatch.setattr(nd, "_measured", counted(measured))
    totals = []
    for n in (200, 400, 800):
        work.clear()
        found = result(nd.near_duplicates(make_docs(*pairs[:n])))
        assert found == brute(pairs[:n])
        totals.append(sum(work.values()))
    # buckets pass the small size at some n, so the two doublings are taken together
    assert totals[2] <= 2.2 ** 2 * totals[0], totals
    assert all(total <= 20 * n for total, n in zip(totals, (200, 400, 800), strict=True)), totals
