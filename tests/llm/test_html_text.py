import html
import re

import numpy as np
import pytest

from feedlens.llm import html_text as ht

CASES = [
    ("", ""),
    (None, ""),
    ("<article><h1>Title</h1><p>One  two\n three</p></article>", "Title\nOne two three"),
    ("<nav>Menu</nav><main><p>Text &amp; more &lt;b&gt; &#65;&nbsp;x</p></main><footer>F</footer>",
     "Text & more <b> A x"),
    ("<article><p>a<b>b</b>c<p>unclosed <i>next<ul><li>x<li>y</ul>", "abc\nunclosed next\nx\ny"),
    ("<article><p>in</p><div class='comments'><p>no</p></div><p>out</p></article>", "in\nout"),
    ("<article><script>var t='</p>';</script><style>p{}</style><p>ok</p><!-- no --></article>", "ok"),
    ("<article><form><p>name</p></form><aside>x</aside><p>ok</p></article>", "ok"),
    ("<article><p hidden>no</p><p aria-hidden=true>no</p><p class=lead>yes</p></article>", "yes"),
    ("<article><div id=cookie-notice>no</div><p>a &am b &amp</p></article", "a &am b &"),
    ("<article><p title='a > b'>x</p><p>last", "x\nlast"),
    ("<body><div>free text</div></body>", "free text"),
]


@pytest.fixture(scope="module")
def make_pages(spark):
    def make(*rows):
        data = [(i, u, h, "x", "y") for i, u, h in rows]
        return spark.createDataFrame(data, "page_id bigint, url string, html string, text string, "
                                           "stream string")
    return make


def texts(df):
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    rows = df.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def test_cases(make_pages):
    pages = [(i, f"http://h{i}.example/", source) for i, (source, _) in enumerate(CASES)]
    assert texts(ht.extract_text(make_pages(*pages))) == {i: t for i, (_, t) in enumerate(CASES)}


def test_whole_table(spark, sf_dir):
    """Against the articles as a plain pattern of these pages finds them."""
    got = texts(ht.op6_html_text(spark, sf_dir))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.DOTALL).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def boilerplate_site(n):
    """Pages without an article: repeated and own blocks, on two hosts."""
    pages, expected = [], {}
    for i in range(n):
        own = " ".join(f"own{i}x{k}" for k in range(12))
        host = "a.example" if i % 4 else "b.example"
        extra = "only on host b this line says so" if i % 4 == 0 else ""
        pages.append((i, f"http://{host}/{i}", "<div>all the pages of this site say the same</div>"
                      f"<div>{own}</div><p>short {i}</p><div>{extra}</div>"))
        expected[i] = f"{own}\nshort {i}"
    return pages, expected


def test_repeated_blocks_of_a_host_go(make_pages):
    pages, expected = boilerplate_site(40)
    assert texts(ht.extract_text(make_pages(*pages))) == expected


def test_shards_change_nothing(make_pages, monkeypatch):
    pages, expected = boilerplate_site(40)
    monkeypatch.setattr(ht, "SHARD_PAGES", 2)
    assert texts(ht.extract_text(make_pages(*pages))) == expected


@pytest.mark.parametrize("seen", [(0, 1, 2), (0, 2, 4, 6)])
def test_runs_on_two_pages_of_one_shard_and_one_of_another(make_pages, monkeypatch, seen):
    """However the pages are dealt, some split of two and one is among these sites."""
    pages, expected = [], {}
    for site in range(12):
        for k in range(8):
            own = " ".join(f"own{site}x{k}x{w}" for w in range(12))
            line = "<div>three of the pages say just this line</div>" if k in seen else ""
            pages.append((site * 8 + k, f"http://s{site}.example/{k}", f"<div>{own}</div>{line}"))
            expected[site * 8 + k] = own
    assert texts(ht.extract_text(make_pages(*pages))) == expected
    monkeypatch.setattr(ht, "SHARD_PAGES", 4)
    assert texts(ht.extract_text(make_pages(*pages))) == expected


@pytest.mark.parametrize("pages_a_shard", [256, 2])
def test_quotes_from_articles_of_other_pages_go(make_pages, monkeypatch, pages_a_shard):
    """A list of what other pages' articles say repeats them; what no page says stays."""
    monkeypatch.setattr(ht, "SHARD_PAGES", pages_a_shard)
    said = [" ".join(f"own{i}x{k}" for k in range(12)) for i in range(8)]
    pages = [(i, f"http://h.example/{i}", f"<article><p>{text}</p></article>")
             for i, text in enumerate(said)]
    teasers = "".join(f"<div>{text}</div>" for text in said)
    pages.append((8, "http://h.example/", f"{teasers}<div>one line that no other page has</div>"))
    pages.append((9, "http://other.example/", f"<div>{said[0]}</div>"))
    assert texts(ht.extract_text(make_pages(*pages))) == {
        **dict(enumerate(said)), 8: "one line that no other page has", 9: said[0]}


def test_copies_of_an_article_stay(make_pages):
    page = "<nav>n</nav><article><p>" + "the same long text of all copies " * 5 + "</p></article>"
    got = texts(ht.extract_text(make_pages(*[(i, "http://h.example/", page) for i in range(9)])))
    assert len(set(got.values())) == 1 and len(got[0]) > 100


def test_edges(make_pages):
    rows = [(None, None, "<p>a"), (1, "odd url", "<p>b"), (1, "odd url", "<p>b"), (2, "", None)]
    df = ht.extract_text(make_pages(*rows))
    assert sorted(r["text"] for r in df.collect()) == ["", "a", "b", "b"]
    assert ht.extract_text(make_pages(*rows).limit(0)).count() == 0
    long = "<div><p>" * 3000 + "deep " * 20000
    assert len(ht.parse_page(long).blocks) == 1


def test_cover_against_all_pairs():
    draw = np.random.default_rng(5)
    streams = [draw.integers(0, 3, draw.integers(0, 40)).astype(np.uint64) for _ in range(12)]
    pages = [i // 2 for i in range(12)]
    for stream, page, got in zip(streams, pages, ht.repeated_cover(streams, pages, 4)):
        expected = np.zeros(len(stream), bool)
        for i in range(len(stream) - 3):
            if any(q != page and any((other[j:j + 4] == stream[i:i + 4]).all()
                                     for j in range(len(other) - 3))
                   for other, q in zip(streams, pages)):
                expected[i:i + 4] = True
        assert (got == expected).all()


def blocks(source):
    return [text for text, kind in ht.parse_page(source).blocks if kind != "boilerplate"]


def test_marks_around_and_within_an_article():
    article = "<article><p>The text.</p></article>"
    for around in ("<form id=f>{}</form>", '<div class="page has-sidebar">{}</div>',
                   '<div class="no-sidebar">{}</div>', '<div hidden>{}</div>',
                   '<div id="comments-page">{}</div>'):
        assert blocks(around.format(article)) == ["The text."]
        assert blocks(around.format(article.replace("article", "main"))) == ["The text."]
    for around in ("<nav>{}</nav>", "<aside>{}</aside>", '<div role="navigation">{}</div>'):
        assert blocks(around.format(article)) == []
    assert blocks(article + '<div class="comments"><article>Nice!</article></div>') == ["The text."]
    inside = ('<article><section class="social history">In 1900.</section><p class="notice">Note.</p>'
              '<div class="ad">Buy.</div><p class="comments">Me too.</p><p>End.</p></article>')
    assert ht.parse_page(inside).blocks == [
        ("In 1900.", "marked"), ("Note.", "marked"), ("Buy.", "boilerplate"),
        ("Me too.", "boilerplate"), ("End.", "article")]


def test_repetition_decides_on_marked_blocks(make_pages):
    def page(i):
        return (f'<article><p>Story number {i} has words of its own {i * 7} and {i * 13}.</p>'
                '<p class="notice">We use small files on your device to count the visits.</p>'
                f'<p class="notice">This story {i} was corrected on day {i} by our editor {i}.</p>'
                '</article>')
    got = texts(ht.extract_text(make_pages(*[(i, "http://h.example/", page(i)) for i in range(4)])))
    for i in range(4):
        assert "corrected on day" in got[i] and "small files" not in got[i]


def test_stray_end_tags_and_deep_markup_take_linear_time():
    import time
    began = time.time()
    for source in ("<div>" * 20000 + "</b>" * 20000 + "x", "<span class=ad>" * 20000 + "</i>" * 20000,
                   "<div>" * 20000 + "</section>" * 20000, "<p><span class=ad>" * 20000,
                   "<ul>" + "<li><b class=ad>" * 20000):
        ht.parse_page(source)
    assert time.time() - began < 5
