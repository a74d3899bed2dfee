"""HTML extraction with suffix arrays over hosts.

A page is cut into blocks, each with its words and the region it stands in. Regions that are
boilerplate by their element or role (menus, headers, footers, sidebars, adverts, forms, comments)
are named by structure. What remains outside an article is decided by the host: the token streams
of its pages are put one after another, a suffix array finds the long substrings that occur on
distinct pages, and blocks that those cover are boilerplate, while unique runs stay.

The streams hold the words of articles too, so what is quoted from them on other pages is found.
Every page goes through the suffix array, but blocks inside an article are not put to that test:
passages and whole texts that several articles share are main text, and covering alone would
remove them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import WordCodes, flat_batches, map_batches, mix64, read_table, stored
from feedlens.llm.decontaminate import suffix_array
from feedlens.session import lookup_join

MIN_WORDS = 6
COVERED = 0.5
SHARD_PAGES = 256
LOOKUP_BYTES = 32 << 20

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(?:[?!])[^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)"""
                    r"""|</?[a-zA-Z][^>]*(?:>|\Z)""", re.DOTALL)
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea",
       "title", "select", "canvas", "audio", "video"}
# Elements whose content is no main text, wherever they stand.
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "menu",
         "menubar", "alert", "alertdialog"}
# Words of classes and ids. Adverts, dialogs and what readers write are boilerplate by their word
# alone; the others are so outside an article only, within one repetition decides.
REMARKS = r"comments?|disqus|respond|replies"
MARKED = re.compile(rf"(?i)(?:^|[\s_-])(?:(?P<remarks>{REMARKS})|(?P<sure>ads?|advert\w*|sponsor\w*"
                    r"|promo\w*|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|login|signup"
                    r"|pagination|pager|breadcrumbs?)|banner|nav\w*|menu\w*|sidebar|footer|header"
                    r"|masthead|notice|social|share|sharing|related|recommended|widget)(?:$|[\s_-])")
# How sure a mark is: none, a class word, a sure one or a form, readers' remarks, an element.
PLAIN, WORD, SURE, REMARK, ELEMENT = range(5)
ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|hidden|aria-hidden)(?![\w-])"""
                       r"""(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del",
          "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source",
        "track", "param"}
# An element of the first kind ends an open one of the second kind.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
        "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
        "option": {"option"}, "body": {"head"}}
SCOPES = {"article", "main", "section", "div", "table", "ul", "ol", "dl", "nav", "header", "footer",
          "aside", "form", "body", "blockquote"}


@dataclass
class Page:
    """Blocks of a page in order: their text, and ``article``, ``marked`` (within an article, by a
    class word only), ``outside`` or ``boilerplate``."""

    blocks: list[tuple[str, str]] = field(default_factory=list)


def mark_of(name: str, attributes: str) -> int:
    """How an element is marked as boilerplate: by its name, role, class or id, or being hidden."""
    if name in BOILERPLATE:
        return SURE if name == "form" else ELEMENT
    if name in ("html", "body", "article", "main") or not attributes:
        return PLAIN
    mark = PLAIN
    for key, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        key = key.lower()
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            mark = max(mark, SURE)
        elif key == "role" and value.lower() in ROLES:
            mark = max(mark, ELEMENT)
        elif key in ("class", "id"):
            for word in MARKED.finditer(value.replace(" ", "  ")):
                mark = max(mark, REMARK if word["remarks"] else SURE if word["sure"] else WORD)
    return mark


def parse_page(source: str | None) -> Page:
    """Blocks of the whole page, broken markup included; one pass from start to end.

    An ``article`` or ``main`` is not boilerplate because something around it has a marked class, is
    a form or hidden, only within elements such as ``nav``; but after a first one, those within
    readers' remarks are remarks.
    """
    page, parts = Page(), []
    stack: list[tuple[str, int, bool]] = []  # element, mark, article, each with its parents
    opened: Counter[str] = Counter()
    seen = False
    source = source or ""

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            _, mark, inside = stack[-1] if stack else ("", PLAIN, False)
            kind = ("article" if inside else "outside") if mark == PLAIN else (
                "marked" if inside and mark == WORD else "boilerplate")
            page.blocks.append((text, kind))

    def cut(depth: int) -> None:
        opened.subtract(name for name, _, _ in stack[depth:])
        del stack[depth:]

    def push(name: str, mark: int, inside: bool) -> None:
        stack.append((name, mark, inside))
        opened[name] += 1

    at = 0
    while at < len(source):
        found = MARKUP.search(source, at)
        if not found:
            parts.append(html.unescape(source[at:]))
            break
        parts.append(html.unescape(source[at:found.start()]))
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        closing = bool(found.group(1))
        if name not in INLINE:
            flush()
        elif name == "br":
            parts.append(" ")
        if closing:
            if opened[name]:
                flush()
                cut(next(d for d in _down(stack) if stack[d][0] == name))
        elif name in RAW and not found.group(3).endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and name not in INLINE:
            ended = ENDS.get(name, ())
            if any(opened[e] for e in ended):  # end tags that may be left out
                for depth in _down(stack):
                    if stack[depth][0] in ended:
                        cut(depth)
                        break
                    if stack[depth][0] in SCOPES:
                        break
            _, mark, inside = stack[-1] if stack else ("", PLAIN, False)
            if name in ("article", "main"):
                if not inside and (mark < REMARK or mark == REMARK and not seen):
                    mark = PLAIN
                inside = seen = True
            push(name, max(mark, mark_of(name, found.group(3) or "")), inside)
        elif name in INLINE and name not in VOID:
            own = mark_of(name, found.group(3) or "")
            if own != PLAIN:
                flush()
                _, mark, inside = stack[-1] if stack else ("", PLAIN, False)
                push(name, max(mark, own), inside)
    flush()
    return page


def _down(stack: list) -> range:
    """Depths from the innermost element out."""
    return range(len(stack) - 1, -1, -1)


def repeated_cover(streams: list[np.ndarray], pages: list[int], least: int = MIN_WORDS) -> list:
    """Per stream a mask of the words that lie in a substring of ``least`` words or more which
    occurs on another page too; ``pages`` says which page a stream is of."""
    if not streams:
        return []
    codes = np.unique(np.concatenate([*streams, np.empty(0, np.uint64)]), return_inverse=True)[1]
    sizes = np.array([len(s) for s in streams])
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.empty(int(sizes.sum()) + len(streams), np.int64)
    owner = np.empty(len(flat), np.int64)
    used = 0
    for i, size in enumerate(sizes):
        at = starts[i]
        flat[at:at + size] = codes[used:used + size] + len(streams)
        flat[at + size] = i  # a closing sign of its own, so that no match runs over an end
        owner[at:at + size + 1] = pages[i]
        used += size
    array = suffix_array(flat, least)
    windows = np.lib.stride_tricks.sliding_window_view(
        np.append(flat, np.full(least, -1)), least)[array]
    same = (windows[1:] == windows[:-1]).all(axis=1)
    group = np.cumsum(np.append(True, ~same)) - 1
    low = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    high = np.full(group[-1] + 1, -1)
    np.minimum.at(low, group, owner[array])
    np.maximum.at(high, group, owner[array])
    change = np.zeros(len(flat) + least + 1, np.int64)
    begins = array[(low != high)[group]]
    np.add.at(change, begins, 1)
    np.add.at(change, begins + least, -1)
    covered = np.cumsum(change) > 0
    return [covered[a:a + n] for a, n in zip(starts, sizes, strict=True)]


def windows_of(stream: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """64-bit names of all runs of ``least`` words."""
    if len(stream) < least:
        return np.empty(0, np.uint64)
    names = np.full(len(stream) - least + 1, least, np.uint64)
    for i in range(least):
        names = names * np.uint64(0x9E3779B97F4A7C15) + stream[i:len(stream) - least + 1 + i]
    return mix64(names)


KINDS = ("article", "marked", "outside", "boilerplate")
ARTICLE, GONE = KINDS.index("article"), KINDS.index("boilerplate")
PARSED = "blocks array<string>, kinds array<tinyint>, undecided boolean, shard long, covered binary"


def stream_of(blocks: list[str], codes: WordCodes) -> tuple[np.ndarray, list[int]]:
    """Codes of all words of a page, those of articles too, and the number of each block."""
    own = [text.encode("utf-8", "surrogatepass").lower().split() for text in blocks]
    return codes.of([word for words in own for word in words]), [len(words) for words in own]


def _parse(size: int):
    """Blocks of each page, and the words covered within its shard, a byte each: up to ``size``
    pages of one host that stand together. A shard is named by the number of its first row."""
    codes = WordCodes()

    def run(batch: pa.RecordBatch):
        blocks, kinds, streams, shards, masks = ([None] * batch.num_rows for _ in range(5))
        hosts: dict[str, list[int]] = {}
        for i, (source, host) in enumerate(zip(batch.column("html").to_pylist(),
                                               batch.column("host").to_pylist(), strict=True)):
            found = parse_page(source).blocks
            blocks[i] = [text for text, _ in found]
            kinds[i] = [KINDS.index(kind) for _, kind in found]
            streams[i] = stream_of(blocks[i], codes)[0]
            hosts.setdefault(host, []).append(i)
        numbers = batch.column("row").to_pylist()
        for pages in hosts.values():
            for at in range(0, len(pages), size):
                shard = pages[at:at + size]
                covered = repeated_cover([streams[i] for i in shard], shard)
                for i, mask in zip(shard, covered, strict=True):
                    shards[i], masks[i] = numbers[shard[0]], mask.astype(np.uint8).tobytes()
        undecided = [not {*own} <= {ARTICLE, GONE} for own in kinds]
        return [blocks, kinds, undecided, shards, masks]

    return run


def _page_windows():
    """Windows of all pages, each once a page, and whether their shard has covered them."""
    codes = WordCodes()

    def run(batch: pa.RecordBatch):
        rows, names, opened = [], [], []
        for row, blocks, covered in zip(*(batch.column(c).to_pylist()
                                          for c in ("row", "blocks", "covered")), strict=True):
            found = windows_of(stream_of(blocks, codes)[0])
            mask = np.frombuffer(covered, np.uint8)
            free = [not mask[i:i + MIN_WORDS].all() for i in range(len(found))]
            seen = dict(sorted(zip(found.astype(np.int64).tolist(), free)))  # open, if anywhere
            rows += [row] * len(seen)
            names += seen
            opened += seen.values()
        return [rows, names, opened]

    return run


def _remaining():
    """Texts of the blocks that stay."""
    codes = WordCodes()

    def run(batch: pa.RecordBatch):
        out = []
        columns = ("blocks", "kinds", "covered", "elsewhere")
        for blocks, kinds, covered, elsewhere in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True):
            stream, lengths = stream_of(blocks, codes)
            mask = np.frombuffer(covered, np.uint8).astype(bool)
            if elsewhere:
                found = windows_of(stream).astype(np.int64)
                for i in np.flatnonzero(np.isin(found, elsewhere)):
                    mask[i:i + MIN_WORDS] = True
            kept, at = [], 0
            for text, kind, length in zip(blocks, kinds, lengths, strict=True):
                if kind == ARTICLE or kind != GONE and mask[at:at + length].mean() < COVERED:
                    kept.append(text)
                at += length
            out.append("\n".join(kept))
        return [out]

    return run


def extract_text(pages: DataFrame) -> DataFrame:
    """Main text of each page: ``page_id, url, text, n_chars``.

    Blocks follow each other in page order, joined by a line feed; white space inside a block is
    one space; character references are decoded. A null or empty page has an empty text. Blocks
    outside an article, or marked by a class word within one, that are covered to half or more by
    substrings of six words which other pages of the same host have too, in an article or not,
    are left out; hosts come from ``url`` (null and odd ones
    share a host named ''). Every page goes through the suffix array of its shard, up to
    256 pages of one host that stand together in the table; the distinct runs of six words of every
    shard of a host with a block to decide, those that it holds twice too, are compared between
    shards by name, so sharding changes no result.
    Rows that repeat are pages of their own. Other columns are not read.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select("page_id", "url", "html", host.alias("host"),
                        F.monotonically_increasing_id().alias("row"))
    parsed = stored(map_batches(rows, partial(_parse, SHARD_PAGES), PARSED,
                                keep=("page_id", "url", "host", "row")), "parsed")
    wanted = parsed.filter("undecided")
    hosts = stored(wanted.select("host").distinct(), "hosts")
    elsewhere = F.lit(None).cast("array<long>")
    if hosts.isEmpty():
        met = parsed.withColumn("elsewhere", elsewhere)
    else:
        opened = lookup_join(parsed.drop("page_id", "url", "kinds"), hosts, ["host"], "left_semi",
                             limit=LOOKUP_BYTES)
        names = stored(flat_batches(opened, _page_windows, "row long, name long, open boolean"),
                       "windows")
        placed = names.join(opened.select("row", "host", "shard"), "row")
        repeated = stored(placed.groupBy("host", "name")
                          .agg(F.min("shard").alias("low"), F.max("shard").alias("high"))
                          .filter("low <> high").select("host", "name"), "repeated")
        found = (placed.filter("open").join(wanted.select("row"), "row", "left_semi")
                 .join(repeated, ["host", "name"])
                 .groupBy("row").agg(F.collect_set("name").alias("elsewhere")))
        met = (wanted.join(found, "row", "left")
               .unionByName(parsed.filter(~F.col("undecided")).withColumn("elsewhere", elsewhere)))
    texts = map_batches(met, _remaining, "text string", keep=("page_id", "url"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(read_table(spark, sf_dir, "pages"))
