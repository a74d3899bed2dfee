"""Secret scans by assignment-aware lexing.

Every text is scanned for plain patterns (the *base* kinds), and lexed for assignments in source
and configuration syntax: ``name = "literal"``, ``"name": "literal"``, ``name: literal``,
``name => literal``, ``<name>literal</name>``, ``--name literal``. Names keep the constants that
they were given, and expressions that refer to them or join strings take those over, so a literal
is judged by every name it reaches. A literal is a secret when the sensitivity of its target name
and its own strength multiply to the threshold.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import map_batches, read_table

KINDS = ("assign", "access", "hex", "lexed")
THRESHOLD = 0.5
MASK = "[secret]"
FOUND = "array<struct<kind:string,start:bigint,end:bigint,value:bigint,name:string,score:double>>"

# Patterns of the base kinds, fixed by the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Parts of names and how strongly they tell of a secret.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0,
             "token": 1.0, "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "bearer": 0.9,
             "authorization": 0.9, "pass": 0.8, "auth": 0.7, "private": 0.6, "key": 0.6,
             "access": 0.5, "signing": 0.5, "encryption": 0.5, "session": 0.4, "cookie": 0.4}
HARMLESS = {"public", "count", "length", "size", "max", "min", "limit", "type", "name", "file",
            "path", "url", "policy", "hint", "label", "field", "id", "tokens", "tokenizer"}
_STAND_IN = (r"(?:your|my|own|an?|the|some|any|new|enter|insert|add|put|set|use|example|sample|dummy|test"
             r"|secret|api|access|private|password|passwd|passphrase|pwd|token|key|credential|value"
             r"|string|here|goes|me|in)")
#: What stands for a secret that is not given: signs, variables, and words of which all are known.
PLACEHOLDER = re.compile(
    r"(?i)^(?:[x*.\-_0]+|<.*>|\$\{?[\w.]+\}?|%\w+%|\{\{.*\}\}|change[_-]?me|placeholder|none|null|true"
    rf"|false|undefined|redacted|todo|{_STAND_IN}(?:[ _.-]*{_STAND_IN})*)[.!]?$")

OPERATOR = re.compile(r":=|=>|=|:|</|--(?=[A-Za-z])")
NAME_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-.$@")
QUOTED = re.compile(r'"""(.*?)"""|\'\'\'(.*?)\'\'\'|"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\''
                    r"|`([^`\n]*)`", re.DOTALL)
BARE = re.compile(r"""[^\s"'`,;(){}<>\[\]&|]+""")
LITERAL = 4096
GAP = re.compile(r"[ \t]*")
JOINT = re.compile(r"[ \t]*(?:\+|\.(?=[ \t]*[\"'$]))[ \t]*|[ \t]+(?=[\"'])")
OPTION = re.compile(r"--([A-Za-z](?:[\w.]|-(?!-))*+)[ \t]+(?=[^\s-])")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Span(NamedTuple):
    """A find; ``value`` is where the secret itself begins."""

    kind: str
    start: int
    end: int
    value: int
    name: str
    score: float


def name_score(name: str) -> float:
    """How sensitive a target name is, from its parts (camel case, snake case, dots, dashes)."""
    parts = [p.lower() for p in PART.findall(name)]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    total = sum(SENSITIVE.get(p, 0.0) for p in dict.fromkeys(parts))
    if "public" in parts:
        return 0.0
    return min(1.0, total)


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret: its entropy, and its mix of signs.

    Words between quotes count less than one word; a literal of one kind of signs passes only for
    a name that is sensitive as a whole.
    """
    if len(value) < 6 or PLACEHOLDER.match(value) or not quoted and len(value.split()) > 1:
        return 0.0
    counts = Counter(value)
    bits = sum(n * math.log2(len(value) / n) for n in counts.values())
    classes = sum(any(map(test, value)) for test in (str.islower, str.isupper, str.isdigit)) + any(
        not c.isalnum() for c in value)
    mixed = {1: 0.6 if quoted else 0.2, 2: 0.8}.get(classes, 1.0)
    return min(1.0, bits / 24) * mixed * (0.6 if len(value.split()) > 1 else 1.0)


class Literal:
    """A value and what it is made of: a place of the text, or two other literals.

    Literals share their parts, so a chain of constants takes a node a line. Put together from more
    than ``LITERAL`` signs it has no value of its own, and its parts are judged one by one.
    """

    __slots__ = ("value", "quoted", "place", "pair", "_strongest")

    def __init__(self, value: str | None, quoted: bool, place: tuple[int, int] | None = None,
                 pair: tuple[Literal, Literal] | None = None):
        self.value, self.quoted, self.place, self.pair = value, quoted, place, pair
        self._strongest = max(part.strongest() for part in pair) if pair else None

    def strongest(self) -> float:
        """The highest score among the places that it is made of."""
        if self._strongest is None:
            self._strongest = literal_score(self.value, True)
        return self._strongest

    def then(self, other: Literal) -> Literal:
        """Both one after the other."""
        whole = None
        if (self.value is not None and other.value is not None
                and len(self.value) + len(other.value) <= LITERAL):
            whole = self.value + other.value
        return Literal(whole, True, pair=(self, other))

    def score(self) -> float:
        return self.strongest() if self.value is None else literal_score(self.value, self.quoted)

    def places(self, seen: set[Literal]) -> Iterator[tuple[int, int]]:
        """The places that it is made of, without what ``seen`` has, to which they are added."""
        waiting = [self]
        while waiting:
            part = waiting.pop()
            if part not in seen:
                seen.add(part)
                if part.pair:
                    waiting.extend(part.pair)
                else:
                    yield part.place


class Lexer:
    """One pass over a text: assignments in order, with the constants known so far."""

    def __init__(self, text: str):
        self.text = text
        self.constants: dict[str, Literal] = {}

    def assignments(self):
        """``(name, Literal)`` for each assignment whose value resolves to a literal."""
        text, taken = self.text, 0
        for found in OPERATOR.finditer(text):
            at = found.start()
            if at < taken:
                continue
            operator = found.group()
            if operator == "--":
                option = OPTION.match(text, at)
                name, start = (option.group(1), option.end()) if option else ("", at)
            elif operator == "</":
                yield from self._element(at)
                continue
            else:
                name, start = self._name_before(at), GAP.match(text, found.end()).end()
            if not name or text.startswith("//", start):
                continue
            literal, end = self._expression(start)
            taken = max(taken, end)  # a word that is called has no literal in its rest either
            if literal is None:
                continue
            self.constants[name] = literal
            yield name, literal

    def _name_before(self, end: int) -> str:
        text = self.text
        while end > 0 and text[end - 1] in " \t":
            end -= 1
        closing = ""
        while end > 0 and text[end - 1] in "\"'`]":
            closing, end = closing + text[end - 1], end - 1
        start = end
        while start > 0 and text[start - 1] in NAME_SIGNS:
            start -= 1
        name = text[start:end].strip(".-")
        if start > 0 and text[start - 1] == "!" and not closing:
            return ""
        return name if any(c.isalpha() for c in name) else ""

    def _element(self, at: int):
        """``<name ...>literal</name>`` that ends at ``at``."""
        start = at
        while start > 0 and self.text[start - 1] not in "<>\n":
            start -= 1
        close = re.compile(r"</([\w.:-]+)>").match(self.text, at)
        if close and start > 0 and self.text[start - 1] == ">":
            opened = self.text.rfind("<", 0, start)
            value = self.text[start:at].strip()
            if value and self.text.startswith(close.group(1), opened + 1):
                begin = self.text.index(value, start)
                yield close.group(1), Literal(value, False, (begin, begin + len(value)))

    def _operand(self, at: int) -> tuple[Literal | None, int, bool]:
        """The literal at a place, where it ends, and whether it is a part of an expression."""
        quoted = QUOTED.match(self.text, at)
        if quoted:
            group = quoted.lastindex
            return Literal(quoted.group(group), True, quoted.span(group)), quoted.end(), True
        bare = BARE.match(self.text, at)
        if not bare:
            return None, at, False
        word, end = bare.group(), bare.end()
        if word.rstrip(".") in self.constants:
            return self.constants[word.rstrip(".")], end, True
        if self.text.startswith(("(", "["), end):
            return None, end, False
        return Literal(word, False, (at, end)), end, False

    def _expression(self, at: int) -> tuple[Literal | None, int]:
        whole, end, joins = self._operand(at)
        while whole and joins and whole.quoted and (joint := JOINT.match(self.text, end)):
            part, after, known = self._operand(joint.end())
            if part is None or not known:
                break
            whole, end = whole.then(part), after
        return whole, end


def base_spans(text: str) -> list[Span]:
    """Matches of the plain patterns, leftmost and without overlap in each kind."""
    found = [Span("assign", *m.span(), m.start(2), m.group(1), 1.0)
             for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [Span("access", *m.span(), m.start(), "", 1.0) for m in ACCESS.finditer(text)]
    found += [Span("hex", *m.span(), m.start(), "", 1.0) for m in HEX.finditer(text)]
    return found


def lexed_spans(text: str, base: list[Span], threshold: float = THRESHOLD) -> list[Span]:
    """Literals of sensitive names that no base span holds.

    The strongest names come first, so each part of a literal is looked at once.
    """
    judged = []
    for name, literal in Lexer(text).assignments():
        sensitive = name_score(name)
        if sensitive and (score := sensitive * literal.score()) >= threshold:
            judged.append((score, name, literal))
    base = sorted(base, key=lambda span: span.start)
    starts = [span.start for span in base]
    reach = list(accumulate((span.end for span in base), max))  # furthest end so far
    best: dict[tuple[int, int], Span] = {}
    seen: set[Literal] = set()
    for score, name, literal in sorted(judged, key=lambda found: -found[0]):
        for start, end in literal.places(seen):
            before = bisect_right(starts, start)
            if start < end and (start, end) not in best and not (
                    before and reach[before - 1] >= end):
                best[start, end] = Span("lexed", start, end, start, name, score)
    return list(best.values())


def secret_spans(text: str | None) -> list[Span]:
    """All finds of a text by start, then kind in the order of ``KINDS``; offsets count code
    points."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + lexed_spans(text, base), key=lambda s: (s.start, KINDS.index(s.kind),
                                                                s.end))


def _scan():
    def run(batch: pa.RecordBatch):
        return [[[s._asdict() for s in secret_spans(t)] for t in batch.column("text").to_pylist()]]

    return run


def find_secrets(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and ``secrets``, its finds.

    Null and empty texts have none; other columns are not read; repeated rows are scanned each.
    """
    rows = documents.select(*dict.fromkeys((*keep, "text")))
    return map_batches(rows, _scan, f"secrets {FOUND}", keep=keep)


def _digest():
    def run(batch: pa.RecordBatch):
        counts, digests, everything = [[], [], []], [], []
        for spans in batch.column("secrets").to_pylist():
            named = [(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in spans or []]
            for kind, into in zip(KINDS, counts):
                into.append(sum(k == kind for k, _ in named))
            base = ",".join(text for kind, text in named if kind != "lexed")
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            everything.append(",".join(text for _, text in named))
        return [*counts, digests, everything]

    return run


def scan_report(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``; see ``find_secrets``."""
    return map_batches(find_secrets(documents), _digest,
                       "n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
                       keep=("doc_id",))


def masked(text: str, spans: list) -> str:
    """The text with every secret replaced; the names and signs before it stay."""
    out, at = [], 0
    for start, end in sorted({(s["value"], s["end"]) for s in spans}):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def _mask():
    def run(batch: pa.RecordBatch):
        return [[masked(t, [s._asdict() for s in spans]) if (spans := secret_spans(t)) else t
                 for t in batch.column("text").to_pylist()]]

    return run


def mask_secrets(documents: DataFrame) -> DataFrame:
    """The same rows and columns with secrets replaced in ``text``; ``n_chars`` follows where it
    is a column and the text changed."""
    packed = documents.select(F.struct("*").alias("row"), "text")
    done = map_batches(packed, _mask, "clean string", keep=("row",))
    changed = ~F.col("clean").eqNullSafe(F.col("row.text"))
    columns = [F.col("clean").alias(c) if c == "text" else
               F.when(changed, F.length("clean").cast(documents.schema[c].dataType))
               .otherwise(F.col("row.n_chars")).alias(c) if c == "n_chars" else
               F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    return done.select(*columns)


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return scan_report(read_table(spark, sf_dir, "documents"))
