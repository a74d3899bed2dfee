"""Subword ids and exact token counts at every prefix.

The vocabulary is a byte-level BPE file of the ``tokenizers`` library, whose path is a parameter.
Ids come from a merge encoder over the same vocabulary (tests hold it against the library). The
counts of prefixes come from dynamic programming: the encoding of a prefix ends with one token,
and a token may follow another only if the two, encoded together, stay these two tokens. So each
prefix takes the one token that ends there and fits the prefix before it, and its count is that
one's plus 1; no prefix is encoded for itself.
"""

from __future__ import annotations

import json
import re
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import map_batches, read_table

# White space as Unicode's property has it; part of the fixed splitting pattern below.
WHITE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (
    0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# The pattern by which the vocabulary's library splits text before merging (fixed).
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
           rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
SPLIT = regex.compile(PATTERN)
RUN = re.compile(f"[{WHITE}]{{2,}}")
REMEMBERED = 800_000
LIMIT = 512


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones stand for
    themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens of a vocabulary file, and their merge encoder."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = byte_letters()
        self.ids = {bytes(letters[c] for c in token): i
                    for token, i in described["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        for token in self.special:
            self.ids.pop(token.encode(), None)
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.ids,
                                          special_tokens=self.special)
        self.special_split = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        self.size = max([*self.ids.values(), *self.special.values()]) + 1

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; special strings count as their tokens, as by the library's
        default."""
        text = text or ""
        allowed = set(self.special) if any(s in text for s in self.special) else set()
        return self.encoding.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())

    def encode_piece(self, piece: bytes) -> list[int]:
        return self.encoding.encode_single_piece(piece) if hasattr(
            self.encoding, "encode_single_piece") else self.encoding._encode_single_piece(piece)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PrefixCounter:
    """Token counts at every prefix (in code points) of pieces and texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids = vocabulary.ids
        self.starts = {token[:n] for token in self.ids for n in range(1, len(token) + 1)}
        self.follows: dict[tuple[int, int], bool] = {}
        self.bytes_of = {i: token for token, i in self.ids.items()}
        self.known: dict[str, bytes] = {}

    def fits(self, before: int, token: int) -> bool:
        """Whether the two tokens stay as they are when encoded together."""
        key = before, token
        answer = self.follows.get(key)
        if answer is None:
            if len(self.follows) > 4 * REMEMBERED:
                self.follows.clear()
            joined = self.bytes_of.get(before, b"") + self.bytes_of[token]
            expected = [token] if before < 0 else [before, token]
            answer = self.follows[key] = self.vocabulary.encode_piece(joined) == expected
        return answer

    def byte_counts(self, piece: bytes) -> list[int]:
        """Counts after each byte of a piece that the pattern leaves whole."""
        last, count = [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        ids, starts, fits, size = self.ids, self.starts, self.fits, len(piece)
        for at in range(size):
            before, fresh = last[at], count[at] + 1
            for end in range(at + 1, size + 1):
                part = piece[at:end]
                if part not in starts:
                    break
                token = ids.get(part)
                if token is not None and not count[end] and fits(before, token):
                    last[end], count[end] = token, fresh
        return count[1:]

    def piece_counts(self, piece: str) -> bytes:
        """32-bit counts after each code point of a piece, remembered while they are not many."""
        counts = self.known.get(piece)
        if counts is None:
            raw = piece.encode("utf-8", "surrogatepass")
            after = self.byte_counts(raw)
            if len(raw) != len(piece):
                ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in piece]) - 1
                after = [after[e] for e in ends]
            if piece in ("'re", "'ve", "'ll"):  # "'r" alone is split into two pieces
                after[1] = 2
            counts = np.array(after, np.uint32).tobytes()
            if len(piece) < 100:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = counts
        return counts

    def _plain(self, text: str) -> np.ndarray:
        pieces = SPLIT.findall(text)
        if not pieces:
            return np.empty(0, np.int64)
        parts = [self.known.get(p) or self.piece_counts(p) for p in pieces]
        flat = np.frombuffer(b"".join(parts), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        ends = np.cumsum(lengths)
        totals = flat[ends - 1]
        base = np.cumsum(totals) - totals
        flat += np.repeat(base, lengths)
        for run in RUN.finditer(text):
            # the splitting pattern cuts the last sign off a run that a word follows; a prefix
            # that ends with the run has it whole
            start, end = run.span()
            if end < len(text):
                whole = np.frombuffer(self.piece_counts(run.group())[-4:], np.uint32)[0]
                flat[end - 1] = (flat[start - 1] if start else 0) + whole
        return flat

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Tokens of ``text[:k]`` for k = 1 .. length."""
        text, out, base, at = text or "", [], 0, 0
        for found in self.vocabulary.special_split.finditer(text):
            counts = self._plain(text[at:found.end() - 1])
            plain = found.start() - at
            before = int(self._plain(text[at:found.start()])[-1]) if plain else 0
            out += [base + counts, np.array([base + before + 1])]
            base, at = base + before + 1, found.end()
        out.append(base + self._plain(text[at:]))
        return np.concatenate(out)


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(vocabulary(path))


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) + 1 if fitting.size else 0


def _count(path: str, budget: int, store: bool):
    def make():
        counter = prefix_counter(path)

        def run(batch: pa.RecordBatch):
            totals, cut, kept = [], [], []
            for text in batch.column("text").to_pylist():
                counts = counter.prefix_counts(text)
                totals.append(int(counts[-1]) if counts.size else 0)
                cut.append(longest_prefix(counts, budget))
                if store:
                    kept.append(counts.astype(np.int32))
            return [totals, cut] + [kept] * store

        return run

    return make


def token_counts(documents: DataFrame, path: str | None = None, budget: int = LIMIT,
                 store_prefixes: bool = False) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_tokens, over_limit, budget_chars``.

    ``budget_chars`` is the length of the longest prefix of at most ``budget`` tokens; with
    ``store_prefixes`` the array ``prefix_tokens`` has the count at every prefix. Null texts count
    as empty ones (0). Other columns are not read; repeated rows are counted each.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    extra = ", prefix_tokens array<int>" if store_prefixes else ""
    counted = map_batches(rows, _count(path or default_path(), budget, store_prefixes),
                          f"n_tokens long, budget_chars long{extra}", keep=("doc_id", "n_bytes"))
    over = (F.col("n_tokens") > budget).alias("over_limit")
    return counted.select("doc_id", "n_bytes", "n_tokens", over, "budget_chars",
                          *["prefix_tokens"] * store_prefixes)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(read_table(spark, sf_dir, "documents"), default_path(), LIMIT)
