"""Text columns: blank checks, markup clean-up, terms and phrases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: markup patterns of feed texts and what replaces them -------------------------
HASHTAG = (r"\{hashtag\|\\?#\|([^}]*)\}", "#$1")
MENTION = (r"@\[([^\]]+)\]\(urn:li:[^)]+\)", "@$1")
ESCAPED = (r"\\([\\()\[\]{}@#*_~<>|])", "$1")
# ---- end of fixed values ------------------------------------------------------------------------

TERM = r"[\p{L}\p{M}\p{N}]+"
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.trim(text, F.lit(WHITE_SPACE))


def has_text(text: Column) -> Column:
    """True where there is something besides white space; false for null."""
    return F.coalesce(F.ltrim(text, F.lit(WHITE_SPACE)) != "", F.lit(False))


def clean_markup(text: Column) -> Column:
    """Hashtag and mention markup to plain ``#tag`` and ``@Name``, escapes undone, ends stripped."""
    for pattern, replacement in (HASHTAG, MENTION, ESCAPED):
        text = F.regexp_replace(text, pattern, replacement)
    return strip(text)


def terms(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits of any script, in order; empty for null.

    An apostrophe parts terms, so "I'm" has two. Accents written as marks stay in their term.
    """
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def phrase_key(text: Column) -> Column:
    """The terms of a phrase joined by one blank, the form that phrases are matched in."""
    return F.array_join(terms(text), " ")


def word_windows(words: Column, longest: int) -> Column:
    """For each word the struct ``w0, w1, ...`` of it and the ``longest - 1`` words after it.

    Made by zipping ``words`` with copies of itself moved by one word each.
    """
    return F.arrays_zip(words.alias("w0"), *[
        F.slice(words, F.lit(k + 1), F.size(words)).alias(f"w{k}") for k in range(1, longest)])


def runs_from(longest: int) -> Column:
    """``array<struct<words, phrase>>`` of the phrases of 1 to ``longest`` words from ``w0`` on."""
    return F.array(*[
        F.struct(F.lit(n).alias("words"),
                 F.when(F.col(f"w{n - 1}").isNotNull(),
                        F.concat_ws(" ", *[f"w{k}" for k in range(n)])).alias("phrase"))
        for n in range(1, longest + 1)])


def mask(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, pattern, replacement)
