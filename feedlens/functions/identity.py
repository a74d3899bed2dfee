"""Keys and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.functions.text import has_text
from feedlens.schema import ORGANISATION_PREFIX


def surrogate_key(author: Column, text: Column) -> Column:
    """Key of an item that came without one; a missing author is left out of the digest."""
    return F.sha2(F.concat_ws("|", author, text), 256)


def pseudonym(author: Column, organisation_prefix: str = ORGANISATION_PREFIX) -> Column:
    """Organisations stay readable, members become 16 hex digits, a missing author stays null."""
    return (F.when(~has_text(author), F.lit(None).cast("string"))
             .when(author.startswith(organisation_prefix), author)
             .otherwise(F.substring(F.sha2(author, 256), 1, 16)))
