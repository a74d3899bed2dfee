"""Suggested actions: read from a model's reply, or looked up in a rule list."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.schema import BUCKETS

REPLY_OBJECT = r"(?s)\{.*\}"
DEFAULT_BUCKET = "monitor"
DEFAULT_ACTION = "No action needed"


class Rule(NamedTuple):
    """Empty ``topics`` or ``sentiments`` match anything."""

    topics: tuple[str, ...]
    sentiments: tuple[str, ...]
    bucket: str
    action: str


DEFAULT_RULES = (
    Rule(("sponsor & lead signal",), (), "follow_up", "Contact the author about working together"),
    Rule(("networking & hiring",), (), "follow_up", "Reply and make the introduction"),
    Rule(("logistics",), ("negative", "mixed"), "fix_ops", "Tell the venue team and fix it today"),
    Rule(("session complaint",), (), "fix_ops", "Tell the session host and answer the author"),
    Rule(("session praise",), ("neutral",), "content", "Send the slides and the recording"),
    Rule((), ("positive",), "amplify", "Thank the author and share the post"),
)


def known_bucket(bucket: Column) -> Column:
    """Null unless it is one of the five buckets."""
    return F.when(bucket.isin(*BUCKETS), bucket)


def parse_reply(reply: Column) -> tuple[Column, Column]:
    """Bucket and action from a reply: the text from the first ``{`` to the last ``}``, as JSON.

    Both are null where that is no JSON; a bucket outside the five is null as well.
    """
    body = F.regexp_extract(reply, REPLY_OBJECT, 0)
    return known_bucket(F.get_json_object(body, "$.bucket")), F.get_json_object(body, "$.action")


def suggest_action(topic: Column, sentiment: Column,
                   rules: Sequence[Rule] = DEFAULT_RULES) -> tuple[Column, Column]:
    """Bucket and action of the first rule that matches, else to monitor.

    The rules are a short list in the code, so they become one CASE expression and no join.
    """
    def choose(pick, default: str) -> Column:
        found = []
        for rule in rules:
            hit = F.lit(True)
            if rule.topics:
                hit = hit & topic.isin(*rule.topics)
            if rule.sentiments:
                hit = hit & sentiment.isin(*rule.sentiments)
            found.append(F.when(hit, F.lit(pick(rule))))
        return F.coalesce(*found, F.lit(default))

    return choose(lambda r: r.bucket, DEFAULT_BUCKET), choose(lambda r: r.action, DEFAULT_ACTION)
