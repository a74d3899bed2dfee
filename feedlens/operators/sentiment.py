"""Sentiment from a learned word list.

Keeps the output contract of a hosted sentiment function (four labels, one per item); it does not
claim a model's judgement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import terms
from feedlens.operators.scoring import TermWeights, combine, score_items
from feedlens.session import materialize

POLARITY = ("positive", "negative")
MIXED_PERCENT = 80


def learn_lexicon(rated: DataFrame, min_support: int = 1, min_weight: int = 0,
                  smoothing: int = 1) -> DataFrame:
    """``term`` and ``weight`` from rows of ``text`` and ``rating`` (positive or negative).

    The weight is 1000 times the smoothed log-odds of the term, rounded. Every term is kept unless
    the caller leaves out those seen less than ``min_support`` times, or with a weight below
    ``min_weight`` either way.
    """
    counts = materialize(
        rated.select("rating", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count_if(F.col("rating") == "positive").alias("pos"),
             F.count_if(F.col("rating") == "negative").alias("neg")), "lexicon").table
    totals = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                        F.count("*").alias("terms")).first()

    def log_share(side: str) -> Column:
        size = (totals[side] or 0) + smoothing * totals["terms"]
        return F.ln((F.col(side) + smoothing) / F.lit(size))

    weight = F.round(1000 * (log_share("pos") - log_share("neg"))).cast("bigint")
    return (counts.filter(F.col("pos") + F.col("neg") >= min_support)
            .select("term", weight.alias("weight"))
            .filter(F.abs("weight") >= min_weight))


def lexicon_weights(lexicon: DataFrame) -> TermWeights:
    """A word list with signed weights as two columns of positive ones."""
    zero = F.lit(0).cast("bigint")
    return TermWeights(
        lexicon.select("term", F.array(F.greatest("weight", zero),
                                       F.greatest(-F.col("weight"), zero)).alias("weights")),
        POLARITY)


def sentiment_of(scores: Column, mixed_percent: int = MIXED_PERCENT) -> Column:
    """No hit is neutral; both sides nearly equal is mixed; else the stronger side."""
    pos, neg = scores[0], scores[1]
    return (F.when(F.greatest(pos, neg) == 0, "neutral")
             .when(100 * F.least(pos, neg) >= mixed_percent * F.greatest(pos, neg), "mixed")
             .when(pos > neg, "positive").otherwise("negative"))


def score_sentiment(items: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``item_id``, both sums and the ``sentiment`` of every item."""
    scored = score_items(items, combine({"tone": lexicon_weights(lexicon)}))
    return scored.select("item_id", F.col("tone")[0].alias("pos_score"),
                         F.col("tone")[1].alias("neg_score"),
                         sentiment_of(F.col("tone")).alias("sentiment"))
