"""One label per text: by term lists, or by Naive Bayes counted from labelled texts.

Keeps the contract of a hosted classifier (one of the given labels); not a model's judgement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import terms
from feedlens.operators.scoring import ONCE, TermWeights, best_label, combine, score_items
from feedlens.session import materialize

LOG_SCALE = 1_000_000


def list_weights(label_terms: DataFrame, labels: Sequence[str]) -> TermWeights:
    """Weights of 1 from rows of ``label`` and ``term``; repeated rows count once."""
    table = label_terms.groupBy("term").agg(*[
        F.max(F.when(F.col("label") == label, 1).otherwise(0)).cast("bigint").alias(f"w{i}")
        for i, label in enumerate(labels)])
    weights = F.array(*[F.col(f"w{i}") for i in range(len(labels))])
    return TermWeights(table.select("term", weights.alias("weights")), tuple(labels))


def count_terms(labelled: DataFrame, labels: Sequence[str]) -> DataFrame:
    """How many terms of each label's texts are which: ``term`` and ``n0, n1, ...``, one per label.

    The empty term counts the texts. Counts of several sets of rows add up, see ``add_counts``.
    """
    rows = labelled.select("label", F.explode(
        F.concat(F.array(F.lit(ONCE)), terms(F.col("text")))).alias("term"))
    return rows.groupBy("term").agg(*[F.count_if(F.col("label") == label).alias(f"n{i}")
                                      for i, label in enumerate(labels)])


def add_counts(counts: DataFrame, more: DataFrame) -> DataFrame:
    """Two tables of ``count_terms`` as one: a new batch is counted by itself, and the history is
    not read again."""
    slots = [c for c in counts.columns if c != "term"]
    return counts.unionByName(more).groupBy("term").agg(*[F.sum(c).alias(c) for c in slots])


def learn_bayes(labelled: DataFrame, labels: Sequence[str], smoothing: int = 1) -> TermWeights:
    """Multinomial Naive Bayes from rows of ``item_id``, ``text`` and ``label``."""
    return bayes_from_counts(count_terms(labelled, labels), labels, smoothing)


def bayes_from_counts(counted: DataFrame, labels: Sequence[str], smoothing: int = 1) -> TermWeights:
    """Multinomial Naive Bayes from the counts of ``count_terms``.

    Weights are log-probabilities times a million, rounded. The empty term holds the priors.
    """
    counts = materialize(counted, "bayes").table
    once = F.col("term") == ONCE
    slots = [f"n{i}" for i in range(len(labels))]
    sizes = counts.agg(
        F.count_if(~once).alias("terms"),
        F.coalesce(F.sum(F.when(once, sum(F.col(n) for n in slots))), F.lit(0)).alias("items"),
        *[F.coalesce(F.sum(F.when(~once, F.col(n))), F.lit(0)).alias(n) for n in slots]).first()

    def weight(i: int):
        size = F.when(once, F.lit(sizes["items"] + smoothing * len(labels))).otherwise(
            F.lit(sizes[f"n{i}"] + smoothing * sizes["terms"]))
        share = (F.col(f"n{i}") + smoothing) / size
        return F.round(LOG_SCALE * F.ln(share)).cast("bigint")

    table = counts.select("term", F.array(*[weight(i) for i in range(len(labels))])
                          .alias("weights"))
    return TermWeights(table, tuple(labels))


def classify(items: DataFrame, weights: TermWeights, default: str | None = None,
             need_hit: bool = False) -> DataFrame:
    """``item_id`` and ``label`` of every item."""
    scored = score_items(items, combine({"score": weights}))
    return scored.select("item_id", best_label(F.col("score"), weights.labels, default, need_hit)
                         .alias("label"))


def fill_language(items: DataFrame, weights: TermWeights) -> DataFrame:
    """The feed with ``lang`` filled by the classifier where it is missing."""
    unknown = items.filter(F.col("lang").isNull())
    found = classify(unknown, weights).withColumnRenamed("label", "_lang")
    return (items.join(found, "item_id", "left")
            .withColumn("lang", F.coalesce("lang", "_lang")).drop("_lang"))
