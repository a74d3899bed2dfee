"""Classifiers kept as tables of term weights, and scoring a feed with them in one join.

A table has one row per term and an array with one whole-number weight per label. Whole numbers
make the sums exact, so a score does not depend on the order in which tasks finish. The empty
term carries a weight that each item gets once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import terms
from feedlens.session import BROADCAST_BYTES, Measured, materialize

ONCE = ""


@dataclass(frozen=True)
class TermWeights:
    """``table`` holds ``term`` (unique) and ``weights``, one for each of ``labels`` in order."""

    table: DataFrame
    labels: tuple[str, ...]


@dataclass(frozen=True)
class CombinedWeights:
    """Several classifiers side by side: a term's weights for all of them in one row.

    A classifier that does not know the term has null there.
    """

    stored: Measured
    widths: dict[str, int]


def combine(parts: Mapping[str, TermWeights]) -> CombinedWeights:
    """Put classifiers side by side, so that a feed is split into terms and joined once."""
    widths = {name: len(part.labels) for name, part in parts.items()}
    table = None
    for name, part in parts.items():
        rows = part.table.select("term", *[
            F.col("weights")[i].alias(f"{name}_{i}") for i in range(widths[name])])
        table = rows if table is None else table.unionByName(rows, allowMissingColumns=True)
    if len(parts) > 1:
        slots = [f"{name}_{i}" for name, width in widths.items() for i in range(width)]
        table = table.groupBy("term").agg(*[F.sum(slot).alias(slot) for slot in slots])
    table = table.select("term", *[
        F.when(F.col(f"{name}_0").isNotNull(),
               F.array(*[F.col(f"{name}_{i}") for i in range(width)])).alias(name)
        for name, width in widths.items()])
    return CombinedWeights(materialize(table, "weights"), widths)


def item_terms(items: DataFrame) -> DataFrame:
    """One row per term of an item's whole text, and one with the empty term."""
    with_once = F.concat(F.array(F.lit(ONCE)), terms(F.col("text")))
    return items.select("item_id", F.explode(with_once).alias("term"))


def frequent_weights(rows: DataFrame, weights: CombinedWeights, limit: int) -> DataFrame | None:
    """The most frequent terms of ``rows`` with their weights, null where a term has none.

    As many as ``limit`` bytes hold, cut between powers of two of the frequency; None if that is
    not one.
    """
    power = F.floor(F.log2(F.count("*"))).cast("int")
    counts = materialize(rows.groupBy("term").agg(power.alias("power")), "frequencies").table
    width = 8 + sum(24 + 8 * n for n in weights.widths.values())
    sizes = counts.groupBy("power").agg(F.sum(F.octet_length("term") + width).alias("bytes"))
    least, used = None, 0
    for row in sizes.orderBy(F.desc("power")).collect():  # a row per power of two, below 64
        used += row["bytes"]
        if used > limit:
            break
        least = row["power"]
    if least is None:
        return None
    frequent = counts.filter(F.col("power") >= least).select("term")
    return materialize(frequent.join(weights.stored.table, "term", "left"), "frequent").table


def score_items(items: DataFrame, weights: CombinedWeights,
                limit: int = BROADCAST_BYTES) -> DataFrame:
    """``item_id`` and one array of summed weights per classifier, for every item.

    Broadcast weights leave the terms where they are: all terms of an item are in one task, which
    adds them up before the only shuffle. Of weights too large for that, those of the terms most
    frequent in the items are broadcast, and only rows of the other terms are joined by term. Where
    no term fits, an item's equal terms are counted first, and AQE cuts the partitions of hot terms.
    """
    rows = item_terms(items)
    table = weights.stored.table
    whole = weights.stored.fits(limit)
    near = table if whole else frequent_weights(rows, weights, limit)

    def summed(hits: DataFrame, times: Column) -> DataFrame:
        return hits.groupBy("item_id").agg(
            *summed_weights(weights, lambda weight: times * weight))

    one = F.lit(1).cast("bigint")
    if near is None:
        counted = rows.groupBy("item_id", "term").agg(F.count("*").alias("n"))
        sums = summed(counted.join(table, "term", "left"), F.col("n"))
    else:
        sums = summed(rows.join(F.broadcast(near), "term", "left"), one)
    if near is not None and not whole:
        others = rows.join(F.broadcast(near.select("term")), "term", "left_anti")
        sums = sums.unionByName(summed(others.join(table, "term"), one))
        sums = sums.groupBy("item_id").agg(
            *[F.sum(c).alias(c) for c in sums.columns if c != "item_id"])
    return sums.select("item_id", *weight_arrays(weights))


def summed_weights(weights: CombinedWeights, counted: Callable[[Column], Column]) -> list[Column]:
    """Aggregates of the joined weights, one per classifier and label, 0 without any."""
    return [F.coalesce(F.sum(counted(F.col(name)[i])), F.lit(0).cast("bigint"))
            .alias(f"{name}_{i}") for name, width in weights.widths.items() for i in range(width)]


def weight_arrays(weights: CombinedWeights) -> list[Column]:
    """One array per classifier from the columns of ``summed_weights``."""
    return [F.array(*[F.col(f"{name}_{i}") for i in range(width)]).alias(name)
            for name, width in weights.widths.items()]


def best_label(scores: Column, labels: Sequence[str], default: str | None = None,
               need_hit: bool = False) -> Column:
    """The label with the highest score, the first of equal ones.

    With ``need_hit`` an item without any positive score gets ``default``.
    """
    names = F.array(*[F.lit(label) for label in labels])
    top = F.array_max(scores)
    label = F.element_at(names, F.array_position(scores, top).cast("int"))
    if need_hit:
        return F.when(top > 0, label).otherwise(F.lit(default).cast("string"))
    return label
