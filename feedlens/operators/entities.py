"""Speakers, companies and places named in a text, found with a gazetteer.

Keeps the contract of a hosted extraction function (one name or null per kind); it finds what the
gazetteer lists and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.text import phrase_key, runs_from, terms, word_windows
from feedlens.schema import ENTITY_KINDS
from feedlens.session import BROADCAST_BYTES, Measured, materialize

RANK_BITS = 32


@dataclass(frozen=True)
class Phrases:
    """A gazetteer laid out by prefixes, all tables with unique keys and small enough to broadcast.

    ``starts``: first words, and whether such a word is a phrase by itself. ``prefixes``: the first
    two words of longer phrases, and the numbers of words that those have. ``ranks``: a phrase's
    rank per kind, by more words first, then name. ``names``: what a kind's rank stands for.
    """

    starts: DataFrame
    prefixes: DataFrame
    ranks: DataFrame
    names: DataFrame


@dataclass(frozen=True)
class Gazetteer(Measured):
    """A stored gazetteer, the words in its longest phrase, and the rows left out of it."""

    longest: int
    rejected: int

    @cached_property
    def phrases(self) -> Phrases:
        """The tables for looking phrases up within a task; for gazetteers that fit."""
        size = F.size(F.split("phrase", " "))
        order = Window.partitionBy("kind").orderBy(F.desc("words"), "name", "phrase")
        ranked = materialize(
            self.table.select("phrase", "kind", "name", size.alias("words"),
                              F.get(F.split("phrase", " "), F.lit(0)).alias("w0"),
                              F.get(F.split("phrase", " "), F.lit(1)).alias("w1"))
            .withColumn("rank", F.row_number().over(order).cast("bigint")), "phrases").table
        return Phrases(
            ranked.groupBy("w0").agg(F.max(F.col("words") == 1).alias("alone")),
            ranked.filter("words > 1").groupBy("w0", "w1")
            .agg(F.sort_array(F.collect_set("words")).alias("sizes")),
            ranked.groupBy("phrase").agg(*[
                F.min(F.when(F.col("kind") == kind, F.col("rank"))).alias(kind)
                for kind in ENTITY_KINDS]),
            ranked.select("kind", "rank", "name"))


def prepare_gazetteer(gazetteer: DataFrame) -> Gazetteer:
    """``phrase``, ``kind`` and ``name`` with phrases in matching form, each row once.

    Rows whose phrase has no term cannot be matched; they are left out and counted.
    """
    keyed = materialize(gazetteer.select(phrase_key(F.col("phrase")).alias("phrase"), "kind",
                                         "name"), "gazetteer")
    usable = F.col("phrase") != ""
    found = keyed.table.agg(
        F.max(F.when(usable, F.size(F.split("phrase", " ")))).alias("longest"),
        F.count_if(~usable).alias("rejected")).first()
    return Gazetteer(keyed.table.filter(usable).distinct(), keyed.bytes, found["longest"] or 1,
                     found["rejected"])


def with_phrases(placed: DataFrame, phrases: Phrases, how: str) -> DataFrame:
    """Rows of ``words`` (an item's terms), ``pos`` (from 1) and ``term`` with phrase ranks.

    A row is repeated for each number of words that phrases with its first two words have, at most
    as often as there are different lengths; ``nth`` counts the repeats from 0. All look-ups are
    broadcast, so rows stay where they are. With ``how`` as ``left`` rows without a phrase stay.
    """
    starts = F.broadcast(phrases.starts.withColumnRenamed("w0", "term"))
    second = F.get("words", F.col("pos")).alias("w1")
    found = placed.join(starts, "term", how).withColumn(
        "w1", F.when(F.col("alone").isNotNull(), second))
    prefixes = F.broadcast(phrases.prefixes.withColumnRenamed("w0", "term"))
    none = F.array().cast("array<int>")
    sizes = F.concat(F.when(F.col("alone"), F.array(F.lit(1))).otherwise(none),
                     F.coalesce("sizes", none))
    found = found.join(prefixes, ["term", "w1"], "left").withColumn("sizes", sizes)
    explode = F.posexplode_outer if how == "left" else F.posexplode
    found = found.select(*placed.columns, explode("sizes").alias("nth", "size"))
    phrase = F.array_join(F.slice("words", F.col("pos"), F.col("size")), " ")
    return found.withColumn("phrase", phrase).join(F.broadcast(phrases.ranks), "phrase", how)


def first_places() -> list[Column]:
    """Aggregates: per kind the earliest place and, among equal ones, the lowest rank."""
    place = F.shiftleft(F.col("pos").cast("bigint"), RANK_BITS)
    return [F.min(F.when(F.col(kind).isNotNull(), place + F.col(kind))).alias(kind)
            for kind in ENTITY_KINDS]


def named_places(found: DataFrame, phrases: Phrases) -> DataFrame:
    """The columns per kind from places to names; one broadcast look-up per kind."""
    for kind in ENTITY_KINDS:
        names = phrases.names.filter(F.col("kind") == kind).select(
            F.col("rank").alias("_rank"), F.col("name").alias("_name"))
        rank = F.col(kind).bitwiseAND(F.lit((1 << RANK_BITS) - 1))
        found = (found.join(F.broadcast(names), rank == F.col("_rank"), "left")
                 .withColumn(kind, F.col("_name")).drop("_rank", "_name"))
    return found


def match_entities(items: DataFrame, gazetteer: Gazetteer,
                   limit: int = BROADCAST_BYTES) -> DataFrame:
    """``item_id`` and one column per kind, for the items that name anything.

    The earliest phrase of a kind wins, then the longest, then the smaller name. ``gazetteer`` is
    a prepared one. Phrases are only put together where the first two words of one stand, in the
    lengths that such phrases have. A gazetteer too large to broadcast is joined with a shuffle,
    in which AQE cuts the partitions of hot phrases, with all runs up to its longest phrase.
    """
    words = items.select("item_id", terms(F.col("text")).alias("words"))
    if gazetteer.fits(limit):
        placed = words.select("item_id", "words", F.posexplode("words").alias("at", "term"))
        placed = placed.select("item_id", "words", (F.col("at") + 1).alias("pos"), "term")
        found = with_phrases(placed, gazetteer.phrases, "inner")
        return named_places(found.groupBy("item_id").agg(*first_places()), gazetteer.phrases)
    longest = gazetteer.longest
    windows = (words.select("item_id", F.posexplode(word_windows(F.col("words"), longest)))
               .select("item_id", "pos", "col.*"))
    runs = windows.select("item_id", "pos", F.inline(runs_from(longest)))
    found = runs.join(gazetteer.table, "phrase")
    place = F.struct("pos", (-F.col("words")).alias("words"), "name")
    return (found.groupBy("item_id")
            .agg(*[F.min(F.when(F.col("kind") == kind, place)).alias(kind)
                   for kind in ENTITY_KINDS])
            .select("item_id", *[F.col(f"{kind}.name").alias(kind) for kind in ENTITY_KINDS]))
