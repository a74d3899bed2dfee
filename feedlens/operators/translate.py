"""English texts from a translation memory.

Keeps the contract of a hosted translation function as far as the memory goes: a text that it does
not hold has no translation and is listed as pending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.session import BROADCAST_BYTES, Measured, lookup_join, measured

MEMORY_KEY = ["lang", "text_hash"]


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def is_english() -> Column:
    return F.coalesce(F.col("lang") == "en", F.lit(False))


def translate(items: DataFrame, memory: DataFrame | Measured, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``items`` with ``text_en``: English as it is, the rest from the memory or null.

    ``memory`` has ``lang``, ``text_hash`` and ``text_en``; of several translations of one text the
    smallest counts, and rows in English are not used.
    Of a memory too large to be sent to the items, its keys are sent, where these fit, and only
    items with a translation move. English items never look anything up, so copies of one English
    text do not meet in one task.
    """
    keyed = items.withColumn("text_hash", F.when(~is_english(), text_hash(F.col("text"))))
    memory = measured(memory)
    usable = memory.table.filter(F.col("lang") != "en")
    known = usable.groupBy(*MEMORY_KEY).agg(F.min("text_en").alias("_found"))
    asking, rest = keyed, []
    if not memory.fits(limit):
        own = F.when(is_english(), F.col("text"))
        asking = keyed.filter(~is_english())
        rest = [keyed.filter(is_english()).withColumn("_found", own)]
        keys = measured(usable.select(*MEMORY_KEY).distinct())
        if keys.fits(limit):
            held = F.broadcast(keys.table)
            rest.append(asking.join(held, MEMORY_KEY, "left_anti").withColumn("_found", own))
            asking = asking.join(held, MEMORY_KEY, "left_semi")
    found = lookup_join(asking, Measured(known, memory.bytes), MEMORY_KEY, "left", limit)
    for rows in rest:
        found = found.unionByName(rows)
    return (found.withColumn("text_en", F.when(is_english(), F.col("text"))
                             .otherwise(F.col("_found"))).select(*items.columns, "text_en"))


def pending_translations(items: DataFrame, memory: DataFrame) -> DataFrame:
    """Texts to translate, each once, with the number of items that wait for it."""
    texts = (items.filter(~is_english() & F.col("text").isNotNull())
             .groupBy("lang", text_hash(F.col("text")).alias("text_hash"))
             .agg(F.count("*").alias("items"), F.min("text").alias("text")))
    return texts.join(memory.select(*MEMORY_KEY), MEMORY_KEY, "left_anti")
