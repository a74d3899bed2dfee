"""Batch inference with a function of the caller's, the one place where Python sees the texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import lookup_join, materialize, short_batches

ANSWERS = "prompt_hash STRING, reply STRING, error STRING, failed BOOLEAN"


def infer(items: DataFrame, load: Callable[[], Callable[[pd.Series], pd.Series]],
          prompt: str = "", column: str = "reply", partitions: int | None = None) -> DataFrame:
    """``items`` with ``column``: the reply to ``prompt`` followed by the text, for every row.

    ``load`` runs once per task and returns the function that answers a batch of prompts. Only
    the prompts go to Python, some 2,000 at a time; the other columns stay where they are.
    ``partitions`` bounds how many tasks, and so how many clients of a service, run at once.
    """
    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reply = load()
        for batch in batches:
            yield reply(batch)

    answer = answer.asNondeterministic()  # else a filter on the reply asks the model once more
    short_batches(items.sparkSession)
    if partitions is not None:
        items = items.repartition(partitions)
    return items.withColumn(column, answer(F.concat(F.lit(prompt), F.col("text"))))


def answers(spark: SparkSession, path: str) -> DataFrame:
    """``prompt_hash`` and ``reply`` of every prompt answered so far, each once."""
    rows = spark.read.schema(ANSWERS).parquet(path).filter(~F.col("failed"))
    return rows.groupBy("prompt_hash").agg(F.min("reply").alias("reply"))


def failures(spark: SparkSession, path: str) -> DataFrame:
    """Prompts that failed and have no answer yet, with one of their errors."""
    rows = spark.read.schema(ANSWERS).parquet(path).filter("failed")
    failed = rows.groupBy("prompt_hash").agg(F.min("error").alias("error"))
    return failed.join(answers(spark, path), "prompt_hash", "left_anti")


def infer_once(items: DataFrame, load: Callable[[], Callable[[pd.Series], pd.Series]], path: str,
               prompt: str = "", column: str = "reply",
               partitions: int | None = None) -> DataFrame:
    """Like ``infer``, with one call per distinct prompt, ever.

    ``path`` is a folder of answers, kept by the hash of the prompt: prompts answered in an earlier
    run are not asked again, copies of a text are asked once, and new answers are appended. Where a
    batch of prompts fails, its prompts are asked one by one; those that fail again are kept apart
    with their error, have a null reply, and are asked again by the next run. A row without text
    has no prompt and a null reply.
    """
    @F.pandas_udf("reply STRING, error STRING")
    def asked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reply = load()

        def alone(one: str) -> tuple[str | None, str | None]:
            try:
                return reply(pd.Series([one])).iloc[0], None
            except Exception as error:
                return None, f"{type(error).__name__}: {error}"[:1000]

        for batch in batches:
            try:
                got = pd.DataFrame({"reply": list(reply(batch)), "error": None})
            except Exception:
                got = pd.DataFrame([alone(one) for one in batch], columns=["reply", "error"])
            yield got

    spark = items.sparkSession
    spark.createDataFrame([], ANSWERS).coalesce(1).write.mode("ignore").partitionBy("failed") \
        .parquet(path)
    whole = F.concat(F.lit(prompt), F.col("text"))
    keyed = items.withColumn("_prompt", F.sha2(whole, 256))
    open_ = (keyed.filter("_prompt IS NOT NULL").groupBy(F.col("_prompt").alias("prompt_hash"))
             .agg(F.min(whole).alias("prompt"))
             .join(answers(spark, path), "prompt_hash", "left_anti"))
    open_ = materialize(open_, "prompts").table
    if partitions is not None:
        open_ = open_.repartition(partitions)
    short_batches(spark)
    got = open_.select("prompt_hash", asked.asNondeterministic()("prompt").alias("a"))
    (got.select("prompt_hash", "a.reply", "a.error", F.col("a.error").isNotNull().alias("failed"))
     .write.mode("append").partitionBy("failed").parquet(path))
    known = materialize(answers(spark, path).select(
        F.col("prompt_hash").alias("_prompt"), F.col("reply").alias(column)), "answers")
    return lookup_join(keyed, known, ["_prompt"], "left").drop("_prompt")
