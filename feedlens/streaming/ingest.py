"""The pipeline on a stream of arriving files.

The stream only says which files are new, each once. What a file holds is read, merged and
enriched by the same functions as in a batch run. The store gives each micro-batch a number for
the pair of the stream's own id and the micro-batch's, so streams, lost checkpoints and batch runs
never meet in one folder.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedlens.operators.enrich import Enrichment
from feedlens.operators.normalize import normalize
from feedlens.plans.runs import run_bronze, run_gold, run_silver
from feedlens.schema import FeedConfig
from feedlens.sources.files import DROP_GLOB, read_paths
from feedlens.sources.store import FeedStore


def new_files(store: FeedStore, folder: str, files_per_batch: int) -> DataFrame:
    """Stream of the paths of arriving files; their content is not read here."""
    fields = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    return (store.spark.readStream.format("binaryFile").schema(fields)
            .option("pathGlobFilter", DROP_GLOB).option("maxFilesPerTrigger", files_per_batch)
            .load(folder).select("path"))


def run_stream(store: FeedStore, folder: str, config: FeedConfig, as_of: datetime | Column,
               checkpoint: str, using: Enrichment | None = None,
               files_per_batch: int = 1000) -> StreamingQuery:
    """Take in every file that is there and stop; the next call goes on after it.

    Without ``using`` only Bronze is filled; a later run with it catches up. A micro-batch that
    failed half-way is run again under the same number and goes on with what it lacks.
    """
    store.create()

    def take_in(files: DataFrame, micro_batch: int) -> None:
        stream = files.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("a micro-batch runs inside a streaming query")
        batch = store.claim(f"{stream}/{micro_batch}")
        # At most files_per_batch names; a micro-batch knows them on the driver anyway.
        paths = sorted(row["path"] for row in files.collect())
        incoming = normalize(read_paths(store.spark, paths), config, as_of)
        run_bronze(store, incoming, batch, as_of)
        if using is not None:
            run_silver(store, using, batch)
            run_gold(store, batch)

    return (new_files(store, folder, files_per_batch).writeStream.foreachBatch(take_in)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
