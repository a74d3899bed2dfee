"""Session checks, shared scratch tables and the size check behind every broadcast."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 192 << 20
BATCH_ROWS = 2000
PACKED = {"compression": "zstd"}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session up for feed jobs: UTC times, and AQE with skewed joins split at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Where it is unset, a local session, which is one process, gets a temporary folder; on a
    cluster that is an error, because executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return _temporary_dir(spark.sparkContext.applicationId)


@cache
def _temporary_dir(application: str) -> str:
    path = tempfile.mkdtemp(prefix="feedlens-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/feedlens/{name}-{uuid.uuid4().hex}"


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Fewer rows in an Arrow batch than by default: rows here hold whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def row_bytes(table: DataFrame) -> Column:
    """Size of a row in memory, about: text by its length, numbers by 8 bytes each."""
    size = F.lit(0)
    for field in table.schema:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            part = F.octet_length(name) + 8
        elif (isinstance(field.dataType, T.ArrayType)
              and isinstance(field.dataType.elementType, T.NumericType)):
            part = 8 * F.size(name) + 24
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            part = 4 * F.octet_length(F.to_json(F.struct(name)))
        else:
            part = F.lit(8)
        size = size + F.coalesce(part, F.lit(8))
    return size


@dataclass(frozen=True)
class Measured:
    """A table and the bytes that its rows take."""

    table: DataFrame
    bytes: int

    def fits(self, limit: int = BROADCAST_BYTES) -> bool:
        """Whether it may be broadcast."""
        return self.bytes <= limit


def measured(table: DataFrame | Measured) -> Measured:
    """Measure a table with one aggregate over it; best handed a stored one."""
    if isinstance(table, Measured):
        return table
    size = table.agg(F.sum(row_bytes(table)).alias("bytes")).first()["bytes"]
    return Measured(table, size or 0)


def materialize(df: DataFrame, name: str) -> Measured:
    """Write ``df`` to the shared folder and read it back, measured on the way.

    Cuts the lineage in storage that outlives any executor, so that a table used more than once
    (a learned model) is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    size = Observation()
    df.observe(size, F.sum(row_bytes(df)).alias("bytes")).write.options(**PACKED).parquet(path)
    return Measured(spark.read.schema(df.schema).parquet(path), size.get["bytes"] or 0)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for listing, removing and renaming folders."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library made."""
    files, where = hadoop_path(spark, path)
    files.delete(where, True)


def literal_path(path: str) -> str:
    """A path with the signs of glob patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def lookup_join(rows: DataFrame, lookup: DataFrame | Measured, on: list[str], how: str = "inner",
                limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join many rows to a look-up table whose keys may be hot in ``rows``.

    A table measured to be small is broadcast, so ``rows`` do not move. A larger one is joined
    with a shuffle of both sides, where AQE cuts the partition of a hot key into many tasks;
    that needs the table to be stored, not the result of an aggregate on the same key.
    """
    lookup = measured(lookup)
    table = F.broadcast(lookup.table) if lookup.fits(limit) else lookup.table
    return rows.join(table, on, how)
