"""What the operators of this package share: input tables, stored tables, Arrow batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.session import scratch_path, short_batches


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends in lasting storage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    jvm = spark._jvm
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id gives 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus, F.lit(0))


def map_batches(rows: DataFrame, make: Callable[[], Callable], schema: T.StructType | str,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Apply a function to Arrow batches of ``rows``.

    ``make`` runs once per task and returns a function from a record batch to a list of columns
    (lists or arrays), in the order of ``schema``. The columns named in ``keep`` are passed on as
    they are, in front of those.
    """
    added = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([rows.schema[name] for name in keep] + list(added.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(added)
        target = to_arrow_schema(whole)
        function = make()
        for batch in batches:
            for part in bounded(batch):
                made = function(part)
                columns = [part.column(name) for name in keep]
                columns += [pa.array(values, type=field.type)
                            for values, field in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, target, strict=True)],
                    schema=target)

    short_batches(rows.sparkSession)
    return rows.mapInArrow(run, whole)


def bounded(batch: pa.RecordBatch, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes, one row at least."""
    step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def flat_batches(rows: DataFrame, make: Callable[[], Callable],
                 schema: T.StructType | str) -> DataFrame:
    """Like ``map_batches``, for functions that return any number of rows (lists of columns)."""
    whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(whole)
        function = make()
        for batch in batches:
            for part in bounded(batch):
                made = function(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, type=field.type)
                     for values, field in zip(made, target, strict=True)], schema=target)

    short_batches(rows.sparkSession)
    return rows.mapInArrow(run, whole)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class WordCodes(dict):
    """Word to 64-bit code, remembered while the number of words stays bounded."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
