"""Drop folder of JSON, JSON-lines and CSV files."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.schema import RAW_SCHEMA
from feedlens.session import Measured, literal_path, lookup_join, materialize

JSON_SUFFIXES = (".json", ".jsonl")
CSV_SUFFIX = ".csv"
DROP_GLOB = "*.{json,jsonl,csv}"
REJECTED = T.StructField("rejected", T.StringType())
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"'}


def list_drop(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the feed files directly in ``folder``; only names are read."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", DROP_GLOB)
             .load(folder).select("path").collect())
    return sorted(row["path"] for row in found)


def read_json(spark: SparkSession, paths: list[str], rejects: bool = False) -> DataFrame:
    """A line that is no JSON, or a count that is no number, becomes null.

    With ``rejects`` the column ``rejected`` holds the line of such a row, else null.
    """
    if not rejects:
        return spark.read.schema(RAW_SCHEMA).json(paths)
    schema = T.StructType([*RAW_SCHEMA, REJECTED])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", REJECTED.name).json(paths)


def csv_headers(spark: SparkSession, paths: list[str]) -> Measured:
    """``file`` and ``header``, the first line of each CSV file that has one; one pass for all."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"))
    return materialize(lines.filter(F.col("start") == 0).groupBy("file")
                       .agg(F.min_by("value", "line").alias("header")), "headers")


def read_csv(spark: SparkSession, paths: list[str], rejects: bool = False) -> DataFrame:
    """CSV files by column name, in any order; missing columns are null, others are left out.

    A CSV scan goes by position. All files are one scan of as many columns as the widest has, and
    each row picks its columns by the header of its file; only distinct headers reach the driver.
    With ``rejects`` the column ``rejected`` holds the first cell that is no number where one is due.
    """
    headers = csv_headers(spark, paths)
    found = [r["header"] for r in headers.table.select("header").distinct().collect()]
    named = {line: [c.strip().lower() for c in next(csv.reader([line.lstrip("\ufeff")]), [])]
             for line in found}
    width = max(map(len, named.values()), default=0)
    if not width:
        return spark.createDataFrame([], T.StructType([*RAW_SCHEMA, *[REJECTED] * rejects]))
    cells = (spark.read.options(**CSV_OPTIONS, enforceSchema=True)
             .schema(", ".join(f"c{i} STRING" for i in range(width))).csv(paths)
             .withColumn("file", F.col("_metadata.file_path")))
    rows = lookup_join(cells, headers, ["file"])

    def cell_of(field: T.StructField) -> Column:
        value = F.lit(None).cast("string")
        for line, names in named.items():
            if field.name in names:
                cell = F.col(f"c{names.index(field.name)}")
                value = F.when(F.col("header") == line, cell).otherwise(value)
        return value

    columns = [cell_of(f).try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA]
    if rejects:
        wrong = [F.when(cell_of(f).try_cast(f.dataType).isNull(), cell_of(f))
                 for f in RAW_SCHEMA if not isinstance(f.dataType, T.StringType)]
        columns.append(F.coalesce(*wrong).alias(REJECTED.name))
    return rows.select(*columns)


def union_parts(spark: SparkSession, parts: Iterable[DataFrame]) -> DataFrame:
    """Parts joined by column name; no parts give an empty table of raw rows."""
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], RAW_SCHEMA) if out is None else out


def read_paths(spark: SparkSession, paths: Iterable[str], rejects: bool = False) -> DataFrame:
    """Raw rows of the given files, each read by its suffix; other files are left out."""
    paths = list(paths)
    json = [literal_path(p) for p in paths if p.endswith(JSON_SUFFIXES)]
    tables = [literal_path(p) for p in paths if p.endswith(CSV_SUFFIX)]
    parts = []
    if json:
        parts.append(read_json(spark, json, rejects))
    if tables:
        parts.append(read_csv(spark, tables, rejects))
    if rejects and not parts:
        return spark.createDataFrame([], T.StructType([*RAW_SCHEMA, REJECTED]))
    return union_parts(spark, parts)


def read_drop(spark: SparkSession, folder: str) -> DataFrame:
    """All raw rows of a drop folder; an empty folder gives an empty table."""
    return read_paths(spark, list_drop(spark, folder))


def preview_json(spark: SparkSession, paths: str | list[str], n: int = 10) -> DataFrame:
    """A first look: ``n`` items with id, type, language and text, in key order."""
    return (read_json(spark, paths).select("item_id", "item_type", "lang", "text")
            .orderBy("item_id", "text").limit(n))


def write_json(feed: DataFrame, folder: str) -> None:
    """A feed as JSON lines, with nulls written out."""
    feed.write.option("ignoreNullFields", False).json(folder)
