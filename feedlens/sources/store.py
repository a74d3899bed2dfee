"""The three layers as Parquet folders.

Bronze is kept in two parts, so that a text is written once and never rewritten:

* ``items``: one row per item, written when it is first seen;
* ``keys``: a few bytes per item that a batch added or refreshed: its key, the day it was created,
  its counts, and the first and the newest batch that had it. Laid out by hash buckets of the key;
  a batch only reads the buckets that its own keys fall into.

Each run writes one ``batch=<n>`` folder per part, as a whole. The store hands out the numbers,
each to one named run, and gives that run the same number again after a failure. A folder whose
write was committed is never written again, so neither another run nor a repeated one takes rows
away.

A key's newest row is the one with the highest batch in it, wherever it stands, and its older rows
say nothing against it. So after every ``fold_after`` batches the newest rows of all keys are
written to ``folded`` and the folders that they came from are removed: whether a reader or a
crash finds both, or only one of them, makes no difference.

Silver and Gold are laid out by creation day. A batch rebuilds the days that it touched. Their files
hold an English text that is the original once, with a mark; ``silver()`` and ``gold()`` show it twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.times import instant
from feedlens.operators.gold import engaged, gold_items
from feedlens.operators.upsert import KEY, dedup_stored
from feedlens.plans.metrics import newest
from feedlens.plans.summary import SUMMARY_SCHEMA, summarize
from feedlens.schema import BRONZE_COLS, BRONZE_SCHEMA, COUNT_COLS, GOLD_SCHEMA, SILVER_SCHEMA
from feedlens.session import (PACKED, Measured, hadoop_path, lookup_join, materialize, measured,
                              remove, scratch_path)

DAY = "created_day"
BUCKETS, FOLD_AFTER = 16, 16
SMALL_FILE, FEW_FILES = 8 << 20, 4
SAME = "text_en_as_original"
MARK = T.StructField(SAME, T.BooleanType())
BATCH = T.StructField("batch", T.LongType())
DAY_FIELD = T.StructField(DAY, T.DateType())
STATE = T.StructType([BRONZE_SCHEMA[KEY], DAY_FIELD, *[BRONZE_SCHEMA[c] for c in COUNT_COLS],
                      T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                      BATCH, T.StructField("bucket", T.IntegerType())])
PARTS = {
    "layout": T.StructType([T.StructField("buckets", T.IntegerType())]),
    "runs": T.StructType([T.StructField("run", T.StringType()), BATCH]),
    "items": T.StructType([*BRONZE_SCHEMA, T.StructField("ingestion_time", T.TimestampType()),
                           BATCH]),
    "keys": STATE,
    "folded": STATE,
    "silver": T.StructType([*SILVER_SCHEMA, MARK, BATCH, DAY_FIELD]),
    "gold": T.StructType([*GOLD_SCHEMA, MARK, DAY_FIELD]),
    "summary": T.StructType([*SUMMARY_SCHEMA, DAY_FIELD]),
}
#: What a part's folders are named by; within a batch folder for the last three of batches.
FOLDERS = {"runs": ("batch",), "items": ("batch",), "keys": ("batch", "bucket"),
           "folded": ("batch", "bucket"), "silver": ("batch", DAY), "gold": (DAY,),
           "summary": (DAY,)}


def on_days(rows: DataFrame, days: Iterable[date | None] | None) -> DataFrame:
    """Rows of a table laid out by ``created_day`` that lie on one of ``days``; None keeps all."""
    if days is None:
        return rows
    known = [day for day in days if day is not None]
    wanted = F.col(DAY).isin(known)
    return rows.filter(wanted if len(known) == len(list(days)) else wanted | F.col(DAY).isNull())


def newest_state(states: DataFrame) -> DataFrame:
    """The newest row per key, folded per task before the shuffle."""
    rest = [f.name for f in STATE if f.name not in (KEY, "last", "batch", "bucket")]
    return (states.groupBy(KEY).agg(F.max(F.struct("last", *rest)).alias("newest"))
            .select(KEY, "newest.*"))


def packed(rows: DataFrame) -> DataFrame:
    """Rows with an English text that equals the original left out, and marked so."""
    text, same = F.col("text_en"), F.coalesce(F.col("text_en") == F.col("original_text"), F.lit(False))
    return rows.withColumn(SAME, same).withColumn("text_en", F.when(~F.col(SAME), text))


def unpacked(rows: DataFrame) -> DataFrame:
    """The rows that ``packed`` was given; those written without a mark are as they were."""
    text = F.when(F.col(SAME), F.col("original_text")).otherwise(F.col("text_en"))
    return rows.withColumn("text_en", text).drop(SAME)


class FeedStore:
    """Bronze, Silver and Gold below one folder."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS,
                 fold_after: int = FOLD_AFTER):
        """``buckets`` counts for a store that is created now: about one per GB of keys."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.new_buckets, self.fold_after = buckets, fold_after

    def path(self, part: str) -> str:
        return f"{self.base}/{part}"

    def create(self) -> FeedStore:
        """Make the folders of the tables that do not exist yet; existing ones stay as they are.

        An empty folder is an empty table: every read names its schema.
        """
        for part in FOLDERS:
            files, where = hadoop_path(self.spark, self.path(part))
            files.mkdirs(where)
        layout = self.spark.range(1).select(F.lit(self.new_buckets).alias("buckets"))
        layout.coalesce(1).write.mode("ignore").parquet(self.path("layout"))
        return self

    @cached_property
    def buckets(self) -> int:
        """How many buckets the store was created with."""
        return self.read("layout").first()["buckets"]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int").alias("bucket")

    def read(self, part: str) -> DataFrame:
        rows = self.spark.read.schema(PARTS[part]).parquet(self.path(part))
        return unpacked(rows) if SAME in PARTS[part].names else rows

    # ---- batches ----

    def batches(self, part: str, committed: bool = False) -> set[int]:
        """Numbers of the batch folders of a part; with ``committed`` those whose write ended."""
        pattern = f"{self.path(part)}/batch=*" + "/_SUCCESS" * committed
        files, where = hadoop_path(self.spark, pattern)
        found = [status.getPath() for status in files.globStatus(where) or []]
        names = [(path.getParent() if committed else path).getName() for path in found]
        return {int(name.partition("=")[2]) for name in names}

    def claim(self, run: str) -> int:
        """The batch number of a run: the one that it got before, or the next one.

        Two runs of one store must not begin at the same moment; the later of two that do so
        fails before it writes any item.
        """
        known = self.read("runs").filter(F.col("run") == run).agg(F.min("batch")).first()[0]
        if known is not None:
            return known
        batch = 1 + max([-1, *(n for part in FOLDERS for n in self.batches(part))])
        rows = self.spark.createDataFrame([(run,)], "run STRING").coalesce(1)
        rows.write.mode("errorifexists").parquet(f"{self.path('runs')}/batch={batch}")
        return batch

    def write_batch(self, part: str, rows: DataFrame, batch: int, stay: bool = False) -> None:
        """Write a batch folder, unless an earlier attempt of its run has committed it.

        With ``stay`` rows are written by the tasks that have them.
        """
        if batch not in self.batches(part, committed=True):
            inner = FOLDERS[part][1:]
            if part == "items":  # in no folders, but a day's rows in few files
                rows = rows.withColumn(DAY, F.to_date("created_at")).hint("rebalance", DAY)
            rows = rows.select(*[f.name for f in PARTS[part] if f.name != "batch"])
            if inner and not stay:  # each folder's rows in few tasks, a large one's in several
                rows = rows.hint("rebalance", *inner)
            rows.write.mode("overwrite").partitionBy(*inner).options(**PACKED).parquet(
                f"{self.path(part)}/batch={batch}")

    # ---- Bronze ----

    def items(self) -> DataFrame:
        return self.read("items")

    def states(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows about keys, older ones included; with ``buckets`` of those only."""
        rows = self.read("keys").filter(F.col("batch").isin(*self.batches("keys", True)))
        if folded := self.batches("folded", True):
            rows = rows.unionByName(self.read("folded").filter(F.col("batch") == max(folded)))
        return rows if buckets is None else rows.filter(F.col("bucket").isin(*buckets))

    def current_counts(self, days: Iterable[date | None] | None = None) -> DataFrame:
        """Key and counts of now; with ``days``, of the items created on these days."""
        return newest_state(on_days(self.states(), days)).select(KEY, *COUNT_COLS)

    def bronze(self) -> DataFrame:
        """Bronze as one table, with the counts of now."""
        items = self.items().drop("batch", *COUNT_COLS)
        return items.join(self.current_counts(), KEY).select(*BRONZE_COLS, "ingestion_time")

    def _merged(self, rows: DataFrame, batch: int) -> DataFrame:
        """What is known of the keys of ``rows`` after this batch; ``rows`` has their buckets.

        Reads the batch's own buckets, and of these only its own keys, where those are measured to
        be small enough to be sent to all tasks. A batch that is older than what is known of a key
        (a run continued late) leaves the newer counts.
        """
        own = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # <= self.buckets
        known = self.states(own)
        keys = measured(rows.select(KEY))
        if keys.fits():
            known = known.join(F.broadcast(keys.table), KEY, "left_semi")
        old = newest_state(known).select(KEY, F.struct("*").alias("old"))
        counts = {c: F.when(F.col("old.last") > batch, F.col(f"old.{c}")).otherwise(F.col(c))
                  for c in COUNT_COLS}
        day = F.when(F.col("old").isNotNull(), F.col(f"old.{DAY}")).otherwise(
            F.to_date("created_at"))
        number = F.lit(batch).cast("bigint")
        return (rows.select(KEY, "bucket", "created_at", *COUNT_COLS).join(old, KEY, "left")
                .withColumns({**counts, DAY: day, "first": F.coalesce("old.first", number),
                              "last": F.greatest("old.last", number)}))

    def upsert(self, incoming: DataFrame, batch: int, as_of: datetime | Column) -> int:
        """Merge a batch into Bronze and return how many items are new.

        New items are added with ``as_of`` as ingestion time; known ones only get their counts
        refreshed. Both readers give every item a key; a row without one cannot be merged. The
        batch is written to the shared folder once, so that no task computes it twice. Its texts
        move once, to files by day, which Silver and Gold are then made of in place. Keys are
        committed before items: a run that fails between the two finds its own keys when it is
        called again, and no other run takes its items for new ones.
        """
        if batch not in self.batches("items", True):
            rows = incoming.select(*BRONZE_COLS).filter(F.col(KEY).isNotNull())
            path = scratch_path(self.spark, "incoming")
            rows.select("*", self.bucket()).write.options(**PACKED).parquet(path)
            schema = T.StructType([*rows.schema, STATE["bucket"]])
            rows = dedup_stored(self.spark.read.schema(schema).parquet(path))
            self.write_batch("keys", self._merged(rows, batch), batch)
            own = self.read("keys").filter(F.col("batch") == batch)
            new = lookup_join(rows, own.filter(F.col("first") == batch).select(KEY), [KEY],
                              "left_semi")
            self.write_batch("items", new.withColumn("ingestion_time", instant(as_of)), batch)
            remove(self.spark, path)
            if len(self.batches("keys", True)) > self.fold_after:
                self.fold()
        return self.items().filter(F.col("batch") == batch).count()

    def fold(self) -> None:
        """One row per key in place of all that came before.

        The folded rows are committed before the folders that they came from go.
        """
        covered, older = self.batches("keys", True), self.batches("folded")
        batch = max(covered | older, default=-1)
        if not covered or batch in older & self.batches("folded", True):
            return
        states = newest_state(self.states()).select("*", self.bucket())
        self.write_batch("folded", states, batch)
        for part, numbers in (("keys", covered), ("folded", older - {batch})):
            for number in sorted(numbers):
                remove(self.spark, f"{self.path(part)}/batch={number}")

    # ---- Silver ----

    def silver(self) -> DataFrame:
        return self.read("silver").drop("batch", DAY)

    def without_silver(self, batch: int) -> set[int]:
        """Earlier batches of which items may lack their Silver row."""
        earlier = {n for n in self.batches("items") if n < batch}
        return earlier - self.batches("silver", committed=True)

    def pending(self, batch: int) -> DataFrame:
        """Every item up to ``batch`` without a Silver row of an earlier batch.

        Where all earlier batches have their Silver, these are the batch's own items, and nothing
        is joined. Otherwise the items of the batches that lack it are held against Silver's keys too,
        which are sent to them where they fit.
        """
        items, behind = self.items(), self.without_silver(batch)
        if not behind:
            return items.filter(F.col("batch") == batch).drop("batch")
        items = items.filter(F.col("batch").isin(batch, *behind))
        return lookup_join(items, self.done(batch), [KEY], "left_anti").drop("batch")

    def done(self, batch: int) -> Measured:
        """Keys with a Silver row of an earlier batch."""
        return measured(self.read("silver").filter(F.col("batch") < batch).select(KEY))

    def write_silver(self, rows: DataFrame, batch: int, stay: bool = False) -> None:
        """Write a batch's Silver; batches that it caught up with get an empty folder of theirs.

        With ``stay`` the rows stand as Bronze's files have them, by day already, and do not move.
        """
        behind = self.without_silver(batch)
        rows = rows.withColumn(DAY, F.to_date("created_at"))
        self.write_batch("silver", packed(rows), batch, stay)
        for earlier in sorted(behind):
            self.write_batch("silver", rows.sparkSession.createDataFrame([], PARTS["silver"]),
                             earlier)

    # ---- Gold ----

    def gold(self) -> DataFrame:
        return self.read("gold").drop(DAY)

    def summary(self) -> DataFrame:
        """Counts and sums of Gold (see ``feedlens.plans.summary``); the metrics take it as Gold."""
        return self.read("summary").drop(DAY)

    def touched_days(self, batch: int) -> list[date | None]:
        """Days with an item that ``batch`` added or refreshed, or whose Silver it wrote.

        Reads the batch's own folders; of keys that were folded since, the folded rows.
        """
        states = self.read("keys").filter(F.col("batch") == batch)
        if batch not in self.batches("keys", True):
            states = self.states()
        silver = self.read("silver").filter(F.col("batch") == batch)
        days = states.filter(F.col("last") == batch).select(DAY).union(silver.select(DAY))
        return [row[DAY] for row in days.distinct().collect()]  # as many as the calendar has

    def write_gold(self, batch: int | None = None) -> None:
        """Rebuild Gold by day, and its summary: all days, or those that ``batch`` touched.

        Days are replaced when the job commits, so a failed run leaves the old ones in place, and
        a day can always be rebuilt from Silver. A full rebuild also removes days without rows. A
        day with very many items is written by several tasks. Engagements that fit are sent to
        the rows; where Silver's files, each of one day, are large or few a day, its rows then do
        not move, and Gold has no more files than Silver.
        """
        days = None if batch is None else self.touched_days(batch)
        silver = on_days(self.read("silver"), days).drop("batch", DAY)
        counts = materialize(engaged(self.current_counts(days)), "engaged")
        gold = gold_items(silver, counts).withColumn(DAY, F.to_date("created_at"))
        self._write_days("gold", packed(gold), stay=counts.fits() and self._few_files("silver"))
        self._write_days("summary", summarize(on_days(self.read("gold"), days), DAY))
        if batch is None:
            present = {f"{DAY}={row[0] or '__HIVE_DEFAULT_PARTITION__'}"
                       for row in silver.select(F.to_date("created_at")).distinct().collect()}
            for part in ("gold", "summary"):
                for name in self._days(part) - present:
                    remove(self.spark, f"{self.path(part)}/{name}")

    def _write_days(self, part: str, rows: DataFrame, stay: bool = False) -> None:
        rows = rows.select(*PARTS[part].names)
        (rows if stay else rows.hint("rebalance", DAY)).write.mode("overwrite").partitionBy(
            DAY).options(**PACKED, partitionOverwriteMode="dynamic").parquet(self.path(part))

    def _few_files(self, part: str) -> bool:
        """Whether the files of a part laid out by batch and day are large, or few a day."""
        files, where = hadoop_path(self.spark, self.path(part))
        found = files.getContentSummary(where)
        folders = files.globStatus(hadoop_path(self.spark, f"{self.path(part)}/batch=*/{DAY}=*")[1])
        days = {status.getPath().getName() for status in folders or []}
        return (found.getLength() >= SMALL_FILE * max(found.getFileCount(), 1)
                or found.getFileCount() <= FEW_FILES * len(days))

    def _days(self, part: str) -> set[str]:
        """Names of a part's day folders."""
        files, where = hadoop_path(self.spark, f"{self.path(part)}/{DAY}=*")
        return {status.getPath().getName() for status in files.globStatus(where) or []}

    # ---- looking at layers ----

    def register(self, bronze: str = "bronze_feed", silver: str = "silver_feed",
                 gold: str = "gold_feed") -> None:
        """Temporary views of the layers, for queries in SQL; call again to see later runs."""
        self.bronze().createOrReplaceTempView(bronze)
        self.silver().createOrReplaceTempView(silver)
        self.gold().createOrReplaceTempView(gold)

    def newest_gold(self, n: int, columns: Sequence[str] | None = None) -> DataFrame:
        """The ``n`` newest rows of Gold, ties by key, rows without a time last.

        Day folders are counted from the newest back, twice as many at a time, until they hold
        ``n`` rows; a count reads no column. Keys are ranked first, and the wide columns are read
        for the ``n`` rows only.
        """
        names = sorted((name.partition("=")[2] for name in self._days("gold")), reverse=True)
        known = [date.fromisoformat(name) for name in names if name[:1].isdigit()]
        gold, step = self.read("gold"), 1
        while step < len(known) and gold.filter(F.col(DAY) >= known[step - 1]).count() < n:
            step *= 2
        if step < len(known):
            gold = gold.filter(F.col(DAY) >= known[step - 1])
        top = newest(gold.select(DAY, "created_at", KEY), n)
        picked = F.broadcast(top.select(F.col(KEY).alias("_key")))
        rows = gold.join(picked, F.col(KEY) == F.col("_key"), "left_semi")
        return newest(rows.drop(DAY), n, columns)

    def preview(self, layer: str, n: int = 50, columns: Sequence[str] | None = None) -> DataFrame:
        """The ``n`` newest rows of ``bronze``, ``silver`` or ``gold``."""
        if layer == "gold":
            return self.newest_gold(n, columns)
        return newest({"bronze": self.bronze, "silver": self.silver}[layer](), n, columns)
