"""K5: compacted snapshots of a table that a stream upserts batch by batch.

The batches (``day=/batch_id=`` folders) stay the source.  A snapshot is the newest write of every key among the batches
up to one batch, written into a folder of its own and then named by one appended row of the commit table.  A reader takes
the snapshot of the newest commit and the batches after it, so

- a compaction that fails, or is still running, has no commit and no reader sees it;
- a reader that began before a compaction goes on with the folder it has, as no folder is changed in place;
- a batch that is replayed replaces its own folder with the same rows, and readers of later snapshots pass it by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from volcast.operators.quality import dedupe
from volcast.session import new_name

COMMIT_SCHEMA = "upto long, data string, n_rows long"


class Snapshots:
    """Snapshots under ``root`` of the batches at ``batches`` (``schema`` with ``day`` and ``batch_id``; ``keys`` name a row).

    Defined cases: batches without rows leave no folder and count as done; without a commit the batches alone are read;
    a null in a key is a value like any other; a table whose batches were never written is an error."""

    def __init__(self, spark: SparkSession, batches: str, root: str, schema: StructType,
                 keys: tuple[str, ...] = ("symbol", "day", "event_time"), files_per_day: int = 8):
        self.spark, self.batches, self.root, self.schema, self.keys = spark, batches, root.rstrip("/"), schema, list(keys)
        self.files_per_day = files_per_day

    def commits(self) -> DataFrame:
        """The commit table (empty before the first compaction)."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.root}/commits")

    def listed(self) -> DataFrame:
        """The batches as they are now.  Their folders are listed once, so a caller with several reads or compactions to do
        at a time may hand this to each (``batches``); batches written later are not in it."""
        return self.spark.read.schema(self.schema).parquet(self.batches)

    def _rows(self, commit, rows: DataFrame, upto: int | None = None) -> DataFrame:
        """Rows of a commit's snapshot and of the batches (``rows``) after it, up to ``upto``, one of them per key."""
        if upto is not None:
            rows = rows.where(F.col("batch_id") <= F.lit(upto))
        if commit is not None:
            kept = self.spark.read.schema(self.schema).parquet(commit.data).select(*self.schema.fieldNames())
            rows = rows.where(F.col("batch_id") > F.lit(commit.upto)).unionByName(kept)
        newest = rows.withColumn("_age", -F.col("batch_id"))
        return dedupe(newest, self.keys, ["_age"]).drop("_age")

    def read(self, version: int | None = None, batches: DataFrame | None = None) -> DataFrame:
        """The newest write of every key, by the newest commit.  ``version`` (0: before any commit, 1: the first, ...)
        reads through an older commit instead, which gives the same rows as long as no batch was taken away."""
        log = self.commits().orderBy("upto", "data").collect()        # one row per compaction
        place = len(log) if version is None else version
        if not 0 <= place <= len(log):
            raise ValueError(f"there are {len(log)} commits")
        return self._rows(log[place - 1] if place else None, self.listed() if batches is None else batches).drop("batch_id")

    def compact(self, upto: int | None = None, batches: DataFrame | None = None) -> int | None:
        """Write and commit a snapshot of the batches up to ``upto``; the last batch but one by default, since the newest
        may still be being written.  Returns that batch, or None where nothing new is there to compact.

        Only the batches after the last snapshot are read beside it.  Rows are laid out by month, in the order of the
        days, in at most ``files_per_day`` files, by hash of the first key: a month is no single task, and a long time
        makes few folders.  A filter on the day skips row groups."""
        last = self.commits().orderBy(F.desc("upto"), F.desc("data")).first()
        batches = self.listed() if batches is None else batches
        seen = batches.select("batch_id").distinct()
        if upto is None:
            newest = seen.orderBy(F.desc("batch_id")).limit(2).collect()
            if len(newest) < 2:
                return None
            upto = newest[1].batch_id
        if last is not None and upto <= last.upto:
            return None
        data = f"{self.root}/data/{new_name(f'upto-{upto}')}"
        rows = self._rows(last, batches, upto).select(*self.schema.fieldNames())
        share = F.pmod(F.xxhash64(self.keys[0]), F.lit(self.files_per_day))
        month = F.trunc("day", "month")
        (rows.withColumn("month", month).repartition("month", share).sortWithinPartitions("month", "day", *self.keys)
         .write.partitionBy("month").parquet(data))
        n_rows = self.spark.read.schema(self.schema).parquet(data).count()
        (self.spark.createDataFrame([(upto, data, n_rows)], COMMIT_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/commits"))
        return upto
