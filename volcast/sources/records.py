"""A log of keyed records with offsets, and a streaming source that reads it by offsets.

The log is a folder.  ``append`` numbers the records of every topic partition (the one the hash balancer gives the key) on
from the last offset, without gaps, and writes them as Parquet below ``appends/``, one folder per partition and segment
of ``segment_rows`` offsets.  One row per such folder then goes to the index below ``index/``, in one file: readers see an append
whole or not at all.  A log has one writer at a time, as its offsets go on from the index.

``record_log`` is the source.  Its offset is the next record of every partition, which Spark keeps in the query's
checkpoint: a query that stops goes on where it stood.  The driver reads the index alone, one row per segment; the records
are read by tasks, one per segment touched.

Options: ``path``; ``startingOffsets`` (``earliest``, ``latest`` or JSON such as ``{"0": 17}``, where partitions not
named start at their earliest) for a query without a checkpoint; ``maxOffsetsPerTrigger``, shared out by what each partition has
left, at least one record of each.  With the ``availableNow`` trigger Spark asks for the end once, so such a run is one
batch of that size; a processing-time trigger goes on to the end of the log.

The paths are opened by pyarrow (local or mounted folders, HDFS, S3, GCS).  Defined cases: an empty log has no partitions
and gives no rows; null keys are dealt by their value; null times come first in their append; equal records are
all kept; offsets asked for that the log does not hold are an error, never skipped.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import NamedTuple
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from volcast.operators.series import number_rows
from volcast.session import new_name
from volcast.sources.messages import dealt_partition

SEGMENT_ROWS = 1_000_000
RECORD_SCHEMA = "partition_no int, offset long, key binary, value binary, time timestamp_ntz"
INDEX_SCHEMA = "partition_no int, start long, end long, folder string"


def index_rows(spark: SparkSession, root: str) -> DataFrame:
    """The index of a log (empty before the first append)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/index")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/index")


def append(records: DataFrame, root: str, partitions: int, segment_rows: int = SEGMENT_ROWS) -> None:
    """Append ``records`` (``key``, ``value``, ``time``; other columns are left out) to the log at ``root``, each partition in the
    order of time, key and value.

    A hot key's partition is numbered by day and written by segment, so it is no single task."""
    spark, root = records.sparkSession, root.rstrip("/")
    d = records.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                       F.col("time").cast("timestamp_ntz").alias("time"))
    d = d.withColumn("partition_no", dealt_partition(partitions))
    day = F.coalesce(F.unix_date(F.to_date("time")), F.lit(-(1 << 31)))
    numbered = number_rows(d, ["partition_no"], ["time", "key", "value"], day, rn_col="_n", total_col=None)
    ends = index_rows(spark, root).groupBy("partition_no").agg(F.max("end").alias("_from"))     # one row per partition
    placed = (numbered.join(ends, "partition_no", "left")
              .withColumn("offset", F.coalesce("_from", F.lit(0)) + F.col("_n") - 1)
              .withColumn("segment", F.floor(F.col("offset") / segment_rows)))
    name = f"appends/{new_name('records')}"
    cell = ["partition_no", "segment"]
    (placed.select(*cell, "offset", "key", "value", "time").repartition(*cell).sortWithinPartitions(*cell, "offset")
     .write.partitionBy(*cell).parquet(f"{root}/{name}"))
    written = spark.read.schema("offset long, partition_no int, segment long").parquet(f"{root}/{name}")
    folder = F.concat(F.lit(f"{name}/partition_no="), F.col("partition_no").cast("string"), F.lit("/segment="),
                      F.col("segment").cast("string"))
    (written.groupBy(*cell).agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"))
     .select("partition_no", "start", "end", folder.alias("folder"))
     .coalesce(1).write.mode("append").parquet(f"{root}/index"))          # one row per segment


def _opened(path: str):
    """pyarrow's file system and path of a Spark path."""
    from pyarrow import fs

    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(path)


class Segment(NamedTuple):
    partition: int
    start: int
    end: int
    folder: str


@dataclass
class SegmentPart(InputPartition):
    """Offsets ``start`` to ``end`` (exclusive) of one segment's folder."""

    partition: int
    start: int
    end: int
    folder: str


def shared_out(at: dict[int, int], ends: dict[int, int], most: int | None) -> dict[int, int]:
    """The end of the next batch: all there is or, of more than ``most`` records, each partition's share of them."""
    left = {p: end - at.get(p, 0) for p, end in ends.items()}
    total = sum(left.values())
    if most is None or total <= most:
        return ends
    return {p: ends[p] - n + min(n, max(1, most * n // total)) for p, n in left.items()}


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.starting = options.get("startingOffsets", "earliest")
        most = options.get("maxOffsetsPerTrigger")
        self.most = int(most) if most else None
        if self.most is not None and self.most < 1:
            raise ValueError("maxOffsetsPerTrigger is one at least")
        self.files: dict[str, list[Segment]] = {}      # of the index, as far as read
        self.at: dict[int, int] | None = None          # where the last planned batch ended

    def _segments(self) -> list[Segment]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, root = _opened(self.root)
        for info in files.get_file_info(fs.FileSelector(f"{root}/index", allow_not_found=True)):
            if info.base_name.endswith(".parquet") and info.base_name[0] not in "._" and info.path not in self.files:
                rows = pq.read_table(info.path, filesystem=files).to_pylist()
                self.files[info.path] = [Segment(r["partition_no"], r["start"], r["end"], r["folder"]) for r in rows]
        return [s for rows in self.files.values() for s in rows]

    def _bounds(self) -> tuple[dict[int, int], dict[int, int]]:
        first, ends = {}, {}
        for s in self._segments():
            first[s.partition] = min(first.get(s.partition, s.start), s.start)
            ends[s.partition] = max(ends.get(s.partition, s.end), s.end)
        return first, ends

    def initialOffset(self) -> dict:
        first, ends = self._bounds()
        if self.starting == "latest":
            begin = ends
        elif self.starting == "earliest":
            begin = first
        else:
            begin = first | {int(p): int(o) for p, o in json.loads(self.starting).items()}
        self.at = begin
        return {str(p): o for p, o in sorted(begin.items())}

    def latestOffset(self) -> dict:
        first, ends = self._bounds()
        # a partition that came later starts at its earliest; one whose start lies ahead waits there
        at = first | (self.at or {})
        ends = {p: max(end, at[p]) for p, end in ends.items()} | {p: o for p, o in at.items() if p not in ends}
        return {str(p): o for p, o in sorted(shared_out(at, ends, self.most).items())}

    def partitions(self, start: dict, end: dict) -> list[SegmentPart]:
        """The segments between two offsets.  Spark also calls it with the checkpoint's last offset (twice the same) when
        a query starts again, so that :meth:`latestOffset` goes on from there."""
        self.at = {int(p): o for p, o in end.items()}
        segments = self._segments()
        first, _ = self._bounds()
        parts = []
        for p, to in self.at.items():
            begin = start.get(str(p), first.get(p, to))
            found = [SegmentPart(p, max(s.start, begin), min(s.end, to), s.folder) for s in segments
                     if s.partition == p and s.start < to and s.end > begin]
            if sum(f.end - f.start for f in found) != to - begin:
                raise ValueError(f"the log at {self.root} does not hold all offsets {begin} to {to} of partition {p}")
            parts += found
        return parts

    def read(self, partition: SegmentPart):
        import pyarrow as pa
        import pyarrow.dataset as pads

        files, root = _opened(self.root)
        rows = pads.dataset(f"{root}/{partition.folder}", filesystem=files, format="parquet")
        wanted = (pads.field("offset") >= partition.start) & (pads.field("offset") < partition.end)
        for b in rows.to_batches(columns=["offset", "key", "value", "time"], filter=wanted):
            number = pa.array([partition.partition] * b.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [number, b.column(0), b.column(1), b.column(2), b.column(3).cast(pa.timestamp("us"))],
                ["partition_no", "offset", "key", "value", "time"])


class RecordLog(DataSource):
    """The source ``record_log``."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def streamReader(self, schema) -> RecordLogReader:
        return RecordLogReader(self.options)


def record_messages(spark: SparkSession, path: str, starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Streaming records of a log: partition_no, offset, key, value, time."""
    spark.dataSource.register(RecordLog)
    r = spark.readStream.format("record_log").option("path", path).option("startingOffsets", starting)
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load()
