"""K5: readers, failures and replays around a compaction give the same rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType, TimestampNTZType

from volcast.sinks.snapshots import Snapshots

SCHEMA = (StructType().add("symbol", StringType()).add("day", DateType()).add("event_time", TimestampNTZType())
          .add("close", DoubleType()).add("batch_id", LongType()))
T0 = dt.datetime(2024, 3, 1)


def _batch(spark, path, batch_id, rows):
    """rows: (symbol, hour, close)."""
    data = [(s, (T0 + dt.timedelta(hours=h)).date(), T0 + dt.timedelta(hours=h), c, batch_id) for s, h, c in rows]
    (spark.createDataFrame(data, SCHEMA).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id").parquet(path))


def _rows(df):
    return sorted(((r.symbol or "", r.event_time, r.close) for r in df.select("symbol", "event_time", "close").collect()))


def _want(*batches):
    newest = {}
    for rows in batches:
        newest |= {(s or "", T0 + dt.timedelta(hours=h)): c for s, h, c in rows}
    return sorted((s, t, c) for (s, t), c in newest.items())


FIRST = [("a", h, float(h)) for h in range(40)] + [("b", 3, 1.0), (None, 5, 2.0)]
SECOND = [("a", h, 100.0 + h) for h in range(30, 50)] + [("c", 90, 3.0)]
THIRD = [("a", 0, -1.0), ("b", 3, -2.0), (None, 5, -3.0), ("d", 200, 0.0)]


def test_versions_readers_and_replays(spark, tmp_dir):
    path = f"{tmp_dir}/batches"
    store = Snapshots(spark, path, f"{tmp_dir}/store", SCHEMA)
    _batch(spark, path, 4, FIRST)
    assert store.compact() is None and store.commits().count() == 0          # the newest batch may still be written
    _batch(spark, path, 7, SECOND)
    before = store.read()
    assert store.compact() == 4 and store.compact() is None
    assert _rows(store.read()) == _rows(before) == _want(FIRST, SECOND)
    reading = store.read()
    _batch(spark, path, 9, THIRD)
    assert store.compact() == 7
    assert _rows(reading) == _want(FIRST, SECOND) or _rows(reading) == _want(FIRST, SECOND, THIRD)
    assert [_rows(store.read(v)) for v in (None, 0, 1, 2)] == [_want(FIRST, SECOND, THIRD)] * 4
    _batch(spark, path, 4, FIRST)                                            # a replay of a compacted batch
    assert _rows(store.read()) == _want(FIRST, SECOND, THIRD)
    assert store.compact(9) == 9 and store.compact(3) is None
    assert _rows(store.read()) == _want(FIRST, SECOND, THIRD)
    with pytest.raises(ValueError):
        store.read(4)


def test_snapshot_holds_what_its_batches_say(spark, tmp_dir):
    """A key that a later batch writes again is in the snapshot with its value up to then."""
    path = f"{tmp_dir}/batches"
    for i, rows in enumerate((FIRST, SECOND, THIRD)):
        _batch(spark, path, i, rows)
    store = Snapshots(spark, path, f"{tmp_dir}/store", SCHEMA)
    assert store.compact(1) == 1
    commit = store.commits().first()
    assert _rows(spark.read.schema(SCHEMA).parquet(commit.data)) == _want(FIRST, SECOND)
    assert commit.n_rows == len(_want(FIRST, SECOND))


def test_failed_compaction_is_not_seen(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/batches"
    _batch(spark, path, 0, FIRST)
    _batch(spark, path, 1, SECOND)
    store = Snapshots(spark, path, f"{tmp_dir}/store", SCHEMA)

    def lost(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lost)
        m.setattr(Snapshots, "commits", lambda self: self.spark.range(0).select(
            F.lit(0).alias("upto"), F.lit("").alias("data"), F.lit(0).alias("n_rows")))
        with pytest.raises(RuntimeError, match="lost"):
            store.compact()
    assert store.commits().count() == 0
    assert _rows(store.read()) == _want(FIRST, SECOND)
    assert store.compact() == 0
    assert _rows(store.read()) == _want(FIRST, SECOND)


def test_files_of_a_day_are_few_and_empty_tables_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/batches"
    _batch(spark, path, 0, [(f"s{i}", i % 24, 1.0) for i in range(500)])
    store = Snapshots(spark, path, f"{tmp_dir}/store", SCHEMA, files_per_day=3)
    assert store.compact(0) == 0
    assert len(spark.read.parquet(store.commits().first().data).inputFiles()) <= 3
    spark.createDataFrame([], SCHEMA).write.partitionBy("day", "batch_id").parquet(f"{tmp_dir}/none")
    empty = Snapshots(spark, f"{tmp_dir}/none", f"{tmp_dir}/none_store", SCHEMA)
    assert empty.read().count() == 0 and empty.compact() is None


def test_a_long_time_makes_few_files_and_one_listing_serves_many_reads(spark, tmp_dir):
    path = f"{tmp_dir}/batches"
    rows = [(s, 24 * d + 1, float(d)) for d in range(70) for s in ("a", "b")]        # March, April and a part of May
    _batch(spark, path, 0, rows)
    _batch(spark, path, 1, SECOND)
    store = Snapshots(spark, path, f"{tmp_dir}/store", SCHEMA, files_per_day=2)
    batches = store.listed()
    assert store.compact(0, batches) == 0 and store.compact(1, batches) == 1
    for commit in store.commits().collect():
        assert len(spark.read.parquet(commit.data).inputFiles()) <= 3 * 2            # by the day: 70 and more
    assert [_rows(store.read(v, batches)) for v in (None, 0, 1, 2)] == [_want(rows, SECOND)] * 4
