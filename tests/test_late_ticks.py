"""Late ticks are kept, and the bars they belong to are corrected."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from volcast.operators.bars import ohlcv_bars
from volcast.streaming import live

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
SCHEMA = "symbol string, event_time timestamp, price double, volume double, taker_buy_volume double, tick_id long"
BARS = ["symbol", "bar_time", "open", "high", "low", "close", "volume", "taker_buy_volume", "num_trades"]


def _tick(symbol, minutes, price, tick_id):
    return (symbol, None if minutes is None else T0 + dt.timedelta(minutes=minutes), price, 1.0, 0.5, tick_id)


BATCHES = [
    [_tick("a", m, 10.0 + m, m) for m in range(0, 180, 7)] + [_tick("b", 5, 1.0, 900), _tick("b", None, 9.0, 901)],
    [_tick("a", m, 20.0 + m, m) for m in range(180, 300, 7)] + [_tick("a", 3, 500.0, 5000), _tick("b", 6, 0.5, 902)],
    [_tick("a", m, 30.0 + m, m) for m in range(300, 3000, 60)] + [_tick("a", 0, 0.25, -1), _tick("a", 3, 500.0, 5000)],
    [],
]
LATE = {(1, 5000), (1, 902), (2, -1), (2, 5000)}


def _run(spark, sink, batches):
    for i, rows in batches:
        sink(spark.createDataFrame(rows, SCHEMA).repartition(3), i)


def _bars(df):
    return sorted(df.select(*BARS).collect())


@pytest.mark.parametrize("width", ["1 hour", "36 hours"])
def test_corrections_equal_bars_of_all_ticks(spark, tmp_dir, width):
    sink = live.LateTickSink(f"{tmp_dir}/late", width, 30)
    sink.mark(spark, None, -1)
    _run(spark, sink, enumerate(BATCHES))
    late = live.read_sink(spark, f"{tmp_dir}/late/late", live.TICK_SCHEMA)
    if width == "1 hour":
        assert {(r.batch_id, r.tick_id) for r in late.collect()} == LATE
    again = live.read_sink(spark, f"{tmp_dir}/late/corrections", live.CORRECTION_SCHEMA)
    closed = live.wall_clock(F.timestamp_micros(F.lit(int((T0 + dt.timedelta(minutes=2940)).timestamp()) * 1_000_000 - 30_000_000)))
    ticks = spark.createDataFrame(sum(BATCHES, []), SCHEMA).where("event_time is not null").dropDuplicates(["symbol", "tick_id"])
    want = ohlcv_bars(ticks, width, tie="tick_id").withColumn("bar_time", live.wall_clock("bar_time")).where(F.col("bar_time") <= closed)
    # a stream's final bars: those of the ticks that were in time, so corrections alone must mend them
    in_time = ticks.join(late.select("symbol", "tick_id"), ["symbol", "tick_id"], "left_anti")
    final = ohlcv_bars(in_time, width, tie="tick_id").withColumn("bar_time", live.wall_clock("bar_time")).where(F.col("bar_time") <= closed)
    assert _bars(live.corrected_bars(final, again)) == _bars(want)


def test_replayed_batches_change_nothing(spark, tmp_dir):
    sink = live.LateTickSink(f"{tmp_dir}/late", "1 hour", 30)
    sink.mark(spark, None, -1)
    _run(spark, sink, enumerate(BATCHES[:3]))

    def tables():
        return [sorted(map(tuple, spark.read.schema(s).parquet(f"{tmp_dir}/late/{n}").collect()), key=repr)
                for n, s in (("late", live.TICK_SCHEMA), ("corrections", live.CORRECTION_SCHEMA), ("ticks", live.TICK_SCHEMA),
                             ("marks", live.MARK_SCHEMA))]

    before = tables()
    _run(spark, sink, [(2, BATCHES[2])])
    assert tables() == before
    assert len(before[0]) == len(LATE)


def test_restarted_stream_keeps_its_watermark(spark, tmp_dir):
    got = []
    for i, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/in/part-{i}")
        q = live.start_late_corrections(live.file_stream(spark, f"{tmp_dir}/in/*", spark.createDataFrame([], SCHEMA).schema),
                                        f"{tmp_dir}/ck", f"{tmp_dir}/late", trigger={"availableNow": True})
        q.awaitTermination()
        got.append(live.read_sink(spark, f"{tmp_dir}/late/late", live.TICK_SCHEMA).count())
    assert got == [0, 2, 4, 4]


def test_a_long_batch_makes_folders_by_month(spark, tmp_dir):
    sink = live.LateTickSink(f"{tmp_dir}/late", "36 hours", 30)
    sink.mark(spark, None, -1)
    day = 24 * 60
    rows = [_tick("a", m, 1.0 + m, m) for m in range(0, 70 * day, day // 2)]          # March, April and a part of May
    _run(spark, sink, [(0, rows), (1, [_tick("a", 31 * day - 5, 0.5, 10 ** 6), _tick("a", 71 * day, 2.0, 10 ** 6 + 1)])])
    for name in ("ticks", "corrections"):
        assert {f for f in os.listdir(f"{tmp_dir}/late/{name}") if "=" in f} == {f"month=2024-0{m}-01" for m in (3, 4, 5)}
    again = live.read_sink(spark, f"{tmp_dir}/late/corrections", live.CORRECTION_SCHEMA)
    assert again.columns[-2:] == ["day", "batch_id"]
    ticks = live.read_sink(spark, f"{tmp_dir}/late/ticks", live.TICK_SCHEMA)
    late = live.read_sink(spark, f"{tmp_dir}/late/late", live.TICK_SCHEMA)
    assert [r.tick_id for r in late.collect()] == [10 ** 6]
    # the bar over the end of March holds ticks of two months, and the late one
    whole = ohlcv_bars(ticks, "36 hours", tie="tick_id").withColumn("bar_time", live.wall_clock("bar_time"))
    mended = again.where("batch_id = 1 and low = 0.5")
    assert mended.count() == 1 and _bars(mended) == _bars(whole.where("low = 0.5"))


def test_a_plan_drains_its_own_queries_over_even_parts(spark, tmp_dir):
    """The events lie in the order of time in a few files, so a third of the time is in few of them."""
    from volcast.plans import registry
    rows = spark.range(0, 6000, 1, 6).select(
        F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 300_000_000).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"), F.lit("a").alias("event_type"), (F.col("id") % 97).cast("double").alias("value"),
        F.lit('{"k": 1}').alias("props"))
    rows.write.parquet(f"{tmp_dir}/events.parquet")
    bars, late = registry.live_run(spark, tmp_dir, "bars", "late")
    assert bars == late == registry.live_run(spark, tmp_dir, "late")[0]
    assert {"bars", "corrected"} <= set(os.listdir(bars)) and not {"forecasts", "routed", "in_events"} & set(os.listdir(bars))
    for at in range(registry.REPLAY_BATCHES):
        part = spark.read.parquet(f"{bars}/in_late/part-{at}")
        sizes = [r["count"] for r in part.groupBy(F.col("_metadata.file_path").alias("f")).count().collect()]
        assert len(sizes) >= 3 and max(sizes) < part.count() / 2
