"""Batch = stream, late data, replay-safe sinks, restart from checkpoint, warm-up state."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, make_bars
from volcast.operators.bars import ohlcv_bars
from volcast.operators import detect
from volcast.sources.tables import load_ticks, table
from volcast.streaming import live
from volcast.streaming.forecaster import SymbolState

SPLIT = dt.datetime(2024, 1, 15)
ONCE = {"availableNow": True}
COLS = ["symbol", "event_time", "close", "rv_15m", "forecast", "residual", "zscore", "is_anomaly"]


def _rows(df):
    return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.select(*COLS).collect())


def _write_halves(spark, d):
    ev = table(spark, SF_SMALL, "events")
    ev.filter(F.col("ts") < F.lit(SPLIT)).coalesce(1).write.parquet(f"{d}/first")
    ev.filter(F.col("ts") >= F.lit(SPLIT)).coalesce(1).write.parquet(f"{d}/second")
    return ev.schema


def _run(spark, src, schema, base, initial=None):
    q = live.start_forecasting(spark, live.event_ticks(live.file_stream(spark, src, schema, max_files=1)),
                               f"{base}/ck", f"{base}/fc", f"{base}/an", initial=initial, trigger=ONCE)
    q.awaitTermination()
    return q


def test_restart_from_checkpoint_equals_unbroken_run(spark, tmp_dir):
    schema = _write_halves(spark, tmp_dir)
    # unbroken: both halves present from the start
    os.makedirs(f"{tmp_dir}/all")
    for h in ["first", "second"]:
        for f in os.listdir(f"{tmp_dir}/{h}"):
            if f.endswith(".parquet"):
                os.link(f"{tmp_dir}/{h}/{f}", f"{tmp_dir}/all/{h}-{f}")
    _run(spark, f"{tmp_dir}/all", schema, f"{tmp_dir}/u")
    unbroken = live.latest(spark.read.parquet(f"{tmp_dir}/u/fc"))
    # interrupted: first half, stop, second half arrives, resume from the same checkpoint
    os.makedirs(f"{tmp_dir}/inc")
    for f in os.listdir(f"{tmp_dir}/first"):
        if f.endswith(".parquet"):
            os.link(f"{tmp_dir}/first/{f}", f"{tmp_dir}/inc/first-{f}")
    _run(spark, f"{tmp_dir}/inc", schema, f"{tmp_dir}/r")
    for f in os.listdir(f"{tmp_dir}/second"):
        if f.endswith(".parquet"):
            os.link(f"{tmp_dir}/second/{f}", f"{tmp_dir}/inc/second-{f}")
    _run(spark, f"{tmp_dir}/inc", schema, f"{tmp_dir}/r")
    resumed = live.latest(spark.read.parquet(f"{tmp_dir}/r/fc"))
    assert _rows(resumed) == _rows(unbroken)
    assert unbroken.count() > 0


def test_stream_equals_batch_on_closed_bars(spark, tmp_dir):
    schema = table(spark, SF_SMALL, "events").schema
    table(spark, SF_SMALL, "events").coalesce(1).write.parquet(f"{tmp_dir}/in")
    _run(spark, f"{tmp_dir}/in", schema, tmp_dir)
    s = live.latest(spark.read.parquet(f"{tmp_dir}/fc"))
    last = s.agg(F.max("event_time")).first()[0]
    b = detect.detect_anomalies(ohlcv_bars(load_ticks(spark, SF_SMALL), tie="tick_id")).filter(F.col("event_time") <= F.lit(last))
    assert _rows(s) == _rows(b)


def test_warm_up_state_equals_unbroken_stream(spark, tmp_dir):
    schema = _write_halves(spark, tmp_dir)
    ticks = load_ticks(spark, SF_SMALL)
    history = ohlcv_bars(ticks.filter(F.col("event_time") < F.lit(SPLIT)))
    _run(spark, f"{tmp_dir}/second", schema, f"{tmp_dir}/w", initial=history)
    warm = live.latest(spark.read.parquet(f"{tmp_dir}/w/fc"))
    full = detect.detect_anomalies(ohlcv_bars(ticks)).filter(F.col("event_time") > F.lit(SPLIT))
    last = warm.agg(F.max("event_time")).first()[0]
    assert _rows(warm) == _rows(full.filter(F.col("event_time") <= F.lit(last)))


def test_replayed_batch_leaves_sinks_unchanged(spark, tmp_dir):
    d = detect.detect_anomalies(ohlcv_bars(load_ticks(spark, SF_SMALL)))
    sink = live.ForecastSink(f"{tmp_dir}/fc", f"{tmp_dir}/an")
    sink(d, 3)
    n1 = spark.read.parquet(f"{tmp_dir}/fc").count()
    sink(d, 3)
    sink(d.limit(5), 4)
    t = spark.read.parquet(f"{tmp_dir}/fc")
    assert t.filter("batch_id = 3").count() == n1
    assert live.latest(t).count() == n1


def test_late_event_dropped_and_counted(spark, tmp_dir):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    os.makedirs(f"{tmp_dir}/in")
    on_time = [(i, base + dt.timedelta(minutes=10 * i), 1, "A", 1.0 + i, '{"k": 1}') for i in range(30)]
    spark.createDataFrame(on_time, schema).coalesce(1).write.parquet(f"{tmp_dir}/in/a")
    # Spark filters late rows with the previous batch's watermark, so the late row comes
    # one batch after the watermark first moves (file order = write order).
    more = [(98, base + dt.timedelta(minutes=301), 1, "A", 2.0, '{"k": 1}')]
    spark.createDataFrame(more, schema).coalesce(1).write.parquet(f"{tmp_dir}/in/b")
    late = [(99, base + dt.timedelta(minutes=5), 1, "A", 1000.0, '{"k": 1}')]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{tmp_dir}/in/c")
    src = live.file_stream(spark, f"{tmp_dir}/in/*/*.parquet", spark.createDataFrame([], schema).schema, max_files=1)
    q = live.start_bars(live.stream_bars(live.event_ticks(src)), f"{tmp_dir}/ck", f"{tmp_dir}/bars", trigger=ONCE)
    q.awaitTermination()
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    bars = spark.read.parquet(f"{tmp_dir}/bars")
    assert bars.agg(F.max("high")).first()[0] < 1000


def _candle(sym, minute, o, h, l, c, v="10", closed=True, n=4):
    t = 1_704_067_200_000 + 60_000 * minute
    return json.dumps({"e": "kline", "E": t, "s": sym, "k": {"t": t - 1000, "T": t, "s": sym, "i": "1s", "o": o, "c": c,
                                                            "h": h, "l": l, "v": v, "V": "5", "n": n, "x": closed}})


def test_candles_keep_high_low_open_and_count_once(spark, tmp_dir):
    """Highs and lows of the candles, first open, summed trades; a record delivered twice counts once;
    an event whose close is no number is no candle."""
    rows = [_candle("A", 1, "3", "9", "1", "2"), _candle("A", 2, "2", "4", "0.5", "3"), _candle("A", 2, "2", "4", "0.5", "3"),
            _candle("A", 3, "3", "99", "0.1", "x"), _candle("A", 4, "3", "50", "0.2", "3", closed=False),
            _candle("A", 70, 5, 6, 4, 5), _candle("A", 200, "1", "1", "1", "1")]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.parquet(f"{tmp_dir}/in")
    src = live.file_stream(spark, f"{tmp_dir}/in", "value string")
    live.start_bars(live.stream_candle_bars(live.kline_candles(src)), f"{tmp_dir}/ck", f"{tmp_dir}/bars",
                    trigger=ONCE).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/bars").orderBy("bar_time")
           .select("open", "high", "low", "close", "volume", "taker_buy_volume", "num_trades").collect()]
    assert got == [(3.0, 9.0, 0.5, 3.0, 20.0, 10.0, 8), (5.0, 6.0, 4.0, 5.0, 10.0, 5.0, 4)]


def test_equal_times_are_ordered_by_tick(spark):
    t = dt.datetime(2024, 1, 1, 0, 30)
    ticks = [("A", t, p, 1.0, 0.5, i) for i, p in ((7, 2.0), (5, 3.0), (9, 1.0))]
    for order in (ticks, ticks[::-1]):
        d = spark.createDataFrame(order, "symbol string, event_time timestamp_ntz, price double, volume double, "
                                  "taker_buy_volume double, tick_id long")
        b = ohlcv_bars(d, tie="tick_id").first()
        assert (b.open, b.close) == (3.0, 1.0)


def test_batch_equals_stream_after_null_residuals(spark):
    """Zero closes give null returns and residuals: frames count rows on both sides."""
    import random
    rnd = random.Random(2)
    closes = [100 + rnd.gauss(0, 1) for _ in range(420)]
    closes[60:80] = [0.0] * 20
    bars = make_bars(spark, [("S", i, c) for i, c in enumerate(closes)])
    want = {r.event_time: r for r in detect.detect_anomalies(bars).collect()}
    rows = bars.select("bar_time", "close").toPandas().sort_values("bar_time")
    for step in (1, 37, 420):
        state, got = SymbolState(), []
        for at in range(0, 420, step):
            got += state.update(rows.iloc[at:at + step]).to_dict("records")
        assert len(got) == len(want)
        for r in got:
            w = want[r["event_time"].to_pydatetime()]
            for c in ("rv_15m", "rv_24h", "forecast", "residual", "zscore", "vol_forecast"):
                assert (w[c] is None) == (r[c] != r[c]), (step, c)
                assert w[c] is None or abs(w[c] - r[c]) < 1e-9
            assert w.is_anomaly == r["is_anomaly"]


def test_missing_sink_table_is_an_error(spark, tmp_dir):
    import pytest
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        live.read_sink(spark, f"{tmp_dir}/never", live.FORECAST_TABLE_SCHEMA).count()


def test_forecast_table_is_pruned_by_day_and_compacted(spark, tmp_dir):
    schema = _write_halves(spark, tmp_dir)
    os.makedirs(f"{tmp_dir}/in")
    for h in ["first", "second"]:
        for f in os.listdir(f"{tmp_dir}/{h}"):
            if f.endswith(".parquet"):
                os.link(f"{tmp_dir}/{h}/{f}", f"{tmp_dir}/in/{h}-{f}")
    _run(spark, f"{tmp_dir}/in", schema, tmp_dir)
    t = live.read_sink(spark, f"{tmp_dir}/fc", live.FORECAST_TABLE_SCHEMA)
    day = t.agg(F.max("day")).first()[0]
    plan = t.filter(F.col("day") == F.lit(day))._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    whole = live.latest(t)
    packed = live.compact_days(spark, f"{tmp_dir}/fc", live.FORECAST_TABLE_SCHEMA, f"{tmp_dir}/days")
    assert _rows(packed) == _rows(whole) and packed.count() > 0
    older = live.compact_days(spark, f"{tmp_dir}/fc", live.FORECAST_TABLE_SCHEMA, f"{tmp_dir}/older", before=day)
    assert older.count() == whole.filter(F.col("day") < F.lit(day)).count()


def test_kafka_shaped_records_to_bars(spark, tmp_dir):
    """(key, value) kline records (the Kafka shape) streamed from files -> bars
    equal the plain aggregates of the closed candles."""
    from volcast.sources import encode as enc
    from volcast.sources import messages as msg
    ev = table(spark, SF_SMALL, "events")
    enc.redelivered(enc.kline_json(ev)).select("key", "value").coalesce(1).write.parquet(f"{tmp_dir}/kafka")
    src = live.file_stream(spark, f"{tmp_dir}/kafka", "key binary, value string")
    q = live.start_bars(live.stream_candle_bars(live.kline_candles(src)), f"{tmp_dir}/ck", f"{tmp_dir}/bars", trigger=ONCE)
    q.awaitTermination()
    got = {(r.symbol, r.bar_time): r for r in spark.read.parquet(f"{tmp_dir}/bars").collect()}
    assert got
    groups = {}
    for r in msg.closed_candles(msg.decode_kline(enc.kline_json(ev))).collect():
        end = r.event_time.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
        groups.setdefault((r.symbol, end), []).append(r)
    for key, bar in got.items():
        rows = sorted(groups[key], key=lambda r: r.event_time)
        assert (bar.open, bar.close) == (rows[0].open, rows[-1].close)
        assert (bar.high, bar.low) == (max(r.high for r in rows), min(r.low for r in rows))
        assert bar.num_trades == sum(r.num_trades for r in rows)


def test_state_after_a_restart_is_that_of_the_closed_bars(spark, tmp_dir):
    """One part, stop, the other part on the same checkpoint; the checkpoint then holds what a plain pass over the
    closed bars leaves behind."""
    schema = _write_halves(spark, tmp_dir)
    for half in ("first", "second"):
        os.makedirs(f"{tmp_dir}/in/{half}")
        for f in os.listdir(f"{tmp_dir}/{half}"):
            if f.endswith(".parquet"):
                os.link(f"{tmp_dir}/{half}/{f}", f"{tmp_dir}/in/{half}/{f}")
        q = live.start_forecasting(spark, live.event_ticks(live.file_stream(spark, f"{tmp_dir}/in/*", schema)), f"{tmp_dir}/ck",
                                   f"{tmp_dir}/fc", f"{tmp_dir}/an", trigger=ONCE)
        q.awaitTermination()
    held = {r.symbol: r for r in live.symbol_states(spark, f"{tmp_dir}/ck").collect()}
    last = max(r.last_time for r in held.values())
    bars = ohlcv_bars(load_ticks(spark, SF_SMALL), tie="tick_id").filter(F.col("bar_time") <= F.lit(last)).toPandas()
    assert set(held) == set(bars.symbol)
    for symbol, rows in bars.groupby("symbol"):
        state = SymbolState()
        state.update(rows[["bar_time", "close"]])
        r, known = held[symbol], state.residuals[state.residuals == state.residuals]
        assert (r.n_closes, r.n_residuals, r.n_known_residuals) == (len(state.closes), len(state.residuals), len(known))
        assert abs(r.sum_residuals - known.sum()) < 1e-9 and r.last_close == state.closes[-1] and r.last_time == state.last_time


def test_state_of_another_query_is_an_error(spark, tmp_dir):
    import pytest
    schema = _write_halves(spark, tmp_dir)
    live.start_provisional(live.event_ticks(live.file_stream(spark, f"{tmp_dir}/first", schema)), f"{tmp_dir}/ck", f"{tmp_dir}/p",
                           trigger=ONCE).awaitTermination()
    with pytest.raises(ValueError, match="no keyed forecaster"):
        live.symbol_states(spark, f"{tmp_dir}/ck")


def test_provisional_bars_are_replaced_and_marked(spark, tmp_dir):
    """T4: an open bar comes out at once, is replaced by its later states, and is final once the watermark has passed it;
    a tick behind the watermark changes nothing; writing a batch again changes nothing."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    base = dt.datetime(2024, 1, 1)
    batches = [[(1, base + dt.timedelta(minutes=5), 1.0), (2, base + dt.timedelta(minutes=70), 2.0)],
               [(3, base + dt.timedelta(minutes=80), 9.0), (4, base + dt.timedelta(minutes=75), 0.0)],
               [(5, base + dt.timedelta(minutes=7), 500.0), (6, base + dt.timedelta(minutes=200), 4.0)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame([(k, t, 1, "A", v, "{}") for k, t, v in rows], schema).coalesce(1).write.parquet(f"{tmp_dir}/in/b{i}")
        src = live.file_stream(spark, f"{tmp_dir}/in/*", schema)
        live.start_provisional(live.event_ticks(src), f"{tmp_dir}/ck", f"{tmp_dir}/out", trigger=ONCE).awaitTermination()
    rows = live.read_sink(spark, f"{tmp_dir}/out", live.PROVISIONAL_SCHEMA)
    got = {}
    for r in live.provisional_history(rows).orderBy("batch", "bar_time").collect():
        got.setdefault(r.batch, []).append((r.bar_time.hour, r.open, r.high, r.low, r.close, r.num_trades, r.is_final))
    first = (1, 2.0, 2.0, 2.0, 2.0, 1, True)
    assert got == {1: [first, (2, 3.0, 3.0, 3.0, 3.0, 1, False)], 2: [first, (2, 3.0, 10.0, 1.0, 10.0, 3, False)],
                   3: [first, (2, 3.0, 10.0, 1.0, 10.0, 3, True), (4, 5.0, 5.0, 5.0, 5.0, 1, False)]}
    made = rows.drop("watermark_ms", "day", "batch_id")
    before = sorted(map(tuple, rows.collect()))
    again = spark.createDataFrame(rows.filter("batch_id = 0").select(*made.columns).collect(), made.schema)
    live.ProvisionalSink(f"{tmp_dir}/out", 30_000)(again, 0)
    after = live.read_sink(spark, f"{tmp_dir}/out", live.PROVISIONAL_SCHEMA)
    assert sorted(map(tuple, after.collect())) == before
