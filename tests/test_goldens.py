"""Hand-made goldens."""
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import make_bars
from volcast.functions import market as m
from volcast.operators import dataset as ds
from volcast.operators import detect, features
from volcast.streaming.forecaster import SymbolState


def test_constant_price_zero_variance_and_intercept_forecast(spark):
    b = make_bars(spark, [("A", i, 5.0) for i in range(40)])
    f = features.feature_table(b, targets=False).filter("rv_15m IS NOT NULL").collect()
    assert f and all(r.rv_15m == 0 and r.rv_1h == 0 and r.rv_24h == 0 for r in f)
    d = detect.detect_anomalies(b).collect()
    assert all(abs(r.forecast - m.HAR_INTERCEPT) < 1e-18 for r in d)


def test_doubling_price(spark):
    b = make_bars(spark, [("A", i, 2.0 ** i) for i in range(30)])
    f = features.feature_table(b, targets=False).orderBy("event_time").collect()
    assert f[0].log_return is None
    assert all(abs(r.log_return - math.log(2)) < 1e-12 for r in f[1:])
    assert abs(f[20].rv_15m - 15 * math.log(2) ** 2) < 1e-9


def test_parkinson_high_twice_low(spark):
    b = make_bars(spark, [("A", 0, 3.0, 4.0, 2.0), ("A", 1, 3.0, 4.0, 0.0)])
    f = features.feature_table(b, targets=False).orderBy("event_time").collect()
    assert abs(f[0].parkinson_1m - math.log(2) / 4) < 1e-12
    assert abs(f[0].parkinson_1m - 0.1732868) < 1e-7
    assert f[1].parkinson_1m is None   # low = 0: null, no exception


def test_one_row_per_symbol(spark):
    b = make_bars(spark, [("A", 0, 3.0), ("B", 5, 4.0)])
    for r in features.feature_table(b, targets=False).collect():
        assert r.log_return is None and r.rv_15m is None and r.rv_24h is None
        assert r.vol_std_1h is None and r.volume_zscore is None


def test_forward_targets_drop_last_60(spark):
    n = 150
    b = make_bars(spark, [("A", i, 10 + (i % 7)) for i in range(n)])
    f = features.feature_table(b, targets=True)
    assert f.count() == n - 60


def test_sequence_counts(spark):
    for n, want in [(48, 0), (49, 1), (100, 52)]:
        rows = spark.range(n).select(F.lit("A").alias("symbol"),
                                     F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("event_time"),
                                     *[F.col("id").cast("double").alias(c) for c in ds.SEQUENCE_FEATURES],
                                     F.col("id").cast("double").alias("target_15m"))
        s = ds.sequences(rows, chunk_rows=16)
        assert s.count() == want
        if want:
            first = s.orderBy("event_time").first()
            assert len(first.seq) == 48 and len(first.seq[0]) == 8
            assert first.seq[0][0] == 0.0 and first.seq[47][0] == 47.0 and first.target == 48.0


def _z_frame(spark, residuals):
    d = spark.createDataFrame([("A", i, None if r is None else float(r)) for i, r in enumerate(residuals)],
                              "symbol string, i long, residual double")
    spec = Window.partitionBy("symbol").orderBy("i")
    return detect.add_zscore(d, spec).orderBy("i").collect()


def test_z_needs_29_past(spark):
    z = _z_frame(spark, [(-1) ** i for i in range(30)])
    assert z[28].zscore is None      # 28 past values
    assert z[29].zscore is not None  # 29 past values


def test_z_golden_alternating_then_five(spark):
    res = [(-1.0) ** i for i in range(288)] + [5.0]
    z = _z_frame(spark, res)[-1].zscore
    assert abs(z - 5 / math.sqrt(288 / 287)) < 1e-9
    assert abs(z - 4.9913) < 1e-4 and abs(z) > m.ANOMALY_THRESHOLD


def test_stream_state_matches_golden():
    """z of the state's own update against the alternating history: (r - 0) / sqrt(288 / 287)."""
    import datetime as dt

    import numpy as np
    import pandas as pd
    start = dt.datetime(2024, 1, 1)
    closes = 100.0 + np.sin(np.arange(400) / 7.0)
    s = SymbolState(list(closes[:399]), [(-1.0) ** i for i in range(288)], start)
    out = s.update(pd.DataFrame({"bar_time": [start + dt.timedelta(minutes=1)], "close": [closes[399]]}))
    assert abs(out.zscore.iloc[0] - out.residual.iloc[0] / math.sqrt(288 / 287)) < 1e-9
    assert len(s.residuals) == 288 and s.residuals[-1] == out.residual.iloc[0]


def _z_blocked(spark, residuals, chunk=None):
    from volcast.operators.series import CHUNK, RN, over_series
    d = spark.createDataFrame([("A", i, float(r) if r is not None else None) for i, r in enumerate(residuals)],
                              "symbol string, i long, residual double")
    d = d.withColumn("t", F.timestamp_seconds(F.col("i") * 60).cast("timestamp_ntz"))

    def build(frame, spec):
        return detect.add_zscore_blocked(frame, spec, ["symbol", CHUNK], RN)

    out = over_series(d, ["symbol"], "t", build, back=m.Z_PAST_ROWS, chunk_rows=chunk)
    return [r.zscore for r in out.orderBy("i").collect()]


def test_blocked_z_golden_and_gate(spark):
    z = _z_blocked(spark, [(-1.0) ** i for i in range(288)] + [5.0])
    assert abs(z[-1] - 5 / math.sqrt(288 / 287)) < 1e-9
    z = _z_blocked(spark, [(-1) ** i for i in range(30)])
    assert z[28] is None and z[29] is not None
    z = _z_blocked(spark, [2.5] * 100)          # constant: std 0 -> no z
    assert all(v is None for v in z)


def test_blocked_z_equals_sliding(spark):
    import random
    rnd = random.Random(3)
    res = [None] * 15 + [rnd.gauss(0, 1) * (1 + (i // 200)) for i in range(1100)]
    want = [r.zscore for r in _z_frame(spark, res)]
    for chunk in (None, 97, 400):
        got = _z_blocked(spark, res, chunk)
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert (a is None) == (b is None)
            if a is not None:
                assert abs(a - b) < 1e-9
