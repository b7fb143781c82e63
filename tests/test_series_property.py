"""Property: halo-chunk frames equal whole-series frames for any lengths, chunk sizes and reach."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from volcast.operators.series import over_series

series = st.lists(st.integers(min_value=1, max_value=120), min_size=1, max_size=3)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lengths=series, chunk=st.integers(min_value=1, max_value=40), back=st.integers(min_value=0, max_value=30),
       ahead=st.integers(min_value=0, max_value=12), seed=st.integers(min_value=0, max_value=1000))
def test_halo_equals_plain(spark, lengths, chunk, back, ahead, seed):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for s, n in enumerate(lengths):
        for i in range(n):
            # irregular spacing and values; some nulls
            v = None if (i * 7 + seed) % 11 == 0 else float((i * 31 + seed) % 97)
            rows.append((f"s{s}", base + dt.timedelta(minutes=i * (1 + (i + seed) % 5)), v))
    df = spark.createDataFrame(rows, "symbol string, t timestamp_ntz, v double")

    def cols(spec):
        fr = spec.rowsBetween(-back, ahead)
        return {"s": F.sum("v").over(fr), "c": F.count("v").over(fr), "l": F.lag("v", max(back, 1)).over(spec)}

    got = over_series(df, ["symbol"], "t", lambda f, spec: f.withColumns(cols(spec)),
                      back=max(back, 1), ahead=ahead, chunk_rows=chunk)
    ref = df.withColumns(cols(Window.partitionBy("symbol").orderBy("t")))
    key = ["symbol", "t", "s", "c", "l"]
    assert sorted(map(repr, got.select(*key).collect())) == sorted(map(repr, ref.select(*key).collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lengths=series, chunk=st.integers(min_value=3, max_value=40), w=st.integers(min_value=2, max_value=25),
       seed=st.integers(min_value=0, max_value=1000))
def test_block_windows_equal_sliding(spark, lengths, chunk, w, seed):
    """window_sums / window_moments (current and past windows) equal sliding frames, nulls included."""
    from volcast.operators.series import CHUNK, RN, window_moments, window_sums
    base = dt.datetime(2024, 1, 1)
    rows = []
    for s, n in enumerate(lengths):
        for i in range(n):
            v = None if (i * 5 + seed) % 7 == 0 else float(((i * 37 + seed) % 89) - 40) / 3.0
            rows.append((f"s{s}", base + dt.timedelta(minutes=i), v))
    df = spark.createDataFrame(rows, "symbol string, t timestamp_ntz, v double")

    def build(f, spec):
        f = window_sums(f, spec, ["symbol", CHUNK], RN, "v", w, "bs")
        f = window_moments(f, spec, ["symbol", CHUNK], RN, "v", w, past=False, prefix="cm")
        return window_moments(f, spec, ["symbol", CHUNK], RN, "v", w, past=True, prefix="pm")

    got = over_series(df, ["symbol"], "t", build, back=w, chunk_rows=chunk)
    spec = Window.partitionBy("symbol").orderBy("t")
    cur, past = spec.rowsBetween(-(w - 1), 0), spec.rowsBetween(-w, -1)
    ref = df.withColumns({"bs": F.sum("v").over(cur), "cm_n": F.count("v").over(cur),
                          "cm_mean": F.avg("v").over(cur), "cm_std": F.stddev_samp("v").over(cur),
                          "pm_n": F.count("v").over(past), "pm_mean": F.avg("v").over(past),
                          "pm_std": F.stddev_samp("v").over(past)})
    cols = ["bs", "cm_n", "cm_mean", "cm_std", "pm_n", "pm_mean", "pm_std"]

    def rows_of(d):
        out = {}
        for r in d.select("symbol", "t", *cols).collect():
            out[(r.symbol, r.t)] = [None if r[c] is None else (r[c] if isinstance(r[c], int) else round(r[c], 9))
                                    for c in cols]
        return out

    a, b = rows_of(got), rows_of(ref)
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None), (k, a[k], b[k])
            if x is not None:
                assert abs(x - y) < 1e-7, (k, a[k], b[k])
