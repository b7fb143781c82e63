"""Halo-chunk windows equal whole-series windows, for any chunk size and skew."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import make_bars
from volcast.operators import features
from volcast.operators.series import RN, apply_over_series, number_rows, over_series, time_segment


def _skewed_bars(spark, seed=7):
    rnd = random.Random(seed)
    rows = []
    # "hot" holds most rows; "cold" a few; "tiny" one row.
    price = 100.0
    for i in range(700):
        price *= 1 + rnd.uniform(-0.02, 0.02)
        rows.append(("hot", i * 2 + (i % 3 == 0), price, price * 1.01, price * 0.99, rnd.uniform(0, 10),
                     rnd.uniform(0, 5)))
    for i in range(40):
        rows.append(("cold", i * 5, 50 + i, 51 + i, 49 + i, 1.0 + i % 4, 0.5))
    rows.append(("tiny", 3, 10.0, 10.0, 10.0, 1.0, 0.0))
    return make_bars(spark, rows)


def _collect(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_number_rows_matches_row_number(spark):
    b = _skewed_bars(spark)
    n = number_rows(b, ["symbol"], ["bar_time"], time_segment("bar_time", "6 hours"))
    w = Window.partitionBy("symbol").orderBy("bar_time")
    ref = b.withColumn("rn2", F.row_number().over(w))
    a = _collect(n.select("symbol", "bar_time", F.col(RN).alias("rn")), ["symbol", "bar_time", "rn"])
    r = _collect(ref.select("symbol", "bar_time", F.col("rn2").cast("long").alias("rn")), ["symbol", "bar_time", "rn"])
    assert a == r


def _plain_features(bars):
    """The feature definitions on plain whole-symbol windows."""
    from volcast.functions import market as m
    d = bars.withColumnRenamed("bar_time", "event_time")
    w = Window.partitionBy("symbol").orderBy("event_time")
    last = lambda n: w.rowsBetween(-(n - 1), 0)
    ahead = lambda n: w.rowsBetween(1, n)
    d = d.withColumn("prev_close", F.lag("close").over(w))
    d = d.withColumn("log_return", m.log_return("close", "prev_close"))
    d = d.withColumn("sq", F.col("log_return") * F.col("log_return")).withColumn("p", m.parkinson_bar("high", "low"))
    d = d.withColumns({"rv_15m": F.sum("sq").over(last(15)), "rv_1h": F.sum("sq").over(last(60)),
                       "rv_4h": F.sum("sq").over(last(240)), "rv_24h": F.sum("sq").over(last(1440)),
                       "parkinson_15m": F.avg("p").over(last(15)), "parkinson_1h": F.avg("p").over(last(60)),
                       "vol_mean": F.avg("volume").over(last(60)), "vol_std_1h": F.stddev_samp("volume").over(last(60)),
                       "buy_ratio": F.try_divide("taker_buy_volume", "volume"),
                       "n15": F.count("sq").over(ahead(15)), "n60": F.count("sq").over(ahead(60)),
                       "target_15m": F.log1p(F.sum("sq").over(ahead(15))), "target_1h": F.log1p(F.sum("sq").over(ahead(60)))})
    d = d.withColumn("volume_zscore", F.when(F.col("vol_std_1h") > 1e-12, (F.col("volume") - F.col("vol_mean")) / F.col("vol_std_1h")))
    return d.filter("n15 = 15 AND n60 = 60")


@pytest.mark.parametrize("chunk", [7, 64, 5000])
def test_feature_table_equals_plain_windows(spark, chunk):
    b = _skewed_bars(spark)
    cols = ["symbol", "event_time", "prev_close", "log_return", "rv_15m", "rv_1h", "rv_4h", "rv_24h",
            "parkinson_15m", "parkinson_1h", "vol_std_1h", "volume_zscore", "buy_ratio", "target_15m", "target_1h"]
    got = features.feature_table(b, targets=True, chunk_rows=chunk)
    ref = _plain_features(b)
    assert _collect(got, cols) == _collect(ref, cols)


def test_over_series_forward_and_back_halo(spark):
    b = _skewed_bars(spark)
    spec_ref = Window.partitionBy("symbol").orderBy("bar_time")

    def build(frame, spec):
        return frame.withColumns({"s": F.sum("close").over(spec.rowsBetween(-20, 11)),
                                  "c": F.count("close").over(spec.rowsBetween(-20, 11))})

    got = over_series(b, ["symbol"], "bar_time", build, back=20, ahead=11, chunk_rows=5)
    ref = b.withColumns({"s": F.sum("close").over(spec_ref.rowsBetween(-20, 11)),
                         "c": F.count("close").over(spec_ref.rowsBetween(-20, 11))})
    assert _collect(got, ["symbol", "bar_time", "s", "c"]) == _collect(ref, ["symbol", "bar_time", "s", "c"])


def test_halo_plan_has_no_symbol_only_window(spark):
    b = _skewed_bars(spark)
    plan = features.feature_table(b)._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan


def test_hot_symbol_never_forms_one_group(spark):
    """A symbol with most of the rows is cut into bounded (symbol, chunk) groups; numbering
    cells are bounded by the segment (a day of minute bars)."""
    from volcast.operators.series import CHUNK, TOTAL, with_halo
    n_hot, chunk, back, ahead = 60_000, 4096, 1440, 60
    hot = spark.range(n_hot).select(F.lit("hot").alias("symbol"),
                                    F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("bar_time"),
                                    (F.lit(100.0) + F.sin(F.col("id") / 50.0)).alias("close"))
    cold = spark.range(500).select(F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("symbol"),
                                   F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("bar_time"),
                                   F.lit(50.0).alias("close"))
    b = hot.unionByName(cold)
    seg = time_segment("bar_time")
    cells = b.groupBy("symbol", seg.alias("seg")).count().agg(F.max("count")).first()[0]
    assert cells <= 1440
    numbered = number_rows(b, ["symbol"], ["bar_time"], seg)
    groups = with_halo(numbered, back, ahead, chunk).groupBy("symbol", CHUNK).count()
    biggest = groups.agg(F.max("count")).first()[0]
    assert biggest <= chunk + back + ahead
    assert groups.filter("symbol = 'hot'").count() == -(-n_hot // chunk)
    # and the frames still equal whole-series frames
    spec = Window.partitionBy("symbol").orderBy("bar_time")
    got = over_series(b, ["symbol"], "bar_time",
                      lambda f, s: f.withColumn("s", F.sum("close").over(s.rowsBetween(-back, 0))),
                      back=back, chunk_rows=chunk)
    ref = b.withColumn("s", F.sum("close").over(spec.rowsBetween(-back, 0)))
    diff = got.join(ref.withColumnRenamed("s", "s2"), ["symbol", "bar_time"]) \
              .agg(F.max(F.abs(F.col("s") - F.col("s2"))), F.count(F.lit(1))).first()
    assert diff[1] == n_hot + 500 and diff[0] < 1e-6


def _spread():
    """Close less the smallest of the three closes before, its own and the one after (a closure, so that it travels by value)."""
    def spread(rows):
        closes = rows["close"].tolist()
        low = [min(closes[max(0, i - 3):i + 2]) for i in range(len(closes))]
        return rows[["symbol", "bar_time"]].assign(spread=[c - m for c, m in zip(closes, low)])
    return spread


@pytest.mark.parametrize("chunk", [1, 5, 64, 5000])
def test_user_function_on_chunks_equals_the_whole_series(spark, chunk):
    b = _skewed_bars(spark)
    out = apply_over_series(b, ["symbol"], "bar_time", _spread(), "symbol string, bar_time timestamp_ntz, spread double",
                            back=3, ahead=1, chunk_rows=chunk)
    w = Window.partitionBy("symbol").orderBy("bar_time").rowsBetween(-3, 1)
    want = b.withColumn("spread", F.col("close") - F.min("close").over(w))
    cols = ["symbol", "bar_time", "spread"]
    assert _collect(out, cols) == _collect(want, cols)


def test_user_function_odd_rows_and_wrong_length(spark):
    schema = "symbol string, bar_time timestamp_ntz, spread double"
    b = _skewed_bars(spark)
    odd = b.unionByName(b.limit(3).withColumn("symbol", F.lit(None).cast("string")))
    assert apply_over_series(odd, ["symbol"], "bar_time", _spread(), schema, back=3, ahead=1).count() == b.count()
    assert apply_over_series(b.limit(0), ["symbol"], "bar_time", _spread(), schema, back=3).count() == 0
    with pytest.raises(Exception, match="returned"):
        apply_over_series(b, ["symbol"], "bar_time", lambda r: r[["symbol", "bar_time"]].assign(spread=0.0)[1:], schema, back=3).collect()
