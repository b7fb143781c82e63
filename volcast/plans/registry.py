"""Registered plans: name -> (spark, sf_dir) -> DataFrame, and name -> oracle SQL.

Each plan reads the driver's tables (hourly bars of ``events`` for the market
plans) and runs over the whole table.  Floating outputs are rounded to 6 places
once, at the end, in both the plan and its SQL twin.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.functions import market as m
from volcast.functions.market import epoch_to_millis, millis_to_ntz
from volcast.operators import dataset as ds
from volcast.operators import detect
from volcast.operators import models as md
from volcast.operators import quality as qa
from volcast.operators import bars as br
from volcast.operators import features as ft
from volcast.operators.series import apply_over_series
from volcast.plans import sql as S
from volcast.plans.common import (bars, column_profiles, feature_rows, features, forecast_table,
                                  known_in_app, once_per_app, rounded, scaled, sequence_table, split_features, split_part,
                                  symbol_dictionary)
from volcast.plans.common import har_fit as fitted_har
from volcast.session import fresh_scratch, ship_package, source_signature
from volcast.sinks.files import write_csv, write_lines
from volcast.sources import archives as ar
from volcast.sources import encode as enc
from volcast.sources import klines as kl
from volcast.sources import messages as msg
from volcast.sources import records as rec
from volcast.sources.tables import archive_and_gap_files, load_ticks, table
from volcast.streaming import live

Plan = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def plan(name: str, oracle: str | None = None):
    def deco(fn: Plan) -> Plan:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)          # Python workers import volcast from the shipped zip
            return fn(spark, sf_dir)
        PLANS[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco


# ---------------------------------------------------------------- bars & features

@plan("ohlcv_bars", S.with_(S.BARS, f"""
SELECT symbol, bar_time, {S.rnd('open', 'high', 'low', 'close', 'volume', 'taker_buy_volume')}, num_trades
FROM bars"""))
def ohlcv_bars(spark, sf_dir):
    """Hourly OHLCV bars per symbol."""
    return rounded(bars(spark, sf_dir))


@plan("ohlcv_bars_ties", S.with_(S.bars_sql("hour", S.TICKS.replace("ts AS event_time", "date_trunc('hour', ts) AS event_time")), f"""
SELECT symbol, bar_time, {S.rnd('open', 'high', 'low', 'close', 'volume', 'taker_buy_volume')}, num_trades
FROM bars"""))
def ohlcv_bars_ties(spark, sf_dir):
    """A1: bars of ticks whose times are cut to the hour, so all ticks of a bar are tied in time and the
    tick id decides which is first and last."""
    ticks = load_ticks(spark, sf_dir).withColumn("event_time", F.date_trunc("hour", "event_time").cast("timestamp_ntz"))
    return rounded(br.ohlcv_bars(ticks, tie="tick_id"))


@plan("log_returns", S.with_(S.RETURNS, f"""
SELECT symbol, event_time, {S.rnd('close', 'prev_close', 'log_return', 'sq_return')} FROM sq"""))
def log_returns(spark, sf_dir):
    """Previous close, log return, squared return."""
    f = ft.short_frames(bars(spark, sf_dir), lambda frame, spec, _: ft.add_returns(frame, spec), back=1)
    return rounded(f.select("symbol", "event_time", "close", "prev_close", "log_return", "sq_return"))


@plan("realised_variance", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('rv_15m', 'rv_1h', 'rv_4h', 'rv_24h')} FROM feat"""))
def realised_variance(spark, sf_dir):
    """Trailing realised variance over 15 / 60 / 240 / 1440 rows."""
    f = feature_rows(spark, sf_dir)
    return rounded(f.select("symbol", "event_time", "rv_15m", "rv_1h", "rv_4h", "rv_24h"))


@plan("parkinson", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('parkinson_1m', 'parkinson_15m', 'parkinson_1h')} FROM feat"""))
def parkinson(spark, sf_dir):
    """One-bar Parkinson and its 15 / 60 row means."""
    f = ft.short_frames(bars(spark, sf_dir), lambda frame, spec, _: ft.add_parkinson(frame, spec), back=60)
    return rounded(f.select("symbol", "event_time", "parkinson_1m", "parkinson_15m", "parkinson_1h"))


def _volume_frames(spark, sf_dir):
    return ft.short_frames(bars(spark, sf_dir), lambda frame, spec, keys: ft.add_volume(frame, spec, keys, "_rn"), back=120)


@plan("volume_features", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('vol_mean_1h', 'vol_std_1h', 'volume_zscore', 'buy_ratio')} FROM feat"""))
def volume_features(spark, sf_dir):
    """Trailing volume mean / std / z-score and buy ratio."""
    f = _volume_frames(spark, sf_dir)
    return rounded(f.select("symbol", "event_time", "vol_mean_1h", "vol_std_1h", "volume_zscore", "buy_ratio"))


@plan("volume_zscore", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('volume', 'volume_zscore')} FROM feat"""))
def volume_zscore(spark, sf_dir):
    """Volume against its trailing 60-row mean and sample std."""
    f = _volume_frames(spark, sf_dir)
    return rounded(f.select("symbol", "event_time", "volume", "volume_zscore"))


@plan("buy_ratio", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('taker_buy_volume', 'buy_ratio')} FROM feat"""))
def buy_ratio(spark, sf_dir):
    """Taker-buy share of volume (null when volume is zero)."""
    b = bars(spark, sf_dir).withColumnRenamed("bar_time", "event_time")
    return rounded(b.select("symbol", "event_time", "taker_buy_volume", ft.buy_ratio().alias("buy_ratio")))


@plan("forward_targets", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('rv_15m', 'target_15m', 'target_1h')} FROM targets"""))
def forward_targets(spark, sf_dir):
    """Forward realised variance over rows +1..+15 / +1..+60, full frames only."""
    f = features(spark, sf_dir)
    return rounded(f.select("symbol", "event_time", "rv_15m", "target_15m", "target_1h"))


#: Rows per chunk of the one-minute plans: small, so that a symbol's series is cut into many chunks (ten and
#: more at the smallest scale factors that have a thousand minutes) and offsets, halos and clamping all take part.
MINUTE_CHUNK = 180


@plan("features_1m", S.with_(S.bars_sql("minute") + S._RETURNS_TAIL + S.FEATURES[len(S.RETURNS):], f"""
SELECT symbol, event_time, {S.rnd('close', 'rv_15m', 'rv_1h', 'rv_4h', 'rv_24h', 'parkinson_15m', 'parkinson_1h',
                                  'volume_zscore', 'buy_ratio', 'target_15m', 'target_1h')} FROM targets"""))
def features_1m(spark, sf_dir):
    """D3 W1-W7 F3 at the reference's width: features and targets of one-minute bars, every symbol in many chunks."""
    f = ft.feature_table(bars(spark, sf_dir, "1 minute"), targets=True, chunk_rows=MINUTE_CHUNK)
    return rounded(f.select("symbol", "event_time", "close", "rv_15m", "rv_1h", "rv_4h", "rv_24h", "parkinson_15m",
                            "parkinson_1h", "volume_zscore", "buy_ratio", "target_15m", "target_1h"))


# ---------------------------------------------------------------- detector

_FORECAST_NUM = ("close", "rv_15m", "rv_1h", "rv_24h", "forecast", "vol_forecast", "vol_realized",
                 "residual", "zscore")


@plan("har_zscore", S.with_(S.DETECT, f"""
SELECT symbol, event_time, day, {S.rnd(*_FORECAST_NUM)}, is_anomaly FROM forecasts"""))
def har_zscore(spark, sf_dir):
    """Served HAR forecast, log residual, past-288 z-score, flag."""
    return rounded(forecast_table(spark, sf_dir))


@plan("har_zscore_1m", S.with_(S.detect_sql("minute"), f"""
SELECT symbol, event_time, day, {S.rnd(*_FORECAST_NUM)}, is_anomaly FROM forecasts"""))
def har_zscore_1m(spark, sf_dir):
    """A1 W1-W3 M3 M4 W8 M5 on one-minute bars (the reference's bar width): a 1440-row
    frame is a day of minutes, the z-score reaches 1728 rows back through the halo of many chunks."""
    return rounded(detect.detect_anomalies(bars(spark, sf_dir, "1 minute"), chunk_rows=MINUTE_CHUNK))


@plan("anomalies", S.with_(S.DETECT, f"""
SELECT symbol, event_time, {S.rnd('close', 'forecast', 'rv_15m', 'zscore')}
FROM forecasts WHERE is_anomaly"""))
def anomalies(spark, sf_dir):
    """K6 / Y-7: flagged rows only."""
    d = forecast_table(spark, sf_dir).filter("is_anomaly")
    return rounded(d.select("symbol", "event_time", "close", "forecast", "rv_15m", "zscore"))


@plan("alert_rate", S.with_(S.DETECT, """
SELECT symbol, count(*) AS n_scored, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS n_alerts,
       round(avg(CASE WHEN is_anomaly THEN 1.0 ELSE 0.0 END), 6) AS alert_rate
FROM forecasts GROUP BY symbol"""))
def alert_rate(spark, sf_dir):
    """Share of scored bars flagged, per symbol."""
    d = forecast_table(spark, sf_dir)
    flag = F.col("is_anomaly").cast("int")
    return rounded(d.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.sum(flag).cast("long").alias("n_alerts"),
        F.avg(flag.cast("double")).alias("alert_rate")))


# ---------------------------------------------------------------- data quality


STEP_S = 3600   # hourly bars


@plan("coverage", S.with_(S.BARS, """
SELECT symbol, count(*) AS n_rows, min(bar_time) AS first_time, max(bar_time) AS last_time
FROM bars GROUP BY symbol ORDER BY symbol LIMIT 25"""))
def coverage(spark, sf_dir):
    """Q1 A2 O1: bars and span of the first 25 symbols (the report's length)."""
    return qa.coverage(bars(spark, sf_dir).withColumnRenamed("bar_time", "event_time"))


_OVERLAP = S._split_ctes("events", "ts", "ov") + """,
archive AS (SELECT e.* FROM events e, ov_c c WHERE epoch_us(e.ts) < c.val_cut),
gapfiles AS (SELECT e.* FROM events e, ov_c c WHERE epoch_us(e.ts) >= c.train_cut),
overlap AS (SELECT * FROM archive UNION ALL SELECT * FROM gapfiles)"""


@plan("duplicate_count", S.with_(_OVERLAP.lstrip(",\n"), """
SELECT count(*) AS n_rows, count(DISTINCT (event_type, ts)) AS n_distinct,
       count(*) - count(DISTINCT (event_type, ts)) AS n_duplicates FROM overlap"""))
def duplicate_count(spark, sf_dir):
    """Archive files and gap files overlap; count the repeated (symbol, time) keys."""
    return qa.duplicate_count(archive_and_gap_files(table(spark, sf_dir, "events")), ["event_type", "ts"])


@plan("dedupe_events", S.with_(_OVERLAP.lstrip(",\n"), """
SELECT event_id, ts, user_id, event_type, round(value, 6) + 0.0 AS value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id) AS k FROM overlap) WHERE k = 1"""))
def dedupe_events(spark, sf_dir):
    """Union of overlapping sources, one row per (symbol, time), first by event_id."""
    u = archive_and_gap_files(table(spark, sf_dir, "events"))
    d = qa.dedupe(u, ["event_type", "ts"], ["event_id"])
    return rounded(d.select("event_id", "ts", "user_id", "event_type", "value", "props"))


_GAPS = S.BARS + f""",
g0 AS (SELECT symbol, bar_time AS event_time, lag(bar_time) OVER (PARTITION BY symbol ORDER BY bar_time) AS prev_time
       FROM bars),
gaps AS (
  SELECT symbol, event_time, prev_time, (epoch_us(event_time) - epoch_us(prev_time)) // 1000000 AS gap_s
  FROM g0 WHERE prev_time IS NOT NULL),
gap_rows AS (SELECT *, gap_s // {STEP_S} - 1 AS missing_bars FROM gaps WHERE gap_s > {STEP_S})"""


@plan("gap_report", S.with_(_GAPS, "SELECT symbol, event_time, prev_time, gap_s, missing_bars FROM gap_rows"))
def gap_report(spark, sf_dir):
    """Bars preceded by a hole longer than one bar."""
    return qa.gap_report(bars(spark, sf_dir).withColumnRenamed("bar_time", "event_time"), STEP_S)


@plan("gap_fill_plan", S.with_(_GAPS, f"""
SELECT symbol, prev_time AS gap_after, page_no,
       epoch_ms(prev_time) + {STEP_S * 1000} + page_no * {qa.REST_PAGE_ROWS * STEP_S * 1000} AS page_start_ms,
       epoch_ms(prev_time) + {STEP_S * 1000} + page_no * {qa.REST_PAGE_ROWS * STEP_S * 1000}
         + (least({qa.REST_PAGE_ROWS}, missing_bars - page_no * {qa.REST_PAGE_ROWS}) - 1) * {STEP_S * 1000} AS page_end_ms,
       CAST(least({qa.REST_PAGE_ROWS}, missing_bars - page_no * {qa.REST_PAGE_ROWS}) AS BIGINT) AS n_bars
FROM gap_rows, LATERAL (SELECT unnest(range(0, CAST(ceil(missing_bars / {qa.REST_PAGE_ROWS}) AS BIGINT))) AS page_no)
WHERE missing_bars > 0"""))
def gap_fill_plan(spark, sf_dir):
    """REST pages (1000 bars each) that re-fetch every missing bar."""
    g = qa.gap_report(bars(spark, sf_dir).withColumnRenamed("bar_time", "event_time"), STEP_S)
    return qa.gap_fill_plan(g, STEP_S)


# ---------------------------------------------------------------- split & scale

@plan("chrono_split", S.with_(S.SPLIT, "SELECT symbol, event_time, split FROM split"))
def chrono_split(spark, sf_dir):
    """Train / val / test by the 80 % and 90 % cuts of the global span."""
    return split_features(spark, sf_dir).select("symbol", "event_time", "split")


@plan("split_sizes", S.with_(S.SPLIT, "SELECT split, count(*) AS n_rows FROM split GROUP BY split"))
def split_sizes(spark, sf_dir):
    """Q5: rows per split."""
    return split_features(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


_STAT_COLS = [f"{c}_{s}" for c in ds.SCALE_COLUMNS for s in ("mean", "std")]


@plan("scaler_stats", S.with_(S.SCALED, f"SELECT symbol, {S.rnd(*_STAT_COLS)} FROM stats"))
def scaler_stats_plan(spark, sf_dir):
    """Per-symbol mean and sample std of the seven scaled columns (train only)."""
    p = column_profiles(spark, sf_dir)
    parts = [F.col("profile")[c][part].alias(f"{c}_{name}") for c in ds.SCALE_COLUMNS
             for part, name in (("centre", "mean"), ("spread", "std"))]
    return rounded(p.select("symbol", *parts))


_SCALED_OUT = [*ds.SCALE_COLUMNS, "volume_zscore", "target_15m", "target_1h"]


@plan("scaled_features", S.with_(S.SCALED, f"SELECT symbol, event_time, split, {S.rnd(*_SCALED_OUT)} FROM scaled"))
def scaled_features(spark, sf_dir):
    """Standardised features of all splits, incomplete rows dropped."""
    return rounded(scaled(spark, sf_dir).select("symbol", "event_time", "split", *_SCALED_OUT))


@plan("scale_check", S.with_(S.SCALED, f"""
SELECT symbol, count(*) AS n_rows, round(avg(rv_15m), 6) + 0.0 AS mean_rv_15m,
       round(stddev_samp(rv_15m), 6) + 0.0 AS std_rv_15m
FROM scaled WHERE split = 'train' GROUP BY symbol"""))
def scale_check(spark, sf_dir):
    """Scaled train rv_15m has mean ~0 and std ~1 for every symbol."""
    d = scaled(spark, sf_dir).filter("split = 'train'")
    return rounded(d.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.avg("rv_15m").alias("mean_rv_15m"),
                                           F.stddev_samp("rv_15m").alias("std_rv_15m")))


@plan("symbol_ids", S.with_(S.SEQUENCES, """
SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) - 1 AS INTEGER) AS symbol_id
FROM (SELECT DISTINCT symbol FROM seqs WHERE split = 'train')"""))
def symbol_ids(spark, sf_dir):
    """Dense ids over the sorted distinct symbols that have training sequences."""
    return symbol_dictionary(spark, sf_dir)


@plan("url_ids", """
SELECT url, CAST(row_number() OVER (ORDER BY url) - 1 AS INTEGER) AS url_id
FROM (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)""")
def url_ids(spark, sf_dir):
    """Dense ids over sorted distinct page addresses, most of which share their first characters."""
    return ds.dense_ids(table(spark, sf_dir, "pages"), "url", "url_id")


_SEQ_OUT = [*ds.SEQUENCE_FEATURES, "target_15m"]


@plan("every_fifth", S.with_(S.SCALED + S._sampled("test", "samp"),
                             f"SELECT symbol, event_time, {S.rnd(*_SEQ_OUT)} FROM samp"))
def every_fifth(spark, sf_dir):
    """Every 5th scaled test row per symbol, in time order."""
    d = scaled(spark, sf_dir).filter("split = 'test'").select("symbol", "event_time", *_SEQ_OUT)
    return rounded(ds.drop_incomplete(ds.every_kth(d), _SEQ_OUT))


_SEQ_CELLS = [f"{kind}_{c}" for c in S.SEQUENCE_COLUMNS for kind in ("sum", "turn")]


@plan("sequences", S.with_(S.SEQUENCES, f"""
SELECT symbol, split, event_time, CAST(seq_len AS INTEGER) AS seq_len, {S.rnd('target', *_SEQ_CELLS)} FROM seqs"""))
def sequences(spark, sf_dir):
    """W11 Y-4: 48 x 8 windows of every-5th scaled rows of every split and the next row's target, reported with
    two numbers per feature over all 48 cells: their sum and their sum weighted by position 1..48."""
    def cells(i, weighted):
        def add(total, row, j):
            return total + row[i] * (j if weighted else F.lit(1.0))
        return F.aggregate(F.transform("seq", lambda row, j: F.struct(row.alias("r"), (j + 1).cast("double").alias("j"))),
                           F.lit(0.0), lambda total, x: add(total, x["r"], x["j"]))

    reported = [cells(i, kind == "turn").alias(f"{kind}_{c}") for i, c in enumerate(ds.SEQUENCE_FEATURES)
                for kind in ("sum", "turn")]
    return rounded(sequence_table(spark, sf_dir).select("symbol", "split", "event_time", F.size("seq").alias("seq_len"),
                                                        "target", *reported))


@plan("target_scaling", S.with_(S.SEQUENCES, """
SELECT count(*) AS n_train, round(avg(target), 6) + 0.0 AS y_mean, round(stddev_pop(target), 6) + 0.0 AS y_std
FROM seqs WHERE split = 'train'"""))
def target_scaling(spark, sf_dir):
    """Mean and population deviation of the training sequences' targets."""
    train = sequence_table(spark, sf_dir).filter("split = 'train'")
    return rounded(train.agg(F.count(F.lit(1)).alias("n_train"), *md.target_moments()))


# ---------------------------------------------------------------- models

_FIT_OUT = ["intercept", "w_15m", "w_1h", "w_24h", "y_mean"]


@plan("har_fit", S.with_(S.HAR_FIT, f"SELECT n_train, {S.rnd(*_FIT_OUT)} FROM har_fit"))
def har_fit(spark, sf_dir):
    """M1: HAR-RV least squares on the train split (normal equations, one aggregate)."""
    return rounded(md.fit_har(split_part(spark, sf_dir, "train")))


@plan("model_metrics", S.with_(S.HAR_FIT + """,
test AS (
  SELECT s.target_15m AS y,
         f.intercept + f.w_15m * ln(1 + s.rv_15m) + f.w_1h * ln(1 + s.rv_1h) + f.w_24h * ln(1 + s.rv_24h) AS har,
         f.y_mean AS mean
  FROM split s, har_fit f WHERE s.split = 'test'),
per_model AS (
  SELECT 'HAR' AS model, y, har AS p FROM test UNION ALL SELECT 'mean' AS model, y, mean AS p FROM test)""", """
SELECT model, count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) + 0.0 AS rmse,
       round(avg(abs(y - p)), 6) + 0.0 AS mae
FROM per_model WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY model"""))
def model_metrics(spark, sf_dir):
    """RMSE / MAE of the fitted HAR model and the mean predictor on test."""
    fit = fitted_har(spark, sf_dir)
    test = md.score_har_fitted(split_part(spark, sf_dir, "test"), fit)
    return rounded(md.regression_metrics(test, "target_15m",
                                         {"HAR": "har_pred", "mean": md.mean_target(fit)}))


_SCORE_OUT = ["rv_15m", "forecast", "residual", "vol_forecast", "vol_realized"]


@plan("har_score", S.with_(S.FEATURES + f""",
hs AS (SELECT symbol, event_time, rv_15m, {S._har()} AS forecast FROM feat),
hr AS (
  SELECT *,
    CASE WHEN rv_15m + 1e-12 > 0 AND forecast + 1e-12 > 0 THEN ln(rv_15m + 1e-12) - ln(forecast + 1e-12) END
      AS residual,
    CASE WHEN forecast IS NOT NULL THEN sqrt(greatest(exp(forecast) - 1, 0.0)) * 100 END AS vol_forecast,
    CASE WHEN rv_15m IS NOT NULL THEN sqrt(greatest(rv_15m, 0.0)) * 100 END AS vol_realized
  FROM hs)""", f"SELECT symbol, event_time, {S.rnd(*_SCORE_OUT)} FROM hr"))
def har_score(spark, sf_dir):
    """Served-model forecast, residual and percent volatilities
    for every feature row (no warm-up gate)."""
    f = detect.score_har(feature_rows(spark, sf_dir))
    return rounded(f.select("symbol", "event_time", *_SCORE_OUT))


@plan("har_residual", S.with_(S.DETECT, f"SELECT symbol, event_time, {S.rnd('rv_15m', 'forecast', 'residual')} FROM forecasts"))
def har_residual(spark, sf_dir):
    """M4: log(rv_15m + eps) - log(forecast + eps) for every scored bar."""
    return rounded(forecast_table(spark, sf_dir).select("symbol", "event_time", "rv_15m", "forecast", "residual"))


@plan("vol_percent", S.with_(S.DETECT, f"SELECT symbol, event_time, {S.rnd('vol_forecast', 'vol_realized')} FROM forecasts"))
def vol_percent(spark, sf_dir):
    """Forecast and realised volatility in percent (sqrt of clamped variance x 100)."""
    return rounded(forecast_table(spark, sf_dir).select("symbol", "event_time", "vol_forecast", "vol_realized"))


@plan("latest_forecasts", S.with_(S.DETECT + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, day ORDER BY event_time DESC) AS recency
           FROM forecasts)""", f"""
SELECT symbol, day, event_time, CAST(recency AS INTEGER) AS recency, {S.rnd('forecast', 'residual', 'zscore')}
FROM ranked WHERE recency <= 3"""))
def latest_forecasts(spark, sf_dir):
    """The newest three forecasts of each (symbol, day) — the store's newest-first
    clustering, as a top-k per key (window per symbol-day, never per symbol)."""
    from pyspark.sql import Window
    d = forecast_table(spark, sf_dir)
    w = Window.partitionBy("symbol", "day").orderBy(F.col("event_time").desc())
    d = d.withColumn("recency", F.row_number().over(w)).filter("recency <= 3")
    return rounded(d.select("symbol", "day", "event_time", "recency", "forecast", "residual", "zscore"))


PANEL_WIDTH = "6 hours"


@plan("forecast_panel", S.with_(S.DETECT, f"""
SELECT symbol, time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '1970-01-01 00:00:00') + INTERVAL 6 HOUR AS panel_time,
       count(*) AS n_bars,
       round(avg(vol_realized), 6) + 0.0 AS vol_realized, round(avg(vol_forecast), 6) + 0.0 AS vol_forecast,
       round(max(abs(zscore)), 6) + 0.0 AS max_abs_z,
       CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies,
       CAST(4.0 AS DOUBLE) AS z_upper, CAST(-4.0 AS DOUBLE) AS z_lower
FROM forecasts GROUP BY symbol, time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '1970-01-01 00:00:00')"""))
def forecast_panel(spark, sf_dir):
    """Realised vs forecast volatility and |z| with the ±4 bands, per symbol and 6 hours."""
    d = forecast_table(spark, sf_dir)
    g = d.groupBy("symbol", F.window("event_time", PANEL_WIDTH).alias("w")).agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.avg("vol_realized").alias("vol_realized"), F.avg("vol_forecast").alias("vol_forecast"),
        F.max(F.abs("zscore")).alias("max_abs_z"),
        F.sum(F.col("is_anomaly").cast("long")).alias("n_anomalies"))
    out = g.select("symbol", F.col("w.end").alias("panel_time"), "n_bars", "vol_realized", "vol_forecast",
                   "max_abs_z", "n_anomalies", F.lit(m.ANOMALY_THRESHOLD).alias("z_upper"),
                   F.lit(-m.ANOMALY_THRESHOLD).alias("z_lower"))
    return rounded(out)


@plan("sequence_model_metrics", S.with_(S.SEQUENCES + S._har_fit() + """,
on_rows AS (
  SELECT q.split, q.target AS y,
         f.intercept + f.w_15m * ln(1 + t.rv_15m) + f.w_1h * ln(1 + t.rv_1h) + f.w_24h * ln(1 + t.rv_24h) AS har,
         f.y_mean AS mean
  FROM seqs q LEFT JOIN targets t ON q.symbol = t.symbol AND q.event_time = t.event_time, har_fit f),
per_model AS (
  SELECT split, 'HAR' AS model, y, har AS p FROM on_rows UNION ALL SELECT split, 'mean' AS model, y, mean AS p FROM on_rows),
per_split AS (
  SELECT split, model, count(*) AS n, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae
  FROM per_model WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY split, model),
overall AS (
  SELECT 'all' AS split, model, CAST(sum(n) AS BIGINT) AS n, sum(mse * n) / sum(n) AS mse, sum(mae * n) / sum(n) AS mae
  FROM per_split GROUP BY model)""", """
SELECT split, model, n, round(sqrt(mse), 6) + 0.0 AS rmse, round(mae, 6) + 0.0 AS mae
FROM (SELECT * FROM per_split UNION ALL SELECT * FROM overall)"""))
def sequence_model_metrics(spark, sf_dir):
    """HAR and mean predictor on the rows that have sequences — left join on (symbol, event_time),
    n, RMSE and MAE per split, and over all splits as the sample-weighted mean of the losses.  The sequence
    model's own row of this table (``common.sequence_model``) is no SQL and is held by a test."""
    return rounded(md.losses_by_split(_on_sequence_rows(spark, sf_dir), {"HAR": "har_pred", "mean": "mean_pred"}))


def _on_sequence_rows(spark, sf_dir):
    fit = fitted_har(spark, sf_dir)
    har = md.score_har_fitted(features(spark, sf_dir).select("symbol", "event_time", *md.HAR_INPUTS), fit)
    rows = sequence_table(spark, sf_dir).select("symbol", "event_time", "split", "target")
    return (rows.join(har.select("symbol", "event_time", "har_pred"), ["symbol", "event_time"], "left")
            .withColumn("mean_pred", md.mean_target(fit)))


@plan("sequence_comparison")
def sequence_comparison(spark, sf_dir):
    """:func:`sequence_model_metrics` with two sequence models fitted on all training sequences as more
    models: the linear one on the flat window (SEQ) and the order-aware reservoir learner (RES).  No SQL: the tests hold
    RES against a plain numpy fit, and SEQ against the mean predictor."""
    from volcast.plans.common import reservoir_scores, sequence_model
    if sequence_table(spark, sf_dir).filter("split = 'train'").isEmpty():     # nothing to fit: no rows of these models
        return sequence_model_metrics(spark, sf_dir)
    seq = sequence_model(spark, sf_dir).select("symbol", "event_time", "seq_pred")
    res = reservoir_scores(spark, sf_dir).select("symbol", "event_time", "res_pred")
    keys = ["symbol", "event_time"]
    rows = _on_sequence_rows(spark, sf_dir).join(seq, keys, "left").join(res, keys, "left")
    return rounded(md.losses_by_split(rows, {"SEQ": "seq_pred", "RES": "res_pred", "HAR": "har_pred", "mean": "mean_pred"}))


@plan("har_artifact", S.with_(S.HAR_FIT, f"SELECT n_train, {S.rnd(*_FIT_OUT)} FROM har_fit"))
def har_artifact(spark, sf_dir):
    """K9: the fitted HAR coefficients saved as a model artefact and loaded back."""
    from volcast.sinks.models import load_har, save_har
    path = fresh_scratch(spark, "har-model")
    save_har(md.fit_har(split_part(spark, sf_dir, "train")), path)
    return rounded(load_har(spark, path))


@plan("symbol_lookup", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('close', 'rv_15m', 'target_15m')} FROM targets WHERE symbol = 'click'"""))
def symbol_lookup(spark, sf_dir):
    """one symbol from the feature table — a partition-pruned read of ``symbol=click``."""
    f = features(spark, sf_dir).filter(F.col("symbol") == "click")
    return rounded(f.select("symbol", "event_time", "close", "rv_15m", "target_15m"))


def _sample_sql(fraction: float) -> str:
    return f"""
SELECT * FROM events
WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|' || event_type), 1, 15) AS BIGINT)
      < CAST({fraction!r} * 1152921504606846976.0 AS BIGINT)"""


def _sample(spark, sf_dir, fraction):
    return rounded(qa.hash_sample(table(spark, sf_dir, "events"), ["event_id", "event_type"], fraction))


@plan("hash_sample", _sample_sql(0.01))
def hash_sample(spark, sf_dir):
    """F8: deterministic 1 % sample of the ticks by a hash of each row's identity (a sampling operator)."""
    return _sample(spark, sf_dir, 0.01)


@plan("hash_sample_fine", _sample_sql(0.0001))
def hash_sample_fine(spark, sf_dir):
    """F8 at the reference's fraction, 0.0001."""
    return _sample(spark, sf_dir, 0.0001)


@plan("hash_sample_all", _sample_sql(1.0))
def hash_sample_all(spark, sf_dir):
    """F8 at its upper end: a fraction of 1 keeps every row."""
    return _sample(spark, sf_dir, 1.0)


# ---------------------------------------------------------------- ingestion


_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
_TAKER = "CASE WHEN user_id % 2 = 0 THEN value ELSE 0.0 END"
_CLOSE = "(value + 1.0 + (user_id % 3) * 0.25)"
_MS_NTZ = "make_timestamp((epoch_us(ts) // 1000) * 1000)"  # ms truncated, like UnixMilli
_CANDLE = ["open", "close", "high", "low", "volume", "taker_buy_volume"]


@plan("decode_kline_json", f"""
SELECT event_type AS symbol, {_MS_NTZ} AS event_time,
       {", ".join(f"round(x_{c}, 6) + 0.0 AS {c}" for c in _CANDLE)},
       CAST({_K} AS BIGINT) AS num_trades
FROM (SELECT *, value + 1.0 AS x_open, {_CLOSE} AS x_close, {_CLOSE} + 0.5 AS x_high, (value + 1.0) * 0.5 AS x_low,
             value AS x_volume, {_TAKER} AS x_taker_buy_volume FROM events)
WHERE value >= 1 AND NOT ({_K} BETWEEN 92 AND 94)""")
def decode_kline_json(spark, sf_dir):
    """Kline event JSON (prices as strings or bare numbers) decoded to
    typed candles; open candles dropped."""
    d = msg.closed_candles(msg.decode_kline(enc.kline_json(table(spark, sf_dir, "events"))))
    return rounded(d.select("symbol", "event_time", *_CANDLE, "num_trades"))


@plan("decode_envelope", f"""
SELECT lower(event_type) || '@kline_1s' AS stream, event_type AS symbol, {_MS_NTZ} AS event_time,
       round({_CLOSE}, 6) + 0.0 AS close
FROM events WHERE {_K} < 92 AND value >= 1""")
def decode_envelope(spark, sf_dir):
    """Combined-stream envelopes -> routed (key = symbol, value = inner JSON)
    records for closed candles; broken envelopes are skipped."""
    r = msg.route(enc.envelopes(table(spark, sf_dir, "events")))
    return rounded(r.select("stream", "symbol", "event_time", "close"))


TOPIC_PARTITIONS = 12


#: The routed records and the topic partition of each symbol, for the SQL twins.
_TOPIC = f"""r AS (
  SELECT event_type AS symbol, {_MS_NTZ} AS event_time, {_CLOSE} AS close FROM events WHERE {_K} < 92 AND value >= 1),
h AS (
  SELECT symbol, list_reduce(list_transform(range(1, length(symbol) + 1), lambda i: ascii(substr(symbol, i::INT, 1))::BIGINT),
                             lambda a, b: (xor(a, b) * {msg.FNV_FACTOR}) & 4294967295, {msg.FNV_START}::BIGINT) AS f
  FROM (SELECT DISTINCT symbol FROM r)),
p AS (SELECT symbol, abs((CASE WHEN f >= 2147483648 THEN f - 4294967296 ELSE f END) % {TOPIC_PARTITIONS})::INTEGER AS partition_no FROM h)"""


@plan("route_partitions", f"""
WITH {_TOPIC}
SELECT symbol, partition_no, count(*) AS n_records, min(event_time) AS first_time, max(event_time) AS last_time
FROM r JOIN p USING (symbol) GROUP BY symbol, partition_no""")
def route_partitions(spark, sf_dir):
    """K4: the routed records laid out by the topic partition that the hash balancer gives their key (12 partitions);
    shown is what each partition holds of each symbol: every symbol is in one partition only."""
    laid = msg.by_partition(msg.route(enc.envelopes(table(spark, sf_dir, "events"))), TOPIC_PARTITIONS)
    return laid.groupBy("symbol", "partition_no").agg(F.count(F.lit(1)).alias("n_records"), F.min("event_time").alias("first_time"),
                                                      F.max("event_time").alias("last_time"))


LOG_BATCHES = 2


def _drain_log(spark, sf_dir) -> str:
    """The routed records as a log of two appends.  A query reads the first in bounded batches and stops; started again on
    its checkpoint, it reads the second."""
    base = fresh_scratch(spark, "log")
    routed = msg.route(enc.envelopes(table(spark, sf_dir, "events"))).select("key", "value", F.col("event_time").alias("time"))
    first, last, n = routed.agg(F.min("time"), F.max("time"), F.count(F.lit(1))).first()
    if n == 0:
        spark.createDataFrame([], f"{rec.RECORD_SCHEMA}, batch_id long").write.partitionBy("batch_id").parquet(f"{base}/read")
        return base
    half = F.lit(first + (last - first) / 2)
    bound = max(n // 2 // LOG_BATCHES, 1)
    sink = functools.partial(live.keep_batch, path=f"{base}/read")
    for part in (F.col("time") < half, F.col("time") >= half):
        rec.append(routed.where(part), f"{base}/records", TOPIC_PARTITIONS)
        q = (rec.record_messages(spark, f"{base}/records", max_offsets=bound).writeStream.foreachBatch(sink)
             .option("checkpointLocation", f"{base}/ck").trigger(processingTime="0 seconds").start())
        q.processAllAvailable()
        q.stop()
    return base


@plan("stream_offsets", f"""
WITH {_TOPIC}
SELECT partition_no, count(*) AS n_records, count(*) AS n_offsets, CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset,
       min(event_time) AS first_time, max(event_time) AS last_time, round(sum(close), 4) + 0.0 AS sum_close, TRUE AS in_batches
FROM r JOIN p USING (symbol) GROUP BY partition_no""")
def stream_offsets(spark, sf_dir):
    """The routed records appended to a log twice and read by offsets in bounded batches, by a query that was
    stopped and started again between: what each topic partition gave, no offset lost or read twice, decoded closes."""
    src = f"{sf_dir.rstrip('/')}/events.parquet"
    base = once_per_app(spark, ("log", src, source_signature(spark, src)), lambda: _drain_log(spark, sf_dir))
    read = spark.read.schema(f"{rec.RECORD_SCHEMA}, batch_id long").parquet(f"{base}/read")
    candles = msg.closed_candles(msg.decode_kline(read.select("partition_no", "offset", "time", "batch_id", F.col("value").cast("string").alias("value"))))
    d = candles.groupBy("partition_no").agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("offset").alias("n_offsets"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.min_by("time", "offset").alias("first_time"), F.max_by("time", "offset").alias("last_time"),
        F.sum("close").alias("sum_close"), (F.countDistinct("batch_id") > 2).alias("in_batches"))
    return rounded(d, 4)


@plan("decode_rejects", f"""
SELECT count(*) AS n_messages,
       CAST(sum(CASE WHEN {_K} >= 95 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_envelope,
       CAST(sum(CASE WHEN {_K} BETWEEN 92 AND 94 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_event,
       CAST(sum(CASE WHEN {_K} < 92 AND value < 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_open,
       CAST(sum(CASE WHEN {_K} < 92 AND value >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_routed
FROM events""")
def decode_rejects(spark, sf_dir):
    """F2 K8: message totals of the routing step (bad envelopes, bad events, open, routed)."""
    return msg.reject_counts(enc.envelopes(table(spark, sf_dir, "events")))


_KROW_SQL = S.BARS + f""",
krows AS (
  SELECT symbol, epoch_ms(bar_time) - {STEP_S * 1000} AS open_time, open, high, low, close, volume,
         epoch_ms(bar_time) - 1 AS close_time, volume * close AS quote_volume, num_trades,
         taker_buy_volume AS taker_buy_base, taker_buy_volume * close AS taker_buy_quote
  FROM bars)"""
_KNUM = ["open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base", "taker_buy_quote"]


def _typed_klines(d):
    return d.select("symbol", "open_time", *[kl.to_double(c).alias(c) for c in _KNUM], "close_time", "num_trades")


@plan("warmup_closes", S.with_(S.BARS, "SELECT symbol, bar_time, round(close, 6) + 0.0 AS close FROM bars"))
def warmup_closes(spark, sf_dir):
    """REST pages decoded to the forecaster's warm-up input — close time (field 6)
    and close (field 4) per symbol; close time + 1 ms is the bar label, so warm-up and live
    bars share one key."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    return rounded(kl.warmup_closes(kl.decode_rest_pages(enc.rest_pages(rows))))


@plan("decode_rest_page", S.with_(_KROW_SQL, f"""
SELECT symbol, open_time, {S.rnd(*_KNUM)}, close_time, num_trades FROM krows"""))
def decode_rest_page(spark, sf_dir):
    """REST pages (JSON arrays of 12-element mixed arrays, 1000 per page) decoded
    back into typed kline rows."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    return rounded(_typed_klines(kl.decode_rest_pages(enc.rest_pages(rows))))


@plan("rest_page_status", S.with_(S.BARS + """,
paged AS (SELECT symbol, (row_number() OVER (PARTITION BY symbol ORDER BY bar_time) - 1) // 100 AS page_no FROM bars)""", """
SELECT symbol, page_no, CASE WHEN length(symbol) % 2 = 0 THEN 'unreadable' ELSE 'ok' END AS status,
       CASE WHEN length(symbol) % 2 = 0 THEN 0 ELSE count(*) END AS n_rows
FROM paged GROUP BY symbol, page_no"""))
def rest_page_status(spark, sf_dir):
    """Status and row count of every REST page (100 rows each), some of them cut short on the way."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    return kl.rest_page_status(enc.cut_pages(enc.rest_pages(rows, page_rows=100)))


@plan("csv_rejects", S.with_(_KROW_SQL, """
SELECT symbol, count(*) AS n_rows, count(*) FILTER (WHERE (open_time // 3600000) % 7 <> 0) AS n_with_time,
       CAST(count(*) FILTER (WHERE (open_time // 3600000) % 7 = 0) AS BIGINT) AS n_rejected
FROM krows GROUP BY symbol"""))
def csv_rejects(spark, sf_dir):
    """Archive CSV in which every seventh hour has an open time that is no number: rows read, rows with a
    time, and rejects per symbol (the reader keeps rejects with nulls)."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    bad = F.pmod(F.floor(F.col("open_time") / 3_600_000), F.lit(7)) == 0
    text = F.col("open_time").cast("string")
    rows = rows.withColumn("open_time", F.when(bad, F.concat(F.lit("x"), text)).otherwise(text))
    out = fresh_scratch(spark, "klines-rejects")
    write_csv(rows.select(*kl.KLINE_FIELDS, "symbol"), out, partition_by=["symbol"])
    return kl.csv_rejects(kl.read_kline_csv(spark, f"{out}/symbol=*/*.csv", symbol_pattern=r"/symbol=([^/]+)/"))


@plan("epoch_normalise", """
SELECT event_id, raw_open_time AS open_time,
       CASE WHEN raw_open_time > 100000000000000 THEN raw_open_time // 1000 ELSE raw_open_time END AS open_time_ms,
       make_timestamp(CASE WHEN raw_open_time > 100000000000000 THEN raw_open_time // 1000
                           ELSE raw_open_time END * 1000) AS event_time
FROM (SELECT event_id, CASE WHEN value >= 50 THEN epoch_us(ts) ELSE epoch_us(ts) // 1000 END AS raw_open_time FROM events)""")
def epoch_normalise(spark, sf_dir):
    """Archive epochs in µs or ms (X-2) -> ms -> timestamp."""
    from volcast.functions.market import ntz_micros
    us = ntz_micros("ts")
    raw = F.when(F.col("value") >= 50, us).otherwise(F.floor(us / 1000)).cast("long")
    d = table(spark, sf_dir, "events").select("event_id", raw.alias("open_time"))
    ms = epoch_to_millis("open_time")
    return d.select("event_id", "open_time", ms.alias("open_time_ms"), millis_to_ntz(ms).alias("event_time"))


@plan("csv_klines", S.with_(_KROW_SQL, f"""
SELECT symbol, open_time, {S.rnd(*_KNUM)}, close_time, num_trades FROM krows"""))
def csv_klines(spark, sf_dir):
    """Bars written as header-less archive CSV (one folder per symbol), read
    back by glob with the explicit schema, symbol recovered from the file path."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    out = fresh_scratch(spark, "klines-csv")
    write_csv(rows.select(*kl.KLINE_FIELDS, "symbol"), out, partition_by=["symbol"])
    raw = kl.read_kline_csv(spark, f"{out}/symbol=*/*.csv", symbol_pattern=r"/symbol=([^/]+)/")
    return rounded(_typed_klines(raw.filter(F.col("_corrupt").isNull())))


@plan("etl_from_csv", S.with_(S.FEATURES, f"""
SELECT symbol, event_time, {S.rnd('close', 'rv_15m', 'rv_24h', 'parkinson_15m', 'volume_zscore', 'buy_ratio',
                                  'target_15m', 'target_1h')} FROM targets"""))
def etl_from_csv(spark, sf_dir):
    """The ETL notebook end to end — archive CSV (before the
    90 % cut) and gap-file CSV (from the 80 % cut, with µs epochs) overlap; both are read by
    one glob, normalised, de-duplicated on (symbol, time) and turned into features + targets."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    train_cut, val_cut = ds.split_cuts(rows.select(millis_to_ntz("open_time").alias("t")), "t").first()
    t = millis_to_ntz("open_time")
    out = fresh_scratch(spark, "klines-etl")
    write_csv(rows.filter(t < F.lit(val_cut)).select(*kl.KLINE_FIELDS, "symbol"), f"{out}/archive",
              partition_by=["symbol"])
    gap = rows.filter(t >= F.lit(train_cut)).withColumn("open_time", F.col("open_time") * 1000)  # µs epochs
    write_csv(gap.select(*kl.KLINE_FIELDS, "symbol"), f"{out}/gap", partition_by=["symbol"])
    raw = kl.read_kline_csv(spark, f"{out}/*/symbol=*/*.csv", symbol_pattern=r"/symbol=([^/]+)/")
    norm = kl.normalise_klines(raw.filter(F.col("_corrupt").isNull()))
    unique = qa.dedupe(kl.klines_to_bars(norm), ["symbol", "bar_time"],
                       ["num_trades", "open", "high", "low", "close", "volume", "taker_buy_volume"])
    # Archive rows are labelled by open time; the bar table by window end.
    unique = unique.withColumn("bar_time", F.col("bar_time") + F.expr(f"INTERVAL {STEP_S} SECONDS"))
    f = ft.feature_table(unique, targets=True)
    return rounded(f.select("symbol", "event_time", "close", "rv_15m", "rv_24h", "parkinson_15m",
                            "volume_zscore", "buy_ratio", "target_15m", "target_1h"))


@plan("manifest_missing", S.with_(S.BARS + """,
days AS (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE)
                AS period FROM events),
syms AS (SELECT DISTINCT event_type AS symbol FROM events),
wanted AS (SELECT symbol, period FROM syms, days),
present AS (SELECT symbol, CAST(bar_time - INTERVAL 1 HOUR AS DATE) AS period FROM bars GROUP BY ALL
            HAVING count(*) = 24)""", """
SELECT w.symbol, w.period, w.symbol || '-1h-' || strftime(w.period, '%Y-%m-%d') AS file_name,
       w.symbol || '/1h/' || w.symbol || '-1h-' || strftime(w.period, '%Y-%m-%d') || '.zip' AS path
FROM wanted w ANTI JOIN present p ON w.symbol = p.symbol AND w.period = p.period"""))
def manifest_missing(spark, sf_dir):
    """Daily archive files per symbol over the data's span, minus the
    days already complete (24 hourly bars) — what a re-run would download."""
    ev = table(spark, sf_dir, "events")
    first, last = ev.agg(F.min(F.to_date("ts"))).scalar(), ev.agg(F.max(F.to_date("ts"))).scalar()
    syms = ev.select(F.col("event_type").alias("symbol")).distinct()
    wanted = ar.work_manifest(syms, first, last, unit="day", interval_label="1h")
    b = bars(spark, sf_dir)
    day = F.to_date(F.col("bar_time") - F.expr("INTERVAL 1 HOUR"))
    present = (b.groupBy("symbol", day.alias("period")).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") == 24))
    return ar.missing_files(wanted, present, ["symbol", "period"])


@plan("checksum_verify", """
SELECT file_name, expected, actual,
       CASE WHEN actual = expected THEN 'ok' ELSE 'mismatch' END AS status
FROM (SELECT 'doc-' || doc_id || '.txt' AS file_name, sha256(text) AS actual,
             CASE WHEN source = 'src7' THEN sha256(text || '#') ELSE sha256(text) END AS expected
      FROM documents)""")
def checksum_verify(spark, sf_dir):
    """SHA-256 of every document's bytes against its manifest line."""
    content, manifest = enc.checksum_manifest(table(spark, sf_dir, "documents"))
    return ar.verify_checksums(content, manifest)


@plan("checksum_files", """
WITH files AS (
  SELECT event_type || '-' || strftime(ts, '%Y-%m-%d') || '.csv' AS file_name, day(ts) AS d,
         string_agg(event_id || ',' || (epoch_us(ts) // 1000) || ',' || user_id, chr(10) ORDER BY event_id) || chr(10) AS text
  FROM events GROUP BY 1, 2),
lines AS (
  SELECT file_name, CASE WHEN d % 7 = 0 THEN sha256(text || '#') ELSE sha256(text) END AS expected FROM files WHERE d % 5 <> 0
  UNION ALL SELECT file_name || '.old', sha256(text) FROM files WHERE d % 11 = 0)
SELECT coalesce(f.file_name, m.file_name) AS file_name, expected, sha256(text) AS actual,
       CASE WHEN text IS NULL THEN 'missing_file' WHEN expected IS NULL THEN 'missing_checksum'
            WHEN sha256(text) = expected THEN 'ok' ELSE 'mismatch' END AS status
FROM files f FULL OUTER JOIN lines m ON f.file_name = m.file_name""")
def checksum_files(spark, sf_dir):
    """One file of ticks per symbol and day in the shared folder, read as bytes by the ``binaryFile``
    source and held against manifest files; files without a line and lines without a file are reported."""
    src = f"{sf_dir.rstrip('/')}/events.parquet"

    def publish() -> str:
        base = fresh_scratch(spark, "tick-files")
        lines = enc.tick_files(table(spark, sf_dir, "events"))
        write_lines(lines, f"{base}/files", "file_name", ["event_id"])
        enc.tick_file_manifest(lines).write.text(f"{base}/manifest")
        return base

    base = once_per_app(spark, ("tick-files", src, source_signature(spark, src)), publish)
    content = ar.binary_files(spark, f"{base}/files", r"file_name=([^/]+)/", recursive=True).where("file_name <> ''")
    return ar.verify_checksums(content, ar.manifest_lines(spark, f"{base}/manifest"))


@plan("archive_unpack", S.with_(_KROW_SQL, f"""
SELECT symbol, open_time, {S.rnd(*_KNUM)}, close_time, num_trades FROM krows"""))
def archive_unpack(spark, sf_dir):
    """One zip archive per symbol-day of kline CSV, unpacked and parsed back to typed rows."""
    rows = enc.kline_rows(bars(spark, sf_dir), STEP_S * 1000)
    day = F.date_format(millis_to_ntz("open_time"), "yyyy-MM-dd")
    lines = rows.select("symbol", "open_time", day.alias("day"),
                        F.concat_ws(",", *[F.col(c).cast("string") for c in kl.KLINE_FIELDS]).alias("line"))
    lines = lines.withColumn("file_name", F.format_string("%s-1h-%s", F.col("symbol"), F.col("day")))
    zips = ar.pack_zip(lines, ["symbol", "day"], order_col="open_time")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kl.KLINE_CSV_SCHEMA.fields)
    parsed = ar.unpack_zip(zips).select("file_name", F.from_csv("line", ddl).alias("k"))
    k = parsed.select(F.regexp_extract("file_name", r"^([^-]+)-", 1).alias("symbol"), "k.*")
    return rounded(_typed_klines(k))


MEDIAN_ROWS = 60


def _weighted_medians(rows):
    """Lower median of the last closes weighted by trades: the smallest close at which half of the trades are reached."""
    closes, trades = rows["close"].to_numpy(), rows["num_trades"].to_numpy()
    medians = []
    for i in range(len(rows)):
        c, n = closes[max(0, i - MEDIAN_ROWS + 1):i + 1], trades[max(0, i - MEDIAN_ROWS + 1):i + 1]
        by_close = c.argsort(kind="stable")
        reached = n[by_close].cumsum()
        medians.append(c[by_close][(2 * reached >= reached[-1]).argmax()])
    return rows[["symbol", "bar_time", "close"]].assign(median_close=medians)


@plan("weighted_median", S.with_(S.BARS + f"""
, n AS (SELECT symbol, bar_time, close, num_trades, row_number() OVER (PARTITION BY symbol ORDER BY bar_time) AS i FROM bars),
seen AS (SELECT a.symbol, a.bar_time, a.close, b.close AS c, sum(b.num_trades) AS trades
         FROM n a JOIN n b ON a.symbol = b.symbol AND b.i BETWEEN a.i - {MEDIAN_ROWS - 1} AND a.i GROUP BY ALL),
reached AS (SELECT *, sum(trades) OVER (PARTITION BY symbol, bar_time ORDER BY c) AS upto,
                   sum(trades) OVER (PARTITION BY symbol, bar_time) AS whole FROM seen)""", """
SELECT symbol, bar_time, round(close, 6) + 0.0 AS close, round(min(c), 6) + 0.0 AS median_close
FROM reached WHERE 2 * upto >= whole GROUP BY symbol, bar_time, close"""))
def weighted_median(spark, sf_dir):
    """A user's pandas function (median of the last 60 closes weighted by trades) applied per series on bounded
    chunks that carry the 59 rows before them."""
    b = bars(spark, sf_dir).select("symbol", "bar_time", "close", "num_trades")
    return rounded(apply_over_series(b, ["symbol"], "bar_time", _weighted_medians,
                                     "symbol string, bar_time timestamp_ntz, close double, median_close double",
                                     back=MEDIAN_ROWS - 1))


# ---------------------------------------------------------------- streaming



REPLAY_BATCHES = 3


#: The independent queries of the live topology.
LIVE_QUERIES = ("forecast", "bars", "provisional", "late", "route", "candles", "warm")


def live_run(spark, sf_dir, *names: str) -> list[str]:
    """Drain ``events`` through queries of the live topology (all, if none is named), each once per application: bars,
    provisional bars, late ticks, forecasts + anomalies (foreachBatch), routed messages, candle bars and forecasts from a
    warm start, each with its own checkpoint.  The records come in ``REPLAY_BATCHES`` parts; after each the queries stop,
    and start again on their checkpoints.  Returned is, per name, the folder that holds what the query wrote.

    The queries share nothing but their input, so a plan drains those that it reads; the ones of a call run side by side."""
    src = f"{sf_dir.rstrip('/')}/events.parquet"
    signature = source_signature(spark, src)
    names = names or LIVE_QUERIES
    drained: list[str] = []

    def drain() -> str:
        if not drained:
            rest = [n for n in names if not known_in_app(spark, ("live", n, src, signature))]
            drained.append(_drain_live(spark, sf_dir, rest))
        return drained[0]

    return [once_per_app(spark, ("live", n, src, signature), drain) for n in names]


def _replay_cuts(rows: DataFrame, time: str) -> list:
    first, last = rows.agg(F.min(time), F.max(time)).first()
    span = (last - first) // dt.timedelta(microseconds=1)
    return [first + dt.timedelta(microseconds=span * i // REPLAY_BATCHES) for i in range(1, REPLAY_BATCHES)]


def _replay(rows: DataFrame, time: str, path: str, cuts: list, at: int, late: DataFrame | None = None) -> None:
    """Write part ``at`` of ``rows`` (between two cuts in time) into a folder of its own; ``late`` goes with the last part.
    Rows that lie in the order of time have a part in a few of their partitions only, so they are dealt out again, by ranges
    of time of like size: the streams read a part with all cores."""
    part = rows
    if at:
        part = part.filter(F.col(time) >= F.lit(cuts[at - 1]))
    if at < REPLAY_BATCHES - 1:
        part = part.filter(F.col(time) < F.lit(cuts[at]))
    elif late is not None:
        part = part.unionByName(late)
    part.repartitionByRange(rows.sparkSession.sparkContext.defaultParallelism, time).write.parquet(f"{path}/part-{at}")


def late_copies(events: DataFrame) -> DataFrame:
    """Ticks that arrive days late: copies, as new ticks with other values, of every tenth id in the first
    three tenths of the time (the watermark that filters a batch is that of two batches before)."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    old = events.filter((F.col("ts") < F.lit(first + (last - first) * 3 / 10)) & (F.pmod("event_id", F.lit(10)) == 0))
    return old.withColumns({"event_id": F.col("event_id") + 10 ** 12, "value": F.col("value") + 1000.0})


def _drain_live(spark, sf_dir, names) -> str:
    base = fresh_scratch(spark, "live")
    events = table(spark, sf_dir, "events")
    cuts = _replay_cuts(events, "ts")
    inputs = {}        # folder: rows, their time, cuts, late rows
    if {"route", "candles"} & set(names):
        inputs["in_events"] = events, "ts", cuts, None
    if {"forecast", "bars", "provisional", "late"} & set(names):
        inputs["in_late"] = events, "ts", cuts, late_copies(events)
    if "warm" in names:
        history, recent = _history_and_recent(spark, sf_dir)
        inputs["in_bars"] = recent, "bar_time", _replay_cuts(recent, "bar_time"), None
    drain = {"trigger": {"availableNow": True}}
    # a handful of symbols here; on a cluster this is the number of state partitions to keep
    state = drain | {"state_partitions": spark.sparkContext.defaultParallelism}

    def stream(name, schema=events.schema):
        return live.file_stream(spark, f"{base}/{name}/*", schema)

    def start() -> dict:
        """Independent queries, run side by side as a deployment would."""
        starts = {
            "forecast": lambda: live.start_forecasting(
                spark, live.event_ticks(stream("in_late")), f"{base}/ck_forecast", f"{base}/forecasts", f"{base}/anomalies",
                report_path=f"{base}/report", **state),
            "bars": lambda: live.start_bars(live.stream_bars(live.event_ticks(stream("in_late"))), f"{base}/ck_bars",
                                            f"{base}/bars", **state),
            "provisional": lambda: live.start_provisional(live.event_ticks(stream("in_late")), f"{base}/ck_provisional",
                                                          f"{base}/provisional", **state),
            "late": lambda: live.start_late_corrections(live.event_ticks(stream("in_late")), f"{base}/ck_late",
                                                        f"{base}/corrected", **drain),
            "route": lambda: live.start_route(enc.envelopes(stream("in_events")), f"{base}/ck_route", f"{base}/routed", **drain),
            "candles": lambda: live.start_bars(live.stream_candle_bars(live.kline_candles(
                enc.redelivered(enc.kline_json(stream("in_events"))))), f"{base}/ck_candles", f"{base}/candle_bars", **state),
            "warm": lambda: live.start_forecaster(
                spark, stream("in_bars", recent.schema), f"{base}/ck_warm", f"{base}/warm_forecasts",
                f"{base}/warm_anomalies", initial=history, **state),
        }
        return {name: starts[name]() for name in names}

    dropped = n_batches = 0
    for at in range(REPLAY_BATCHES):
        for folder, (rows, time, at_times, late) in inputs.items():
            _replay(rows, time, f"{base}/{folder}", at_times, at, late)
        queries = start()
        for q in queries.values():
            q.awaitTermination()
        if "bars" in names:      # its first stateful operator drops the late ticks
            progress = queries["bars"].recentProgress
            dropped += sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])
            n_batches += sum(p["numInputRows"] > 0 for p in progress)
    if "bars" in names:
        spark.createDataFrame([(dropped, n_batches)], "n_dropped long, n_batches long").coalesce(1).write.parquet(f"{base}/late")
    return base


def _history_and_recent(spark, sf_dir):
    """Bars before and from the 80 % cut."""
    b = bars(spark, sf_dir).select("symbol", "bar_time", "close")
    cut = F.lit(ds.split_cuts(b, "bar_time").first()["train_cut"])
    return b.filter(F.col("bar_time") < cut), b.filter(F.col("bar_time") >= cut)


_WM = "(SELECT (epoch_us(max(ts)) // 1000) - 30000 FROM events)"   # watermark in ms after the last batch


@plan("stream_bars", S.with_(S.BARS, f"""
SELECT symbol, bar_time, {S.rnd('open', 'high', 'low', 'close', 'volume', 'taker_buy_volume')}, num_trades
FROM bars WHERE epoch_us(bar_time) // 1000 <= {_WM}"""))
def stream_bars(spark, sf_dir):
    """Final bars from the watermarked stream (append mode, several micro-batches, late ticks
    in the last) — the batch bars less those the watermark has not closed yet."""
    return rounded(spark.read.parquet(f"{live_run(spark, sf_dir, 'bars')[0]}/bars"))


@plan("stream_provisional_bars", S.with_(S.TICKS + f"""
, edge AS (SELECT epoch_us(min(event_time)) AS t0, epoch_us(max(event_time)) - epoch_us(min(event_time)) AS span FROM ticks),
parts AS (SELECT b::BIGINT AS b, CASE WHEN b < {REPLAY_BATCHES} THEN t0 + span * b // {REPLAY_BATCHES} ELSE t0 + span + 1 END AS upto
          FROM edge, (SELECT unnest(range(1, {REPLAY_BATCHES} + 1)) AS b)),
seen AS (SELECT p.b, t.* FROM ticks t, parts p WHERE epoch_us(t.event_time) < p.upto),
marks AS (SELECT b, epoch_us(max(event_time)) // 1000 - 30000 AS wm FROM seen GROUP BY b),
grouped AS (
  SELECT b, symbol, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS bar_time,
         arg_min(price, (event_time, tick_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (event_time, tick_id)) AS close, sum(volume) AS volume, count(*) AS num_trades
  FROM seen GROUP BY b, symbol, date_trunc('hour', event_time))""", f"""
SELECT g.b AS batch, symbol, bar_time, {S.rnd('open', 'high', 'low', 'close', 'volume')}, num_trades,
       epoch_us(bar_time) // 1000 <= wm AS is_final
FROM grouped g JOIN marks n ON g.b = n.b"""))
def stream_provisional_bars(spark, sf_dir):
    """T4: bars in update mode.  Every trigger upserts the bars it changed; shown is the keyed table as it stood after
    each part of the records, with the bars that the watermark has not closed marked provisional."""
    rows = live.read_sink(spark, f"{live_run(spark, sf_dir, 'provisional')[0]}/provisional", live.PROVISIONAL_SCHEMA)
    return rounded(live.provisional_history(rows).select("batch", "symbol", "bar_time", "open", "high", "low", "close",
                                                         "volume", "num_trades", "is_final"))


@plan("stream_state", S.with_(S.DETECT + """
, closed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_time DESC) AS recency
            FROM bars WHERE epoch_us(bar_time) // 1000 <= (SELECT (epoch_us(max(ts)) // 1000) - 30000 FROM events)),
held AS (SELECT c.symbol, c.recency, c.bar_time, c.close, f.residual FROM closed c
         LEFT JOIN forecasts f ON c.symbol = f.symbol AND c.bar_time = f.event_time)""", f"""
SELECT symbol, CAST(least(count(*), 1441) AS INTEGER) AS n_closes, CAST(least(count(*), 288) AS INTEGER) AS n_residuals,
       CAST(count(residual) FILTER (WHERE recency <= 288) AS INTEGER) AS n_known_residuals,
       round(coalesce(sum(residual) FILTER (WHERE recency <= 288), 0), 6) + 0.0 AS sum_residuals,
       round(arg_min(close, recency), 6) + 0.0 AS last_close, max(bar_time) AS last_time
FROM held GROUP BY symbol"""))
def stream_state(spark, sf_dir):
    """What the forecaster's checkpoint holds per symbol after it was stopped and started again twice on the same
    checkpoint, read from the RocksDB state by Spark's state data source: closes, residuals and the last bar."""
    return rounded(live.symbol_states(spark, f"{live_run(spark, sf_dir, 'forecast')[0]}/ck_forecast"))


@plan("stream_late_rows", """
SELECT CAST(count(*) AS BIGINT) AS n_dropped, CAST(3 AS BIGINT) AS n_batches
FROM events, (SELECT min(ts) AS t0, max(ts) AS t1 FROM events)
WHERE event_id % 10 = 0 AND epoch_us(ts) < epoch_us(t0) + (epoch_us(t1) - epoch_us(t0)) * 3 // 10""")
def stream_late_rows(spark, sf_dir):
    """The ticks that came days late are dropped by the watermark, all of them and no other."""
    return spark.read.parquet(f"{live_run(spark, sf_dir, 'bars')[0]}/late")


@plan("stream_late_ticks", """
SELECT event_type AS symbol, event_id + 1000000000000 AS tick_id, ts AS event_time,
       round(value + 1001.0, 6) + 0.0 AS price, round(value + 1000.0, 6) + 0.0 AS volume
FROM events, (SELECT min(ts) AS t0, max(ts) AS t1 FROM events)
WHERE event_id % 10 = 0 AND epoch_us(ts) < epoch_us(t0) + (epoch_us(t1) - epoch_us(t0)) * 3 // 10""")
def stream_late_ticks(spark, sf_dir):
    """The side table of the ticks that came after their bar was closed, all of them and no other."""
    t = live.read_sink(spark, f"{live_run(spark, sf_dir, 'late')[0]}/corrected/late", live.TICK_SCHEMA)
    return rounded(t.select("symbol", "tick_id", live.wall_clock("event_time").alias("event_time"), "price", "volume"))


_WITH_LATE = """
edge AS (SELECT epoch_us(min(ts)) AS t0, epoch_us(max(ts)) - epoch_us(min(ts)) AS span FROM events),
arrived AS (SELECT event_id, ts, event_type, user_id, value FROM events
            UNION ALL SELECT event_id + 1000000000000, ts, event_type, user_id, value + 1000.0 FROM events, edge
            WHERE event_id % 10 = 0 AND epoch_us(ts) < t0 + span * 3 // 10),""" + S.TICKS.replace("FROM events", "FROM arrived")


@plan("stream_corrected_bars", S.with_(S.bars_sql("hour", _WITH_LATE), f"""
SELECT symbol, bar_time, {S.rnd('open', 'high', 'low', 'close', 'volume', 'taker_buy_volume')}, num_trades
FROM bars WHERE epoch_us(bar_time) // 1000 <= {_WM}"""))
def stream_corrected_bars(spark, sf_dir):
    """The closed bars of the stream after the late ticks corrected them: the batch bars over all ticks that ever arrived."""
    bars_base, late_base = live_run(spark, sf_dir, "bars", "late")
    final = spark.read.parquet(f"{bars_base}/bars")
    again = live.read_sink(spark, f"{late_base}/corrected/corrections", live.CORRECTION_SCHEMA)
    return rounded(live.corrected_bars(final, again).select(*final.columns))


@plan("stream_kline_bars", f"""
WITH c AS (
  SELECT event_type AS symbol, epoch_us(ts) // 1000 AS t, value + 1.0 AS open, {_CLOSE} AS close, {_CLOSE} + 0.5 AS high,
         (value + 1.0) * 0.5 AS low, value AS volume, {_TAKER} AS taker_buy_volume, {_K} AS trades
  FROM events WHERE value >= 1 AND NOT ({_K} BETWEEN 92 AND 94)),
b AS (
  SELECT symbol, make_timestamp((t // 3600000 + 1) * 3600000000) AS bar_time, arg_min(open, t) AS open, max(high) AS high,
         min(low) AS low, arg_max(close, t) AS close, sum(volume) AS volume, sum(taker_buy_volume) AS taker_buy_volume,
         CAST(sum(trades) AS BIGINT) AS num_trades
  FROM c GROUP BY symbol, t // 3600000)
SELECT symbol, bar_time, {S.rnd('open', 'high', 'low', 'close', 'volume', 'taker_buy_volume')}, num_trades
FROM b WHERE epoch_ms(bar_time) <= (SELECT max(t) - 30000 FROM c)""")
def stream_kline_bars(spark, sf_dir):
    """Live candles with four different prices, a third of them delivered twice, as hourly bars."""
    return rounded(spark.read.parquet(f"{live_run(spark, sf_dir, 'candles')[0]}/candle_bars"))


@plan("stream_warm_start", S.with_(S.DETECT + S._split_ctes("bars", "bar_time", "warm"), f"""
SELECT symbol, event_time, day, {S.rnd(*_FORECAST_NUM)}, is_anomaly
FROM forecasts, warm_c WHERE epoch_us(event_time) >= train_cut"""))
def stream_warm_start(spark, sf_dir):
    """A forecaster started on history bars (their newest rows as initial state) and fed the rest
    gives the batch detector's rows for the rest."""
    t = live.read_sink(spark, f"{live_run(spark, sf_dir, 'warm')[0]}/warm_forecasts", live.FORECAST_TABLE_SCHEMA)
    return rounded(live.latest(t).select(*detect.FORECAST_COLUMNS))


@plan("stream_report", S.with_(S.DETECT, f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies
FROM forecasts WHERE epoch_us(event_time) // 1000 <= {_WM}"""))
def stream_report(spark, sf_dir):
    """K8: rows and anomalies of all micro-batches, from the sink's report rows."""
    r = live.read_sink(spark, f"{live_run(spark, sf_dir, 'forecast')[0]}/report", live.REPORT_SCHEMA)
    return r.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_anomalies").alias("n_anomalies"))


@plan("stream_zscore", S.with_(S.DETECT, f"""
SELECT symbol, event_time, day, {S.rnd(*_FORECAST_NUM)}, is_anomaly
FROM forecasts WHERE epoch_us(event_time) // 1000 <= {_WM}"""))
def stream_zscore(spark, sf_dir):
    """Keyed streaming forecaster output (latest write per key) — equal to the
    batch detector on the closed bars."""
    t = live.read_sink(spark, f"{live_run(spark, sf_dir, 'forecast')[0]}/forecasts", live.FORECAST_TABLE_SCHEMA)
    return rounded(live.latest(t).select(*detect.FORECAST_COLUMNS))


@plan("stream_snapshots", S.with_(S.DETECT, f"""
SELECT CAST(v AS INTEGER) AS version, symbol, event_time, day, {S.rnd(*_FORECAST_NUM)}, is_anomaly
FROM forecasts, (SELECT unnest(range(0, 3)) AS v) WHERE epoch_us(event_time) // 1000 <= {_WM}"""))
def stream_snapshots(spark, sf_dir):
    """K5: the forecast store before a compaction, after one of its first batch and after one of all but the newest:
    every version reads the same newest write per key."""
    base, = live_run(spark, sf_dir, "forecast")

    def compact_twice() -> str:
        store = live.forecast_store(spark, f"{base}/forecasts", f"{base}/forecast_snapshots")
        batches = store.listed()
        store.compact(batches.agg(F.min("batch_id")).first()[0], batches)
        store.compact(batches=batches)
        return store.root

    root = once_per_app(spark, ("snapshots", base), compact_twice)
    store = live.forecast_store(spark, f"{base}/forecasts", root)
    batches = store.listed()
    versions = [store.read(v, batches).select(F.lit(v).alias("version"), *detect.FORECAST_COLUMNS) for v in range(3)]
    return rounded(functools.reduce(DataFrame.unionByName, versions))


@plan("stream_anomalies", S.with_(S.DETECT, f"""
SELECT symbol, event_time, {S.rnd('close', 'forecast', 'rv_15m', 'zscore')}
FROM forecasts WHERE is_anomaly AND epoch_us(event_time) // 1000 <= {_WM}"""))
def stream_anomalies(spark, sf_dir):
    """K6: the anomaly table written by the same foreachBatch, latest write per key."""
    t = live.read_sink(spark, f"{live_run(spark, sf_dir, 'forecast')[0]}/anomalies", live.ANOMALY_SCHEMA)
    return rounded(live.latest(t, ("symbol", "event_time"))
                   .select("symbol", "event_time", "close", "forecast", "rv_15m", "zscore"))


@plan("stream_route", f"""
SELECT event_type AS symbol, {_MS_NTZ} AS event_time, round({_CLOSE}, 6) + 0.0 AS close
FROM events WHERE {_K} < 92 AND value >= 1""")
def stream_route(spark, sf_dir):
    """Envelopes routed by the stream as (key = symbol, value = inner JSON) for closed
    candles; the forwarded bytes are decoded again to show they arrive intact."""
    routed = spark.read.parquet(f"{live_run(spark, sf_dir, 'route')[0]}/routed")
    d = msg.decode_kline(routed.select(F.col("key").cast("string").alias("k"), "value"))
    return rounded(d.filter(~F.col("_bad")).select(F.col("k").alias("symbol"), "event_time", "close"))


@plan("stream_sinks", S.with_(S.DETECT, f"""
SELECT symbol, count(*) AS n_forecasts, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies,
       max(event_time) AS last_event_time
FROM forecasts WHERE epoch_us(event_time) // 1000 <= {_WM} GROUP BY symbol"""))
def stream_sinks(spark, sf_dir):
    """K5 K6: what the two foreachBatch tables hold per symbol — the forecasts after compaction to one
    folder per day, the anomalies by latest write per key."""
    base, = live_run(spark, sf_dir, "forecast")
    fc = live.compact_days(spark, f"{base}/forecasts", live.FORECAST_TABLE_SCHEMA, f"{base}/forecast_days")
    an = live.latest(live.read_sink(spark, f"{base}/anomalies", live.ANOMALY_SCHEMA), ("symbol", "event_time"))
    per = fc.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_forecasts"), F.max("event_time").alias("last_event_time"))
    flagged = an.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_anomalies"))
    return (per.join(flagged, "symbol", "left")
               .select("symbol", "n_forecasts", F.coalesce("n_anomalies", F.lit(0)).cast("long").alias("n_anomalies"),
                       "last_event_time"))
