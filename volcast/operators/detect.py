"""HAR-RV scoring, log residual and the past-only rolling z-score detector (batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window  # noqa: F401
from pyspark.sql import functions as F

from volcast.functions import market as m
from volcast.operators.features import add_realised_variance, add_returns, bars_to_events
from volcast.operators.series import CHUNK, RN, over_series, window_moments

DETECT_RV = {"rv_15m": 15, "rv_1h": 60, "rv_24h": 1440}
FORECAST_COLUMNS = ["symbol", "event_time", "day", "close", "rv_15m", "rv_1h", "rv_24h", "forecast",
                    "vol_forecast", "vol_realized", "residual", "zscore", "is_anomaly"]


def add_zscore(frame: DataFrame, spec, value: str = "residual", out: str = "zscore",
               past_rows: int = m.Z_PAST_ROWS, min_past: int = m.Z_MIN_PAST) -> DataFrame:
    """Z of the current value against the previous ``past_rows`` values only."""
    past = spec.rowsBetween(-past_rows, -1)
    frame = frame.withColumns({
        "_zm": F.avg(value).over(past),
        "_zs": F.stddev_samp(value).over(past),
        "_zn": F.count(value).over(past),
    })
    z = F.when(F.col("_zn") >= min_past, m.safe_zscore(value, "_zm", "_zs"))
    return frame.withColumn(out, z).drop("_zm", "_zs", "_zn")


def add_zscore_blocked(frame: DataFrame, spec, part_keys: list[str], rn: str, value: str = "residual",
                       out: str = "zscore", past_rows: int = m.Z_PAST_ROWS,
                       min_past: int = m.Z_MIN_PAST) -> DataFrame:
    """W8 in O(rows): same result as :func:`add_zscore` (past ``past_rows`` values,
    at least ``min_past``), with the window moments from :func:`window_moments`."""
    frame = window_moments(frame, spec, part_keys, rn, value, past_rows, past=True, prefix="_z")
    z = F.when(F.col("_z_n") >= min_past, m.safe_zscore(value, "_z_mean", "_z_std"))
    return frame.withColumn(out, z).drop("_z_n", "_z_mean", "_z_std")


def score_har(df: DataFrame, coef: dict | None = None) -> DataFrame:
    """M2/M3 M4 M6: forecast, residual and percent volatilities from rv columns."""
    coef = coef or {}
    f = m.har_forecast("rv_15m", "rv_1h", "rv_24h", **coef)
    return (df.withColumn("forecast", f)
              .withColumns({
                  "residual": m.log_residual("rv_15m", "forecast"),
                  "vol_forecast": m.vol_percent_from_forecast("forecast"),
                  "vol_realized": m.vol_percent_from_variance("rv_15m"),
              }))


def detect_anomalies(bars: DataFrame, coef: dict | None = None, threshold: float = m.ANOMALY_THRESHOLD,
                     past_rows: int = m.Z_PAST_ROWS, min_past: int = m.Z_MIN_PAST,
                     min_prices: int = m.MIN_PRICES, chunk_rows: int | None = None,
                     blocked_z: bool = True) -> DataFrame:
    """Bars -> Y-6 forecast rows.  Rows start once a symbol has ``min_prices`` bars
    (the live path's warm-up); the z-score needs ``min_past`` earlier residuals."""
    df = bars_to_events(bars).select("symbol", "event_time", "close")

    def build(frame, spec):
        frame = add_returns(frame, spec)
        frame = add_realised_variance(frame, spec, ["symbol", CHUNK], RN, DETECT_RV)
        frame = score_har(frame, coef)
        warm = F.col(RN) >= min_prices
        frame = frame.withColumn("residual", F.when(warm, F.col("residual")))
        if blocked_z:
            frame = add_zscore_blocked(frame, spec, ["symbol", CHUNK], RN, past_rows=past_rows, min_past=min_past)
        else:
            frame = add_zscore(frame, spec, past_rows=past_rows, min_past=min_past)
        return frame.filter(warm)

    back = max(DETECT_RV.values()) + past_rows
    out = over_series(df, ["symbol"], "event_time", build, back=back, chunk_rows=chunk_rows)
    return (out.withColumns({
                "day": F.to_date("event_time"),
                "is_anomaly": F.coalesce(F.abs(F.col("zscore")) > F.lit(threshold), F.lit(False)),
            })
            .select(*FORECAST_COLUMNS))
