"""Scalar Column builders for market series.  All JVM-side, null-safe under ANSI mode."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same numbers.
# Parkinson factor 1 / (4 ln 2); log-space epsilon; anomaly threshold on |z|;
# past residuals in the z-score; minimum past residuals; minimum prices before a
# live forecast; the served HAR-RV coefficients (15m, 1h, 24h) and intercept.
PARKINSON_FACTOR = 1.0 / (4.0 * math.log(2.0))
LOG_EPS = 1e-12
ANOMALY_THRESHOLD = 4.0
Z_PAST_ROWS = 288
Z_MIN_PAST = 29
MIN_PRICES = 16
HAR_W_15M = 0.17862620024636272
HAR_W_1H = 0.011214103226812332
HAR_W_24H = 0.00035420663272866257
HAR_INTERCEPT = 1.896524003230036e-05

# Std below this is treated as zero (keeps both engines of a comparison in step).
STD_FLOOR = 1e-12


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_double(x: str | Column) -> Column:
    """String / number -> double; malformed text gives null instead of failing (ANSI)."""
    return _c(x).try_cast("double")


def log_return(close: str | Column, prev_close: str | Column) -> Column:
    """ln(close / prev); null when prev is null/0 or the ratio is not positive."""
    ratio = F.try_divide(_c(close), _c(prev_close))
    return F.when(ratio > 0, F.ln(ratio))


def parkinson_bar(high: str | Column, low: str | Column) -> Column:
    """One-bar Parkinson variance (1 / (4 ln 2)) * ln(high / low)^2; null when low <= 0."""
    ratio = F.try_divide(_c(high), _c(low))
    return F.when(ratio > 0, F.lit(PARKINSON_FACTOR) * F.pow(F.ln(ratio), 2))


def safe_zscore(x: str | Column, mean: str | Column, std: str | Column) -> Column:
    """(x - mean) / std, null when std is null or (numerically) zero."""
    s = _c(std)
    return F.when(s > STD_FLOOR, (_c(x) - _c(mean)) / s)


def ratio(num: str | Column, den: str | Column) -> Column:
    """Null-safe divide (null on zero denominator)."""
    return F.try_divide(_c(num), _c(den))


class ColumnMath:
    """The few functions the formulas below need, on Columns (null-safe)."""

    log1p, expm1 = staticmethod(F.log1p), staticmethod(F.expm1)

    @staticmethod
    def log_positive(x):
        return F.when(x > 0, F.ln(x))

    @staticmethod
    def sqrt_clamped(x):
        return F.when(x.isNotNull(), F.sqrt(F.greatest(x, F.lit(0.0))))     # greatest() alone would skip the null


class ArrayMath:
    """The same on numpy arrays, with NaN for null."""

    log1p, expm1 = staticmethod(np.log1p), staticmethod(np.expm1)

    @staticmethod
    def log_positive(x):
        return np.where(x > 0, np.log(np.where(x > 0, x, 1.0)), np.nan)

    @staticmethod
    def sqrt_clamped(x):
        return np.sqrt(np.maximum(x, 0.0))


def _arg(x):
    return F.col(x) if isinstance(x, str) else x


def har_forecast(rv_15m, rv_1h, rv_24h, w15=HAR_W_15M, w1h=HAR_W_1H, w24=HAR_W_24H, intercept=HAR_INTERCEPT,
                 math_of=ColumnMath):
    """HAR-RV forecast in log1p-variance space: the one expression of batch (Columns) and stream
    (arrays, ``math_of=ArrayMath``).  Coefficients are numbers (served model) or Columns (fitted)."""
    return (intercept + w15 * math_of.log1p(_arg(rv_15m)) + w1h * math_of.log1p(_arg(rv_1h))
            + w24 * math_of.log1p(_arg(rv_24h)))


def log_residual(rv, forecast, eps: float = LOG_EPS, math_of=ColumnMath):
    """log(rv + eps) - log(forecast + eps), null where either is not positive; the forecast stays in log1p space."""
    return math_of.log_positive(_arg(rv) + eps) - math_of.log_positive(_arg(forecast) + eps)


def vol_percent_from_forecast(forecast, math_of=ColumnMath):
    """sqrt(max(expm1(forecast), 0)) * 100."""
    return math_of.sqrt_clamped(math_of.expm1(_arg(forecast))) * 100.0


def vol_percent_from_variance(rv, math_of=ColumnMath):
    """sqrt(max(rv, 0)) * 100."""
    return math_of.sqrt_clamped(_arg(rv)) * 100.0


def epoch_to_millis(epoch: str | Column) -> Column:
    """Epoch in ms or µs -> ms.  Values above 1e14 are microseconds."""
    e = _c(epoch).cast("long")
    return F.when(e > F.lit(100_000_000_000_000), F.floor(e / 1000)).otherwise(e).cast("long")


_EPOCH_NTZ = "1970-01-01 00:00:00"


def micros_to_ntz(us: str | Column) -> Column:
    """Epoch µs -> TIMESTAMP_NTZ (UTC wall clock), independent of the session zone."""
    return F.timestamp_add("MICROSECOND", _c(us).cast("long"), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def millis_to_ntz(ms: str | Column) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ, exact to the millisecond."""
    return micros_to_ntz(_c(ms).cast("long") * 1000)


def ntz_micros(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ -> epoch µs read as UTC wall clock.

    Days and the time within the day are taken apart and put together as numbers, so the
    session's zone and its clock changes play no part (a difference of timestamps would be
    taken through the session's zone)."""
    t = _c(ts)
    days = F.unix_date(t.cast("date")).cast("long")
    micros = F.floor(F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long")
    seconds = days * 86_400 + F.hour(t).cast("long") * 3_600 + F.minute(t).cast("long") * 60
    return seconds * 1_000_000 + micros
