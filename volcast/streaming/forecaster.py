"""Per-symbol HAR forecaster as keyed streaming state.

Replaces the reference's driver-side dicts and ``collect`` loop with
``transformWithStateInPandas`` on executors: one state row per symbol holding
the last ``1 + max rv window`` closes, the last ``past_rows`` residuals and the
last bar time.  State is checkpointed (RocksDB), so a restart resumes where the
last committed batch ended.  The formulas are those of ``functions.market`` that the
batch detector uses, over arrays, and frames count rows as the batch windows do, so
stream and batch give the same rows for the same bars, also after null residuals.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from volcast.functions import market as m

RV_ROWS = {"rv_15m": 15, "rv_1h": 60, "rv_24h": 1440}

STATE_SCHEMA = StructType([
    StructField("closes", ArrayType(DoubleType())),
    StructField("residuals", ArrayType(DoubleType())),
    StructField("last_time", TimestampNTZType()),
])

OUTPUT_SCHEMA = StructType([
    StructField("symbol", StringType()), StructField("event_time", TimestampNTZType()),
    StructField("day", DateType()), StructField("close", DoubleType()),
    StructField("rv_15m", DoubleType()), StructField("rv_1h", DoubleType()), StructField("rv_24h", DoubleType()),
    StructField("forecast", DoubleType()), StructField("vol_forecast", DoubleType()),
    StructField("vol_realized", DoubleType()), StructField("residual", DoubleType()),
    StructField("zscore", DoubleType()), StructField("is_anomaly", BooleanType()),
])


#: Rows of history that decide a symbol's state: the z-score's rows, each over the longest variance.
STATE_ROWS = max(RV_ROWS.values()) + 1 + m.Z_PAST_ROWS
#: Bars judged at a time; bounds the work arrays (bars x longest window).
BLOCK_BARS = 1024


def _trailing(x: np.ndarray, n: int, n_new: int) -> np.ndarray:
    """For each of the last ``n_new`` entries of ``x``: the ``n`` entries that end with it (NaN before the start)."""
    padded = np.concatenate([np.full(n, np.nan), x])
    return np.lib.stride_tricks.sliding_window_view(padded, n)[len(padded) - n - n_new + 1:]


def _null_sum(rows: np.ndarray) -> np.ndarray:
    known = np.isfinite(rows)
    return np.where(known.any(1), np.where(known, rows, 0.0).sum(1), np.nan)


class SymbolState:
    """State of one symbol: its last closes, its last residuals (one per row, NaN for null) and the last bar time.

    ``update`` judges a block of bars at once.  Rules of nulls are those of the batch detector: a
    frame counts rows, and nulls within it are left out."""

    def __init__(self, closes=None, residuals=None, last_time=None, coef=None,
                 past_rows: int = m.Z_PAST_ROWS, min_past: int = m.Z_MIN_PAST,
                 min_prices: int = m.MIN_PRICES, threshold: float = m.ANOMALY_THRESHOLD):
        self.closes = np.array([np.nan if c is None else c for c in closes or []], dtype="float64")
        self.residuals = np.array([np.nan if r is None else r for r in residuals or []], dtype="float64")
        self.last_time = last_time
        self.coef = coef or {}
        self.past_rows, self.min_past = past_rows, min_past
        self.min_prices, self.threshold = min_prices, threshold

    def fresh(self, bars: pd.DataFrame) -> pd.DataFrame:
        """Bars in time order, without repeated times and those at or before the last seen time."""
        bars = bars.sort_values("bar_time", kind="stable").drop_duplicates("bar_time", keep="first")
        return bars if self.last_time is None else bars[bars["bar_time"] > pd.Timestamp(self.last_time)]

    def update(self, bars: pd.DataFrame) -> pd.DataFrame:
        """Take ``bars`` (bar_time, close; fresh) and return their forecast rows (none while warming up)."""
        bars = self.fresh(bars)
        parts = [self._block(bars.iloc[at:at + BLOCK_BARS]) for at in range(0, len(bars), BLOCK_BARS)]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()

    def _block(self, bars: pd.DataFrame) -> pd.DataFrame:
        n, held = len(bars), len(self.closes)
        close = np.concatenate([self.closes, bars["close"].to_numpy(dtype="float64")])
        with np.errstate(divide="ignore", invalid="ignore"):
            returns = np.concatenate([[np.nan], m.ArrayMath.log_positive(
                np.where(close[:-1] != 0, close[1:] / close[:-1], np.nan))]) if len(close) > 1 else np.full(len(close), np.nan)
        squares = returns * returns
        if held:                                 # the first held close only serves the return after it
            squares = squares[1:]
        rv = {k: _null_sum(_trailing(squares, w, n)) for k, w in RV_ROWS.items()}
        forecast = m.har_forecast(rv["rv_15m"], rv["rv_1h"], rv["rv_24h"], **self.coef, math_of=m.ArrayMath)
        residual = m.log_residual(rv["rv_15m"], forecast, math_of=m.ArrayMath)
        warm = held + 1 + np.arange(n) >= self.min_prices
        residual = np.where(warm, residual, np.nan)
        past = _trailing(np.concatenate([self.residuals, residual]), self.past_rows + 1, n)[:, :-1]
        known = np.isfinite(past)
        count = known.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.where(known, past, 0.0).sum(1) / count
            std = np.sqrt((np.where(known, past - mean[:, None], 0.0) ** 2).sum(1) / (count - 1))
            z = np.where((count >= self.min_past) & (std > m.STD_FLOOR), (residual - mean) / std, np.nan)
        self.closes = close[-(max(RV_ROWS.values()) + 1):]
        self.residuals = np.concatenate([self.residuals, residual])[-self.past_rows:]
        self.last_time = pd.Timestamp(bars["bar_time"].iloc[-1]).to_pydatetime()
        out = pd.DataFrame({
            "event_time": bars["bar_time"].to_numpy(), "close": close[len(close) - n:], **rv, "forecast": forecast,
            "vol_forecast": m.vol_percent_from_forecast(forecast, math_of=m.ArrayMath),
            "vol_realized": m.vol_percent_from_variance(rv["rv_15m"], math_of=m.ArrayMath),
            "residual": residual, "zscore": z, "is_anomaly": np.abs(np.nan_to_num(z)) > self.threshold})
        return out[warm]


def _frame(symbol: str, rows: pd.DataFrame) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({f.name: pd.Series([], dtype="object") for f in OUTPUT_SCHEMA.fields})
    rows = rows.assign(symbol=symbol, day=pd.to_datetime(rows["event_time"]).dt.date)
    numbers = [f.name for f in OUTPUT_SCHEMA.fields if isinstance(f.dataType, DoubleType)]
    rows[numbers] = rows[numbers].astype("object").where(rows[numbers].notna(), None)
    return rows[[f.name for f in OUTPUT_SCHEMA.fields]]


class HarForecaster(StatefulProcessor):
    """Keyed by symbol.  Input rows: ``symbol, bar_time (timestamp_ntz), close``."""

    def __init__(self, coef: dict | None = None, past_rows: int = m.Z_PAST_ROWS):
        self.coef, self.past_rows = coef, past_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("symbol_state", STATE_SCHEMA)

    def _load(self) -> SymbolState:
        if self.state.exists():
            closes, residuals, last = self.state.get()
            return SymbolState(closes, residuals, last, self.coef, self.past_rows)
        return SymbolState(coef=self.coef, past_rows=self.past_rows)

    def _save(self, s: SymbolState) -> None:
        known = lambda xs: [None if np.isnan(x) else float(x) for x in xs]
        self.state.update((known(s.closes), known(s.residuals), s.last_time))

    def handleInputRows(self, key, rows, timerValues):
        """One vectorised update per Arrow batch; a symbol's batches of a trigger come sorted only if
        together, so they are joined first (a trigger holds the final bars since the last one)."""
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        s = self._load()
        out = s.update(pd.concat(frames, ignore_index=True))
        self._save(s)
        yield _frame(key[0], out)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """History bars through the same update (no output), so the state is exactly what
        streaming those bars would have left behind."""
        if initialState is None or not len(initialState):
            return
        s = self._load()
        s.update(initialState[["bar_time", "close"]])
        self._save(s)

    def close(self) -> None:
        pass
