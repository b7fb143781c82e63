"""Rolling volatility features and forward targets on a bar table.

Row-count frames, as in the reference: a "15m" window is 15 rows, whatever the
gaps.  Partial frames at the start of a series are kept.  Everything runs on the
halo-chunk machinery of :mod:`volcast.operators.series`, so no task ever holds a
whole symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcast.functions import market as m
from volcast.operators.series import CHUNK, RN, over_series, window_moments, window_sums

# Fixed window lengths (rows) of the reference's feature set.
RV_WINDOWS = {"rv_15m": 15, "rv_1h": 60, "rv_4h": 240, "rv_24h": 1440}
PARKINSON_WINDOWS = {"parkinson_15m": 15, "parkinson_1h": 60}
VOLUME_WINDOW = 60
TARGET_WINDOWS = {"target_15m": 15, "target_1h": 60}
#: Sum and count of the squared returns ahead, by target.
FORWARD_NAMES = {k: (f"_{k}_sum", f"_{k}_count") for k in TARGET_WINDOWS}

# Frames at least this long are summed by blocks (O(rows) instead of O(rows x n)); the sums are the same.
BLOCK_SUM_ROWS = 240

BACK_ROWS = max(RV_WINDOWS.values())          # 1439 rows of frame + 1 for the lag
AHEAD_ROWS = max(TARGET_WINDOWS.values())


def add_returns(frame: DataFrame, spec) -> DataFrame:
    """Previous close, log return, squared return."""
    frame = frame.withColumn("prev_close", F.lag("close").over(spec))
    lr = m.log_return("close", "prev_close")
    return frame.withColumns({"log_return": lr, "sq_return": lr * lr})


def add_realised_variance(frame: DataFrame, spec, part_keys: list[str], rn: str,
                          windows: dict[str, int] = RV_WINDOWS) -> DataFrame:
    """Trailing sums of squared returns over n rows; long frames by :func:`window_sums`."""
    direct = {k: n for k, n in windows.items() if n < BLOCK_SUM_ROWS}
    frame = frame.withColumns({k: F.sum("sq_return").over(spec.rowsBetween(-(n - 1), 0))
                               for k, n in direct.items()})
    for k, n in windows.items():
        if k not in direct:
            frame = window_sums(frame, spec, part_keys, rn, "sq_return", n, k, nonnegative=True)
    return frame


def add_parkinson(frame: DataFrame, spec) -> DataFrame:
    """One-bar Parkinson variance and its trailing means."""
    frame = frame.withColumn("parkinson_1m", m.parkinson_bar("high", "low"))
    return frame.withColumns({k: F.avg("parkinson_1m").over(spec.rowsBetween(-(n - 1), 0))
                              for k, n in PARKINSON_WINDOWS.items()})


def add_volume(frame: DataFrame, spec, part_keys: list[str], rn: str) -> DataFrame:
    """Volume against its trailing mean and sample deviation (:func:`window_moments`, O(rows)); buy ratio."""
    frame = window_moments(frame, spec, part_keys, rn, "volume", VOLUME_WINDOW, past=False, prefix="_vol")
    frame = frame.withColumns({"vol_mean_1h": F.col("_vol_mean"), "vol_std_1h": F.col("_vol_std")})
    return frame.drop("_vol_n", "_vol_mean", "_vol_std").withColumns({
        "volume_zscore": m.safe_zscore("volume", "vol_mean_1h", "vol_std_1h"), "buy_ratio": buy_ratio()})


def buy_ratio() -> Column:
    """Taker-buy share of volume (null when volume is zero)."""
    return m.ratio("taker_buy_volume", "volume")


def add_forward_sums(frame: DataFrame, spec) -> DataFrame:
    """Sums and counts of squared returns over rows +1 .. +n."""
    cols = {}
    for k, n in TARGET_WINDOWS.items():
        fwd = spec.rowsBetween(1, n)
        fs, fc = FORWARD_NAMES[k]
        cols[fs] = F.sum("sq_return").over(fwd)
        cols[fc] = F.count("sq_return").over(fwd)
    return frame.withColumns(cols)


def finish_targets(df: DataFrame) -> DataFrame:
    """Keep rows whose forward frames are full, then log1p the sums."""
    cond = None
    for k, n in TARGET_WINDOWS.items():
        c = F.col(FORWARD_NAMES[k][1]) == n
        cond = c if cond is None else cond & c
    df = df.filter(cond)
    df = df.withColumns({k: F.log1p(F.col(FORWARD_NAMES[k][0])) for k in TARGET_WINDOWS})
    return df.drop(*[c for pair in FORWARD_NAMES.values() for c in pair])


def bars_to_events(bars: DataFrame) -> DataFrame:
    """Feature tables key rows by ``event_time`` (= bar label)."""
    return bars.withColumnRenamed("bar_time", "event_time")


def feature_table(bars: DataFrame, targets: bool = True, chunk_rows: int | None = None,
                  filter_targets: bool = True) -> DataFrame:
    """D3: bars + returns + realised variance + Parkinson + volume features (+ targets).

    With ``filter_targets=False`` the forward sums and counts are kept as columns
    and no row is dropped; :func:`finish_targets` applies the full-frame filter later."""
    df = bars_to_events(bars)

    def build(frame, spec):
        keys = ["symbol", CHUNK]
        frame = add_realised_variance(add_returns(frame, spec), spec, keys, RN)
        frame = add_volume(add_parkinson(frame, spec), spec, keys, RN)
        return add_forward_sums(frame, spec) if targets else frame

    out = over_series(df, ["symbol"], "event_time", build, back=BACK_ROWS,
                      ahead=AHEAD_ROWS if targets else 0, chunk_rows=chunk_rows)
    return finish_targets(out) if (targets and filter_targets) else out


def short_frames(bars: DataFrame, build, back: int, chunk_rows: int | None = None) -> DataFrame:
    """Bars with only the window columns that ``build(frame, spec, part_keys)`` adds (frames of at most
    ``back`` rows): what a light query needs, without the day-long frames of the whole table."""
    return over_series(bars_to_events(bars), ["symbol"], "event_time",
                       lambda frame, spec: build(frame, spec, ["symbol", CHUNK]), back=back, chunk_rows=chunk_rows)
