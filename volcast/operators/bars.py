"""OHLCV bar aggregation over ticks or candles (batch and stream share these functions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from volcast.functions.market import ntz_micros

BAR_COLUMNS = ["symbol", "bar_time", "open", "high", "low", "close", "volume",
               "taker_buy_volume", "num_trades"]
_TIE_SPAN = 10 ** 19            # above any non-negative long


def total_order(rows: DataFrame, time: str, tie: str | None) -> Column:
    """Sort key of a tick: its time and, between equal times, ``tie`` (a non-negative long).

    One decimal rather than a struct: aggregate buffers of decimals are updated in place, so
    ``min_by`` on it stays a hash aggregate."""
    if tie is None:
        return F.col(time)
    ntz = isinstance(rows.schema[time].dataType, TimestampNTZType)
    micros = (ntz_micros(time) if ntz else F.unix_micros(time)).cast("decimal(18,0)")
    return micros * F.lit(str(_TIE_SPAN)).cast("decimal(20,0)") + F.col(tie).cast("decimal(19,0)")


def _bars(rows: DataFrame, width: str, symbol: str, time: str, order: Column, first: str, high: str, low: str,
          last: str, volume: str, taker: str | None, trades: Column) -> DataFrame:
    """Tumbling-window bars labelled by the window end.  All aggregates have fixed-width buffers,
    so a hot symbol is collapsed map-side; the shuffle carries one row per (map task, symbol, bar)."""
    aggs = [F.min_by(first, order).alias("open"), F.max(high).alias("high"), F.min(low).alias("low"),
            F.max_by(last, order).alias("close"), F.sum(volume).alias("volume")]
    if taker:
        aggs.append(F.sum(taker).alias("taker_buy_volume"))
    aggs.append(trades.alias("num_trades"))
    grouped = rows.groupBy(F.col(symbol).alias("symbol"), F.window(time, width).alias("_w")).agg(*aggs)
    return grouped.select(*[F.col("_w.end").alias(c) if c == "bar_time" else c for c in BAR_COLUMNS
                            if taker or c != "taker_buy_volume"])


def ohlcv_bars(ticks: DataFrame, width: str = "1 hour", symbol: str = "symbol",
               time: str = "event_time", price: str = "price", volume: str = "volume",
               taker: str | None = "taker_buy_volume", tie: str | None = None) -> DataFrame:
    """A1: bars of ticks.  open/close are the prices of the first/last tick in the order of
    ``(time, tie)``; without ``tie`` the times of a symbol must be distinct."""
    return _bars(ticks, width, symbol, time, total_order(ticks, time, tie), price, price, price, price, volume, taker,
                 F.count(F.lit(1)))


def candle_bars(candles: DataFrame, width: str = "1 hour", symbol: str = "symbol", time: str = "event_time") -> DataFrame:
    """Bars of shorter candles — first open, highest high, lowest low, last close, summed
    volumes and trades.  A symbol's candles must have distinct times (see ``unique`` of the stream)."""
    return _bars(candles, width, symbol, time, F.col(time), "open", "high", "low", "close", "volume",
                 "taker_buy_volume", F.sum("num_trades"))
