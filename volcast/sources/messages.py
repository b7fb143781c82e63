"""Live kline messages — decoding, validation and routing.

Messages arrive as Kafka records ``(key binary, value binary)`` or as text lines.
Both decoders are column expressions, so they serve a batch DataFrame and a
streaming one alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from volcast.functions.market import millis_to_ntz, to_double

# Schema of the inner kline event (field names are the wire format's).
KLINE_FIELDS = StructType([
    StructField("t", LongType()), StructField("T", LongType()), StructField("s", StringType()),
    StructField("i", StringType()), StructField("o", StringType()), StructField("c", StringType()),
    StructField("h", StringType()), StructField("l", StringType()), StructField("v", StringType()),
    StructField("V", StringType()), StructField("n", IntegerType()), StructField("x", BooleanType()),
])
KLINE_EVENT = StructType([
    StructField("e", StringType()), StructField("E", LongType()), StructField("s", StringType()),
    StructField("k", KLINE_FIELDS), StructField("_corrupt", StringType()),
])
ENVELOPE = StructType([StructField("stream", StringType()), StructField("data", StringType()),
                       StructField("_corrupt", StringType())])
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

CANDLE_COLUMNS = ["symbol", "event_time", "open", "close", "high", "low", "volume", "taker_buy_volume",
                  "num_trades", "is_closed"]


def stream_name(symbol: str | Column, interval: str = "1s") -> Column:
    """P10: name of a symbol's kline stream: stream names are lower case, symbols keep the case of the wire."""
    return F.concat(F.lower(F.col(symbol) if isinstance(symbol, str) else symbol), F.lit(f"@kline_{interval}"))


def _text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def _parse_once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Attach a parsed struct through a one-element ``explode``.  The generator is a plan
    barrier: later filters on the struct cannot be pushed below it, so the parser runs
    once per row instead of once per referencing expression."""
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def decode_kline(df: DataFrame, value: str = "value") -> DataFrame:
    """Kline event JSON -> typed candle rows plus ``_bad`` for undecodable input.

    Prices may be JSON strings or bare numbers (both read as text, then
    ``try_cast``).  ``v`` and ``V`` differ only in case; they are separated by
    position (``k.*`` + ``toDF``), so no session-wide case-sensitivity switch is needed."""
    d = _parse_once(df, F.from_json(_text(value), KLINE_EVENT, _PERMISSIVE), "_ev")
    k = d.select("*", "_ev.k.*")
    names = list(k.columns)
    base = len(names) - len(KLINE_FIELDS.fields)
    renamed = names[:base] + [f"_k_{f.name}_{i}" for i, f in enumerate(KLINE_FIELDS.fields)]
    k = k.toDF(*renamed)
    fld = {f.name: renamed[base + i] for i, f in enumerate(KLINE_FIELDS.fields)}
    bad = F.col("_ev._corrupt").isNotNull() | F.col("_ev.k").isNull() | F.col(fld["T"]).isNull()
    # a price or volume that is text but no number makes the event undecodable, as does a missing close
    for name in ("o", "c", "h", "l", "v", "V"):
        bad = bad | (F.col(fld[name]).isNotNull() & to_double(fld[name]).isNull())
    bad = bad | F.col(fld["c"]).isNull()
    return k.select(
        *names[:base],
        F.coalesce(F.col("_ev.s"), F.col(fld["s"])).alias("symbol"),
        millis_to_ntz(F.col(fld["T"])).alias("event_time"),
        to_double(fld["o"]).alias("open"), to_double(fld["c"]).alias("close"),
        to_double(fld["h"]).alias("high"), to_double(fld["l"]).alias("low"),
        to_double(fld["v"]).alias("volume"), to_double(fld["V"]).alias("taker_buy_volume"),
        F.col(fld["n"]).cast("long").alias("num_trades"),
        F.col(fld["x"]).alias("is_closed"),
        bad.alias("_bad"),
    ).drop("_ev")


def closed_candles(decoded: DataFrame) -> DataFrame:
    """F1 F2: keep decodable, closed candles."""
    return decoded.filter(~F.col("_bad") & F.coalesce(F.col("is_closed"), F.lit(False))).drop("_bad")


def open_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Combined-stream envelope -> ``stream`` and the raw inner ``data`` text (kept
    byte-for-byte for forwarding); ``_env_bad`` marks undecodable envelopes."""
    d = _parse_once(df, F.from_json(_text(value), ENVELOPE, _PERMISSIVE), "_env")
    bad = F.col("_env._corrupt").isNotNull() | F.col("_env.data").isNull()
    return d.select("*", F.col("_env.stream").alias("stream"), F.col("_env.data").alias("data"),
                    bad.alias("_env_bad")).drop("_env")


def route(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """Envelope -> (key = symbol, value = inner data) for closed candles only.

    The inner JSON is forwarded untouched; the key drives hash partitioning, so
    one symbol's records stay in one Kafka partition.  Symbols keep the case of the wire."""
    e = open_envelope(envelopes, value).filter(~F.col("_env_bad"))
    k = decode_kline(e.select("stream", "data"), "data")
    k = closed_candles(k)
    return k.select(F.col("symbol").cast("binary").alias("key"), F.col("data").cast("binary").alias("value"),
                    "stream", "symbol", "event_time", "close")


#: 32-bit FNV-1a (fixed values): start and factor.
FNV_START, FNV_FACTOR = 2166136261, 16777619


def key_partition(key: str | Column, partitions: int) -> Column:
    """K4: the partition a hash balancer gives a record key: FNV-1a over the key's bytes, read as a signed 32-bit number,
    remainder by the number of partitions without its sign.  A null key has none (a producer deals those round robin).
    Native, so a batch or a stream can be laid out as the topic is."""
    if partitions < 1:
        raise ValueError("a topic has one partition at least")
    raw = (F.col(key) if isinstance(key, str) else key).cast("binary")
    digits = F.hex(raw)
    places = F.when(F.length(raw) > 0, F.sequence(F.lit(0), F.length(raw) - 1)).otherwise(F.array().cast("array<int>"))
    byte = lambda i: F.conv(F.substr(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("long")
    hashed = F.aggregate(places, F.lit(FNV_START).cast("long"),
                         lambda h, i: (h.bitwiseXOR(byte(i)) * FNV_FACTOR).bitwiseAND(F.lit(0xFFFFFFFF)))
    signed = F.when(hashed >= 1 << 31, hashed - (1 << 32)).otherwise(hashed)
    return F.when(raw.isNotNull(), F.abs(signed % F.lit(partitions)).cast("int"))


def dealt_partition(partitions: int, key: str = "key", value: str = "value") -> Column:
    """K4: :func:`key_partition`; null keys are dealt by their value."""
    return F.coalesce(key_partition(key, partitions), F.pmod(F.xxhash64(value), F.lit(partitions)).cast("int"))


def by_partition(records: DataFrame, partitions: int, key: str = "key") -> DataFrame:
    """K4: records laid out as the topic is — every Spark partition holds whole topic partitions (column
    ``partition_no``), so one symbol's records stay together.  Null keys are dealt by their value."""
    return records.withColumn("partition_no", dealt_partition(partitions, key)).repartition(partitions, "partition_no")


def reject_counts(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """F2 K8: totals of the routing step — one row, one pass."""
    e = open_envelope(envelopes, value)
    k = decode_kline(e.select("_env_bad", "data"), "data")
    inner_bad = ~F.col("_env_bad") & F.col("_bad")
    closed = ~F.col("_env_bad") & ~F.col("_bad") & F.coalesce(F.col("is_closed"), F.lit(False))
    return k.agg(F.count(F.lit(1)).alias("n_messages"),
                 F.sum(F.col("_env_bad").cast("long")).alias("n_bad_envelope"),
                 F.sum(inner_bad.cast("long")).alias("n_bad_event"),
                 F.sum((~F.col("_env_bad") & ~F.col("_bad") & ~closed).cast("long")).alias("n_open"),
                 F.sum(closed.cast("long")).alias("n_routed"))
