"""Wire formats derived from the driver's tables (inputs for the decoders).

The reference ingests WebSocket JSON, REST pages, CSV archives and checksums.
These encoders produce the same shapes from ``events`` / bars / ``documents``
with plain DataFrame expressions, so decoders are exercised on data that grows
with the tables.  Rules that pick a variant are data-driven, never row filters:
closed flag ``x`` = ``value >= 1``; prices as bare JSON numbers when
``props.k < 50`` (strings otherwise); a close that is no number when ``props.k`` is
92 to 94; envelopes with ``props.k >= 95`` are cut short (broken JSON); pages of
symbols with an even number of letters are cut short.  A candle's open is
``value + 1``, its close ``user_id % 3`` quarters above, its high half above the
close and its low half of the open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcast.functions.market import ntz_micros
from volcast.operators.series import number_rows, time_segment
from volcast.sources.messages import stream_name

KLINE_INTERVAL = "1s"
PAGE_ROWS = 1000


def props_k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def _ms(ts: str | Column) -> Column:
    return F.floor(ntz_micros(ts) / 1000).cast("long")


def kline_json_value() -> Column:
    """X-3: kline event JSON for a row of ``events``."""
    opened = F.col("value") + F.lit(1.0)
    closed = opened + F.pmod(F.col("user_id"), F.lit(3)) * F.lit(0.25)
    high, low = closed + F.lit(0.5), opened * F.lit(0.5)
    taker = F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.col("value")).otherwise(F.lit(0.0))
    t_ms = _ms("ts")
    k = props_k()

    def kline(as_number: bool) -> Column:
        num = (lambda c: c) if as_number else (lambda c: c.cast("string"))
        close = num(closed) if as_number else F.when(k.between(92, 94), F.lit("n/a")).otherwise(num(closed))
        inner = F.struct(
            (t_ms - 1000).alias("t"), t_ms.alias("T"), F.col("event_type").alias("s"),
            F.lit(KLINE_INTERVAL).alias("i"), num(opened).alias("o"), close.alias("c"),
            num(high).alias("h"), num(low).alias("l"), num(F.col("value")).alias("v"),
            num(taker).alias("V"), k.alias("n"), (F.col("value") >= 1).alias("x"))
        return F.to_json(F.struct(F.lit("kline").alias("e"), (t_ms + 5).alias("E"),
                                  F.col("event_type").alias("s"), inner.alias("k")))

    return F.when(k < 50, kline(True)).otherwise(kline(False))


def kline_json(events: DataFrame) -> DataFrame:
    """X-3 / X-6: one kline event per row of ``events`` as a Kafka-shaped record."""
    return events.select("event_id", F.col("event_type").cast("binary").alias("key"),
                         kline_json_value().alias("value"))


def envelopes(events: DataFrame) -> DataFrame:
    """X-5: ``{"stream": "<symbol>@kline_1s", "data": {...}}``; some cut short (broken)."""
    stream = stream_name("event_type", KLINE_INTERVAL)
    full = F.concat(F.lit('{"stream":"'), stream, F.lit('","data":'), kline_json_value(), F.lit("}"))
    broken = F.substring(full, 1, 40)
    return events.select("event_id", F.when(props_k() >= 95, broken).otherwise(full).alias("value"))


def kline_rows(bars: DataFrame, width_ms: int) -> DataFrame:
    """X-1: the 12 archive fields of each bar (bar_time = window end)."""
    close_ms = _ms("bar_time")
    return bars.select(
        "symbol",
        (close_ms - width_ms).alias("open_time"),
        F.col("open"), F.col("high"), F.col("low"), F.col("close"), F.col("volume"),
        (close_ms - 1).alias("close_time"),
        (F.col("volume") * F.col("close")).alias("quote_volume"),
        F.col("num_trades"),
        F.col("taker_buy_volume").alias("taker_buy_base"),
        (F.col("taker_buy_volume") * F.col("close")).alias("taker_buy_quote"),
        F.lit("0").alias("ignore"))


def _row_text() -> Column:
    """One REST kline as a mixed JSON array: integers bare, prices as strings."""
    s = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    parts = [F.col("open_time").cast("string"), s("open"), s("high"), s("low"), s("close"), s("volume"),
             F.col("close_time").cast("string"), s("quote_volume"), F.col("num_trades").cast("string"),
             s("taker_buy_base"), s("taker_buy_quote"), s("ignore")]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def rest_pages(rows: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """X-7: JSON pages of up to ``page_rows`` klines per symbol, in time order.

    Pages are numbered from global per-symbol row numbers, so a page is at most
    ``page_rows`` rows however large a symbol is."""
    seg = time_segment(F.timestamp_millis(F.col("open_time")).cast("timestamp_ntz"), "30 days")
    n = number_rows(rows, ["symbol"], ["open_time"], seg, rn_col="_rn", total_col=None)
    n = n.withColumn("page_no", F.floor((F.col("_rn") - 1) / page_rows).cast("long"))
    g = n.groupBy("symbol", "page_no").agg(F.sort_array(F.collect_list(F.struct("_rn", _row_text().alias("j"))))
                                             .alias("_rows"))
    return g.select("symbol", "page_no",
                    F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda x: x["j"]), ","), F.lit("]"))
                    .alias("page"))


def cut_pages(pages: DataFrame) -> DataFrame:
    """X-7 with broken responses: pages of symbols with an even number of letters lose their last ten characters."""
    cut = F.pmod(F.length("symbol"), F.lit(2)) == 0
    return pages.withColumn("page", F.when(cut, F.expr("left(page, length(page) - 10)")).otherwise(F.col("page")))


def redelivered(messages: DataFrame, id_col: str = "event_id") -> DataFrame:
    """X-6 as an at-least-once source delivers it: records whose id is divisible by three come twice."""
    times = F.when(F.pmod(F.col(id_col), F.lit(3)) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return messages.select("*", F.explode(times).alias("_n")).drop("_n")


def checksum_manifest(documents: DataFrame) -> DataFrame:
    """X-8: content ``(file_name, content)`` and manifest ``(file_name, line)``; the
    manifest of source ``src7`` is wrong (hash of different bytes)."""
    name = F.format_string("doc-%d.txt", F.col("doc_id"))
    good = F.sha2(F.col("text").cast("binary"), 256)
    wrong = F.sha2(F.concat(F.col("text"), F.lit("#")).cast("binary"), 256)
    h = F.when(F.col("source") == "src7", wrong).otherwise(good)
    content = documents.select(name.alias("file_name"), F.col("text").cast("binary").alias("content"))
    manifest = documents.select(name.alias("file_name"), F.concat(h, F.lit("  "), name).alias("line"))
    return content, manifest


def tick_files(events: DataFrame) -> DataFrame:
    """X-8: the lines of one tick file per symbol and day, ``(file_name, event_id, line)``."""
    line = F.concat_ws(",", F.col("event_id").cast("string"), _ms("ts").cast("string"), F.col("user_id").cast("string"))
    name = F.concat(F.col("event_type"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))
    return events.select(name.alias("file_name"), "event_id", line.alias("line"))


def tick_file_manifest(files: DataFrame) -> DataFrame:
    """X-8: the publisher's manifest lines of :func:`tick_files`: none for the fifth days of a month, a wrong hash (one
    byte more) on the seventh ones, and a line for a file ``<name>.old`` that does not exist beside every eleventh one."""
    text = F.concat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "line"))),
                                             lambda x: x["line"]), "\n"), F.lit("\n"))
    d = files.groupBy("file_name").agg(text.alias("text"))
    day = F.regexp_extract("file_name", r"(\d\d)\.csv$", 1).cast("int")
    good = F.sha2(F.col("text").cast("binary"), 256)
    wrong = F.sha2(F.concat("text", F.lit("#")).cast("binary"), 256)
    own = F.when(day % 5 != 0, F.concat(F.when(day % 7 == 0, wrong).otherwise(good), F.lit("  "), "file_name"))
    gone = F.when(day % 11 == 0, F.concat(good, F.lit("  "), "file_name", F.lit(".old")))
    return d.select(F.explode(F.array_compact(F.array(own, gone))).alias("line"))
