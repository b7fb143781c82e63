"""Kline archives (CSV) and REST pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from volcast.functions.market import epoch_to_millis, millis_to_ntz, to_double

# X-1: the archive's 12 header-less fields.
KLINE_CSV_SCHEMA = StructType([
    StructField("open_time", LongType()), StructField("open", StringType()),
    StructField("high", StringType()), StructField("low", StringType()),
    StructField("close", StringType()), StructField("volume", StringType()),
    StructField("close_time", LongType()), StructField("quote_volume", StringType()),
    StructField("num_trades", LongType()), StructField("taker_buy_base", StringType()),
    StructField("taker_buy_quote", StringType()), StructField("ignore", StringType()),
])
KLINE_FIELDS = [f.name for f in KLINE_CSV_SCHEMA.fields]
NUMERIC_TEXT = ["open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base", "taker_buy_quote"]

# The archive layout puts each symbol in its own folder: .../klines/<SYMBOL>/<file>.csv
SYMBOL_FROM_PATH = r"/klines/([A-Z0-9]+)/"


def read_kline_csv(spark: SparkSession, paths: str | list[str], symbol_pattern: str = SYMBOL_FROM_PATH,
                   corrupt_column: str | None = "_corrupt") -> DataFrame:
    """Header-less CSV under a glob (archive and gap files together), explicit
    schema, symbol taken from the file path (``_metadata.file_path``)."""
    schema = KLINE_CSV_SCHEMA
    reader = spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        reader = spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE") \
                      .option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.csv(paths)
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), symbol_pattern, 1).alias("symbol"))


def normalise_klines(raw: DataFrame) -> DataFrame:
    """µs/ms epochs -> ms -> event_time; text prices -> doubles (bad text -> null)."""
    d = raw.withColumn("open_time_ms", epoch_to_millis("open_time"))
    d = d.withColumn("event_time", millis_to_ntz("open_time_ms"))
    return d.withColumns({f"{c}_num": to_double(c) for c in ["close", "high", "low", "volume", "taker_buy_base"]})


def klines_to_bars(norm: DataFrame) -> DataFrame:
    """Archive rows in the bar schema used by the feature pipeline."""
    return norm.select("symbol", F.col("event_time").alias("bar_time"), to_double("open").alias("open"),
                       F.col("high_num").alias("high"), F.col("low_num").alias("low"),
                       F.col("close_num").alias("close"), F.col("volume_num").alias("volume"),
                       F.col("taker_buy_base_num").alias("taker_buy_volume"), "num_trades")


_PAGE = "array<array<string>>"


def rest_page_status(pages: DataFrame, page: str = "page") -> DataFrame:
    """Every page's ``status`` (ok, empty, unreadable) and ``n_rows``; an unreadable page is
    reported here and gives no rows in :func:`decode_rest_pages`, the walk goes on."""
    rows = F.from_json(F.col(page), _PAGE)
    n = F.when(rows.isNull(), 0).otherwise(F.size(rows))
    status = F.when(rows.isNull(), "unreadable").when(F.size(rows) == 0, "empty").otherwise("ok")
    return pages.select(*[c for c in pages.columns if c != page], status.alias("status"), n.cast("long").alias("n_rows"))


def decode_rest_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """JSON page ``[[open_time, "open", ...], ...]`` -> one typed row per kline.

    Mixed numbers and strings are read as text (integers keep their digits), so
    each field converts exactly like an archive CSV field.  Empty and unreadable pages give
    no rows; :func:`rest_page_status` tells which."""
    arr = F.from_json(F.col(page), _PAGE)
    d = pages.select(*[c for c in pages.columns if c != page], F.explode(arr).alias("_k"))
    cols = []
    for i, f in enumerate(KLINE_CSV_SCHEMA.fields):
        v = F.try_element_at(F.col("_k"), F.lit(i + 1))
        cols.append((v.try_cast("long") if isinstance(f.dataType, LongType) else v).alias(f.name))
    return d.select(*[c for c in d.columns if c != "_k"], *cols)


def csv_rejects(raw: DataFrame, corrupt_column: str = "_corrupt") -> DataFrame:
    """Per symbol the rows read and the rows that do not fit the schema (kept with nulls by the
    reader; whoever filters them out reports them with this)."""
    bad = F.col(corrupt_column).isNotNull()
    return raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.count("open_time").alias("n_with_time"),
                                     F.sum(bad.cast("long")).alias("n_rejected"))


def warmup_closes(rows: DataFrame) -> DataFrame:
    """(bar_time, close) from REST rows — close time (field 6) and close (field 4).
    Bars are labelled by window end, so close time + 1 ms is the label.  No rows give an empty
    frame with these columns; :func:`rest_page_status` has the pages that failed."""
    return rows.select("symbol", millis_to_ntz(F.col("close_time") + 1).alias("bar_time"),
                       to_double("close").alias("close"))
