"""Access to the driver's parquet tables and the market view of ``events``.

``events`` plays the tick stream (see FIXTURES.md §3):
symbol = event_type, event_time = ts, price = value + 1, volume = value,
taker buy volume = value for even user ids, JSON number = props.k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(events: DataFrame) -> DataFrame:
    """Market ticks from ``events``; only the projected columns reach the scan."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("event_time"),
        (F.col("value") + F.lit(1.0)).alias("price"),
        F.col("value").alias("volume"),
        F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.col("value")).otherwise(F.lit(0.0))
         .alias("taker_buy_volume"),
        F.col("event_id").alias("tick_id"),
    )


def load_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(table(spark, sf_dir, "events"))


def archive_and_gap_files(events: DataFrame, time: str = "ts") -> DataFrame:
    """The archive (everything before the 90 % cut) plus gap files (everything from
    the 80 % cut on), read together as one table — the overlap is duplicated, as when a
    backfill re-downloads a range the archive already holds.

    The cuts are computed once (one aggregate row) and compared with the raw column, so both
    branches push their range into the scan."""
    from volcast.operators.dataset import split_cuts
    train_cut, val_cut = split_cuts(events, time).first()
    return events.filter(F.col(time) < F.lit(val_cut)).unionByName(events.filter(F.col(time) >= F.lit(train_cut)))
