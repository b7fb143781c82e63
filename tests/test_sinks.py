"""K1: files and tasks of partitioned writes."""
import glob

import pytest
from pyspark.sql import functions as F

from volcast.sinks.files import write_parquet


@pytest.fixture()
def no_coalescing(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def hot_bars(spark, n=6000):
    """Two thirds of the bars are of one symbol; 6-hourly over four years, dealt over 64 partitions."""
    i = F.col("id")
    return (spark.range(n).select(F.when(i % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), (i % 2).cast("string"))).alias("symbol"),
                                  F.expr("make_timestamp_ntz(2020, 1, 1, 0, 0, 0) + make_dt_interval(0, CAST(id * 6 AS INT))").alias("event_time"),
                                  i.alias("n")).repartition(64))


def test_few_files_and_no_task_for_a_whole_symbol(spark, tmp_dir, no_coalescing):
    bars = hot_bars(spark)
    write_parquet(bars, f"{tmp_dir}/t", partition_by=["symbol"], sort_by=["event_time"])
    files = glob.glob(f"{tmp_dir}/t/*/*.parquet")
    assert len(files) <= 8 * 3, "as many as shuffle partitions and symbols at most, whatever the input's partitions are"
    back = spark.read.parquet(f"{tmp_dir}/t")
    hot = back.where("symbol = 'hot'").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    assert len(hot) >= 6 and max(r.n for r in hot) <= 4000 / 3
    assert sorted(back.select("symbol", "n").collect()) == sorted(bars.select("symbol", "n").collect())


def test_rows_of_a_file_are_in_time_order(spark, tmp_dir, no_coalescing):
    write_parquet(hot_bars(spark, 900), f"{tmp_dir}/t", partition_by=["symbol"], sort_by=["event_time"])
    for path in glob.glob(f"{tmp_dir}/t/symbol=hot/*.parquet"):
        times = [r[0] for r in spark.read.parquet(path).select("event_time").collect()]
        assert times == sorted(times)


def test_clump_and_odd_tables(spark, tmp_dir, no_coalescing):
    bars = hot_bars(spark, 900).withColumn("event_time", F.when(F.col("n") % 9 > 0, F.col("event_time")))
    for clump in (None, "year"):
        write_parquet(bars, f"{tmp_dir}/{clump}", partition_by=["symbol"], sort_by=["event_time"], clump=clump)
        assert sorted(r.n for r in spark.read.parquet(f"{tmp_dir}/{clump}").collect()) == list(range(900))
    write_parquet(bars, f"{tmp_dir}/plain", partition_by=["symbol"], sort_by=["n"])
    assert spark.read.parquet(f"{tmp_dir}/plain").count() == 900
    write_parquet(bars.limit(0), f"{tmp_dir}/empty", partition_by=["symbol"], sort_by=["event_time"])
    assert spark.read.schema(bars.schema).parquet(f"{tmp_dir}/empty").count() == 0
