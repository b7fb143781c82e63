"""Session helpers: settings, scratch folders, input identity."""
import os

from volcast.session import cluster_settings, drop_scratch, fresh_scratch, scratch_dir, source_signature


def test_cluster_settings_follow_the_shuffled_bytes():
    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64
    assert int(cluster_settings(1 << 40, 64)["spark.sql.shuffle.partitions"]) == (1 << 40) // (128 << 20) + 1
    assert int(big["spark.sql.shuffle.partitions"]) == 20_000          # blocks stay countable
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_dir_from_session(spark):
    base = scratch_dir(spark)
    assert base and scratch_dir(spark, "x").endswith("/x")


def test_signature_follows_the_files(spark, tmp_dir):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_dir}/t")
    a = source_signature(spark, f"{tmp_dir}/t")
    assert a == source_signature(spark, f"{tmp_dir}/t")
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/t")
    assert a != source_signature(spark, f"{tmp_dir}/t")


def test_changed_input_is_not_answered_from_old_stage_tables(spark, tmp_dir):
    from volcast.plans import common
    spark.range(3).coalesce(1).write.parquet(f"{tmp_dir}/t")

    def stage():
        key = ("stage_test", source_signature(spark, f"{tmp_dir}/t"))
        return common.materialized(spark, key, lambda: spark.read.parquet(f"{tmp_dir}/t")).count()

    assert stage() == 3
    spark.range(4).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/t")
    assert stage() == 7


def test_scratch_folders_are_removed_at_the_end(spark):
    from volcast import session
    app = spark.sparkContext.applicationId
    kept = session._SCRATCH.pop(app, [])
    path = fresh_scratch(spark, "gone")
    spark.range(2).write.parquet(path)
    drop_scratch(spark)
    assert not os.path.exists(path.replace("file:", ""))
    session._SCRATCH[app] = kept
