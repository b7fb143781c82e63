"""Dense ids of many values, whatever their first characters are."""
from pyspark.sql import functions as F

from volcast.operators.dataset import dense_ids, range_segment


def test_ids_of_values_with_one_common_prefix(spark):
    values = spark.range(100_000).select(F.concat(F.lit("https://example.org/"), F.md5(F.col("id").cast("string"))).alias("u"))
    twice = values.unionByName(values.limit(500)).unionByName(spark.createDataFrame([(None,)], "u string"))
    got = {r.u: r.symbol_id for r in dense_ids(twice, "u").collect()}
    assert got == {u: i for i, u in enumerate(sorted(r.u for r in values.collect()))}
    per_range = [r["count"] for r in values.groupBy(range_segment(values, "u").alias("s")).count().collect()]
    assert len(per_range) == 128 and max(per_range) < 2 * 100_000 / 128


def test_ids_of_few_odd_values(spark):
    rows = ["", "a", "A", "é", "漢", "😀", "a ", "\t"]
    d = spark.createDataFrame([(r,) for r in rows], "u string")
    for splits, sample in ((1, 10), (3, 10), (128, 2), (128, 16_384)):
        assert {r.u: r.i for r in dense_ids(d, "u", "i", splits, sample).collect()} == {u: i for i, u in enumerate(sorted(rows))}
    assert dense_ids(d.limit(0), "u").collect() == []
    assert [(r.u, r.symbol_id) for r in dense_ids(d.where("u = 'a'"), "u").collect()] == [("a", 0)]
