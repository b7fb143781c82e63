"""Connected components of an edge table, by alternating large-star and small-star steps.

Every round is two grouped minima joined back to the edges; nothing is collected.  A first pass
contracts the edges inside each task, which leaves at most one edge per node and task.  A hot node
is one row of the grouped minima, and the join on it is of the kind Spark splits when skewed.
Rounds are written to the shared checkpoint folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcast.llm.common import written


def _contract(kind: pa.DataType):
    def run(batches):
        above: dict = {}

        def root(x):
            top = x
            while above.get(top, top) != top:
                top = above[top]
            while above.get(x, x) != top:
                above[x], x = top, above[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
        nodes = list(above)
        for at in range(0, len(nodes), 10_000):
            part = nodes[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], ["u", "v"])

    return run


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two columns of one orderable type, no nulls);
    the component is its smallest node."""
    spark = edges.sparkSession
    a, b = edges.columns
    kind_name = edges.schema[a].dataType.simpleString()
    kind = {"binary": pa.binary(), "bigint": pa.int64()}[kind_name]
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = written(spark, e.mapInArrow(_contract(kind), f"u {kind_name}, v {kind_name}").where("u <> v").distinct(), label)
    state = None
    for _ in range(max_rounds):
        # large star: of all neighbours and the node itself, the smallest becomes parent of the larger ones
        both = e.union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours and the node itself get the smallest of them as parent
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = written(spark, small, label)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v", F.col("v").alias("component")).distinct())
