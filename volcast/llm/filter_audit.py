"""Filter interaction audit by higher-order SQL folds.

Every document fails some of five filters; its failures are one mask.  Documents with one mask in
one part are a cell, so a part has at most 32 cells.  Each cell is folded across the array of all
120 filter orders: ``aggregate`` walks the steps of an order and carries the filters seen so far,
``transform`` does so for every order, and the cell becomes 600 structs of counts (kept, removed,
redundant, unique_fails, good_lost, toxic_lost), weighted by its documents.  The cells of a part are
merged by elementwise sums of those structs.

Only ids, 32-byte text hashes and masks are shuffled.  Repeated rows are counted before anything
moves; the smallest id of a text is a grouped minimum, and it is joined back on hash and id together,
so the copies of one text are dealt out.

Filters, in the letters of an order: A under 100 words; B fewer than 80 % distinct words; C more than
10 % capital letters A-Z; D any of ``#$%&*|``; E the text of a smaller doc_id (a SHA-256 stands for it).

Defined cases: a null text is empty, a null lang is the part ``''``; no words fail A, not B; a null
doc_id is smaller than none and has none smaller, so it does not fail E, and has no label; rows that
repeat an id each count, and do not fail E by one another; a document with several labels is good
(toxic) if one of them says so; texts of any length are judged whole; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.llm.common import written

FILTERS = "ABCDE"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` fails (A: 1, B: 2, C: 4, D: 8)."""
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    n_words, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    tests = (n_words < 100, 100 * distinct < 80 * n_words, 100 * capitals > 10 * F.length(text).cast("long"),
             text.rlike("[#$%&*|]"))
    bits = [F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(tests)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def cells(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: documents of every mask in every part (at most 32 rows a part)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
            .select("doc_id", F.unhex(F.sha2(text, 256)).alias("h"), "part", failures(text).alias("mask"))
            .groupBy("doc_id", "h", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    rows = written(spark, rows, "audit-rows")
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first_id")).select(F.col("h").alias("first_h"), "first_id")
    later = F.col("first_id").isNull() & F.col("doc_id").isNotNull()
    masked = (rows.join(first, (F.col("h") == F.col("first_h")) & (F.col("doc_id") == F.col("first_id")), "left")
              .select("doc_id", "part", "n", (F.col("mask") + F.when(later, F.lit(16)).otherwise(F.lit(0))).alias("mask"),
                      # null ids meet no label; the salt deals them out
                      F.when(F.col("doc_id").isNull(), F.xxhash64("h")).otherwise(F.lit(0)).alias("salt")))
    marks = (labels.groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
             .withColumn("label_salt", F.lit(0).cast("long")))
    joined = masked.join(marks, (F.col("doc_id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))


def folded(mask: Column, n: Column, good: Column, toxic: Column, orders: list[str]) -> Column:
    """Array of one struct per order and step: the bit of the step's filter and the cell's weighted counts."""
    steps = F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in order]) for order in orders])
    zero = F.lit(0).cast("long")

    def step(seen: Column, bit: Column) -> Column:
        reached, fails = mask.bitwiseAND(seen) == 0, mask.bitwiseAND(bit) != 0
        here = reached & fails
        return F.struct(
            bit.alias("bit"), F.when(reached & ~fails, n).otherwise(zero).alias("kept"), F.when(here, n).otherwise(zero).alias("removed"),
            F.when(~reached & fails, n).otherwise(zero).alias("redundant"), F.when(mask == bit, n).otherwise(zero).alias("unique_fails"),
            F.when(here, good).otherwise(zero).alias("good_lost"), F.when(here, toxic).otherwise(zero).alias("toxic_lost"))

    nothing = "cast(array() as array<struct<bit:int,kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>>)"

    def walk(order: Column) -> Column:
        start = F.struct(F.lit(0).alias("seen"), F.expr(nothing).alias("out"))
        return F.aggregate(order, start, lambda acc, bit: F.struct(
            acc["seen"].bitwiseOR(bit).alias("seen"), F.concat(acc["out"], F.array(step(acc["seen"], bit))).alias("out")),
            lambda acc: acc["out"])

    return F.flatten(F.transform(steps, walk))


def summed(one: Column, other: Column) -> Column:
    """Elementwise sum of two folds."""
    return F.zip_with(one, other, lambda a, b: F.struct(a["bit"].alias("bit"), *[(a[c] + b[c]).alias(c) for c in COUNTS]))


def filter_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    found = cells(spark, docs, labels, id_col, text_col, part_col)
    folds = found.select("part", folded(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic"), orders).alias("fold"))
    # a part has 32 cells at most, so its list is bounded
    parts = (folds.groupBy("part").agg(F.collect_list("fold").alias("folds"))
             .select("part", F.aggregate(F.slice("folds", 2, 32), F.get("folds", F.lit(0)), summed).alias("fold")))
    steps = parts.select("part", "fold", F.posexplode("fold").alias("at", "x"))
    shapley = F.aggregate("fold", F.lit(0).cast("long"),
                          lambda total, y: total + F.when(y["bit"] == F.col("x.bit"), y["removed"]).otherwise(F.lit(0).cast("long")))
    names = F.array(*map(F.lit, orders))
    return steps.select("part", F.get(names, F.floor(F.col("at") / 5).cast("int")).alias("filter_order"),
                        (F.pmod("at", F.lit(5)) + 1).cast("int").alias("step"), *[F.col(f"x.{c}").alias(c) for c in COUNTS],
                        shapley.alias("shapley"))
