"""Line dedup: lines that many documents share stay in one document only.

Lines are exploded with their position, normalised and hashed (128 bits); documents are counted
per hash in two steps, first (hash, document), then hash, so a line that a third of all documents
hold is counted by many tasks.  Only hashes, ids and positions are shuffled for that.  The drops
are then collected per document as positions, and the text is put together again without them.
DataFrame functions only.

Defined cases: a null or empty text is one empty line; a document is a ``doc_id``: rows that
repeat an id count as one document, each judged by its own lines, and a null id is one more
document, smaller than all others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcast.llm.common import id_text

SALTS = 16
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """ASCII blanks stripped at both ends, A-Z lower-cased (``lower`` says the same for ASCII text, and is faster)."""
    line = F.btrim(line, F.lit(BLANKS))
    return F.when(F.length(line) == F.octet_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id",
               text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay) for every row; with ``carry`` also ``rest``."""
    # A row is known by its id and its text, so that rows which repeat an id keep their own lines.
    docs = id_text(docs, id_col, text_col, carry)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("t1"),
                       F.xxhash64(F.lit("row"), "text").alias("t2"), *docs.columns[2:])
    lines = (docs.select("doc_id", "t1", "t2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .select("doc_id", "t1", "t2", "pos", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars)
             .select("doc_id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("line"), "key").alias("h2")))
    shared = (lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
              .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"))
              .where(F.col("n_docs") >= min_docs).select("h1", "h2", "holder"))
    # a shared line's rows are many, its holder is one row: rows go to SALTS places, the holder to all of them
    salted = shared.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    drops = (lines.join(salted, ["h1", "h2", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("holder")))
             .groupBy("doc_id", "t1", "t2").agg(F.collect_set("pos").alias("drop"))
             .select(F.col("doc_id").alias("d_id"), F.col("t1").alias("d_t1"), F.col("t2").alias("d_t2"), "drop"))
    joined = docs.join(drops, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("t1") == F.col("d_t1"))
                       & (F.col("t2") == F.col("d_t2")), "left")
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    all_lines = F.split("text", "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("drop")),
                       lambda i: F.get(F.col("lines"), i))
    return (joined.withColumn("lines", F.when(F.col("drop").isNotNull(), all_lines))
            .select("doc_id", n_lines.cast("long").alias("n_lines"),
                    F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
                    F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                    *(["rest"] if carry else [])))
