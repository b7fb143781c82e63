"""Queries of the training-data operators: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.llm.bpe_trie import encode_decode
from volcast.llm.chat_repair import repair
from volcast.llm.common import table
from volcast.llm.compression_rules import quality_rules
from volcast.llm.filter_audit import filter_audit
from volcast.llm.harmonic_packing import pack
from volcast.llm.hnsw import nearest_neighbours
from volcast.llm.laesa_clusters import centroid_clusters
from volcast.llm.license_scan import license_scan
from volcast.llm.line_dedup import line_dedup
from volcast.llm.lsh_forest import near_duplicates
from volcast.llm.pairwise_quality import fit, score
from volcast.llm.rank_queue import encode_decode as queue_encode_decode
from volcast.llm.seed_extend import substring_dedup


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokeniser's file (never copied into the repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: BPE encoding and decoding of every text by trie traversal."""
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: base statistics and compression bands of every text."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: lines shared by three or more documents stay in the document with the largest id."""
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: components of near-duplicate documents by an LSH forest."""
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: the 20 nearest vectors of every twentieth, by HNSW graphs per shard."""
    return nearest_neighbours(spark, table(spark, sf_dir, "embeddings"))


def op6_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: quality score of every text by a Bradley-Terry model of the labelled training folds."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op7_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: words of repeated 20-word passages removed, but for the first occurrence."""
    return substring_dedup(spark, table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: licence notices in every text."""
    return license_scan(table(spark, sf_dir, "documents"))


def op9_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: every conversation repaired and rendered, piece by piece."""
    return repair(spark, table(spark, sf_dir, "conversations"))


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: every document packed into sequences of 2,048 tokens by harmonic classes."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: byte-level BPE encoding and decoding of every text by a hierarchical-bitmap rank queue."""
    import public_tokenizers

    return queue_encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: what five filters remove in all 120 orders, per language, by folds over mask cells."""
    return filter_audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: ten rounds of centroid clustering of integer vectors with a pivot table."""
    return centroid_clusters(spark, table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_trie": op1_bpe_trie,
    "op2_compression_rules": op2_compression_rules,
    "op3_line_dedup": op3_line_dedup,
    "op4_lsh_forest": op4_lsh_forest,
    "op5_hnsw": op5_hnsw,
    "op6_pairwise_quality": op6_pairwise_quality,
    "op7_seed_extend": op7_seed_extend,
    "op8_license_scan": op8_license_scan,
    "op9_chat_repair": op9_chat_repair,
    "op10_harmonic_packing": op10_harmonic_packing,
    "op11_rank_queue": op11_rank_queue,
    "op12_filter_audit": op12_filter_audit,
    "op13_laesa_clusters": op13_laesa_clusters,
}

OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, row_number() OVER () AS i FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.holder AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id, i
"""

OP12_SQL = r"""
WITH firsts AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first_id FROM documents GROUP BY 1),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
judged AS (
  SELECT part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * length(regexp_replace(words.t, '[^A-Z]', '', 'g')) > 10 * length(words.t))::INT
         + 8 * regexp_matches(words.t, '[#$%&*|]')::INT + 16 * coalesce(words.doc_id > first_id, false)::INT AS mask
  FROM words JOIN firsts ON words.t = firsts.t LEFT JOIN marks m ON words.doc_id = m.doc_id),
f(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, i AS step, bits[i] AS bit, list_sum(bits[1:i])::INT - bits[i] AS seen
  FROM orders, (SELECT unnest(range(1, 6))::INT AS i)),
counted AS (
  SELECT part, filter_order, step, bit,
         count(*) FILTER (WHERE mask & (seen | bit) = 0)::BIGINT AS kept,
         count(*) FILTER (WHERE mask & seen = 0 AND mask & bit <> 0)::BIGINT AS removed,
         count(*) FILTER (WHERE mask & seen <> 0 AND mask & bit <> 0)::BIGINT AS redundant,
         count(*) FILTER (WHERE mask = bit)::BIGINT AS unique_fails,
         count(*) FILTER (WHERE mask & seen = 0 AND mask & bit <> 0 AND good = 1)::BIGINT AS good_lost,
         count(*) FILTER (WHERE mask & seen = 0 AND mask & bit <> 0 AND toxic = 1)::BIGINT AS toxic_lost
  FROM judged, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


def _clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """DuckDB twin of operator 13: one pair of CTEs a round, every vector compared with every centroid."""
    apart = "list_sum(list_transform(range(1, {n}), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))::BIGINT".format(n=dims + 1)
    ctes = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
            f"""c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1)::INT AS c, v FROM kept QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(v.vec_id) AS vec_id, arg_min(c, d * {k} + c) AS c, min(d) AS d
  FROM (SELECT v.r, v.vec_id, c.c, {apart} AS d FROM kept v, c{i} c) v GROUP BY r)""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
      SELECT a.c, i, sum(k.v[i])::BIGINT AS s, count(*) AS n FROM kept k JOIN a{i} a USING (r), range(1, {dims + 1}) x(i)
      GROUP BY a.c, i) GROUP BY c) m ON m.c = o.c)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, a.c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(o.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} o ON a.c = o.c"""


ORACLE: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op12_filter_audit": OP12_SQL, "op13_laesa_clusters": _clusters_sql()}
