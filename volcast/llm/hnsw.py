"""Approximate nearest neighbours by largest inner product: one HNSW graph per shard.

Distinct vectors are dealt into shards of bounded size.  Each shard becomes a hierarchical
navigable small-world graph: the levels of its vectors are geometric in a hash of the id, every
level links a vector to diverse near neighbours (and back), and the graph is kept as flat
neighbour arrays in one row.  The largest inner product becomes a nearest neighbour by one more
coordinate, ``sqrt(m - |v|^2)`` with ``m`` the largest squared norm of all vectors (0 for queries).

Queries go in blocks through every shard, from the top level down with a beam; the shards' best are
scored again in double precision on the original vectors and merged.  Equal vectors are one
node with its ``k + 1`` smallest ids: no other id of them can be among anybody's ``k`` nearest.

Defined cases: a vector that is null, empty, all zero or holds a null or non-finite component takes
no part, nor does a null id; of rows that repeat an id the smallest vector counts; vectors are
compared with those of their own length; with fewer than ``k`` candidates all are returned; an
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from volcast.llm.common import mix64, written

SHARD, BLOCK = 8192, 512
LINKS, TOP_LINKS, CANDIDATES = 40, 16, 48
BEAM, EXPAND = 96, 4
INDEX = ("dim int, shard int, ids array<long>, vectors binary, level_sizes array<int>, widths array<int>, "
         "nodes binary, neighbours binary")


# -- one shard's graph (plain arrays; a shard's size is bounded)

def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest other rows of every row, nearest first."""
    n = len(x)
    norm = (x * x).sum(1)
    out = np.empty((n, k), dtype=np.int32)
    for at in range(0, n, 256):
        d = norm - 2 * (x[at:at + 256] @ x.T)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k] if k < n else np.argsort(d, axis=1)[:, :k]
        out[at:at + 256] = np.take_along_axis(near, np.take_along_axis(d, near, 1).argsort(1, kind="stable"), 1)
    return out


def link(x: np.ndarray, width: int) -> np.ndarray:
    """Neighbour lists (-1: none): first neighbours not nearer to a chosen one than to the vector, then the nearest;
    half of the width is for those, the rest for links back."""
    n = len(x)
    if n == 1:
        return np.full((1, width), -1, dtype=np.int32)
    near = nearest(x, min(CANDIDATES, n - 1))
    own = width // 2
    chosen: list[np.ndarray] = []
    for at in range(0, n, 128):
        rows = near[at:at + 128]
        c = x[rows]
        to_node = ((c - x[at:at + 128, None]) ** 2).sum(2)
        sq = (c * c).sum(2)
        between = sq[:, :, None] + sq[:, None, :] - 2 * (c @ c.transpose(0, 2, 1))
        taken = np.zeros(rows.shape, dtype=bool)
        for j in range(rows.shape[1]):
            blocked = (taken & (between[:, j] < to_node[:, j, None])).any(1)
            taken[:, j] = ~blocked & (taken.sum(1) < own)
        order = np.argsort(~taken, axis=1, kind="stable")[:, :own]      # the diverse ones, then the nearest
        chosen.append(np.take_along_axis(rows, order, 1))
    forward = np.concatenate(chosen)
    source = np.repeat(np.arange(n, dtype=np.int32), forward.shape[1])
    target = forward.ravel()
    place = np.tile(np.arange(forward.shape[1]), n)
    # both directions; own links first, then links back by how early they were chosen
    a, b = np.concatenate([source, target]), np.concatenate([target, source])
    rank = np.concatenate([place, place + own])
    order = np.lexsort((rank, b, a))
    a, b, rank = a[order], b[order], rank[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, rank = a[new], b[new], rank[new]
    order = np.lexsort((rank, a))
    a, b = a[order], b[order]
    slot = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((n, width), -1, dtype=np.int32)
    ok = slot < width
    out[a[ok], slot[ok]] = b[ok]
    return out


def build(ids: np.ndarray, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per level (0: all): the nodes, and their neighbours as positions in that level's nodes."""
    u = (mix64(ids.astype(np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    level = np.floor(-np.log(np.maximum(u, 1e-18)) / math.log(TOP_LINKS)).astype(int)
    nodes, links = [], []
    for top in range(level.max() + 1):
        at = np.flatnonzero(level >= top).astype(np.int32)
        nodes.append(at)
        links.append(link(x[at], LINKS if top == 0 else TOP_LINKS))
    return nodes, links


def beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, entries: np.ndarray, beam: int) -> np.ndarray:
    """Per query the ``beam`` best positions found (-1: none), from ``entries`` (per query, -1: none)."""
    rows = np.arange(len(q))[:, None]
    n = len(x)
    norm = (x * x).sum(1)

    def distance(at):
        d = norm[at] - 2 * np.einsum("bkd,bd->bk", x[at], q)
        return np.where(at < 0, np.inf, d)

    seen = np.zeros((len(q), n + 1), dtype=bool)        # the last column stands for -1
    seen[:, n] = True
    best = np.full((len(q), beam), -1, dtype=np.int32)
    best[:, :entries.shape[1]] = entries[:, :beam]
    seen[rows, best] = True
    dist = distance(best)
    done = best < 0
    while True:
        open_dist = np.where(done, np.inf, dist)
        pick = np.argpartition(open_dist, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND] if beam > EXPAND \
            else np.argsort(open_dist, axis=1)
        live = ~np.take_along_axis(done, pick, 1)
        active = np.flatnonzero(live.any(1))
        if not len(active):
            return np.take_along_axis(best, np.argsort(dist, axis=1, kind="stable"), 1)
        pick, live = pick[active], live[active]
        from_nodes = np.where(live, best[active[:, None], pick], -1)
        done[active[:, None], pick] = True
        near = np.where(from_nodes[:, :, None] >= 0, links[from_nodes], -1).reshape(len(active), -1)
        near = np.where(seen[active[:, None], near], -1, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[active[:, None], near] = True
        keep = (near >= 0).sum(1).max()
        if not keep:
            continue
        near = near[:, -keep:] if keep == near.shape[1] else np.sort(near, axis=1)[:, -keep:]
        qa = q[active]
        d = np.where(near < 0, np.inf, norm[near] - 2 * np.einsum("bkd,bd->bk", x[near], qa))
        all_ids = np.concatenate([best[active], near], axis=1)
        all_dist = np.concatenate([dist[active], d], axis=1)
        all_done = np.concatenate([done[active], near < 0], axis=1)
        top = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        best[active] = np.take_along_axis(all_ids, top, 1)
        dist[active] = np.take_along_axis(all_dist, top, 1)
        done[active] = np.take_along_axis(all_done, top, 1)


def search(x: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray], q: np.ndarray, beam: int) -> np.ndarray:
    """Positions in ``x`` of the best found for every query, from the top level down."""
    at = np.repeat(nodes[-1][None, :32], len(q), 0)
    for level in range(len(nodes) - 1, -1, -1):
        place = np.full(len(x) + 1, -1, dtype=np.int32)
        place[nodes[level]] = np.arange(len(nodes[level]))
        width = beam if level == 0 else max(16, beam // 4)
        found = beam_search(x[nodes[level]], links[level], q, place[at][:, :width], width)
        at = np.where(found < 0, -1, nodes[level][found])
    return at


def _augmented(v: np.ndarray, largest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(largest - (v * v).sum(1), 0.0))
    return np.concatenate([v, rest[:, None]], axis=1).astype(np.float32)


# -- tables

def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles): one row per id that takes part."""
    v = F.col("v")
    huge = float("inf")
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull()
                   & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge))
                   & F.exists(v, lambda x: x != 0.0))
            # -0.0 and 0.0 are the same component
            .select("vec_id", F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def build_index(spark: SparkSession, classes: DataFrame, largest: dict[int, float], counts: dict[int, int]) -> DataFrame:
    """One row per shard (``INDEX``) of ``classes`` (head, v), written to the shared folder."""
    n_shards = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, -(-n // SHARD))])

    def run(key, rows):
        dim = key[0].as_py()
        ids = rows.column("head").to_numpy()
        v = rows.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        order = np.argsort(ids)
        ids, v = ids[order], v[order]
        nodes, links = build(ids, _augmented(v, largest[dim]))
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
            "ids": pa.array([ids.tolist()], pa.list_(pa.int64())), "vectors": pa.array([v.tobytes()], pa.binary()),
            "level_sizes": pa.array([[len(n) for n in nodes]], pa.list_(pa.int32())),
            "widths": pa.array([[links_.shape[1] for links_ in links]], pa.list_(pa.int32())),
            "nodes": pa.array([np.concatenate(nodes).astype(np.int32).tobytes()], pa.binary()),
            "neighbours": pa.array([b"".join(a.tobytes() for a in links)], pa.binary())})

    # xxhash64 deals the heads evenly, so a shard has about SHARD rows
    dealt = classes.select("head", "v", F.size("v").alias("dim")).withColumn(
        "shard", F.pmod(F.xxhash64("head"), F.element_at(n_shards, F.col("dim"))).cast("int"))
    return written(spark, dealt.groupBy("dim", "shard").applyInArrow(run, INDEX), "hnsw-index")


def load(row: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    ids = np.array(row["ids"], dtype=np.int64)
    v = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(ids), row["dim"])
    flat_nodes, flat_links = (np.frombuffer(row[c], dtype=np.int32) for c in ("nodes", "neighbours"))
    nodes, links, a, b = [], [], 0, 0
    for size, width in zip(row["level_sizes"], row["widths"]):
        nodes.append(flat_nodes[a:a + size])
        links.append(flat_links[b:b + size * width].reshape(size, width))
        a, b = a + size, b + size * width
    return ids, v, nodes, links


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, k: int = 20, query_every: int = 20, beam: int = BEAM,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found for every id divisible by ``query_every``."""
    rows = written(spark, usable(vectors, id_col, vector_col), "hnsw-vectors")
    first = Window.partitionBy("v").orderBy("vec_id")
    # the rank limit is applied before the shuffle too, so a vector that a third of the rows share is no hot group
    members = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = written(spark, members.groupBy("v").agg(F.min("vec_id").alias("head"),
                                                      F.sort_array(F.collect_list("vec_id")).alias("ids")), "hnsw-classes")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    facts = classes.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m")).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts:
        return spark.createDataFrame([], schema)
    largest, counts = {r["dim"]: r["m"] for r in facts}, {r["dim"]: r["n"] for r in facts}
    index = build_index(spark, classes, largest, counts)
    asked = rows.where(F.pmod("vec_id", F.lit(query_every)) == 0).join(
        classes.select("head", F.col("v").alias("class_v")), F.col("v") == F.col("class_v")).select("vec_id", "head", "v")
    distinct = asked.dropDuplicates(["head"]).select("head", "v", F.size("v").alias("dim"))
    n_blocks = max(1, -(-distinct.count() // BLOCK))
    blocks = (distinct.groupBy("dim", F.pmod(F.xxhash64("head"), F.lit(n_blocks)).alias("block"))
              .agg(F.collect_list(F.struct("head", "v")).alias("queries")))
    shards = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, -(-n // SHARD))])
    visits = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.element_at(shards, F.col("dim")) - 1)))

    def visit(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, v, nodes, links = load(row)
                x = _augmented(v, largest[row["dim"]])
                heads = np.array([q["head"] for q in row["queries"]], dtype=np.int64)
                qs = np.array([q["v"] for q in row["queries"]], dtype=np.float64)
                for at in range(0, len(qs), BLOCK):
                    q = qs[at:at + BLOCK]
                    flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
                    found = search(x, nodes, links, flat, beam)
                    score = np.einsum("bkd,bd->bk", v[found], q)
                    score = np.where(found < 0, -np.inf, score)
                    order = np.lexsort((ids[found], -score), axis=1)[:, :k + 1]
                    got = np.take_along_axis(found, order, 1)
                    ok = got >= 0
                    query = np.broadcast_to(heads[at:at + BLOCK, None], got.shape)[ok]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), pa.array(ids[got[ok]]), pa.array(np.take_along_axis(score, order, 1)[ok])],
                        ["query", "head", "score"])

    hits = visits.join(index, ["dim", "shard"]).mapInArrow(visit, "query long, head long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "head")
    hits = hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = (hits.join(classes.select("head", "ids"), "head").select("query", "score", F.explode("ids").alias("vec_id"))
               .withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1).select("query", "score", "vec_id"))
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.select(F.col("vec_id").alias("query_id"), F.col("head").alias("query")).join(answers, "query")
            .where("query_id <> vec_id").withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
