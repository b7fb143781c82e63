"""MinHash near-dedup by an LSH forest.

Every text has ``trees`` labels of ``depth`` minhashes.  Per tree the labels are sorted, so that
texts with the longest common prefixes are neighbours.  Two texts are candidates if they are at
most ``near`` places apart in some tree and share a prefix of at least ``base_depth`` minhashes;
where more than ``near`` texts share that prefix, the window reaches only the longest common
prefixes, that is, the depth grows with the density of the region.  In such a region most texts may
be copies of one text and only near to that one, so each text is also compared with the most central
texts of its stretch of the region (those that agree most with the stretch's commonest minhash bytes),
where the sketches are in memory, and the likest few go on.  What window and centre leave over in crowded regions is found exactly: the texts of such regions are joined on the
prefixes of their full sets, rarest shingle first, across the components linked so far.

Candidates are screened by their minhash sketches and confirmed on the full shingle sets, in
blocks: the texts of a candidate component (cut into chunks if it is large) meet in one task with
the pairs to be confirmed.  Texts with equal sets are one class from the start, so copies of one
text are never paired.  Only ids, hashes and sketches are shuffled, texts once.

Defined cases: null, empty and blank texts have no shingles, are linked with nothing and are kept;
fewer than ``words`` words are one shingle; rows that repeat an id are judged by their own texts;
a null id is smaller than none (it is never the id of a component that has another); an empty
table gives no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.llm.common import Words, id_text, map_rows, mix64, text_bytes, window_hash, written
from volcast.llm.components import components

DEPTH, NEAR, HUBS, BEST = 10, 16, 4, 4
#: Chance that a link of exactly the wanted similarity shares a prefix in no tree.
MISS = 1e-4
BLOCK = 256
#: Rows of one shingle that meet in a task of the exact join; more are dealt in chunks, each pair of chunks to a task.
CHUNK = 2048


class Forest(NamedTuple):
    """Size of the forest for links of ``percent``; ``screen``: the sketch agreement under which a pair is not confirmed."""

    trees: int
    base_depth: int
    screen: float

    @property
    def hashes(self) -> int:
        return self.trees * DEPTH


def forest(percent: int) -> Forest:
    """Prefixes that a link shares in about two of five trees, as many trees as ``MISS`` asks for, and a screen more
    than four deviations below the similarity (85: 16 trees, prefixes of 5, 0.72; 80: 18 trees, 4, 0.66)."""
    same = percent / 100
    base = max(1, min(DEPTH, 80 // max(1, 100 - percent)))
    trees = math.ceil(math.log(MISS) / math.log1p(-same ** base)) if same < 1 else 1
    return Forest(trees, base, round(same - 4.6 * math.sqrt(same * (1 - same) / (trees * DEPTH)), 2))


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of ``n`` minhash functions, from a fixed seed."""
    rng = np.random.default_rng(20240607)
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint32))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of each text (A-Z lower-cased)."""
    w = Words([t.lower() for t in texts])           # bytes.lower() changes A-Z only
    all_windows = window_hash(w.hash, words)
    out = []
    for a, b in zip(w.first.tolist(), w.last.tolist()):
        if b - a >= words:
            out.append(np.unique(all_windows[a:b - words + 1]))
        elif b > a:
            out.append(window_hash(w.hash[a:b], b - a))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def minhashes(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    factor, summand = family
    x = (mix64(shingles) >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factor), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(low, (x[at:at + 512, None] * factor + summand).min(0), out=low)
    return low


def signatures(docs: DataFrame, words: int, shape: Forest) -> DataFrame:
    """doc_id, text_hash, n_shingles, cid (128-bit hash of the set; null: no shingles), label (all minhashes,
    big-endian), sketch (the low byte of every minhash), prefixes (a hash per tree of the first ``base_depth``
    minhashes)."""
    family = _hash_family(shape.hashes)

    def run(batch: pa.RecordBatch):
        n, cid, label, sketch, prefixes = [], [], [], [], []
        for s in shingle_sets(text_bytes(batch.column(1)), words):
            n.append(len(s))
            if not len(s):
                cid.append(None), label.append(None), sketch.append(None), prefixes.append(None)
                continue
            cid.append(xxhash.xxh3_128_digest(s.tobytes()))
            raw = minhashes(s, family).astype(">u4")
            label.append(raw.tobytes())
            sketch.append(label[-1][3::4])
            prefixes.append([xxhash.xxh3_64_intdigest(t[:shape.base_depth].tobytes()) - (1 << 63)
                             for t in raw.reshape(shape.trees, DEPTH)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cid, pa.binary()), pa.array(label, pa.binary()),
             pa.array(sketch, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "n_shingles", "cid", "label", "sketch", "prefixes"])

    return map_rows(docs, run, "doc_id long, text_hash long, n_shingles long, cid binary, label binary, "
                    "sketch binary, prefixes array<long>")


def _tree_rows(classes: DataFrame, trees: str) -> DataFrame:
    """One row per class and tree of the column ``trees``: tree, p, label (of the tree), sketch, cid."""
    width = 4 * DEPTH
    return (classes.select("cid", "label", "sketch", "prefixes", F.explode(trees).alias("tree"))
            .withColumn("p", F.get("prefixes", "tree"))
            .select("tree", "p", F.col("label").substr(F.col("tree") * width + 1, F.lit(width)).alias("label"),
                    "sketch", "cid"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _pairs(found: set) -> pa.RecordBatch:
    rows = sorted(found)
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.binary()), pa.array([b for _, b in rows], pa.binary())],
                                      ["a", "b"])


def _places(batches, shape: Forest):
    """(tree, p, sketches, class ids, rows known before) of every batch with the ``NEAR`` rows before it."""
    carry = None
    for batch in batches:
        if batch.num_rows:
            new = batch if carry is None else pa.concat_batches([carry, batch])
            yield (new.column(0).to_numpy(), new.column(1).to_numpy(), _matrix(new.column(3), shape.hashes),
                   new.column(4).to_pylist(), new.num_rows - batch.num_rows)
            carry = new.slice(max(0, new.num_rows - NEAR))


def _neighbours(shape: Forest):
    """Over whole regions in the order of (tree, label): all screened pairs of neighbours."""

    def run(batches):
        for tree, p, sketch, cid, old in _places(batches, shape):
            found: set[tuple] = set()
            for k in range(1, min(NEAR, len(tree) - 1) + 1):
                i = np.flatnonzero((tree[k:] == tree[:-k]) & (p[k:] == p[:-k])) + k
                i = i[i >= old]
                if not len(i):
                    break           # a region of k + 1 rows is one of k rows too
                for at in range(0, len(i), 4096):
                    j = i[at:at + 4096]
                    for x in j[(sketch[j] == sketch[j - k]).mean(1) >= shape.screen].tolist():
                        found.add((min(cid[x], cid[x - k]), max(cid[x], cid[x - k])))
            yield _pairs(found)

    return run


def _central(shape: Forest):
    """Over stretches of crowded regions in the order of (tree, label): the screened pairs of every text with its
    ``BEST`` likest ones of the ``NEAR`` places before it and the most central texts among the rows in memory (those
    of the batch and of the region's batches before)."""

    def run(batches):
        hubs: list[tuple] = []              # (tree, p, sketch, cid) of the last region
        for tree, p, sketch, cid, old in _places(batches, shape):
            found: set[tuple] = set()
            edge = np.flatnonzero(np.diff(p, prepend=p[0] ^ 1) | np.diff(tree, prepend=tree[0]))
            for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(p)]):
                hubs = [h for h in hubs if h[:2] == (tree[lo], p[lo])]
                if hi - lo > NEAR:
                    region = sketch[lo:hi]
                    common = np.array([np.bincount(c, minlength=256).argmax() for c in region.T], dtype=np.uint8)
                    best = np.argsort(-(region == common).mean(1), kind="stable")[:HUBS]
                    hubs = hubs[:3 * HUBS] + [(tree[lo], p[lo], region[x], cid[lo + x]) for x in best.tolist()]
                for at in range(max(lo, old), hi, 4096):
                    rows = np.arange(at, min(at + 4096, hi))
                    near = [np.where(rows - k >= lo, (sketch[rows] == sketch[np.maximum(rows - k, lo)]).mean(1), -1.0)
                            for k in range(1, NEAR + 1)]
                    far = [(sketch[rows] == h[2]).mean(1) for h in hubs]
                    agree = np.stack(near + far, axis=1)
                    for c in np.argsort(-agree, axis=1, kind="stable")[:, :BEST].T:
                        ok = agree[np.arange(len(rows)), c] >= shape.screen
                        for x, y in zip(rows[ok].tolist(), c[ok].tolist()):
                            other = cid[x - y - 1] if y < NEAR else hubs[y - NEAR][3]
                            if other != cid[x]:
                                found.add((min(cid[x], other), max(cid[x], other)))
            yield _pairs(found)

    return run


def candidate_pairs(spark: SparkSession, classes: DataFrame, shape: Forest) -> tuple[DataFrame, DataFrame]:
    """Distinct screened pairs ``a, b`` of class ids, from the forest; the ``cid`` of the texts of crowded regions, of
    which the forest does not compare all pairs."""
    places = classes.select("cid", F.posexplode("prefixes").alias("tree", "p"))
    regions = places.groupBy("tree", "p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    few, many = (F.collect_set(F.when((F.col("n") > NEAR) == crowded, F.col("tree"))) for crowded in (False, True))
    shared = places.join(regions, ["tree", "p"]).groupBy("cid").agg(few.alias("few"), many.alias("many"))
    kept = written(spark, classes.join(shared, "cid").dropDuplicates(["cid"]), "forest-classes")
    # a small region stays in one task and is compared whole; a crowded one is cut anywhere, the exact join covers its borders
    order = ["tree", "label", "cid"]
    small = (_tree_rows(kept, "few").repartition("tree", "p").sortWithinPartitions(*order)
             .mapInArrow(_neighbours(shape), "a binary, b binary"))
    large = (_tree_rows(kept, "many").repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(_central(shape), "a binary, b binary"))
    return (written(spark, small.union(large).distinct(), "forest-candidates"),
            kept.where(F.size("many") > 0).select("cid"))


def _confirm(numerator: int, denominator: int):
    def run(key, pairs, sets):
        full = {c: np.frombuffer(s, dtype=np.uint64) for c, s in
                zip(sets.column("cid").to_pylist(), sets.column("shingles").to_pylist())}
        a_out, b_out = [], []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            x, y = full[a], full[b]
            if denominator * min(len(x), len(y)) < numerator * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if denominator * both >= numerator * (len(x) + len(y) - both):
                a_out.append(a), b_out.append(b)
        return pa.table({"a": pa.array(a_out, pa.binary()), "b": pa.array(b_out, pa.binary())})

    return run


def text_sets(spark: SparkSession, docs: DataFrame, first: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """cid, shingles (the full set, packed) of the classes in ``ids``, from one row of each."""
    source = first.join(ids, "cid", "left_semi")

    def sets_of(batch: pa.RecordBatch):
        sets = [s.tobytes() for s in shingle_sets(text_bytes(batch.column(1)), words)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["cid", "shingles"])

    texts = docs.join(source, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash")))
    return written(spark, map_rows(texts.select("cid", "text"), sets_of, "cid binary, shingles binary"), "forest-sets")


def confirmed_links(spark: SparkSession, pairs: DataFrame, sets_of, numerator: int, denominator: int) -> DataFrame:
    """The candidate pairs whose full sets are similar enough, confirmed in blocks; ``sets_of`` gives the sets of ids."""
    groups = components(pairs, "forest-groups")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    n_small = sizes.where(F.col("size") <= BLOCK).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = n_small // BLOCK + 1
    # small components share blocks; a large one has blocks for each pair of its chunks
    place = written(spark, groups.join(sizes, "component").select(
        "node", F.when(F.col("size") <= BLOCK, F.lit(-1)).otherwise(F.xxhash64("component")).alias("region"),
        F.when(F.col("size") <= BLOCK, F.pmod(F.xxhash64("component"), F.lit(buckets)))
        .otherwise(F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK))).alias("chunk")), "forest-places")
    pa_, pb_ = (place.select(F.col("node").alias(c), F.col("region").alias(f"r{c}"), F.col("chunk").alias(f"c{c}"))
                for c in "ab")
    keyed = written(spark, pairs.join(pa_, "a").join(pb_, "b").select(
        F.col("ra").alias("region"), F.least("ca", "cb").alias("c1"), F.greatest("ca", "cb").alias("c2"), "a", "b"),
        "forest-blocks")
    sets = sets_of(place.select(F.col("node").alias("cid")))
    sides = keyed.select("region", "c1", "c2", F.explode(F.array("a", "b")).alias("cid")).distinct()
    block = ["region", "c1", "c2"]
    by_block = (sides.join(sets.dropDuplicates(["cid"]), "cid").select(*block, "cid", "shingles")
                .toDF("block_region", "block_1", "block_2", "cid", "shingles"))
    return written(spark, keyed.groupBy(*block).cogroup(by_block.groupBy("block_region", "block_1", "block_2")).applyInArrow(
        _confirm(numerator, denominator), "a binary, b binary"), "forest-links")


def _shingle_rows(batches):
    for batch in batches:
        for cid, part, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            tokens = np.frombuffer(s, dtype=np.int64)
            for at in range(0, len(tokens), 10_000):
                t = tokens[at:at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t), pa.array([cid] * len(t), pa.binary()), pa.array(np.full(len(t), part)),
                     pa.array(np.full(len(t), len(tokens)))], ["token", "cid", "part", "n"])


def _prefix_pairs(numerator: int, denominator: int):
    """Over rows in the order of (token, c1, c2): pairs of different components whose sets can be similar enough if the
    token is the first that they share."""

    def block(rows: pa.Table):
        c1, c2 = rows.column("c1")[0].as_py(), rows.column("c2")[0].as_py()
        part, n, left, c = (rows.column(x).to_numpy() for x in ("part", "n", "left", "c"))
        cid = rows.column("cid").to_pylist()
        # the smaller set of a pair leaves so many shingles that two sets of its size could be similar enough
        for i in np.flatnonzero((numerator + denominator) * left >= 2 * numerator * n).tolist():
            fits = ((part != part[i]) & (n >= n[i]) & (numerator * n <= denominator * n[i])
                    & ((numerator + denominator) * np.minimum(left, left[i]) >= numerator * (n + n[i])))
            if c1 != c2:
                fits &= c != c[i]
            j = np.flatnonzero(fits).tolist()
            if j:
                yield pa.RecordBatch.from_arrays([pa.array([min(cid[i], cid[x]) for x in j], pa.binary()),
                                                  pa.array([max(cid[i], cid[x]) for x in j], pa.binary())], ["a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(x).to_numpy() for x in range(3)])
            edge = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edge, edge[1:]):
                if held and any(held[0].column(x)[0].as_py() != keys[x, lo] for x in range(3)):
                    yield from block(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from block(pa.Table.from_batches(held))

    return run


def crowded_links(spark: SparkSession, sets: DataFrame, links: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Every link between texts of ``sets`` that are in different components of ``links``.

    Shingles held by one component only come first in the order of a set, then the others, rarest first.  The first
    shingle that two similar sets share is among the first of both, with enough shingles left in both for the overlap.
    So only those prefixes are joined, and within a component nothing is."""
    parts = components(links, "forest-parts").withColumnRenamed("node", "cid")
    tagged = sets.join(parts, "cid", "left").select(
        "cid", F.xxhash64(F.coalesce("component", "cid")).alias("part"), "shingles")
    tokens = written(spark, tagged.mapInArrow(_shingle_rows, "token long, cid binary, part long, n long"), "forest-shingles")
    live = (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("part").alias("lo"), F.max("part").alias("hi"))
            .where("lo < hi").select("token", "df"))
    ranked = (tokens.join(live, "token").groupBy("cid", "part", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("order")))
    spare = F.size("order") - F.ceil(F.col("n") * numerator / denominator)
    prefix = (ranked.where(spare >= 0)
              .select("cid", "part", "n", F.size("order").alias("live"),
                      F.posexplode(F.slice("order", F.lit(1), (spare + 1).cast("int"))).alias("at", "x"))
              .select(F.col("x.token").alias("token"), "cid", "part", "n", (F.col("live") - F.col("at")).cast("long").alias("left")))
    prefix = written(spark, prefix, "forest-prefixes")
    smaller = (numerator + denominator) * F.col("left") >= 2 * numerator * F.col("n")
    met = (prefix.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("part").alias("lo"), F.max("part").alias("hi"),
                                       F.max(smaller).alias("any")).where("lo < hi and any")
           .select("token", F.ceil(F.col("m") / CHUNK).alias("chunks")))
    dealt = (prefix.join(met, "token").withColumn("c", F.pmod(F.xxhash64("cid"), F.col("chunks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select("token", F.least("c", "other").alias("c1"), F.greatest("c", "other").alias("c2"), "c", "cid", "part", "n", "left"))
    key = ["token", "c1", "c2"]
    pairs = written(spark, dealt.repartition(*key).sortWithinPartitions(*key)
                    .mapInArrow(_prefix_pairs(numerator, denominator), "a binary, b binary").distinct(), "forest-crowded")
    return confirmed_links(spark, pairs, lambda ids: sets.join(ids, "cid", "left_semi"), numerator, denominator)


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash (xxhash64): components of the links ``100 * |a & b| >= percent * |a | b|``."""
    shape = forest(percent)
    docs = id_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    sigs = written(spark, signatures(docs, words, shape), "forest-signatures")
    shaped = sigs.where("cid is not null")
    # texts with equal sets are one class; its shingles and signature are those of one of its rows
    first = written(spark, shaped.groupBy("cid").agg(F.min("doc_id").alias("first_id"),
                                                     F.min(F.struct("doc_id", "text_hash")).alias("one"))
                    .select("cid", "first_id", F.col("one.doc_id").alias("one_id"),
                            F.col("one.text_hash").alias("one_hash")), "forest-first")
    # joined on the row as well as the class, so the copies of one text are dealt out
    one = first.select(F.col("cid").alias("one_cid"), "one_id", "one_hash")
    mine = ((F.col("cid") == F.col("one_cid")) & F.col("doc_id").eqNullSafe(F.col("one_id"))
            & (F.col("text_hash") == F.col("one_hash")))
    classes = shaped.join(one, mine).select("cid", "label", "sketch", "prefixes")
    pairs, crowded = candidate_pairs(spark, classes, shape)
    links = confirmed_links(spark, pairs, lambda ids: text_sets(spark, docs, first, ids, words), percent, 100)
    sets = text_sets(spark, docs, first, crowded, words).dropDuplicates(["cid"])
    links = links.union(crowded_links(spark, sets, links, percent, 100))
    linked = components(links, "forest-components")
    heads = (first.select("cid", "first_id")
             .join(linked.withColumnRenamed("node", "cid"), "cid", "left")
             .select("cid", "first_id", F.coalesce("component", "cid").alias("component")))
    lowest = heads.groupBy("component").agg(F.min("first_id").alias("component_id"))
    heads = heads.join(lowest, "component").select(F.col("cid").alias("class"), "component_id")
    out = sigs.select("doc_id", "text_hash", "n_shingles", "cid").join(heads, F.col("cid") == F.col("class"), "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")
