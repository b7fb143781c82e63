"""Operators 11 to 13 against the tiktoken library, plain Python and brute force."""
import base64
import hashlib
import math
import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_MID
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import edge_rows, frame, words

from volcast.llm import laesa_clusters as lc
from volcast.llm.filter_audit import filter_audit
from volcast.llm.laesa_clusters import centroid_clusters
from volcast.llm.rank_queue import LONG, QueueEncoder, encode_decode, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = read_ranks(open(PATH, "rb").read())
LIB = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
QUEUE = QueueEncoder(RANKS, public_tokenizers.PATTERN)
MIXED = st.text(alphabet="abcTHE  \n\t'st.,!019éß日​\x85\xa0\x1c　🙂<|endoftext|>", max_size=80)


# ---------------------------------------------------------------- operator 11

@settings(max_examples=300, deadline=None)
@given(MIXED | st.text(max_size=40))
def test_queue_equals_the_library(text):
    want = LIB.encode_ordinary(text)
    assert QUEUE.encode(text) == want
    assert QUEUE.decode(want) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=6), unique=True, max_size=12), st.text("ab", max_size=60))
def test_any_order_of_ranks(tokens, word):
    """Ranks in any order: a merge may bring up a pair of lower rank than its own."""
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
    lib = tiktoken.Encoding("ab", pat_str="[ab]+", mergeable_ranks=ranks, special_tokens={})
    queue = QueueEncoder(ranks, "[ab]+")
    assert queue.encode(word) == lib.encode_ordinary(word)
    assert not any(queue.words_of_bits)


def test_very_long_pre_tokens():
    rng = random.Random(3)
    for word in ("a" * 50_000, "".join(rng.choice("abcdefgh") for _ in range(60_000)), "é" * 20_000, " " * 9_000 + "x", "!" * 30_000):
        ids = QUEUE.encode(word)
        assert QUEUE.decode(ids) == word.encode()
        assert ids == LIB.encode_ordinary(word)
    word = "".join(rng.choice("abcdefgh") for _ in range(LONG + 5))
    ids = QUEUE.encode(word)
    assert QUEUE.decode(ids) == word.encode() and not QUEUE.known and not any(QUEUE.words_of_bits)
    assert ids == [i for part in QUEUE.merge_all([word.encode()]) for i in part]


def test_forgetting_does_not_change_ids():
    small = QueueEncoder(RANKS, public_tokenizers.PATTERN, remember=3)
    for text in ("the quick brown fox jumps over the lazy dogs' qwrtzplk again and again", "Zyx wvu tsr qpo"):
        assert small.encode(text) == LIB.encode_ordinary(text)


def test_operator_11_over_edge_rows(spark):
    rows = edge_rows()
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    got = sorted(map(tuple, encode_decode(frame(spark, rows), PATH, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = LIB.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(LIB.decode_bytes(ids))))
    assert got == sorted(want, key=repr)
    one = encode_decode(frame(spark, [(1, "a b")]), PATH, public_tokenizers.PATTERN, keep_ids=True).first()
    assert one.ids == LIB.encode_ordinary("a b") and bytes(one.decoded) == b"a b"
    assert encode_decode(frame(spark, [], 1), PATH, public_tokenizers.PATTERN).count() == 0


def test_operator_11_over_the_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_MID}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in encode_decode(spark.read.parquet(f"{SF_MID}/documents.parquet"), PATH,
                                              public_tokenizers.PATTERN).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        ids = LIB.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_ranks_need_all_bytes_and_skip_blank_lines():
    assert read_ranks(base64.b64encode(b"x") + b" 7\n\n") == {b"x": 7}
    with pytest.raises(ValueError, match="lacks a byte"):
        QueueEncoder({b"a": 0}, "a+")
    with pytest.raises(ValueError, match="UTF-8"):
        QueueEncoder({bytes([b]): b for b in range(256)} | {b"\xff\xff": 256}, "a+")


# ---------------------------------------------------------------- operator 12

def audit(rows, labels):
    """Rows of the audit, document by document, for (doc_id, text, lang) rows and (doc_id, quality, toxic) labels."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = Counter()
    parts = {p or "" for _, _, p in rows}
    for i, t, p in rows:
        t, p, w = t or "", p or "", words(t)
        fails = {f for f, bad in (("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)),
                                  ("C", 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t)),
                                  ("D", any(c in "#$%&*|" for c in t)), ("E", i is not None and first[t] < i)) if bad}
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for k, f in enumerate(order, 1):
                at = (p, order, k)
                if f in fails:
                    out[*at, "redundant" if gone else "removed"] += 1
                    if not gone:
                        out[*at, "good_lost"] += i in good
                        out[*at, "toxic_lost"] += i in toxic
                        out[p, f] += 1
                    out[*at, "unique_fails"] += fails == {f}
                    gone = True
                out[*at, "kept"] += not gone
    return sorted((p, order, k, *(out[p, order, k, c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")),
                   out[p, f]) for p in parts for order in map("".join, permutations("ABCDE")) for k, f in enumerate(order, 1))


def test_operator_12_equals_document_by_document_counts(spark):
    rng = random.Random(9)
    texts = [None, "", "A B C", "word " * 120, " ".join(f"w{i}" for i in range(150)), " ".join(f"W{i}" for i in range(150)),
             " ".join(f"w{i}" for i in range(110)) + " 5%", "x|y", " \x0b\t", "żółw ÄÖÜ " * 30, "SHOUT " * 200 + "#"]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(300)]
    rows += rows[:20] + [(i, t, "fr") for i, t in edge_rows()]
    labels = [(rng.choice([None, *range(45)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, p, 1, "h", 2) for i, t, p in rows],
                                 "doc_id long, text string, lang string, mask int, part string, n long").repartition(4)
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string").repartition(2)
    got = filter_audit(spark, docs, marks)
    assert sorted(map(tuple, got.collect())) == audit(rows, labels)
    assert filter_audit(spark, docs.limit(0), marks).count() == 0
    unlabelled = filter_audit(spark, docs, marks.limit(0))
    assert unlabelled.agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[0] == 0


# ---------------------------------------------------------------- operator 13

VECTORS = "vec_id long, embedding array<float>, v int, cluster string, distance double"


def clusters(rows, k, rounds, dims, scale):
    """Every vector against every centroid, in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seed = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=seed)[:k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for at in range(rounds + 1):
        of = [min(range(len(centroids)), key=lambda c: (apart(v, centroids[c]), c)) for _, v in kept]
        if at < rounds:
            for c in range(len(centroids)):
                mine = [v for (_, v), x in zip(kept, of) if x == c]
                if mine:
                    centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    d = [apart(v, centroids[c]) for (_, v), c in zip(kept, of)]
    per = Counter()
    for c, x in zip(of, d):
        per[c] += x
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, x, per[c], sum(d), digest[c]) for (i, _), c, x in zip(kept, of, d)), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2.0) for i, v in rows], VECTORS).repartition(4)


@pytest.mark.parametrize("n", [3, 200])
def test_operator_13_equals_all_comparisons(spark, n):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, 6)) * 3
    rows = [(i, (centres[i % 5] + rng.normal(size=6) * rng.choice([.02, 1])).astype(np.float32).tolist()) for i in range(n)]
    rows += [(i, rows[0][1]) for i in range(1000, 1030)]                          # copies: ties and empty centroids
    rows += [(5, [1.0] * 6), (5, [0.5] * 6), (5, [0.5] * 6), (None, [0.25] * 6), (None, [-0.25] * 6)]
    odd = [(7000, None), (7001, []), (7002, [1.0] * 5), (7003, [1.0, None, 0, 0, 0, 0]), (7004, [float("nan")] + [1.0] * 5),
           (7005, [float("-inf")] * 6), (7006, [0.0, -0.0, 1e-30, -1e-30, 0.0, 0.0])]
    rows += [(i, v and [None if x is None else float(x) for x in v]) for i, v in odd]
    got = centroid_clusters(spark, vectors(spark, rows), dims=6, rounds=4)
    assert sorted(map(tuple, got.collect()), key=repr) == clusters(rows, 8, 4, 6, 1024)


def test_operator_13_few_vectors_empty_table_and_huge_components(spark):
    rows = [(1, [0.5, 1.5]), (2, [0.5, 1.5]), (3, [-2.0, 7.0])]
    got = centroid_clusters(spark, vectors(spark, rows), dims=2, rounds=2)
    assert sorted(map(tuple, got.collect()), key=repr) == clusters(rows, 8, 2, 2, 1024)
    assert centroid_clusters(spark, vectors(spark, rows)).count() == 0            # none has 64 components
    assert centroid_clusters(spark, vectors(spark, [])).count() == 0
    with pytest.raises(ValueError, match="do not fit a long"):
        centroid_clusters(spark, vectors(spark, [(1, [1e9, 0.0])]), dims=2)


def test_pivot_bounds_spare_exact_distances_and_keep_ties():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-4000, 4000, (8, 16))
    v = centroids[rng.integers(0, 8, 3000)] + rng.integers(-300, 300, (3000, 16))
    v[:50] = (centroids[0] + centroids[1]) // 2
    pivots = lc.spread_out(v[:256], lc.PIVOTS)
    cluster, best, exact = lc.nearest(v, lc.pivot_distances(v, pivots), centroids, pivots)
    every = ((v[:, None] - centroids[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (best == every.min(1)).all()
    assert exact < 1.5 * len(v)                     # of 8 * len(v)
