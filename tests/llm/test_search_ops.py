"""Operators 5 and 8 against brute force."""
import duckdb
import numpy as np
from conftest import SF_MID
from llm_helpers import edge_rows, frame

from volcast.llm.hnsw import nearest_neighbours
from volcast.llm.license_scan import TEMPLATES, Templates, license_scan

VECTORS = "vec_id long, embedding array<float>, head long, rank int, v string"


def brute(vectors, k, every):
    ids = sorted(vectors)
    out = {}
    for q in ids:
        if q % every == 0:
            near = [(-float(np.dot(vectors[q], vectors[i])), i) for i in ids if i != q and len(vectors[i]) == len(vectors[q])]
            out[q] = [i for _, i in sorted(near)[:k]]
    return out


def test_operator_5_recall_over_the_table(spark):
    path = SF_MID.replace("0.01", "0.1") + "/embeddings.parquet"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}'").fetchall()
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    got = nearest_neighbours(spark, spark.read.parquet(path)).toPandas()
    hit = total = 0
    for q, want in brute(vectors, 20, 20).items():
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and q not in set(mine.vec_id)
        assert np.allclose(mine.score, [vectors[q] @ vectors[i] for i in mine.vec_id], atol=1e-12)
        assert (np.diff(mine.score) <= 0).all()
        hit, total = hit + len(set(want) & set(mine.vec_id)), total + 20
    assert hit / total >= 0.95


def test_operator_5_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    rows += [(i, [1.0, 0, 0, 0, 0, 0]) for i in range(100, 160)]                 # one large group of copies
    rows += [(160, None), (180, [0.0] * 6), (200, [1.0, None, 0, 0, 0, 0]), (220, [float("nan")] + [1.0] * 5),
             (240, [float("inf")] * 6), (260, []), (None, [1.0] * 6), (280, [2.0, 1.0]), (281, [1.0, 3.0]), (0, rows[0][1]),
             (300, [0.0, 0.0, -0.0, 9.0, 0.0, 0.0])]
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows
               if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    floats = [(i, v and [None if x is None else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in floats], VECTORS).repartition(4)
    got = nearest_neighbours(spark, df, k=7).collect()
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        mine.setdefault(r.query_id, []).append(r.vec_id)
    assert mine == brute(vectors, 7, 20)
    assert nearest_neighbours(spark, df.limit(0)).count() == 0


def license_rows():
    name, text = TEMPLATES[4]
    w = text.split()
    edited = " ".join("CHANGED" if i in (30, 61) else x for i, x in enumerate(w))
    return [(100, f"prose before\n{text}\nprose after " * 3), (101, edited), (102, " ".join(w[:30])), (103, text.upper()),
            (104, "Released under the MIT-License!"), (105, "filler " * 700 + TEMPLATES[6][1] + " filler" * 90),
            (106, " ".join(t for _, t in TEMPLATES)), (107, "licensed under the apache license version 3")]


def test_operator_8_equals_a_check_of_all_windows(spark):
    rows = edge_rows() + license_rows()
    rows += duckdb.sql(f"SELECT doc_id + 1000, text FROM '{SF_MID}/documents.parquet'").fetchall()
    got = sorted(map(tuple, license_scan(frame(spark, rows)).collect()), key=repr)
    known = Templates(TEMPLATES)
    want = [(rows[i][0], *rest) for i, *rest in known.scan([(t or "").encode() for _, t in rows], 0.8, retrieve=False)]
    assert got == sorted(want, key=repr)
    found = {}
    for doc, name, *_ in got:
        found.setdefault(doc, set()).add(name)
    assert "Apache-2.0 notice" in found[100] and "Apache-2.0 notice" in found[103] and "MIT line" in found[104]
    assert 102 not in found or "Apache-2.0 notice" not in found[102]
    assert found[106] == {n for n, _ in TEMPLATES} and "GPL-3.0 notice" in found[105]
    start = next(r for r in got if r[0] == 105)[2]
    assert start == 700
    marked = {i for i, t in rows if t and ("Released under the MIT License." in t or "Licensed under CC BY-NC 4.0." in t)}
    assert marked <= set(found)
    assert license_scan(frame(spark, [], 1)).count() == 0


def test_license_lines_are_found_by_plain_search(spark):
    got = {(r.doc_id, r.license) for r in license_scan(spark.read.parquet(f"{SF_MID}/documents.parquet")).collect()}
    for name, line in TEMPLATES[:4]:
        rows = duckdb.sql(f"SELECT doc_id FROM '{SF_MID}/documents.parquet' WHERE contains(text, '{line}')").fetchall()
        assert rows and {(r[0], name) for r in rows} <= got
