"""Operators 2 and 6: base statistics against plain Python, bands, held-out accuracy, edge rows."""
import re
from collections import Counter

import duckdb
import numpy as np
from conftest import SF_MID
from llm_helpers import edge_rows, frame, words

from volcast.llm.compression_rules import Bands, quality_rules
from volcast.llm.pairwise_quality import FEATURES, accepted, features, fit, fit_pairs, score


def base(text):
    w, lines = words(text), (text or "").split("\n")
    with_word = [x for x in lines if words(x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    n, r = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(with_word) - len(set(with_word)), r,
            n < 20 or 100 * r > 30 * n)


def check_rules(df, rows):
    got = sorted((tuple(r)[:7] for r in df.collect()), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in rows), key=repr)


def test_operator_2_statistics(spark):
    rows = edge_rows() + [(20, "a b c\n" * 30), (21, "#*$ |<>\n#*$ |<>\n \n \n"), (22, " ".join("abcdefghij" * 4))]
    check_rules(quality_rules(frame(spark, rows)), rows)
    assert quality_rules(frame(spark, [], 1)).count() == 0


def test_operator_2_statistics_over_the_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_MID}/documents.parquet'").fetchall()
    check_rules(quality_rules(spark.read.parquet(f"{SF_MID}/documents.parquet")), rows)


def test_bands_reject_repetitive_and_incompressible_texts(spark):
    rng = np.random.default_rng(1)
    prose = " ".join("".join(rng.choice(list("etaoinshr"), rng.integers(2, 9))) for _ in range(300))
    noise = "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 4000)))
    noise = " ".join(noise[i:i + 5] for i in range(0, 4000, 5))
    dull = " ".join(f"line {i % 7} of {i % 11} in {i % 13} {'x' * 40}" for i in range(400))
    half = prose * 8 + dull
    kept = {r.doc_id: (r.kept, r.base_failed) for r in
            quality_rules(frame(spark, [(1, prose), (2, noise), (3, dull)])).collect()}
    assert kept[1] == (True, False)
    assert not kept[3][0]
    assert kept[2][1] is False and Bands.inside(Bands().whole, 10, 1.0)
    row = quality_rules(frame(spark, [(1, half)])).first()
    assert row.n_chunks > 1 and row.n_odd_chunks >= 1


def test_operator_6_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID.replace('0.01', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    got = score(docs, fit(docs, labels)).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 500 and (held.predicted == held.quality).mean() > 0.99
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_operator_6_edge_rows(spark):
    rows = edge_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(5, 1, 0), (10, 0, 0), (7, 1, 0), (8, 0, 1), (2, 0, 0), (2, 1, 0), (None, 1, 0),
                                    (6, None, 0), (6, 1, None)], "doc_id long, quality int, toxic int")
    model = fit(docs, labels)
    got = score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1        # null, empty and blank are alike
    assert all(r.held_out is False for r in got if r.doc_id is None)
    kept = accepted(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in got)
    none = fit(docs, labels.where("quality = 1"))                            # one label only: no order to learn
    assert all(abs(r.score - 0.5) < 1e-9 for r in score(docs, none).collect())
    assert score(frame(spark, [], 1), model).count() == 0


def test_pairs_are_ranked_rightly():
    rng = np.random.default_rng(3)
    y = (rng.random(600) < 0.7).astype(int)
    x = rng.normal(size=(600, len(FEATURES)))
    x[:, 0] += 3 * y
    model = fit_pairs(x, y, 0.3)
    s = model.scores(x)
    order = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert order > 0.97 and ((s >= 0.3) == (y == 1)).mean() > 0.9
    assert len(features("Aé 1".encode())) == len(FEATURES)
