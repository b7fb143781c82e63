"""The near-dedup stage links from similarity 0.80 on; op4 keeps its own 0.85."""
import random

import corpus_pipeline
import pytest
from conftest import SF_MID
from llm_helpers import frame, near_components, repeats_removed, sha, words
from test_tokens import check_packing

from volcast.llm.common import table, written
from volcast.llm.lsh_forest import DEPTH, forest, near_duplicates


def swapped(w, n, rng):
    """The words with one replaced in each of ``n`` stretches: each costs five shingles on either side."""
    w, step = list(w), len(w) // n
    for k in range(n):
        w[k * step + step // 2] = f"swap{rng.randint(0, 10**9)}"
    return " ".join(w)


def similarity(a, b):
    a, b = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (words(a), words(b)))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("percent", [70, 80, 85, 90, 95])
def test_forest_misses_no_more_than_stated(percent):
    f, same = forest(percent), percent / 100
    assert (1 - same ** f.base_depth) ** f.trees <= 1e-4 and f.base_depth <= DEPTH
    assert f.screen < same - 4 * (same * (1 - same) / f.hashes) ** .5
    assert forest(85) == (16, 5, 0.72)


def test_copies_between_80_and_85_are_linked_by_the_stage_only(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(60):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(304)]
        rows += [" ".join(base), swapped(base, rng.choice([4, 5, 6]), rng)]
    assert all(similarity(a, b) >= .80 for a, b in zip(rows[::2], rows[1::2]))
    assert sum(similarity(a, b) < .85 for a, b in zip(rows[::2], rows[1::2])) > 20
    rows = list(enumerate(rows))
    stay = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), SF_MID).collect()}
    assert stay == set(range(0, 120, 2))
    got = {r.doc_id: r.component_id for r in near_duplicates(spark, frame(spark, rows)).collect()}
    assert got == {i: c for (i, _), (_, c) in zip(rows, near_components(rows))}


def test_stages_from_near_dedup_on_over_the_table(spark):
    docs = table(spark, SF_MID, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = written(spark, stage(spark, docs, SF_MID), name)
        after = docs.collect()
        if name == "minhash_near_dedup":
            want = {i for (i, _), (n, c) in zip(before, near_components(before, 80)) if not n or c == i}
            assert {r.doc_id for r in after} == want and len(after) == len(want)
        elif name == "substring_dedup":
            want = repeats_removed(before)
            assert all(sha(" ".join(words(r.text))) == want[r.doc_id, dict(before)[r.doc_id]][2] for r in after)
        elif name == "packing":
            check_packing(after, before)
