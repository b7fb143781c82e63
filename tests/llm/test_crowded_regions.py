"""Near duplicates in crowded regions of the forest: every link counts, also those far from any centre."""
import random

import numpy as np
import pytest
from llm_helpers import frame, words

from volcast.llm import lsh_forest
from volcast.llm.lsh_forest import near_duplicates


def crowd(seed, n=1200, planted=300, own=(0,), edits=(0, 3)):
    """Texts of one template without the template itself (110 shingles), each with words of its own (one: typical
    similarity 0.833), and texts of which each is linked to one of them only (two words, three apart: 0.864)."""
    rng = random.Random(seed)

    def changed(w, places):
        w, at = list(w), rng.randrange(6, 104)
        for x in places:
            w[at + x] = f"own{rng.randint(0, 10**12)}"
        return w

    base = [f"t{i}" for i in range(114)]
    rows = [changed(base, own) for _ in range(n)]
    rows += [changed(w, edits) for w in rng.sample(rows, planted)]
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def exact_components(rows, percent):
    """Component per row, from the overlaps of all pairs of sets."""
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (words(t) for _, t in rows)]
    held = {}
    for i, s in enumerate(sets):
        for z in s:
            held.setdefault(z, []).append(i)
    shared = np.zeros((len(rows), sum(len(h) > 1 for h in held.values())), dtype=np.float32)
    for k, h in enumerate(h for h in held.values() if len(h) > 1):
        shared[h, k] = 1
    both, size = shared @ shared.T, np.array([len(s) for s in sets])
    linked = 100 * both >= percent * (size[:, None] + size[None] - both)
    low = np.arange(len(rows))
    while True:
        new = np.where(linked, low[None], len(rows)).min(1)
        if (np.minimum(new, low) == low).all():
            return {rows[i][0]: rows[x][0] for i, x in enumerate(low.tolist())}
        low = np.minimum(new, low)


@pytest.mark.parametrize(("percent", "own"), [(85, (0,)), (80, (0, 2))])
def test_crowd_without_centre(spark, percent, own):
    rows = crowd(percent, own=own)
    want = exact_components(rows, percent)
    got = {r.doc_id: r.component_id for r in near_duplicates(spark, frame(spark, rows), percent=percent).collect()}
    assert got == want


def test_links_of_a_common_shingle_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "CHUNK", 16)
    rows = crowd(3, 300, 100)
    got = {r.doc_id: r.component_id for r in near_duplicates(spark, frame(spark, rows)).collect()}
    assert got == exact_components(rows, 85)


def test_small_regions_are_not_cut_between_tasks(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(5):
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(114)]
        rows += [" ".join(w), " ".join(w[:50] + ["own"] + w[51:])]
    rows = list(enumerate(rows))
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 400)      # more than there are places: every range holds one row
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.doc_id: r.component_id for r in near_duplicates(spark, frame(spark, rows)).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == exact_components(rows, 85)
