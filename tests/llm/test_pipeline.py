"""The pipeline's stages against plain Python, each on its own input."""
import corpus_pipeline
from conftest import SF_MID
from llm_helpers import CLASHING, edge_rows, near_components, repeats_removed, sha, words
from test_dedup_ops import lines_kept
from test_tokens import check_packing

from volcast.llm.common import table, written


def test_stages_over_the_table(spark):
    docs = table(spark, SF_MID, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = written(spark, stage(spark, docs, SF_MID), name)
        after = docs.collect()
        seen[name] = len(after)
        if name != "packing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in table(spark, SF_MID, "labels").collect()}
            stay = {r.doc_id for r in after}
            judged = [(labels[i] == 1) == (i in stay) for i, _ in before if i in labels]
            assert sum(judged) / len(judged) > 0.98
        elif name == "line_dedup":
            assert sorted((r.doc_id, r.text) for r in after) == sorted((i, t) for i, _, _, t in lines_kept(before))
        elif name == "minhash_near_dedup":
            want = {i for (i, _), (n, c) in zip(before, near_components(before, corpus_pipeline.NEAR_PERCENT)) if not n or c == i}
            assert {r.doc_id for r in after} == want and len(after) == len(want)
        elif name == "substring_dedup":
            want = repeats_removed(before)
            for r in after:
                key = (r.doc_id, dict(before)[r.doc_id])
                assert sha(" ".join(words(r.text))) == want[key][2]
                assert want[key][1] or r.text == key[1]
        else:
            check_packing(after, before)
    assert seen["quality_classifier"] > seen["minhash_near_dedup"] > 0
    assert corpus_pipeline.run(spark, SF_MID).count() == seen["packing"]


def test_stages_over_edge_rows_and_empty_tables(spark):
    rows = [(i, t, 1, "k", "r", 2, b"c", [1], "l") for i, t in edge_rows()]
    for given in (rows, []):
        docs = spark.createDataFrame(given, CLASHING)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written(spark, stage(spark, docs, SF_MID), name)
            if name != "packing":
                assert docs.columns == columns
        assert (docs.count() > 0) == bool(given)
