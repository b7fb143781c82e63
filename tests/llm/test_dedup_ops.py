"""Operators 3, 4 and 7 against plain Python over edge rows, copies and the given table."""
import random
from collections import defaultdict

import duckdb
import pytest
import xxhash
from conftest import SF_MID
from llm_helpers import edge_rows, frame, lowered, near_components, repeats_removed, sha, words

from volcast.llm.components import components
from volcast.llm.line_dedup import line_dedup
from volcast.llm.lsh_forest import near_duplicates
from volcast.llm.seed_extend import substring_dedup

BLANK = " \t\n\x0b\x0c\r"


def lines_kept(rows):
    holders = defaultdict(set)
    key = lambda line: lowered(line.strip(BLANK))
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3
                or i == max(holders[key(x)], key=lambda d: (d is not None, d or 0))]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def test_operator_3(spark):
    shared, short = "This line is shared by many ÄÖ", "a short line"
    rows = edge_rows() + [(20, f"{shared}\nown line of the first one\n{short}"), (21, f"  {shared.replace('T', 't')}\t\n{short}\n"),
                          (22, f"{shared.upper().replace('Ä', 'Ä')}\n\n{short}"), (23, f"x\n{shared}\n{shared}"),
                          (None, shared), (20, shared), (24, "\n\n"), (25, shared.replace("Ä", "ä"))]
    got = sorted((tuple(r)[:4] for r in line_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(lines_kept(rows), key=repr)
    assert line_dedup(frame(spark, [], 1)).count() == 0


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randint(0, 10**6)}"
    return " ".join(w)


def copies(seed, groups=8, stars=60):
    """Texts of groups of near copies, one star of copies around one text, exact copies and chains."""
    rng = random.Random(seed)
    rows = []
    new = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    for _ in range(groups):
        base = new(rng.randint(6, 300))
        rows += [edited(rng, base, rng.randint(0, 4)) for _ in range(rng.randint(1, 6))]
    hub = new(150)
    rows += [" ".join(hub)] + [edited(rng, hub, 2) for _ in range(stars)] + [" ".join(hub).upper()] * 3
    link = new(120)
    for _ in range(6):
        rows.append(" ".join(link))
        link[rng.randrange(120)] = "chain"
    rows += ["a b", "a b", "a b c d e", "A B c d e", "a b c d e f g h"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_operator_4_copies(spark, seed):
    rows = copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark, frame(spark, rows)).collect()}
    want = near_components(rows)
    assert got == {i: (n, c, i == c) for (i, _), (n, c) in zip(rows, want)}


def test_operator_4_edge_rows(spark):
    rows = edge_rows()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(spark, frame(spark, rows)).collect()), key=repr)
    want = [(i, n, i if not n else c) for (i, _), (n, c) in zip(rows, near_components(rows))]
    assert got == sorted(want, key=repr)
    assert near_duplicates(spark, frame(spark, [], 1)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (3, 2), (2, 3)]
    rng.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_operator_7_random_passages(spark, seed):
    rng = random.Random(seed)
    letters = "abcdefgh" if seed == 1 else [f"w{i}" for i in range(300)]
    passages = [" ".join(rng.choice(letters) for _ in range(rng.randint(10, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < .5 else " ".join(rng.choice(letters) for _ in range(rng.randint(0, 30))))
            if rng.random() < .2:
                parts.append(" ".join(["z"] * rng.randint(1, 50)))
        rows.append((i, " \n".join(parts)))
    out = substring_dedup(spark, frame(spark, rows), carry=True)
    want = repeats_removed(rows)
    for r in out.collect():
        text = dict(rows)[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id, text]
        assert sha(" ".join(words(r.text))) == r.kept_sha256
        assert r.n_removed or r.text == text


def test_operator_7_edge_rows(spark):
    rows = [r for r in edge_rows() if r[0] != 4] + [(30, "word " * 25), (31, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(spark, frame(spark, rows)).collect()), key=repr)
    want = repeats_removed(rows)
    assert got == sorted(((i, *want[i, t]) for i, t in rows), key=repr)
    assert substring_dedup(spark, frame(spark, [], 1)).count() == 0


def colliding_texts():
    """Two texts of 25 words, and one of 25 and one of 3, whose xxhash64 agree in the low 30 bits and nothing else."""
    low = lambda t: xxhash.xxh64_intdigest(t, 42) & ((1 << 30) - 1)
    long_texts, pair = {}, None
    for i in range(200_000):
        t = " ".join(f"x{i}y{k}" for k in range(25))
        other = long_texts.setdefault(low(t), t)
        if other is not t:
            pair = pair or (other, t)
    for i in range(1_000_000):
        t = f"a{i} b c"
        if low(t) in long_texts:
            return *pair, long_texts[low(t)], t
    raise AssertionError("no collision")


def test_operator_7_rows_of_one_id_whose_text_hashes_agree_in_part(spark):
    a, b, c, short = colliding_texts()
    assert spark.createDataFrame([(a,), (b,)], "t string").selectExpr("xxhash64(t) & 1073741823 h").distinct().count() == 1
    for i in (7, None):
        rows = [(-5, a), (i, a), (i, b), (-6, c), (i, c), (i, short)]
        got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(spark, frame(spark, rows)).collect()}
        want = repeats_removed(rows)
        assert got == {(k[0], *v) for k, v in want.items()}
        assert want[i, b][1] == 0 and want[i, short][1] == 0


def test_operator_7_many_texts_of_a_null_id(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(None, " ".join(f"n{rng.randint(0, 10**9)}" for _ in range(22))) for _ in range(400)]
    rows += rows[:50] + [(3, passage), (4, "x " + passage), (4, "y"), (4, "y")]
    got = substring_dedup(spark, frame(spark, rows), carry=True).collect()
    want = repeats_removed(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed) == ((31, 30) if r.doc_id == 4 and r.n_words == 31 else (r.n_words, 0))
        assert r.n_removed or (r.doc_id, r.text) in want


def test_operators_4_and_7_over_the_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_MID}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark, docs).collect()}
    assert got == {i: x for (i, _), x in zip(rows, near_components(rows))}
    want = {i: v for (i, _), v in repeats_removed(rows).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(spark, docs).collect()} == want
