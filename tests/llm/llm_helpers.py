"""Small tables and plain-Python versions of the operators' contracts."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Columns that operators also make: they must not clash.
CLASHING = "doc_id long, text string, n_words long, key string, rest string, at long, cid binary, places array<long>, lines string"


def frame(spark, rows, parts=3):
    """documents-like table of (doc_id, text) with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, 1, "k", "r", 2, b"c", [1], "l") for i, t in rows], CLASHING).repartition(parts)


def edge_rows():
    """Nulls, empty and blank texts, a very long text and word, repeated rows and ids, non-ASCII text."""
    rng = random.Random(5)
    prose = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(rng.randint(0, 999)) for _ in range(400))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, "null id text"), (5, prose),
            (6, prose), (6, prose), (7, prose[:900] + "\n" + prose[:900]), (8, "x" * 30_000), (9, "żółw 日本 🙂  a\x0b\x0cb"),
            (10, "word " * 6000), (4, "same id, other text"), (11, "<|endoftext|> a<|endoftext|>")]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def near_components(rows, percent=85):
    """(n_shingles, component) per row by comparing all pairs of sets."""
    sets = []
    for _, t in rows:
        w = words(lowered(t))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    above = list(range(len(rows)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for z in s for j in holders[z])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                above[root(i)] = root(j)
        for z in s:
            holders[z].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[root(i)] if x is not None]
        out.append((len(sets[i]), min(ids) if ids else None))
    return out


def repeats_removed(rows, span=20):
    """{(doc_id, text): (n_words, n_removed, sha of kept words)} for rows with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - span + 1):
            x = tuple(w[k:k + span])
            if x in seen:
                gone[k:k + span] = [True] * span
            seen.add(x)
        out[i, t] = (len(w), sum(gone), sha(" ".join(a for a, g in zip(w, gone) if not g)))
    return out
