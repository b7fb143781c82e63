"""Operators 1 and 10 against the tokenizers library, exact round trips, and packing invariants."""
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import PATH, edge_rows, frame, sha
from tokenizers import Tokenizer

from volcast.llm.bpe_trie import TrieEncoder, encode_decode
from volcast.llm.harmonic_packing import FastEncoder, Packer, pack

LIB = Tokenizer.from_file(PATH)
TRIE = TrieEncoder(open(PATH, encoding="utf-8").read())
FAST = FastEncoder(open(PATH, encoding="utf-8").read())
MIXED = st.text(alphabet="abcTHE  \n\t'st.,!019éß日​\x85\xa0\x1c　🙂<|endoftext|>", max_size=60)


def library_ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(MIXED | st.text(max_size=30))
def test_trie_and_fast_encoders_equal_the_library(text):
    want = library_ids(text)
    assert TRIE.encode(text) == want
    raw = FAST.encode(text)
    assert [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)] == want
    assert TRIE.decode(want).decode("utf-8", "replace") == LIB.decode(want, skip_special_tokens=False)


def test_forgetting_does_not_change_ids():
    small = TrieEncoder(open(PATH, encoding="utf-8").read(), remember=5)
    for text in ("the quick brown fox jumps over the lazy dog again and again", "Zyx wvu tsr qpo"):
        assert small.encode(text) == library_ids(text)


def test_common_words_are_learnt_once_when_the_bound_is_reached():
    """Texts of a few common and many rare words, far beyond what is remembered at a time."""
    small, learnt = TrieEncoder(open(PATH, encoding="utf-8").read(), remember=60), []
    walk = small.encode_words
    small.encode_words = lambda words: walk(learnt.extend(words) or words)
    for i in range(40):
        text = " alpha beta, gamma 'tis \t delta  " + " ".join(f"rare{chr(97 + k)}{chr(97 + i % 26)}q{i}" for k in range(9))
        assert small.encode(text) == library_ids(text)
        assert len(small.known) <= 100 and len(small.older) <= 100
    assert learnt.count(b" alpha") == 1


def test_operator_1_over_edge_rows(spark):
    rows = edge_rows()
    got = sorted(map(tuple, encode_decode(frame(spark, rows), PATH).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = library_ids(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(LIB.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)
    one = encode_decode(frame(spark, [(1, "a b")]), PATH, keep_ids=True).first()
    assert one.ids == library_ids("a b") and one.decoded == "a b"
    assert encode_decode(frame(spark, [], 1), PATH).count() == 0


def check_packing(pieces, rows, capacity=2048):
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id, p.doc_tokens].append(p)
        sequences[p.sequence_id].append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= capacity
    total = 0
    for i, t in rows:
        ids = library_ids(t or "") + [1]
        total += len(ids)
        left = sorted(docs[i, len(ids)], key=lambda p: p.start)
        assert left, i
        copies = sum(p.start == 0 for p in left)
        assert sum(p.length for p in left) == copies * len(ids)
        for p in left:
            raw = b"".join(x.to_bytes(4, "little") for x in ids[p.start:p.start + p.length])
            assert zlib.crc32(raw) == p.ids_crc32
    assert sum(p.length for p in pieces) == total
    return sum(capacity - n for n in (sum(p.length for p in s) for s in sequences.values()) if n & (n - 1))


def test_operator_10_over_edge_rows(spark):
    rows = [r for r in edge_rows() if r[0] != 4] + [(4, "one two")]
    padding = check_packing(pack(frame(spark, rows), PATH).collect(), rows)
    assert padding <= 100
    assert pack(frame(spark, [], 1), PATH).count() == 0


@pytest.mark.parametrize("capacity,classes", [(2048, 16), (64, 4), (30, 30), (7, 1)])
def test_packer_keeps_every_id_and_pads_little(capacity, classes):
    rng = random.Random(capacity)
    packer, out, total = Packer(capacity, classes, 0), [], 0
    for doc in range(300):
        n = int(rng.paretovariate(0.8) * 5)
        total += n
        packer.add(doc, rng.randbytes(4 * n), out)
    packer.close(out)
    used = defaultdict(int)
    for _, _, n, _, _, seq, _ in out:
        used[seq] += n
    assert sum(used.values()) == total and max(used.values()) <= capacity
    padded = sum(capacity - n for n in used.values() if n & (n - 1) and n != capacity)
    assert padded <= len(used) * (classes - 1)
