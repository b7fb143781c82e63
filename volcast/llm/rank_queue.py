"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

A pre-token starts as a linked list of its bytes.  Two neighbours whose bytes together are a token
may be merged; the lowest rank goes first, of equal ranks the leftmost.  The queue holds one bucket
of list positions for every merge rank.  Which buckets hold something is kept in a bitmap of two
levels: a bit per rank in words of ``WORD`` bits, and a bit per word in the top.  The next rank is
found by find-first-set on the top, then on the word.  A merge changes the pairs of its position and
of the one before; their old entries stay in their buckets and are skipped as stale when taken out.
So a pre-token costs a bounded number of queue steps per byte, however long it is.  The new
pre-tokens of a batch are one list with separators that are in no merge; merges of different
pre-tokens do not touch, so they share the queue, and one bucket serves them all.

A pre-token that is a token as a whole is that token.  Texts are cut into white-space units
(``\\s*\\S+``) first: the usual split pattern never crosses the place between a non-space character
and white space (with another pattern a text is one unit).  Units are remembered per Python worker
in two generations of bounded size.  No shuffle: every scan split is encoded alone.

Defined cases: a null text is empty (0 tokens); a text of any length is taken whole; repeated rows
give repeated result rows; a null id stays null; an empty table gives an empty table; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from volcast.llm.common import id_text, map_rows

#: White space as the split pattern's ``\s`` has it (Unicode White_Space).
SPACES = "\t-\r \x85\xa0  -     　"
#: The usual split pattern of byte-level BPE (fixed value); only its texts are cut into units.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHIFT = 8
WORD = 1 << SHIFT
MASK = WORD - 1
#: A byte that UTF-8 does not have.
SEPARATOR = b"\xff"
#: Longer lists than this are packed arrays; texts with longer units are not remembered.
LONG = 1 << 20


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a ``tiktoken`` file (lines of base64 bytes and rank)."""
    ranks: dict[bytes, int] = {}
    for line in lines.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


@contextmanager
def collector_paused():
    """Nothing here makes reference cycles, so the cycle collector would only walk over what is remembered."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


class QueueEncoder:
    """Encoder and decoder for token ranks; ``pattern`` cuts texts into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 750_000):
        import re

        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        if any(SEPARATOR in token for token in ranks if len(token) > 1):
            raise ValueError("a token holds a byte that UTF-8 does not have")
        self.ranks = ranks
        self.one_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.two_bytes = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], dtype=np.int32)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.words_of_bits = [0] * ((max(ranks.values()) >> SHIFT) + 1)    # lower level; all zero between pre-tokens
        self.bit = [1 << i for i in range(max(WORD, len(self.words_of_bits)))]
        self.usual = pattern == SPLIT_PATTERN
        self.units_of = (re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+").findall if self.usual
                         else lambda text: [text] if text else [])
        self.split = regex.compile(pattern).findall
        self.remember = remember
        self.numbers = {rank: str(rank) for rank in self.bytes_of}
        # unit or pre-token -> ids as text, number of ids, decoded bytes; the newer and the older half of what is remembered
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of every pre-token.  All of them are one linked list with a separator between them, which is in no
        merge, so they share one queue and a bucket serves all pre-tokens at once."""
        joined = SEPARATOR.join([b"", *words, b""])
        raw = np.frombuffer(joined, dtype=np.uint8)
        n = len(raw)
        first = self.two_bytes[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        edge = np.flatnonzero(np.diff(first[at], prepend=-1)) if len(at) else at
        starts, places = [*edge.tolist(), len(at)], at.tolist()
        buckets = {r: places[x:y] for r, x, y in zip(first[at[edge]].tolist(), starts, starts[1:])}
        bits, bit, top, rank_of = self.words_of_bits, self.bit, 0, self.ranks.get
        for rank in buckets:
            bits[rank >> SHIFT] |= bit[rank & MASK]
            top |= bit[rank >> SHIFT]
        pair, token = [*first.tolist(), -1], self.one_byte[raw].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        if n > LONG:
            pair, token, after, before = (array("i", x) for x in (pair, token, after, before))
        while top:
            at = (top & -top).bit_length() - 1          # find first set: word, then bit
            held = bits[at]
            rank = at << SHIFT | (held & -held).bit_length() - 1
            bits[at] = held = held & held - 1
            if not held:
                top &= top - 1
            bucket = buckets.pop(rank)
            bucket.sort()                               # of equal ranks the leftmost goes first
            lowest = rank
            for done, i in enumerate(bucket, 1):
                if pair[i] != rank:
                    continue                            # stale: the pair has changed since
                j = after[i]
                k = after[i] = after[j]
                before[k], pair[j], token[i], h = i, -1, rank, before[i]
                made = pair[i] = rank_of(joined[i:after[k]], -1)
                if made >= 0:
                    if made in buckets:
                        buckets[made].append(i)
                    else:
                        buckets[made] = [i]
                        bits[made >> SHIFT] |= bit[made & MASK]
                        top |= bit[made >> SHIFT]
                        if made < lowest:
                            lowest = made
                made = pair[h] = rank_of(joined[h:k], -1)
                if made >= 0:
                    if made in buckets:
                        buckets[made].append(h)
                    else:
                        buckets[made] = [h]
                        bits[made >> SHIFT] |= bit[made & MASK]
                        top |= bit[made >> SHIFT]
                        if made < lowest:
                            lowest = made
                if lowest < rank:                       # a lower rank has come up: it goes before the rest
                    if done < len(bucket):
                        buckets[rank] = bucket[done:]
                        bits[rank >> SHIFT] |= bit[rank & MASK]
                        top |= bit[rank >> SHIFT]
                    break
        out, ids, i = [], [], 1
        while i < n:
            if joined[i] == SEPARATOR[0]:
                out.append(ids)
                ids = []
            else:
                ids.append(token[i])
            i = after[i]
        return out

    def words_in(self, unit: str) -> list[str]:
        """Pre-tokens of a unit; a space and letters are one of the usual pattern."""
        if self.usual and (unit[1:] if unit[0] == " " else unit).isalpha():
            return [unit]
        return self.split(unit)

    def learn(self, units: list[str]) -> None:
        """Encode units into ``known``; those of the generation before are taken over."""
        known, older, numbers, raw, ranks = self.known, self.older, self.numbers, self.bytes_of, self.ranks
        cut = {u: (u,) if u in older else self.words_in(u) for u in units if u not in known}
        new = []
        for word in {w for ws in cut.values() for w in ws if w not in known}:
            if word in older:
                known[word] = older[word]
            elif (whole := ranks.get(word.encode())) is not None:
                known[word] = (numbers[whole], 1, word.encode())
            else:
                new.append(word)
        for word, ids in zip(new, self.merge_all([w.encode() for w in new])):
            known[word] = (",".join([numbers[i] for i in ids]), len(ids), b"".join([raw[i] for i in ids]))
        for unit, ws in cut.items():
            if len(ws) > 1:
                hits = [known[w] for w in ws]
                known[unit] = (",".join([h[0] for h in hits]), sum([h[1] for h in hits]), b"".join([h[2] for h in hits]))

    def found(self, texts: list[str]) -> list[list[tuple[str, int, bytes]]]:
        """Per text the (ids as text, number of ids, decoded bytes) of its units."""
        with collector_paused():
            units, known = [self.units_of(t) for t in texts], self.known
        new = {u for us in units for u in us if u not in known}
        if len(known) + len(new) > self.remember:
            self.older, self.known = known, {}
            known, new = self.known, {u for us in units for u in us}
        with collector_paused():
            self.learn(new)
        hits = [[known[u] for u in us] for us in units]
        if max(map(len, new), default=0) > LONG:
            self.older = self.known = {}                # do not hold long texts
        return hits

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, n, _ in self.found([text])[0] if n for i in ids.split(",")]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple, QueueEncoder] = {}


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and, with ``keep_ids``, ids and decoded bytes) of every text.

    ``ranks_path`` is read on the driver; the file (a vocabulary, so of bounded size) is broadcast."""
    with open(ranks_path, "rb") as f:
        raw = f.read()
    key = (hashlib.sha256(raw).hexdigest(), pattern)
    lines = docs.sparkSession.sparkContext.broadcast(raw)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded binary"

    def run(batch: pa.RecordBatch):
        enc = _ENCODERS.get(key)
        if enc is None:
            enc = _ENCODERS[key] = QueueEncoder(read_ranks(lines.value), pattern)
        out: list[list] = [[] for _ in range(5)]
        for hits in enc.found([t or "" for t in batch.column(1).to_pylist()]):
            ids, decoded = ",".join([h[0] for h in hits]), b"".join([h[2] for h in hits])
            out[0].append(sum([h[1] for h in hits]))
            out[1].append(hashlib.sha256(ids.encode()).hexdigest())
            out[2].append(hashlib.sha256(decoded).hexdigest())
            if keep_ids:
                out[3].append([int(i) for i in ids.split(",")] if ids else [])
                out[4].append(decoded)
        cols = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            cols += [pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.binary())]
            names += ["ids", "decoded"]
        yield pa.RecordBatch.from_arrays(cols, names)

    # slices whose lists stay near the processor's caches
    return map_rows(id_text(docs, id_col, text_col), run, schema)
