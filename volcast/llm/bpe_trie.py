"""BPE encoding and decoding by prefix-sharing trie traversal.

A byte-level BPE encoding has two properties that this operator uses.  (1) A token sequence is
the encoding of its bytes exactly if every token encodes to itself and every two neighbours,
encoded together, stay those two tokens.  (2) So the encoding of a prefix is fixed by its last
token: the encoding of ``w[:i]`` is that of ``w[:i - len(t)]`` followed by ``t``, and exactly one
token ``t`` that ends at ``i`` is compatible with the last token at ``i - len(t)``.

The distinct words of a batch form a trie.  Its depth-first order is the sorted order of the
words, and the branch node of a word is its longest common prefix with the word before; so the
trie is walked as the sorted list with a stack of last-token states, one per depth, and the
states of a shared prefix are computed once.  Reading the states back from a word's end gives
its tokens.  The cost is linear in new trie nodes, also for a word of 100,000 characters.

Words come from white-space units (``\\s*\\S+``): the tokeniser's split pattern never crosses the
place between a non-space character and white space, so a unit can be split by itself.  Units and
words are remembered per Python worker in two generations of bounded size, so a common one is not
learnt again when the bound is reached.  No shuffle: each scan split is encoded alone.

Defined cases: a null text is empty (0 tokens); repeated rows give repeated result rows; a null
id stays null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from volcast.llm.common import id_text, map_rows

#: White space as the split pattern's ``\s`` has it (Unicode White_Space); Python's own differs (\x1c-\x1f).
WS = "\t-\r \x85\xa0  -     　"
#: The split pattern of byte-level BPE with ``use_regex`` (fixed value).
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 60
ROOT = 1 << 19     # stands for "no token yet"; above all ids
MOST_PAIRS = 1_200_000
TAIL = 4           # token ends of up to this many bytes are looked up at once


def byte_chars() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the others follow 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in set(printable))
    chars.update({chr(256 + i): b for i, b in enumerate(others)})
    return chars


class TrieEncoder:
    """Encoder and decoder of one ``tokenizers`` byte-level BPE file (given as its JSON text)."""

    def __init__(self, tokenizer_json: str, remember: int = 750_000):
        import re

        import regex

        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        chars = byte_chars()
        self.bytes_of = {i: bytes(chars[c] for c in t) for t, i in model["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.merge: dict[int, int] = {}        # left << 20 | right -> rank
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> (left, right, rank)
        vocab = model["vocab"]
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault(left << 20 | right, rank)
            self.parts.setdefault(made, (left, right, rank))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.unit = re.compile(f"[{WS}]*[^{WS}]+|[{WS}]+").findall
        self.split = regex.compile(SPLIT_PATTERN).findall
        self.max_len = max(map(len, self.id_of))
        self.remember = remember
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.endings: dict[bytes, list[tuple[int, int]]] = {}
        self.numbers = {i: str(i) for i in self.bytes_of}
        # unit or word -> ids as text, number of ids, decoded bytes; the newer and the older half of what is remembered
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}

    # -- which tokens may stand alone, or next to each other

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(symbol, rank of the merge that made it) from the single byte at one edge of ``token`` up to ``token``."""
        out = []
        while token in self.parts:
            out.append((token, self.parts[token][2]))
            token = self.parts[token][side]
        out.append((token, -1))
        return out[::-1]

    def first_crossing(self, a: int, b: int) -> tuple[int, int] | None:
        """The first merge across the border of ``a`` and ``b`` when their bytes are merged together; None: none."""
        left, right = self.spine(a, 1), self.spine(b, 0)
        i = j = 0
        while True:
            rank = self.merge.get(left[i][0] << 20 | right[j][0], NEVER)
            up_left = left[i + 1][1] if i + 1 < len(left) else NEVER
            up_right = right[j + 1][1] if j + 1 < len(right) else NEVER
            if rank < up_left and rank <= up_right:     # of equal merges the leftmost goes first
                return left[i][0], right[j][0]
            if up_left == NEVER and up_right == NEVER:
                return None
            if up_left <= up_right:
                i += 1
            else:
                j += 1

    def token_ok(self, token: int) -> bool:
        """Whether the bytes of ``token`` encode to ``token``."""
        ok = self.alone.get(token)
        if ok is None:
            if token in self.parts:
                a, b, _ = self.parts[token]
                ok = self.token_ok(a) and self.token_ok(b) and self.first_crossing(a, b) == (a, b)
            else:
                ok = len(self.bytes_of[token]) == 1
            self.alone[token] = ok
        return ok

    def pair_ok(self, a: int, b: int) -> bool:
        """Whether ``b`` may follow ``a`` (``ROOT``: begin a word)."""
        ok = self.token_ok(b) and (a == ROOT or self.first_crossing(a, b) is None)
        if len(self.pairs) >= min(4 * self.remember, MOST_PAIRS):
            self.pairs.clear()
        self.pairs[a << 20 | b] = ok
        return ok

    def ending_in(self, tail: bytes) -> list[tuple[int, int]]:
        """(size, token) of the tokens that are suffixes of ``tail`` (at most ``TAIL`` bytes), shortest first."""
        found = [(k, self.id_of[tail[-k:]]) for k in range(1, len(tail) + 1) if tail[-k:] in self.id_of]
        self.endings[tail] = found
        return found

    # -- the traversal

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Encodings of distinct words, by a depth-first walk of their trie (see the module's text)."""
        known, endings = self.pairs.get, self.endings.get
        depth = max(map(len, words), default=0)
        last, begin = [ROOT] * (depth + 1), [0] * (depth + 1)   # by depth: last token of the prefix, where it begins
        before = b""
        for word in sorted(words):
            n = len(word)
            shared, most = 0, min(len(before), n)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            for end in range(shared + 1, n + 1):
                tail = word[end - TAIL if end > TAIL else 0:end]
                tokens = endings(tail)
                if tokens is None:
                    tokens = self.ending_in(tail)
                for size, token in tokens:
                    start = end - size
                    prior = last[start]
                    ok = known(prior << 20 | token)
                    if ok is None:
                        ok = self.pair_ok(prior, token)
                    if ok:
                        break
                else:
                    start, token = self.longer(word, end, last)
                last[end] = token
                begin[end] = start
            ids, at = [], n
            while at:
                ids.append(last[at])
                at = begin[at]
            ids.reverse()
            before = word
            yield word, ids

    def longer(self, word: bytes, end: int, last: list[int]) -> tuple[int, int]:
        """The last token of ``word[:end]`` if it has more than ``TAIL`` bytes."""
        for start in range(end - TAIL - 1, max(-1, end - 1 - self.max_len), -1):
            token = self.id_of.get(word[start:end])
            if token is not None:
                ok = self.pairs.get(last[start] << 20 | token)
                if self.pair_ok(last[start], token) if ok is None else ok:
                    return start, token
        raise ValueError("no token ends here: the vocabulary lacks a byte")

    # -- texts

    def pieces(self, text: str) -> list[str]:
        """White-space units; a special token's text is a piece of its own."""
        if self.special_cut is None or not any(s in text for s in self.special):
            return self.unit(text)
        out: list[str] = []
        for part in self.special_cut.split(text):
            out.extend([part] if part in self.special else self.unit(part))
        return out

    def words_of(self, unit: str) -> tuple[str, ...]:
        """The split pattern on one unit; a space, letters and one ASCII mark need no pattern."""
        if unit[0] == " " and len(unit) > 2:
            if unit[1:].isalpha():
                return (unit,)
            if unit[-1] in ".,;:!?)|" and unit[1:-1].isalpha():
                return unit[:-1], unit[-1]
        return (unit,) if unit in self.special else tuple(self.split(unit))

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces into ``known``; those of the generation before are taken over."""
        known, older, numbers, raw = self.known, self.older, self.numbers, self.bytes_of
        for text, i in self.special.items():
            known[text] = (numbers[i], 1, text.encode())
        split = {u: (u,) if u in older else self.words_of(u) for u in pieces if u not in known}
        new = []
        for word in {w for ws in split.values() for w in ws if w not in known}:
            if word in older:
                known[word] = older[word]
            else:
                new.append(word.encode())
        for word, ids in self.encode_words(new):
            known[word.decode()] = (",".join([numbers[i] for i in ids]), len(ids), b"".join([raw[i] for i in ids]))
        for u, ws in split.items():
            if len(ws) > 1:
                found = [known[w] for w in ws]
                known[u] = (",".join([f[0] for f in found]), sum([f[1] for f in found]), b"".join([f[2] for f in found]))

    def found(self, texts: list[str]) -> list[list[tuple[str, int, bytes]]]:
        """Per text the (ids as text, number of ids, decoded bytes) of its pieces."""
        pieces, known = [self.pieces(t) for t in texts], self.known
        new = {p for ps in pieces for p in ps if p not in known}
        if len(known) + len(new) > self.remember:
            self.older, self.known = known, {}
            known, new = self.known, {p for ps in pieces for p in ps}
        self.learn(new)
        return [[known[p] for p in ps] for ps in pieces]

    def forget(self) -> None:
        self.older, self.known = {}, {}

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, n, _ in self.found([text])[0] if n for i in ids.split(",")]

    def decode(self, ids) -> bytes:
        """Bytes of a token sequence (special tokens as their text)."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[int, TrieEncoder] = {}


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and, with ``keep_ids``, ids and decoded) of every text.

    ``tokenizer_path`` is read on the driver; its JSON (a vocabulary, so of bounded size) is broadcast."""
    sc = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = sc.broadcast(f.read())
    key = hash(tokenizer_path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"

    def run(batch: pa.RecordBatch):
        enc = _ENCODERS.get(key)
        if enc is None:
            enc = _ENCODERS[key] = TrieEncoder(spec.value)
        out: list[list] = [[] for _ in range(5)]
        for found in enc.found([t or "" for t in batch.column(1).to_pylist()]):
            ids = ",".join([f[0] for f in found])
            raw = b"".join([f[2] for f in found])
            out[0].append(sum([f[1] for f in found]))
            out[1].append(hashlib.sha256(ids.encode()).hexdigest())
            # the library decodes bytes that are no UTF-8 to U+FFFD; whole texts always are UTF-8
            decoded = raw.decode("utf-8", "replace")
            out[2].append(hashlib.sha256(decoded.encode()).hexdigest())
            if keep_ids:
                out[3].append([int(x) for x in ids.split(",")] if ids else [])
                out[4].append(decoded)
        cols = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            cols += [pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.string())]
            names += ["ids", "decoded"]
        yield pa.RecordBatch.from_arrays(cols, names)

    # larger slices share more prefixes in one walk
    return map_rows(id_text(docs, id_col, text_col), run, schema, most_bytes=2_000_000)
