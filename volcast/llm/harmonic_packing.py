"""Packing of tokenised documents into fixed-length sequences, by harmonic classes.

Class ``k`` holds pieces of exactly ``capacity // k`` tokens, and each of its bins takes exactly
``k`` of them; a bin's fill needs no search and no knowledge of other bins, so every scan split
packs by itself and nothing is shuffled.  A document is cut from its front into whole sequences
(class 1), then into the largest class size that still fits, down to class ``classes``; the short
rest goes to the split's stream, which is filled without gaps and cut at sequence ends.  A full
bin of class ``k`` leaves ``capacity % k`` tokens of padding (at most ``classes - 1``).

At the end of a split the pieces of unfilled bins join the stream, and what is left of the stream
(less than one sequence) is cut into sequences of power-of-two lengths, which need no padding.

Held at a time: the pieces of one open bin per class and of one stream sequence.  A lost executor
repeats its splits; a split's sequences never depend on another split.

Defined cases: a null or empty text has one token, the end mark; repeated rows are packed as
often as they occur; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from volcast.llm.bpe_trie import SPLIT_PATTERN, WS, TrieEncoder, byte_chars
from volcast.llm.common import id_text

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Longer texts go to the tokeniser in parts, cut where white space begins.
PART_CHARS = 100_000


class FastEncoder:
    """Token ids (little-endian uint32 bytes) by ``tiktoken`` over the vocabulary of a byte-level BPE file."""

    def __init__(self, tokenizer_json: str):
        import tiktoken

        spec = json.loads(tokenizer_json)
        chars, vocab = byte_chars(), spec["model"]["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("token ids must follow the order of merges")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bpe = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, special_tokens=self.special,
                                     mergeable_ranks={bytes(chars[c] for c in t): i for t, i in vocab.items()
                                                      if t not in self.special})
        self.units = re.compile(f"[{WS}]*[^{WS}]+|[{WS}]+").findall
        self.json = tokenizer_json
        self.trie: TrieEncoder | None = None

    def parts(self, text: str) -> Iterator[str]:
        held, size = [], 0
        for unit in self.units(text):
            if size + len(unit) > PART_CHARS and held:
                yield "".join(held)
                held, size = [], 0
            held.append(unit)
            size += len(unit)
        if held:
            yield "".join(held)

    def encode(self, text: str) -> bytes:
        if len(text) <= PART_CHARS:
            return self.bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        out = []
        for part in self.parts(text):
            if len(part) <= PART_CHARS:
                out.append(self.encode(part))
            else:   # one run without (or of) white space: the trie's cost is linear in its length
                self.trie = self.trie or TrieEncoder(self.json)
                out.append(b"".join(i.to_bytes(4, "little") for i in self.trie.encode(part)))
                self.trie.forget()
        return b"".join(out)


class Packer:
    """Sequences of one split.  ``add`` and ``close`` return finished pieces
    (doc_id, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, classes: int, first: int):
        if capacity < classes or classes < 1:
            raise ValueError("capacity must be at least the number of classes")
        self.capacity, self.sizes, self.next = capacity, [capacity // k for k in range(1, classes + 1)], first
        self.bins: list[list] = [[] for _ in self.sizes]
        self.stream: list = []
        self.filled = 0

    def emit(self, pieces: list, out: list) -> None:
        """Close a sequence of (doc_id, start, ids, doc_tokens) pieces."""
        at = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) >> 2
            out.append((doc_id, start, n, zlib.crc32(ids), total, self.next, at))
            at += n
        self.next += 1

    def add(self, doc_id, ids: bytes, out: list) -> None:
        total = len(ids) >> 2
        start = 0
        for k, size in enumerate(self.sizes, 1):
            while total - start >= size:
                piece = (doc_id, start, ids[4 * start:4 * (start + size)], total)
                start += size
                if k == 1:
                    self.emit([piece], out)
                    continue
                box = self.bins[k - 1]
                box.append(piece)
                if len(box) == k:
                    self.emit(box, out)
                    self.bins[k - 1] = []
        if start < total:
            self.pour(doc_id, start, ids[4 * start:], total, out)

    def pour(self, doc_id, start: int, ids: bytes, total: int, out: list) -> None:
        while ids:
            room = 4 * (self.capacity - self.filled)
            head, ids = ids[:room], ids[room:]
            self.stream.append((doc_id, start, head, total))
            start += len(head) >> 2
            self.filled += len(head) >> 2
            if self.filled == self.capacity:
                self.emit(self.stream, out)
                self.stream, self.filled = [], 0

    def close(self, out: list) -> None:
        for k, box in enumerate(self.bins):
            self.bins[k] = []
            for doc_id, start, ids, total in box:
                self.pour(doc_id, start, ids, total, out)
        rest, left = self.stream[::-1], self.filled
        self.stream, self.filled = [], 0
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            box = []
            while size:
                doc_id, start, ids, total = rest.pop()
                n = min(size, len(ids) >> 2)
                box.append((doc_id, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    rest.append((doc_id, start + n, ids[4 * n:], total))
                size -= n
            self.emit(box, out)


_FAST: dict[int, FastEncoder] = {}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, classes: int = 16, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``sequence_id`` has the split's number in its high 31 bits and counts within the split below."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    key = hash(tokenizer_path)
    mark = end_id.to_bytes(4, "little")

    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * 7
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    def run(batches):
        enc = _FAST.get(key)
        if enc is None:
            enc = _FAST[key] = FastEncoder(spec.value)
        packer = Packer(capacity, classes, TaskContext.get().partitionId() << 32)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, out = whole.slice(at, 256), []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    packer.add(doc_id, enc.encode(text or "") + mark, out)
                yield batch_of(out)
        out = []
        packer.close(out)
        yield batch_of(out)

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
