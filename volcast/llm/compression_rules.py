"""Quality rules: base statistics, and compression bands by zstandard.

The ratio raw / compressed bytes of a whole text, and of its fixed chunks, is high for repetitive
text and near 1 for text that does not compress.  What is normal depends on the length, so each
band holds for texts up to a length.  A text is rejected if its own ratio is outside its band, or
if more than ``chunk_share`` of its chunks are outside theirs (junk inside a long text).

Every text is judged by itself: no shuffle, nothing kept but one small batch of rows.

Defined cases: a null text has no words and fails the base rules; an empty text too; repeated
rows give repeated result rows; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from volcast.llm.common import SPACE_BYTES, Words, id_text, map_rows, text_bytes, window_hash

SYMBOLS = b"#*$%&|<>"
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, doc_ratio double, n_chunks long, n_odd_chunks long")


@dataclass(frozen=True)
class Bands:
    """(text bytes below, least ratio, largest ratio), in order of length; the last one is open."""

    whole: tuple[tuple[float, float, float], ...] = (
        (128, 0.0, 3.0), (512, 1.05, 3.0), (2048, 1.15, 3.5), (8192, 1.25, 4.0), (65536, 1.3, 4.5),
        (float("inf"), 1.35, 6.0))
    chunk: tuple[tuple[float, float, float], ...] = ((2048, 1.15, 3.5), (float("inf"), 1.25, 4.0))
    chunk_bytes: int = 4096
    least_chunk: int = 1024        # a shorter last chunk is not judged by itself
    chunk_share: float = 0.2
    level: int = 3

    @staticmethod
    def inside(bands, size: int, ratio: float) -> bool:
        for below, least, most in bands:
            if size < below:
                return least <= ratio <= most
        return True


def repeat_words(raw: bytes, hashes: np.ndarray, size: int) -> int:
    """Words covered by a ``size``-word window that occurs twice or more in the text (``hashes``: of its words)."""
    h = window_hash(hashes, size)
    if len(h) < 2:
        return 0
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    # equal hashes are held against the words themselves
    words = raw.split()
    seen = Counter(tuple(words[i:i + size]) for i in at.tolist())
    if len(seen) * 2 > len(at) or any(n < 2 for n in seen.values()):
        at = np.array([i for i in at.tolist() if seen[tuple(words[i:i + size])] > 1], dtype=np.int64)
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_statistics(raw: bytes, n_chars: int, hashes: np.ndarray, window: int) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    spaces = len(raw) - len(raw.translate(None, SPACE_BYTES))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACE_BYTES)]
    return (len(hashes), n_chars - spaces, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(raw, hashes, window))


def quality_rules(docs: DataFrame, bands: Bands = Bands(), min_words: int = 20, max_repeat_percent: int = 30,
                  window: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and verdict of every text (columns of ``SCHEMA``)."""
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]

    def run(batch: pa.RecordBatch):
        import zstandard

        compress = zstandard.ZstdCompressor(level=bands.level).compress
        out: list[list] = [[] for _ in names[1:]]
        texts = text_bytes(batch.column(1))
        chars = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
        words = Words(texts)
        for i, raw in enumerate(texts):
            stats = base_statistics(raw, chars[i], words.of(i), window)
            n_words, repeated = stats[0], stats[4]
            failed = n_words < min_words or 100 * repeated > max_repeat_percent * n_words
            ratio = len(raw) / len(compress(raw)) if raw else 0.0
            size = bands.chunk_bytes
            chunks = [raw[i:i + size] for i in range(0, len(raw), size)] if len(raw) > size else []
            chunks = [c for c in chunks if len(c) >= bands.least_chunk]
            odd = sum(not bands.inside(bands.chunk, len(c), len(c) / len(compress(c))) for c in chunks)
            fits = bands.inside(bands.whole, len(raw), ratio) and odd <= bands.chunk_share * len(chunks)
            for col, v in zip(out, (*stats, failed, not failed and fits, ratio, len(chunks), odd)):
                col.append(v)
        types = [pa.bool_() if n in ("base_failed", "kept") else pa.float64() if n == "doc_ratio" else pa.int64()
                 for n in names[1:]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names)

    return map_rows(id_text(docs, id_col, text_col), run, SCHEMA)
