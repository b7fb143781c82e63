"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel  # noqa: F401  (re-exported for operators that persist)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.session import fresh_scratch, ship_package

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``; ``bytes.split()`` splits on exactly these.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by a path that only Spark needs to be able to open."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Only the two columns an operator works on, so other columns of any name cannot clash; with ``carry`` the
    whole row's other columns too, in one struct ``rest``."""
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *([F.struct(F.lit(True).alias("row"), *[F.col(f"`{c}`").alias(f"c_{c}") for c in docs.columns
                                                              if c not in (id_col, text_col)]).alias("rest")] if carry else []))
    return out


def with_rest(out: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of the rows that ``id_text(carry=True)`` packed, with the new text; ``n_chars`` is the new length."""
    made = {id_col: F.col("doc_id"), text_col: F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(made[c] if c in made else F.col(f"rest.`c_{c}`")).alias(c) for c in columns])


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_scratch(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
             text_column: int = 1, most_bytes: int = 500_000) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` slices with about ``most_bytes`` of text, so that work buffers stay small."""

    def run(batches):
        for batch in batches:
            for part in bounded_slices(batch, text_column, most_bytes):
                yield from fn(part)

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds) over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd base of the polynomial word hash, and its inverse modulo 2**64 (derived).
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling and kept per worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            while len(have) < size:
                have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        _POWERS[base] = have
    return have[:n]


class Words:
    """The words of a few texts: 64-bit content hash, first and last byte of each, and each text's range of words.

    A word's hash is the polynomial of its bytes, taken from prefix sums over all bytes, then
    mixed; it depends on the word only, so it is the same in every task."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.base = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1]
        inside = np.zeros(len(buf) + 1, dtype=np.int8)
        inside[:-1] = ~_IS_SPACE[buf]
        step = np.diff(inside, prepend=np.int8(0))
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(buf) + 1, dtype=np.uint64)
            np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(buf)), out=sums[1:])
            self.hash = mix64((sums[self.end] - sums[self.start]) * powers(INVERSE, len(buf))[self.start])
        self.first = np.searchsorted(self.start, self.base)            # of each text, in words
        self.last = np.append(self.first[1:], len(self.start))

    def of(self, i: int) -> np.ndarray:
        """Word hashes of text ``i``."""
        return self.hash[self.first[i]:self.last[i]]


def bounded_slices(batch: pa.RecordBatch, text_column: int, most_bytes: int = 500_000, most_rows: int = 2048):
    """Slices of a batch of which each holds few bytes of text (one text at least)."""
    column = batch.column(text_column)
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and (held + n > most_bytes or i - at >= most_rows):
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)


def window_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive entries (by position of its first); content only, any ``size``."""
    if len(h) < size:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        # power[k] covers 2**k entries; the binary digits of ``size`` are chained from left to right.
        power, out, at, width = h, None, 0, 1
        rest = size
        n = len(h) - size + 1
        while rest:
            if rest & 1:
                part = power[at:at + n]
                out = mix64(part + np.uint64(width)) if out is None else mix64(out * np.uint64(0x9E3779B97F4A7C15) + part)
                at += width
            rest >>= 1
            if rest:
                power = mix64(power[:-width] * np.uint64(0xD6E8FEB86659FD93) + power[width:])
                width *= 2
    return out
