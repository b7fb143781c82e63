"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every ``span - gram + 1`` consecutive ``gram``-word grams the one
with the smallest hash (the rightmost of equals).  Any two equal windows of ``span`` words choose
the same anchor at the same place, so no repeat of ``span`` words is missed, and a window belongs
to one anchor.  Documents are joined on their anchors.  A match is extended both ways as far as a
window of the anchor can reach (``span - gram`` words on each side):

* occurrences whose whole reach is equal repeat all windows of the anchor, but for the first one;
* the first occurrences of the different reaches of an anchor are extended only in part; their
  windows are compared one by one.

The windows found are maximal repeats once joined: a word is removed if a repeated window covers it.

Skew: occurrences with equal reach are reduced in the task that scans them (one row per task goes
on); anchors that a sample of the documents shows to be hot are dealt by anchor and reach, and
always compared window by window, which changes the work and never the result.  Tasks work in the
order of a sort and hold one row.  Hashes of two families (128 bits together) stand for grams,
reaches and windows.

Defined cases: a null text has no words; texts of fewer than ``span`` words lose nothing; rows that
repeat an id come in the order of their texts' 128-bit hashes, by which they are numbered (equal rows
have one result); a null id comes before all others; texts are taken whole, up to 2**29 words (more
is an error, as are 2**30 texts of one id); other columns are ignored or carried, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from volcast.llm.common import (INVERSE, BASE, Words, bounded_slices, id_text, mix64, powers, text_bytes, window_hash,
                                written)

SPAN, GRAM = 20, 8
#: ``at`` = number of the text among those of its id (30 bits), first window (29 bits), number of windows (4 bits); its
#: order is the documents' order.
TEXT_BITS, PLACE_BITS, COUNT_BITS = 30, 29, 4
#: Texts of one id are numbered in cells by so many bits of their hash.
CELL_BITS = 12
HELD_ROWS = 400_000
SAMPLE, HOT_IN_SAMPLE = 64, 200
NO_ID = -(1 << 63)


def _range_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hash of the words lo..hi (ends excluded), from prefix sums."""
    with np.errstate(over="ignore"):
        return mix64((sums[hi] - sums[lo]) * powers(INVERSE, len(sums))[lo])


class Grams:
    """Anchors of the windows of a few texts."""

    def __init__(self, texts: list[bytes], span: int, gram: int):
        self.words = w = Words(texts)
        n = len(w.hash)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(w.hash * powers(BASE, max(n, 1))[:n], out=self.sums[1:])
        self.gram = window_hash(w.hash, gram)
        size = w.last - w.first
        self.doc = np.repeat(np.arange(len(texts)), size)
        starts = np.arange(n)
        self.starts = starts[starts + span <= w.last[self.doc]] if n else starts
        if not len(self.starts):
            self.anchor = self.starts
            return
        # smallest of the next ``span - gram + 1`` grams, by windows of doubling width
        width, least = 1, np.arange(len(self.gram))
        need = span - gram + 1
        while width < need:
            step = min(width, need - width)
            left, right = least[:-step], least[step:]
            least = np.where(self.gram[right] <= self.gram[left], right, left)
            width += step
        self.anchor = least[self.starts]

    def runs(self):
        """(document, first window, number of windows, anchor) of every run of windows with one anchor."""
        new = np.flatnonzero(np.diff(self.anchor, prepend=-1))
        first = self.starts[new]
        count = np.diff(np.append(new, len(self.anchor)))
        return self.doc[first], first, count, self.anchor[new]


def _place(th: np.ndarray, place: np.ndarray, count: np.ndarray) -> np.ndarray:
    if len(place) and place.max() >= 1 << PLACE_BITS:
        raise ValueError(f"a text has more than {1 << PLACE_BITS} words")
    return (th << (PLACE_BITS + COUNT_BITS)) | (place << COUNT_BITS) | count


def _first_of_equals(g, c, doc, at):
    """Order by (g, c, doc, at) without rows that are the same in all four; whether a row is the first of its (g, c)."""
    order = np.lexsort((at, doc, c, g))
    g, c, doc, at = g[order], c[order], doc[order], at[order]
    first, same = np.ones(len(g), dtype=bool), np.zeros(len(g), dtype=bool)
    first[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    same[1:] = ~first[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
    return order[~same], first[~same]


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as integers; null comes first."""
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


KEYED = "g long, c long, id long, at long, done boolean"


def _keyed_batch(g, c, doc, at, done) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc),
                                       pa.array(at), pa.array(done)], ["g", "c", "id", "at", "done"])


def _reduced(parts: list) -> pa.RecordBatch:
    """Rows of one scan task: of rows with equal keys only the first goes on; the others are repeats (done)."""
    g, c, doc, at = (np.concatenate(x) for x in zip(*parts))
    order, first = _first_of_equals(g, c, doc, at)
    zero = np.uint64(0)
    return _keyed_batch(np.where(first, g[order], zero), np.where(first, c[order], zero), doc[order], at[order], ~first)


def _scan(make):
    """mapInArrow function: ``make(batch)`` gives (g, c, id, at) arrays; equal keys are reduced."""

    def run(batches):
        held, size = [], 0
        for whole in batches:
            for batch in bounded_slices(whole, 1):
                part = make(batch)
                if len(part[0]):
                    held.append(part)
                    size += len(part[0])
                if size >= HELD_ROWS:
                    yield _reduced(held)
                    held, size = [], 0
        if held:
            yield _reduced(held)

    return run


def _anchors(span: int, gram: int):
    reach = span - gram

    def make(batch: pa.RecordBatch):
        k = Grams(text_bytes(batch.column(1)), span, gram)
        doc, first, count, anchor = k.runs() if len(k.starts) else (k.starts,) * 4
        w = k.words
        lo, hi = np.maximum(anchor - reach, w.first[doc]), np.minimum(anchor + gram + reach, w.last[doc])
        with np.errstate(over="ignore"):
            context = mix64(_range_hash(k.sums, lo, hi) + ((anchor - lo) * 64 + (hi - anchor)).astype(np.uint64))
        th = batch.column(2).to_numpy()[doc] if len(doc) else doc
        return k.gram[anchor], context, _ids(batch.column(0))[doc], _place(th, first - w.first[doc], count)

    return make


def _windows(span: int):
    """The single windows of the listed places of a text, keyed by two hashes."""

    def make(batch: pa.RecordBatch):
        w = Words(text_bytes(batch.column(1)))
        n = len(w.hash)
        sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(w.hash * powers(BASE, max(n, 1))[:n], out=sums[1:])
        whole = window_hash(w.hash, span)
        places = batch.column(3)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
        at = places.flatten().to_numpy()
        count = at & ((1 << COUNT_BITS) - 1)
        doc = np.repeat(doc, count)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        place = np.repeat((at >> COUNT_BITS) & ((1 << PLACE_BITS) - 1), count) + step
        word = place + w.first[doc]
        th = batch.column(2).to_numpy()[doc] if len(doc) else doc
        return (whole[word], _range_hash(sums, word, word + span), _ids(batch.column(0))[doc],
                _place(th, place, np.ones_like(place)))

    return make


def _judge(hot: frozenset, by_windows: bool):
    """Over rows in the order of (g, c, id, at): repeats (all = true) and, if ``by_windows``, the first occurrences
    of different reaches of one anchor (all = false).  Holds one row between batches."""
    hot_array = np.array(sorted(hot), dtype=np.int64)

    def out(doc, at, every):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(at), pa.array(every)], ["id", "at", "every"])

    def run(batches):
        last = None                 # the row before
        pending = None              # (id, at) of the first row of the current anchor, until a second reach is seen
        for batch in batches:
            if not batch.num_rows:
                continue
            g, c, doc, at = (batch.column(i).to_numpy() for i in range(4))
            done = batch.column(4).to_numpy(zero_copy_only=False)
            yield out(doc[done], at[done], np.ones(int(done.sum()), dtype=bool))
            g, c, doc, at = (x[~done] for x in (g, c, doc, at))
            if not len(g):
                continue
            same = [np.append(last is not None and x[0] == last[i], x[1:] == x[:-1]) for i, x in enumerate((g, c, doc, at))]
            same_g, repeat = same[0], same[0] & same[1]
            later = repeat & ~(same[2] & same[3])               # an equal row is the same text once more
            yield out(doc[later], at[later], np.ones(int(later.sum()), dtype=bool))
            if by_windows:
                head = np.flatnonzero(~repeat)                  # first rows of the reaches
                more = same_g[head]                             # not the first reach of its anchor
                if len(hot_array):
                    is_hot = np.isin(g[head], hot_array)
                else:
                    is_hot = np.zeros(len(head), dtype=bool)
                follow = np.append(more[1:], False)             # the next reach is of the same anchor
                take = more | follow | is_hot
                if len(head) and more[0] and pending is not None:
                    yield out(np.array([pending[0]]), np.array([pending[1]]), np.array([False]))
                    pending = None
                if len(head):
                    # the last reach may get company in a later batch, unless it has been taken
                    pending = None if take[-1] else (doc[head[-1]], at[head[-1]])
                rows = head[take]
                yield out(doc[rows], at[rows], np.zeros(len(rows), dtype=bool))
            last = (g[-1], c[-1], doc[-1], at[-1])

    return run


def _sorted_judgement(keyed: DataFrame, hot: list[int], by_windows: bool) -> DataFrame:
    deal = F.when(F.col("done"), F.xxhash64("id"))
    if hot:
        deal = deal.when(F.col("g").isin(hot), F.xxhash64("g", "c"))
    if not by_windows:
        deal = deal.otherwise(F.xxhash64("g", "c"))
    else:
        deal = deal.otherwise(F.xxhash64("g"))
    return (keyed.repartition(deal).sortWithinPartitions("g", "c", "id", "at")
            .mapInArrow(_judge(frozenset(hot), by_windows), "id long, at long, every boolean"))


def _by_document(flags: DataFrame) -> DataFrame:
    """(id, th) -> places, one row per document; the text's number is the high part of ``at``."""
    th = F.shiftright("at", PLACE_BITS + COUNT_BITS)
    return flags.groupBy(F.col("id").alias("f_id"), th.alias("f_th")).agg(F.collect_list("at").alias("places"))


def repeated_places(spark: SparkSession, docs: DataFrame, span: int, gram: int) -> DataFrame:
    """``id, at`` of every repeated window (or run of windows) that is not the first of its kind."""
    if not 1 <= gram < span or span - gram + 1 >= 1 << COUNT_BITS:
        raise ValueError("span - gram must be 1 to 14")
    anchors = _scan(_anchors(span, gram))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).mapInArrow(anchors, KEYED)
    # at most (sampled anchors / HOT_IN_SAMPLE) values; the 1,000 hottest are enough to deal them out
    hot = [r["g"] for r in sample.where("not done").groupBy("g").count().where(F.col("count") >= HOT_IN_SAMPLE)
           .orderBy(F.desc("count")).limit(1000).collect()]
    seeds = written(spark, _sorted_judgement(docs.mapInArrow(anchors, KEYED), hot, True), "repeat-seeds")
    partial = _by_document(seeds.where("not every"))
    texts = docs.join(partial, (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("f_id")) & (F.col("th") == F.col("f_th")))
    # equal rows list the same places once
    windows = texts.select("doc_id", "text", "th", "places").mapInArrow(_scan(_windows(span)), KEYED)
    found = _sorted_judgement(windows, [], False)
    return seeds.where("every").select("id", "at").union(found.select("id", "at"))


def _cut(raw: bytes, stay: np.ndarray, start: np.ndarray) -> bytes:
    """``raw`` without the words that do not stay, each with the blanks after it."""
    edge = np.append(start, len(raw))
    change = np.flatnonzero(np.diff(stay.astype(np.int8), prepend=np.int8(1)))
    parts, keep, at = [], True, 0
    for i in change.tolist():
        if keep:
            parts.append(raw[at:edge[i]])
        keep, at = not keep, edge[i]
    if keep:
        parts.append(raw[at:])
    return b"".join(parts)


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with ``th``, the number of the row's text among the different texts of its id, in the order of their
    128-bit hashes.  Only ids that have several texts (null ids, as a rule) cost more than one narrow shuffle.

    Texts are numbered in cells by the high bits of the hash, so an id that a third of all rows share is many cells."""
    hashed = docs.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")})
    texts = hashed.select("doc_id", "h1", "h2", F.shiftright("h1", 64 - CELL_BITS).alias("cell")).distinct()
    by_cell = Window.partitionBy("doc_id").orderBy("cell")
    of_id = Window.partitionBy("doc_id")
    cells = (texts.groupBy("doc_id", "cell").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("doc_id").alias("cell_id"), F.col("cell").alias("in_cell"), (F.sum("n").over(by_cell) - F.col("n")).alias("before"),
                     F.sum("n").over(of_id).alias("texts")).where("texts > 1"))
    cells = written(spark, cells, "repeat-cells")
    most = cells.agg(F.max("texts")).first()[0]
    if most is None:
        return docs.withColumn("th", F.lit(0).cast("long"))
    if most >= 1 << TEXT_BITS:
        raise ValueError(f"an id has {most} texts")
    rank = F.row_number().over(Window.partitionBy("n_id", "cell").orderBy("n1", "n2"))
    numbers = (texts.join(cells, F.col("doc_id").eqNullSafe(F.col("cell_id")) & (F.col("cell") == F.col("in_cell")))
               .select(F.col("doc_id").alias("n_id"), F.col("h1").alias("n1"), F.col("h2").alias("n2"), "cell", "before")
               .select("n_id", "n1", "n2", (F.col("before") + rank - 1).cast("long").alias("number")))
    numbers = written(spark, numbers, "repeat-numbers")
    same = (F.col("doc_id").eqNullSafe(F.col("n_id"))) & (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2"))
    out = hashed.join(numbers, same, "left").withColumn("th", F.coalesce("number", F.lit(0)))
    return written(spark, out.select(*docs.columns, "th"), "repeat-texts")


def substring_dedup(spark: SparkSession, docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space); with ``carry`` also text (the
    text without the removed words, otherwise as it was) and ``rest``."""
    docs = numbered(spark, id_text(docs, id_col, text_col, carry))
    places = _by_document(repeated_places(spark, docs.select("doc_id", "text", "th"), span, gram))
    joined = docs.join(places, (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("f_id")) & (F.col("th") == F.col("f_th")),
                       "left").select("doc_id", "text", "places", *(["rest"] if carry else []))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if carry:
        schema += f", text string, rest {joined.schema['rest'].dataType.simpleString()}"

    def run(batches):
        for whole in batches:
            for batch in bounded_slices(whole, 1):
                n, removed, sha, kept_text = [], [], [], []
                texts = text_bytes(batch.column(1))
                spans = Words(texts) if carry else None
                for i, (raw, at) in enumerate(zip(texts, batch.column(2))):
                    words = raw.split()
                    n.append(len(words))
                    if at.is_valid:
                        a = at.values.to_numpy()
                        start = (a >> COUNT_BITS) & ((1 << PLACE_BITS) - 1)
                        edge = np.zeros(len(words) + 1, dtype=np.int64)
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + (a & ((1 << COUNT_BITS) - 1)) - 1 + span, -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        removed.append(len(words) - int(stay.sum()))
                        words = [words[j] for j in np.flatnonzero(stay).tolist()]
                        if carry:
                            raw = _cut(raw, stay, spans.start[spans.first[i]:spans.last[i]] - spans.base[i])
                    else:
                        removed.append(0)
                    sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    kept_text.append(raw.decode() if carry else None)
                cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if carry:
                    cols += [pa.array(kept_text, pa.string()), batch.column(3)]
                    names += ["text", "rest"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, schema)
