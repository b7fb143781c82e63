"""Quality classifier: Bradley-Terry pairwise ranking.

A text's worth is linear in a few measures of its form.  The chance that text a is preferred to
text b is the logistic function of the difference of their worths; the weights are learnt from
preference pairs (a: label 1, b: label 0) by the logistic loss on feature differences, with an L2
term, by Newton steps.  The cut is a quantile of the worths of the training rows: the level that
sorts most of them rightly.  A score is the logistic function of the worth, shifted so that the
cut lies at ``cut_score``.

Learning uses at most ``max_rows`` labelled rows (those with the smallest hashes of their ids, of
the training folds only), so what reaches the driver is bounded: ``max_rows`` rows of 14 numbers.
Every text is scored whole, without a shuffle.  Labels, lang, source and doc_id are no inputs.

Defined cases: a null text counts as empty; both get the score of an empty text; a document with
two different labels is not used for learning; without rows of both labels all scores are 0.5;
repeated rows give repeated result rows; a null id is in no fold (held_out false).
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcast.llm.common import SPACE_BYTES, id_text, map_rows, text_bytes

FEATURES = ("log_words", "mean_word", "symbols", "marked_words", "bars", "exclaims", "upper", "digits", "repeats",
            "common", "fresh", "compress", "marks", "non_ascii")
SYMBOLS = b"#*$%&|<>@^~\\{}[]=+_"
ASCII = bytes(range(128))
FOLDS = 5


def features(raw: bytes) -> list[float]:
    """Measures of form of one text (UTF-8 bytes); the shares are of words or of non-blank bytes."""
    import zstandard

    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / (size + 20)

    size = len(raw.translate(None, SPACE_BYTES))
    weight = n + 5             # shares of a few words say little
    counts = Counter(words)
    ratio = len(raw) / max(len(zstandard.ZstdCompressor(level=1).compress(raw)) - 9, 1)
    return [
        np.log1p(n), min(size / n, 50.0), share(SYMBOLS),
        sum(c for w, c in counts.items() if w[-1] in SYMBOLS) / weight,
        counts.get(b"|", 0) / weight,
        sum(c for w, c in counts.items() if w.endswith(b"!!")) / weight,
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"0123456789"),
        sum(map(bytes.__eq__, words, words[1:])) / weight,
        (max(counts.values()) - 1) / weight,
        (len(counts) + 5) / weight ** 0.9,
        np.log(max(ratio, 0.1)) - 0.06 * np.log1p(len(raw)),
        share(b".,;:!?"), len(raw.translate(None, ASCII)) / len(raw),
    ]


@dataclass(frozen=True)
class PairModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    shift: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        worth = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(worth - self.cut + self.shift, -30, 30)))


def fit_pairs(x: np.ndarray, y: np.ndarray, cut_score: float, pairs_per_row: int = 4, l2: float = 1e-2) -> PairModel:
    """Bradley-Terry weights of the rows ``x`` with labels ``y``, and the quantile cut."""
    shift = float(np.log(cut_score / (1 - cut_score)))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        d = x.shape[1]
        return PairModel(np.zeros(d), np.ones(d), np.zeros(d), shift, shift)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    n_pairs = pairs_per_row * max(len(good), len(bad))
    rng = np.random.default_rng(7)
    # every row takes part: both sides are repeated in shuffled order
    a = np.concatenate([rng.permutation(good) for _ in range(-(-n_pairs // len(good)))])[:n_pairs]
    b = np.concatenate([rng.permutation(bad) for _ in range(-(-n_pairs // len(bad)))])[:n_pairs]
    diff = z[a] - z[b]
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(np.clip(diff @ w, -30, 30)))      # chance of the wrong order
        grad = -(diff * p[:, None]).mean(0) + l2 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    worth = z @ w
    levels = np.arange(0, 1.0005, 0.005)
    cuts = np.quantile(worth, levels)
    right = np.array([((worth >= c) == (y == 1)).mean() for c in cuts])
    best = np.flatnonzero(right == right.max())
    level = levels[best[len(best) // 2]]
    cut = float(np.quantile(worth, level))
    low, high = worth[worth < cut], worth[worth >= cut]
    if len(low) and len(high):       # between the two rows at the quantile
        cut = float((low.max() + high.min()) / 2)
    return PairModel(mean, scale, w, cut, shift)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled documents of the training folds."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("quality").isin(0, 1) & (fold != 0))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
              .where(F.col("quality") == F.col("most")).select("doc_id", "quality")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows rows of two numbers: bounded, so it may be broadcast
    found = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality")

    def run(batch: pa.RecordBatch):
        x = [features(raw) for raw in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64())), batch.column(2)],
                                         ["doc_id", "x", "quality"])

    rows = (map_rows(found, run, "doc_id long, x array<double>, quality int")
            .groupBy("doc_id").agg(F.min("x").alias("x"), F.min("quality").alias("quality")).toPandas()
            .sort_values("doc_id", kind="stable"))
    return np.array(rows["x"].tolist()).reshape(len(rows), len(FEATURES)), rows["quality"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, cut_score: float = 0.3, id_col: str = "doc_id",
        text_col: str = "text") -> PairModel:
    return fit_pairs(*training_rows(id_text(docs, id_col, text_col), labels, max_rows), cut_score)


def score(docs: DataFrame, model: PairModel, cut_score: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
          keep_text: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted of every text (and, with ``keep_text``, the row's text)."""
    schema = "doc_id long, held_out boolean, score double, predicted int" + (", text string" if keep_text else "")

    def run(batch: pa.RecordBatch):
        x = np.array([features(raw) for raw in text_bytes(batch.column(1))]).reshape(batch.num_rows, len(FEATURES))
        s = model.scores(x)
        ids = batch.column(0).to_pylist()
        held = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == 0 for i in ids]
        cols = [batch.column(0), pa.array(held, pa.bool_()), pa.array(s, pa.float64()),
                pa.array((s >= cut_score).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(cols + [batch.column(1)] * keep_text,
                                         ["doc_id", "held_out", "score", "predicted"] + ["text"] * keep_text)

    return map_rows(id_text(docs, id_col, text_col), run, schema)


def accepted(docs: DataFrame, model: PairModel, cut_score: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text's score is at least ``cut_score``."""
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch):
        x = np.array([features(raw) for raw in text_bytes(batch.column(place))]).reshape(batch.num_rows, len(FEATURES))
        yield batch.filter(pa.array(model.scores(x) >= cut_score))

    return map_rows(docs, run, docs.schema, place)
