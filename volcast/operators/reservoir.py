"""M8 M9: an order-aware sequence learner — a fixed random reservoir with a linear readout.

A recurrent state runs over the steps of a sequence, ``h = tanh(W h + U [x, s])``, with fixed random
matrices and a fixed random code ``s`` of the symbol.  Only the readout is learnt: ridge regression of
the standardised target on the last state.  Its Gram matrix is a sum over rows, so every task sends
one matrix of its rows (Arrow batches, bounded chunks) and the driver solves a system whose size
does not depend on the data.

Defined cases: sequences with a null, non-finite or missing cell and rows without a target are left
out of the fit; such sequences score null; a symbol never seen has a code like any other.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that are run through the reservoir at a time (the reference's scoring chunk).
CHUNK_ROWS = 4096
UNITS, CODE, RADIUS, SEED = 32, 4, 0.9, 20240607


class Reservoir:
    """The fixed part: matrices from a seed; states of a block of sequences."""

    def __init__(self, steps: int, width: int, units: int = UNITS, code: int = CODE, radius: float = RADIUS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        w = rng.normal(size=(units, units))
        self.w = w * (radius / np.abs(np.linalg.eigvals(w)).max())
        self.u = rng.normal(size=(units, width + code)) / np.sqrt(width + code)
        self.steps, self.width, self.units, self.code = steps, width, units, code
        self.config = {"steps": steps, "width": width, "units": units, "code": code, "radius": radius, "seed": seed}

    def codes(self, symbols: Sequence[str | None]) -> np.ndarray:
        """One fixed code in [-1, 1] per symbol."""
        known = {s: np.frombuffer(hashlib.sha256((s or "").encode()).digest()[:2 * self.code], dtype="<u2") / 32767.5 - 1
                 for s in set(symbols)}
        return np.array([known[s] for s in symbols]).reshape(-1, self.code)

    def states(self, x: np.ndarray, symbols: Sequence[str | None]) -> np.ndarray:
        """Design rows ``[1, last state]`` of sequences ``x`` (rows x steps x width)."""
        h, code = np.zeros((len(x), self.units)), self.codes(symbols)
        for t in range(self.steps):
            h = np.tanh(h @ self.w.T + np.concatenate([x[:, t], code], axis=1) @ self.u.T)
        return np.concatenate([np.ones((len(x), 1)), h], axis=1)


def _blocks(batch: pa.RecordBatch, shape: Reservoir):
    """(first row, usable rows, cells, symbols) of chunks of a batch of (symbol, flat cells, ...)."""
    size = shape.steps * shape.width
    for at in range(0, batch.num_rows, CHUNK_ROWS):
        part = batch.slice(at, CHUNK_ROWS)
        column = part.column(1)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(lengths == size)
        cells = column.take(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, shape.steps, shape.width)
        fine = np.isfinite(cells).all((1, 2))
        names = part.column(0).take(pa.array(whole[fine])).to_pylist()
        yield at, whole[fine], cells[fine], names


def _flat(seqs: DataFrame, *others: str) -> DataFrame:
    return seqs.select("symbol", F.flatten(F.col("seq").cast("array<array<double>>")).alias("cells"), *others)


def fit(train: DataFrame, shape: Reservoir, ridge: float = 1e-3, target: str = "target") -> dict:
    """Readout weights, target mean and population std from the rows of ``train`` (symbol, seq, target)."""
    y = train.where(F.col(target).isNotNull() & ~F.isnan(target))
    moments = y.agg(F.avg(target).alias("y_mean"), F.stddev_pop(target).alias("y_std")).first()
    if moments.y_mean is None:
        raise ValueError("no training sequence has a target")
    mean, std = moments.y_mean, moments.y_std or 1.0
    width = shape.units + 1

    def gram(batches):
        total, n = np.zeros((width, width + 1)), 0
        for batch in batches:
            goal = batch.column(2).to_numpy()
            for at, rows, cells, symbols in _blocks(batch, shape):
                z = shape.states(cells, symbols)
                total += z.T @ np.concatenate([z, ((goal[at + rows] - mean) / std)[:, None]], axis=1)
                n += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))],
                                         ["n", "cells"])

    parts = _flat(y, F.col(target).cast("double").alias("goal")).mapInArrow(gram, "n long, cells array<double>")
    sums = parts.select("n", F.posexplode("cells").alias("at", "v")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    rows = sums.orderBy("at").collect()                    # (units + 1) * (units + 2) numbers
    if not rows or not rows[0].n:
        raise ValueError("no training sequence is complete")
    total, n = np.array([r.v for r in rows]).reshape(width, width + 1), rows[0].n
    penalty = ridge * n * np.diag([0.0] + [1.0] * shape.units)
    weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])
    return {"weights": weights.tolist(), "y_mean": mean, "y_std": std, "n_train": n, "config": shape.config}


def save(spark: SparkSession, model: dict, path: str) -> None:
    """K9: the artefact as one row of JSON."""
    spark.createDataFrame([(json.dumps(model),)], "model string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> dict:
    model = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if set(model) != {"weights", "y_mean", "y_std", "n_train", "config"}:
        raise ValueError("not a reservoir artefact")
    return model


def score(seqs: DataFrame, model: dict, out: str = "res_pred", target: str = "target") -> DataFrame:
    """M9: symbol, event_time, split, target and the prediction in the target's units for every sequence.  The scorer
    is built once per task from the artefact (a few kilobytes) and sees bounded chunks."""

    def run(batches):
        shape, weights = Reservoir(**model["config"]), np.array(model["weights"])
        for batch in batches:
            pred = np.full(batch.num_rows, np.nan)
            for at, rows, cells, symbols in _blocks(batch, shape):
                pred[at + rows] = shape.states(cells, symbols) @ weights * model["y_std"] + model["y_mean"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(pred, mask=np.isnan(pred))],
                                             ["symbol", "event_time", "split", target, out])

    kept = {f.name: f.dataType.simpleString() for f in seqs.schema.fields}
    schema = ", ".join(f"{c} {kept[c]}" for c in ("symbol", "event_time", "split", target)) + f", {out} double"
    return _flat(seqs, "event_time", "split", target).mapInArrow(run, schema)
