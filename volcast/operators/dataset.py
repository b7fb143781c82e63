"""Chronological split, per-symbol scaling, sampling, symbol ids and sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcast.functions.market import micros_to_ntz, ntz_micros
from volcast.operators.series import RN, number_rows, over_series, time_segment

# Fixed values of the reference's dataset preparation.
TRAIN_FRACTION = 0.8
VAL_FRACTION = 0.9
SCALE_COLUMNS = ["rv_15m", "rv_1h", "rv_4h", "rv_24h", "parkinson_15m", "parkinson_1h", "buy_ratio"]
DROPNA_COLUMNS = SCALE_COLUMNS + ["volume_zscore"]
SEQUENCE_FEATURES = ["rv_15m", "rv_1h", "rv_4h", "rv_24h", "parkinson_15m", "parkinson_1h",
                     "volume_zscore", "buy_ratio"]
SEQ_LEN = 48
SAMPLE_EVERY = 5


def split_cuts(df: DataFrame, time: str = "event_time") -> DataFrame:
    """The 80 % / 90 % cuts of the global time span as a one-row table of TIMESTAMP_NTZ
    (``train_cut``, ``val_cut``), from one partial aggregate."""
    ends = df.agg(F.min(time).alias("first"), F.max(time).alias("last"))
    t0, span = ntz_micros("first"), ntz_micros("last") - ntz_micros("first")
    return ends.select(*[micros_to_ntz((t0 + F.floor(span * f)).cast("long")).alias(name)
                         for name, f in (("train_cut", TRAIN_FRACTION), ("val_cut", VAL_FRACTION))])


def _ranges(cuts: DataFrame, time: str) -> dict[str, Column]:
    """Condition of each split on the raw time column.  The two cuts are one row of two
    timestamps, so they become literals and the comparison reaches the parquet scan."""
    train_cut, val_cut = (F.lit(c).cast("timestamp_ntz") for c in cuts.select("train_cut", "val_cut").first())
    t = F.col(time)
    return {"train": t < train_cut, "val": (t >= train_cut) & (t < val_cut), "test": t >= val_cut}


def chrono_split(df: DataFrame, cuts: DataFrame, time: str = "event_time") -> DataFrame:
    """label rows train / val / test by the global cuts (one pass, no re-scan per split)."""
    r = _ranges(cuts, time)
    return df.withColumn("split", F.when(r["train"], "train").when(r["val"], "val").otherwise("test"))


def split_part(df: DataFrame, cuts: DataFrame, split: str, time: str = "event_time") -> DataFrame:
    """the rows of one split, as a range on the time column."""
    return df.filter(_ranges(cuts, time)[split])


def column_profiles(train: DataFrame, cols: Sequence[str] = SCALE_COLUMNS, key: str = "symbol") -> DataFrame:
    """One row per symbol with ``profile``, a map from column name to its training centre
    and spread (sample deviation), gathered in one aggregate."""
    moments = [F.struct(F.lit(c).alias("column"), F.struct(F.avg(c).alias("centre"), F.stddev_samp(c).alias("spread"))
                        .alias("moments")) for c in cols]
    return train.groupBy(key).agg(F.map_from_entries(F.array(*moments)).alias("profile"))


def standardised(df: DataFrame, profiles: DataFrame, cols: Sequence[str] = SCALE_COLUMNS,
                 key: str = "symbol") -> DataFrame:
    """``cols`` in units of their symbol's training spread around its centre.  A symbol that
    training has not seen, and a column without spread, give nulls.  One row per symbol joins;
    Spark broadcasts it while it is below the session's threshold in bytes."""
    def scaled(c: str) -> Column:
        m = F.col("profile")[c]
        return F.try_divide(F.col(c) - m["centre"], m["spread"])

    return df.join(profiles, key, "left").select(*[scaled(c).alias(c) if c in cols else c for c in df.columns])


def drop_incomplete(df: DataFrame, cols: Sequence[str] = DROPNA_COLUMNS) -> DataFrame:
    """drop rows with a null in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def every_kth(df: DataFrame, k: int = SAMPLE_EVERY, key: str | Sequence[str] = "symbol",
              time: str = "event_time") -> DataFrame:
    """Rows 1, 1+k, 1+2k, ... of each series in time order (the reference's
    positional sampling), numbered without a whole-symbol task."""
    n = number_rows(df, _keys(key), [time], time_segment(time), total_col=None)
    return n.filter(F.pmod(F.col(RN) - 1, F.lit(k)) == 0).drop(RN)


#: Distinct values that choose the splits of :func:`dense_ids`, and the number of splits.
ID_SAMPLE, ID_SPLITS = 16_384, 128


def range_segment(values: DataFrame, col: str, splits: int = ID_SPLITS, sample: int = ID_SAMPLE) -> Column | None:
    """Order-preserving segment number of a column of distinct values: how many of at most ``splits - 1`` bounds
    lie at or below the value, found by a tree of comparisons.

    The bounds are even steps through a sample of at most ``sample`` values (smallest hashes), the only rows that
    reach the driver.  They decide where values are numbered, never which number they get.  With fewer than two
    distinct values there is nothing to split (``None``)."""
    picked = sorted((r[0] for r in values.orderBy(F.xxhash64(col), col).limit(sample).select(col).collect()))
    step = max(1, -(-len(picked) // splits))
    bounds = picked[step::step]

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(col) < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds)) if bounds else None


def dense_ids(df: DataFrame, col: str, out: str = "symbol_id", splits: int = ID_SPLITS,
              sample: int = ID_SAMPLE) -> DataFrame:
    """0-based dense id of each distinct value of a string column in sorted order; a null has no id.

    The distinct values are numbered per range of values (:func:`range_segment`) and shifted by the running count of
    earlier ranges, so values with one common prefix spread like any others and a task holds about 1 / ``splits``
    of them."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    segment = range_segment(d, col, splits, sample)
    n = number_rows(d, [], [col], segment if segment is not None else F.lit(0), total_col=None)
    return n.select(col, (F.col(RN) - 1).cast("int").alias(out))


def sequences(df: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES, target: str = "target_15m",
              seq_len: int = SEQ_LEN, key: str | Sequence[str] = "symbol", time: str = "event_time",
              chunk_rows: int | None = None) -> DataFrame:
    """W11 / Y-4: for each row t with ``seq_len`` rows before it, the matrix of rows
    t-seq_len .. t-1 (time-major, ``seq_len`` x len(features)) and the target of row t."""
    feats = list(features)

    def build(frame, spec):
        vec = F.array(*[F.col(c).cast("double") for c in feats])
        return frame.withColumn("seq", F.collect_list(vec).over(spec.rowsBetween(-seq_len, -1)))

    keys = _keys(key)
    d = df.select(*keys, time, *feats, target)
    out = over_series(d, keys, time, build, back=seq_len, chunk_rows=chunk_rows)
    return (out.filter(F.size("seq") == seq_len)
               .select(*keys, time, "seq", F.col(target).alias("target")))
