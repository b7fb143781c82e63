"""Per-symbol time-series machinery that never puts a whole symbol in one task.

A plain ``Window.partitionBy("symbol")`` sends every row of a symbol to one task.
With one symbol holding a third of all rows that task is the whole job.  The two
operators below replace it:

``number_rows``
    Global, 1-based row numbers per key in time order.  Rows are first grouped
    by ``(key, segment)`` where ``segment`` is a coarse, order-preserving bucket
    (a day of bars by default).  Each segment is numbered locally; a tiny table
    of segment sizes (one row per key and segment) turns local numbers into
    global ones through a running sum.

``over_series``
    Row-count window frames evaluated on chunks of ``chunk_rows`` consecutive
    rows.  Every chunk receives copies of the ``back`` rows before it and the
    ``ahead`` rows after it (its halo), windows run per ``(key, chunk)``, and
    only the chunk's own rows are kept.  The result equals the same frames over
    the full series as long as no frame reaches further than the halo.

Both are plain DataFrame plans: two hash shuffles, one sort, no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RN = "_rn"          # global row number (long, 1-based)
TOTAL = "_total"    # rows in the key's whole series
CHUNK = "_chunk"    # chunk id the copy belongs to
CORE = "_core"      # True for the chunk's own rows, False for halo copies

DEFAULT_SEGMENT = "1 day"
MIN_CHUNK_ROWS = 32_768


def time_segment(col: str | Column, width: str = DEFAULT_SEGMENT) -> Column:
    """Order-preserving bucket of a timestamp (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.window(c, width)["start"]


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                segment: Column, rn_col: str = RN, total_col: str | None = TOTAL) -> DataFrame:
    """Add a global 1-based row number per ``by`` group in ``order``.

    ``segment`` must be non-decreasing along ``order`` inside each group.  Work per
    task is bounded by the rows of one ``(by, segment)`` cell, not by a group.
    ``order`` must be a total order inside a group for the numbers to be stable.
    """
    by = list(by)
    seg = "_seg"
    d = df.withColumn(seg, segment)
    keys = by + [seg]
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # One row per (key, segment): small, bounded by keys x time span / segment width.
    per_key = Window.partitionBy(*by) if by else Window.partitionBy()
    running = per_key.orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off")]
    if total_col:
        cols.append(F.sum("_n").over(per_key.rowsBetween(Window.unboundedPreceding,
                                                         Window.unboundedFollowing)).alias(total_col))
    offsets = counts.select(*cols)
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    d = d.withColumn("_lrn", local)
    d = d.join(offsets, keys, "inner")
    return (d.withColumn(rn_col, (F.col("_off") + F.col("_lrn")).cast("long"))
             .drop("_lrn", "_off", seg))


def chunk_size(back: int, ahead: int, chunk_rows: int | None = None) -> int:
    """Rows per chunk: large enough that halos cost a few percent of the data."""
    if chunk_rows:
        return int(chunk_rows)
    return max(MIN_CHUNK_ROWS, 16 * (back + ahead))


def with_halo(numbered: DataFrame, back: int, ahead: int, chunk_rows: int,
              rn_col: str = RN, total_col: str = TOTAL) -> DataFrame:
    """Copy every row into its own chunk and into each chunk whose halo covers it.

    Row ``i`` (0-based) lives in chunk ``i // C``.  Chunk ``m`` needs rows
    ``[mC - back, (m+1)C + ahead)``, so row ``i`` is needed by the contiguous
    chunk range ``[(i - ahead) // C, (i + back) // C]`` (clamped to the series).
    """
    c = int(chunk_rows)
    i = F.col(rn_col) - 1
    own = F.floor(i / c)
    lo = F.greatest(F.lit(0).cast("long"), F.floor((i - ahead) / c))
    hi = F.least(F.floor((i + back) / c), F.floor((F.col(total_col) - 1) / c))
    return (numbered
            .withColumn(CHUNK, F.explode(F.sequence(lo.cast("long"), hi.cast("long"))))
            .withColumn(CORE, F.col(CHUNK) == own))


def over_series(df: DataFrame, by: Sequence[str], time_col: str,
                build: Callable[[DataFrame, "Window"], DataFrame],
                back: int, ahead: int = 0, chunk_rows: int | None = None,
                segment: Column | None = None, keep_rn: str | None = None,
                order: Sequence[str | Column] | None = None) -> DataFrame:
    """Run row-frame window logic per ``by`` series without whole-series tasks.

    ``build(frame, spec)`` receives the halo-extended rows and a base
    ``WindowSpec`` (partitioned by key and chunk, ordered by row number); it adds
    window columns using ``spec.rowsBetween(...)``.  Frames must not reach more
    than ``back`` rows behind or ``ahead`` rows in front of the current row,
    counting nested windows (a 288-row window over a 1440-row sum needs 1728).
    """
    by = list(by)
    seg = segment if segment is not None else time_segment(time_col)
    numbered = number_rows(df, by, order or [time_col], seg)
    c = chunk_size(back, ahead, chunk_rows)
    halo = with_halo(numbered, back, ahead, c)
    spec = Window.partitionBy(*by, CHUNK).orderBy(RN)
    out = build(halo, spec).filter(F.col(CORE))
    drop = [CHUNK, CORE, TOTAL]
    if keep_rn:
        out = out.withColumnRenamed(RN, keep_rn)
    else:
        drop.append(RN)
    return out.drop(*drop)


def apply_over_series(df: DataFrame, by: Sequence[str], time_col: str, fn: Callable, schema: str,
                      back: int, ahead: int = 0, chunk_rows: int | None = None, segment: Column | None = None,
                      order: Sequence[str | Column] | None = None) -> DataFrame:
    """A user's pandas function over row frames of each ``by`` series, without whole-series groups.

    ``fn`` receives consecutive rows of one series in time order as a pandas frame and returns a frame of ``schema``
    with one row for each of them, in the same order.  It may look at most ``back`` rows behind and ``ahead`` rows
    in front of a row: that is what every chunk of ``chunk_rows`` rows is given beside its own, and only the rows of
    the chunk itself are kept.  A group is therefore bounded by the chunk, however long the series is.

    Another number of rows than was given is an error.  Rows with a null key or time have no place in a series and
    are left out, as in :func:`number_rows`."""
    by = list(by)
    seg = segment if segment is not None else time_segment(time_col)
    numbered = number_rows(df, by, order or [time_col], seg)
    halo = with_halo(numbered, back, ahead, chunk_size(back, ahead, chunk_rows))

    def run(rows):
        rows = rows.sort_values(RN, kind="stable").reset_index(drop=True)
        own = rows.pop(CORE).to_numpy(dtype=bool)
        made = fn(rows.drop(columns=[RN, TOTAL, CHUNK]))
        if len(made) != len(rows):
            raise ValueError(f"the function was given {len(rows)} rows and returned {len(made)}")
        return made[own]

    return halo.groupBy(*by, CHUNK).applyInPandas(run, schema)


def window_moments(frame: DataFrame, spec, part_keys: Sequence[str], rn: str, value: str, w: int,
                   past: bool, prefix: str) -> DataFrame:
    """Count, mean and sample std of ``value`` over the last ``w`` rows, in O(rows).

    The window ends at row e = i (``past=False``) or e = i - 1 (``past=True``).  Rows
    are cut into blocks of ``w`` by row number ``rn``; the window is the head of e's
    block up to e plus, when it starts in the previous block, that block's tail from
    the window start.  Heads and tails are running frames inside a block (Welford
    updates: a constant block has exactly zero variance); the two pieces are merged
    with the parallel-variance formula (Chan et al.).  ``part_keys`` / ``spec`` are the
    series partitioning (e.g. symbol + chunk, ordered by ``rn``).  Adds
    ``{prefix}_n``, ``{prefix}_mean`` and ``{prefix}_std``."""
    s = 1 if past else 0
    blk = f"_{prefix}_blk"
    frame = frame.withColumn(blk, F.floor((F.col(rn) - 1) / w))
    within = Window.partitionBy(*part_keys, blk)
    head = within.orderBy(F.col(rn)).rowsBetween(Window.unboundedPreceding, 0)
    tail = within.orderBy(F.col(rn).desc()).rowsBetween(Window.unboundedPreceding, 0)
    x = F.col(value)
    t = {k: f"_{prefix}_{k}" for k in ("hn", "hm", "hv", "tn", "tm", "tv", "an", "am", "av", "bn", "bm", "bv")}
    frame = frame.withColumns({
        t["hn"]: F.count(x).over(head), t["hm"]: F.avg(x).over(head), t["hv"]: F.var_pop(x).over(head),
        t["tn"]: F.count(x).over(tail), t["tm"]: F.avg(x).over(tail), t["tv"]: F.var_pop(x).over(tail),
    })
    lag_a, lag_b = s, w - 1 + s

    def at(col, k):
        return F.col(col) if k == 0 else F.lag(col, k).over(spec)

    other_block = at(blk, lag_b) != at(blk, lag_a)
    frame = frame.withColumns({
        t["an"]: F.coalesce(at(t["hn"], lag_a), F.lit(0)), t["am"]: at(t["hm"], lag_a), t["av"]: at(t["hv"], lag_a),
        t["bn"]: F.when(other_block, at(t["tn"], lag_b)).otherwise(F.lit(0)),
        t["bm"]: F.when(other_block, at(t["tm"], lag_b)),
        t["bv"]: F.when(other_block, at(t["tv"], lag_b)),
    })
    na = F.coalesce(F.col(t["an"]), F.lit(0)).cast("double")
    nb = F.coalesce(F.col(t["bn"]), F.lit(0)).cast("double")
    n = na + nb
    ma, mb = F.coalesce(F.col(t["am"]), F.lit(0.0)), F.coalesce(F.col(t["bm"]), F.lit(0.0))
    delta = mb - ma
    m2 = (F.coalesce(F.col(t["av"]), F.lit(0.0)) * na + F.coalesce(F.col(t["bv"]), F.lit(0.0)) * nb
          + F.when(n > 0, delta * delta * na * nb / n).otherwise(F.lit(0.0)))
    frame = frame.withColumns({
        f"{prefix}_n": n.cast("long"),
        f"{prefix}_mean": F.when(n > 0, ma + delta * nb / n),
        f"{prefix}_std": F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))),
    })
    return frame.drop(blk, *t.values())


def window_sums(frame: DataFrame, spec, part_keys: Sequence[str], rn: str, value: str, w: int,
                out: str, nonnegative: bool = False) -> DataFrame:
    """Sum of ``value`` over the last ``w`` rows (current included), in O(rows).

    Same block decomposition as :func:`window_moments`: the window is the head of the
    current row's block plus, when it starts earlier, the tail of the previous block.
    Both parts are plain sums of at most ``w`` values, so unlike a difference of running
    sums nothing is subtracted and a large value long gone cannot cost precision.  Null
    handling matches ``sum``: a window without a non-null value gives null."""
    blk = f"_{out}_blk"
    frame = frame.withColumn(blk, F.floor((F.col(rn) - 1) / w))
    within = Window.partitionBy(*part_keys, blk)
    head = within.orderBy(F.col(rn)).rowsBetween(Window.unboundedPreceding, 0)
    tail = within.orderBy(F.col(rn).desc()).rowsBetween(Window.unboundedPreceding, 0)
    x = F.col(value)
    hs, hn, ts, tn = (f"_{out}_{k}" for k in ("hs", "hn", "ts", "tn"))
    frame = frame.withColumns({hs: F.sum(x).over(head), hn: F.count(x).over(head),
                               ts: F.sum(x).over(tail), tn: F.count(x).over(tail)})
    lag_b = w - 1
    other_block = F.lag(blk, lag_b).over(spec) != F.col(blk)
    n = F.col(hn) + F.when(other_block, F.lag(tn, lag_b).over(spec)).otherwise(F.lit(0))
    total = (F.coalesce(F.col(hs), F.lit(0.0))
             + F.when(other_block, F.coalesce(F.lag(ts, lag_b).over(spec), F.lit(0.0))).otherwise(F.lit(0.0)))
    val = F.greatest(total, F.lit(0.0)) if nonnegative else total
    return frame.withColumn(out, F.when(n > 0, val)).drop(blk, hs, hn, ts, tn)
