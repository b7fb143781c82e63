"""Oracle SQL (DuckDB dialect) for the registered plans.

Written from the definitions, not from our Spark plans, with every constant and column list
written out here: straightforward ``PARTITION BY symbol`` windows, ``arg_min``/``arg_max``
bars, explicit CASEs for null-safe division.  Views ``events`` etc. are registered by the caller.
"""

from __future__ import annotations

PF = "0.36067376022224085"      # 1 / (4 ln 2)
SCALED_COLUMNS = ["rv_15m", "rv_1h", "rv_4h", "rv_24h", "parkinson_15m", "parkinson_1h", "buy_ratio"]
SEQUENCE_COLUMNS = ["rv_15m", "rv_1h", "rv_4h", "rv_24h", "parkinson_15m", "parkinson_1h", "volume_zscore", "buy_ratio"]
COMPLETE_COLUMNS = ["rv_15m", "rv_1h", "rv_4h", "rv_24h", "parkinson_15m", "parkinson_1h", "buy_ratio", "volume_zscore"]

TICKS = """
ticks AS (
  SELECT event_type AS symbol, ts AS event_time, value + 1.0 AS price, value AS volume,
         CASE WHEN user_id % 2 = 0 THEN value ELSE 0.0 END AS taker_buy_volume, event_id AS tick_id
  FROM events)"""


def bars_sql(unit: str = "hour", ticks: str = TICKS) -> str:
    return ticks + f""",
bars AS (
  SELECT symbol, date_trunc('{unit}', event_time) + INTERVAL 1 {unit.upper()} AS bar_time,
         arg_min(price, epoch_us(event_time)::HUGEINT * 10000000000000000000 + tick_id) AS open,
         max(price) AS high, min(price) AS low,
         arg_max(price, epoch_us(event_time)::HUGEINT * 10000000000000000000 + tick_id) AS close, sum(volume) AS volume,
         sum(taker_buy_volume) AS taker_buy_volume, count(*) AS num_trades
  FROM ticks GROUP BY symbol, date_trunc('{unit}', event_time))"""


BARS = bars_sql("hour")

_RETURNS_TAIL = """,
ret0 AS (
  SELECT symbol, bar_time AS event_time, open, high, low, close, volume, taker_buy_volume, num_trades,
         lag(close) OVER (PARTITION BY symbol ORDER BY bar_time) AS prev_close,
         row_number() OVER (PARTITION BY symbol ORDER BY bar_time) AS rn
  FROM bars),
ret AS (
  SELECT *, CASE WHEN prev_close <> 0 AND close / prev_close > 0 THEN ln(close / prev_close) END AS log_return
  FROM ret0),
sq AS (SELECT *, log_return * log_return AS sq_return FROM ret)"""
RETURNS = BARS + _RETURNS_TAIL


def _rows(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY event_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _fwd(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY event_time ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"


FEATURES = RETURNS + f""",
feat0 AS (
  SELECT *,
    sum(sq_return) OVER {_rows(15)} AS rv_15m,
    sum(sq_return) OVER {_rows(60)} AS rv_1h,
    sum(sq_return) OVER {_rows(240)} AS rv_4h,
    sum(sq_return) OVER {_rows(1440)} AS rv_24h,
    CASE WHEN low <> 0 AND high / low > 0 THEN {PF} * pow(ln(high / low), 2) END AS parkinson_1m,
    avg(volume) OVER {_rows(60)} AS vol_mean_1h,
    stddev_samp(volume) OVER {_rows(60)} AS vol_std_1h,
    CASE WHEN volume = 0 THEN NULL ELSE taker_buy_volume / volume END AS buy_ratio,
    sum(sq_return) OVER {_fwd(15)} AS fsum15, count(sq_return) OVER {_fwd(15)} AS fcnt15,
    sum(sq_return) OVER {_fwd(60)} AS fsum60, count(sq_return) OVER {_fwd(60)} AS fcnt60
  FROM sq),
feat AS (
  SELECT *,
    avg(parkinson_1m) OVER {_rows(15)} AS parkinson_15m,
    avg(parkinson_1m) OVER {_rows(60)} AS parkinson_1h,
    CASE WHEN vol_std_1h > 1e-12 THEN (volume - vol_mean_1h) / vol_std_1h END AS volume_zscore
  FROM feat0),
targets AS (
  SELECT *, ln(1 + fsum15) AS target_15m, ln(1 + fsum60) AS target_1h
  FROM feat WHERE fcnt15 = 15 AND fcnt60 = 60)"""


def _har(rv15: str = "rv_15m", rv1h: str = "rv_1h", rv24: str = "rv_24h") -> str:
    return (f"(1.896524003230036e-05 + 0.17862620024636272 * ln(1 + {rv15}) + 0.011214103226812332 * ln(1 + {rv1h})"
            f" + 0.00035420663272866257 * ln(1 + {rv24}))")


_DETECT_TAIL = f""",
drv AS (
  SELECT *,
    sum(sq_return) OVER {_rows(15)} AS rv_15m,
    sum(sq_return) OVER {_rows(60)} AS rv_1h,
    sum(sq_return) OVER {_rows(1440)} AS rv_24h
  FROM sq),
dfc AS (SELECT *, {_har()} AS forecast FROM drv),
dres AS (
  SELECT *,
    CASE WHEN rn >= 16 AND rv_15m + 1e-12 > 0 AND forecast + 1e-12 > 0
         THEN ln(rv_15m + 1e-12) - ln(forecast + 1e-12) END AS residual,
    CASE WHEN forecast IS NOT NULL THEN sqrt(greatest(exp(forecast) - 1, 0.0)) * 100 END AS vol_forecast,
    CASE WHEN rv_15m IS NOT NULL THEN sqrt(greatest(rv_15m, 0.0)) * 100 END AS vol_realized
  FROM dfc),
dz0 AS (
  SELECT *,
    avg(residual) OVER p AS zm, stddev_samp(residual) OVER p AS zs, count(residual) OVER p AS zn
  FROM dres
  WINDOW p AS (PARTITION BY symbol ORDER BY event_time ROWS BETWEEN 288 PRECEDING AND 1 PRECEDING)),
scored AS (
  SELECT symbol, event_time, CAST(event_time AS DATE) AS day, close, rv_15m, rv_1h, rv_24h, forecast,
         vol_forecast, vol_realized, residual,
         CASE WHEN zn >= 29 AND zs > 1e-12 THEN (residual - zm) / zs END AS zscore
  FROM dz0 WHERE rn >= 16),
forecasts AS (
  SELECT *, coalesce(abs(zscore) > 4.0, false) AS is_anomaly FROM scored)"""
DETECT = RETURNS + _DETECT_TAIL


def detect_sql(unit: str) -> str:
    return bars_sql(unit) + _RETURNS_TAIL + _DETECT_TAIL


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


R = "round({0}, 6) + 0.0 AS {0}"


def rnd(*cols: str) -> str:
    return ", ".join(R.format(c) for c in cols)


# ---------------------------------------------------------------- dataset preparation

def _scaled_cols() -> str:
    return ",\n    ".join(
        f"CASE WHEN st.{c}_std = 0 THEN NULL ELSE (s.{c} - st.{c}_mean) / st.{c}_std END AS {c}"
        for c in SCALED_COLUMNS)


def _stats_cols() -> str:
    return ", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in SCALED_COLUMNS)


def _notnull(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def _split_ctes(src: str, time: str, name: str) -> str:
    return f""",
{name}_b AS (SELECT epoch_us(min({time})) AS t0, epoch_us(max({time})) AS t1 FROM {src}),
{name}_c AS (
  SELECT t0 + CAST(floor(CAST(t1 - t0 AS DOUBLE) * 0.8) AS BIGINT) AS train_cut,
         t0 + CAST(floor(CAST(t1 - t0 AS DOUBLE) * 0.9) AS BIGINT) AS val_cut FROM {name}_b)"""


SPLIT = FEATURES + _split_ctes("targets", "event_time", "bnd") + """,
split AS (
  SELECT t.*, CASE WHEN epoch_us(t.event_time) < c.train_cut THEN 'train'
                   WHEN epoch_us(t.event_time) < c.val_cut THEN 'val' ELSE 'test' END AS split
  FROM targets t, bnd_c c)"""


def _scaled() -> str:
    return SPLIT + f""",
stats AS (SELECT symbol, {_stats_cols()} FROM split WHERE split = 'train' GROUP BY symbol),
scaled0 AS (
  SELECT s.symbol, s.event_time, s.split,
    {_scaled_cols()},
    s.volume_zscore, s.target_15m, s.target_1h
  FROM split s LEFT JOIN stats st ON s.symbol = st.symbol),
scaled AS (SELECT * FROM scaled0 WHERE {_notnull(COMPLETE_COLUMNS)})"""


SCALED = _scaled()


def _sampled(split_name: str, cte: str) -> str:
    cols = ", ".join(SEQUENCE_COLUMNS)
    return f""",
{cte}0 AS (
  SELECT symbol, event_time, {cols}, target_15m,
         row_number() OVER (PARTITION BY symbol ORDER BY event_time) AS srn
  FROM scaled WHERE split = '{split_name}'),
{cte} AS (SELECT * FROM {cte}0 WHERE (srn - 1) % 5 = 0 AND {_notnull(SEQUENCE_COLUMNS + ['target_15m'])})"""


#: Every fifth row of each (symbol, split) series and the 48 rows before it.
_SEQ_WINDOW = "(PARTITION BY symbol, split ORDER BY event_time ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING)"
SEQUENCES = SCALED + f""",
seq0 AS (
  SELECT symbol, split, event_time, {", ".join(SEQUENCE_COLUMNS)}, target_15m,
         row_number() OVER (PARTITION BY symbol, split ORDER BY event_time) AS srn
  FROM scaled),
seq1 AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, split ORDER BY event_time) AS pos FROM seq0
  WHERE (srn - 1) % 5 = 0 AND {_notnull(SEQUENCE_COLUMNS + ['target_15m'])}),
seq2 AS (
  SELECT symbol, split, event_time, target_15m AS target, count(*) OVER w AS seq_len,
    {", ".join(f"sum({c}) OVER w AS sum_{c}, sum({c} * pos) OVER w - (pos - 49) * sum({c}) OVER w AS turn_{c}"
               for c in SEQUENCE_COLUMNS)}
  FROM seq1 WINDOW w AS {_SEQ_WINDOW}),
seqs AS (SELECT * FROM seq2 WHERE seq_len = 48)"""

# ---------------------------------------------------------------- models

def _det3(a) -> str:
    return (f"({a[0][0]} * ({a[1][1]} * {a[2][2]} - {a[1][2]} * {a[2][1]})"
            f" - {a[0][1]} * ({a[1][0]} * {a[2][2]} - {a[1][2]} * {a[2][0]})"
            f" + {a[0][2]} * ({a[1][0]} * {a[2][1]} - {a[1][1]} * {a[2][0]}))")


def _har_fit() -> str:
    cov = [[f"c{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    cy = [f"cy{i}" for i in range(3)]
    ws = []
    for k in range(3):
        mm = [[cy[r] if c == k else cov[r][c] for c in range(3)] for r in range(3)]
        ws.append(f"{_det3(mm)} / {_det3(cov)} AS w{k}")
    covs = ", ".join(f"covar_pop(x{i}, x{j}) AS c{i}{j}" for i in range(3) for j in range(i, 3))
    return f""",
har_d AS (
  SELECT ln(1 + rv_15m) AS x0, ln(1 + rv_1h) AS x1, ln(1 + rv_24h) AS x2, target_15m AS y
  FROM split WHERE split = 'train' AND rv_15m IS NOT NULL AND rv_1h IS NOT NULL AND rv_24h IS NOT NULL
    AND target_15m IS NOT NULL),
har_s AS (
  SELECT count(*) AS n, avg(y) AS my, avg(x0) AS m0, avg(x1) AS m1, avg(x2) AS m2,
         covar_pop(x0, y) AS cy0, covar_pop(x1, y) AS cy1, covar_pop(x2, y) AS cy2, {covs}
  FROM har_d),
har_w AS (SELECT n, my, m0, m1, m2, {", ".join(ws)} FROM har_s),
har_fit AS (
  SELECT n AS n_train, my - (0.0 + w0 * m0 + w1 * m1 + w2 * m2) AS intercept,
         w0 AS w_15m, w1 AS w_1h, w2 AS w_24h, my AS y_mean FROM har_w)"""


HAR_FIT = SPLIT + _har_fit()
