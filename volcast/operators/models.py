"""HAR-RV fit and scoring, evaluation metrics, and the sequence model (Spark ML)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volcast.functions.market import har_forecast

HAR_INPUTS = ["rv_15m", "rv_1h", "rv_24h"]
HAR_TARGET = "target_15m"
COEF_COLUMNS = ["intercept", "w_15m", "w_1h", "w_24h"]


def har_design(df: DataFrame, inputs: Sequence[str] = HAR_INPUTS, target: str = HAR_TARGET) -> DataFrame:
    """log1p of the realised variances; rows with any null dropped."""
    d = df.select(*[F.log1p(c).alias(f"x{i}") for i, c in enumerate(inputs)], F.col(target).alias("y"))
    return d.na.drop()


def _det3(a):
    return (a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1])
            - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0])
            + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0]))


def fit_har(df: DataFrame, inputs: Sequence[str] = HAR_INPUTS, target: str = HAR_TARGET) -> DataFrame:
    """M1: ordinary least squares of ``target`` on log1p(inputs), one row of coefficients.

    Normal equations from one distributed aggregate (means and population
    covariances, merged map-side), solved in closed form (Cramer's rule) as
    Column arithmetic — the model never leaves the executors as data."""
    d = har_design(df, inputs, target)
    k = len(inputs)
    if k != 3:
        raise ValueError("fit_har solves the three-input HAR model")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("y").alias("my")]
    aggs += [F.avg(f"x{i}").alias(f"m{i}") for i in range(k)]
    for i in range(k):
        aggs.append(F.covar_pop(f"x{i}", "y").alias(f"cy{i}"))
        for j in range(i, k):
            aggs.append(F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}"))
    s = d.agg(*aggs)
    cov = [[F.col(f"c{min(i, j)}{max(i, j)}") for j in range(k)] for i in range(k)]
    cy = [F.col(f"cy{i}") for i in range(k)]
    det = _det3(cov)
    w = []
    for col_i in range(k):
        m = [[cy[r] if c == col_i else cov[r][c] for c in range(k)] for r in range(k)]
        w.append(_det3(m) / det)
    out = s.select("n", *[wi.alias(f"_w{i}") for i, wi in enumerate(w)], "my", *[f"m{i}" for i in range(k)])
    intercept = F.col("my") - sum((F.col(f"_w{i}") * F.col(f"m{i}") for i in range(k)), F.lit(0.0))
    return out.select(F.col("n").alias("n_train"), intercept.alias("intercept"),
                      F.col("_w0").alias("w_15m"), F.col("_w1").alias("w_1h"), F.col("_w2").alias("w_24h"),
                      F.col("my").alias("y_mean"))


def _fit_row(fit: DataFrame) -> Column:
    """The one-row fit as a single struct-valued scalar subquery.  Every use is the same
    plan, so Spark executes the fit once however many fields are read."""
    return fit.select(F.struct(*fit.columns).alias("fit")).scalar()


def coefficients(fit: DataFrame) -> dict[str, Column]:
    """Coefficients as fields of one scalar subquery, ready for :func:`har_forecast`."""
    row = _fit_row(fit)
    return {"intercept": row["intercept"], "w15": row["w_15m"], "w1h": row["w_1h"], "w24": row["w_24h"]}


def score_har_fitted(df: DataFrame, fit: DataFrame, out: str = "har_pred") -> DataFrame:
    """M2: batch HAR prediction with fitted coefficients (same expression as the live path)."""
    return df.withColumn(out, har_forecast(*HAR_INPUTS, **coefficients(fit)))


def regression_metrics(df: DataFrame, truth: str, preds: dict[str, Column | str]) -> DataFrame:
    """One row per model with n, RMSE and MAE (one aggregation for all models)."""
    pairs = [F.struct(F.lit(name).alias("model"), (F.col(p) if isinstance(p, str) else p).cast("double").alias("p"))
             for name, p in preds.items()]
    long = df.select(F.col(truth).alias("y"), F.explode(F.array(*pairs)).alias("_m")).select("y", "_m.*")
    long = long.na.drop(subset=["y", "p"])
    err = F.col("y") - F.col("p")
    return long.groupBy("model").agg(F.count(F.lit(1)).alias("n"),
                                     F.sqrt(F.avg(err * err)).alias("rmse"),
                                     F.avg(F.abs(err)).alias("mae"))


def losses_by_split(df: DataFrame, preds: dict[str, str], truth: str = "target") -> DataFrame:
    """N, RMSE and MAE per split and model, and over all splits (``split = 'all'``) as the
    sample-weighted mean of the per-split losses."""
    pairs = F.array(*[F.struct(F.lit(name).alias("model"), F.col(p).cast("double").alias("p")) for name, p in preds.items()])
    long = df.select("split", truth, F.explode(pairs).alias("_m")).select("split", truth, "_m.*").na.drop(subset=[truth, "p"])
    err = F.col(truth) - F.col("p")
    per_split = long.groupBy("split", "model").agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"),
                                                   F.avg(F.abs(err)).alias("mae"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("model"))
    overall = per_split.select("model", "n", (F.col("mse") * share).alias("mse"), (F.col("mae") * share).alias("mae")) \
        .groupBy("model").agg(F.lit("all").alias("split"), F.sum("n").alias("n"), F.sum("mse").alias("mse"),
                              F.sum("mae").alias("mae"))
    return per_split.unionByName(overall).select("split", "model", "n", F.sqrt("mse").alias("rmse"), "mae")


def mean_target(fit: DataFrame) -> Column:
    """The naive predictor — mean target over the fit's rows — as a scalar subquery."""
    return _fit_row(fit)["y_mean"]


def target_scaling(train_seq: DataFrame, target: str = "target") -> DataFrame:
    """Mean and population std of the training targets (one row)."""
    return train_seq.agg(*target_moments(target))


def target_moments(target: str = "target") -> list[Column]:
    return [F.avg(target).alias("y_mean"), F.stddev_pop(target).alias("y_std")]


def flatten_sequences(seqs: DataFrame, ids: DataFrame) -> DataFrame:
    """M8 inputs: flattened 48 x 8 window as an ML vector, plus the dense symbol id.
    ``ids`` has one row per symbol; the join is left so unseen symbols keep a null id."""
    from pyspark.ml.functions import array_to_vector

    extra = [c for c in seqs.columns if c not in ("symbol", "event_time", "seq", "target")]
    d = seqs.join(ids, "symbol", "left")
    return d.select("symbol", "event_time", *extra, F.coalesce("symbol_id", F.lit(-1)).alias("symbol_id"),
                    array_to_vector(F.flatten("seq")).alias("features"), "target")


def fit_sequence_model(train_vec: DataFrame, reg: float = 1e-3, elastic: float = 0.0, max_iter: int = 50):
    """M8: the second forecaster, re-aimed as a distributed Spark ML regression on the
    flattened sequence plus a one-hot symbol (the recurrent network itself is not built).
    The label is the standardised target (A8), as in the reference's training loop."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    enc = OneHotEncoder(inputCols=["symbol_id"], outputCols=["sym_vec"], handleInvalid="keep", dropLast=False)
    asm = VectorAssembler(inputCols=["features", "sym_vec"], outputCol="x")
    lr = LinearRegression(featuresCol="x", labelCol="target_s", regParam=reg, elasticNetParam=elastic,
                          maxIter=max_iter, standardization=True)
    return Pipeline(stages=[enc, asm, lr]).fit(train_vec)


def standardise_target(df: DataFrame, scaling: DataFrame, target: str = "target") -> DataFrame:
    """(y - mean) / std with the training statistics as scalar subqueries."""
    row = _fit_row(scaling)
    return df.withColumn("target_s", F.try_divide(F.col(target) - row["y_mean"], row["y_std"]))


def destandardise(df: DataFrame, scaling: DataFrame, pred: str = "prediction", out: str = "seq_pred") -> DataFrame:
    """M9: predictions back to the target's units: p * std + mean."""
    row = _fit_row(scaling)
    return df.withColumn(out, F.col(pred) * row["y_std"] + row["y_mean"])
