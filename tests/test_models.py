import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from volcast.operators import models as md
from volcast.plans.common import split_features, split_part


def test_har_fit_equals_least_squares(spark):
    tr = split_features(spark, SF_SMALL).filter("split = 'train'")
    fit = md.fit_har(tr).first()
    rows = md.har_design(tr).collect()
    X = np.array([[1.0, r.x0, r.x1, r.x2] for r in rows])
    y = np.array([r.y for r in rows])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert fit.n_train == len(rows)
    np.testing.assert_allclose([fit.intercept, fit.w_15m, fit.w_1h, fit.w_24h], beta, rtol=1e-7, atol=1e-9)


def test_fitted_scoring_uses_scalar_subqueries(spark):
    f = split_features(spark, SF_SMALL)
    fit = md.fit_har(f.filter("split = 'train'"))
    scored = md.score_har_fitted(f.filter("split = 'test'"), fit)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    m = md.regression_metrics(scored, "target_15m", {"HAR": "har_pred", "mean": md.mean_target(fit)})
    got = {r.model: r for r in m.collect()}
    assert set(got) == {"HAR", "mean"} and got["HAR"].n == got["mean"].n


def test_metrics_simple(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "y double, p double")
    r = md.regression_metrics(df, "y", {"m": "p"}).first()
    assert abs(r.rmse - np.sqrt(0.5)) < 1e-12 and abs(r.mae - 0.5) < 1e-12


def test_symbol_lookup_prunes_partitions(spark):
    import __spark_entry__ as E
    df = E.queries()["symbol_lookup"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "click" in plan


def test_time_filter_and_columns_reach_the_scan(spark):
    """§4.1: a time range on the written feature table is pushed to the parquet scan (row-group
    statistics on time-sorted files) and only the projected columns are read."""
    import datetime as dt

    from volcast.plans.common import feature_rows
    f = feature_rows(spark, SF_SMALL).filter(F.col("event_time") >= F.lit(dt.datetime(2024, 1, 20)))
    plan = f.select("symbol", "rv_15m")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan
    assert "ReadSchema: struct<event_time:timestamp_ntz,rv_15m:double>" in plan


def test_split_range_reaches_the_scan(spark):
    import __spark_entry__ as E
    assert E.queries()["model_metrics"](spark, SF_SMALL).count() == 2
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for split in ("train", "val", "test"):
        d = split_part(spark, SF_SMALL, split)
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert any(op in plan.split("PushedFilters: [")[1].split("]")[0]
                   for op in ("LessThan(event_time", "GreaterThanOrEqual(event_time"))
        same = split_features(spark, SF_SMALL).filter(F.col("split") == split)
        assert d.count() == same.count()


def test_standardised_columns_have_unit_spread(spark):
    from volcast.operators import dataset as ds
    rows = [(s, float(i), 5.0) for s in "ab" for i in range(10)]
    d = spark.createDataFrame(rows, "symbol string, x double, y double")
    p = ds.column_profiles(d, ["x", "y"])
    out = ds.standardised(d.unionByName(spark.createDataFrame([("new", 1.0, 1.0)], d.schema)), p, ["x", "y"])
    by = {r.symbol: r for r in out.groupBy("symbol").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"),
                                                         F.count("y").alias("n")).collect()}
    assert abs(by["a"].m) < 1e-12 and abs(by["b"].s - 1) < 1e-12 and by["a"].n == 0 and by["new"].m is None
    assert out.columns == d.columns


def test_sequence_model_artefact_and_comparison(spark):
    """Fitted on the training sequences, saved and loaded as one artefact; finite scores for every
    sequence, a training error below the mean predictor's, and the same rows as the other models."""
    from conftest import SF_MID
    from volcast.plans.common import sequence_model, sequence_table
    from volcast.plans.registry import sequence_comparison
    scored = sequence_model(spark, SF_MID)
    assert scored.count() == sequence_table(spark, SF_MID).count() > 0
    assert scored.filter(F.isnan("seq_pred") | F.col("seq_pred").isNull()).count() == 0
    table = {(r.split, r.model): r for r in sequence_comparison(spark, SF_MID).collect()}
    assert {n for _, n in table} == {"SEQ", "RES", "HAR", "mean"}
    y = scored.filter("split = 'train'").toPandas()
    assert ((y.target - y.seq_pred) ** 2).mean() < y.target.var(ddof=0)
    assert all(table[s, n].n == table[s, "mean"].n for s, n in table if n in ("SEQ", "RES"))


def test_sequence_model_loads_what_was_saved(spark, tmp_dir):
    from pyspark.ml.linalg import Vectors
    from volcast.sinks.models import load_sequence_model, save_sequence_model
    rows = [("a", 0, Vectors.dense([float(i), 1.0]), 2.0 * i) for i in range(20)]
    train = spark.createDataFrame(rows, ["symbol", "symbol_id", "features", "target_s"])
    model = md.fit_sequence_model(train)
    one = spark.createDataFrame([(1.5, 2.5)], "y_mean double, y_std double")
    ids = spark.createDataFrame([("a", 0)], "symbol string, symbol_id int")
    save_sequence_model(spark, f"{tmp_dir}/m", model, one, ids, {"seq_len": 48})
    again, scaling, ids2, config = load_sequence_model(spark, f"{tmp_dir}/m")
    assert config == {"seq_len": 48} and scaling.first().y_std == 2.5 and ids2.collect() == ids.collect()
    pick = lambda m: [r.prediction for r in m.transform(train).collect()]
    assert pick(again) == pick(model)


def plain_reservoir(shape, sequences, symbols):
    """Last states step by step, one sequence at a time."""
    out = []
    for x, s in zip(sequences, symbols):
        h, code = np.zeros(shape.units), shape.codes([s])[0]
        for step in x:
            h = np.tanh(shape.w @ h + shape.u @ np.concatenate([step, code]))
        out.append([1.0, *h])
    return np.array(out)


def test_reservoir_equals_a_plain_fit_over_all_training_sequences(spark):
    """M8 M9: readout weights, scores and loss of the registered job against numpy, row by row."""
    from conftest import SF_MID
    from volcast.operators import reservoir as rs
    from volcast.plans.common import reservoir_scores, sequence_table
    from volcast.plans.registry import sequence_comparison
    rows = sequence_table(spark, SF_MID).collect()
    shape = rs.Reservoir(48, 8)
    z = plain_reservoir(shape, [np.array(r.seq) for r in rows], [r.symbol for r in rows])
    y, train = np.array([r.target for r in rows]), np.array([r.split == "train" for r in rows])
    mean, std = y[train].mean(), y[train].std()
    a = z[train]
    w = np.linalg.solve(a.T @ a + 1e-3 * len(a) * np.diag([0.0] + [1.0] * shape.units), a.T @ ((y[train] - mean) / std))
    model = rs.fit(sequence_table(spark, SF_MID).filter("split = 'train'"), shape)
    assert model["n_train"] == train.sum() and np.allclose(model["weights"], w, atol=1e-7)
    want = {(r.symbol, r.event_time): p for r, p in zip(rows, z @ w * std + mean)}
    got = {(r.symbol, r.event_time): r.res_pred for r in reservoir_scores(spark, SF_MID).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    loss = {(r.split, r.model): r for r in sequence_comparison(spark, SF_MID).collect()}
    fitted = np.array([want[r.symbol, r.event_time] for r in rows])
    assert abs(loss["train", "RES"].rmse - np.sqrt(((y - fitted)[train] ** 2).mean())) < 1e-6
    assert loss["train", "RES"].rmse <= loss["train", "mean"].rmse


def test_reservoir_sees_order_and_survives_odd_rows(spark, tmp_dir):
    import datetime as dt
    from volcast.operators import reservoir as rs
    rng, shape = np.random.default_rng(1), rs.Reservoir(6, 2, units=24)
    t0, rows = dt.datetime(2024, 1, 1), []
    for i in range(300):
        x = rng.normal(size=(6, 2))
        rows.append(("ab"[i % 2], t0 + dt.timedelta(hours=i), "train", x.tolist(), float(x[-1, 0] - x[-2, 0])))
    odd = [("a", t0, "test", None, 1.0), ("a", t0, "test", [[1.0, 2.0]], 1.0), ("b", t0, "test", [[None, 2.0]] * 6, 1.0),
           (None, t0, "test", rows[0][3], None), ("new", t0, "test", rows[0][3], float("nan")), ("a", t0, "test", [[float("inf"), 0.0]] * 6, 2.0)]
    d = spark.createDataFrame(rows + odd, "symbol string, event_time timestamp_ntz, split string, seq array<array<double>>, target double")
    model = rs.fit(d.repartition(3), shape)
    assert model["n_train"] == 300
    turned = rs.score(d.withColumn("seq", F.reverse("seq")), model).filter("split = 'train'").toPandas()
    out = rs.score(d, model)
    straight = out.filter("split = 'train'").toPandas()
    error = lambda p: ((p.target - p.res_pred) ** 2).mean()
    assert error(straight) < 0.5 * straight.target.var() < error(turned)         # the order of the steps matters
    assert [r.res_pred is None for r in out.filter("split = 'test'").collect()].count(True) == 4
    rs.save(spark, model, f"{tmp_dir}/m")
    assert rs.load(spark, f"{tmp_dir}/m") == model
    import pytest
    with pytest.raises(ValueError, match="no training sequence"):
        rs.fit(d.limit(0), shape)
    with pytest.raises(ValueError, match="complete"):
        rs.fit(d.filter("seq is null"), shape)
