"""K9: model artefacts — the HAR coefficients as a one-row parquet table, the sequence model as one folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from volcast.operators.models import COEF_COLUMNS


def save_har(fit: DataFrame, path: str) -> None:
    """Write the fitted coefficients (one row; the aggregate guarantees exactly one)."""
    fit.coalesce(1).write.mode("overwrite").parquet(path)


def load_har(spark: SparkSession, path: str) -> DataFrame:
    """The saved coefficients; pass to :func:`volcast.operators.models.coefficients`."""
    d = spark.read.parquet(path)
    missing = [c for c in COEF_COLUMNS if c not in d.columns]
    if missing:
        raise ValueError(f"not a HAR artefact, missing {missing}")
    return d


def save_sequence_model(spark: SparkSession, path: str, model, scaling: DataFrame, ids: DataFrame, config: dict) -> None:
    """Everything a scorer needs under one folder: pipeline, target scaling, symbol ids, configuration."""
    model.write().overwrite().save(f"{path}/pipeline")
    scaling.write.mode("overwrite").parquet(f"{path}/target_scaling")
    ids.write.mode("overwrite").parquet(f"{path}/symbol_ids")
    spark.createDataFrame([(json.dumps(config),)], "config string").coalesce(1).write.mode("overwrite").parquet(f"{path}/config")


def load_sequence_model(spark: SparkSession, path: str):
    """(pipeline model, target scaling, symbol ids, configuration) of a saved artefact."""
    from pyspark.ml import PipelineModel
    config = json.loads(spark.read.parquet(f"{path}/config").first()[0])
    return (PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/target_scaling"),
            spark.read.parquet(f"{path}/symbol_ids"), config)
