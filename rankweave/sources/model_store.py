"""Saving, loading and batch scoring of fitted models, and reports of parameter searches."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models.fm import FMModel


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> tuple[PipelineModel, object]:
    """The pipeline and its last stage, the model."""
    pipeline = PipelineModel.load(path)
    return pipeline, pipeline.stages[-1]


def write_report(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").json(path)


def score_pipeline(df: DataFrame, path: str) -> DataFrame:
    """Batch scoring with a saved pipeline."""
    return PipelineModel.load(path).transform(df)


def score_fm(spark: SparkSession, df: DataFrame, model_path: str, features: str = "features", link: bool = True) -> DataFrame:
    """Batch scoring with a saved factorization machine; link=False gives the raw margin."""
    model = FMModel.load(spark, model_path)
    return df.withColumn("score", model.score(F.col(features), link))
