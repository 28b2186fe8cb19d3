"""Complete ranking models: build, fit, score, evaluate, save and load behind one small interface."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models import fm, trees
from rankweave.models.fm import FMModel
from rankweave.operators import binary_eval
from rankweave.session import ensure_checkpoint_dir


class Ranker(Protocol):
    """A model that appends `score` (probability of a positive) to feature rows."""

    def fit(self, df: DataFrame) -> Ranker: ...

    def transform(self, df: DataFrame) -> DataFrame: ...

    def save(self, spark: SparkSession, path: str) -> None: ...

    def load(self, spark: SparkSession, path: str) -> Ranker: ...


def evaluate(ranker: Ranker, df: DataFrame, label: str = "label", bins: int = 10) -> dict[str, DataFrame]:
    """Threshold curve, areas and weighted report of a ranker on labelled rows, and the report per label.

    Rows are scored once: `scores` (two columns) is cached for the other results; unpersist it when done.
    """
    scored = ranker.transform(df).select(F.col(label).cast("int").alias("label"), "score").persist()
    predicted = binary_eval.with_prediction(scored, "score")
    return {
        "scores": scored,
        "curve": binary_eval.threshold_curve(scored, bins=bins),
        "areas": binary_eval.areas(scored),
        "report": binary_eval.classification_report(predicted),
        "slices": binary_eval.classification_report(predicted, groups=["label"]),
    }


class _PipelineRanker:
    """A ranker whose model is one saved pipeline ending in a classifier."""

    def __init__(self, stages: Sequence[Transformer], label: str = "label"):
        self.stages = list(stages)
        self.label = label
        self.model: PipelineModel | None = None

    def _classifiers(self) -> list:
        raise NotImplementedError

    def _probability(self) -> str:
        return "probability"

    def fit(self, df: DataFrame) -> _PipelineRanker:
        ensure_checkpoint_dir(df.sparkSession)
        self.model = Pipeline(stages=[*self.stages, *self._classifiers()]).fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).withColumn("score", vector_to_array(self._probability())[1])

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(path)

    def load(self, spark: SparkSession, path: str) -> _PipelineRanker:
        self.model = PipelineModel.load(path)
        return self


class TreeRanker(_PipelineRanker):
    """Feature stages and boosted trees."""

    def __init__(self, stages: Sequence[Transformer], label: str = "label", **settings):
        super().__init__(stages, label)
        self.settings = settings

    def _classifiers(self) -> list:
        return [trees.boosted_trees(label=self.label, **self.settings)]

    def _probability(self) -> str:
        return "gbt_probability"


class LinearRanker(_PipelineRanker):
    """Feature stages and logistic regression."""

    def __init__(self, stages: Sequence[Transformer], label: str = "label", **settings):
        super().__init__(stages, label)
        self.settings = settings

    def _classifiers(self) -> list:
        return [trees.logistic_regression(label=self.label, **self.settings)]


class TreeLinearRanker(_PipelineRanker):
    """Feature stages, boosted trees, one-hot leaves, and logistic regression on leaves (and further vectors)."""

    def __init__(
        self,
        stages: Sequence[Transformer],
        label: str = "label",
        rounds: int = trees.ROUNDS,
        depth: int = trees.DEPTH,
        other_features: Sequence[str] = (),
        **settings,
    ):
        super().__init__(stages, label)
        self.rounds, self.depth, self.other_features, self.settings = rounds, depth, other_features, settings

    def _classifiers(self) -> list:
        return [
            trees.boosted_trees(label=self.label, rounds=self.rounds, depth=self.depth),
            *trees.leaf_stack(self.rounds, self.depth, self.other_features),
            trees.logistic_regression("stack_features", self.label, **self.settings),
        ]


class FactorizationRanker:
    """Feature stages and a factorization machine over the `features` vector, trained by SGD or L-BFGS."""

    features = "features"

    def __init__(self, stages: Sequence[Transformer], label: str = "label", optimizer: str = "sgd", **training):
        self.stages = list(stages)
        self.label = label
        self.optimizer = optimizer
        self.training = training
        self.model: PipelineModel | None = None
        self.machine: FMModel | None = None

    def fit(self, df: DataFrame) -> FactorizationRanker:
        ensure_checkpoint_dir(df.sparkSession)
        self.model = Pipeline(stages=self.stages).fit(df)
        train = {"sgd": fm.train_sgd, "lbfgs": fm.train_lbfgs}[self.optimizer]
        self.machine = train(self.model.transform(df), self.features, self.label, **self.training)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).withColumn("score", self.machine.score(F.col(self.features)))

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/stages")
        self.machine.save(spark, f"{path}/machine")

    def load(self, spark: SparkSession, path: str) -> FactorizationRanker:
        self.model = PipelineModel.load(f"{path}/stages")
        self.machine = FMModel.load(spark, f"{path}/machine")
        return self


class TreeFactorizationRanker(FactorizationRanker):
    """Feature stages, boosted trees, one-hot leaves, and a factorization machine on leaves (and further vectors)."""

    features = "stack_features"

    def __init__(
        self,
        stages: Sequence[Transformer],
        label: str = "label",
        rounds: int = trees.ROUNDS,
        depth: int = trees.DEPTH,
        other_features: Sequence[str] = (),
        optimizer: str = "sgd",
        **training,
    ):
        stacked = [
            *stages,
            trees.boosted_trees(label=label, rounds=rounds, depth=depth),
            *trees.leaf_stack(rounds, depth, other_features),
        ]
        super().__init__(stacked, label, optimizer, **training)
