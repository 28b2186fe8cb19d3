"""Boosted trees, logistic regression, and stacks that feed tree leaves to a second model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.models import fm
from rankweave.models.stages import LeafOneHot
from rankweave.session import ensure_checkpoint_dir

# Default training settings.
ROUNDS = 300
DEPTH = 6
STEP = 0.1
SAMPLE = 0.8
MIN_ROWS_PER_LEAF = 3
LR_ITERATIONS = 50
LR_REG = 0.3
LR_ELASTIC_NET = 0.002

LEAVES = "predLeaf"


def boosted_trees(
    features: str = "features",
    label: str = "label",
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    step: float = STEP,
    sample: float = SAMPLE,
    seed: int = 12345,
    prefix: str = "gbt_",
) -> GBTClassifier:
    """Boosted trees that also report the leaf of each tree.

    Row and feature sampling match the usual boosting settings. Leaf-weight shrinkage, split penalty and the hessian
    limit have no exact counterpart here; the smallest leaf size stands in for the last one.
    """
    classifier = GBTClassifier(
        featuresCol=features,
        labelCol=label,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=sample,
        featureSubsetStrategy=str(sample),
        minInstancesPerNode=MIN_ROWS_PER_LEAF,
        leafCol=LEAVES,
        predictionCol=f"{prefix}prediction",
        checkpointInterval=10,
        seed=seed,
    )
    # Names of its own, so that a second model in the same pipeline can use the usual ones.
    return classifier.setRawPredictionCol(f"{prefix}margin").setProbabilityCol(f"{prefix}probability")


def logistic_regression(
    features: str = "features",
    label: str = "label",
    iterations: int = LR_ITERATIONS,
    reg: float = LR_REG,
    elastic_net: float = LR_ELASTIC_NET,
) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=iterations, regParam=reg, elasticNetParam=elastic_net
    )


def fit_trees(df: DataFrame, stages: Sequence = (), **settings) -> PipelineModel:
    """Feature stages followed by boosted trees."""
    ensure_checkpoint_dir(df.sparkSession)
    return Pipeline(stages=[*stages, boosted_trees(**settings)]).fit(df)


def leaf_stack(rounds: int, depth: int, other_features: Sequence[str] = (), output: str = "stack_features") -> list:
    """Stages that turn tree leaves (and further vector columns) into one feature vector."""
    return [
        LeafOneHot(inputCol=LEAVES, outputCol="leaf_vec", trees=rounds, depth=depth),
        VectorAssembler(inputCols=["leaf_vec", *other_features], outputCol=output),
    ]


def fit_leaf_lr(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    other_features: Sequence[str] = (),
    reg: float = LR_REG,
    seed: int = 12345,
) -> PipelineModel:
    """Trees, their leaves one-hot, and logistic regression on top, as one pipeline."""
    ensure_checkpoint_dir(df.sparkSession)
    return Pipeline(
        stages=[
            boosted_trees(features, label, rounds, depth, seed=seed),
            *leaf_stack(rounds, depth, other_features),
            logistic_regression("stack_features", label, reg=reg),
        ]
    ).fit(df)


def fit_leaf_fm(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    other_features: Sequence[str] = (),
    seed: int = 12345,
    **training,
) -> tuple[PipelineModel, fm.FMModel]:
    """Trees and their leaves as a pipeline, and a factorization machine on its output."""
    ensure_checkpoint_dir(df.sparkSession)
    pipeline = Pipeline(
        stages=[boosted_trees(features, label, rounds, depth, seed=seed), *leaf_stack(rounds, depth, other_features)]
    ).fit(df)
    return pipeline, fm.train_sgd(pipeline.transform(df), "stack_features", label, seed=seed, **training)


def fit_indexed_trees(
    df: DataFrame, features: str = "features", label: str = "label", rounds: int = 10, max_categories: int = 4, seed: int = 12345
) -> PipelineModel:
    """Trees over indexed labels and categorical features; `predictedLabel` is the original label."""
    ensure_checkpoint_dir(df.sparkSession)
    labels = StringIndexer(inputCol=label, outputCol="indexedLabel").fit(df)
    categories = VectorIndexer(inputCol=features, outputCol="indexedFeatures", maxCategories=max_categories).fit(df)
    trees = GBTClassifier(featuresCol="indexedFeatures", labelCol="indexedLabel", maxIter=rounds, seed=seed)
    names = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=labels.labels)
    return Pipeline(stages=[labels, categories, trees, names]).fit(df)


def feature_importances(df: DataFrame, model: PipelineModel, stage: int = -1) -> DataFrame:
    """(feature, importance) of a fitted tree stage; only features that are used."""
    importances = model.stages[stage].featureImportances
    rows = [(int(i), float(importances[int(i)])) for i in range(importances.size) if importances[int(i)] > 0]
    return df.sparkSession.createDataFrame(rows, "feature int, importance double")


def training_summary(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """(iteration, objective) of a logistic regression fit."""
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return df.sparkSession.createDataFrame(rows, "iteration int, objective double")


def training_roc(model: LogisticRegressionModel) -> DataFrame:
    """(point, fpr, tpr): the ROC curve of a logistic regression on its training data, from (0, 0) to (1, 1)."""
    roc = model.summary.roc
    order = F.row_number().over(Window.orderBy("FPR", "TPR"))  # Spark's curve has some thousand points at most
    return roc.select(order.cast("bigint").alias("point"), F.col("FPR").alias("fpr"), F.col("TPR").alias("tpr"))


def training_area(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """One row: the area under that curve."""
    return df.sparkSession.createDataFrame([(float(model.summary.areaUnderROC),)], "area_under_roc double")


def use_best_threshold(model: LogisticRegressionModel) -> float:
    """Set the model's threshold to the one with the highest F-measure on its training data."""
    by_threshold = model.summary.fMeasureByThreshold
    best = by_threshold.agg(F.max_by("threshold", F.struct("F-Measure", "threshold")).alias("t")).first()["t"]
    model.setThreshold(best)
    return best
