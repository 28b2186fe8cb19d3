"""Evaluation of ranked recommendation lists against lists of relevant items.

Per-list metrics are expressions over the two array columns of a row, so they need no shuffle beyond the final mean.
Catalogue-wide metrics explode the lists and count distinct items.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIST_METRICS = ("map", "ndcgAt", "precisionAtk", "recallAtK", "trueRecallAtK", "mrr", "fcp")
CATALOGUE_METRICS = ("diversityAtK", "maxDiversity")
METRICS = LIST_METRICS + CATALOGUE_METRICS


def _hits(prediction: Column, label: Column) -> Column:
    """1.0 / 0.0 per position of the prediction; null items hit nothing."""
    known = F.array_compact(label)
    return F.transform(prediction, lambda p: F.coalesce(F.array_contains(known, p), F.lit(False)).cast("double"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def average_precision(prediction: Column, label: Column) -> Column:
    """Mean precision at the hits, over the number of distinct relevant items; 0 when there are none."""
    relevant = F.size(F.array_distinct(F.array_compact(label)))
    start = F.struct(F.lit(0.0).alias("hits"), F.lit(0.0).alias("total"), F.lit(0.0).alias("seen"))

    def step(acc: Column, hit: Column) -> Column:
        hits, seen = acc["hits"] + hit, acc["seen"] + 1.0
        return F.struct(hits.alias("hits"), (acc["total"] + hit * hits / seen).alias("total"), seen.alias("seen"))

    total = F.aggregate(_hits(prediction, label), start, step, lambda acc: acc["total"])
    return F.when(relevant > 0, total / relevant).otherwise(F.lit(0.0))


def ndcg_at(prediction: Column, label: Column, k: int) -> Column:
    """Binary-relevance NDCG over the first max(|prediction|, |distinct label|) positions, at most k."""
    relevant = F.size(F.array_distinct(F.array_compact(label)))
    reach = F.least(F.greatest(F.size(prediction), relevant), F.lit(k))
    gains = F.transform(
        F.slice(_hits(prediction, label), 1, k), lambda hit, i: hit / F.ln((i + 2).cast("double"))
    )
    best = F.transform(
        F.sequence(F.lit(1), F.greatest(F.least(reach, relevant), F.lit(1))),
        lambda i: F.lit(1.0) / F.ln((i + 1).cast("double")),
    )
    return F.when(relevant > 0, _sum(gains) / _sum(best)).otherwise(F.lit(0.0))


def precision_at(prediction: Column, label: Column, k: int) -> Column:
    """Hits in the first k predictions divided by k, also for shorter lists."""
    return F.when(F.size(label) > 0, _sum(F.slice(_hits(prediction, label), 1, k)) / F.lit(float(k))).otherwise(
        F.lit(0.0)
    )


def _common(prediction: Column, label: Column) -> Column:
    return F.size(F.array_compact(F.array_intersect(prediction, label))).cast("double")


def overlap_share(prediction: Column, label: Column) -> Column:
    """Distinct items in both lists over the length of the prediction ("recallAtK"); null for an empty prediction."""
    return F.when(F.size(prediction) > 0, _common(prediction, label) / F.size(prediction))


def recall_at(prediction: Column, label: Column, k: int) -> Column:
    """Distinct relevant items among the first k predictions over all distinct relevant items; null without any."""
    relevant = F.size(F.array_distinct(F.array_compact(label)))
    return F.when(relevant > 0, _common(F.slice(prediction, 1, k), label) / relevant)


def reciprocal_rank(prediction: Column, label: Column) -> Column:
    first = F.array_position(_hits(prediction, label), F.lit(1.0))
    return F.when(first > 0, F.lit(1.0) / first).otherwise(F.lit(0.0))


def fraction_concordant(prediction: Column, label: Column) -> Column:
    """Share of common positions that hold the same item; null when either list is empty."""
    shared = F.least(F.size(prediction), F.size(label))
    same = F.zip_with(prediction, label, lambda p, t: F.when(p.eqNullSafe(t) & p.isNotNull(), 1.0).otherwise(0.0))
    return F.when(shared > 0, _sum(same) / shared)


def list_metrics(df: DataFrame, k: int, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """`df` with one column per list metric."""
    p, t = F.col(prediction), F.col(label)
    return df.select(
        "*",
        average_precision(p, t).alias("map"),
        ndcg_at(p, t, k).alias("ndcgAt"),
        precision_at(p, t, k).alias("precisionAtk"),
        overlap_share(p, t).alias("recallAtK"),
        recall_at(p, t, k).alias("trueRecallAtK"),
        reciprocal_rank(p, t).alias("mrr"),
        fraction_concordant(p, t).alias("fcp"),
    )


def catalogue_metrics(df: DataFrame, n_items: int, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: distinct recommended items, and distinct recommended or relevant items, over the catalogue size.

    Both lists are exploded in one pass and reduced per item on the map side.
    """
    recommended = F.transform(prediction, lambda p: F.struct(p.alias("item"), F.lit(1).alias("recommended")))
    relevant = F.transform(label, lambda t: F.struct(t.alias("item"), F.lit(0).alias("recommended")))
    entries = df.select(F.inline(F.concat(recommended, relevant))).where(F.col("item").isNotNull())
    items = entries.groupBy("item").agg(F.max("recommended").alias("recommended"))
    return items.agg(
        (F.coalesce(F.sum("recommended"), F.lit(0)) / F.lit(n_items)).alias("diversityAtK"),
        (F.count(F.lit(1)) / F.lit(n_items)).alias("maxDiversity"),
    )


def diversity(df: DataFrame, n_items: int, prediction: str = "prediction") -> DataFrame:
    """One row: distinct recommended items over the size of the catalogue."""
    items = df.select(F.explode(prediction).alias("item")).distinct()
    return items.agg((F.count("item") / F.lit(n_items)).alias("diversityAtK"))


def max_diversity(df: DataFrame, n_items: int, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: distinct recommended or relevant items over the size of the catalogue."""
    return catalogue_metrics(df, n_items, prediction, label).select("maxDiversity")


def ranking_metrics(
    df: DataFrame,
    k: int = 10,
    n_items: int | None = None,
    prediction: str = "prediction",
    label: str = "label",
) -> DataFrame:
    """One row with the mean of every list metric, and the catalogue metrics when `n_items` is given."""
    means = list_metrics(df.select(prediction, label), k, prediction, label).agg(
        *[F.avg(m).alias(m) for m in LIST_METRICS]
    )
    if n_items is None:
        return means
    both = catalogue_metrics(df, n_items, prediction, label).select(F.struct(*CATALOGUE_METRICS)).scalar()
    return means.withColumn("_catalogue", both).select(*LIST_METRICS, "_catalogue.*")


class RankingMetricsEvaluator(
    Evaluator, HasPredictionCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Ranking metrics as an ML evaluator, for cross validation of recommenders."""

    metricName = Param(Params._dummy(), "metricName", "|".join(METRICS), typeConverter=TypeConverters.toString)
    topK = Param(Params._dummy(), "topK", "list length k", typeConverter=TypeConverters.toInt)
    nItems = Param(Params._dummy(), "nItems", "catalogue size", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, predictionCol="prediction", labelCol="label", metricName="ndcgAt", topK=10, nItems=-1):
        super().__init__()
        self._setDefault(metricName="ndcgAt", topK=10, nItems=-1)
        self._set(**self._input_kwargs)

    def setMetricName(self, value: str):
        return self._set(metricName=value)

    def setTopK(self, value: int):
        return self._set(topK=value)

    def setNItems(self, value: int):
        return self._set(nItems=value)

    def getMetrics(self, dataset: DataFrame) -> dict[str, float]:
        n_items = self.getOrDefault(self.nItems)
        row = ranking_metrics(
            dataset,
            self.getOrDefault(self.topK),
            n_items if n_items > 0 else None,
            self.getPredictionCol(),
            self.getLabelCol(),
        ).first()
        return row.asDict()

    def _evaluate(self, dataset: DataFrame) -> float:
        name = self.getOrDefault(self.metricName)
        if name not in METRICS:
            raise ValueError(f"unknown metric {name!r}")
        if name in CATALOGUE_METRICS and self.getOrDefault(self.nItems) <= 0:
            raise ValueError(f"{name} needs nItems")
        value = self.getMetrics(dataset)[name]
        return float("nan") if value is None else value
