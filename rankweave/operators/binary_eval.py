"""Evaluation of binary scores: threshold curves, areas, confusion-based metrics.

A curve needs running totals over all scores in order. Instead of one global window, scores are grouped (equal scores
become one row), cut into ranges, totalled per range, and each range then adds the totals of the ranges above it. Ranges
come from quantile sketches in two levels, as many as the number of distinct scores asks for. The sketches only balance
the work; results are exact whatever they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct scores of one range, which a task sorts; there are at most 512 ranges of 512 each.
RANGE_ROWS = 20_000

_FAN_BITS = 9
_FAN = 1 << _FAN_BITS


def _range_of(value: Column, bounds: Column) -> Column:
    """Number of sorted `bounds` (fewer than 512) that are <= value, by bisection inside the row."""

    def halve(low: Column, step: Column) -> Column:
        return F.when(F.get(bounds, low + step - 1) <= value, low + step).otherwise(low)

    steps = F.array(*[F.lit(1 << b) for b in reversed(range(_FAN_BITS))])
    return F.aggregate(steps, F.lit(0), halve)


def _cuts(score: Column, ranges: Column) -> Column:
    """An aggregate: the bounds of `ranges` ranges (1 to 512) of about equal size. The sketch has a fixed size."""
    sketch = F.percentile_approx(score, [i / _FAN for i in range(1, _FAN)], _FAN << 3)
    picked = F.transform(F.sequence(F.lit(1), ranges - 1), lambda i: F.get(sketch, F.floor(i * _FAN / ranges).cast("int") - 1))
    return F.when(ranges > 1, picked).otherwise(F.array().cast("array<double>"))


def score_table(df: DataFrame, score: str, label: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per distinct score with running totals from the highest score down to and including it.

    Columns: score, pos, neg, cum_pos, cum_neg, rank (1 = highest), and the overall total_pos, total_neg, scores.
    """
    is_positive = (F.col(label) == 1).cast("bigint")
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(is_positive).alias("pos"), F.sum(1 - is_positive).alias("neg"))
    )

    def wanted(n: Column) -> Column:
        return F.greatest(F.least(F.ceil(n / range_rows), F.lit(_FAN)), F.lit(1)).cast("int")

    # First level: up to 512 ranges of all scores; second level: up to 512 of each of these, where it is still too large.
    everything = F.count(F.lit(1))
    outer = counts.agg(F.struct(_cuts(F.col("score"), wanted(everything)).alias("bounds"), (everything > range_rows * _FAN).alias("many")).alias("facts")).scalar()
    ranged = counts.withColumn("_facts", outer).withColumns({"_range": _range_of(F.col("score"), F.col("_facts.bounds")), "_many": F.col("_facts.many")}).drop("_facts")
    # Where one level is enough the second sketch is given nothing, so that it costs nothing.
    finer = ranged.groupBy("_range").agg(_cuts(F.when(F.col("_many"), F.col("score")), wanted(F.count(F.lit(1)))).alias("_bounds"))
    ranged = ranged.drop("_many")
    # At most 512 rows of at most 511 numbers.
    split = ranged.join(F.broadcast(finer), "_range").withColumn("_part", _range_of(F.col("score"), F.col("_bounds"))).drop("_bounds")
    sums = [F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"), F.count(F.lit(1)).alias("_n")]
    totals = split.groupBy("_range", "_part").agg(*sums)
    above = Window.partitionBy("_range").orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("_range", "_part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_in") for c in ("_pos", "_neg", "_n")])
    # At most 512 rows: a window over all of them, and a broadcast.
    whole = totals.groupBy("_range").agg(*[F.sum(c).alias(c) for c in ("_pos", "_neg", "_n")])
    order = Window.orderBy(F.col("_range").desc())
    higher, all_ranges = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = whole.select(
        "_range",
        *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_out") for c in ("_pos", "_neg", "_n")],
        F.sum("_pos").over(all_ranges).alias("total_pos"),
        F.sum("_neg").over(all_ranges).alias("total_neg"),
        F.sum("_n").over(all_ranges).alias("scores"),
    )
    offsets = parts.join(F.broadcast(ranges), "_range").select(
        "_range", "_part", *[(F.col(f"{c}_in") + F.col(f"{c}_out")).alias(f"{c}_above") for c in ("_pos", "_neg", "_n")], "total_pos", "total_neg", "scores"
    )
    inside = Window.partitionBy("_range", "_part").orderBy(F.col("score").desc())
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        split.withColumn("_p", F.sum("pos").over(running))
        .withColumn("_q", F.sum("neg").over(running))
        .withColumn("_r", F.row_number().over(inside))
        .join(offsets, ["_range", "_part"])
        .select(
            "score",
            "pos",
            "neg",
            (F.col("_pos_above") + F.col("_p")).alias("cum_pos"),
            (F.col("_neg_above") + F.col("_q")).alias("cum_neg"),
            (F.col("_n_above") + F.col("_r")).alias("rank"),
            "total_pos",
            "total_neg",
            "scores",
        )
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def _f_measure(precision: Column, recall: Column, beta: float) -> Column:
    square = beta * beta
    whole = F.lit(square) * precision + recall
    return F.when(whole > 0, F.lit(1.0 + square) * precision * recall / whole).otherwise(F.lit(0.0))


def threshold_curve(df: DataFrame, score: str = "score", label: str = "label", bins: int = 10, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Precision, recall, F1, F0.5 and ROC coordinates for "score >= threshold", highest threshold first in `point`.

    With `bins`, neighbouring distinct scores are merged into groups of floor(distinct / bins) by global rank, as far
    as that gives groups of two or more; the threshold of a group is its lowest score. bins=0 keeps every score.
    """
    table = score_table(df, score, label, range_rows)
    if bins > 0:
        size = F.floor(F.col("scores") / F.lit(bins))
        group = F.when(size >= 2, F.floor((F.col("rank") - 1) / size)).otherwise(F.col("rank") - 1)
        table = (
            table.groupBy((group + 1).cast("bigint").alias("point"))
            .agg(
                F.min("score").alias("threshold"),
                F.max("cum_pos").alias("tp"),
                F.max("cum_neg").alias("fp"),
                F.first("total_pos").alias("total_pos"),
                F.first("total_neg").alias("total_neg"),
            )
        )
    else:
        table = table.select(
            F.col("rank").cast("bigint").alias("point"),
            F.col("score").alias("threshold"),
            F.col("cum_pos").alias("tp"),
            F.col("cum_neg").alias("fp"),
            "total_pos",
            "total_neg",
        )
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("total_pos"))
    return table.select(
        "point", "threshold", "tp", "fp", precision.alias("precision"), recall.alias("recall"), "total_pos", "total_neg"
    ).select(
        "point",
        "threshold",
        "tp",
        "fp",
        "precision",
        "recall",
        _f_measure(F.col("precision"), F.col("recall"), 1.0).alias("f1"),
        _f_measure(F.col("precision"), F.col("recall"), 0.5).alias("f05"),
        _ratio(F.col("fp"), F.col("total_neg")).alias("fpr"),
    )


def areas(df: DataFrame, score: str = "score", label: str = "label", range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row: areas under the exact ROC and precision-recall curves; null when only one class is present."""
    table = score_table(df, score, label, range_rows)
    pos_before = F.col("cum_pos") - F.col("pos")
    neg_before = F.col("cum_neg") - F.col("neg")
    roc_step = F.col("neg") * (pos_before + F.col("pos") / 2)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    precision_before = F.when(F.col("rank") == 1, precision).otherwise(pos_before / (pos_before + neg_before))
    pr_step = F.col("pos") * (precision + precision_before) / 2
    both = (F.max("total_pos") > 0) & (F.max("total_neg") > 0)
    return table.agg(
        F.when(both, F.sum(roc_step) / (F.max("total_pos") * F.max("total_neg"))).alias("auroc"),
        F.when(both, F.sum(pr_step) / F.max("total_pos")).alias("aupr"),
        F.coalesce(F.max("total_pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.max("total_neg"), F.lit(0)).alias("negatives"),
    )


def best_threshold(df: DataFrame, score: str = "score", label: str = "label", bins: int = 0) -> DataFrame:
    """One row: the highest F1 and its threshold (the highest one among equals)."""
    curve = threshold_curve(df, score, label, bins)
    return curve.agg(
        F.max("f1").alias("max_f1"), F.max_by("threshold", F.struct("f1", "threshold")).alias("threshold")
    )


def confusion(df: DataFrame, prediction: str, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(
    df: DataFrame, prediction: str = "prediction", label: str = "label", groups: Sequence[str] = ()
) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 (each class weighted by its true count), per group if given.

    Everything comes from the confusion counts, a few rows per group. Null groups are groups; a null label is a class of
    its own that no prediction hits.
    """
    groups = list(groups)
    cells = df.groupBy(*groups, F.col(label).alias("_label"), F.col(prediction).alias("_pred")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # Both sides of a class must read the same: 1 and 1.0 are one class.
    kinds = dict(cells.dtypes)
    number = all(kinds[c] not in ("string", "boolean") for c in ("_label", "_pred"))
    label_class, guess_class = (F.col(c).cast("double").cast("string") if number else F.col(c).cast("string") for c in ("_label", "_pred"))
    hit = F.coalesce(label_class == guess_class, F.lit(False))
    nothing = F.lit(0).cast("bigint")
    # Each cell counts once for its true class and once for the guessed one; no join, so null groups and labels stay.
    sides = F.explode(
        F.array(
            F.struct(label_class.alias("c"), F.col("_n").alias("t"), F.when(hit, F.col("_n")).otherwise(nothing).alias("h"), nothing.alias("g")),
            F.struct(guess_class.alias("c"), nothing.alias("t"), nothing.alias("h"), F.col("_n").alias("g")),
        )
    )
    exploded = cells.select(*groups, sides.alias("_s"))
    joined = exploded.groupBy(*groups, F.col("_s.c").alias("_class")).agg(
        F.sum("_s.t").alias("_true"), F.sum("_s.h").alias("_hits"), F.sum("_s.g").alias("_guessed")
    ).where(F.col("_true") > 0)
    precision = F.coalesce(_ratio(F.col("_hits"), F.col("_guessed")), F.lit(0.0))
    recall = F.col("_hits") / F.col("_true")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    rows = F.sum("_true")
    return joined.groupBy(*groups).agg(
        rows.alias("rows"),
        (F.sum("_hits") / rows).alias("accuracy"),
        (F.sum(F.col("_true") * precision) / rows).alias("weighted_precision"),
        (F.sum(F.col("_true") * recall) / rows).alias("weighted_recall"),
        (F.sum(F.col("_true") * f1) / rows).alias("weighted_f1"),
    )


def with_prediction(df: DataFrame, score: str, threshold: float = 0.5, output: str = "prediction") -> DataFrame:
    return df.withColumn(output, (F.col(score) >= F.lit(threshold)).cast("int"))


def error_rate(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    accuracy = F.avg((F.col(prediction) == F.col(label)).cast("double"))
    return df.agg(accuracy.alias("accuracy"), (1.0 - accuracy).alias("error"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "rating") -> DataFrame:
    difference = F.col(prediction) - F.col(label)
    return df.agg(F.sqrt(F.avg(difference * difference)).alias("rmse"))
