"""Parameter search for factorization machines, and its report."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.models import fm
from rankweave.operators.binary_eval import areas, classification_report
from rankweave.operators.cleaning import stable_split

# The default search space, 3 * 4 * 7 * 6 * 1 = 504 settings. The number of corrections matters to L-BFGS
# only; settings that train the same model are tried once.
GRID: Mapping[str, Sequence] = {
    "iterations": (100, 200, 300),
    "n_factors": (2, 4, 6, 8),
    "reg": tuple((0.0, 0.0, r) for r in (0.1, 0.2, 0.3, 0.5, 0.8, 1.0, 1.2)),
    "corrections": (4, 5, 6, 7, 8, 9),
    "optimizer": ("sgd",),
}


def settings_of(grid: Mapping[str, Sequence]) -> Iterable[dict]:
    """Points of the grid without repeats of the same training run."""
    names, seen = list(grid), set()
    for values in itertools.product(*grid.values()):
        setting = dict(zip(names, values))
        if setting.get("optimizer", "lbfgs") != "lbfgs":
            setting.pop("corrections", None)
        key = json.dumps(setting, sort_keys=True)
        if key not in seen:
            seen.add(key)
            yield setting


def train(df: DataFrame, setting: Mapping, features: str, label: str, seed: int) -> fm.FMModel:
    options = {k: v for k, v in setting.items() if k not in ("optimizer", "corrections")}
    if setting.get("optimizer", "lbfgs") == "lbfgs":
        return fm.train_lbfgs(df, features, label, corrections=setting.get("corrections", 5), seed=seed, **options)
    return fm.train_sgd(df, features, label, seed=seed, **options)


def search(
    df: DataFrame,
    keys: Sequence[str],
    grid: Mapping[str, Sequence] = GRID,
    features: str = "features",
    label: str = "label",
    train_share: float = 0.8,
    seed: int = 12345,
) -> DataFrame:
    """(setting JSON, weighted_f1, accuracy, auroc, loss) per grid point, best first.

    All settings see the same split, chosen by a hash of `keys`, so their results can be compared.
    """
    training, held_out = stable_split(df, [train_share, 1.0 - train_share], keys)
    training, held_out = training.persist(), held_out.persist()
    rows = []
    try:
        for setting in settings_of(grid):
            model = train(training, setting, features, label, seed)
            scored = held_out.select(
                F.col(label).cast("int").alias("label"), model.score(F.col(features)).alias("score")
            )
            scored = scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int")).persist()
            report = classification_report(scored).first()
            area = areas(scored).first()
            scored.unpersist()
            rows.append(
                (
                    json.dumps(setting, sort_keys=True),
                    report["weighted_f1"],
                    report["accuracy"],
                    area["auroc"],
                    float(model.loss_history[-1]),
                )
            )
    finally:
        training.unpersist()
        held_out.unpersist()
    schema = "setting string, weighted_f1 double, accuracy double, auroc double, loss double"
    return df.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("weighted_f1"), "setting")


def best(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("weighted_f1"), "setting").limit(1)
