"""Whole ranking models on a small log: fit, evaluate, save, load."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankweave.models.feature_stages import FeatureSet, TagUnion
from rankweave.models.rankers import (
    FactorizationRanker,
    LinearRanker,
    TreeFactorizationRanker,
    TreeLinearRanker,
    TreeRanker,
    evaluate,
)

FEATURES = FeatureSet(
    tags={"tags": 50},
    positive_tags={"interests": 40},
    unions={"all_tags": TagUnion(["tags", "interests"], [5, 5], [False, True], 60)},
    key_values={"income": ["1", "2", "3"]},
    one_hot={"kind": ["1", "3"]},
    thresholds={"age": [0, 10, 20, 30]},
    buckets={"ctr": [0.2, 0.5]},
    numbers=["ctr"],
    products={"kind_by_age": ["kind", "age"]},
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(400):
        tag = rng.choice(["sport", "news", "music"])
        interest = rng.choice(["sport", "news", "music"])
        label = int((tag == interest) != (rng.random() < 0.05))
        data.append((i, tag, f"{interest}:{rng.choice([1, 2])}", f"{rng.randint(1, 3)}:0.5", rng.choice([1, 3]), float(rng.randint(0, 29)), rng.random(), label))
    return spark.createDataFrame(
        data, "id int, tags string, interests string, income string, kind int, age double, ctr double, label int"
    ).cache()


def test_feature_set_width(rows):
    df = rows
    for stage in FEATURES.stages():
        df = stage.transform(df)
    width = 50 + 40 + 60 + 3 + 2 + 3 + 1 + 1 + 2 * 3
    vectors = df.select("features", "label").collect()
    assert all(r["features"].size == width for r in vectors)
    with pytest.raises(ValueError):
        FeatureSet(numbers=["a"], products={"p": ["a", "zz"]}).stages()
    with pytest.raises(ValueError):
        FeatureSet().stages()


def rankers():
    return {
        "trees": TreeRanker(FEATURES.stages(), rounds=3, depth=3),
        "linear": LinearRanker(FEATURES.stages(), reg=0.01),
        "tree_linear": TreeLinearRanker(FEATURES.stages(), rounds=2, depth=3, other_features=["features"], reg=0.01),
        "fm": FactorizationRanker(FEATURES.stages(), iterations=4, n_factors=3, optimizer="lbfgs", init_std=0.2),
        "tree_fm": TreeFactorizationRanker(FEATURES.stages(), rounds=2, depth=2, iterations=4, n_factors=2, step_size=1.0),
    }


@pytest.mark.parametrize("name", ["trees", "linear", "tree_linear", "fm", "tree_fm"])
def test_ranker(spark, rows, tmp_path, name):
    ranker = rankers()[name].fit(rows)
    found = evaluate(ranker, rows)
    area = found["areas"].first()["auroc"]
    assert area > 0.55
    assert found["report"].first()["rows"] == 400
    assert found["slices"].count() == 2 and found["curve"].count() >= 1
    ranker.save(spark, str(tmp_path / name))
    again = rankers()[name].load(spark, str(tmp_path / name))
    first = {r["id"]: r["score"] for r in ranker.transform(rows).select("id", "score").collect()}
    second = {r["id"]: r["score"] for r in again.transform(rows).select("id", "score").collect()}
    assert first == pytest.approx(second)
    if name == "trees":
        leaves = ranker.transform(rows).select(F.size(vector_to_array("predLeaf"))).distinct().collect()
        assert [r[0] for r in leaves] == [3]
