"""Recall models and parameter search on small data with a known structure."""

import json
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from rankweave.functions.byte_hash import murmur32, murmur64, murmur128
from rankweave.models import als, embeddings, tuning
from rankweave.operators.similarity import similar_items
from rankweave.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def taste(spark):
    """Two groups of users, each with its own group of items, and a few unseen pairs."""
    rng = random.Random(6)
    rows = [
        (f"u{u}", f"i{i}", 5.0)
        for u in range(20)
        for i in range(20)
        if (u < 10) == (i < 10) and rng.random() < 0.7
    ]
    return spark.createDataFrame(rows, "device_id string, feed_id string, rating double").repartition(3).cache()


@pytest.fixture(scope="module")
def recommender(taste):
    return als.fit_als(taste, rank=3, iterations=5, reg=0.05, implicit=True, blocks=2)


def test_recommendations_stay_in_the_group(recommender):
    rows = recommender.top_items(5).collect()
    assert len(rows) == 100 and {r["rank"] for r in rows} == {1, 2, 3, 4, 5}
    inside = [(int(r["device_id"][1:]) < 10) == (int(r["feed_id"][1:]) < 10) for r in rows]
    assert sum(inside) > 95
    users = recommender.top_users(3).collect()
    assert len(users) == 60 and set(users[0].asDict()) == {"feed_id", "device_id", "score", "rank"}


def test_lists_are_the_best_by_the_factors(recommender):
    factors = [{r["id"]: np.array(r["features"], float) for r in t.collect()} for t in (recommender.model.userFactors, recommender.model.itemFactors)]
    users, items = ({r[0]: r[1] for r in t.collect()} for t in (recommender.users, recommender.items))
    rows = recommender.top_items(4).collect()
    assert dict(recommender.top_items(4).dtypes)["score"] == "float" and len(rows) == 80
    for r in rows:
        scores = sorted((float(factors[0][users[r["device_id"]]] @ v) for v in factors[1].values()), reverse=True)
        own = float(factors[0][users[r["device_id"]]] @ factors[1][items[r["feed_id"]]])
        assert r["score"] == pytest.approx(own, abs=1e-5) and own == pytest.approx(scores[r["rank"] - 1], abs=1e-5)


def test_lists_with_labels(spark, recommender):
    labels = spark.createDataFrame(
        [("u1", ["i2", "i3"]), ("u1", ["i2", "i3"]), ("u2", None), ("unknown", ["i1"])], "device_id string, label array<string>"
    )
    rows = recommender.with_labels(labels, 4).collect()
    assert len(rows) == 1 and len(rows[0]["recommendations"]) == 4 and rows[0]["label"] == ["i2", "i3"]


def test_predictions_leave_out_unknown_ids(spark, recommender):
    pairs = spark.createDataFrame([("u1", "i1"), ("u1", "i15"), ("nobody", "i1")], "device_id string, feed_id string")
    scores = {(r["device_id"], r["feed_id"]): r["prediction"] for r in recommender.predict(pairs).collect()}
    assert set(scores) == {("u1", "i1"), ("u1", "i15")}
    assert scores["u1", "i1"] > scores["u1", "i15"]


def test_scoring_indexed_rows_equals_scoring_names_and_spark(taste):
    tables, rows = als.indexed_ratings(taste.unionByName(taste.limit(1).selectExpr("CAST(null AS STRING) AS device_id", "feed_id", "rating")))
    assert rows.columns == ["device_id_index", "feed_id_index", "rating"] and rows.count() == taste.count()
    found = als.fit_als(rows, rank=3, iterations=3, reg=0.05, tables=tables)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    spark_own = sorted(r["prediction"] for r in found.model.transform(rows).collect())
    assert sorted(r["prediction"] for r in found.predict(rows).collect()) == pytest.approx(spark_own, rel=1e-5)
    by_name = found.predict(taste)
    assert by_name.columns == [*taste.columns, "prediction"] and dict(by_name.dtypes)["prediction"] == "float"
    assert sorted(r["prediction"] for r in by_name.collect()) == pytest.approx(spark_own, rel=1e-5)


def test_search_by_error_reads_narrow_folds(taste, monkeypatch):
    seen, fit = [], als.fit_als
    monkeypatch.setattr(als, "fit_als", lambda rows, *a, **k: seen.append(rows) or fit(rows, *a, **k))
    als.cross_validate_rmse(taste, ranks=(2,), iterations=(1,), folds=3, implicit=False)
    assert len(seen) == 3 and sum(t.count() for t in seen) == 2 * taste.count()
    assert all("device_id" not in t.columns and "Sort" not in t._jdf.queryExecution().executedPlan().toString() for t in seen)


def test_cross_validation(taste):
    found = als.cross_validate(taste, ranks=(2,), iterations=(2, 4), topN=10, top_k=3).collect()
    assert [r["rank"] for r in found] == [2, 2] and found[0]["score"] >= found[1]["score"]
    errors = als.cross_validate_rmse(taste, ranks=(2,), iterations=(2,), implicit=False).collect()
    assert len(errors) == 1 and 0 <= errors[0]["rmse"] < 5


def test_the_search_by_error_covers_the_whole_grid(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(o, o % 7, float(o % 12)) for o in range(40)], "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 5) for o in range(40)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    seen = []

    def fit(rows, user, item, rating, rank, rounds, **_):
        seen.append((rank, rounds))
        return SimpleNamespace(predict=lambda held_out: held_out.withColumn("prediction", F.col("rating") + rank + rounds / 100))

    monkeypatch.setattr(als, "fit_als", fit)
    found = [tuple(r) for r in entry_points.queries()["als_rmse_search"](spark, str(tmp_path)).collect()]
    grid = [(rank, rounds) for rank in (5, 10, 15, 20) for rounds in (5, 10, 20, 30, 50)]
    assert sorted(seen) == sorted(grid * 2)
    assert [r[:2] for r in found] == grid and [r[2] for r in found] == pytest.approx([a + b / 100 for a, b in grid])


def test_blocks_of_factors_grow_with_the_ratings(taste, monkeypatch):
    assert [als.factor_blocks(n, 12) for n in (0, 600_000, 36_000_000, 216_000_000)] == [12, 12, 33, 60]
    seen, plain = [], als.ALS
    monkeypatch.setattr(als, "ALS", lambda **k: seen.append((k["numUserBlocks"], k["numItemBlocks"])) or plain(**k))
    monkeypatch.setattr(als, "RATINGS_A_CUBE", taste.count() / 15**3)
    als.fit_als(taste, rank=2, iterations=1, reg=0.1)
    als.fit_als(als.indexed_ratings(taste)[1], rank=2, iterations=1, reg=0.1, tables=(taste, taste))
    assert seen == [(15, 15)] * 2


def test_embeddings_of_items_seen_together(spark):
    rng = random.Random(2)
    groups = [[f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]]
    lists = [([rng.choice(groups[n % 2]) for _ in range(12)],) for n in range(400)]
    df = spark.createDataFrame(lists, "feeds array<string>")
    vectors = embeddings.train_embeddings(df, "feeds", width=8, min_count=1, iterations=5, partitions=1)
    assert vectors.count() == 12
    near = similar_items(vectors, 3).collect()
    assert sum(r["query_id"][0] == r["item_id"][0] for r in near) > 30


def test_search_grid():
    settings = list(tuning.settings_of(tuning.GRID))
    assert len(settings) == 3 * 4 * 7
    both = list(tuning.settings_of({**tuning.GRID, "optimizer": ("lbfgs",)}))
    assert len(both) == 504


def test_search(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        x = [rng.choice([-1.0, 1.0]) for _ in range(3)]
        rows.append((i, Vectors.dense(x), int(x[0] > 0)))
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    grid = {"iterations": (1, 6), "n_factors": (2,), "reg": ((0.0, 0.0, 0.0),), "corrections": (3,), "optimizer": ("lbfgs",)}
    results = tuning.search(df, ["id"], grid)
    best = tuning.best(results).collect()
    assert results.count() == 2 and len(best) == 1
    assert json.loads(best[0]["setting"])["optimizer"] == "lbfgs" and best[0]["auroc"] > 0.9


def test_checkpoint_folder(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_byte_hash_of_any_length_in_any_batch():
    rng = random.Random(12)
    texts = pa.array(["".join(rng.choice("abcé体") for _ in range(n)) for n in [*range(70), 300, 5000, 5001, 1, 0]])
    many = pa.concat_arrays([texts] * 30)
    for function in (murmur32, murmur64, murmur128):
        together = function(texts, 7).tolist()
        alone = [function(texts.slice(i, 1), 7).tolist()[0] for i in range(len(texts))]
        # Alone, a string goes on by itself from its first block; among many, from where few are left, or never.
        assert together == alone and function(many, 7).tolist() == alone * 30
        assert function(texts.slice(0, 0), 7).tolist() == []


def test_byte_hash_blocks_against_scalar_arithmetic():
    """The 32-bit hash of whole blocks written out in plain integers."""
    def rotate(x, n):
        return ((x << n) | (x >> (32 - n))) & 0xFFFFFFFF

    def scalar(data):
        h = 0
        for i in range(0, len(data), 4):
            k = int.from_bytes(data[i : i + 4], "little")
            k = rotate(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
            h = (rotate(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
        h ^= len(data)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ (h >> shift)) * factor & 0xFFFFFFFF
        h ^= h >> 16
        return h - (1 << 32) if h >= 1 << 31 else h

    texts = ["abcd" * n for n in range(9)] + ["spark sql engine"]
    assert murmur32(pa.array(texts), 0).tolist() == [scalar(t.encode()) for t in texts]


def test_tree_table_equals_the_fitted_model(spark, tmp_path):
    import random

    from pyspark.ml.feature import VectorIndexer
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import DecisionTreeRegressor

    from rankweave.models import tree_table, trees

    rnd = random.Random(4)
    rows = []
    for i in range(300):
        x = [float(rnd.randrange(4)), rnd.uniform(-1, 1), rnd.uniform(-1, 1), 0.0 if rnd.random() < 0.6 else 1.5]
        label = float((x[0] in (1.0, 3.0)) != (x[1] > 0.2))
        rows.append((i, Vectors.dense(x) if i % 2 else Vectors.sparse(4, [(k, v) for k, v in enumerate(x) if v]), label))
    df = spark.createDataFrame(rows, ["id", "raw", "label"])
    df = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(df).transform(df).cache()
    model = trees.boosted_trees(rounds=4, depth=3, sample=1.0).fit(df)
    nodes = tree_table.export_trees(model, str(tmp_path / "model"), spark)
    assert nodes.where("categories is not null").count() and nodes.where("cut is not null").count()
    tree_table.write_trees(nodes, str(tmp_path / "nodes"))
    again = tree_table.TreeTable.of(tree_table.read_trees(spark, str(tmp_path / "nodes")))
    scored = again.score(model.transform(df)).select(
        "trees.*", vector_to_array("predLeaf").cast("array<int>").alias("own"), vector_to_array("gbt_margin")[1].alias("own_margin"), vector_to_array("gbt_probability")[1].alias("own_probability")
    )
    for r in scored.collect():
        assert r["leaves"] == r["own"]
        assert r["margin"] == pytest.approx(r["own_margin"]) and r["probability"] == pytest.approx(r["own_probability"])
    plain = again.score(df.select(vector_to_array("features").alias("features"), "id")).select("id", "trees.margin")
    assert {r["id"]: r["margin"] for r in plain.collect()} == {r["id"]: r["margin"] for r in again.score(df).select("id", "trees.margin").collect()}

    one = DecisionTreeRegressor(maxDepth=2).fit(df)
    single = tree_table.TreeTable.of(tree_table.export_trees(one, str(tmp_path / "one"), spark))
    both = single.score(one.transform(df)).select("trees.margin", "prediction").collect()
    assert all(r["margin"] == pytest.approx(r["prediction"]) for r in both)
    stump = spark.createDataFrame([(0, 1.0, 0, -1, None, None, -1, -1, 0.5, 0)], tree_table.NODE_SCHEMA)
    assert tree_table.TreeTable.of(stump).score(df).select("trees.margin", "trees.leaves").first().asDict() == {"margin": 0.5, "leaves": [0]}
    with pytest.raises(ValueError):
        tree_table.TreeTable.of(nodes.where("node <> 0"))
    odd = spark.createDataFrame([(1, [None, 0.1, 0.1, 0.0]), (2, [float("nan")] * 4)], "id int, features array<double>")
    assert again.score(odd).count() == 2


def test_skip_gram_puts_neighbours_together(spark, monkeypatch):
    import numpy as np

    from rankweave.models import parameter_blocks, skip_gram

    monkeypatch.setattr(parameter_blocks, "BLOCK_VALUES", 64)
    monkeypatch.setattr(parameter_blocks, "SHARE_GROUPS", 2)
    rng = random.Random(2)
    rows = [(g, k, rng.randrange(10) + 10 * (g % 2)) for g in range(80) for k in range(12)]
    positions = spark.createDataFrame(rows, "g int, position long, item int")
    pairs = skip_gram.neighbour_pairs(positions, ["g"], 2)
    assert pairs.count() == 80 * (2 * 11 + 2 * 10)
    random_start = np.random.default_rng(1).uniform(-0.5, 0.5, (40, 9))
    model = skip_gram.train(pairs, 20, width=8, negatives=4, rounds=14, first=parameter_blocks.blocks_of(spark, random_start), group_rows=500)
    assert model.loss_history[-1] < 0.9 * model.loss_history[0]
    vectors = np.array([r["vec"] for r in sorted(model.vectors().collect())])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T
    same = np.equal.outer(np.arange(20) // 10, np.arange(20) // 10)
    assert near[same].mean() > near[~same].mean() + 0.3
    assert model.vectors("context").count() == 20
    with pytest.raises(ValueError):
        skip_gram.train(pairs.limit(0), 20, width=4)
