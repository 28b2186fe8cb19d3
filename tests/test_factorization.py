"""Factorization machines against brute-force sums, and training on separable data."""

import itertools

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rankweave.models import ffm, ffm_table, fm, fm_table
from rankweave.operators.binary_eval import areas


def brute_fm(model, x):
    total = model.intercept + float(model.weights @ x)
    for a, b in itertools.combinations(range(len(x)), 2):
        total += float(model.factors[a] @ model.factors[b]) * x[a] * x[b]
    return total


def test_fm_score_small_example(spark):
    model = fm.FMModel(1.0, np.array([1.0, 2.0]), np.array([[1.0], [3.0]]), "regression")
    df = spark.createDataFrame([(Vectors.dense([1.0, 1.0]),), (Vectors.sparse(2, [], []),)], ["features"])
    assert [r[0] for r in df.select(model.score(F.col("features"))).collect()] == [7.0, 1.0]


def test_fm_score_equals_pair_sum(spark):
    rng = np.random.default_rng(3)
    model = fm.FMModel(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    xs = rng.normal(size=(40, 6)) * (rng.random((40, 6)) < 0.6)
    rows = [
        (i, Vectors.dense(x) if i % 2 else Vectors.sparse(6, [(j, v) for j, v in enumerate(x) if v])) for i, x in enumerate(xs)
    ]
    df = spark.createDataFrame(rows, ["id", "features"])
    direct = {r["id"]: r["s"] for r in df.select("id", model.score(F.col("features"), link=False).alias("s")).collect()}
    table = spark.createDataFrame(
        [(j, float(model.weights[j]), [float(v) for v in model.factors[j]]) for j in range(6)],
        "feature long, w double, v array<double>",
    )
    joined = {r["id"]: r["margin"] for r in fm.score_with_table(df, "id", "features", table, model.intercept).collect()}
    for i, x in enumerate(xs):
        assert direct[i] == pytest.approx(brute_fm(model, x))
        assert joined[i] == pytest.approx(brute_fm(model, x))


def test_fm_save_and_load(spark, tmp_path):
    rng = np.random.default_rng(4)
    model = fm.FMModel(0.5, rng.normal(size=5), rng.normal(size=(5, 2)), "regression", -1.0, 2.0)
    model.save(spark, str(tmp_path / "fm"))
    again = fm.FMModel.load(spark, str(tmp_path / "fm"))
    assert again.intercept == 0.5 and again.task == "regression" and (again.min_target, again.max_target) == (-1.0, 2.0)
    np.testing.assert_array_equal(again.weights, model.weights)
    np.testing.assert_array_equal(again.factors, model.factors)
    table = spark.read.parquet(str(tmp_path / "fm" / "parameters"))
    with pytest.raises(ValueError):
        fm.FMModel.from_table(table, 6, 2, "regression")


@pytest.fixture(scope="module")
def interacting(spark):
    """Labels that depend on a product of two features only, so that a linear model fails."""
    rng = np.random.default_rng(11)
    x = rng.choice([-1.0, 1.0], size=(600, 4))
    label = (x[:, 0] * x[:, 1] > 0).astype(int)
    rows = [(Vectors.dense(v), int(t)) for v, t in zip(x, label)]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(3).cache()


def area(df, model):
    return areas(df.select(model.score(F.col("features")).alias("score"), "label")).first()["auroc"]


def test_gradient_matches_finite_differences(spark, interacting):
    rows = fm.sparse_rows(interacting, "features", "label").cache()
    rng = np.random.default_rng(5)
    base = fm.FMModel(0.1, rng.normal(size=4), rng.normal(size=(4, 2)))
    found = fm._one_pass(rows, base)
    eps = 1e-5
    for kind, index in (("weights", (1,)), ("factors", (2, 1)), ("factors", (0, 0))):
        moved = []
        for sign in (1, -1):
            values = getattr(base, kind).copy()
            values[index] += sign * eps
            args = {"weights": base.weights, "factors": base.factors, kind: values}
            moved.append(fm._one_pass(rows, fm.FMModel(base.intercept, args["weights"], args["factors"])).loss)
        assert getattr(found, kind)[index] == pytest.approx((moved[0] - moved[1]) / (2 * eps), rel=1e-4, abs=1e-7)


def test_sgd_learns_interaction(interacting):
    model = fm.train_sgd(interacting, iterations=40, step_size=2.0, n_factors=3, init_std=0.3, reg=(0, 0, 0), tolerance=0)
    assert model.loss_history[-1] < model.loss_history[0] * 0.7
    assert area(interacting, model) > 0.95


def test_lbfgs_learns_interaction(interacting):
    model = fm.train_lbfgs(interacting, iterations=15, n_factors=3, init_std=0.3, reg=(0, 0, 0))
    assert all(b <= a for a, b in zip(model.loss_history, model.loss_history[1:]))
    assert area(interacting, model) > 0.95


def test_regression_is_clipped(spark, interacting):
    model = fm.train_sgd(interacting, task="regression", iterations=3, n_factors=2)
    low, high = interacting.select(model.score(F.col("features")).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert 0.0 <= low <= high <= 1.0


def brute_ffm(weights, nodes):
    n_features, n_fields, _ = weights.shape
    inside = [n for n in nodes if 0 <= n[0] < n_fields and 0 <= n[1] < n_features]
    return sum(
        2 * float(weights[j1, f2] @ weights[j2, f1]) * v1 * v2
        for (f1, j1, v1), (f2, j2, v2) in itertools.combinations(inside, 2)
    )


NODES = "nodes array<struct<f:int,j:int,v:double>>"


def test_ffm_score(spark):
    rng = np.random.default_rng(8)
    weights = rng.normal(size=(7, 3, 2))
    rows = [
        (i, [(int(rng.integers(0, 4)), int(rng.integers(0, 8)), float(rng.normal())) for _ in range(rng.integers(0, 6))])
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "id int, " + NODES)
    model = ffm.FFMModel(weights)
    scored = {r["id"]: r["s"] for r in df.select("id", model.score(F.col("nodes")).alias("s")).collect()}
    turned = df.select("id", model.score(F.reverse("nodes")).alias("s")).collect()
    for i, nodes in rows:
        assert scored[i] == pytest.approx(brute_ffm(weights, nodes), abs=1e-9)
    for r in turned:
        assert r["s"] == pytest.approx(scored[r["id"]], abs=1e-9)


def test_ffm_small_example(spark):
    weights = np.zeros((2, 2, 1))
    weights[0, 1], weights[1, 0] = 2.0, 3.0
    df = spark.createDataFrame([([(0, 0, 1.0), (1, 1, 1.0)],)], NODES)
    assert df.select(ffm.FFMModel(weights).score(F.col("nodes"))).first()[0] == pytest.approx(12.0)


@pytest.mark.parametrize("solver,step", [("adagrad", 0.3), ("sgd", 0.5)])
def test_ffm_learns(spark, solver, step):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 3, 500), rng.integers(0, 3, 500)
    rows = [([(0, int(x), 1.0), (1, 3 + int(y), 1.0)], 1 if x == y else -1) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, NODES + ", label int").repartition(2).cache()
    model = ffm.train(df, 2, 6, iterations=25, step_size=step, solver=solver, batch_rows=16)
    assert model.loss_history[-1] < model.loss_history[0]
    found = areas(df.select(model.score(F.col("nodes")).alias("score"), (F.col("label") > 0).cast("int").alias("label")))
    assert found.first()["auroc"] > 0.9


def same_model(a, b, tolerance=1e-9):
    np.testing.assert_allclose(a.weights, b.weights, atol=tolerance)
    np.testing.assert_allclose(a.factors, b.factors, atol=tolerance)
    assert a.intercept == pytest.approx(b.intercept, abs=tolerance)


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of a few features and few groups to a share, so that every step has several of them."""
    from rankweave.models import parameter_blocks

    monkeypatch.setattr(parameter_blocks, "BLOCK_VALUES", 8)
    monkeypatch.setattr(parameter_blocks, "SHARE_GROUPS", 3)


def test_table_training_equals_local_training(spark, interacting, small_blocks):
    first = fm.initial_model(4, 3, "classification", 0.3, 1, -np.inf, np.inf)
    start = fm_table.FMTable.of(spark, first)
    settings = {"n_factors": 3, "init_std": 0.3, "reg": (0.1, 0.01, 0.02), "n_features": 4}
    plain = fm.train_sgd(interacting, iterations=3, step_size=2.0, tolerance=0, seed=1, **settings)
    found = fm_table.train_sgd(interacting, iterations=3, step_size=2.0, tolerance=0, first=start, group_rows=40, **settings)
    np.testing.assert_allclose(found.loss_history, plain.loss_history)
    same_model(found.local(), plain)
    plain = fm.train_lbfgs(interacting, iterations=6, corrections=2, seed=1, **settings)
    found = fm_table.train_lbfgs(interacting, iterations=6, corrections=2, first=start, group_rows=100, **settings)
    np.testing.assert_allclose(found.loss_history, plain.loss_history)
    same_model(found.local(), plain, 1e-7)
    scored = found.score(interacting.withColumn("id", F.monotonically_increasing_id()), "id")
    assert scored.count() == interacting.count()


def test_table_models_of_wide_sparse_rows(spark):
    rows = [(i, Vectors.sparse(1_000_000, [3, 999_998 + i % 2], [1.0, 2.0]), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    model = fm_table.train_sgd(df, n_factors=1, iterations=4, step_size=1.0, n_features=1_000_000, init_std=0.01)
    assert model.loss_history[-1] < model.loss_history[0]
    by_label = {r["id"] % 2: r["score"] for r in model.score(df, "id").collect()}
    assert by_label[0] < 0.5 < by_label[1]
    with pytest.raises(ValueError):
        fm_table.train_sgd(df.limit(0), n_factors=1)


def test_parameter_table_of_blocks_and_back(spark, small_blocks):
    values = [("intercept", 0, 0, 0.5), ("weight", 0, 3, 1.0), ("weight", 0, 8, -3.0), ("factor", 1, 3, 2.0), ("factor", 0, 9, 0.5)]
    parameters = spark.createDataFrame(values, fm.PARAMETER_SCHEMA)
    model = fm_table.FMTable.from_parameters(parameters, 10, 2)
    assert model.local().weights.tolist() == [0, 0, 0, 1.0, 0, 0, 0, 0, -3.0, 0]
    whole = model.parameter_table()
    assert whole.count() == 1 + 10 * 3
    assert sorted(map(tuple, whole.where("value <> 0").collect())) == sorted(values)
    again = fm.FMModel.from_table(whole, 10, 2, "classification")
    same_model(again, model.local(), 0)
    with pytest.raises(Exception, match="beyond"):
        fm_table.FMTable.from_parameters(parameters, 8, 2)


def test_table_regression_and_features_outside(spark, interacting):
    found = fm_table.train_sgd(interacting, task="regression", iterations=2, n_factors=2)
    low, high = found.score(interacting.withColumn("id", F.monotonically_increasing_id()), "id").agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= low <= high <= 1.0
    with pytest.raises(Exception, match="outside"):
        fm_table.train_sgd(interacting, n_features=2, n_factors=2, iterations=1)


def test_two_loops_equal_the_usual_recursion():
    rng = np.random.default_rng(3)
    s, y, g = rng.normal(size=(3, 9)), rng.normal(size=(3, 9)), rng.normal(size=9)
    basis = np.concatenate([s, y, g[None]])
    q, used = g.copy(), []
    for i in reversed(range(3)):
        a = (s[i] @ q) / (s[i] @ y[i])
        q -= a * y[i]
        used.append((i, a))
    q *= (s[2] @ y[2]) / (y[2] @ y[2])
    for i, a in reversed(used):
        q += s[i] * (a - (y[i] @ q) / (s[i] @ y[i]))
    np.testing.assert_allclose(fm_table.two_loops(basis @ basis.T, 3) @ basis, -q)
    np.testing.assert_allclose(fm_table.two_loops(np.array([[4.0]]), 0), [-1.0])


@pytest.mark.parametrize("solver,step", [("adagrad", 0.3), ("sgd", 0.5)])
def test_ffm_table_learns_and_scores(spark, solver, step, small_blocks):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 3, 300), rng.integers(0, 3, 300)
    rows = [(i, [(0, int(x), 1.0), (1, 3 + int(y), 1.0), (9, 9, 1.0)], 1 if x == y else -1) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame([*rows, (300, [], 1), (301, [(7, 0, 1.0)], -1)], "id int, " + NODES + ", label int").repartition(2).cache()
    model = ffm_table.train(df, 2, 6, iterations=6, step_size=step, solver=solver, batch_rows=16, group_rows=120)
    assert model.loss_history[-1] < model.loss_history[0]
    local = model.local()
    joined = model.score(df, "id").join(df.select("id", local.score(F.col("nodes")).alias("own")), "id").collect()
    assert len(joined) == 302 and all(r["score"] == pytest.approx(r["own"], abs=1e-12) for r in joined)
    # One group and one pass is what a single partition of the local training does.
    first = ffm_table.FFMTable.of(spark, 0.5 / np.sqrt(4) * np.random.default_rng(12345).random((6, 2, 4)))
    one = df.coalesce(1).sortWithinPartitions("id")
    found = ffm_table.train(one, 2, 6, iterations=2, step_size=step, solver=solver, batch_rows=16, first=first, group_rows=10_000)
    plain = ffm.train(one, 2, 6, iterations=2, step_size=step, solver=solver, batch_rows=16)
    np.testing.assert_allclose(found.loss_history, plain.loss_history)
    np.testing.assert_allclose(found.local().weights, plain.weights)
