"""Factorization machines: scoring, and training by gradient descent or L-BFGS.

This is the form for models that fit one machine: rows stay on the executors, each pass ships the parameters out, every
partition sums its gradient over Arrow batches and emits only the features it has seen, and Spark adds the partial sums up
per feature. `fm_table` has the same training, losses and scores with the parameters as a table of any width.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models.batches import SparseBatch, flat_list, read_batches, sparse_rows, vector_parts

FORMAT_CLASS = "rankweave.FactorizationMachine"
FORMAT_VERSION = "1.0"
PARAMETER_SCHEMA = "kind string, factor int, feature long, value double"


def log_loss(margin: np.ndarray, sign: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -sign * margin)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class FMModel:
    """Parameters of a second-order factorization machine over `len(weights)` features."""

    intercept: float
    weights: np.ndarray
    factors: np.ndarray  # features x factors
    task: str = "classification"
    min_target: float = -math.inf
    max_target: float = math.inf
    loss_history: list[float] = field(default_factory=list)

    def __post_init__(self):
        if self.task not in ("classification", "regression"):
            raise ValueError(f"unknown task {self.task!r}")
        if len(self.weights) != len(self.factors):
            raise ValueError(f"{len(self.weights)} weights do not fit {len(self.factors)} factor rows")

    @property
    def n_features(self) -> int:
        return len(self.weights)

    @property
    def n_factors(self) -> int:
        return self.factors.shape[1]

    def margins(self, batch: SparseBatch) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of a batch, and the per-factor sums that the gradient needs again."""
        sums = np.empty((batch.size, self.n_factors))
        squares = np.zeros(batch.size)
        for f in range(self.n_factors):
            part = self.factors[batch.feature, f] * batch.value
            sums[:, f] = np.bincount(batch.row, part, batch.size)
            squares += np.bincount(batch.row, part * part, batch.size)
        linear = np.bincount(batch.row, self.weights[batch.feature] * batch.value, batch.size)
        return self.intercept + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, features: Column, link: bool = True) -> Column:
        """Score of a vector column: probability of class 1, or the clipped regression value; raw with link=False."""
        model = self

        @F.arrow_udf("double")
        def scored(indices: pa.Array, values: pa.Array) -> pa.Array:
            feature, row = flat_list(indices)
            value, _ = flat_list(values)
            margin, _ = model.margins(SparseBatch(np.zeros(len(indices)), row, feature.astype(np.int64), value.astype(np.float64)))
            if not link:
                return pa.array(margin)
            if model.task == "regression":
                return pa.array(np.clip(margin, model.min_target, model.max_target))
            return pa.array(sigmoid(margin))

        return scored(*vector_parts(features))

    def transform(self, df: DataFrame, features: str = "features", threshold: float = 0.5) -> DataFrame:
        """Append `prediction`, and for classification also `probability` as [1 - p, p]."""
        if self.task == "regression":
            return df.withColumn("prediction", self.score(F.col(features)))
        scored = df.withColumn("_p", self.score(F.col(features)))
        p = F.col("_p")
        return scored.select(
            *df.columns,
            F.array(1.0 - p, p).alias("probability"),
            (p >= F.lit(threshold)).cast("double").alias("prediction"),
        )

    def parameter_table(self, spark: SparkSession) -> DataFrame:
        """(kind, factor, feature, value): one row per parameter."""
        n, k = self.factors.shape
        table = pa.table(
            {
                "kind": ["intercept"] + ["weight"] * n + ["factor"] * (n * k),
                "factor": np.concatenate([[0], np.zeros(n), np.repeat(np.arange(k), n)]).astype(np.int32),
                "feature": np.concatenate([[0], np.arange(n), np.tile(np.arange(n), k)]).astype(np.int64),
                "value": np.concatenate([[self.intercept], self.weights, self.factors.T.reshape(-1)]),
            }
        )
        return spark.createDataFrame(table, PARAMETER_SCHEMA)

    def metadata(self) -> dict:
        bounded = {"min_target": self.min_target, "max_target": self.max_target}
        return {
            "class": FORMAT_CLASS,
            "version": FORMAT_VERSION,
            "task": self.task,
            "features": self.n_features,
            "factors": self.n_factors,
            **{name: (value if math.isfinite(value) else None) for name, value in bounded.items()},
        }

    def save(self, spark: SparkSession, path: str) -> None:
        """`path/metadata` holds one JSON line, `path/parameters` the parameter table ordered by its key."""
        line = spark.createDataFrame([(json.dumps(self.metadata()),)], "value string")
        line.write.mode("overwrite").text(f"{path}/metadata")
        table = self.parameter_table(spark).sort("kind", "factor", "feature")
        table.write.mode("overwrite").parquet(f"{path}/parameters")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FMModel:
        meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        if meta.get("class") != FORMAT_CLASS or meta.get("version") != FORMAT_VERSION:
            raise ValueError(f"{path} holds {meta.get('class')} version {meta.get('version')}")
        return cls.from_table(
            spark.read.schema(PARAMETER_SCHEMA).parquet(f"{path}/parameters"),
            meta["features"],
            meta["factors"],
            meta["task"],
            -math.inf if meta["min_target"] is None else meta["min_target"],
            math.inf if meta["max_target"] is None else meta["max_target"],
        )

    @classmethod
    def from_table(
        cls, table: DataFrame, features: int, factors: int, task: str, min_target=-math.inf, max_target=math.inf
    ) -> FMModel:
        """Read back a parameter table; its size must fit the stated dimensions."""
        found = table.toArrow()
        expected = 1 + features + features * factors
        if found.num_rows != expected:
            raise ValueError(f"{found.num_rows} parameters found, {expected} expected")
        weights, matrix = np.zeros(features), np.zeros((features, factors))
        kind = found["kind"].combine_chunks().dictionary_encode()
        names, kind = kind.dictionary.to_pylist(), kind.indices.to_numpy()
        factor, feature, value = (found[c].to_numpy() for c in ("factor", "feature", "value"))
        linear, cross, head = (kind == (names.index(name) if name in names else -1) for name in ("weight", "factor", "intercept"))
        weights[feature[linear]] = value[linear]
        matrix[feature[cross], factor[cross]] = value[cross]
        return cls(float(value[head][0]), weights, matrix, task, min_target, max_target)


def score_with_table(df: DataFrame, key: str, features: str, weights: DataFrame, intercept: float = 0.0) -> DataFrame:
    """(key, margin) by joining features with a parameter table; nothing model-sized leaves the executors.

    `weights` has (feature, w, v array<double>), one row per feature. The active features of all rows are joined with
    it (broadcast or shuffled, by its measured size; a feature present in most rows is split by adaptive execution) and
    summed back per row with map-side combining. For feature spaces too wide for `FMModel`.
    """
    indices, values = vector_parts(F.col(features))
    active = df.select(key, F.explode(F.arrays_zip(indices.alias("feature"), values.alias("x"))).alias("e")).select(
        key, F.col("e.feature").cast("bigint").alias("feature"), F.col("e.x").alias("x")
    )
    width = len(weights.select("v").first()["v"])
    joined = active.join(weights, "feature")
    terms = [F.col("v")[f] * F.col("x") for f in range(width)]
    sums = [F.sum(t).alias(f"s{f}") for f, t in enumerate(terms)]
    squares = [F.sum(t * t).alias(f"q{f}") for f, t in enumerate(terms)]
    totals = joined.groupBy(key).agg(F.sum(F.col("w") * F.col("x")).alias("linear"), *sums, *squares)
    cross = F.lit(0.0)
    for f in range(width):
        cross = cross + F.col(f"s{f}") * F.col(f"s{f}") - F.col(f"q{f}")
    scored = totals.select(key, (F.lit(intercept) + F.col("linear") + F.lit(0.5) * cross).alias("margin"))
    return df.select(key).join(scored, key, "left").select(key, F.coalesce("margin", F.lit(intercept)).alias("margin"))


def gradient(model: FMModel, batch: SparseBatch) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Summed over the rows of a batch: loss, and its gradient by intercept, weights and factors."""
    n, k = model.factors.shape
    margin, sums = model.margins(batch)
    if model.task == "regression":
        slope = margin - batch.label
        loss = 0.5 * slope * slope
    else:
        sign = np.where(batch.label > 0, 1.0, -1.0)
        slope = -sign * sigmoid(-sign * margin)
        loss = log_loss(margin, sign)
    pull = slope[batch.row] * batch.value
    cross = np.empty((n, k))
    for f in range(k):
        own = model.factors[batch.feature, f] * batch.value
        cross[:, f] = np.bincount(batch.feature, pull * (sums[batch.row, f] - own), n)
    return float(loss.sum()), float(slope.sum()), np.bincount(batch.feature, pull, n), cross


@dataclass
class _Pass:
    """Result of one pass over the data: mean loss and mean gradient."""

    rows: int
    loss: float
    intercept: float
    weights: np.ndarray
    factors: np.ndarray


def _one_pass(rows: DataFrame, model: FMModel) -> _Pass:
    n, k = model.factors.shape
    # Plain arrays: a broadcast is unpickled by reference, and executors may not have this package.
    task = model.task
    shared = rows.sparkSession.sparkContext.broadcast((model.intercept, model.weights, model.factors))
    sums_of = ["rows", "loss", "g", *[f"v{f}" for f in range(k)]]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = FMModel(*shared.value, task)
        touched = np.zeros(n, dtype=bool)
        linear, cross = np.zeros(n), np.zeros((n, k))
        count, loss_sum, slope_sum = 0, 0.0, 0.0
        for batch in read_batches(batches, n):
            loss, slope, *sums = gradient(m, batch)
            count, loss_sum, slope_sum = count + batch.size, loss_sum + loss, slope_sum + slope
            touched[batch.feature] = True
            linear += sums[0]
            cross += sums[1]
        seen = np.flatnonzero(touched)
        # Feature -1 carries the totals of the partition: rows, loss and the gradient of the intercept.
        none = np.zeros(len(seen))
        arrays = [
            np.append(seen, -1).astype(np.int64),
            np.append(none, float(count)),
            np.append(none, loss_sum),
            np.append(linear[seen], slope_sum),
            *[np.append(cross[seen, f], 0.0) for f in range(k)],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in arrays], names=["feature", *sums_of])

    parts = rows.mapInArrow(partial, "feature long, " + ", ".join(f"{c} double" for c in sums_of))
    pdf = parts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in sums_of]).toPandas()
    shared.destroy()
    head, body = pdf[pdf["feature"] == -1], pdf[pdf["feature"] >= 0]
    count = int(head["rows"].sum())
    if count == 0:
        raise ValueError("no training rows")
    at = body["feature"].to_numpy()
    linear, cross = np.zeros(n), np.zeros((n, k))
    linear[at] = body["g"] / count
    cross[at] = body[[f"v{f}" for f in range(k)]].to_numpy() / count
    return _Pass(count, head["loss"].iloc[0] / count, head["g"].iloc[0] / count, linear, cross)


def initial_model(
    n_features: int, n_factors: int, task: str, init_std: float, seed: int, min_target: float, max_target: float
) -> FMModel:
    rng = np.random.default_rng(seed)
    factors = rng.normal(0.0, init_std, (n_features, n_factors))
    return FMModel(0.0, np.zeros(n_features), factors, task, min_target, max_target)


def _prepare(df: DataFrame, features: str, label: str, n_features: int | None, task: str):
    """Cached sparse rows, the feature count, and the label range for clipping."""
    rows = sparse_rows(df, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    facts = rows.agg(
        F.max(F.array_max("indices")).alias("top"), F.min("label").alias("low"), F.max("label").alias("high")
    ).first()
    if facts["low"] is None:
        raise ValueError("no training rows")
    width = n_features if n_features is not None else int(facts["top"] or 0) + 1
    low, high = (facts["low"], facts["high"]) if task == "regression" else (-math.inf, math.inf)
    return rows, width, low, high


def train_sgd(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    task: str = "classification",
    iterations: int = 100,
    step_size: float = 0.15,
    fraction: float = 1.0,
    n_factors: int = 6,
    use_intercept: bool = True,
    use_linear: bool = True,
    reg: tuple[float, float, float] = (0.0, 0.0, 0.0),
    init_std: float = 0.1,
    n_features: int | None = None,
    seed: int = 12345,
    tolerance: float = 0.001,
) -> FMModel:
    """Gradient descent with step `step_size / sqrt(t)` and separate regularisation of intercept, weights, factors.

    `fraction` < 1 uses a fresh sample of the rows in each step; the default uses all of them.
    """
    rows, width, low, high = _prepare(df, features, label, n_features, task)
    model = initial_model(width, n_factors, task, init_std, seed, low, high)
    try:
        for t in range(1, iterations + 1):
            used = rows if fraction >= 1.0 else rows.sample(False, fraction, seed + t)
            found = _one_pass(used, model)
            step = step_size / math.sqrt(t)
            change_w = step * (found.weights + reg[1] * model.weights) if use_linear else np.zeros(width)
            change_v = step * (found.factors + reg[2] * model.factors)
            change_0 = step * (found.intercept + reg[0] * model.intercept) if use_intercept else 0.0
            model = FMModel(
                model.intercept - change_0,
                model.weights - change_w,
                model.factors - change_v,
                task,
                low,
                high,
                [*model.loss_history, found.loss],
            )
            moved = math.sqrt(change_0**2 + (change_w**2).sum() + (change_v**2).sum())
            size = math.sqrt(model.intercept**2 + (model.weights**2).sum() + (model.factors**2).sum())
            if moved < tolerance * max(size, 1.0):
                break
    finally:
        rows.unpersist()
    return model


def train_lbfgs(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    task: str = "classification",
    iterations: int = 20,
    corrections: int = 5,
    n_factors: int = 6,
    use_intercept: bool = True,
    use_linear: bool = True,
    reg: tuple[float, float, float] = (0.0, 0.0, 0.0),
    init_std: float = 0.1,
    n_features: int | None = None,
    seed: int = 12345,
    tolerance: float = 1e-4,
) -> FMModel:
    """Limited-memory BFGS with `corrections` curvature pairs on the regularised mean loss.

    Every evaluation is one distributed pass; only parameter vectors are combined on the driver.
    """
    rows, width, low, high = _prepare(df, features, label, n_features, task)
    start = initial_model(width, n_factors, task, init_std, seed, low, high)
    scale = np.concatenate([[reg[0]], np.full(width, reg[1]), np.full(width * n_factors, reg[2])])
    mask = np.concatenate(
        [[float(use_intercept)], np.full(width, float(use_linear)), np.ones(width * n_factors)]
    )

    def pack(intercept, weights, factors) -> np.ndarray:
        return np.concatenate([[intercept], weights, factors.reshape(-1)])

    def unpack(x: np.ndarray, history=()) -> FMModel:
        return FMModel(
            float(x[0]), x[1 : 1 + width], x[1 + width :].reshape(width, n_factors), task, low, high, list(history)
        )

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        found = _one_pass(rows, unpack(x))
        gradient = pack(found.intercept, found.weights, found.factors) + scale * x
        return found.loss + 0.5 * float((scale * x * x).sum()), gradient * mask

    def direction(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        q = gradient.copy()
        used = []
        for s, y in reversed(pairs):
            rho = 1.0 / (s @ y)
            a = rho * (s @ q)
            q -= a * y
            used.append((s, y, rho, a))
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for s, y, rho, a in reversed(used):
            q += s * (a - rho * (y @ q))
        return -q

    try:
        x = pack(start.intercept, start.weights, start.factors)
        loss, gradient = evaluate(x)
        history, pairs = [loss], []
        for _ in range(iterations):
            along = direction(gradient, pairs)
            slope = float(gradient @ along)
            if slope >= 0:
                pairs, along = [], -gradient
                slope = float(gradient @ along)
            step = 1.0 if pairs else 1.0 / max(1.0, float(np.linalg.norm(gradient)))
            for _ in range(12):
                trial = x + step * along
                trial_loss, trial_gradient = evaluate(trial)
                if trial_loss <= loss + 1e-4 * step * slope:
                    break
                step *= 0.5
            else:
                break
            s, y = trial - x, trial_gradient - gradient
            if s @ y > 1e-10:
                pairs = [*pairs, (s, y)][-corrections:]
            gain = loss - trial_loss
            x, loss, gradient = trial, trial_loss, trial_gradient
            history.append(loss)
            if gain <= tolerance * max(abs(loss), 1.0) * 0.01 or np.linalg.norm(gradient) < tolerance:
                break
        return unpack(x, history)
    finally:
        rows.unpersist()
