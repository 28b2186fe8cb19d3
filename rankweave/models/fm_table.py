"""Factorization machines whose parameters are a table of feature blocks: any width, nothing model-sized in one place.

Feature ids are shifted by one: id 0 carries the intercept in its first number. Each other id has its weight and its
factors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models.batches import flat_list, vector_parts
from rankweave.models.fm import PARAMETER_SCHEMA, FMModel, gradient
from rankweave.models.batches import SparseBatch
from rankweave.models.parameter_blocks import GroupedRows, block_features, blocks_of, collect_blocks, initial_blocks, map_blocks
from rankweave.session import cut_lineage


@dataclass
class FMTable:
    """A model as (block, x). `n_features` features with `n_factors` factors each."""

    blocks: DataFrame
    n_features: int
    n_factors: int
    task: str = "classification"
    min_target: float = -math.inf
    max_target: float = math.inf
    loss_history: list[float] = field(default_factory=list)

    @classmethod
    def of(cls, spark: SparkSession, model: FMModel) -> FMTable:
        """A model that the caller holds, as a table."""
        head = np.zeros((1, model.n_factors + 1))
        head[0, 0] = model.intercept
        values = np.concatenate([head, np.column_stack([model.weights, model.factors])])
        return cls(blocks_of(spark, values), model.n_features, model.n_factors, model.task, model.min_target, model.max_target, list(model.loss_history))

    def local(self) -> FMModel:
        """The model as arrays on the driver: for models that the caller knows to fit there."""
        x = collect_blocks(self.blocks, self.n_factors + 1)
        return FMModel(float(x[0, 0]), x[1:, 0].copy(), x[1:, 1:].copy(), self.task, self.min_target, self.max_target, list(self.loss_history))

    def parameter_table(self) -> DataFrame:
        """(kind, factor, feature, value): one row per parameter, as `FMModel.parameter_table` has them."""
        width, size = self.n_factors + 1, block_features(self.n_factors + 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, packed in zip(batch.column("block").to_pylist(), batch.column("x").to_pylist(), strict=True):
                    x = np.frombuffer(packed, np.float64).reshape(-1, width)
                    ids = block * size + np.arange(len(x))
                    if block == 0:
                        yield pa.record_batch([pa.array(["intercept"]), pa.array([0], pa.int32()), pa.array([0]), pa.array(x[:1, 0])], names=["kind", "factor", "feature", "value"])
                        x, ids = x[1:], ids[1:]
                    for k in range(width):
                        kind = pa.array(["factor" if k else "weight"] * len(x), pa.string())
                        yield pa.record_batch([kind, pa.array(np.full(len(x), max(k - 1, 0), np.int32)), pa.array(ids - 1), pa.array(np.ascontiguousarray(x[:, k]))], names=["kind", "factor", "feature", "value"])

        return self.blocks.mapInArrow(run, PARAMETER_SCHEMA)

    @classmethod
    def from_parameters(cls, table: DataFrame, n_features: int, n_factors: int, task: str = "classification", min_target: float = -math.inf, max_target: float = math.inf) -> FMTable:
        """The model of a parameter table; a parameter that is not in it is 0. Rows are grouped by block where they are."""
        width, size = n_factors + 1, block_features(n_factors + 1)
        last = n_features + 1
        id = F.when(F.col("kind") == "intercept", F.lit(0)).otherwise(F.col("feature") + 1).cast("long")
        column = F.when(F.col("kind") == "factor", F.col("factor") + 1).otherwise(F.lit(0)).cast("int")
        cells = table.select(id.alias("id"), column.alias("k"), "value").withColumn("block", F.expr(f"id div {size}"))
        empty = table.sparkSession.range(-(-last // size)).select(F.col("id").alias("block"))

        def pack(known: pa.Table, found: pa.Table) -> pa.Table:
            if not known.num_rows:
                raise ValueError(f"parameters of features beyond {n_features}")
            block = known["block"][0].as_py()
            x = np.zeros((min(size, last - block * size), width))
            ids = found["id"].to_numpy() - block * size
            if len(ids) and ids.max() >= len(x):
                raise ValueError(f"parameters of features beyond {n_features}")
            x[ids, found["k"].to_numpy()] = found["value"].to_numpy()
            return pa.table([known["block"], pa.array([x.tobytes()], pa.binary())], names=["block", "x"])

        packed = empty.groupBy("block").cogroup(cells.groupBy("block")).applyInArrow(pack, "block long, x binary")
        return cls(cut_lineage(packed), n_features, n_factors, task, min_target, max_target)

    def score(self, df: DataFrame, key: str, features: str = "features", link: bool = True) -> DataFrame:
        """(key, score) of every row of `df`: as `FMModel.score`, for a model of any size."""
        rows = GroupedRows.deal(_thin(df.select(F.col(key).alias("key"), F.col(features).alias("features"), F.lit(0.0).alias("label")), "features", "label", ["key"]), "ids", self.n_factors + 1, extra=(0,))
        model = (self.n_factors, self.task, self.min_target, self.max_target)

        def run(table: pa.Table, ids: np.ndarray, x: np.ndarray) -> pa.Table:
            if not table.num_rows:
                return table.select(["key"]).append_column("score", pa.array([], pa.float64()))
            local, batch = _compact(table, ids, x, *model)
            margin, _ = local.margins(batch)
            if link:
                margin = np.clip(margin, local.min_target, local.max_target) if local.task == "regression" else 0.5 * (1 + np.tanh(0.5 * margin))
            return table.select(["key"]).append_column("score", pa.array(margin))

        try:
            kind = dict(df.select(key).dtypes)[key]
            scored = cut_lineage(rows.with_parameters(self.blocks, run, f"key {kind}, score double"))
        finally:
            rows.release()
        return scored.withColumnRenamed("key", key)


def _thin(df: DataFrame, features: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(label, ids, values, kept): the features of a vector column, shifted by one."""
    indices, values = vector_parts(F.col(features))
    return df.select(F.col(label).cast("double").alias("label"), F.transform(indices, lambda i: i.cast("long") + 1).alias("ids"), values.alias("values"), *keep)


def _compact(table: pa.Table, ids: np.ndarray, x: np.ndarray, n_factors: int, task: str, low: float, high: float) -> tuple[FMModel, SparseBatch]:
    """A model over a group's features alone, and the group's rows with their numbers in it."""
    feature, row = flat_list(table["ids"].combine_chunks())
    value, _ = flat_list(table["values"].combine_chunks())
    batch = SparseBatch(table["label"].to_numpy(), row, np.searchsorted(ids, feature), value.astype(np.float64))
    # The first id is 0, whose first number is the intercept; no row names it.
    return FMModel(float(x[0, 0]), x[:, 0], x[:, 1:], task, low, high), batch


def _local(n_factors: int, task: str):
    def run(table: pa.Table, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, int, float]:
        model, batch = _compact(table, ids, x, n_factors, task, -math.inf, math.inf)
        loss, slope, linear, cross = gradient(model, batch)
        total = np.column_stack([linear, cross])
        total[0] = 0.0
        total[0, 0] = slope
        return total, batch.size, loss

    return run


def _scales(block: int, rows: int, width: int, first: float, weight: float, factor: float) -> np.ndarray:
    """One number for each parameter of a block: for the intercept, weights and factors."""
    out = np.full((rows, width), factor)
    out[:, 0] = weight
    if block == 0:
        out[0] = 0.0
        out[0, 0] = first
    return out


@dataclass
class Objective:
    """Mean loss with its regularisation, over rows dealt to groups."""

    rows: GroupedRows
    n_factors: int
    task: str
    reg: tuple[float, float, float]
    use_intercept: bool = True
    use_linear: bool = True

    @property
    def width(self) -> int:
        return self.n_factors + 1

    def shapes(self):
        """(reg, mask) of a block: what is added to the gradient for each parameter, and which ones move."""
        width, reg, moves = self.width, self.reg, (float(self.use_intercept), float(self.use_linear), 1.0)

        def of(block: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
            return _scales(block, rows, width, *reg), _scales(block, rows, width, *moves)

        return of

    def evaluate(self, parameters: DataFrame, where=None) -> tuple[DataFrame, int, float, float]:
        """((block, x, g), rows, mean loss, regularised loss): one pass, written to the shared checkpoint folder."""
        found = cut_lineage(self.rows.sums(parameters, _local(self.n_factors, self.task), where))
        count, loss = found.agg(F.sum("rows"), F.sum("loss")).first()
        if not count:
            raise ValueError("no training rows")
        width, shapes = self.width, self.shapes()

        def mean(row: dict) -> dict:
            x = np.frombuffer(row["x"], np.float64).reshape(-1, width)
            reg, mask = shapes(row["block"], len(x))
            g = (np.frombuffer(row["sum"], np.float64).reshape(-1, width) / count + reg * x) * mask
            return {"block": row["block"], "x": row["x"], "g": g.tobytes(), "penalty": 0.5 * float((reg * x * x).sum())}

        table = map_blocks(found, mean, "block long, x binary, g binary, penalty double")
        penalty = table.agg(F.sum("penalty")).first()[0]
        return table.drop("penalty"), count, loss / count, loss / count + penalty


def step_along(table: DataFrame, step: float) -> DataFrame:
    """(block, x, moved, size): x - step g, and the squared lengths of the step and of the result."""

    def run(row: dict) -> dict:
        x, g = np.frombuffer(row["x"], np.float64), np.frombuffer(row["g"], np.float64)
        new = x - step * g
        return {"block": row["block"], "x": new.tobytes(), "moved": float((step * step) * (g @ g)), "size": float(new @ new)}

    return map_blocks(table, run, "block long, x binary, moved double, size double")


def start(spark: SparkSession, n_features: int, n_factors: int, init_std: float, seed: int) -> DataFrame:
    """Weights 0 and random factors; a block's depend on the seed and its place alone."""

    def fill(first: int, last: int) -> np.ndarray:
        x = np.random.default_rng([seed, first]).normal(0.0, init_std, (last - first, n_factors + 1))
        x[:, 0] = 0.0
        if first == 0:
            x[0] = 0.0
        return x

    return initial_blocks(spark, n_features + 1, n_factors + 1, fill)


def _deal(df: DataFrame, features: str, label: str, n_features: int | None, n_factors: int, task: str, group_rows: int | None):
    """Grouped rows, the number of features, and the label range for clipping."""
    rows = GroupedRows.deal(_thin(df, features, label), "ids", n_factors + 1, group_rows, extra=(0,))
    facts = rows.rows.agg(F.max(F.array_max("ids")), F.min("label"), F.max("label")).first()
    if facts[1] is None:
        rows.release()
        raise ValueError("no training rows")
    bounds = (facts[1], facts[2]) if task == "regression" else (-math.inf, math.inf)
    return rows, n_features if n_features is not None else int(facts[0] or 1), bounds


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
    first: FMTable | None = None,
    group_rows: int | None = None,
) -> FMTable:
    """Gradient descent as `fm.train_sgd` does it, for models of any width. The driver sees the loss and two lengths.

    `first` has the parameters to start from. `fraction` < 1 uses, in each step, the rows that a hash of row and step picks.
    """
    rows, width, (low, high) = _deal(df, features, label, n_features, n_factors, task, group_rows)
    goal = Objective(rows, n_factors, task, reg, use_intercept, use_linear)
    history = []
    try:
        blocks = first.blocks if first else start(df.sparkSession, width, n_factors, init_std, seed)
        for t in range(1, iterations + 1):
            used = None if fraction >= 1.0 else F.pmod(F.xxhash64("_id", F.lit(seed + t)), F.lit(1 << 20)) < int(fraction * (1 << 20))
            found, _, loss, _ = goal.evaluate(blocks, used)
            moved = step_along(found, step_size / math.sqrt(t))
            history.append(loss)
            squares = moved.agg(F.sum("moved"), F.sum("size")).first()
            blocks = moved.select("block", "x")
            if math.sqrt(squares[0]) < tolerance * max(math.sqrt(squares[1]), 1.0):
                break
        return FMTable(cut_lineage(blocks), width, n_factors, task, low, high, history)
    finally:
        rows.release()


def _gram(basis: DataFrame) -> np.ndarray:
    """Inner products of the vectors that a basis table (block, b array<binary>) holds: the only thing of them that the
    driver ever sees."""

    def dots(row: dict) -> dict:
        vectors = np.stack([np.frombuffer(v, np.float64) for v in row["b"]])
        return {"block": row["block"], "dots": (vectors @ vectors.T).ravel().tolist()}

    table = map_blocks(basis, dots, "block long, dots array<double>")
    n = table.select(F.posexplode("dots").alias("at", "dot")).groupBy("at").agg(F.sum("dot").alias("dot")).toPandas()
    out = np.zeros(len(n))
    out[n["at"].to_numpy()] = n["dot"].to_numpy()
    return out.reshape(int(math.isqrt(len(n))), -1)


def two_loops(gram: np.ndarray, pairs: int) -> np.ndarray:
    """Coefficients of the L-BFGS direction in the basis s_1..s_m, y_1..y_m, g, from the inner products alone."""
    g = 2 * pairs
    c = np.zeros(2 * pairs + 1)
    c[g] = -1.0
    a = np.zeros(pairs)
    for i in reversed(range(pairs)):
        a[i] = (gram[i] @ c) / gram[i, pairs + i]
        c[pairs + i] -= a[i]
    if pairs:
        c *= gram[pairs - 1, 2 * pairs - 1] / gram[2 * pairs - 1, 2 * pairs - 1]
    for i in range(pairs):
        b = (gram[pairs + i] @ c) / gram[i, pairs + i]
        c[i] += a[i] - b
    return c


def _combined(state: DataFrame, coefficients: np.ndarray, step: float) -> DataFrame:
    """(block, x): x plus `step` times the combination of the basis."""

    def run(row: dict) -> dict:
        along = sum(c * np.frombuffer(v, np.float64) for c, v in zip(coefficients, row["b"], strict=True))
        return {"block": row["block"], "x": (np.frombuffer(row["x"], np.float64) + step * along).tobytes()}

    return map_blocks(state, run, "block long, x binary")


def _advanced(state: DataFrame, found: DataFrame, pairs: int, corrections: int) -> tuple[DataFrame, int]:
    """The state after an accepted step: the new x and gradient, and the pair of differences if its curvature is positive."""
    joined = state.select("block", F.col("x").alias("old"), "b").join(found, "block")

    def curvature(row: dict) -> dict:
        s = np.frombuffer(row["x"], np.float64) - np.frombuffer(row["old"], np.float64)
        y = np.frombuffer(row["g"], np.float64) - np.frombuffer(row["b"][-1], np.float64)
        return {"block": row["block"], "x": row["x"], "g": row["g"], "s": s.tobytes(), "y": y.tobytes(), "b": row["b"], "sy": float(s @ y)}

    moved = cut_lineage(map_blocks(joined, curvature, "block long, x binary, g binary, s binary, y binary, b array<binary>, sy double"))
    keep = pairs
    history_s, history_y = list(range(1, pairs + 1)), list(range(pairs + 1, 2 * pairs + 1))
    listed = lambda places: [F.col("b")[k - 1] for k in places]
    s, y = listed(history_s), listed(history_y)
    if moved.agg(F.sum("sy")).first()[0] > 1e-10:
        s, y = [*s, F.col("s")][-corrections:], [*y, F.col("y")][-corrections:]
        keep = len(s)
    return moved.select("block", "x", F.array(*s, *y, F.col("g")).alias("b")), keep


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
    first: FMTable | None = None,
    group_rows: int | None = None,
) -> FMTable:
    """Vector-free L-BFGS: parameters, gradient and history are blocks of one table; the two loops run on the matrix of
    their inner products, (2 corrections + 1) squared numbers, and a step is one combination of blocks."""
    rows, width, (low, high) = _deal(df, features, label, n_features, n_factors, task, group_rows)
    goal = Objective(rows, n_factors, task, reg, use_intercept, use_linear)
    try:
        blocks = first.blocks if first else start(df.sparkSession, width, n_factors, init_std, seed)
        found, _, _, loss = goal.evaluate(blocks)
        state, pairs, history = found.select("block", "x", F.array("g").alias("b")), 0, [loss]
        for _ in range(iterations):
            gram = _gram(state)
            along = two_loops(gram, pairs)
            slope = float(gram[-1] @ along)
            if slope >= 0:
                state, pairs = state.select("block", "x", F.array(F.col("b")[2 * pairs]).alias("b")), 0
                gram, along = gram[-1:, -1:], np.array([-1.0])
                slope = -float(gram[0, 0])
            length = math.sqrt(gram[-1, -1])
            step = 1.0 if pairs else 1.0 / max(1.0, length)
            for _ in range(12):
                found, _, _, trial = goal.evaluate(_combined(state, along, step))
                if trial <= loss + 1e-4 * step * slope:
                    break
                step *= 0.5
            else:
                break
            state, pairs = _advanced(state, found, pairs, corrections)
            gain, loss = loss - trial, trial
            history.append(loss)
            if gain <= tolerance * max(abs(loss), 1.0) * 0.01:
                break
        return FMTable(cut_lineage(state.select("block", "x")), width, n_factors, task, low, high, history)
    finally:
        rows.release()
