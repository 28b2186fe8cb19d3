"""Field-aware factorization machines whose weights and step state are a table of feature blocks, of any size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models.batches import flat_list
from rankweave.models.ffm import FFMModel, Nodes, _gradient, _node_columns, _rows_at_once
from rankweave.models.fm import sigmoid
from rankweave.models.parameter_blocks import GroupedRows, block_features, blocks_of, collect_blocks, initial_blocks, map_blocks
from rankweave.session import cut_lineage


@dataclass
class FFMTable:
    """(block, x): for each feature its weights (fields x factors), then the sums of squared gradients in the same shape."""

    blocks: DataFrame
    n_features: int
    n_fields: int
    n_factors: int
    loss_history: list[float] = field(default_factory=list)

    @property
    def width(self) -> int:
        return 2 * self.n_fields * self.n_factors

    @classmethod
    def of(cls, spark: SparkSession, weights: np.ndarray) -> FFMTable:
        """Weights that the caller holds, as a table; no steps were made yet."""
        flat = weights.reshape(len(weights), -1)
        return cls(blocks_of(spark, np.concatenate([flat, np.ones_like(flat)], axis=1)), *weights.shape)

    def local(self) -> FFMModel:
        """The model as an array on the driver: for models that the caller knows to fit there."""
        x = collect_blocks(self.blocks, self.width)
        return FFMModel(x[:, : self.width // 2].reshape(-1, self.n_fields, self.n_factors).copy(), list(self.loss_history))

    def score(self, df: DataFrame, key: str, nodes: str = "nodes", link: bool = False) -> DataFrame:
        """(key, score) of every row: as `FFMModel.score`, for a model of any size."""
        thin = df.select(F.col(key).alias("key"), F.lit(0).alias("label"), F.col(nodes).alias("nodes"))
        rows = _deal(thin, "nodes", "label", self, None, ["key"])
        fields, k = self.n_fields, self.n_factors

        def run(table: pa.Table, ids: np.ndarray, x: np.ndarray) -> pa.Table:
            if not table.num_rows:
                return table.select(["key"]).append_column("score", pa.array([], pa.float64()))
            margin = FFMModel(_weights(x, fields, k)).margins(_nodes(table, ids))
            return table.select(["key"]).append_column("score", pa.array(sigmoid(margin) if link else margin))

        try:
            kind = dict(df.select(key).dtypes)[key]
            scored = cut_lineage(rows.with_parameters(self.blocks, run, f"key {kind}, score double"))
        finally:
            rows.release()
        return scored.withColumnRenamed("key", key)


def _deal(df: DataFrame, nodes: str, label: str, model: FFMTable, group_rows: int | None, keep=()) -> GroupedRows:
    """Rows by group: sign, fields, features and values of the nodes inside the model."""
    inside = F.filter(F.col(nodes), lambda n: (n["f"] >= 0) & (n["f"] < model.n_fields) & (n["j"] >= 0) & (n["j"] < model.n_features))
    f, j, v = _node_columns(inside)
    thin = df.select(F.when(F.col(label) > 0, 1.0).otherwise(-1.0).alias("sign"), f.alias("f"), j.alias("j"), v.alias("v"), *keep)
    # A group without any node inside still has rows and a loss; it asks for the first feature.
    return GroupedRows.deal(thin, "j", model.width, group_rows, extra=(0,))


def _weights(x: np.ndarray, fields: int, k: int) -> np.ndarray:
    return x[:, : fields * k].reshape(-1, fields, k)


def _nodes(table: pa.Table, ids: np.ndarray) -> Nodes:
    feature, row = flat_list(table["j"].combine_chunks())
    place, _ = flat_list(table["f"].combine_chunks())
    value, _ = flat_list(table["v"].combine_chunks())
    return Nodes(table.num_rows, row, place.astype(np.int64), np.searchsorted(ids, feature), value.astype(np.float64))


def cells(blocks: DataFrame, model: FFMTable, column: str = "x") -> DataFrame:
    """(feature, field, factor, value): one row per weight of a packed column of a block table."""
    fields, k, size = model.n_fields, model.n_factors, block_features(model.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("x").to_pylist(), strict=True):
                w = _weights(np.frombuffer(packed, np.float64).reshape(-1, model_width), fields, k)
                j, f, d = np.indices(w.shape)
                yield pa.record_batch(
                    [pa.array(j.ravel() + block * size), pa.array(f.ravel().astype(np.int32)), pa.array(d.ravel().astype(np.int32)), pa.array(w.ravel())],
                    names=["feature", "field", "factor", "value"],
                )

    model_width = model.width
    return blocks.select("block", F.col(column).alias("x")).mapInArrow(run, "feature long, field int, factor int, value double")


def gradient(df: DataFrame, model: FFMTable, nodes: str = "nodes", label: str = "label", reg: float = 0.0, group_rows: int | None = None) -> tuple[DataFrame, int, float]:
    """((block, x, g), rows, mean loss): the mean gradient over all rows by every weight, in the weights' half of g."""
    rows = _deal(df, nodes, label, model, group_rows)
    fields, k, width = model.n_fields, model.n_factors, model.width
    step = _rows_at_once(fields, k)

    def local(table: pa.Table, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, int, float]:
        weights, inside, sign = _weights(x, fields, k), _nodes(table, ids), table["sign"].to_numpy()
        total, loss = np.zeros((len(ids), width)), 0.0
        for first in range(0, len(sign), step):
            last = min(first + step, len(sign))
            at, found, part = _gradient(weights, inside.part(first, last), sign[first:last], reg)
            total[at, : fields * k] += found.reshape(len(at), -1)
            loss += part
        return total, len(sign), loss

    try:
        found = cut_lineage(rows.sums(model.blocks, local))
    finally:
        rows.release()
    count, loss = found.agg(F.sum("rows"), F.sum("loss")).first()
    if not count:
        raise ValueError("no training rows")
    mean = map_blocks(found, lambda r: {"block": r["block"], "x": r["x"], "g": (np.frombuffer(r["sum"], np.float64) / count).tobytes()}, "block long, x binary, g binary")
    return mean, count, loss / count


def train(
    df: DataFrame,
    n_fields: int,
    n_features: int,
    nodes: str = "nodes",
    label: str = "label",
    n_factors: int = 4,
    iterations: int = 15,
    step_size: float = 0.1,
    reg: float = 0.0,
    solver: str = "adagrad",
    batch_rows: int = 64,
    seed: int = 12345,
    first: FFMTable | None = None,
    group_rows: int | None = None,
) -> FFMTable:
    """As `ffm.train`: in each iteration every group makes a pass over its rows in steps of `batch_rows`, from the shared
    weights, and changes of weights and step state are averaged over the groups.

    A group fetches what its rows use; changes go back by block and are added where the block is. The driver sees the loss.
    """
    if solver not in ("sgd", "adagrad"):
        raise ValueError(f"unknown solver {solver!r}")
    half = n_fields * n_factors

    def fill(low: int, high: int) -> np.ndarray:
        x = np.ones((high - low, 2 * half))
        x[:, :half] = 0.5 / math.sqrt(n_factors) * np.random.default_rng([seed, low]).random((high - low, half))
        return x

    model = first or FFMTable(initial_blocks(df.sparkSession, n_features, 2 * half, fill), n_features, n_fields, n_factors)
    rows = _deal(df, nodes, label, model, group_rows)
    step_rows = min(batch_rows, _rows_at_once(n_fields, n_factors))

    def local(table: pa.Table, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, int, float]:
        now = x.copy()
        w, g = now[:, :half].reshape(-1, n_fields, n_factors).copy(), now[:, half:].reshape(-1, n_fields, n_factors).copy()
        inside, sign, loss = _nodes(table, ids), table["sign"].to_numpy(), 0.0
        for low in range(0, len(sign), step_rows):
            high = min(low + step_rows, len(sign))
            at, found, part = _gradient(w, inside.part(low, high), sign[low:high], reg)
            loss += part
            if solver == "adagrad":
                g[at] += found * found
                w[at] -= step_size * found / np.sqrt(g[at])
            else:
                w[at] -= step_size * found / (high - low)
        return np.concatenate([w.reshape(len(ids), -1), g.reshape(len(ids), -1)], axis=1) - x, len(sign), loss

    groups, history, blocks = rows.groups, [], model.blocks

    def average(r: dict) -> dict:
        return {"block": r["block"], "x": (np.frombuffer(r["x"], np.float64) + np.frombuffer(r["sum"], np.float64) / groups).tobytes()}

    try:
        for _ in range(iterations):
            found = cut_lineage(rows.sums(blocks, local))
            count, loss = found.agg(F.sum("rows"), F.sum("loss")).first()
            if not count:
                raise ValueError("no training rows")
            history.append(loss / count)
            blocks = map_blocks(found, average, "block long, x binary")
        return FFMTable(cut_lineage(blocks), n_features, n_fields, n_factors, history)
    finally:
        rows.release()
