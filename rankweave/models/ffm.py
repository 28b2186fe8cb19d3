"""Field-aware factorization machines.

The pairwise sum over a row's nodes is rewritten over fields. With S[p][q] = sum of w[j, q] * v over the nodes j of
field p, all pairs together give sum(S[p][q] . S[q][p]) minus each node's product with itself. That is linear in the
number of nodes, and gives the gradient in the same form.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.models.batches import flat_list
from rankweave.models.fm import log_loss, sigmoid

#: Cells of the per-row field tables that are held at once.
TABLE_CELLS = 4_000_000


@dataclass
class Nodes:
    """Nodes of a batch of rows; nodes outside of the model's fields or features are left out."""

    size: int
    row: np.ndarray
    field: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    @classmethod
    def inside(cls, size, row, field, feature, value, n_fields: int, n_features: int) -> Nodes:
        keep = (field >= 0) & (field < n_fields) & (feature >= 0) & (feature < n_features)
        return cls(size, row[keep], field[keep].astype(np.int64), feature[keep].astype(np.int64), value[keep])

    def part(self, start: int, stop: int) -> Nodes:
        """Rows [start, stop); node rows are in order."""
        low, high = np.searchsorted(self.row, [start, stop])
        cut = slice(low, high)
        return Nodes(stop - start, self.row[cut] - start, self.field[cut], self.feature[cut], self.value[cut])


def _field_sums(weights: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(S, own field part of each node, margins) of a batch."""
    n_fields, k = weights.shape[1:]
    scaled = weights[nodes.feature] * nodes.value[:, None, None]
    sums = np.zeros((nodes.size * n_fields, n_fields, k))
    np.add.at(sums, nodes.row * n_fields + nodes.field, scaled)
    sums = sums.reshape(nodes.size, n_fields, n_fields, k)
    own = scaled[np.arange(len(nodes.field)), nodes.field]
    itself = np.bincount(nodes.row, (own * own).sum(axis=1), nodes.size)
    return sums, own, np.einsum("bpqk,bqpk->b", sums, sums) - itself


@dataclass
class FFMModel:
    """weights: features x fields x factors; the margin counts each pair twice."""

    weights: np.ndarray
    loss_history: list[float] = field(default_factory=list)

    @property
    def n_features(self) -> int:
        return self.weights.shape[0]

    @property
    def n_fields(self) -> int:
        return self.weights.shape[1]

    def margins(self, nodes: Nodes) -> np.ndarray:
        step = _rows_at_once(self.n_fields, self.weights.shape[2])
        parts = [
            _field_sums(self.weights, nodes.part(i, min(i + step, nodes.size)))[2] for i in range(0, nodes.size, step)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)

    def score(self, nodes: Column, link: bool = False) -> Column:
        """Raw margin (or its logistic value) of an array<struct<f,j,v>> column."""
        model = self

        @F.arrow_udf("double")
        def scored(fields: pa.Array, features: pa.Array, values: pa.Array) -> pa.Array:
            (field, row), (feature, _), (value, _) = (flat_list(c) for c in (fields, features, values))
            margin = model.margins(Nodes.inside(len(fields), row, field, feature, value, model.n_fields, model.n_features))
            return pa.array(sigmoid(margin) if link else margin)

        return scored(*_node_columns(nodes))


def _node_columns(nodes: Column) -> list[Column]:
    return [
        F.transform(nodes, lambda n: n["f"].cast("int")),
        F.transform(nodes, lambda n: n["j"].cast("int")),
        F.transform(nodes, lambda n: n["v"].cast("double")),
    ]


def _rows_at_once(n_fields: int, k: int) -> int:
    return max(1, TABLE_CELLS // (n_fields * n_fields * k))


def _gradient(weights: np.ndarray, nodes: Nodes, sign: np.ndarray, reg: float):
    """(features touched, their summed gradient, loss) of a batch of rows."""
    n_fields = weights.shape[1]
    sums, own, margin = _field_sums(weights, nodes)
    slope = -sign * sigmoid(-sign * margin)
    # Partner sums seen by each node: one vector per field of the partners, without the node itself.
    partners = sums[nodes.row, :, nodes.field, :].copy()
    partners[np.arange(len(nodes.field)), nodes.field] -= own
    gradient = (2.0 * slope[nodes.row] * nodes.value)[:, None, None] * partners
    if reg:
        counts = np.zeros((nodes.size, n_fields))
        np.add.at(counts, (nodes.row, nodes.field), 1.0)
        times = counts[nodes.row]
        times[np.arange(len(nodes.field)), nodes.field] -= 1.0
        gradient += reg * times[:, :, None] * weights[nodes.feature]
    features, where = np.unique(nodes.feature, return_inverse=True)
    total = np.zeros((len(features), *weights.shape[1:]))
    np.add.at(total, where, gradient)
    return features, total, float(log_loss(margin, sign).sum())


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
) -> FFMModel:
    """Each iteration: every partition makes a pass over its rows in steps of `batch_rows`, starting from the shared
    weights; the changes are averaged over the partitions. batch_rows=1 updates after every row.

    solver "sgd" uses the plain step, "adagrad" divides it by the root of the summed squared gradients (from 1).
    Partitions emit changed weights only, and Spark sums them per (feature, field). The weights travel to the executors and
    back in each iteration: `ffm_table.train` is the one for models that should not be in one place.
    """
    if solver not in ("sgd", "adagrad"):
        raise ValueError(f"unknown solver {solver!r}")
    adaptive = solver == "adagrad"
    shape = (n_features, n_fields, n_factors)
    fields, features, values = _node_columns(F.col(nodes))
    rows = df.select(
        F.when(F.col(label) > 0, 1.0).otherwise(-1.0).alias("sign"),
        fields.alias("f"),
        features.alias("j"),
        values.alias("v"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    rng = np.random.default_rng(seed)
    weights = 0.5 / math.sqrt(n_factors) * rng.random(shape)
    squares = np.ones(shape)
    step_rows = min(batch_rows, _rows_at_once(n_fields, n_factors))
    history: list[float] = []
    deltas = [f"w{d}" for d in range(n_factors)] + [f"g{d}" for d in range(n_factors)]
    columns = ["rows", "loss", *deltas]
    schema = "feature long, field long, " + ", ".join(f"{c} double" for c in columns)

    def one_pass(shared):
        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first_w, first_g = shared.value
            w, g = first_w.copy(), first_g.copy()
            touched = np.zeros(n_features, dtype=bool)
            count, loss = 0, 0.0
            for batch in batches:
                f, row = flat_list(batch.column("f"))
                j, _ = flat_list(batch.column("j"))
                v, _ = flat_list(batch.column("v"))
                sign = batch.column("sign").to_numpy(zero_copy_only=False)
                inside = Nodes.inside(len(sign), row, f, j, v, n_fields, n_features)
                for start in range(0, len(sign), step_rows):
                    stop = min(start + step_rows, len(sign))
                    at, gradient, part_loss = _gradient(w, inside.part(start, stop), sign[start:stop], reg)
                    count, loss = count + stop - start, loss + part_loss
                    touched[at] = True
                    if adaptive:
                        g[at] += gradient * gradient
                        w[at] -= step_size * gradient / np.sqrt(g[at])
                    else:
                        w[at] -= step_size * gradient / (stop - start)
            if count == 0:
                return
            at = np.flatnonzero(touched)
            changes = np.concatenate([(w[at] - first_w[at]), (g[at] - first_g[at])], axis=2).reshape(-1, 2 * n_factors)
            # Feature -1 carries the totals of the partition: rows and loss.
            none = np.zeros(len(changes))
            arrays = [
                np.append(np.repeat(at, n_fields), -1).astype(np.int64),
                np.append(np.tile(np.arange(n_fields), len(at)), -1).astype(np.int64),
                np.append(none, float(count)),
                np.append(none, loss),
                *np.append(changes, np.zeros((1, 2 * n_factors)), axis=0).T.copy(),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in arrays], names=["feature", "field", *columns])

        return local

    try:
        for _ in range(iterations):
            shared = df.sparkSession.sparkContext.broadcast((weights, squares))
            parts = rows.mapInArrow(one_pass(shared), schema)
            summed = (
                parts.groupBy("feature", "field")
                .agg(F.count(F.lit(1)).alias("partitions"), *[F.sum(c).alias(c) for c in columns])
                .toPandas()
            )
            shared.destroy()
            if summed.empty:
                raise ValueError("no training rows")
            head = summed[summed["feature"] == -1].iloc[0]
            partitions = int(head["partitions"])
            history.append(head["loss"] / head["rows"])
            body = summed[summed["feature"] >= 0]
            at = (body["feature"].to_numpy(), body["field"].to_numpy())
            changes = body[deltas].to_numpy() / partitions
            weights[at] += changes[:, :n_factors]
            if adaptive:
                squares[at] += changes[:, n_factors:]
    finally:
        rows.unpersist()
    return FFMModel(weights, history)
