"""Skip-gram vectors with negative sampling, for vocabularies that no single machine holds.

Vectors are blocks of a table: ids 0 to n - 1 are the items' own vectors, n to 2 n - 1 their vectors as context. Pairs of
neighbours are joined by position, so that a long sequence is not one task's, and dealt to groups; a group fetches the
vectors of its pairs, and sums of gradients go back by block. Spark's `Word2Vec`, whose vocabulary lies in the driver, stays
the choice for small vocabularies (`embeddings.train_embeddings`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models.parameter_blocks import GroupedRows, block_features, initial_blocks, map_blocks
from rankweave.session import cut_lineage

#: Factors of centre, context and number, and the modulus, of the arithmetic that picks negatives.
_PICK = (7919, 104_729, 1_299_709, 2_147_483_647)


def neighbour_pairs(positions: DataFrame, group: Sequence[str], window: int, position: str = "position", item: str = "item") -> DataFrame:
    """(centre, context): all pairs of items at most `window` positions apart in a sequence, both ways. Positions of a
    sequence are gapless; items are numbers."""
    own = positions.select(*group, F.col(position).alias("_at"), F.col(item).cast("long").alias("centre"))
    offsets = F.array(*[F.lit(k).cast("long") for k in range(-window, window + 1) if k])
    asking = own.withColumn("_step", F.explode(offsets)).select(*group, (F.col("_at") + F.col("_step")).alias("_at"), "centre")
    return asking.join(own.withColumnRenamed("centre", "context"), [*group, "_at"]).select("centre", "context")


def with_negatives(pairs: DataFrame, items: int, negatives: int) -> DataFrame:
    """`pairs` with `targets`: the context and `negatives` items that the pair's numbers pick, each with the same chance."""
    a, b, c, modulus = _PICK
    number = F.col("centre") * a + F.col("context") * b
    picked = F.transform(F.sequence(F.lit(1), F.lit(negatives)), lambda k: (number + k * c) % modulus % items) if negatives else F.array().cast("array<long>")
    return pairs.withColumn("targets", F.concat(F.array("context"), picked))


@dataclass
class SkipGram:
    """(block, x) of 2 `items` vectors of `width` numbers and a place that only sums use."""

    blocks: DataFrame
    items: int
    width: int
    loss_history: list[float]

    def vectors(self, kind: str = "item") -> DataFrame:
        """(item, vec) of the items' own vectors, or with kind "context" of those as context."""
        width, size, n = self.width, block_features(self.width + 1), self.items

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, packed in zip(batch.column("block").to_pylist(), batch.column("x").to_pylist(), strict=True):
                    x = np.frombuffer(packed, np.float64).reshape(-1, width + 1)[:, :width]
                    ids = block * size + np.arange(len(x))
                    kept = ids < n if kind == "item" else ids >= n
                    cuts = np.arange(int(kept.sum()) + 1, dtype=np.int32) * width
                    yield pa.record_batch([pa.array(ids[kept] % n), pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.ascontiguousarray(x[kept]).ravel()))], names=["item", "vec"])

        return self.blocks.mapInArrow(run, "item long, vec array<double>")


def start(spark: SparkSession, items: int, width: int, seed: int) -> DataFrame:
    """Small random vectors for the items, zeros as contexts."""

    def fill(first: int, last: int) -> np.ndarray:
        x = np.random.default_rng([seed, first]).uniform(-0.5 / width, 0.5 / width, (last - first, width + 1))
        x[:, width] = 0.0
        x[np.arange(first, last) >= items] = 0.0
        return x

    return initial_blocks(spark, 2 * items, width + 1, fill)


def _gradient(items: int, width: int):
    def run(table: pa.Table, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, int, float]:
        targets = table["targets"].combine_chunks()
        row = np.repeat(np.arange(table.num_rows), targets.value_lengths().to_numpy())
        centre = np.searchsorted(ids, table["centre"].to_numpy())
        target = np.searchsorted(ids, targets.flatten().to_numpy() + items)
        label = np.zeros(len(row))
        label[targets.offsets.to_numpy()[:-1] - targets.offsets[0].as_py()] = 1.0  # the context stands first
        vectors = x[:, :width]
        margin = np.einsum("ij,ij->i", vectors[centre][row], vectors[target])
        slope = 0.5 * (1 + np.tanh(0.5 * margin)) - label
        total = np.zeros((len(ids), width + 1))
        np.add.at(total[:, :width], centre[row], slope[:, None] * vectors[target])
        np.add.at(total[:, :width], target, slope[:, None] * vectors[centre][row])
        total[:, width] = np.bincount(centre, minlength=len(ids)) + np.bincount(target, minlength=len(ids))
        return total, table.num_rows, float(np.logaddexp(0.0, np.where(label > 0, -margin, margin)).sum())

    return run


def train(
    pairs: DataFrame,
    items: int,
    width: int = 100,
    negatives: int = 5,
    rounds: int = 10,
    rate: float = 1.0,
    seed: int = 12345,
    first: DataFrame | None = None,
    group_rows: int | None = None,
) -> SkipGram:
    """Vectors from (centre, context) pairs of item numbers below `items`. In each round a vector moves by `rate` times the
    mean gradient of its occurrences. `first` has the blocks to start from."""
    rows = with_negatives(pairs, items, negatives)
    rows = rows.withColumn("ids", F.concat(F.array("centre"), F.transform("targets", lambda t: t + items)))
    grouped = GroupedRows.deal(rows, "ids", width + 1, group_rows)

    def move(r: dict) -> dict:
        x, total = (np.frombuffer(r[c], np.float64).reshape(-1, width + 1) for c in ("x", "sum"))
        new = x.copy()
        new[:, :width] -= rate * total[:, :width] / np.maximum(total[:, width:], 1.0)
        return {"block": r["block"], "x": new.tobytes()}

    history, blocks = [], first if first is not None else start(pairs.sparkSession, items, width, seed)
    try:
        for _ in range(rounds):
            found = cut_lineage(grouped.sums(blocks, _gradient(items, width)))
            count, loss = found.agg(F.sum("rows"), F.sum("loss")).first()
            if not count:
                raise ValueError("no pairs")
            history.append(loss / count)
            blocks = map_blocks(found, move, "block long, x binary")
        return SkipGram(cut_lineage(blocks), items, width, history)
    finally:
        grouped.release()
