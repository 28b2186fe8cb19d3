"""Model parameters as a table of feature blocks, and passes over training rows that fetch what they need of it.

A row of the table holds the parameters of `block` features in a row: `width` doubles for each. Training rows are dealt
to groups once and kept partitioned by group. A pass has three steps, each an equi-join of tables that are already
partitioned by its key on one side:

1. Each group has asked once for the features that its rows use; blocks answer with their parameters.
2. A task has one group, its rows and just these parameters; it hands back sums by block.
3. Sums are added up by (block, share of the groups), then by block.

So neither the driver nor any task ever holds a whole model, only blocks and what one group of rows uses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.models.batches import flat_list
from rankweave.session import cut_lineage

#: Doubles in one block of parameters, about 256 KB.
BLOCK_VALUES = 32_768

#: Rows of a group at most.
GROUP_ROWS = 16_384

#: Groups whose questions to, or sums for, one block are handled together.
SHARE_GROUPS = 64

PARAMETERS = "block long, x binary"


def doubles(column: pa.ChunkedArray | pa.Array, k: int = 0) -> np.ndarray:
    return np.frombuffer(column[k].as_py(), np.float64)


def block_features(width: int) -> int:
    return max(1, BLOCK_VALUES // width)


def initial_blocks(spark: SparkSession, features: int, width: int, fill: Callable[[int, int], np.ndarray]) -> DataFrame:
    """(block, x): `fill(first, last)` gives the parameters of features first to last - 1, as an array of `width` columns.

    It must depend on its arguments alone: blocks are made where they are needed, again after a lost executor."""
    size = block_features(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("block").to_pylist():
                x = np.ascontiguousarray(fill(k * size, min((k + 1) * size, features)), np.float64)
                yield pa.record_batch([pa.array([k], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["block", "x"])

    count = (features + size - 1) // size
    return spark.range(count).select(F.col("id").alias("block")).mapInArrow(run, PARAMETERS)


def blocks_of(spark: SparkSession, values: np.ndarray) -> DataFrame:
    """The parameter table of an array that the caller holds."""
    values = np.ascontiguousarray(values, np.float64)
    size = block_features(values.shape[1])
    rows = [(k, bytearray(values[first : first + size].tobytes())) for k, first in enumerate(range(0, len(values), size))]
    return spark.createDataFrame(rows, PARAMETERS)


def collect_blocks(table: DataFrame, width: int) -> np.ndarray:
    """The whole model as one array: for models that the caller knows to fit one machine."""
    parts = sorted((r["block"], bytes(r["x"])) for r in table.select("block", "x").collect())
    return np.concatenate([np.frombuffer(x, np.float64) for _, x in parts]).reshape(-1, width).copy()


#: What a group's task gets: its rows, the ids of its features (ascending), and their parameters (features x width). It
#: yields sums for the features, the number of rows and the loss.
Local = Callable[[pa.Table, np.ndarray, np.ndarray], tuple[np.ndarray, int, float]]


@dataclass
class GroupedRows:
    """Training rows dealt to groups, and what each group asks of each block. Release it after use."""

    rows: DataFrame
    asks: DataFrame
    groups: int
    shares: int
    block: int
    width: int

    @classmethod
    def deal(cls, df: DataFrame, features: str, width: int, group_rows: int | None = None, extra: tuple[int, ...] = ()) -> GroupedRows:
        """Deal the rows of `df` out; `features` is the array column of the feature ids of a row. Every group also asks for
        the `extra` ids. Groups are runs of neighbouring rows, so that equal rows do not meet in one group."""
        spark = df.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        numbered = cut_lineage(df.withColumn("_id", F.monotonically_increasing_id()))
        if group_rows is None:
            group_rows = min(max(numbered.count() // (2 * parts), 256), GROUP_ROWS)
        inside = F.floor(F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) / group_rows)
        group = F.shiftright("_id", 33) * F.lit((1 << 33) // group_rows + 1) + inside
        grouped = numbered.withColumn("group", group).repartition(parts, "group").sortWithinPartitions("group").persist(StorageLevel.MEMORY_AND_DISK)
        groups = grouped.agg(F.count_distinct("group")).first()[0]
        shares = max(1, -(-groups // SHARE_GROUPS))
        size = block_features(width)

        def ask(table: pa.Table) -> pa.Table:
            found = np.unique(np.append(flat_list(table[features].combine_chunks())[0], extra)).astype(np.int64)
            blocks = found // size
            heads = np.flatnonzero(np.diff(blocks, prepend=-1))
            slots = [(found[a:b] % size).astype(np.int32).tobytes() for a, b in zip(heads, np.append(heads, len(found))[1:], strict=True)]
            group = [table["group"][0].as_py()] * len(heads)
            return pa.table([pa.array(blocks[heads]), pa.array(group, pa.int64()), pa.array(slots, pa.binary())], names=["block", "group", "slots"])

        asks = grouped.groupBy("group").applyInArrow(ask, "block long, group long, slots binary")
        share = F.pmod(F.xxhash64("group"), F.lit(shares)).cast("int")
        asks = asks.withColumn("share", share).repartition(parts, "block", "share").persist(StorageLevel.MEMORY_AND_DISK)
        return cls(grouped, asks, groups, shares, size, width)

    def release(self) -> None:
        self.rows.unpersist()
        self.asks.unpersist()

    def fetch(self, parameters: DataFrame) -> DataFrame:
        """(group, block, slots, x): what each group has asked for."""
        width = self.width
        copies = parameters.select("block", "x", F.explode(F.sequence(F.lit(0), F.lit(self.shares - 1))).alias("share"))

        def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
            if not asked.num_rows:
                return pa.table({"group": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "slots": pa.array([], pa.binary()), "x": pa.array([], pa.binary())})
            if not held.num_rows:
                raise ValueError(f"features of block {asked['block'][0].as_py()} are outside of the model")
            x = doubles(held["x"]).reshape(-1, width)
            values = []
            for slots in asked["slots"].to_pylist():
                at = np.frombuffer(slots, np.int32)
                if at[-1] >= len(x) or at[0] < 0:
                    raise ValueError(f"feature {int(at[-1])} of block {asked['block'][0].as_py()} is outside of the model")
                values.append(x[at].tobytes())
            return pa.table([asked["group"], asked["block"], asked["slots"], pa.array(values, pa.binary())], names=["group", "block", "slots", "x"])

        key = ["block", "share"]
        return self.asks.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(answer, "group long, block long, slots binary, x binary")

    def with_parameters(self, parameters: DataFrame, run: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table], schema: str, where=None) -> DataFrame:
        """`run` over each group: its rows, its feature ids, their parameters."""
        size, width = self.block, self.width

        def group(rows: pa.Table, fetched: pa.Table) -> pa.Table:
            parts = sorted(zip(fetched["block"].to_pylist(), fetched["slots"].to_pylist(), fetched["x"].to_pylist(), strict=True))
            ids = np.concatenate([b * size + np.frombuffer(s, np.int32).astype(np.int64) for b, s, _ in parts]) if parts else np.empty(0, np.int64)
            x = np.concatenate([np.frombuffer(v, np.float64) for *_, v in parts]).reshape(-1, width) if parts else np.empty((0, width))
            return run(rows, ids, x)

        rows = self.rows if where is None else self.rows.where(where)
        return rows.groupBy("group").cogroup(self.fetch(parameters).groupBy("group")).applyInArrow(group, schema)

    def sums(self, parameters: DataFrame, local: Local, where=None) -> DataFrame:
        """(block, x, sum, rows, loss) of every block: the parameters, and the sums that all groups hand back for them.

        Rows and loss stand with the block of each group's first feature."""
        size, width, shares = self.block, self.width, self.shares
        schema = "block long, share int, slots binary, sum binary, rows long, loss double"
        names = ["block", "share", "slots", "sum", "rows", "loss"]

        def run(rows: pa.Table, ids: np.ndarray, x: np.ndarray) -> pa.Table:
            if not rows.num_rows or not len(ids):
                return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.float64())], names=names)
            total, count, loss = local(rows, ids, x)
            blocks = ids // size
            heads = np.flatnonzero(np.diff(blocks, prepend=-1))
            ends = np.append(heads, len(ids))[1:]
            first = np.arange(len(heads)) == 0
            share = int(rows["group"][0].as_py() % shares)
            return pa.table(
                [
                    pa.array(blocks[heads]),
                    pa.array([share] * len(heads), pa.int32()),
                    pa.array([(ids[a:b] % size).astype(np.int32).tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary()),
                    pa.array([np.ascontiguousarray(total[a:b]).tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary()),
                    pa.array(np.where(first, count, 0)),
                    pa.array(np.where(first, loss, 0.0)),
                ],
                names=names,
            )

        def add(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            total, seen = np.zeros((size, width)), np.zeros(size, bool)
            for slots, values in zip(table["slots"].to_pylist(), table["sum"].to_pylist(), strict=True):
                at = np.frombuffer(slots, np.int32)
                total[at] += np.frombuffer(values, np.float64).reshape(-1, width)
                seen[at] = True
            return total, seen

        def numbers(table: pa.Table) -> list[pa.Array]:
            return [pa.array([int(np.sum(table["rows"].to_numpy()))], pa.int64()), pa.array([float(np.sum(table["loss"].to_numpy()))], pa.float64())]

        def of_share(table: pa.Table) -> pa.Table:
            total, seen = add(table)
            at = np.flatnonzero(seen).astype(np.int32)
            packed = [pa.array([at.tobytes()], pa.binary()), pa.array([total[at].tobytes()], pa.binary())]
            return pa.table([table["block"].slice(0, 1), table["share"].slice(0, 1), *packed, *numbers(table)], names=names)

        def of_block(held: pa.Table, table: pa.Table) -> pa.Table:
            total, _ = add(table)
            known = len(doubles(held["x"])) // width
            return pa.table([held["block"], held["x"], pa.array([total[:known].tobytes()], pa.binary()), *numbers(table)], names=["block", "x", "sum", "rows", "loss"])

        parts = self.with_parameters(parameters, run, schema, where)
        shared = parts.groupBy("block", "share").applyInArrow(of_share, schema)
        joined = parameters.groupBy("block").cogroup(shared.groupBy("block"))
        return joined.applyInArrow(of_block, "block long, x binary, sum binary, rows long, loss double")


def map_blocks(table: DataFrame, run: Callable[[dict], dict], schema: str) -> DataFrame:
    """`run` over each row of a block table, as a dict; it gives a dict for a row of `schema`."""
    kind = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in table.sparkSession.createDataFrame([], schema).schema])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([run(row)], schema=kind)

    return table.mapInArrow(each, schema)


_ARROW = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<binary>": pa.list_(pa.binary()), "array<double>": pa.list_(pa.float64())}
