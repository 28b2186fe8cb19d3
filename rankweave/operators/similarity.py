"""Embedding lookup, history similarity and top-N scoring over vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rankweave.functions.dates import shift_date
from rankweave.functions.vectors import dot, normalized, zero_array
from rankweave.operators.joins import SHARE_ROWS, skew_safe_join


def previous_day_vectors(
    df: DataFrame,
    vectors: DataFrame,
    id_column: str,
    width: int,
    output: str,
    salt_by: Sequence[str] | None = None,
    share_rows: int = SHARE_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Append the embedding of `id_column` from the day before `label_date`; zeros when there is none.

    `vectors` has (id, dt, vec), one row per id and day. With `counts`, the `key_counts` of (id, label_date), popular
    ids are split over several tasks; without, that is left to adaptive execution.
    """
    before = shift_date(F.col("label_date"), -1)
    keyed = df.withColumn("_day", before)
    sizes = None if counts is None else counts.withColumn("_day", before)
    table = vectors.select(F.col("id").alias(id_column), F.col("dt").alias("_day"), F.col("vec").alias(output))
    joined = skew_safe_join(keyed, table, [id_column, "_day"], "left", salt_by, share_rows, sizes)
    return joined.select(*df.columns, F.coalesce(F.col(output), zero_array(width)).alias(output))


def history_items(history: DataFrame) -> DataFrame:
    """(device_id, dt, feed_id) rows of a history table whose `feeds` are blank-joined texts or arrays."""
    feeds = F.col("feeds")
    if dict(history.dtypes)["feeds"] == "string":
        feeds = F.split(feeds, " ")
    return history.select("device_id", "dt", F.explode(feeds).alias("feed_id"))


def history_profiles(items: DataFrame, vectors: DataFrame, width: int, history_offset: int = -1) -> DataFrame:
    """Per (device, label_date): number of history items and the sum of their unit vectors.

    The mean cosine of a target with each history item equals the dot product of the target's unit vector with the
    mean of the items' unit vectors. So the history is reduced to one vector per user and day, and rows never meet
    their history item by item: the cost is linear, also for a user with most of the rows. Repeats of an item are
    counted before its vector is fetched.
    """
    dated = items.withColumn("label_date", shift_date(F.col("dt"), -history_offset))
    counted = dated.groupBy("device_id", "label_date", "feed_id").agg(F.count(F.lit(1)).alias("_times"))
    looked_up = previous_day_vectors(counted, vectors, "feed_id", width, "_vec")
    unit = looked_up.select("device_id", "label_date", "_times", normalized(F.col("_vec")).alias("_unit"))
    sums = [F.sum(F.col("_unit")[i] * F.col("_times")) for i in range(width)]
    return unit.groupBy("device_id", "label_date").agg(
        F.sum("_times").alias("_items"), F.array(*sums).alias("_profile")
    )


def add_history_similarity(
    df: DataFrame,
    items: DataFrame,
    vectors: DataFrame,
    width: int,
    history_offset: int = -1,
    salt_by: Sequence[str] | None = None,
    vector_column: str = "feed_vec",
    output: str = "history_sim",
) -> DataFrame:
    """Append the item vector of the day before and its mean cosine with the user's history; 0 without history.

    History of day `label_date + history_offset` is used. The default is the day before; +1 reproduces pipelines that
    read the day after, which leaks future clicks into training.
    """
    profiles = history_profiles(items, vectors, width, history_offset)
    with_vector = previous_day_vectors(df, vectors, "feed_id", width, vector_column, salt_by=salt_by)
    joined = skew_safe_join(with_vector, profiles, ["device_id", "label_date"], "left", salt_by)
    similarity = dot(normalized(F.col(vector_column)), F.col("_profile")) / F.col("_items")
    return joined.select(*df.columns, vector_column, F.coalesce(similarity, F.lit(0.0)).alias(output))


def top_n(df: DataFrame, group: Sequence[str], order, n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows of each group with their rank; the limit also applies before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


#: Queries of one block, which a task holds while items stream past.
BLOCK_ROWS = 50_000

#: Items of one part; each part streams past every block of queries in a task of its own.
PART_ROWS = 250_000

#: Lists that leave a unit of work together.
LIST_ROWS = 4_096

#: Items that give each query a first bound for its n-th best score.
HEAD_ROWS = 4_096

#: Scores held at once inside a unit of work.
SCORE_CELLS = 2_000_000

#: Results that a unit of work holds for its queries; long lists have smaller blocks.
HELD_ROWS = 1_000_000

#: Lengths are told apart by sixteenths of a factor of two; the zero vector has a class of its own.
_CLASSES_A_DOUBLING, _ZERO_CLASS = 16, -20_000


def _length_class(length: Column) -> Column:
    return F.when(length > 0, F.floor(F.log2(length) * _CLASSES_A_DOUBLING)).otherwise(F.lit(_ZERO_CLASS)).cast("int")


def _with_length(df: DataFrame) -> DataFrame:
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda total, v: total + v * v))
    return df.select("id", F.col("vec").cast("array<double>").alias("vec"), length.alias("length"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the `n` best entries of each row: higher scores, then smaller ids."""
    order = np.lexsort((-scores, rows))
    same = (np.diff(rows[order]) == 0) & (np.diff(scores[order]) == 0)
    if same.any():  # ids are compared only where scores are equal
        tied = order[np.append(same, False) | np.append(False, same)]
        place = np.zeros(len(rows), np.int64)
        place[tied] = np.unique(ids[tied], return_inverse=True)[1]
        order = np.lexsort((place, -scores, rows))
    rows = rows[order]
    first = np.searchsorted(rows, rows, "left")
    return order[np.arange(len(rows)) - first < n]


class _Best:
    """A block of queries and the best items that have passed it."""

    def __init__(self, n: int, exclude: bool, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, bounds: np.ndarray):
        self.n, self.exclude, self.ids, self.vectors, self.lengths, self.bounds = n, exclude, ids, vectors, lengths, bounds
        self.held, self.count = [], 0

    def meet(self, ids: np.ndarray, vectors: np.ndarray, longest: float) -> bool:
        """Take in items of length `longest` at most; False if no item so short can be among the best of any query."""
        # By Cauchy and Schwarz; the slack is for rounding. Equal scores count, since the smaller id wins.
        can = np.flatnonzero(self.lengths * longest * (1 + 1e-9) + 1e-300 >= self.bounds)
        if not len(can):
            return False
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        step = max(1, SCORE_CELLS // len(ids))
        for k in range(0, len(can), step):
            rows = can[k : k + step]
            # A matrix product rounds by a score's place in it; those that may win are computed again, each for itself.
            slack = 1e-12 * self.lengths[rows] * longest
            scores = self.vectors[rows] @ vectors.T
            passed = scores >= (self.bounds[rows] - slack)[:, None]
            many = np.flatnonzero(np.count_nonzero(passed, axis=1) > 4 * (self.n + 1))
            if len(many):  # with nothing known of a query's bound: its best here, one more for itself
                least = -np.partition(-scores[many], self.n, axis=1)[:, self.n]
                passed[many] = scores[many] >= np.maximum(least - 2 * slack[many], self.bounds[rows[many]] - slack[many])[:, None]
            at, item = np.divmod(np.flatnonzero(passed.ravel()), len(ids))
            at = rows[at]
            score = (self.vectors[at] * vectors[item]).sum(axis=1)
            kept = score >= self.bounds[at]
            if self.exclude:
                kept &= self.ids[at] != ids[item]
            self.held.append((at[kept], ids[item[kept]], score[kept]))
            self.count += int(kept.sum())
            if self.count > 2 * max(HELD_ROWS, self.n * len(self.ids)):
                self.tighten()
        return True

    def tighten(self) -> None:
        """Keep the best and raise each query's bound to the score of its n-th."""
        row, item, score = (np.concatenate(c) for c in zip(*self.held, strict=True))
        best = _best_of(row, item, score, self.n)
        row, item, score = row[best], item[best], score[best]
        self.held, self.count = [(row, item, score)], len(row)
        counts = np.bincount(row, minlength=len(self.ids))
        full = np.flatnonzero(counts >= self.n)
        self.bounds[full] = np.maximum(self.bounds[full], score[np.cumsum(counts)[full] - 1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, score), the best first within each row."""
        self.tighten()
        return self.held[0]


def _first_bounds(n: int, exclude: bool):
    """Queries of a block against the head: each query's n-th best score there."""

    def run(queries: pa.Table, head: pa.Table) -> pa.Table:
        bounds = np.full(queries.num_rows, -np.inf)
        if queries.num_rows and head.num_rows:
            vectors, items = _matrix(queries["vec"]), _matrix(head["head_vec"])
            own, others = queries["id"].to_numpy(), head["head_id"].to_numpy()
            step = max(1, SCORE_CELLS // len(items))
            for k in range(0, len(vectors), step):
                scores = vectors[k : k + step] @ items.T
                if exclude:
                    scores[own[k : k + step, None] == others[None, :]] = -np.inf
                if n <= scores.shape[1]:
                    bounds[k : k + step] = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
        # Rounding may differ between matrix products of different shapes.
        return queries.append_column("bound", pa.array(bounds - 1e-9 * np.abs(bounds)))

    return run


def _stream_past(n: int, exclude: bool, fields: pa.Schema, lists: bool = False):
    """Rows (block, part, kind, falling length, ...): the queries of a unit, then its items, the longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, best, waiting, open_ = None, None, [], True

        def finish() -> Iterator[pa.RecordBatch]:
            if best is None or not best.count:
                return
            row, item, score = best.found()
            if not lists:
                yield pa.RecordBatch.from_arrays([pa.array(best.ids[row], fields.field(0).type), pa.array(item, fields.field(1).type), pa.array(score)], schema=fields)
                return
            head = np.flatnonzero(np.diff(row, prepend=-1))
            for first in range(0, len(head), LIST_ROWS):
                part = head[first : first + LIST_ROWS]
                end = head[first + LIST_ROWS] if first + LIST_ROWS < len(head) else len(row)
                cuts = pa.array(np.append(part, end) - part[0], pa.int32())
                columns = [pa.ListArray.from_arrays(cuts, pa.array(x[part[0] : end], fields.field(i).type.value_type)) for i, x in ((1, item), (2, score))]
                yield pa.RecordBatch.from_arrays([pa.array(best.ids[row[part]], fields.field(0).type), *(c.cast(fields.field(i).type) for i, c in enumerate(columns, 1))], schema=fields)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "part", "kind")])
            heads = np.append(0, np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1) if batch.num_rows else []
            for a, b in zip(heads, np.append(heads, batch.num_rows)[1:], strict=True):
                rows = batch.slice(a, b - a)
                if unit != tuple(keys[:2, a]):
                    yield from finish()
                    unit, best, waiting, open_ = tuple(keys[:2, a]), None, [], True
                if keys[2, a] == 0:
                    waiting.append(rows)
                    continue
                if waiting:
                    held = pa.Table.from_batches(waiting)
                    best, waiting = _Best(n, exclude, held["query_id"].to_numpy(), _matrix(held["vec"]), held["length"].to_numpy(), held["bound"].to_numpy().copy()), []
                if best is not None and open_:
                    open_ = best.meet(rows.column("item_id").to_numpy(zero_copy_only=False), _matrix(rows.column("vec")), float(rows.column("length")[0].as_py()))
        yield from finish()

    return run


def _units(queries: DataFrame, items: DataFrame, n: int, exclude: bool, block_rows: int, part_rows: int | None = None) -> DataFrame:
    """(block, part, kind, query_id, item_id, vec, length, bound): which items each block of queries has to see."""
    parallelism = queries.sparkSession.sparkContext.defaultParallelism
    block_rows = min(block_rows, max(1, HELD_ROWS // n))
    queries, items = _with_length(queries), _with_length(items).withColumn("class", _length_class(F.col("length")))

    def several(rows: DataFrame, size: int, least: int) -> Column:
        """How many pieces of `size` rows; small data still gets up to `least`. A scalar subquery: nothing runs yet."""
        n = F.count(F.lit(1))
        return rows.agg(F.greatest(F.ceil(n / size), F.least(F.lit(least), F.ceil(n / 256)), F.lit(1)).alias("n")).scalar()

    blocks, parts = several(queries, block_rows, parallelism), several(items, part_rows or PART_ROWS, 1)
    # A query of length 0 can be bounded by nothing; such ones have blocks of their own, with negative numbers.
    place = F.pmod(F.xxhash64("id"), blocks)
    queries = queries.withColumn("block", F.when(F.col("length") > 0, place).otherwise(-1 - place))
    # The head: some of the longest items. Any items would give true bounds; long ones give high ones.
    falling = Window.orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, 0)  # one row for each class of lengths
    counted = items.groupBy("class").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(falling))
    enough = F.col("upto") >= HEAD_ROWS
    cut = counted.agg(
        F.struct(F.coalesce(F.max(F.when(enough, F.col("class"))), F.min("class")).alias("class"), F.coalesce(F.min(F.when(enough, F.col("upto"))), F.max("upto")).alias("n")).alias("cut")
    ).scalar()
    chosen = (F.col("class") >= cut["class"]) & (F.xxhash64("id", F.lit("head")) / F.lit(2.0**64) + 0.5 <= F.lit(float(HEAD_ROWS)) / cut["n"])
    head = items.where(chosen).select(F.col("id").alias("head_id"), F.col("vec").alias("head_vec"), F.explode(F.sequence(-blocks, blocks - 1)).alias("block"))
    kind = dict(queries.dtypes)["id"]
    bounded = queries.groupBy("block").cogroup(head.groupBy("block")).applyInArrow(_first_bounds(n, exclude), f"id {kind}, vec array<double>, length double, block long, bound double")

    # Items shorter than the block's smallest bound over its queries' lengths cannot win.
    least = F.min(F.when(F.col("length") > 0, F.col("bound") / F.col("length")).otherwise(F.lit(-math.inf))) * (1 - 1e-9)
    shortest = F.when(least > 0, _length_class(least)).otherwise(F.lit(_ZERO_CLASS))
    classes = items.agg(F.collect_set("class")).scalar()
    numbers = F.sequence(F.lit(0).cast("long"), parts - 1)
    wanted = bounded.groupBy("block").agg(shortest.alias("shortest")).withColumn("classes", classes)
    wanted = wanted.select("block", "shortest", F.explode("classes").alias("class")).where("class >= shortest").drop("shortest")
    wanted = wanted.withColumn("part", F.explode(numbers))
    item_part = F.pmod(F.xxhash64("id"), parts)
    shown = items.withColumn("part", item_part).join(wanted, ["class", "part"])
    none = F.lit(None)
    kinds = {"query_id": kind, "item_id": dict(items.dtypes)["id"]}
    left = bounded.select("block", F.explode(numbers).alias("part"), F.lit(0).alias("kind"), F.col("id").alias("query_id"), none.cast(kinds["item_id"]).alias("item_id"), "vec", "length", "bound")
    right = shown.select("block", "part", F.lit(1).alias("kind"), none.cast(kind).alias("query_id"), F.col("id").alias("item_id"), "vec", "length", none.cast("double").alias("bound"))
    return left.unionByName(right)


def _ordered(units: DataFrame) -> DataFrame:
    """Units by task. Their bytes tell little of their work, so tasks are not merged by size: the number is given."""
    spark = units.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    return units.repartition(tasks, "block", "part").sortWithinPartitions("block", "part", "kind", F.desc("length"))


def top_n_by_dot(queries: DataFrame, items: DataFrame, n: int, exclude_same_id: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, item_id, score, rank): exact top `n` items by inner product for each query.

    Both inputs are (id, vec). Queries are hashed into blocks of bounded size. A few of the longest items give each query a
    first bound for its n-th best score. Only items that are long enough to beat a block's bounds are sent to it, and they
    stream past it from the longest on, while the bounds rise; a task stops at the first item that is too short to win. So
    a task holds one block of queries, whatever the number of items, and skewed lengths save most of the pairs. With equal
    lengths every item has to be seen. No job runs while the plan is built.
    """
    types = {"query_id": queries.schema["id"].dataType.simpleString(), "item_id": items.schema["id"].dataType.simpleString()}
    schema = f"query_id {types['query_id']}, item_id {types['item_id']}, score double"
    fields = to_arrow_schema(StructType.fromDDL(schema))
    ordered = _ordered(_units(queries, items, n, exclude_same_id, block_rows))
    partial = ordered.mapInArrow(_stream_past(n, exclude_same_id, fields), schema)
    return top_n(partial, ["query_id"], [F.col("score").desc(), F.col("item_id")], n)


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                vectors = np.column_stack([np.ones(batch.num_rows), _matrix(batch.column("vec"))])
                total += vectors.T @ vectors
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"])

    return run


def _moved(matrix: np.ndarray, origin: np.ndarray, mean: np.ndarray):
    """(id, vec, shift): vectors from `origin` times `matrix`, and their own product with the mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vec"))
            moved = ((vectors - origin) @ matrix).astype(float)
            cuts = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(mean))
            yield pa.record_batch([batch.column("id"), pa.ListArray.from_arrays(cuts, pa.array(moved.ravel())), pa.array((vectors * mean).sum(axis=1))], names=["id", "vec", "shift"])

    return run


def top_lists_by_dot(queries: DataFrame, items: DataFrame, n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, ids, scores): `top_n_by_dot` with one ordered list for each query, for short dense vectors such as factors.

    Factors lie around a mean far from the origin, and lengths tell little of who wins. A query's order of items stays if
    all items are moved by one vector, and if items are multiplied by a matrix and queries by its inverse. So items are
    moved to their mean and made equally wide in all directions; then only the outermost are long enough to win, a small
    part of very many. The moments of the items are computed by a job while this is built. All items of a block pass one
    task in a stream, so no partial lists are merged.
    """
    types = {"query_id": queries.schema["id"].dataType.simpleString(), "item_id": items.schema["id"].dataType.simpleString()}
    queries, items = (t.select("id", F.col("vec").cast("array<double>").alias("vec")) for t in (queries, items))
    first = items.select(F.size("vec").alias("n")).first() or queries.select(F.size("vec").alias("n")).first()
    width = first["n"] if first else 0
    sums = items.select("vec").mapInArrow(_moments(width), "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros((width + 1) ** 2)
    for r in sums.collect():
        total[r["place"]] = r["value"]
    total = total.reshape(width + 1, width + 1) / max(total[0], 1)
    mean = total[0, 1:]
    spread, axes = np.linalg.eigh(total[1:, 1:] - np.outer(mean, mean)) if width else (np.empty(0), np.empty((0, 0)))
    # Any widths keep the order; those of a direction without spread must not be zero.
    wide = np.sqrt(np.maximum(spread, max(spread.max(initial=0), 1e-30) * 1e-9))
    zero = np.zeros(width)
    asked = queries.mapInArrow(_moved(axes * wide, zero, mean), f"id {types['query_id']}, vec array<double>, shift double")
    offered = items.mapInArrow(_moved(axes / wide, mean, zero), f"id {types['item_id']}, vec array<double>, shift double")
    schema = f"query_id {types['query_id']}, ids array<{types['item_id']}>, scores array<double>"
    units = _ordered(_units(asked.drop("shift"), offered.drop("shift"), n, False, block_rows, 1 << 60))
    lists = units.mapInArrow(_stream_past(n, False, to_arrow_schema(StructType.fromDDL(schema)), True), schema)
    shifts = asked.select(F.col("id").alias("query_id"), "shift")
    return lists.join(shifts, "query_id").select("query_id", "ids", F.transform("scores", lambda s: s + F.col("shift")).alias("scores"))


def similar_items(vectors: DataFrame, n: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, item_id, score, rank): exact `n` nearest neighbours by cosine, without the vector itself."""
    unit = vectors.select("id", normalized(F.col("vec")).alias("vec"))
    return top_n_by_dot(unit, unit, n, exclude_same_id=True, block_rows=block_rows)


def as_lists(ranked: DataFrame, query: str = "query_id", output: str = "recommendations") -> DataFrame:
    """Ranked rows of `top_n_by_dot` (at most n per query) as one ordered array per query."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "item_id")))
    return ranked.groupBy(query).agg(F.transform(entries, lambda e: e["item_id"]).alias(output))
