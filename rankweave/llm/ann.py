"""Approximate nearest neighbours by inner product: inverted lists, scanned in column blocks with early abandoning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.learning import first_by_hash


@dataclass(frozen=True)
class Settings:
    """`sample` vectors fit the lists, whose number is the root of the number of vectors, at most `lists`. A query looks
    into `probe` of the lists and `least_lists` at least. Columns are read in blocks that end at `blocks`; after d of D
    columns a candidate goes if its distance so far, times D / d, is over the bound times (1 + `doubt` / root of d)^2.
    A list is cut into parts of about `part` vectors, and parts are dealt to groups of about `group` vectors; queries are dealt to
    blocks of about `asked`, and a task has one block and one group."""

    neighbours: int = 20
    sample: int = 20_000
    lists: int = 4096
    probe: float = 0.7
    least_lists: int = 16
    blocks: tuple[int, ...] = (16, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024)
    doubt: float = 2.1
    part: int = 4096
    group: int = 100_000
    asked: int = 32_768
    rounds: int = 10
    seed: int = 5


def usable(vector: Column) -> Column:
    """True for vectors that have components, none of them null or not finite, and not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of matching rows in double precision, summed from the first component on: equal for equal rows."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


@dataclass
class Lists:
    """The fitted lists and what a query needs besides: sizes, and the sample with its lists."""

    centres: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    sample_list: np.ndarray
    sizes: np.ndarray
    rotation: np.ndarray

    def fields(self) -> tuple:
        """Plain arrays: what a broadcast holds is read by name, and executors need not have this package."""
        return self.centres, self.sample_ids, self.sample, self.sample_list, self.sizes, self.rotation

    def nearness(self, x: np.ndarray) -> np.ndarray:
        """Smaller is nearer: squared distances to the centres, less the vector's own square."""
        return (self.centres**2).sum(axis=1) - 2 * x @ self.centres.T

    def turned(self, x: np.ndarray, reach: float) -> np.ndarray:
        """Rotated vectors with one component more, which gives all the length `reach`: then near is a large product."""
        rest = np.sqrt(np.maximum(reach**2 - (x**2).sum(axis=1), 0))
        return (np.hstack([x, rest[:, None]]) @ self.rotation).astype(np.float32)

    def turned_queries(self, q: np.ndarray) -> np.ndarray:
        return (np.hstack([q, np.zeros((len(q), 1))]) @ self.rotation).astype(np.float32)


def norm_classes(x: np.ndarray) -> np.ndarray:
    """Vectors of one class differ in length by a factor of 2 at most; lengths about 1 are within one class."""
    return np.floor(np.log2(np.sqrt((x**2).sum(axis=1))) + 0.5).astype(np.int64)


def _fit(ids: np.ndarray, x: np.ndarray, count: int, s: Settings) -> Lists:
    random = np.random.default_rng(s.seed)
    number = int(min(s.lists, max(1, np.sqrt(count)), len(x)))
    centres = x[random.permutation(len(x))[:number]].copy()
    for _ in range(s.rounds):
        home = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        held = np.bincount(home, minlength=number)
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        centres = np.where(held[:, None] > 0, total / np.maximum(held, 1)[:, None], centres)
    home = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
    rotation = np.linalg.qr(random.standard_normal((x.shape[1] + 1, x.shape[1] + 1)))[0]
    return Lists(centres, ids, x, home, np.zeros(number, np.int64), rotation)


def _best(query: np.ndarray, score: np.ndarray, vector: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the `keep` best of each query: higher scores, then smaller ids; one entry for an id."""
    order = np.lexsort((vector, -score, query))
    q, v = query[order], vector[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
    order, q = order[fresh], q[fresh]
    head = np.flatnonzero(np.diff(q, prepend=-1)) if len(q) else np.empty(0, int)
    place = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
    return order[place < keep]


def _bounds(query: np.ndarray, score: np.ndarray, count: int, keep: int) -> np.ndarray:
    """The `keep`-th best score of each query, minus infinity if it has fewer. Entries are ordered by query, best first."""
    out = np.full(count, -np.inf)
    held = np.bincount(query, minlength=count)
    last = np.cumsum(held) - held + keep - 1
    full = held >= keep
    out[full] = score[last[full]]
    return out


def scan(reach: float, ids: np.ndarray, blocks: list[np.ndarray], cuts: list[int], q: np.ndarray, turned: np.ndarray, own: np.ndarray, bound: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) positions that no test abandoned, for all queries against all vectors of one list and length class.

    `bound` is each query's score to beat; as squared distance it is |q|^2 + reach^2 - 2 x score. Distances are summed in
    single precision; `slack` is over their rounding error, which grows with the lengths and the number of columns.
    """
    width = cuts[-1]
    long = np.sqrt((q**2).sum(axis=1))
    limit = long**2 + reach**2 - 2 * bound
    slack = 1e-4 + (width + 8) * float(np.finfo(np.float32).eps) * (long + reach) ** 2
    found_q, found_x = [], []
    step = max(1, (1 << 22) // max(1, len(ids)))
    for first in range(0, len(q), step):
        part = slice(first, first + step)
        a, b = turned[part, : cuts[0]], blocks[0]
        so_far = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
        allow = limit[part] * (cuts[0] / width) * (1 + s.doubt / np.sqrt(cuts[0])) ** 2
        at_q, at_x = np.nonzero(so_far <= (allow + slack[part])[:, None])
        so_far = so_far[at_q, at_x]
        at_q = at_q + first
        for k in range(1, len(cuts)):
            some = (1 << 24) // (cuts[k] - cuts[k - 1])
            for f in range(0, len(at_q), some):
                gap = turned[at_q[f : f + some], cuts[k - 1] : cuts[k]] - blocks[k][at_x[f : f + some]]
                so_far[f : f + some] += (gap**2).sum(axis=1)
            allow = limit[at_q] * (cuts[k] / width) * (1 + (s.doubt / np.sqrt(cuts[k]) if k < len(cuts) - 1 else 0)) ** 2
            kept = so_far <= allow + slack[at_q]
            at_q, at_x, so_far = at_q[kept], at_x[kept], so_far[kept]
        found_q.append(at_q)
        found_x.append(at_x)
    at_q, at_x = np.concatenate(found_q), np.concatenate(found_x)
    other = ids[at_x] != own[at_q]
    return at_q[other], at_x[other]


def search(vectors: DataFrame, queries: Column, settings: Settings = Settings(), *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The nearest rows of each query row: query_id, rank (from 1), `id`, score (the inner product in double precision).

    Queries are the rows where `queries` holds; candidates are all rows with another id. Ties go to the smaller id; a
    query has all candidates if there are no more than `neighbours`. Null and zero vectors and those with a null or
    non-finite component take no part, nor do rows with a null id or of another dimension than most. Ids are whole
    numbers; repeated ids give one result each. Other columns are not read.

    Lists are fitted on a bounded sample, the first rows by a hash of the id; every row is put into its list. Lists are
    cut into parts by a hash of the id and parts are dealt to groups, so a list with a third of all rows is spread over
    many tasks. A query travels once to each group that holds a list it looks into. Queries are dealt to blocks by a hash
    of id and vector, equal rows asking once, and each block has its copy of a group, so that a task's queries are bounded. It starts with the bound of its best
    sample vectors in those lists, and each list that a group has scanned tightens it.
    """
    s, spark = settings, vectors.sparkSession
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    kinds = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).orderBy(F.desc("n"), "d").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double").withColumnRenamed("id", id)
    if not kinds:
        return empty
    width, count, asking_rows = kinds[0]
    rows = rows.where(F.size("v") == width)
    sample = first_by_hash(rows.select("id", "v"), "id", s.sample).toArrow()
    lists = _fit(sample.column("id").to_numpy(), _matrix(sample.column("v")), count, s)
    cuts = [c for c in s.blocks if c < width + 1] + [width + 1]
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(shuffle, -(-count // s.group))
    query_blocks = max(1, -(-asking_rows // s.asked))
    shipped = spark.sparkContext.broadcast(lists.fields())  # the sample and the centres: bounded by the settings

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(*shipped.value)
        for batch in batches:
            home = lists.nearness(_matrix(batch.column("v"))).argmin(axis=1) if batch.num_rows else np.empty(0, int)
            yield pa.record_batch([batch.column("id"), batch.column("v"), pa.array(home.astype(np.int32))], names=["id", "v", "list"])

    homed = rows.select("id", "v").mapInArrow(put, "id long, v array<double>, list int")
    held = homed.groupBy("list").count().collect()  # one row for each list
    lists.sizes[[r[0] for r in held]] = [r[1] for r in held]
    parts = -(-lists.sizes // s.part)
    shipped = spark.sparkContext.broadcast(lists.fields())
    part_count = spark.createDataFrame([(k, int(p)) for k, p in enumerate(parts)], "list int, parts int")
    cells = homed.join(F.broadcast(part_count), "list").select(
        F.pmod(F.xxhash64("list", F.pmod(F.xxhash64("id"), F.col("parts"))), F.lit(groups)).cast("int").alias("group"), "list", "id", "v"
    )
    cells = cells.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))) if query_blocks > 1 else F.lit(0))
    places = part_count.select("list", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)).alias("p"))
    places = places.select("list", F.pmod(F.xxhash64("list", F.col("p").cast("long")), F.lit(groups)).cast("int").alias("group")).groupBy("list").agg(F.collect_set("group").alias("groups"))
    # At most `lists` rows, each with at most `groups` numbers.
    spread = {r.list: sorted(r.groups) for r in places.collect()}
    where = spark.sparkContext.broadcast(spread)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, spread = Lists(*shipped.value), where.value
        probes = max(int(np.ceil(s.probe * len(lists.sizes))), min(s.least_lists, len(lists.sizes)))
        for batch in batches:
            every, every_id, every_block = _matrix(batch.column("v")), batch.column("id").to_numpy(), batch.column("block").to_numpy()
            for begin in range(0, len(every), 256):
                q, own, block = (a[begin : begin + 256] for a in (every, every_id, every_block))
                order = np.argsort(lists.nearness(q), axis=1, kind="stable")
                # More lists, if these hold too few vectors for a full answer.
                enough = (np.cumsum(lists.sizes[order], axis=1) < 2 * s.neighbours + 1).sum(axis=1) + 1
                number = np.minimum(np.maximum(probes, enough), order.shape[1])
                looks = np.zeros((len(q), len(lists.sizes)), bool)
                np.put_along_axis(looks, order, np.arange(order.shape[1]) < number[:, None], axis=1)
                near = q @ lists.sample.T
                near[~looks[:, lists.sample_list] | (lists.sample_ids == own[:, None])] = -np.inf
                top = np.argsort(-near, axis=1, kind="stable")[:, : s.neighbours]
                out: list[list] = [[], [], [], [], [], [], [], []]
                for i in range(len(q)):
                    seeds = top[i][np.isfinite(near[i, top[i]])]
                    scores = dot(np.repeat(q[i : i + 1], len(seeds), axis=0), lists.sample[seeds])
                    bound = scores.min() if len(seeds) == s.neighbours else -np.inf
                    mine: dict[int, list[int]] = {}
                    for k in order[i, : number[i]].tolist():
                        for g in spread[k]:
                            mine.setdefault(g, []).append(k)
                    for n, (g, ks) in enumerate(mine.items()):
                        first = n == 0
                        for column, value in zip(out, (g, block[i], own[i], q[i], ks, bound, lists.sample_ids[seeds] if first else [], scores if first else []), strict=True):
                            column.append(value)
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["group", "block", "query", "q", "lists", "bound", "seeds", "scores"])

    asks = rows.where("asks").select("id", "v")
    asks = asks.distinct() if query_blocks > 1 else asks
    asks = asks.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(query_blocks)).cast("int"))
    asking = asks.mapInArrow(ask, "group int, block int, query long, q array<double>, lists array<int>, bound double, seeds array<long>, scores array<double>")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = Lists(*shipped.value)
        own, bound = right.column("query").to_numpy(), right.column("bound").to_numpy().copy()
        seeds, scores = right.column("seeds").combine_chunks(), right.column("scores").combine_chunks()
        found_q = np.repeat(np.arange(len(own)), seeds.value_lengths().to_numpy())
        found_id, found_score = seeds.flatten().to_numpy(), scores.flatten().to_numpy()
        if left.num_rows and right.num_rows:
            x, home = _matrix(left.column("v")), left.column("list").to_numpy()
            kind = norm_classes(x)
            order = np.lexsort((kind, home))
            x, ids, home, kind = x[order], left.column("id").to_numpy()[order], home[order], kind[order]
            edges = np.append(np.flatnonzero((np.diff(home, prepend=-1) != 0) | (np.diff(kind, prepend=0) != 0)), len(home))
            edges = np.unique(np.append(0, edges))
            q = _matrix(right.column("q"))
            turned_q = lists.turned_queries(q)
            looked = right.column("lists").combine_chunks()
            asked, by = looked.flatten().to_numpy(), np.repeat(np.arange(len(own)), looked.value_lengths().to_numpy())
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                who = by[asked == home[a]]
                if not len(who):
                    continue
                reach = float(np.sqrt((x[a:b] ** 2).sum(axis=1).max())) * (1 + 1e-12)
                turned = lists.turned(x[a:b], reach)
                blocks = [np.ascontiguousarray(turned[:, p:c]) for p, c in zip([0, *cuts[:-1]], cuts, strict=True)]
                at_q, at_x = scan(reach, ids[a:b], blocks, cuts, q[who], turned_q[who], own[who], bound[who], s)
                score = np.concatenate([dot(q[who[at_q[f : f + 100_000]]], x[a:b][at_x[f : f + 100_000]]) for f in range(0, len(at_q), 100_000)] or [np.empty(0)])
                found_q = np.concatenate([found_q, who[at_q]])
                found_id = np.concatenate([found_id, ids[a:b][at_x]])
                found_score = np.concatenate([found_score, score])
                best = _best(found_q, found_score, found_id, s.neighbours)
                found_q, found_score, found_id = found_q[best], found_score[best], found_id[best]
                bound = np.maximum(bound, _bounds(found_q, found_score, len(own), s.neighbours))
        kept = found_score >= bound[found_q]
        return pa.table({"query_id": own[found_q[kept]], "id": found_id[kept], "score": found_score[kept]})

    found = cells.groupBy("group", "block").cogroup(asking.groupBy("group", "block")).applyInArrow(meet, "query_id long, id long, score double")
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.neighbours)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
