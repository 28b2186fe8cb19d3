"""Exact self-join of 64-bit fingerprints within a Hamming distance, by vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.storage import settle
from rankweave.llm.text import frugal


class Settings(NamedTuple):
    """`leaf` fingerprints are compared with each other directly. A shard aims at `shard_rows` of them, fewer if that
    leaves less than `shards_per_partition` shards for each shuffle partition, but never under `least_rows`. The tree that
    cuts shards is grown on a sample of about `sample` fingerprints for each shard; there are `most_shards` at most."""

    leaf: int = 64
    shard_rows: int = 1 << 22
    shards_per_partition: int = 4
    least_rows: int = 1024
    sample: int = 32
    most_shards: int = 1 << 16
    candidates: int = 12


#: Cuts that part less than 2 % are taken last, and not at all from this many points or fewer: those are compared directly.
_LOPSIDED, _ALIKE = 1e6, 4096


class Tree(NamedTuple):
    """Node k keeps its vantage point; fingerprints at most `cut[k]` bits from it go to `near[k]`, others to `far[k]`.
    A leaf has the cut -1, and its number in `near`."""

    vantage: np.ndarray
    cut: np.ndarray
    near: np.ndarray
    far: np.ndarray


def _best_cut(points: np.ndarray, reach: int, candidates: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """The vantage point and cut with the fewest points near the cut for what the cut tells. None if no cut is worth it."""
    vantage = np.unique(rng.choice(points, min(candidates, len(points)), replace=False))
    far = np.bitwise_count(vantage[:, None] ^ points[None, :]).astype(np.int64)
    table = np.bincount((far + 65 * np.arange(len(vantage))[:, None]).ravel(), minlength=65 * len(vantage)).reshape(-1, 65)
    upto = np.cumsum(table, axis=1)
    share = upto[:, :-1] / len(points)
    padded = np.pad(upto, ((0, 0), (reach, reach)), mode="edge")
    padded[:, :reach] = 0
    band = (padded[:, 2 * reach : -1] - padded[:, : -2 * reach - 1]) / len(points)
    with np.errstate(divide="ignore", invalid="ignore"):
        told = -(share * np.log2(share) + (1 - share) * np.log2(1 - share))
        cost = np.where((share > 0) & (share < 1), (1 + band) / told, np.inf)
        cost = np.where(np.minimum(share, 1 - share) < 0.02, cost + _LOPSIDED, cost)
    k, cut = np.unravel_index(int(np.argmin(cost)), cost.shape)
    if not np.isfinite(cost[k, cut]) or (cost[k, cut] >= _LOPSIDED and len(points) <= _ALIKE):
        return None
    return vantage[k], int(cut)


def grow(points: np.ndarray, leaf: int, reach: int, candidates: int, seed: int = 7) -> Tree:
    """A tree over the points with at most about `leaf` of them in a leaf."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    leaves = 0
    waiting = [(points, -1, 0)]
    while waiting:
        mine, parent, side = waiting.pop()
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        found = _best_cut(mine, reach, candidates, rng) if len(mine) > leaf else None
        if found is None:
            nodes.append([np.uint64(0), -1, leaves, -1])
            leaves += 1
            continue
        vantage, cut = found
        close = np.bitwise_count(mine ^ vantage) <= cut
        waiting += [(mine[~close], len(nodes), 1), (mine[close], len(nodes), 0)]
        nodes.append([vantage, cut, -1, -1])
    vantage, cut, near, far = zip(*nodes, strict=True)
    return Tree(np.array(vantage, np.uint64), np.array(cut, np.int16), np.array(near, np.int32), np.array(far, np.int32))


def route(tree: tuple, points: np.ndarray, guest: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, index into points, guest): where each point has to be.

    Every point is at home in one leaf. If it goes near and another within `reach` of it may go far, it goes far as a
    guest too; by the triangle inequality that is so only if its distance is above cut - reach. A guest goes to each
    side that may hold a point within reach of it. So two points within reach of each other meet in the leaf where one of
    them is at home, exactly once: sides part at one node, and from there on the near one follows as a guest.
    """
    vantage, cut, near, far = tree
    at = np.zeros(len(points), np.int32)
    which = np.arange(len(points))
    done: list[tuple] = []
    while len(at):
        stop = cut[at] < 0
        if stop.any():
            done.append((near[at[stop]], which[stop], guest[stop]))
            at, which, guest = at[~stop], which[~stop], guest[~stop]
        if not len(at):
            break
        distance = np.bitwise_count(points[which] ^ vantage[at]).astype(np.int16)
        limit = cut[at]
        to_near = np.where(guest, distance - reach <= limit, distance <= limit)
        to_far = distance + reach > limit
        as_guest = guest | (distance <= limit)
        at = np.concatenate([near[at[to_near]], far[at[to_far]]])
        which, guest = np.concatenate([which[to_near], which[to_far]]), np.concatenate([guest[to_near], as_guest[to_far]])
    if not done:
        return np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _groups(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and the homes of a matrix rows x homes: the smallest home each is connected with; the number of homes
    if a row is close to none."""
    none = close.shape[1]
    label = np.arange(none)
    while True:
        of_rows = np.where(close, label[None, :], none).min(axis=1)
        of_homes = np.minimum(np.where(close, of_rows[:, None], none).min(axis=0), label)
        if (of_homes == label).all():
            return of_rows, label
        label = of_homes


def _links(homes: np.ndarray, bounds: np.ndarray, leaf: np.ndarray, rows: np.ndarray, at_home: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the rows of each leaf with the homes within reach: fewer than rows and homes, whatever the
    number of pairs. Leaf k has homes[bounds[k] : bounds[k + 1]]; rows that are homes themselves are marked."""
    order = np.argsort(leaf, kind="stable")
    leaf, rows, at_home = leaf[order], rows[order], at_home[order]
    heads = np.flatnonzero(np.diff(leaf, prepend=-1))
    for a, b in zip(heads, np.append(heads, len(leaf))[1:], strict=True):
        part = homes[bounds[leaf[a]] : bounds[leaf[a] + 1]]
        if not len(part):
            continue
        step = max((1 << 20) // len(part), 1)
        for k in range(a, b, step):
            mine = rows[k : min(k + step, b)]
            close = np.bitwise_count(mine[:, None] ^ part[None, :]) <= reach
            if np.count_nonzero(close) == np.count_nonzero(at_home[k : k + len(mine)]):
                continue  # homes have met themselves alone
            of_rows, of_homes = _groups(close)
            has = np.flatnonzero((of_rows < len(part)) & ~at_home[k : k + len(mine)])
            moved = np.flatnonzero(of_homes != np.arange(len(part)))
            yield np.concatenate([mine[has], part[moved]]), part[np.concatenate([of_rows[has], of_homes[moved]])]


def _join_shards(reach: int, leaf: int, candidates: int):
    """Rows (shard, guest, fp) sorted by shard and guest, as links (a, b)."""

    def linked(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for one, two in found:
            yield pa.record_batch([pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, gathered, placed = -1, [], None

        def settle_homes() -> Iterator[pa.RecordBatch]:
            """Grow the shard's tree, join its homes, and keep them by leaf for the guests."""
            nonlocal placed
            points = np.concatenate(gathered)
            gathered.clear()
            tree = grow(points, leaf, reach, candidates)
            at, which, visiting = route(tree, points, np.zeros(len(points), bool), reach)
            own = np.flatnonzero(~visiting)
            own = own[np.argsort(at[own], kind="stable")]
            bounds = np.searchsorted(at[own], np.arange(int(tree.near[tree.cut < 0].max()) + 2))
            placed = (tree, points[which[own]], bounds)
            yield from linked(_links(placed[1], bounds, at, points[which], ~visiting, reach))

        for batch in batches:
            shards, guests = batch.column("shard").to_numpy(), batch.column("guest").to_numpy(zero_copy_only=False)
            points = batch.column("fp").to_numpy().view(np.uint64)
            heads = np.flatnonzero(np.diff(shards.astype(np.int64) * 2 + guests, prepend=-1))
            for a, b in zip(heads, np.append(heads, len(shards))[1:], strict=True):
                if shards[a] != shard:
                    if gathered:
                        yield from settle_homes()
                    shard, placed = shards[a], None
                if not guests[a]:
                    gathered.append(points[a:b])
                    continue
                if gathered:
                    yield from settle_homes()
                if placed is None:
                    continue  # a shard without homes: nothing to meet
                tree, homes, bounds = placed
                at, which, visiting = route(tree, points[a:b], np.ones(b - a, bool), reach)
                yield from linked(_links(homes, bounds, at, points[a:b][which], ~visiting, reach))
        if gathered:
            yield from settle_homes()

    return run


def near_links(fingerprints: DataFrame, reach: int = 2, settings: Settings = Settings(), *, fp: str = "fp") -> DataFrame:
    """(a, b): links among the distinct 64-bit numbers in `fp` (long) that connect all that are within `reach` bits.

    Exact: two numbers are connected by links if and only if a chain of pairs within reach connects them. At most one
    link for a number in each leaf comes back, so no group of near copies yields all its pairs.

    A tree over a sample, grown in the driver, cuts the space into shards of like size: the sample only balances them. It
    has at most 65,536 leaves, some 32 numbers for each, whatever the table holds. A task has one shard at a time; it
    keeps the numbers at home there, grows a tree over them all, and sends the guests through it as they come. Numbers
    near a cut are copied into the shards that they reach. Nulls take no part.
    """
    s = settings
    spark = fingerprints.sparkSession
    known = settle(fingerprints.select(F.col(fp).alias("fp")).where("fp is not null").distinct())
    rows = known.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_shard = max(min(rows // (parts * s.shards_per_partition), s.shard_rows), s.least_rows, rows // s.most_shards)
    shards = rows // per_shard + 1
    rate = min(1.0, s.sample * shards / max(rows, 1))
    # A hash below a bound, not the first of an order: no task ever gathers more than its part of the sample.
    chosen = known.where(F.xxhash64("fp", F.lit("sample")) <= F.lit(min(int(rate * 2**64), 2**64 - 1) - 2**63)).toArrow()["fp"].to_numpy()
    points = np.sort(chosen).view(np.uint64)
    tree = tuple(grow(points, max(len(points) // shards, 1), reach, s.candidates))
    shipped = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shipped.value
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            at, which, guest = route(tree, values, np.zeros(len(values), bool), reach)
            yield pa.record_batch([pa.array(at), pa.array(guest), pa.array(values[which].view(np.int64))], names=["shard", "guest", "fp"])

    placed = known.mapInArrow(frugal(place), "shard int, guest boolean, fp long")
    sorted_ = placed.repartition("shard").sortWithinPartitions("shard", "guest")
    return sorted_.mapInArrow(frugal(_join_shards(reach, s.leaf, s.candidates)), "a long, b long")
