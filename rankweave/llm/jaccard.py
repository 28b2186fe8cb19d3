"""Exact Jaccard self-join of shingle sets: universe partition, segment signatures, one-deletion neighbourhoods.

Two sets with |r|, |s| elements and similarity of 0.75 or more differ in at most (|r| + |s|) / 7 elements. If the
universe is cut into segments by a hash, each differing element changes one segment. So a set that can point to more
segments than that, none of which another set shares, is not linked to it. A shared segment counts 1 if its subset is
equal in both; a segment with its one-deletion neighbourhood counts 2, as it is found unless two elements differ there.
Which of a set's shared segments are looked up is decided by their cost, the number of sets in them; the cheapest that
make up the count are enough. What they bring is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.graph import components
from rankweave.llm.text import frugal, give_back, mix, pieces, shingle_sets
from rankweave.llm.storage import settle
from rankweave.operators.joins import skew_safe_join

#: Text bytes in one chunk of documents.
CHUNK_BYTES = 4 << 20
_MAX_BAND = 40
#: Elements are counted by so many classes of their hashes.
_CLASSES = 32
#: A component's sets are dealt to so many tasks where they meet those of another.
_PARTS = 16


@dataclass(frozen=True)
class Segments:
    """Sizes from 2^k to 2^(k+1) - 1 are band k, cut into `density` x the largest size + `spare` segments; the first
    `neighbourhoods` of 1 of them are also looked up with one element left out."""

    density: float = 0.35
    spare: int = 16
    neighbourhoods: float = 0.04

    def count(self) -> np.ndarray:
        return np.ceil(self.density * (2.0 ** (np.arange(_MAX_BAND) + 1) - 1)).astype(np.int64) + self.spare

    def deep(self) -> np.ndarray:
        return np.ceil(self.neighbourhoods * self.count()).astype(np.int64)


@dataclass
class Signatures:
    """Signatures of a run of rows: sizes by row, and for each signature its row, layer (0 the own band, 1 the band
    below), segment, kind (0 the subset, 1 a one-deletion) and value."""

    size: np.ndarray
    row: np.ndarray
    layer: np.ndarray
    segment: np.ndarray
    kind: np.ndarray
    value: np.ndarray


def allowed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Most elements in which linked sets of these sizes differ."""
    return (a + b) // 7


def signatures(rows: np.ndarray, shingles: np.ndarray, count: int, segments: Segments) -> Signatures:
    size = np.bincount(rows, minlength=count)
    band = np.frexp(np.maximum(size, 1).astype(float))[1].astype(np.int64) - 1
    # Only a set near the lower end of its band can be linked to one of the band below.
    below = (size > 0) & ((3 * size + 3) // 4 <= (1 << band) - 1)
    parts = []
    for layer in (0, 1):
        mine = np.arange(len(rows)) if layer == 0 else np.flatnonzero(below[rows])
        if not len(mine):
            continue
        owner, element = rows[mine], mix(shingles[mine])
        level = band[owner] - layer
        segment = ((mix(shingles[mine] ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) * segments.count()[level].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((segment, owner))
        owner, element, segment, level = owner[order], element[order], segment[order], level[order]
        head = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(segment, prepend=-1) != 0))
        held = np.diff(np.append(head, len(owner)))
        whole = np.add.reduceat(element, head)
        place = mix(segment.astype(np.uint64) * np.uint64(_MAX_BAND) + level.astype(np.uint64) + np.uint64(1))
        parts.append((owner[head], np.full(len(head), layer), segment[head], np.zeros(len(head), int), mix(whole ^ place[head])))
        deep = np.flatnonzero((segment < segments.deep()[level]) & (np.repeat(held, held) >= 2))
        if len(deep):
            parts.append((owner[deep], np.full(len(deep), layer), segment[deep], np.ones(len(deep), int), mix((np.repeat(whole, held)[deep] - element[deep]) ^ place[deep])))
    if not parts:
        empty = np.empty(0, np.int64)
        return Signatures(size, empty, empty, empty, empty, np.empty(0, np.uint64))
    return Signatures(size, *(np.concatenate(x) for x in zip(*parts, strict=True)))


def _digests(rows: np.ndarray, shingles: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each row's set: equal sets have equal ones."""
    one, two = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    if len(rows):
        head = np.flatnonzero(np.diff(rows, prepend=-1))
        one[rows[head]] = np.add.reduceat(mix(shingles), head)
        two[rows[head]] = np.add.reduceat(mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)), head)
    return one, two


def _squeeze(values: np.ndarray) -> bytes:
    return len(values).to_bytes(8, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _restore(packed: bytes, kind) -> np.ndarray:
    count = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], count * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: ids and texts of some documents, compressed. The key comes from place and content."""
    place, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column("id")
        for first, last, data, offsets in pieces(batch.column("text"), CHUNK_BYTES):
            here = ids.slice(first, last - first).to_pylist()
            digest = xxhash.xxh64(f"{place} {number}")
            digest.update(data.tobytes())
            digest.update(repr(here))
            values = [[digest.intdigest() - (1 << 63)], [here], [_squeeze(offsets)], [_squeeze(data)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=["chunk", "ids", "offsets", "texts"])
            number += 1


def _sets(offsets: bytes, texts: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row numbers, shingles) of a chunk's documents, piece by piece."""
    texts, offsets = _restore(texts, np.uint8), _restore(offsets, np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(texts)])
    for first, last, data, ends in pieces(column):
        yield first, last - first, *shingle_sets(data, ends)


def _chunk_signatures(ids: list, offsets: bytes, texts: bytes, segments: Segments) -> tuple[Signatures, list, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the chunk's different sets, each under the smallest id that has it.

    Returns them, the (row, shingles) parts, the two digests by row, and which rows stand for their set. Rows with a
    null id or no words never do."""
    parts, one, two = [], [], []
    for first, count, rows, shingles in _sets(offsets, texts):
        d = _digests(rows, shingles, count)
        one.append(d[0])
        two.append(d[1])
        parts.append((first + rows, shingles))
    total = len(ids)
    one = np.concatenate(one) if one else np.empty(0, np.uint64)
    two = np.concatenate(two) if two else np.empty(0, np.uint64)
    rows = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    shingles = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.uint64)
    has = np.bincount(rows, minlength=total) > 0
    known = np.array([i is not None for i in ids], bool)
    number = np.array([0 if i is None else i for i in ids], np.int64)
    order = np.lexsort((number, ~known, two, one))
    new = np.ones(total, bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    stands = np.zeros(total, bool)
    stands[order[new]] = True
    stands &= has & known
    at = stands[rows]
    return signatures(rows[at], shingles[at], total, segments), (rows, shingles), one, two, stands


def _planes(values: np.ndarray) -> np.ndarray:
    """The values' first bytes, then all second ones and so on: this packs smaller."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).ravel()


def _asking(values: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct signatures, how many sets index and how many only look each up, and where each input went.

    Only 48 bits are sent: two signatures that agree there count as shared, which may add candidates but loses none."""
    distinct, back = np.unique(values >> np.uint64(16), return_inverse=True)
    return distinct, np.bincount(back, own, minlength=len(distinct)).astype(np.int32), np.bincount(back, ~own, minlength=len(distinct)).astype(np.int32), back


def _ask(segments: Segments, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, ids, offsets, texts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "ids", "offsets", "texts")), strict=True):
                found = _chunk_signatures(ids, offsets, texts, segments)[0]
                distinct, own, probing, _ = _asking(found.value, found.layer == 0)
                bucket = (distinct % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")  # values stay sorted within a bucket
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cuts))
                columns = [full.tolist(), [key] * len(full), [], []]
                for b in full:
                    at = order[cuts[b] : cuts[b + 1]]
                    columns[2].append(_squeeze(_planes(np.diff(distinct[at], prepend=np.uint64(0)))))
                    columns[3].append(_squeeze(np.concatenate([own[at], probing[at]])))
                yield pa.record_batch([pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "steps", "counts"])

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk's signatures in a bucket: how many sets index it and how many look it up, in the whole corpus."""

    def answers(bucket, waiting):
        values = [np.cumsum(np.ascontiguousarray(_restore(w[1], np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64) for w in waiting]
        counts = [_restore(w[2], np.int32).reshape(2, -1) for w in waiting]
        _, back = np.unique(np.concatenate(values), return_inverse=True)
        totals = [np.bincount(back, np.concatenate([c[k] for c in counts])).astype(np.int32)[back] for k in (0, 1)]
        ends = np.cumsum([len(v) for v in values])[:-1]
        out = [_squeeze(np.concatenate([o, p])) for o, p in zip(np.split(totals[0], ends), np.split(totals[1], ends), strict=True)]
        return pa.record_batch([pa.array([w[0] for w in waiting], pa.int64()), pa.array([bucket] * len(waiting), pa.int32()), pa.array(out, pa.binary())], names=["chunk", "bucket", "totals"])

    current, waiting = None, []
    for batch in batches:
        for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "steps", "counts")), strict=True):
            if bucket != current and waiting:
                yield answers(current, waiting)
                waiting = []
            current = bucket
            waiting.append(row)
    if waiting:
        yield answers(current, waiting)


def _choose(found: Signatures, own: np.ndarray, probing: np.ndarray, stands: np.ndarray):
    """For each row that may be linked: (row, its shared signatures, flags 1 indexed + 2 looked up, short of segments,
    segments that are its alone in a thousand elements).

    `own` and `probing` are each signature's totals. A row stays if so few of its segments are its alone that it can be
    linked to a larger set, or to a smaller one of its band or of the band below.
    """
    rows = len(found.size)
    whole = found.kind == 0
    alone = {0: (own <= 1) & (found.layer == 0), 1: (own == 0) & (found.layer == 1)}
    unshared = np.bincount(found.row, whole & (found.layer == 0) & (own + probing <= 1), minlength=rows)
    band = np.frexp(np.maximum(found.size, 1).astype(float))[1].astype(np.int64) - 1
    limit = {0: allowed(found.size, found.size), 1: allowed(found.size, (1 << band) - 1)}
    has_below = np.bincount(found.row, found.layer == 1, minlength=rows) > 0
    alone_below = np.bincount(found.row, whole & alone[1], minlength=rows)
    maybe = stands & ((unshared <= found.size // 3) | has_below & (alone_below <= limit[1]))
    order = np.argsort(found.row, kind="stable")
    cuts = np.searchsorted(found.row[order], np.arange(rows + 1))
    for row in np.flatnonzero(maybe):
        mine = order[cuts[row] : cuts[row + 1]]
        looked, short = np.zeros(len(mine), bool), False
        for layer in (0, 1):
            here = np.flatnonzero(found.layer[mine] == layer)
            if not len(here):
                continue
            at = mine[here]
            free, first = alone[layer][at], found.kind[at] == 0
            cost = np.where(free, 0, own[at]).astype(np.int64)
            deep = np.unique(found.segment[at][~first])
            options = []  # (cost, depth, signatures): a segment's subset, then its neighbourhood on top
            for segment, i in zip(found.segment[at][first], np.flatnonzero(first), strict=True):
                options.append((int(cost[i]), 0, int(segment), [i]))
            price = dict(zip(found.segment[at][first].tolist(), cost[first].tolist(), strict=True))
            for segment in deep.tolist():
                own_part = np.flatnonzero(~first & (found.segment[at] == segment))
                options.append((max(int(cost[own_part].sum()), price[segment]), 1, segment, own_part.tolist()))
            need = int(limit[layer][row]) + 1
            options.sort(key=lambda o: o[:3])
            short |= len(options) < need
            for c, _, _, chosen in options[:need]:
                if c:
                    looked[here[chosen]] = True
        indexed = (found.layer[mine] == 0) & (own[mine] + probing[mine] > 1)
        kept = looked | indexed
        value, flags = found.value[mine[kept]], (indexed + 2 * looked)[kept]
        if len(np.unique(value)) < len(value):  # neighbourhoods of repeated hash sums
            value, back = np.unique(value, return_inverse=True)
            merged = np.zeros(len(value), np.int64)
            np.bitwise_or.at(merged, back, flags)
            flags = merged
        yield row, value, flags, short, int(unshared[row] * 1000 // max(found.size[row], 1))


def _suspects(segments: Segments, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        out: list[list] = [[], [], [], [], [], [], [], [], [], []]
        packed = sorted(zip(right.column("bucket").to_pylist(), right.column("totals").to_pylist(), strict=True))
        for ids, offsets, texts in zip(*(left.column(c).to_pylist() for c in ("ids", "offsets", "texts")), strict=True):
            found, (rows, shingles), one, two, stands = _chunk_signatures(ids, offsets, texts, segments)
            size = np.bincount(rows, minlength=len(ids))
            distinct, _, _, back = _asking(found.value, found.layer == 0)
            order = np.argsort(distinct % np.uint64(buckets), kind="stable")
            totals = [_restore(t, np.int32).reshape(2, -1) for _, t in packed]
            totals = np.concatenate(totals, axis=1) if totals else np.empty((2, 0), np.int32)
            if totals.shape[1] != len(distinct):
                raise RuntimeError("a chunk changed between two readings: the input is not stable, run again over a written table")
            own, probing = np.empty_like(totals)
            own[order], probing[order] = totals
            chosen = {row: rest for row, *rest in _choose(found, own[back], probing[back], stands)}
            cuts = np.searchsorted(rows, np.arange(len(ids) + 1))
            for row, doc in enumerate(ids):
                value, flags, short, odd = chosen.get(row, (None, None, False, None))
                suspect = row in chosen
                for column, cell in zip(out, (doc, int(size[row]), one[row : row + 1].view(np.int64)[0], two[row : row + 1].view(np.int64)[0], value.view(np.int64) if suspect else None, flags.astype(np.int8) if suspect else None, shingles[cuts[row] : cuts[row + 1]].view(np.int64) if suspect else None, bool(short), odd, np.bincount(shingles[cuts[row] : cuts[row + 1]].view(np.int64) % _CLASSES, minlength=_CLASSES).astype(np.int32) if suspect else None), strict=True):
                    column.append(cell)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int8()), pa.list_(pa.int64()), pa.bool_(), pa.int32(), pa.list_(pa.int32())]
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=["id", "n", "one", "two", "signatures", "flags", "shingles", "short", "odd", "classes"])

    return run


_SCHEMA = "id long, n long, one long, two long, signatures array<long>, flags array<byte>, shingles array<long>, short boolean, odd int, classes array<int>"


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have 100 x intersection >= 75 x union. `b` may stand in very many pairs."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("_x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("_y")), "b")
    same = F.size(F.array_intersect("_x", "_y"))
    return both.where(100 * same >= 75 * (F.size("_x") + F.size("_y") - same)).select("a", "b")


def jaccard_groups(docs: DataFrame, *, id: str = "doc_id", text: str = "text", segments: Segments = Segments(), buckets: int | None = None) -> DataFrame:
    """(`id`, n_shingles, component_id) for every row: groups of texts linked by 5-word shingle sets of similarity 0.75.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z become a-z. A text with fewer than five words has them all as its one
    shingle; null, empty and wordless texts have none and are linked with nothing. Texts of any length are read whole.
    The component is the smallest id reachable by links, the row's own included. Ids are whole numbers; rows with equal
    ids are one node. A row with a null id links nothing and has a null component. Other columns are not read.

    Equal sets are one node from the first stage on. Texts travel once, compressed, in chunks. Each chunk asks, bucket by
    bucket of signature hashes, how many sets share each of its signatures - a signature is sent once for a chunk however
    many texts hold it, so no frequent one gathers rows in a task. Only sets that pass the count go on with their
    signatures and shingles. Where many sets meet in one signature, one set of each component is verified against the
    most typical set first; after that only sets of different components are still compared, so a group of n near
    copies costs about n verifications in each of its signatures and not n^2, and no link between components is missed.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    thin = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    chunks = thin.mapInArrow(frugal(_pack), "chunk long, ids array<long>, offsets binary, texts binary").repartition("chunk")
    asked = chunks.mapInArrow(frugal(_ask(segments, buckets)), "bucket int, chunk long, steps binary, counts binary")
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(frugal(_answer), "chunk long, bucket int, totals binary")
    known = settle(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_suspects(segments, buckets), _SCHEMA))

    same = ["one", "two", "n"]
    marks = settle(known.select("id", *same))
    classes = marks.where("n > 0").groupBy(*same).agg(F.min("id").alias("_class"), F.count(F.lit(1)).alias("_rows"))
    # By id as well: a key that all copies of a text share would be one task's.
    suspects = known.where("signatures is not null").join(classes.select(F.col("_class").alias("id"), *same), ["id", *same], "left_semi")
    sets = settle(suspects.select("id", "n", "odd", "shingles", "short", "classes", F.arrays_zip("signatures", "flags").alias("_held")))
    del known, suspects
    # Links are among these sets, so elements that only one of them has are in no other's. With u such elements of n, a
    # set shares at most n - u with another, of size m; as 7 (n - u) >= 3 (n + m) for a link, m is (4 n - 7 u) / 3 at most.
    alone = sets.select("id", F.explode("shingles").alias("e")).groupBy("e").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    own = [F.count_if(F.pmod("e", F.lit(_CLASSES)) == k) for k in range(_CLASSES)]
    alone = settle(alone.where("c = 1").groupBy("id").agg(F.count("*").alias("u"), F.array(*own).alias("_own")))
    facts = sets.select("id", "n", "odd", "short", "classes").join(alone, "id", "left")
    facts = facts.withColumn("top", F.floor((4 * F.col("n") - 7 * F.coalesce("u", F.lit(0))) / 3)).where("4 * top >= 3 * n or short")
    shared = F.zip_with("classes", "_own", lambda a, b: (a - b).cast("int"))
    facts = settle(facts.select("id", "n", "odd", "top", F.coalesce(shared, "classes").alias("held")))
    held = sets.select("id", "_held").join(facts.drop("held"), "id").select("id", "n", "top", "odd", F.explode("_held").alias("_s")).select("id", "n", "top", "odd", F.col("_s.signatures").alias("s"), F.col("_s.flags").alias("f"))
    members = held.groupBy("s").agg(F.bit_or("f").alias("_any"), F.max(F.col("f") % 2).alias("_in"), F.count("*").alias("_c"))
    held = settle(held.join(members.where("_c > 1 and _any >= 2 and _in > 0").select("s"), "s"))

    # Stars: in each signature, one set of each component against the most typical set of all. Components grow until a
    # round links nothing more.
    groups, links, tried = None, None, None
    while True:
        placed = held if groups is None else held.join(groups.withColumnRenamed("node", "id"), "id", "left")
        placed = placed.select("s", "id", "n", "top", "f", "odd", F.lit(None).cast("long").alias("g") if groups is None else F.col("component").alias("g")).withColumn("g", F.coalesce("g", "id"))
        if links is not None:
            several = placed.groupBy("s").agg(F.min("g").alias("_g"), F.max("g").alias("_h")).where("_g <> _h").select("s")
            placed = placed.join(several, "s", "left_semi")
        best = F.min(F.struct("odd", "id", "n", "top"))
        ones = placed.groupBy("s", "g").agg(best.alias("m"))
        heads = placed.where("f % 2 = 1").groupBy("s").agg(best.alias("h"))
        pairs = ones.join(heads, "s").where("m.id <> h.id and m.n <= h.top and h.n <= m.top")
        pairs = pairs.select(F.greatest("m.id", "h.id").alias("a"), F.least("m.id", "h.id").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = settle(pairs)
        new = settle(_verified(pairs, sets))
        tried = pairs if tried is None else tried.union(pairs)
        if new.isEmpty():
            break
        links = new if links is None else links.union(new)
        groups = settle(components(links))

    # Then all sets that share a signature and are not yet in one component, if sizes and elements allow it.
    # Sets share at most the smaller count of each class of elements that are not one set's alone; of components, the
    # largest counts of their sets stand for all.
    placed = settle(placed.select("s", "id", "n", "top", "f", "g")).join(facts.select("id", "held"), "id")
    bounds = [F.min("n").alias("n"), F.max("top").alias("top"), F.array(*[F.max(F.col("held")[k]) for k in range(_CLASSES)]).alias("held")]
    looking, indexed = placed.where("f >= 2"), placed.where("f % 2 = 1")
    other = {c: F.col(c).alias(f"_{c}") for c in ("g", "id", "n", "top", "held")}
    common = F.aggregate(F.zip_with("held", "_held", lambda a, b: F.least(a, b).cast("int")), F.lit(0), lambda a, b: a + b)
    may_link = (F.col("n") <= F.col("_top")) & (F.col("_n") <= F.col("top")) & (7 * common >= 3 * (F.col("n") + F.col("_n")))
    ends = indexed.groupBy("s", "g").agg(*bounds).select("s", *[other[c] for c in ("g", "n", "top", "held")])
    meeting = looking.groupBy("s", "g").agg(*bounds).join(ends, "s").where(F.col("g") != F.col("_g")).where(may_link)
    meeting = settle(meeting.select(F.least("g", "_g").alias("g"), F.greatest("g", "_g").alias("_g")).distinct())
    # Each two components once, however many signatures they share: the smaller one is copied to the parts of the larger.
    members = settle(placed.select("id", "g", "n", "top", "held").dropDuplicates(["id"]))
    sizes = members.groupBy("g").agg(F.count("*").alias("c"))
    meeting = meeting.join(sizes, "g").join(sizes.select(F.col("g").alias("_g"), F.col("c").alias("_c")), "_g")
    meeting = meeting.select(F.when(F.col("c") <= F.col("_c"), F.col("g")).otherwise(F.col("_g")).alias("g"), F.when(F.col("c") <= F.col("_c"), F.col("_g")).otherwise(F.col("g")).alias("_g"))
    part = F.pmod(F.xxhash64("id"), F.lit(_PARTS)).cast("int")
    copied = members.join(meeting, "g").withColumn("part", F.explode(F.array(*map(F.lit, range(_PARTS)))))
    pairs = copied.join(members.select(*other.values(), part.alias("part")), ["_g", "part"]).where("id <> _id").where(may_link)
    pairs = pairs.select(F.least("id", "_id").alias("b"), F.greatest("id", "_id").alias("a")).distinct()
    new = _verified(pairs.join(tried, ["a", "b"], "left_anti"), sets).union(_short_links(thin, sets))
    groups = components(new if links is None else links.union(new))

    # Rows without words and those alone with their set need no look-up by set; a set that very many rows share is split.
    found = groups.withColumnRenamed("node", "_class")
    several = classes.where("_rows > 1").join(found, "_class", "left").select(*same, F.coalesce("component", "_class").alias("_of_set"), "_rows")
    rows = marks.where("n > 0")
    share = max(rows.count() // (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))), 1024)
    placed = skew_safe_join(rows, several.drop("_rows"), same, "left", ["id"], share, several.select(*same, "_rows"))
    alone = placed.where("_of_set is null").join(found.select(F.col("_class").alias("id"), "component"), "id", "left")
    named = placed.where("_of_set is not null").withColumn("component", F.col("_of_set")).unionByName(alone)
    named = named.select("id", "n", "component").unionByName(marks.where("n = 0 or n is null").select("id", "n", F.lit(None).cast("long").alias("component")))
    return named.select(
        F.col("id").cast(dict(docs.dtypes)[id]).alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.least("component", "id")).cast(dict(docs.dtypes)[id]).alias("component_id"),
    )


def _short_links(thin: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of sets whose elements fell into too few segments to make up the count (with the usual settings, none in
    billions): such a set is compared with every set that shares an element."""
    short = sets.where("short")
    if short.isEmpty():
        return sets.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in pieces(batch.column("text")):
                rows, shingles = shingle_sets(data, offsets)
                cuts = np.searchsorted(rows, np.arange(len(offsets))).astype(np.int32)
                yield pa.record_batch([batch.column("id").slice(first, len(offsets) - 1), pa.ListArray.from_arrays(pa.array(cuts), pa.array(shingles.view(np.int64)))], names=["id", "shingles"])

    everything = thin.where("id is not null").mapInArrow(frugal(run), "id long, shingles array<long>").dropDuplicates(["id", "shingles"])
    wanted = short.select(F.col("id").alias("_id"), F.col("n").alias("_n"), F.explode("shingles").alias("e"))
    found = everything.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("e")).join(wanted, "e").where("id <> _id and 100 * least(n, _n) >= 75 * greatest(n, _n)")
    return _verified(found.select(F.col("id").alias("a"), F.col("_id").alias("b")).distinct(), everything)
