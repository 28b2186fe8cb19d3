"""Benchmark decontamination: rare n-gram seeds find passages, word-level Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.text import LOWER, byte_table, frugal, mix, ngram_hashes, pieces, runs, span_hashes

_WORD = byte_table([*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)])
_SLOT_BITS = 20


@dataclass(frozen=True)
class Settings:
    """Seeds are `width` words. A seed is an item's own if at most `few_items` plus `few_share` of the block's different
    items have it. It is rare if at most `rare_rows` plus `rare_share` of all documents have it, or at most 4 times as
    many as have its item's median own seed. Words align at `match`, `mismatch` and `gap` points; words that no own seed
    covers match for nothing. A passage leaks from `share` of the item's full score on, but not under `least` points
    unless it is the whole item, or from `points` on. Items are searched in blocks of `block_bytes`."""

    width: int = 3
    few_items: int = 10
    few_share: float = 0.005
    rare_rows: int = 20
    rare_share: float = 1e-4
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    share: float = 0.4
    least: int = 10
    points: int = 40
    block_bytes: int = 16 << 20


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, rows, starts, ends) of the words: runs of letters, digits and bytes beyond ASCII; A-Z count as a-z."""
    lower = LOWER[data]
    starts, ends, rows = runs(_WORD[lower], offsets)
    return span_hashes(lower, starts, ends), rows, starts, ends


@dataclass
class Index:
    """A block of items: their ids, words, and sorted distinct seeds with the items and places that have them.

    `weights` are 1 for words that one of the item's own seeds covers, else 0; an item without own seeds has 1 for all its
    words and is `common`: only the whole of it is a leak."""

    ids: pa.Array
    word_hashes: np.ndarray
    bounds: np.ndarray
    seeds: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    slots: np.ndarray
    weights: np.ndarray
    common: np.ndarray
    few: np.ndarray

    def fields(self) -> tuple:
        """Plain values: what a broadcast holds is read by name, and executors need not have this package."""
        return tuple(getattr(self, f.name) for f in fields(self))

    def seed_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.seeds)), np.diff(self.first))

    def telling(self, documents: np.ndarray, all_documents: int, s: Settings) -> Index:
        """The index with those seeds of each item alone that tell it: its own ones that are rare. `documents` has how many
        documents have each seed. An item without own seeds keeps the one that the fewest items have (ties: documents)."""
        seed, n = self.seed_of_entries(), len(self.bounds) - 1
        own = self.few[seed] & ~self.common[self.item]
        limit = np.full(n, s.rare_rows + s.rare_share * all_documents)
        order = np.lexsort((documents[seed], self.item))
        order = order[own[order]]
        heads = np.flatnonzero(np.diff(self.item[order], prepend=-1))
        size = np.diff(np.append(heads, len(order)))
        middle = (documents[seed[order[heads + (size - 1) // 2]]] + documents[seed[order[heads + size // 2]]]) / 2
        limit[self.item[order[heads]]] = np.maximum(limit[self.item[order[heads]]], 4 * middle)
        keep = own & (documents[seed] <= limit[self.item])
        held = np.diff(self.first)[seed]
        order = np.lexsort((documents[seed], held, self.item))
        order = order[self.common[self.item[order]]]
        keep[order[np.flatnonzero(np.diff(self.item[order], prepend=-1))]] = True
        count = np.bincount(seed[keep], minlength=len(self.seeds))
        left = np.flatnonzero(count)
        slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        slots[_slot(self.seeds[left])] = np.arange(len(left))
        return replace(self, seeds=self.seeds[left], first=np.append(0, np.cumsum(count[left])), item=self.item[keep], place=self.place[keep], slots=slots, few=self.few[left])

    @staticmethod
    def build(ids: pa.Array, texts: pa.Array, s: Settings) -> Index:
        hashes, counts, seeds, items, places = [], [], [], [], []
        for first, last, data, offsets in pieces(texts):
            h, rows, _, _ = words(data, offsets)
            found, at = ngram_hashes(h, rows, s.width)
            begin = np.searchsorted(rows, np.arange(last - first + 1))
            hashes.append(h)
            counts.append(np.diff(begin))
            seeds.append(found)
            items.append(first + rows[at])
            places.append(at - begin[rows[at]])
        if not hashes:
            hashes, counts, seeds, items, places = ([np.empty(0, t)] for t in (np.uint64, np.int64, np.uint64, np.int64, np.int64))
        seeds, items, places = np.concatenate(seeds), np.concatenate(items), np.concatenate(places)
        order = np.argsort(seeds, kind="stable")
        distinct, first = np.unique(seeds[order], return_index=True)
        slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        slots[_slot(distinct)] = np.arange(len(distinct))
        hashes, bounds, first = np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))]), np.append(first, len(order))
        items, places = items[order], places[order]
        # Items of the same words count once: what they share is their own.
        length = np.diff(bounds)
        starts = np.minimum(bounds[:-1], max(len(hashes) - 1, 0))
        turned = mix(hashes + np.arange(len(hashes), dtype=np.uint64) - np.repeat(bounds[:-1], length).astype(np.uint64))
        whole = np.where(length > 0, np.add.reduceat(np.append(turned, np.uint64(0)), starts)[: len(length)] if len(length) else 0, 0).astype(np.uint64)
        _, kind = np.unique(np.stack([whole, length.astype(np.uint64)]), axis=1, return_inverse=True)
        kind = kind.ravel()
        seed = np.repeat(np.arange(len(distinct)), np.diff(first))
        pairs = np.unique(seed * (kind.max(initial=0) + 1) + kind[items])
        held = np.bincount(pairs // (kind.max(initial=0) + 1), minlength=len(distinct))
        few = held <= s.few_items + s.few_share * len(np.unique(kind))
        weights = np.zeros(len(hashes), np.int64)
        own = few[seed]
        for k in range(s.width):
            weights[bounds[items[own]] + places[own] + k] = 1
        common = np.bincount(items[own], minlength=len(length)) == 0
        weights[np.repeat(common, length)] = 1
        return Index(ids, hashes, bounds, distinct, first, items, places, slots, weights, common, few)

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """The seed's number, or -1. A slot holds one of the seeds that fall into it; the others are searched for."""
        if not len(self.seeds):
            return np.full(len(hashes), -1)
        out = self.slots[_slot(hashes)].astype(np.int64)
        maybe = np.flatnonzero(out >= 0)
        at = np.minimum(np.searchsorted(self.seeds, hashes[maybe]), len(self.seeds) - 1)
        out[maybe] = np.where(self.seeds[at] == hashes[maybe], at, -1)
        return out


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def smith_waterman(item: np.ndarray, passage: np.ndarray, s: Settings, weights: np.ndarray | None = None) -> tuple[int, int, int]:
    """(score, first word, word after the last) of the best local alignment of all of `item` with `passage`.

    A matching word counts `match` times its weight.

    Row by row; within a row, gaps in the item are a running maximum. Of equal scores the first end counts, and of its
    alignments the one that starts last.
    """
    width = len(passage)
    steps = -s.gap * np.arange(width + 1)
    score, begin = np.zeros(width + 1, np.int64), np.arange(width + 1)
    best = (0, 0, 0)
    base = np.int64(1) << 32  # score and start in one number: higher scores first, then later starts
    for word, weight in zip(item, np.ones(len(item), np.int64) if weights is None else weights, strict=True):
        gain = np.where(passage == word, s.match * weight, s.mismatch)
        down = (score + s.gap) * base + begin
        cross = np.concatenate([[0], (score[:-1] + gain) * base + begin[:-1]])
        cell = np.maximum(np.maximum(down, cross), np.arange(width + 1))
        cell = np.maximum.accumulate(cell + steps * base) - steps * base
        cell = np.maximum(cell, np.arange(width + 1))
        score, begin = cell >> 32, cell & (base - 1)
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(begin[top]), top)
    return best


def _leaks(index: Index, s: Settings, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(row, item, share of the full score, points, start byte, end byte) of the best passage of each item in each row."""
    hashes, rows, starts, ends = words(data, offsets)
    seeds, at = ngram_hashes(hashes, rows, s.width)
    number = index.look_up(seeds)
    hit = np.flatnonzero(number >= 0)
    number, at = number[hit], at[hit]
    each = index.first[number + 1] - index.first[number]
    where = np.repeat(at, each)
    ends_at = np.cumsum(each)
    entry = np.repeat(index.first[number], each) + np.arange(ends_at[-1] if len(each) else 0) - np.repeat(ends_at - each, each)
    item, shift = index.item[entry], where - index.place[entry]
    order = np.lexsort((where, item, rows[where]))
    where, item, shift = where[order], item[order], shift[order]
    length = np.diff(index.bounds)
    slack = length // 2 + 8
    new = np.ones(len(where), bool)
    new[1:] = (rows[where[1:]] != rows[where[:-1]]) | (item[1:] != item[:-1]) | (np.diff(where) > (length + slack)[item[1:]])
    heads = np.flatnonzero(new)
    begin = np.searchsorted(rows, np.arange(len(offsets)))
    best: dict[tuple[int, int], tuple] = {}
    for a, b in zip(heads, np.append(heads, len(where))[1:], strict=True):
        i, row = int(item[a]), int(rows[where[a]])
        low = max(begin[row], shift[a:b].min() - slack[i])
        high = min(begin[row + 1], shift[a:b].max() + length[i] + slack[i])
        weights = index.weights[index.bounds[i] : index.bounds[i + 1]]
        points, first, last = smith_waterman(index.word_hashes[index.bounds[i] : index.bounds[i + 1]], hashes[low:high], s, weights)
        full = s.match * int(weights.sum())
        share = points / full
        # One shared n-gram, or two that overlap, are no leak: in a short item they alone reach the share.
        enough = share >= s.share and points >= min(full, s.least) or points >= s.points
        if (points >= full if index.common[i] else enough) and points > best.get((row, i), (0, 0))[1]:
            best[row, i] = (share, points, int(starts[low + first] - offsets[row]), int(ends[low + last - 1] - offsets[row]))
    for (row, i), found in sorted(best.items()):
        yield row, i, *found


def _blocks(benchmark: DataFrame, s: Settings, item: str, text: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of the items, at most about `block_bytes` of text at a time."""
    items = benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = size // s.block_bytes + 1
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).orderBy("item", "text").toArrow()
        yield block.column("item").combine_chunks(), block.column("text").combine_chunks()


def _told(index: Index, thin: DataFrame, s: Settings) -> Index:
    """The index cut down to telling seeds, by how many of all documents have each seed."""
    shipped = thin.sparkSession.sparkContext.broadcast(index.fields())  # within the block's bound

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shipped.value)
        total, rows_seen = np.zeros(len(index.seeds), np.int64), 0
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column("text")):
                hashes, rows, _, _ = words(data, offsets)
                seeds, at = ngram_hashes(hashes, rows, s.width)
                number = index.look_up(seeds)
                hit = np.flatnonzero(number >= 0)
                pairs = np.unique(rows[at[hit]] * len(index.seeds) + number[hit]) if len(hit) else hit
                total += np.bincount(pairs % max(len(index.seeds), 1), minlength=len(index.seeds))
                rows_seen += last - first
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(found, -1)), pa.array(np.append(total[found], rows_seen))], names=["seed", "n"])

    counted = thin.select("text").mapInArrow(frugal(count), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    documents = np.zeros(len(index.seeds) + 1, np.int64)  # the last place, -1, has all documents
    documents[counted["seed"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return index.telling(documents[:-1], int(documents[-1]), s)


def _shipped(docs: DataFrame, ids: pa.Array, texts: pa.Array, s: Settings, text: str) -> Broadcast:
    """The telling seeds of a block of items for all executors: within the block's bound."""
    index = _told(Index.build(ids, texts, s), docs.select(F.col(text).alias("text")), s)
    return docs.sparkSession.sparkContext.broadcast(index.fields())


def _searched(docs: DataFrame, ids: pa.Array, texts: pa.Array, s: Settings, id: str, text: str, item_type: str) -> DataFrame:
    """(id, leaks) for every row: the block's items that it holds."""
    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    shipped = _shipped(docs, ids, texts, s, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shipped.value)
        for batch in batches:
            cuts, found = np.zeros(batch.num_rows + 1, np.int64), []
            for first, _, data, offsets in pieces(batch.column("text")):
                # Bytes of a row before a place, without continuation bytes, are its code points.
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                for row, i, share, score, a, b in _leaks(index, s, data, offsets):
                    cuts[first + row + 1] += 1
                    base = points[offsets[row]]
                    found.append((i, float(share), score, int(points[offsets[row] + a] - base), int(points[offsets[row] + b] - base)))
            columns = list(zip(*found, strict=True)) or [[]] * 5
            leaks = pa.StructArray.from_arrays(
                [index.ids.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.float64()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                ["item", "score", "points", "start", "end"],
            )
            yield pa.record_batch([batch.column("id"), pa.ListArray.from_arrays(pa.array(np.cumsum(cuts), pa.int32()), leaks)], names=["id", "leaks"])

    kind = dict(thin.dtypes)["id"]
    return thin.mapInArrow(frugal(run), f"id {kind}, leaks array<struct<item: {item_type}, score: double, points: bigint, start: bigint, end: bigint>>")


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and benchmark item in it: `id`, `item`, score (share of the item's full alignment
    score), points, and the passage's start and end in code points.

    1. Seeds are the items' n-grams of words. One pass counts in how many of all documents each occurs.
    2. A second pass looks the rare ones up in each whole text. A seed that many items share tells none of them and is
       left out, as one is that most documents have; but rare is measured against the item's own seeds, so an item that a
       large part of the corpus repeats is found. Seeds of one item close together make a passage, which is aligned, with
       room for insertions, with the whole item. Words that only shared seeds cover count nothing there, so the stem of a
       template is no evidence. An item of which no seed is its own is a leak only as a whole.

    Neither pass shuffles documents. The benchmark is searched in blocks, each broadcast, so that it may be of any size.
    Null and empty texts hold nothing; items with fewer words than a seed are not found. Repeated items count once, rows
    with equal ids stay apart; other columns are not read.
    """
    item_type = dict(benchmark.dtypes)[item]
    out = None
    for ids, texts in _blocks(benchmark, settings, item, item_text):
        found = _searched(docs, ids, texts, settings, id, text, item_type).select("id", F.explode("leaks").alias("leak")).select("id", "leak.*")
        out = found if out is None else out.union(found)
    return out.withColumnsRenamed({"id": id, "item": item})


def _leaking(shipped: Broadcast, s: Settings):
    def run(texts: pa.Array) -> pa.Array:
        index, leaking = Index(*shipped.value), np.zeros(len(texts), bool)
        for first, _, data, offsets in pieces(texts):
            for row, *_ in _leaks(index, s, data, offsets):
                leaking[first + row] = True
        return pa.array(leaking)

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), *, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    for ids, texts in _blocks(benchmark, settings, item, item_text):
        shipped = _shipped(docs, ids, texts, settings, text)

        docs = docs.where(~F.arrow_udf(_leaking(shipped, settings), "boolean")(F.col(text)))
    return docs
