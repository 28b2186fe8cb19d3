"""Near duplicates by SimHash: fingerprints of word shingles, grouped where few bits differ."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.graph import components
from rankweave.llm.hamming import Settings, near_links
from rankweave.llm.spans import joined_words, word_runs, xxh64
from rankweave.llm.storage import settle
from rankweave.llm.text import SPACES, frugal, pieces
from rankweave.operators.joins import skew_safe_join

#: Eight counters share a 64-bit number, so none may pass 255.
_FULL = 255
_LOW_BITS = np.uint64(0x0101010101010101)


def bit_majority(hashes: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """For each of `count` rows the bits that are set in over half its hashes; 0 for a row without any. `rows` ascend."""
    out = np.zeros(count, np.uint64)
    if not len(hashes):
        return out
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    size = np.diff(np.append(first, len(rows)))
    # Segments of at most 255 hashes of one row; all segments of a row follow each other.
    segments = (size + _FULL - 1) // _FULL
    number = np.arange(segments.sum()) - np.repeat(np.cumsum(segments) - segments, segments)
    starts = np.repeat(first, segments) + number * _FULL
    row_starts = np.cumsum(segments) - segments
    majority = np.zeros(len(first), np.uint64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LOW_BITS, starts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), row_starts, axis=0)
        over = (2 * sums > size[:, None]).astype(np.uint64)
        majority |= (over << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(shift))).sum(axis=1, dtype=np.uint64)
    out[rows[first]] = majority
    return out


def simhash(data: np.ndarray, offsets: np.ndarray, width: int = 3, seed: int = 42) -> np.ndarray:
    """The 64-bit fingerprint of each row: the majority of the bits of the XXH64 of its runs of `width` words, joined by
    one space, repeats included. A row with fewer words has its whole sequence as the only run; one without words is 0."""
    buffer, starts, ends, rows = joined_words(data, offsets, ~SPACES)
    first, last, owner = word_runs(starts, ends, rows, width)
    words = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        head = np.searchsorted(rows, short)
        first, last = np.append(first, starts[head]), np.append(last, ends[head + words[short] - 1])
        owner = np.append(owner, short)
        order = np.argsort(owner, kind="stable")
        first, last, owner = first[order], last[order], owner[order]
    return bit_majority(xxh64(buffer, first, last, seed), owner, len(offsets) - 1)


def fingerprints(docs: DataFrame, width: int = 3, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(`id`, fp) for every row; fp is the fingerprint as a signed long. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows, np.uint64)
            for first, last, data, offsets in pieces(batch.column("text")):
                out[first:last] = simhash(data, offsets, width)
            yield pa.record_batch([batch.column("id"), pa.array(out.view(np.int64))], names=["id", "fp"])

    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return thin.mapInArrow(frugal(run), f"id {dict(thin.dtypes)['id']}, fp long").withColumnRenamed("id", id)


def simhash_groups(docs: DataFrame, reach: int = 2, width: int = 3, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's `id`, fingerprint (16 hex digits) and component_id, the smallest id that links reach.

    Rows are linked if their fingerprints differ in at most `reach` bits; equal ones always are, texts without words
    among them (fingerprint 0). Texts are read once; from then on there are ids and fingerprints only. Each distinct
    fingerprint enters the trees once, so copies cost nothing there; one that very many rows share is split when
    components are joined back.

    Rows with equal ids are nodes of their own that share the id. Rows with a null id take part in links; a component of
    such rows alone has a null component_id. Empty tables give no rows; other columns are not read.
    """
    rows = settle(fingerprints(docs, width, id=id, text=text).withColumnRenamed(id, "_id"))
    each = settle(rows.groupBy("fp").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows")))
    linked = components(settle(near_links(each, reach, settings)), "a", "b")
    members = each.join(linked, each["fp"] == linked["node"]).select("fp", "_least", "component")
    least = members.groupBy("component").agg(F.min("_least").alias("_of_all"))
    joined = members.join(least, "component").select("fp", "_of_all")
    classes = each.join(joined, "fp", "left").select("fp", F.when(F.col("_of_all").isNull(), F.col("_least")).otherwise(F.col("_of_all")).alias("component_id"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = each.agg(F.sum("_rows")).first()[0] or 0
    back = skew_safe_join(rows, classes, ["fp"], "inner", share_rows=max(total // (2 * parts), 64), counts=each.select("fp", "_rows"))
    return back.select(F.col("_id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
