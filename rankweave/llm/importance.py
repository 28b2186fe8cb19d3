"""Importance resampling towards a target corpus: bucket gains scored from an array, ranks by a distributed radix sort."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.spans import crc32, joined_words, word_runs
from rankweave.llm.storage import settle
from rankweave.llm.text import byte_table, frugal, pieces

#: Bytes of words: digits, letters (after lower-casing) and all beyond ASCII.
WORD_BYTES = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


class Settings(NamedTuple):
    """Features are runs of 1 to `width` words in `buckets`; documents with `least_words` words take part in the draw of
    `percent` of them, by a noise that `seed` and the id give."""

    width: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


def _features(data: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket and row of each feature, words of each row)."""
    buffer, starts, ends, rows = joined_words(data, offsets, WORD_BYTES)
    found = [word_runs(starts, ends, rows, k + 1) for k in range(s.width)]
    buckets = [crc32(buffer, a, b).astype(np.int64) % s.buckets for a, b, _ in found]
    return np.concatenate(buckets), np.concatenate([r for *_, r in found]), np.bincount(rows, minlength=len(offsets) - 1)


def bucket_counts(docs: DataFrame, settings: Settings = Settings(), *, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket. A task sends one row for each bucket it has seen."""
    s = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                total += np.bincount(_features(data, offsets, s)[0], minlength=s.buckets)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return docs.select(text).mapInArrow(frugal(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), *, text: str = "text", target_text: str = "text") -> np.ndarray:
    """For each bucket, floor(1000 ln of how much likelier the target has it than the documents), both smoothed by one.

    Only the `buckets` sums of each side reach the driver."""
    s = settings
    both = [bucket_counts(docs, s, text=text), bucket_counts(target, s, text=target_text)]
    counted = both[0].select(F.lit(0).alias("side"), "*").union(both[1].select(F.lit(1), "*")).toArrow()
    n = np.zeros((2, s.buckets))
    n[counted["side"].to_numpy(), counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    all_docs, all_target = n.sum(axis=1)
    return np.floor(1000 * np.log((n[1] + 1) * (all_docs + s.buckets) / ((n[0] + 1) * (all_target + s.buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(`id`, n_words, n_features, weight) of every row: the sum of the gains of its features, looked up in the array."""
    s = settings
    shipped = docs.sparkSession.sparkContext.broadcast(gain)  # `buckets` numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shipped.value
        for batch in batches:
            out = np.empty((3, batch.num_rows), np.int64)
            for first, last, data, offsets in pieces(batch.column("text")):
                bucket, row, words = _features(data, offsets, s)
                out[0, first:last] = words
                out[1, first:last] = np.bincount(row, minlength=last - first)
                # Whole numbers below 2^53, so that sums of doubles are exact.
                out[2, first:last] = np.bincount(row, gain[bucket].astype(np.float64), minlength=last - first)
            yield pa.record_batch([batch.column("id"), *map(pa.array, out)], names=["id", "n_words", "n_features", "weight"])

    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return thin.mapInArrow(frugal(run), f"id {dict(thin.dtypes)['id']}, n_words long, n_features long, weight long").withColumnRenamed("id", id)


def noise(id: str, seed: str) -> Column:
    """floor(-1000 ln(-ln u)) for a u in (0, 1) that the id's digest gives. A null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def _bits(span: int) -> int:
    return int(span).bit_length()


def _digits(fields: Sequence[tuple[Column, int]], width: int) -> list[Column]:
    """Digits of `width` bits of one long composite key, the least significant first. `fields` are (number from 0, bits),
    the least significant first; a digit may hold bits of several."""
    pieces_of: list[list[tuple[Column, int, int, int]]] = []
    place = 0
    for value, bits in fields:
        taken = 0
        while taken < bits:
            digit, inside = divmod(place, width)
            count = min(bits - taken, width - inside)
            if digit == len(pieces_of):
                pieces_of.append([])
            pieces_of[digit].append((value, taken, count, inside))
            taken, place = taken + count, place + count
    out = []
    for parts in pieces_of:
        digit = F.lit(0).cast("long")
        for value, skip, count, inside in parts:
            digit = digit + F.shiftleft(F.shiftrightunsigned(value, skip).bitwiseAND(F.lit((1 << count) - 1)), inside)
        out.append(digit.cast("int"))
    return out


def radix_rank(rows: DataFrame, fields: Sequence[tuple[Column, int]], digit_bits: int = 11, block_rows: int | None = None) -> DataFrame:
    """`rows` with _position, from 0: their place by a composite key, found by stable counting-sort passes.

    `fields` are (a number from 0, its bits), the least significant field first. A pass takes the next digit: rows are
    counted by (digit, block of the present order); running totals over digits, then over the blocks of a digit, give
    each count its place in the new order; a row's place is that plus its number among the rows of its block and digit.
    So a pass shuffles the narrow rows once, no task sees more than blocks of a digit, and no row order is ever assumed:
    the order is a column. Each pass is written to the shared checkpoint folder. Rows of equal keys keep an order of
    their own that is not defined.
    """
    session = rows.sparkSession
    # Any distinct numbers do for a start; they are settled, so that a lost executor does not change them.
    rows = settle(rows.withColumn("_position", F.monotonically_increasing_id()))
    parts = int(session.conf.get("spark.sql.shuffle.partitions"))
    if block_rows is None:
        block_rows = min(max(rows.count() // (4 * parts), 256), 1 << 20)
    # The first numbers are (partition, row in it): blocks are pieces of partitions, in the same order.
    block = F.shiftright("_position", 33) * F.lit((1 << 33) // block_rows + 1) + F.floor(F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)) / block_rows)
    cell = ["_digit", "_block"]
    for digit in _digits(fields, digit_bits) or [F.lit(0)]:
        dealt = rows.withColumns({"_digit": digit, "_block": block.cast("long")})
        counts = dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
        before = W.partitionBy("_digit").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
        inside = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        ahead = W.orderBy("_digit").rowsBetween(W.unboundedPreceding, -1)  # at most 2^digit_bits rows
        digits = counts.groupBy("_digit").agg(F.sum("_n").alias("_n")).select("_digit", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
        offsets = inside.join(F.broadcast(digits), "_digit").select(*cell, (F.col("_before") + F.col("_ahead")).alias("_offset"))
        local = F.row_number().over(W.partitionBy(*cell).orderBy("_position")) - 1
        placed = dealt.withColumn("_local", local).join(offsets, cell)
        rows = settle(placed.withColumn("_position", F.col("_offset") + F.col("_local")).drop(*cell, "_local", "_offset"))
        block = F.floor(F.col("_position") / block_rows)
    return rows


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every document with `id`, n_features, weight, score and rank; the drawn ones have ranks 1, 2, 3 ..., others null.

    A document's weight is the sum of its features' gains, its score adds a noise that depends on the id alone, and of the
    documents with enough words the given share with the highest scores is drawn, ties to the smaller id. Texts are read
    twice (counts, weights) and never shuffled; what is sorted has five numbers a row.

    Null texts have no features, weight 0 and take no part in the draw. A null id comes after all others among equal
    scores; rows with equal ids and scores are ordered by their number of features, and equal in all that is returned
    beyond that. Ids are whole numbers. No documents: no rows; no target: its counts are 0. Other columns are not read.
    """
    s = settings
    gain = gains(docs, target, s, text=text, target_text=target_text)
    scored = weigh(docs, gain, s, id=id, text=text).withColumn("score", F.col("weight") + noise(id, s.seed))
    scored = settle(scored.withColumnRenamed(id, "_id"))
    enough = F.col("n_words") >= s.least_words
    # The halves of an id, the high one with its sign, so that differences stay within a long; a null id is beyond all.
    high, low = F.shiftright(F.col("_id").cast("long"), 32), F.col("_id").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    known = scored.where(enough).select("n_features", "score", high.alias("high"), low.alias("low"))
    names = ["n_features", "low", "high", "score"]
    span = known.agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]).first()
    size = {c: (span[f"max_{c}"] or 0) - (span[f"min_{c}"] or 0) for c in names}
    fields = [
        (F.col("n_features") - (span["min_n_features"] or 0), _bits(size["n_features"])),
        (F.coalesce(low - (span["min_low"] or 0), F.lit(size["low"])), _bits(size["low"])),
        (F.coalesce(high - (span["min_high"] or 0), F.lit(size["high"] + 1)), _bits(size["high"] + 1)),
        (F.lit(span["max_score"] or 0) - F.col("score"), _bits(size["score"])),
    ]
    ranked = radix_rank(scored.where(enough).drop("n_words"), fields)
    drawn = span["rows"] * s.percent // 100
    columns = [F.col("_id").alias(id), "n_features", "weight", "score"]
    rank = F.when(F.col("_position") < drawn, F.col("_position") + 1)
    return ranked.select(*columns, rank.alias("rank")).union(scored.where(~enough).select(*columns, F.lit(None).cast("long")))
