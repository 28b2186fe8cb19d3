"""Language identification by prediction by partial matching: the language whose context tree codes the text shortest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.learning import hash_below, held_out
from rankweave.llm.text import LOWER, byte_table, frugal, pieces, runs

#: Bytes of context at most. A context and its symbol fit in 32 bits.
ORDER = 3
UNKNOWN = "und"
_PAD = 0x20
_SLOT_BITS = 22
_LETTER = byte_table([*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)])
_WORD = byte_table([*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)])


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte (A-Z as a-z) its three predecessors and itself as one number; spaces stand before each text."""
    now = LOWER[data]
    codes, shifted = now.astype(np.uint32), now
    starts = offsets[:-1][offsets[:-1] < len(data)]
    for k in range(1, ORDER + 1):
        before = np.empty_like(shifted)
        before[1:] = shifted[:-1]
        before[starts] = _PAD
        codes |= before.astype(np.uint32) << np.uint32(8 * k)
        shifted = before
    return codes


@dataclass
class ContextTrees:
    """One tree per language, frozen, as tables over the union of all languages' nodes.

    `grams[k]` are the sorted (context of k bytes, symbol) codes seen in any language and `cost[k][l]` their code
    lengths in bits under language l; `contexts[k]` are the contexts of k bytes and `escape[k][l]` the bits for leaving
    them, 0 where language l never saw the context (it is skipped, not left). After context c, seen n times with d
    different symbols, a symbol seen m times there costs -log2(m / (n + d)) bits; any other costs -log2(d / (n + d))
    for the escape and then its code in the context shorter by one. Below order 0 all 256 bytes are equally likely.
    """

    languages: list[str]
    grams: list[np.ndarray]
    cost: list[np.ndarray]
    contexts: list[np.ndarray]
    escape: list[np.ndarray]

    @staticmethod
    def build(languages: list[str], codes: np.ndarray, owners: np.ndarray, counts: np.ndarray) -> ContextTrees:
        """From counts of full-length codes per language (owners: indexes into `languages`)."""
        all_grams, all_cost, all_contexts, all_escape = [], [], [], []
        for k in range(ORDER + 1):
            cut = codes & np.uint32((1 << (8 * (k + 1))) - 1)
            union = np.unique(cut)
            contexts = np.unique(union >> np.uint32(8))
            seen = np.zeros((len(languages), len(union)))
            np.add.at(seen, (owners, np.searchsorted(union, cut)), counts)
            at = np.searchsorted(contexts, union >> np.uint32(8))
            total, kinds = np.zeros((2, len(languages), len(contexts)))
            for l in range(len(languages)):
                total[l] = np.bincount(at, seen[l], minlength=len(contexts))
                kinds[l] = np.bincount(at, seen[l] > 0, minlength=len(contexts))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
                coded = -np.log2(seen / (total + kinds)[:, at])
            if k:
                shorter = all_cost[k - 1][:, np.searchsorted(all_grams[k - 1], union & np.uint32((1 << (8 * k)) - 1))]
            else:
                shorter = np.full_like(coded, 8.0)
            all_grams.append(union)
            all_contexts.append(contexts)
            all_escape.append(escape)
            all_cost.append(np.where(seen > 0, coded, escape[:, at] + shorter))
        return ContextTrees(languages, all_grams, all_cost, all_contexts, all_escape)

    def bits(self, codes: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Code lengths (languages x codes) of any codes of k + 1 bytes."""
        known, out = self.grams[k], np.zeros((len(self.languages), len(codes)))
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        hit = known[at] == codes
        out[:, hit] = self.cost[k][:, at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            context = codes[miss] >> np.uint32(8) if k else np.zeros(len(miss), np.uint32)
            at = np.minimum(np.searchsorted(self.contexts[k], context), max(len(self.contexts[k]) - 1, 0))
            left = np.where(self.contexts[k][at] == context, self.escape[k][:, at], 0.0)
            out[:, miss] = left + (self.bits(codes[miss] & np.uint32((1 << (8 * k)) - 1), k - 1) if k else 8.0)
        return out

    def index(self) -> np.ndarray:
        """For each hash slot, the full-length gram in it (the first, if several): most look-ups end here."""
        slots = np.zeros(1 << _SLOT_BITS, np.int32)
        slots[_slot(self.grams[ORDER][::-1])] = np.arange(len(self.grams[ORDER]), dtype=np.int32)[::-1]
        return slots

    def text_bits(self, data: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Exact code lengths (languages x texts) of whole texts."""
        return self.text_and_span_bits(data, offsets, index, np.empty(0, int), np.empty(0, int))[0]

    def text_and_span_bits(self, data: np.ndarray, offsets: np.ndarray, index: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`text_bits`, and the least code length that any language gives each span of bytes (not empty, in order)."""
        rows = len(offsets) - 1
        out, least = np.zeros((len(self.languages), rows)), np.full(len(starts), np.inf)
        if not len(data):
            return out, least
        codes = grams(data, offsets)
        at = index[_slot(codes)]
        miss = np.flatnonzero(self.grams[ORDER][at] != codes)
        full = np.flatnonzero(np.diff(offsets))
        owners = np.searchsorted(offsets, miss, "right") - 1
        others, back = np.unique(codes[miss], return_inverse=True)
        other_bits = self.bits(others)
        for l in range(len(self.languages)):
            cost = self.cost[ORDER][l][at]
            cost[miss] = 0
            out[l, full] = np.add.reduceat(cost, offsets[:-1][full])
            out[l] += np.bincount(owners, other_bits[l][back], minlength=rows)
            if len(starts):
                cost[miss] = other_bits[l][back]
                edges = np.stack([starts, ends], axis=1).ravel()
                least = np.minimum(least, np.add.reduceat(np.append(cost, 0), edges)[::2])
        return out, least


def prose(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, rows) of the words without digits; of a text with none, of all its words."""
    lower = LOWER[data]
    starts, ends, rows = runs(_WORD[lower], offsets)
    if not len(starts):
        return starts, ends, rows
    letters = np.append(0, np.cumsum(_LETTER[lower] > 0))
    plain = letters[ends] - letters[starts] == ends - starts
    some = np.zeros(len(offsets) - 1, bool)
    some[rows[plain]] = True
    kept = plain | ~some[rows]
    return starts[kept], ends[kept], rows[kept]


@dataclass
class Norms:
    """What each language's own texts need outside training: bits per byte of prose, and their spread per root of a byte.

    A text fits if its words, each under the language that codes it shortest, need at most `factor` times the rate of
    its best language, and `doubts` spreads more; short texts vary more, and their spread is larger.
    """

    rate: np.ndarray
    spread: np.ndarray
    factor: float = 1.6
    doubts: float = 4.0

    def fits(self, best: np.ndarray, bits: np.ndarray, size: np.ndarray) -> np.ndarray:
        return bits <= self.factor * self.rate[best] * size + self.doubts * self.spread[best] * np.sqrt(size)


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - _SLOT_BITS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column("lang").to_pylist()
        for first, _, data, offsets in pieces(batch.column("text")):
            codes = grams(data, offsets)
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                seen, counts = np.unique(codes[a:b], return_counts=True)
                yield pa.record_batch([pa.array([names[first + i]] * len(seen), pa.string()), pa.array(seen.astype(np.int64)), pa.array(counts)], names=["lang", "code", "n"])


def _sample(docs: DataFrame, rows: int, id: str, text: str, lang: str) -> DataFrame:
    """(_id, lang, text) of at most `rows` labelled documents of each language, the first by a hash of the id.

    Ids are counted by language first, so that only those with a hash below a bound are ordered; a language of which too
    few come through (its ids repeat very often) is ordered whole."""
    known = docs.where(F.col(lang).isNotNull() & F.col(id).isNotNull() & F.col(text).isNotNull())
    ids = known.select(F.col(id).alias("_id"), F.col(lang).alias("lang"))
    counts = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    ids = ids.join(F.broadcast(counts), "lang").withColumn("_share", F.lit(4.0 * rows) / F.col("_n"))
    below = (F.col("_share") >= 1) | hash_below(F.col("_id"), F.col("_share"))
    passed = ids.where(below).groupBy("lang").agg(F.count_distinct("_id").alias("_passed"), F.first("_share").alias("_share"))
    scarce = [r.lang for r in passed.where((F.col("_passed") < rows) & (F.col("_share") < 1)).select("lang").collect()]
    ids = ids.where(below | F.col("lang").isin(scarce))
    order = W.partitionBy("lang").orderBy(F.xxhash64("_id"), "_id")
    chosen = ids.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= rows).select("_id", "lang").distinct()
    texts = known.select(F.col(id).alias("_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    return texts.join(F.broadcast(chosen), ["_id", "lang"]).groupBy("_id", "lang").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, rows: int = 400, *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> ContextTrees:
    """Trees from at most `rows` whole documents of each language outside the held-out fold.

    Documents with a null language, text or id are not learned from. The first by a hash of the id are taken, so at most
    `rows` ids for each language are broadcast, and each id counts once. Counting is a map over those texts and a sum;
    the driver gets the distinct 4-byte codes of the sample, and its size is bounded by the sample's, not the corpus's.
    """
    sample = _sample(docs.where(~held_out(id)), rows, id, text, lang)
    counted = sample.select("lang", "text").mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    languages = sorted(found["lang"].unique())
    owners = np.searchsorted(np.array(languages, object), found["lang"].to_numpy(object)) if languages else np.empty(0, int)
    return ContextTrees.build(languages, found["code"].to_numpy(np.int64).astype(np.uint32), owners, found["n"].to_numpy(float))


def norms(docs: DataFrame, trees: ContextTrees, *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Norms:
    """The trees' norms from all held-out labelled documents, which no tree has learned from.

    A language without such a document takes the largest rate and spread of the others; with none at all, any text fits.
    """
    shipped = _shipped(docs.sparkSession, trees)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, index = shipped.value
        trees = ContextTrees(*fields)
        for batch in batches:
            names, found = batch.column("lang").to_pylist(), []
            for first, _, data, offsets in pieces(batch.column("text")):
                starts, ends, owners = prose(data, offsets)
                _, bits = trees.text_and_span_bits(data, offsets, index, starts, ends)
                size = (ends - starts).astype(float)
                for row in np.unique(owners):
                    b, n = bits[owners == row], size[owners == row]
                    found.append((names[first + row], b.sum(), n.sum(), b @ b, b @ n, n @ n))
            columns = list(zip(*found, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(columns[0], pa.string()), *(pa.array(c, pa.float64()) for c in columns[1:])], names=["lang", "b", "n", "bb", "bn", "nn"])

    rate, spread = np.full((2, len(trees.languages)), np.nan)
    if trees.languages:
        known = docs.where(held_out(id) & F.col(lang).isNotNull() & F.col(id).isNotNull() & F.col(text).isNotNull())
        sums = known.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(frugal(measure), "lang string, b double, n double, bb double, bn double, nn double").groupBy("lang")
        for r in sums.agg(*[F.sum(c).alias(c) for c in ("b", "n", "bb", "bn", "nn")]).collect():
            if r.lang in trees.languages and r.n:
                at, mean = trees.languages.index(r.lang), r.b / r.n
                rate[at], spread[at] = mean, np.sqrt(max(r.bb - 2 * mean * r.bn + mean**2 * r.nn, 0) / r.n)
    if np.isnan(rate).all():
        return Norms(np.full(len(rate), np.inf), np.zeros(len(rate)))
    return Norms(np.where(np.isnan(rate), np.nanmax(rate), rate), np.where(np.isnan(spread), np.nanmax(spread), spread))


def _shipped(spark: SparkSession, trees: ContextTrees) -> Broadcast:
    """The trees and their index for all executors, as plain arrays: a broadcast is read by name, and executors need not
    have this package."""
    fields = (trees.languages, trees.grams, trees.cost, trees.contexts, trees.escape)
    return spark.sparkContext.broadcast((fields, trees.index() if trees.languages else None))


def _identified(shipped: Broadcast, norms: Norms | None):
    """A function over (texts, readable) that gives lang_pred, score, bits_per_byte and fits."""

    def run(texts: pa.Array, readable: pa.Array) -> list[pa.Array]:
        fields, index = shipped.value
        trees = ContextTrees(*fields)
        names, size = np.array([*trees.languages, UNKNOWN], object), len(texts)
        best, score, rate, fits = np.full(size, len(names) - 1), np.zeros(size), np.zeros(size), np.zeros(size, bool)
        if trees.languages:
            readable = np.asarray(readable.to_numpy(zero_copy_only=False), bool)
            for first, last, data, offsets in pieces(texts):
                starts, ends, owners = prose(data, offsets) if norms else [np.empty(0, int)] * 3
                bits, words = trees.text_and_span_bits(data, offsets, index, starts, ends)
                least = bits.min(axis=0)
                best[first:last] = bits.argmin(axis=0)
                score[first:last] = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(axis=0)
                rate[first:last] = least / np.maximum(np.diff(offsets), 1)
                if norms:
                    spent, spelt = (np.bincount(owners, w, minlength=last - first) for w in (words, ends - starts))
                    fits[first:last] = norms.fits(best[first:last], spent, spelt)
            best[~readable], score[~readable], rate[~readable], fits[~readable] = len(names) - 1, 0, 0, False
        return [pa.array(names[best], pa.string()), pa.array(score), pa.array(rate), pa.array(fits)]

    return run


def _readable(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, trees: ContextTrees, norms: Norms | None = None, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(`id`, lang_pred, score, bits_per_byte) for every row, from its whole text alone; with `norms`, also fits: whether
    the text is in a learned language at all, which the score cannot tell.

    The prediction is the language with the shortest code (ties: the first by name); the score is its probability if all
    languages are equally likely beforehand. A null text, a text without a Unicode letter, or a model without languages
    gives `und` with score 0. Rows with equal ids stay apart; other columns are not read.
    """
    found = _identified(_shipped(docs.sparkSession, trees), norms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column("id"), *found(batch.column("text"), batch.column("readable"))]
            yield pa.record_batch(columns[: 5 if norms else 4], names=["id", "lang_pred", "score", "bits_per_byte", "fits"][: 5 if norms else 4])

    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), _readable(F.col(text)).alias("readable"))
    return thin.mapInArrow(frugal(run), f"id {dict(thin.dtypes)['id']}, lang_pred string, score double, bits_per_byte double{', fits boolean' * bool(norms)}").withColumnRenamed("id", id)


def described(docs: DataFrame, trees: ContextTrees, norms: Norms, *, text: str = "text", output: str = "found") -> DataFrame:
    """The rows with all their columns and `output`, a struct of what `identify` finds. Only the texts travel to the Python
    workers, and only the finding comes back."""
    found = _identified(_shipped(docs.sparkSession, trees), norms)

    def run(texts: pa.Array, readable: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(found(texts, readable), ["lang_pred", "score", "bits_per_byte", "fits"])

    # Deterministic functions would be run once for each use of their result.
    column = F.arrow_udf(run, "lang_pred string, score double, bits_per_byte double, fits boolean").asNondeterministic()
    return docs.withColumn(output, column(F.col(text), _readable(F.col(text))))


def predict(docs: DataFrame, rows: int = 400, *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the labelled rows outside the held-out fold and predict every row: `id`, held_out, lang_pred, score."""
    trees = fit(docs, rows, id=id, text=text, lang=lang)
    found = identify(docs, trees, id=id, text=text)
    return found.select(id, held_out(id).alias("held_out"), "lang_pred", "score", "bits_per_byte")
