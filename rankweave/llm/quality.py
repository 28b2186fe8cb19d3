"""Quality classifier: hashed word n-grams and logistic regression by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.learning import held_out, labelled_sample
from rankweave.llm.text import SPACES, byte_table, ngram_hashes, pieces, runs, span_hashes

_UPPER = byte_table(range(ord("A"), ord("Z") + 1))
_DIGIT = byte_table(range(ord("0"), ord("9") + 1))
_WORD = byte_table([*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)])


@dataclass(frozen=True)
class Settings:
    """`rows` bounds the labelled sample; the other fields are the usual ones of follow-the-regularised-leader."""

    rows: int = 8192
    bits: int = 18
    epochs: int = 2
    rate: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features (rows, slots, values) of texts, sorted by row and slot; each row's values have length 1.

    Tokens are runs of letters and digits (with all bytes beyond ASCII) and runs of other printing bytes. Counted are
    1- and 2-grams of tokens, and 1- to 3-grams of token forms: capitals, digits, length and kind. A value is
    log(1 + count) before scaling.
    """
    word = _WORD[data]
    found = [runs(word, offsets), runs(~word & ~SPACES[data], offsets)]
    starts, ends, rows = (np.concatenate(x) for x in zip(*found, strict=True))
    kind = np.repeat([0, 1], [len(found[0][0]), len(found[1][0])])
    order = np.argsort(starts, kind="stable")
    starts, ends, rows, kind = starts[order], ends[order], rows[order], kind[order]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    tokens = span_hashes(data, starts, ends)
    length = ends - starts
    capitals = np.add.reduceat(_UPPER[data].astype(np.int64), starts) if len(starts) else starts
    digits = np.add.reduceat(_DIGIT[data].astype(np.int64), starts)
    form = kind * 64 + np.minimum(length, 4) * 8 + (capitals > 0) + (capitals == length) * 2 + (digits > 0) * 4
    forms = (form.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    hashed, owners = [], []
    for salt, (values, width) in enumerate(((tokens, 1), (tokens, 2), (forms, 1), (forms, 2), (forms, 3))):
        h, at = ngram_hashes(values, rows, width)
        hashed.append((h ^ np.uint64(salt * 0x9E3779B1)) >> np.uint64(64 - bits))
        owners.append(rows[at])
    keys = np.concatenate(owners) << bits | np.concatenate(hashed).astype(np.int64)
    keys.sort()
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    owners, values = keys >> bits, np.log1p(counts)
    scale = np.sqrt(np.bincount(owners, values * values, minlength=len(offsets) - 1))
    return owners, keys & ((1 << bits) - 1), values / scale[owners]


def _sample_features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("_id"), batch.column("label")
            for first, last, data, offsets in pieces(batch.column("text")):
                rows, slots, values = features(data, offsets, bits)
                cut = np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        ids.slice(first, last - first), labels.slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(slots.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(values.astype(np.float32))),
                    ],
                    names=["_id", "label", "slots", "values"],
                )

    return run


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], s: Settings) -> np.ndarray:
    """Weights after `epochs` passes over the examples (slots, values, label). The last slot, 2^bits, is the bias."""
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)

    def weights(at):
        shrunk = np.sign(z[at]) * s.l1 - z[at]
        return np.where(np.abs(z[at]) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(n[at])) / s.rate + s.l2))

    for _ in range(s.epochs):
        for slots, values, label in examples:
            slots, values = np.append(slots, 1 << s.bits), np.append(values, 1.0)
            w = weights(slots)
            g = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            z[slots] += g - (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / s.rate * w
            n[slots] += g * g
    return weights(np.arange((1 << s.bits) + 1))


def fit(docs: DataFrame, labels: DataFrame, label: str, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> np.ndarray:
    """Weights from at most `settings.rows` labelled documents outside the held-out fold.

    Texts become sparse vectors where they are read; one task runs the updates over that bounded sample, in the order of
    the ids' hashes, and only its non-zero weights reach the driver (at most 2^bits). Without labelled rows all weights
    are 0.
    """
    sample = labelled_sample(docs, labels, label, settings.rows, id=id, text=text)
    vectors = sample.mapInArrow(_sample_features(settings.bits), "_id " + dict(sample.dtypes)["_id"] + ", label int, slots array<int>, values array<float>")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            slots, values, known = batch.column("slots"), batch.column("values"), batch.column("label")
            examples += [(slots[i].values.to_numpy(), values[i].values.to_numpy(), float(known[i].as_py())) for i in range(batch.num_rows)]
        w = ftrl(examples, settings)
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(at.astype(np.int64)), pa.array(w[at])], names=["slot", "weight"])

    ordered = vectors.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id", F.size("slots"), "label")
    found = ordered.mapInArrow(train, "slot long, weight double").toPandas()
    weights = np.zeros((1 << settings.bits) + 1)
    weights[found["slot"].to_numpy(np.int64)] = found["weight"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, *, bits: int = 18, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(`id`, score) for every row: the logistic of the sparse dot product of its whole text with the weights.

    A null or empty text has no features; its score comes from the bias alone. Rows with equal ids stay apart.
    """
    weights = weights.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows)
            for first, last, data, offsets in pieces(batch.column("text")):
                rows, slots, values = features(data, offsets, bits)
                out[first:last] = np.bincount(rows, values * weights[slots], minlength=last - first)
            scores = 1 / (1 + np.exp(-np.clip(out + weights[-1], -35, 35)))
            yield pa.record_batch([batch.column("id"), pa.array(scores)], names=["id", "score"])

    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return thin.mapInArrow(run, f"id {dict(thin.dtypes)['id']}, score double").withColumnRenamed("id", id)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled rows and score every document: `id`, held_out, score (0 to 1) and predicted (0 or 1)."""
    weights = fit(docs, labels, label, settings, id=id, text=text)
    scored = score(docs, weights, bits=settings.bits, id=id, text=text)
    return scored.select(id, held_out(id).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
