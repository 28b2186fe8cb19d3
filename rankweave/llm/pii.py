"""Personal data: wide generators propose spans, boosted trees score them, a calibrated threshold per kind selects."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.boosting import Boosted, boost
from rankweave.llm.learning import first_by_hash
from rankweave.llm.text import frugal

#: The kinds in the order in which spans are listed. The first four have base patterns.
KINDS = ["email", "ip", "card", "phone", "secret", "account"]
BASE_KINDS = KINDS[:4]

_MAYBE = re.compile(r"[0-9@]|[(\[]at[)\]]|[A-Z0-9]{16}|pass|token|secret|key|pwd", re.I)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns' matches, by kind and start, in time linear in the text.

    Leftmost matches that do not overlap within a kind; a match that fails its test is dropped and not tried again:
    ip parts at most 255, 13 to 19 card digits that pass Luhn, 9 to 15 phone digits.
    """
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            out.append((0, start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    for match in _NUMBERS.finditer(text):
        if match[0].count(".") >= 3:
            parts, start = match[0].split("."), match.start()
            for k in range(0, len(parts) - 3, 4):
                end = start + sum(map(len, parts[k : k + 4])) + 3
                if all(map(_small, parts[k : k + 4])):
                    out.append((1, start, end))
                start = end + 1
    for match in _DIGITS.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _NOT_DIGIT.sub("", match[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, match.start(), match.end()))
    if "+" in text:
        for match in _DIALLED.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                out.append((3, match.start(), match.end()))
    return out


#: Generators: kind, pattern, group that is the span. They may overlap and may be wrong; the trees decide.
GENERATORS = [
    (0, re.compile(r"(?<![\w.+-])[\w.+-]{1,64}\s?(?:@|\(at\)|\[at\])\s?[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]{1,63}){1,8}", re.I), 0),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])"), 0),
    (2, re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])"), 0),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){3}(?![0-9])"), 0),
    (3, re.compile(r"(?<![0-9+])\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"), 0),
    (3, re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"), 0),
    (4, re.compile(r"(?:key|token|secret|passwo?r?d|pwd)\s{0,3}[:=]\s{0,3}[\"']?([^\s\"']{6,256})", re.I), 1),
    (4, re.compile(r"(?<![A-Za-z0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,64}(?![A-Za-z0-9])"), 0),
    (4, re.compile(r"(?<![A-Za-z0-9])(?=[0-9]*[A-Fa-f])[A-Fa-f0-9]{18,128}(?![A-Za-z0-9])"), 0),
    (5, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), 0),
    (5, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), 0),
]
_NAMED = re.compile(r"(?:key|token|secret|passwo?r?d|pwd)\W{0,5}$", re.I)


def candidates(text: str) -> list[tuple[int, int, int]]:
    found = {(kind, *match.span(group)) for kind, pattern, group in GENERATORS for match in pattern.finditer(text)}
    return sorted(found)


def features(text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Format of each span and what stands around it."""
    rows = []
    for kind, start, end in spans:
        body, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 1]
        digits = _NOT_DIGIT.sub("", body)
        counts, size = Counter(body), len(body)
        parts = [p for p in body.split(".") if p.isdigit()]
        rows.append(
            [float(kind == k) for k in range(len(KINDS))]
            + [
                size, len(digits), len(digits) / size, sum(c.isupper() for c in body) / size, sum(c.islower() for c in body) / size,
                len(counts), -sum(n / size * math.log2(n / size) for n in counts.values()), float(bool(digits) and luhn(digits)),
                max((int(p[:6]) for p in parts), default=0), sum(not c.isalnum() for c in body), float(body.startswith("+")), float("@" in body),
                float(bool(_NAMED.search(before))), float(before[-1:].isalnum()), float(before[-1:].isspace() or not before), float(after.isalnum()), float(after.isspace() or not after),
            ]
        )
    return np.array(rows, float).reshape(len(rows), len(KINDS) + 17)


def rule_label(text: str, kind: int, start: int, end: int) -> int | None:
    """What is known of a candidate without a person looking: 1 personal, 0 not, None unknown. Only training uses it."""
    body = text[start:end]
    digits = _NOT_DIGIT.sub("", body)
    if kind == 0:
        return 1 if base_spans(body) == [(0, 0, len(body))] else None
    if kind == 1:
        return int(all(map(_small, body.split("."))))
    if kind == 2:
        return int(luhn(digits) and len(set(digits)) > 2)
    if kind == 3:
        return 1 if body.startswith("+") and 9 <= len(digits) <= 15 else None
    if kind == 4:
        letters = len(body) - len(digits)
        if not digits or len(set(body)) < 6:
            return 0
        return 1 if letters and len(digits) >= 3 and (_NAMED.search(text[max(0, start - 24) : start]) or body.startswith("AKIA")) else None
    return None


def spoiled(text: str, kind: int, start: int, end: int) -> tuple[str, tuple[int, int, int]] | None:
    """The text with an address or card number made impossible, and where it stands: a sure example of no personal data."""
    body = text[start:end]
    if kind == 1:
        first, dot, rest = body.partition(".")
        body = f"{300 + int(first) % 600}{dot}{rest}"
    elif kind == 2:
        body = body[:-1] + str((int(body[-1]) + 1 + start % 8) % 10)
    else:
        return None
    return text[:start] + body + text[end:], (kind, start, start + len(body))


@dataclass
class Model:
    """Trees and, for each kind, the least probability for redaction (over 1: never)."""

    trees: Boosted | None = None
    least: list[float] = field(default_factory=lambda: [2.0] * len(KINDS))


@dataclass(frozen=True)
class Settings:
    """`rows` bounds the sample of documents, `precision` is what each kind's threshold must reach on its last fifth."""

    rows: int = 16384
    precision: float = 0.98


def train(x: np.ndarray, y: np.ndarray, s: Settings) -> Model:
    """Fit on four fifths of the labelled candidates and set each kind's threshold on the rest."""
    if not y.any():
        return Model()
    part = np.arange(len(y)) % 5 == 4
    trees = boost(x[~part], y[~part])
    p, least = trees.probability(x), []
    for kind in range(len(KINDS)):
        mine = (x[:, kind] > 0) & (part | (y > 0))
        if not (mine & (y > 0)).any():
            least.append(0.9)
            continue
        order = np.argsort(-p[mine])
        right = np.cumsum(y[mine][order]) / np.arange(1, mine.sum() + 1)
        good = np.flatnonzero(right >= s.precision)
        least.append(max(0.5, float(p[mine][order][good[-1]]) * 0.5 + 0.25) if len(good) else 2.0)
    return Model(trees, least)


def select(text: str, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans by kind and start: the base ones and the chosen candidates, which overlap none of them
    nor each other; of overlapping candidates the likeliest stays (ties: the first)."""
    base = base_spans(text)
    found = candidates(text)
    if not found or model.trees is None:
        return base, base
    p = model.trees.probability(features(text, found))
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for score, (kind, start, end) in sorted(zip(p.tolist(), found, strict=True), key=lambda c: (-c[0], c[1])):
        if score >= model.least[kind] and not any(a < end and start < b for a, b in taken):
            taken.append((start, end))
            added.append((kind, start, end))
    return base, sorted(base + added)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by its first kind's name in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def fit(docs: DataFrame, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> Model:
    """Train on the candidates of at most `settings.rows` documents, the first by a hash of the id.

    There are no tables of labelled personal data, so rules label what they are sure of (`rule_label`), and each address
    and card number found is a counterexample once spoiled; what the rules cannot tell is only scored. Null ids are not sampled. One task trains on that bounded sample.
    """
    ids = first_by_hash(docs.where(F.col(id).isNotNull()).select(F.col(id).alias("_id")).distinct(), "_id", settings.rows)
    texts = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("text").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for value in batch.column("text").to_pylist():
                if _MAYBE.search(value):
                    found = [(c, y) for c in candidates(value) if (y := rule_label(value, *c)) is not None]
                    rows += features(value, [c for c, _ in found]).tolist()
                    labels += [y for _, y in found]
                    for changed, span in filter(None, (spoiled(value, *c) for c, y in found if y)):
                        rows += features(changed, [span]).tolist()
                        labels.append(0)
            yield pa.record_batch([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32())], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for batch in batches:
            x += batch.column("x").to_pylist()
            y += batch.column("y").to_pylist()
        m = train(np.array(x, float).reshape(len(x), len(KINDS) + 17), np.array(y, float), settings)
        if m.trees is not None:
            trees = m.trees
            yield pa.record_batch([pa.array([[trees.base], trees.feature.ravel().tolist(), trees.cut.ravel().tolist(), trees.leaf.ravel().tolist(), m.least, [float(len(trees.leaf))]], pa.list_(pa.float64()))], names=["v"])

    described = texts.mapInArrow(frugal(describe), "x array<double>, y int")
    ordered = described.repartition(1).sortWithinPartitions(F.xxhash64("x"), "x", "y")
    found = [r.v for r in ordered.mapInArrow(frugal(run), "v array<double>").collect()]
    if not found:
        return Model()
    base, feature, cut, leaf, least, (count,) = found
    shape = (int(count), -1)
    return Model(Boosted(base[0], np.array(feature).astype(int).reshape(shape), np.array(cut).reshape(shape), np.array(leaf).reshape(shape)), list(least))


def find(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: `id`, base and spans (arrays of kind, start, end in code points, end exclusive) and redacted text.

    Whole texts are searched; a null text is empty, and its redacted text is null. Rows with equal ids stay apart; other
    columns are not read.
    """
    one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans, clean = [], [], []
            for value in batch.column("text"):
                value = value.as_py()
                first, every = select(value, model) if value and _MAYBE.search(value) else ([], [])
                for column, found in ((base, first), (spans, every)):
                    column.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found])
                clean.append(redacted(value, every) if every else value)
            yield pa.record_batch([batch.column("id"), pa.array(base, pa.list_(one)), pa.array(spans, pa.list_(one)), pa.array(clean, pa.string())], names=["id", "base", "spans", "redacted"])

    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = "array<struct<kind: string, start: bigint, end: bigint>>"
    return thin.mapInArrow(frugal(run), f"id {dict(thin.dtypes)['id']}, base {kind}, spans {kind}, redacted string").withColumnRenamed("id", id)


def without_personal_data(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows with all their columns, `text` redacted as `find` does it. Only the texts travel to the Python workers, and
    only the changed ones come back."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            value = value.as_py()
            every = select(value, model)[1] if value and _MAYBE.search(value) else []
            out.append(redacted(value, every) if every else None)
        return pa.array(out, pa.string())

    name = "_changed"
    while name in docs.columns:
        name += "_"
    changed = F.arrow_udf(run, "string").asNondeterministic()(F.col(text))
    return docs.withColumn(name, changed).withColumn(text, F.coalesce(F.col(name), F.col(text))).drop(name)
