"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.learning import held_out, labelled_sample
from rankweave.llm.text import LOWER, SPACES, byte_table, pieces, runs

#: Subsequences of 3 bytes that span at most SPAN bytes weigh DECAY to the power of their span.
SPAN, DECAY = 6, 0.8
_STEPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
#: Longer words are read in windows of so many bytes, each starting half a window after the last.
WINDOW = 24
_MARKS = byte_table([b for b in range(0x21, 0x7F) if not chr(b).isalnum()] + [*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F])
_CODES = 1 << 24


@dataclass(frozen=True)
class Settings:
    """`rows` bounds the labelled sample, `landmarks` those chosen for insults and as many for plain words. The first
    `stretched` of them also train with a letter inserted."""

    rows: int = 8192
    landmarks: int = 128
    rounds: int = 4
    stretched: int = 32
    margin_cost: float = 100.0


@dataclass
class Model:
    """The decision function: a weight for each 3-byte subsequence, a bias, and the slope and offset to a probability."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def table(self) -> np.ndarray:
        dense = np.zeros(_CODES, np.float32)
        dense[self.codes] = self.weights
        return dense


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as the kernel sees them: (bytes of all units, bounds, row of each unit).

    A-Z count as a-z, marks inside and around a word are dropped (`i.d-i,o*t` is `idiot`), and three or more one-letter
    words in a row are joined. Words of more than WINDOW bytes become overlapping windows that cover them.
    """
    data = LOWER[data]
    kept = ~_MARKS[data]
    position = np.concatenate([[0], np.cumsum(kept)])
    data, offsets = data[kept], position[offsets]
    starts, ends, rows = runs(~SPACES[data], offsets)
    single = (ends - starts) == 1
    if single.any():
        follows = np.zeros(len(single), bool)
        follows[1:] = single[1:] & single[:-1] & (rows[1:] == rows[:-1])
        head = np.flatnonzero(single & ~follows)
        group = np.cumsum(single & ~follows)[single] - 1
        joined = np.zeros(len(single), bool)
        joined[single] = np.bincount(group, minlength=len(head))[group] >= 3
        glue = joined & follows
        new = np.flatnonzero(~glue)
        lengths = np.add.reduceat(ends - starts, new) if len(new) else ends[:0]
        keep = np.repeat(starts, ends - starts) + _count_up(ends - starts)
        data, rows = data[keep], rows[new]
        ends = np.cumsum(lengths)
        starts = ends - lengths
    lengths = ends - starts
    parts = np.maximum(1, -(-(lengths - WINDOW) // (WINDOW // 2)) + 1)
    first = np.repeat(starts, parts) + _count_up(parts) * (WINDOW // 2)
    size = np.minimum(WINDOW, np.repeat(ends, parts) - first)
    body = data[np.repeat(first, size) + _count_up(size)]
    return body, np.concatenate([[0], np.cumsum(size)]), np.repeat(rows, parts)


def _count_up(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count in turn."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


_LENGTHS = np.arange(WINDOW + 1)
#: The length of a unit's feature vector, by its bytes: features count apart even where they agree.
NORMS = np.sqrt(sum(np.maximum(0, _LENGTHS - a - b) * DECAY ** (2 * (a + b + 1)) for a, b in _STEPS))
NORMS[NORMS == 0] = 1.0


def _features(body: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(position of the first byte, 3-byte code, weight) of all subsequences within one unit, step by step."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    wide = body.astype(np.int32)
    for a, b in _STEPS:
        count = len(body) - a - b
        if count > 0:
            at = np.flatnonzero(owner[:count] == owner[a + b :])
            yield at, (wide[at] << 16) | (wide[at + a] << 8) | wide[at + a + b], DECAY ** (a + b + 1)


def kernel_sums(body: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each unit, the dot product of its scaled feature vector with a table of weights by code."""
    if len(bounds) < 2:
        return np.empty(0)
    total = np.zeros(len(body))
    for at, codes, weight in _features(body, bounds):
        total[at] += table[codes] * weight
    return np.add.reduceat(total, bounds[:-1]) / NORMS[np.diff(bounds)]


def landmark_tables(words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, weights) of the scaled feature vector of each landmark."""
    out = []
    for word in words:
        body = np.frombuffer(word, np.uint8)
        found: Counter = Counter()
        for _, codes, weight in _features(body, np.array([0, len(body)])):
            for c in codes.tolist():
                found[c] += weight
        out.append((np.array(list(found), np.int64), np.array(list(found.values())) / NORMS[len(body)]))
    return out


def kernel(words: list[bytes], landmarks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Kernel values, words x landmarks."""
    body = np.frombuffer(b"".join(words), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    table, out = np.zeros(_CODES, np.float32), np.zeros((len(words), len(landmarks)))
    for j, (codes, weights) in enumerate(landmarks):
        table[codes] = weights
        out[:, j] = kernel_sums(body, bounds, table)
        table[codes] = 0
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps; y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.append(np.ones(x.shape[1] - 1), 1e-3)
    value = np.inf
    for _ in range(50):
        slack = np.maximum(0, 1 - y * (x @ w))
        now = 0.5 * ridge @ (w * w) + cost @ (slack * slack)
        if value - now < 1e-9 * max(1.0, now):
            break
        value, active = now, slack > 0
        xa, ca = x[active], cost[active]
        w = np.linalg.solve(np.diag(ridge) + 2 * (xa * ca[:, None]).T @ xa, 2 * xa.T @ (ca * y[active]))
    return w[:-1], w[-1]


def _apart(bags: list[set[bytes]]) -> list[set[bytes]]:
    """One of each group of bags that share half of their units, so that copies of a text do not count as evidence."""
    kept: list[set[bytes]] = []
    holds: dict[bytes, list[int]] = {}
    for bag in bags:
        shared = Counter(i for word in bag for i in holds.get(word, ()))
        if not any(2 * n >= min(len(bag), len(kept[i])) for i, n in shared.items()):
            for word in bag:
                holds.setdefault(word, []).append(len(kept))
            kept.append(bag)
    return kept


def _telling(bags: list[set[bytes]], clean: set[bytes], texts: int, limit: int) -> list[bytes]:
    """Units that no clean text has and that are in too many toxic texts to be there by chance, the commonest first.

    By chance means: with the share of toxic texts as the odds, less than one in twenty among all units together. Then,
    greedily, units that explain three toxic texts which no unit chosen so far explains.
    """
    holds: dict[bytes, set[int]] = {}
    for i, bag in enumerate(bags):
        for word in bag - clean:
            if len(word) >= 3:
                holds.setdefault(word, set()).add(i)
    least = np.log(0.05 / (len(holds) + len(clean) + 1)) / np.log((len(bags) + 1) / (texts + 2))
    ranked = sorted(holds, key=lambda w: (-len(holds[w]), w))
    chosen = [w for w in ranked if len(holds[w]) >= max(3, least)][:limit]
    left = set(range(len(bags))).difference(*(holds[w] for w in chosen))
    while len(chosen) < limit:
        holds = {w: rest for w, at in holds.items() if len(rest := at & left) >= 3}
        if not holds:
            break
        word = max(holds, key=lambda w: (len(holds[w]), w))
        chosen.append(word)
        left -= holds.pop(word)
    return chosen


def train(texts: list[list[bytes]], labels: list[int], s: Settings) -> Model:
    """Fit on bags of units: one for each labelled text.

    A text is toxic if one of its units is, so which unit made it toxic is found along the way: first by the units that
    tell toxic texts, then, for each round, as the text's highest unit under the last machine. Plain units with the
    highest scores join the negatives of the next round.
    """
    bags = [set(u) for u, y in zip(texts, labels, strict=True) if y]
    clean = set().union(*(u for u, y in zip(texts, labels, strict=True) if not y))
    chosen = _telling(_apart(bags), clean, len(texts), s.landmarks)
    plain = sorted((w for w in clean if len(w) >= 3), key=lambda w: (hash_of(w), w))
    if not chosen or not plain:
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, 0.0, float(np.log((len(bags) + 1) / (len(texts) - len(bags) + 1))))
    marks = landmark_tables(chosen + plain[: len(chosen)])
    landmarks = chosen + plain[: len(chosen)]
    between = kernel(landmarks, marks)
    value, vector = np.linalg.eigh((between + between.T) / 2)
    kept = value > 1e-6 * value.max()
    to_features = vector[:, kept] / np.sqrt(value[kept])  # K_mm^(-1/2), up to a rotation

    good, bad = set(chosen), set(plain[: 50 * len(chosen)])
    for word in chosen[: s.stretched]:
        good.update(w for w in _stretched(word) if w not in clean and len(word) >= 5)
    table = np.zeros(_CODES, np.float32)
    everything = list(clean)
    for step in range(s.rounds):
        words = sorted(good) + sorted(bad)
        y = np.repeat([1.0, -1.0], [len(good), len(bad)])
        cost = np.where(y > 0, s.margin_cost * len(bad) / len(good), s.margin_cost)
        w, bias = _svm(kernel(words, marks) @ to_features, y, cost / 10)
        beta = to_features @ w
        table[:] = 0
        for b, (codes, weights) in zip(beta, marks, strict=True):
            table[codes] += b * weights
        if step + 1 < s.rounds:
            hard = np.argsort(-_scores(everything, table))[: 50 * len(chosen)]
            bad |= {everything[i] for i in hard}
            for bag in bags:
                own = sorted(bag - clean)
                if own:
                    scores = _scores(own, table) + bias
                    if scores.max() > 0:
                        good.add(own[int(scores.argmax())])
    value = np.array([max([0.0, *_scores(sorted(set(u)), table)]) + bias for u in texts])
    slope, offset = _sigmoid(value, np.array(labels, float))
    codes = np.flatnonzero(table)
    return Model(codes, table[codes].astype(float), float(bias), slope, offset)


def _stretched(word: bytes) -> list[bytes]:
    """The word with one letter inserted at each inner place; which letter follows from the word."""
    letter = hash_of(word)
    return [word[:k] + bytes([97 + (letter >> 5 * k % 40) % 26]) + word[k:] for k in range(1, len(word))]


def hash_of(word: bytes) -> int:
    return int.from_bytes(word, "big") * 0x9E3779B97F4A7C15 % (1 << 64)


def _scores(words: list[bytes], table: np.ndarray) -> np.ndarray:
    body = np.frombuffer(b"".join(words), np.uint8)
    return kernel_sums(body, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64), table)


def _sigmoid(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic that fits the labels, with equal weight for both classes together.

    The labels are drawn in a little, so that both numbers stay finite."""
    yes, no = label.sum(), (1 - label).sum()
    share = np.where(label > 0, 0.5 / max(yes, 1), 0.5 / max(no, 1)) * len(label)
    target = np.where(label > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    w = np.array([1.0, 0.0])
    x = np.stack([value, np.ones_like(value)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        move = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (share * (target - p)))
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _distinct_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels = batch.column("_id"), batch.column("label")
        for first, last, data, offsets in pieces(batch.column("text")):
            body, bounds, rows = units(data, offsets)
            raw, at = body.tobytes(), np.searchsorted(rows, np.arange(last - first + 1))
            for i in range(last - first):
                found = {raw[bounds[k] : bounds[k + 1]] for k in range(at[i], at[i + 1])}
                yield pa.record_batch([ids.slice(first + i, 1), labels.slice(first + i, 1), pa.array([sorted(found)], pa.list_(pa.binary()))], names=["_id", "label", "units"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> Model:
    """Train on at most `settings.rows` labelled documents outside the held-out fold.

    Texts become their distinct units where they are read; one task trains on that bounded sample in the order of the
    ids' hashes. The driver gets the model: weights of at most the landmarks' subsequences. Without toxic rows every
    score is the same low one.
    """
    sample = labelled_sample(docs, labels, label, settings.rows, id=id, text=text)
    bags = sample.mapInArrow(_distinct_units, f"_id {dict(sample.dtypes)['_id']}, label int, units array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, known = [], []
        for batch in batches:
            texts += batch.column("units").to_pylist()
            known += batch.column("label").to_pylist()
        m = train(texts, [int(k == 1) for k in known], settings)
        numbers = [m.bias, m.slope, m.offset]
        yield pa.record_batch([pa.array([-3, -2, -1, *m.codes.tolist()]), pa.array([*numbers, *m.weights.tolist()])], names=["code", "weight"])

    ordered = bags.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id", "label")
    found = ordered.mapInArrow(run, "code long, weight double").toPandas().sort_values("code")
    code, weight = found["code"].to_numpy(np.int64), found["weight"].to_numpy(float)
    if not len(code):
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, 0.0, 0.0)
    return Model(code[3:], weight[3:], *weight[:3].tolist())


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(`id`, score, witness) for every row: the probability from its highest unit, and that unit (ties: the first).

    The whole text counts. A null or empty text, or one without units, has score of a unit that is like no landmark, and
    a null witness. Rows with equal ids stay apart; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            best, witness = np.zeros(batch.num_rows), [None] * batch.num_rows
            for first, last, data, offsets in pieces(batch.column("text")):
                body, bounds, rows = units(data, offsets)
                if not len(rows):
                    continue
                values = kernel_sums(body, bounds, table)
                heads = np.flatnonzero(np.diff(rows, prepend=-1))
                top = np.maximum.reduceat(values, heads)
                best[first + rows[heads]] = np.maximum(top, 0)
                hit = np.flatnonzero(values == np.repeat(top, np.diff(np.append(heads, len(rows)))))
                hit = hit[np.flatnonzero(np.diff(rows[hit], prepend=-1))]
                raw = body.tobytes()
                for k in hit[values[hit] + model.bias > 0]:
                    witness[first + rows[k]] = raw[bounds[k] : bounds[k + 1]].decode("utf-8", "replace")
            scores = 1 / (1 + np.exp(-np.clip(model.slope * (best + model.bias) + model.offset, -35, 35)))
            yield pa.record_batch([batch.column("id"), pa.array(scores), pa.array(witness, pa.string())], names=["id", "score", "witness"])

    thin = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return thin.mapInArrow(run, f"id {dict(thin.dtypes)['id']}, score double, witness string").withColumnRenamed("id", id)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled rows and score every document: `id`, held_out, score (0 to 1), predicted (0 or 1), witness."""
    scored = score(docs, fit(docs, labels, label, settings, id=id, text=text), id=id, text=text)
    return scored.select(id, held_out(id).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "witness")
