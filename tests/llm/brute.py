"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict


def shingles(text: str | None) -> frozenset:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_groups(docs: list[tuple]) -> dict:
    sets = {i: shingles(t) for i, t in docs}
    links = []
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    groups = components(sets, links)
    return {i: (len(sets[i]), groups[i]) for i in sets}


def code_bits(train: list[bytes], text: bytes, order: int = 3) -> float:
    counts: dict = defaultdict(Counter)
    for t in train:
        padded = b" " * order + t
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[padded[i - k : i]][padded[i]] += 1
    total, padded = 0.0, b" " * order + text
    for i in range(order, len(padded)):
        for k in range(order, -1, -1):
            seen = counts.get(padded[i - k : i])
            if seen is None:
                continue
            n, d = sum(seen.values()), len(seen)
            if padded[i] in seen:
                total -= math.log2(seen[padded[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def align(item, passage, match=2, mismatch=-1, gap=-1) -> int:
    last, best = [0] * (len(passage) + 1), 0
    for a in item:
        row = [0]
        for j, b in enumerate(passage):
            row.append(max(0, last[j] + (match if a == b else mismatch), last[j + 1] + gap, row[j] + gap))
        best, last = max(best, *row), row
    return best


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str) -> list:
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(d if i % 2 == 0 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((k, *m.span()))
    return out


def words(text: str | None) -> list:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaks(docs: list, items: list, s) -> set:
    """(document, item, points) of all documents and items, each item aligned with each whole text that has a telling seed."""

    def seeds(w):
        return [tuple(w[k : k + s.width]) for k in range(len(w) - s.width + 1)]

    item_words = {i: words(t) for i, t in items}
    doc_words = [(d, words(t)) for d, t in docs]
    kinds = {tuple(w) for w in item_words.values()}
    held = Counter(seed for w in kinds for seed in set(seeds(list(w))))
    few = s.few_items + s.few_share * len(kinds)
    documents = Counter(seed for _, w in doc_words for seed in set(seeds(w)))
    out = set()
    for i, w in item_words.items():
        own = [seed for seed in seeds(w) if held[seed] <= few]
        weights = [0] * len(w)
        for k, seed in enumerate(seeds(w)):
            for j in range(s.width):
                weights[k + j] |= held[seed] <= few
        if own:
            middle = sorted(documents[x] for x in own)
            median = (middle[(len(own) - 1) // 2] + middle[len(own) // 2]) / 2
            limit = max(s.rare_rows + s.rare_share * len(docs), 4 * median)
            telling = {x for x in own if documents[x] <= limit}
        else:
            weights, telling = [1] * len(w), set(seeds(w))
        full = s.match * sum(weights)
        for d, text in doc_words:
            if not telling & set(seeds(text)):
                continue
            last, points = [0] * (len(text) + 1), 0
            for a, weight in zip(w, weights, strict=True):
                row = [0]
                for j, b in enumerate(text):
                    row.append(max(0, last[j] + (s.match * weight if a == b else s.mismatch), last[j + 1] + s.gap, row[j] + s.gap))
                points, last = max(points, *row), row
            enough = points >= s.share * full and points >= min(full, s.least) or points >= s.points
            if points >= full if not own else enough:
                out.add((d, i, points))
    return out
