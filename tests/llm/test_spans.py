"""Word spans and their digests, fingerprints, vantage-point trees and the groups they give."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rankweave.llm import hamming, simhash, spans
from rankweave.llm.text import SPACES, utf8
from tests.llm import brute

CLASH = "doc_id long, text string, fp string, node string, component string, `_rows` string, shard string, id string"


def clash(rows):
    return [(i, t, "f", "n", "c", "r", "s", "i") for i, t in rows]


def test_digests_equal_the_libraries():
    rnd = random.Random(1)
    buffer = np.frombuffer(rnd.randbytes(9000), np.uint8)
    starts = np.array([rnd.randrange(4000) for _ in range(2000)])
    ends = starts + np.array([rnd.choice([*range(0, 70), 95, 96, 97, 300, 4000]) for _ in starts])
    parts = [buffer[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert spans.crc32(buffer, starts, ends).tolist() == [zlib.crc32(p) for p in parts]
    for seed in (0, 42):
        assert spans.xxh64(buffer, starts, ends, seed).tolist() == [xxhash.xxh64_intdigest(p, seed=seed) for p in parts]
    none = starts[:0]
    assert len(spans.crc32(buffer, none, none)) == len(spans.xxh64(buffer, none, none)) == 0


def test_words_are_joined_within_rows():
    texts = ["Hello  World a", None, "", "x", "  ", "end", "é Z\tq\n", "a"]
    buffer, starts, ends, rows = spans.joined_words(*utf8(pa.array(texts)), ~SPACES)
    words = [(bytes(buffer[a:b]).decode(), int(r)) for a, b, r in zip(starts, ends, rows, strict=True)]
    assert words == [("hello", 0), ("world", 0), ("a", 0), ("x", 3), ("end", 5), ("é", 6), ("z", 6), ("q", 6), ("a", 7)]
    first, last, owner = spans.word_runs(starts, ends, rows, 3)
    assert [(bytes(buffer[a:b]).decode(), int(r)) for a, b, r in zip(first, last, owner, strict=True)] == [("hello world a", 0), ("é z q", 6)]


def plain_simhash(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_short_long_and_repeated_texts():
    texts = ["", None, " \t", "a", "a B", "a b c", "a b c d", "é ü 日本 w", "x " * 700, " ".join(f"w{k % 97}" for k in range(3000)), "one", "a" * 5000 + " b c"]
    got = simhash.simhash(*utf8(pa.array(texts)))
    assert got.tolist() == [plain_simhash(t) for t in texts]


def planted(rnd, clusters=40, loose=300):
    points = [rnd.getrandbits(64) for _ in range(loose)]
    for _ in range(clusters):
        at = rnd.getrandbits(64)
        for _ in range(rnd.choice([2, 5, 30])):
            points.append(at)
            for _ in range(rnd.choice([1, 1, 2, 3])):
                at ^= 1 << rnd.randrange(64)
    # A dense ball: all words with up to two of twelve bits changed.
    centre = rnd.getrandbits(64)
    points += [centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a, 12)]
    return np.array(sorted(set(points)), np.uint64)


@pytest.mark.parametrize("reach", [0, 1, 2, 5])
def test_two_near_points_meet_once_where_one_is_at_home(reach):
    points = planted(random.Random(reach))
    tree = hamming.grow(points, 8, reach, 6)
    leaf, which, guest = hamming.route(tree, points, np.zeros(len(points), bool), reach)
    assert sorted(which[~guest].tolist()) == list(range(len(points)))
    meetings = {}
    for at in np.unique(leaf):
        homes, visitors = which[(leaf == at) & ~guest], which[(leaf == at) & guest]
        for i, a in enumerate(homes):
            for b in [*homes[i + 1 :], *visitors]:
                meetings[frozenset((int(a), int(b)))] = meetings.get(frozenset((int(a), int(b))), 0) + 1
    near = {frozenset((i, j)) for i in range(len(points)) for j in range(i) if int(points[i] ^ points[j]).bit_count() <= reach}
    assert near <= set(meetings) and {meetings[p] for p in near} <= {1}
    if reach == 0:
        assert not guest.any()


@pytest.mark.parametrize("reach", [1, 2, 3])
def test_links_connect_exactly_what_is_near(spark, reach):
    points = planted(random.Random(10 + reach))
    signed = [(int(p),) for p in points.view(np.int64)] + [(None,), (int(points.view(np.int64)[0]),)]
    small = hamming.Settings(leaf=8, shards_per_partition=8, least_rows=16, sample=8)
    links = hamming.near_links(spark.createDataFrame(signed, "fp long"), reach, small).collect()
    value = [int(p) for p in points]
    near = [(a, b) for i, a in enumerate(value) for b in value[:i] if (a ^ b).bit_count() <= reach]
    got = [(r.a % 2**64, r.b % 2**64) for r in links]
    # A link may lead over a guest of the leaf, so its ends are connected but need not be near themselves.
    assert brute.components(value, got) == brute.components(value, near)
    assert near and len(got) < 8 * len(value)


def test_groups_equal_brute_force(spark):
    rnd = random.Random(5)
    base = [" ".join(f"w{rnd.randrange(50)}" for _ in range(60)) for _ in range(12)]
    texts = ["", None, " \n ", "one", "One"] + base * 3
    for text in base:
        for _ in range(6):
            words = text.split()
            words[rnd.randrange(60)] = "edited"
            texts.append(" ".join(words))
    docs = [(i * 3 - 40, t) for i, t in enumerate(texts)] + [(None, "alone and without an id"), (None, base[0]), (5000, base[1]), (5000, base[2])]
    small = hamming.Settings(leaf=4, least_rows=4, sample=4)
    got = simhash.simhash_groups(spark.createDataFrame(clash(docs), CLASH), settings=small).collect()
    prints = [plain_simhash(t) for _, t in docs]
    nodes = range(len(docs))
    groups = brute.components(nodes, [(i, j) for i in nodes for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for i in nodes:
        if docs[i][0] is not None:
            least[groups[i]] = min(least.get(groups[i], docs[i][0]), docs[i][0])
    want = sorted(map(repr, ((docs[i][0], f"{prints[i]:016x}", least.get(groups[i])) for i in nodes)))
    assert sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    assert len(set(groups.values())) < len(set(prints))


def test_groups_of_no_rows_and_of_one(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = simhash.simhash_groups(spark.createDataFrame([(4, None)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in one] == [(4, "0" * 16, 4)]
