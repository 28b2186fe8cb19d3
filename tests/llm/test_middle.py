"""Fill-in-the-middle: containers, cuts and the way back; importance resampling: gains, radix ranks and the draw."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from rankweave.llm import importance, middle
from tests.oracle_check import compare, duck_connection

CLASH = "doc_id long, text string, form string, `_cut` string, output string, n string, id string, score string, `_position` string, bucket string"


def clash(rows):
    return [(i, t, *["x"] * 8) for i, t in rows]


@pytest.mark.parametrize(
    ("flags", "kind"),
    [
        (np.ones(5000, bool), "run"),
        (np.resize([True, False, False], 3000), "array"),
        (np.resize([True, False], 60_000), "bitmap"),
        (np.resize([False, True, True, True], 40_000), "bitmap"),
        (np.zeros(10, bool), "array"),
        (np.concatenate([np.ones(65_536, bool), np.resize([True, False], 65_536), np.resize([True, False, False, False], 9_000)]), "run"),
    ],
)
def test_select_in_every_container(flags, kind):
    places = middle.Boundaries(flags)
    want = np.flatnonzero(flags)
    assert places.containers[0][0] == kind and len(places) == len(want)
    assert [places.select(k) for k in range(0, len(want), 7)] == want[::7].tolist()
    assert places.select(len(want)) == len(flags)


def test_select_over_many_containers():
    flags = np.concatenate([np.ones(65_536, bool), np.resize([True, False], 65_536), np.zeros(65_536, bool), np.resize([True, *[False] * 30], 70_000)])
    places = middle.Boundaries(flags)
    assert [c[0] for c in places.containers] == ["run", "bitmap", "array", "array", "array"]
    want = np.flatnonzero(flags)
    assert [places.select(k) for k in range(0, len(want), 501)] == want[::501].tolist()
    assert len(middle.Boundaries(flags[:0])) == 0 and middle.Boundaries(flags[:0]).select(0) == 0


def plain_middle(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(text), "plain", None, None, text)
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, len(text), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, len(text), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def test_middle_equals_plain_slices_and_comes_back(spark):
    rnd = random.Random(2)
    letters = ["a", "é", "日", "😀", "<", ">", "P", "S", "M", " "]
    texts = ["".join(rnd.choices(letters, k=rnd.randrange(40))) for _ in range(300)]
    texts += [None, "", "x", "日" * 50_000, "a" * 140_000 + "é" * 10, "😀a" * 40_000, "has <P> in it", "<<P<S>", "<M", "<P", ">"]
    docs = list(enumerate(texts)) + [(None, "no id"), (7, "same id"), (7, "same id")]
    got = middle.fill_in_middle(spark.createDataFrame(clash(docs), CLASH), keep=["text"])
    got = got.withColumn("back", middle.restore("output", "form")).collect()
    want = sorted((repr(plain_middle(i, t)) for i, t in docs))
    assert sorted(repr(tuple(r)[:6]) for r in got) == want
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_middle_of_no_rows(spark):
    assert middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_radix_ranks_equal_a_sort(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([0, 1, 5, 1000, 70_000]), rnd.randrange(1 << 33)) for i in range(3000)] + [(3000, 5, 7), (3001, 5, 7)]
    df = spark.createDataFrame(rows, "id long, a long, b long").repartition(7)
    fields = [(F.col("b"), 33), (F.col("a"), 17)]
    got = importance.radix_rank(df, fields, digit_bits=5, block_rows=64).collect()
    assert sorted(r._position for r in got) == list(range(len(rows)))
    ordered = [(r.a, r.b) for r in sorted(got, key=lambda r: r._position)]
    assert ordered == sorted((a, b) for _, a, b in rows)
    same = importance.radix_rank(df, [], block_rows=10).collect()
    assert sorted(r._position for r in same) == list(range(len(rows)))


def plain_resample(docs, target, width, buckets=10_000, least=20, percent=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def features(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[k : k + n]).encode()) % buckets for n in range(1, width + 1) for k in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in docs for b in features(x)), Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        f = features(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    enough = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(enough[: len(enough) * percent // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("width", [1, 2])
def test_resampling_equals_brute_force(spark, width):
    rnd = random.Random(width)
    text = lambda n: " ".join(rnd.choice(["alpha", "Beta", "gämma", "42", "x_y", "z"]) + rnd.choice(["", str(rnd.randrange(30))]) for _ in range(n))
    docs = [(rnd.choice([1, -1]) * (i + rnd.choice([0, 1 << 40, 1 << 62])), text(rnd.randrange(60))) for i in range(400)]
    docs += [(None, text(30)), (None, text(30)), (9, None), (10, ""), (11, "!!"), (12, "W " * 4000), (13, "q" * 3000), (50, docs[3][1]), (50, docs[4][1]), (50, docs[4][1])]
    target = [text(20) for _ in range(30)] + [None, ""]
    bench = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    got = importance.resample(spark.createDataFrame(clash(docs), CLASH), bench, importance.Settings(width=width))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, plain_resample(docs, target, width)))


def test_resampling_without_documents_or_target(spark):
    docs = [(i, " ".join(f"w{k * i}" for k in range(25))) for i in range(20)]
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(docs, "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert sorted(map(tuple, importance.resample(some, none).collect())) == sorted(plain_resample(docs, [], 1))


@pytest.mark.parametrize("name", ["op11_simhash", "op12_fill_in_middle", "op13_importance"])
def test_sql_twins(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck_connection(sf), name, entry_points.queries()[name], entry_points.oracle_sql()[name], sf) == []
