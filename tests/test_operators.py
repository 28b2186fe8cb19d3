"""Relational operators against brute force, with settings small enough to reach their skew paths."""

import collections
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rankweave.functions import encode
from rankweave.functions.byte_hash import byte_hash
from rankweave.functions.scores import gaussian_cdf, normalize_scores, sigmoid
from rankweave.functions.vectors import cosine_similarity, sparse_vector
from rankweave.operators import binary_eval, cleaning, profile, ranking_eval, sequences, similarity
from rankweave.operators.indexing import index_ids
from rankweave.operators.joins import hot_keys, key_counts, skew_safe_join

BYTE_HASHES = {
    "test": (-1167338989, -2353579381090595187, [-6017608668500074083, -7344664891132916350]),
    "bat": (-1528583113, 797495713783027131, [3551180214319987150, 8473415072495952696]),
    "mouse": (579094372, 692581152243738501, [3692097994347420905, 151997300441887120]),
    "horse": (-2106200120, 481449084967948455, [-4542030370415664205, 6250857513869398141]),
    "hello, world!": (-327098478, 4210743881558459837, [-5307364510503470246, -7374811567047135714]),
    "体育": (1369536192, -4578860846627055949, [2262771425408326273, -819159687703668653]),
}


def test_byte_hashes(spark):
    df = spark.createDataFrame([(w,) for w in [*BYTE_HASHES, None, "", "x" * 5000]], "t string").coalesce(1)
    t = F.col("t")
    rows = df.select("t", byte_hash(t, "hash32").alias("a"), byte_hash(t, "hash64").alias("b"), byte_hash(t, "hash128").alias("c"))
    found = {r["t"]: (r["a"], r["b"], r["c"]) for r in rows.collect()}
    assert found[None] == (None, None, None)
    for word, expected in BYTE_HASHES.items():
        assert found[word] == expected


def skewed_rows(n=400, seed=1):
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None]), i % 7) for i in range(n)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    left = spark.createDataFrame(skewed_rows(), "id long, k string, x int").repartition(3)
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("a", 3), ("z", 4)], "k string, y int")
    expected = sorted(map(repr, left.join(right, ["k"], how).collect()))
    found = skew_safe_join(left, right, ["k"], how, salt_by=["id"], share_rows=10, counts=key_counts(left, ["k"]))
    assert sorted(map(repr, found.select(left.join(right, ["k"], how).columns).collect())) == expected
    assert "_share" not in found.columns


def test_hot_keys(spark):
    left = spark.createDataFrame(skewed_rows(), "id long, k string, x int")
    hot = {r["k"]: r["_shares"] for r in hot_keys(key_counts(left, ["k"]), ["k"], 100).collect()}
    assert set(hot) == {"hot"} and hot["hot"] >= 2
    assert hot_keys(key_counts(left, ["k"]), ["k"], 1000) is None


def event_rows(n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        device = "heavy" if rng.random() < 0.4 else f"d{rng.randint(0, 12)}"
        rows.append((i, datetime(2024, 1, 1) + timedelta(seconds=rng.randint(0, 4000)), device, str(rng.randint(0, 9)), rng.randint(0, 1)))
    return rows


EVENTS = "event_id long, ts timestamp, device_id string, feed_id string, label int"


def test_sequences_in_parts(spark):
    rows = event_rows()
    df = spark.createDataFrame(rows, EVENTS).repartition(4)
    expected = collections.defaultdict(list)
    for event_id, ts, device, feed, label in sorted(rows, key=lambda r: (r[1], r[0])):
        if label == 1:
            expected[device].append(feed)
    found = sequences.user_sequences(df, part_size=7)
    parts = collections.defaultdict(dict)
    for r in found.collect():
        assert len(r["feeds"]) <= 7
        parts[r["device_id"]][r["part"]] = r["feeds"]
    joined = {d: [f for p in sorted(by_part) for f in by_part[p]] for d, by_part in parts.items()}
    assert joined == {d: feeds for d, feeds in expected.items() if len(feeds) > 1}
    assert len(parts["heavy"]) > 1
    for by_part in parts.values():
        assert all(len(by_part[p]) == 7 for p in list(sorted(by_part))[:-1])


def test_ordered_positions_with_one_hot_group(spark):
    df = spark.createDataFrame(event_rows(), EVENTS)
    numbered = sequences.ordered_positions(df, ["device_id"], ["ts", "event_id"], F.date_trunc("minute", "ts")).collect()
    by_device = collections.defaultdict(list)
    for r in numbered:
        by_device[r["device_id"]].append((r["_position"], r["ts"], r["event_id"]))
    for entries in by_device.values():
        entries.sort()
        assert [e[0] for e in entries] == list(range(len(entries)))
        assert [e[1:] for e in entries] == sorted(e[1:] for e in entries)


def test_best_label(spark):
    rows = [("2024-01-01", "d", "f", 0, 1), ("2024-01-01", "d", "f", 1, 2), ("2024-01-01", "d", "f", 1, 3), ("2024-01-02", "d", "f", 0, 4)]
    df = spark.createDataFrame(rows, "label_date string, device_id string, feed_id string, label int, id int")
    assert sorted(r["id"] for r in cleaning.best_label(df, [F.col("id")]).collect()) == [2, 4]
    assert sorted(r["id"] for r in cleaning.best_label_join(df).collect()) == [2, 3, 4]


def test_multi_record_users_split(spark):
    df = spark.createDataFrame([(i, "one" if i == 0 else "many", "f") for i in range(50)], "id int, device_id string, feed_id string")
    for share_rows in (5, 1000):
        kept = cleaning.multi_record_users(df, salt_by=["id"], share_rows=share_rows)
        assert kept.count() == 49 and kept.select("device_id").distinct().count() == 1


def test_sampling(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(2000)], "id int, label int")
    first = cleaning.sample_negatives(df, 2, keys=["id"])
    again = cleaning.sample_negatives(df.repartition(7), 2, keys=["id"])
    assert sorted(first.collect()) == sorted(again.collect())
    counts = {r["label"]: r["count"] for r in first.groupBy("label").count().collect()}
    assert counts[1] == 200 and 320 < counts[0] < 480
    assert cleaning.sample_negatives(df, 100, keys=["id"]).count() == 2000
    random_counts = cleaning.sample_negatives(df, 2).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in random_counts}[1] == 200
    only_positive = df.where("label = 1")
    assert cleaning.sample_negatives(only_positive, 1, keys=["id"]).count() == 200


def test_splits_are_whole(spark):
    df = spark.range(1000)
    parts = cleaning.stable_split(df, [0.7, 0.2, 0.1], ["id"])
    ids = [r["id"] for p in parts for r in p.collect()]
    assert sorted(ids) == list(range(1000))
    assert sum(p.count() for p in cleaning.random_split(df, [0.7, 0.3])) == 1000


def test_item_family(spark):
    df = spark.createDataFrame([("123456",), ("9900000000123",), ("99",), ("-150",)], "i string")
    assert [r[0] for r in df.select(cleaning.item_family(F.col("i"))).collect()] == [1234, 99000000001, 0, -1]


def test_index_ids(spark):
    df = spark.createDataFrame([(f"u{i % 700}",) for i in range(2000)], "u string")
    rows = index_ids(df, "u", "i").collect()
    assert sorted(r["i"] for r in rows) == list(range(700))
    assert len({r["u"] for r in rows}) == 700


def vector_table(spark, n, width, seed):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, width))
    rows = [(f"v{i}", [float(x) for x in v]) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "id string, vec array<double>"), data


def test_top_n_over_many_blocks(spark):
    queries, q = vector_table(spark, 60, 5, 1)
    items, m = vector_table(spark, 90, 5, 2)
    items = items.unionByName(items.where("id = 'v3'").select(F.lit("v3b").alias("id"), "vec"))
    names = [f"v{i}" for i in range(90)] + ["v3b"]
    matrix = np.vstack([m, m[3]])
    found = collections.defaultdict(list)
    for r in similarity.top_n_by_dot(queries, items, 7, block_rows=13).collect():
        found[r["query_id"]].append((r["rank"], r["item_id"], r["score"]))
    for i in range(60):
        scores = matrix @ q[i]
        expected = sorted(range(91), key=lambda j: (-round(scores[j], 10), names[j]))[:7]
        got = sorted(found[f"v{i}"])
        assert [g[1] for g in got] == [names[j] for j in expected]
        assert [g[2] for g in got] == pytest.approx([scores[j] for j in expected])


def test_top_n_visits_few_pairs_of_skewed_lengths(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(3000, 6)) * np.exp(rng.normal(size=(3000, 1)) * 2)
    data[100:140] = 0.0
    data[500:700] = data[500] / np.linalg.norm(data[500]) * 1e-3
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, vec array<double>")
    asked = np.vstack([rng.normal(size=(300, 6)), np.zeros((2, 6))])
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "id long, vec array<double>")
    monkeypatch.setattr(similarity, "HEAD_ROWS", 100)
    monkeypatch.setattr(similarity, "PART_ROWS", 1000)
    units = similarity._units(queries.where("id < 300"), items, 10, False, 40)
    sizes = units.groupBy("block", "part").agg(F.count_if(F.col("kind") == 0).alias("q"), F.count_if(F.col("kind") == 1).alias("i")).collect()
    assert sum(r["q"] * r["i"] for r in sizes) + 300 * 200 < 0.2 * 300 * 3000
    for exclude in (False, True):
        found = collections.defaultdict(list)
        for r in similarity.top_n_by_dot(queries, items, 10, exclude, block_rows=40).collect():
            found[r["query_id"]].append((r["rank"], r["item_id"], r["score"]))
        for q in range(302):
            scores = data @ asked[q]
            order = sorted((i for i in range(3000) if not (exclude and i == q)), key=lambda i: (-scores[i], i))[:10]
            got = sorted(found[q])
            assert [g[2] for g in got] == pytest.approx([scores[i] for i in order], rel=1e-9, abs=1e-12)
            if len(set(np.round(scores[order], 12))) == 10 or q >= 300:
                assert [g[1] for g in got] == order
    few = similarity.top_n_by_dot(queries.where("id < 2"), items.where("id < 3"), 10).collect()
    assert len(few) == 6
    assert similarity.top_n_by_dot(queries.limit(0), items, 3).count() == similarity.top_n_by_dot(queries, items.limit(0), 3).count() == 0


def test_top_lists_of_factors_around_a_far_mean(spark, monkeypatch):
    rng = np.random.default_rng(9)
    data = rng.normal(size=(20000, 5)) * [1, 2, 0.1, 1, 0.5] + [9, 0, 3, 0, 0]
    data[100:103] = data[99]
    data[:, 4] = data[:, 0] * 2  # a direction without spread
    asked = rng.normal(size=(300, 5)) + [3, 0, 0, 0, 0]
    asked[0] = 0.0
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id int, vec array<double>")
    queries = spark.createDataFrame([(f"u{i}", v.tolist()) for i, v in enumerate(asked)], "id string, vec array<double>")
    monkeypatch.setattr(similarity, "HEAD_ROWS", 200)
    monkeypatch.setattr(similarity, "LIST_ROWS", 7)
    made, units = [], similarity._units
    monkeypatch.setattr(similarity, "_units", lambda *a: made.append(units(*a)) or made[-1])
    rows = similarity.top_lists_by_dot(queries, items, 10, block_rows=60).collect()
    assert sorted(r["query_id"] for r in rows) == sorted(f"u{i}" for i in range(300))
    for r in rows:
        scores = data @ asked[int(r["query_id"][1:])]
        order = np.lexsort((np.arange(len(data)), -np.round(scores, 9)))[:10]
        assert r["ids"] == order.tolist() and r["scores"] == pytest.approx(scores[order].tolist())
    sizes = made[0].where("block >= 0").groupBy("block", "part").agg(F.count_if(F.col("kind") == 0).alias("q"), F.count_if(F.col("kind") == 1).alias("i")).collect()
    assert 0 < sum(r["q"] * r["i"] for r in sizes) < 0.25 * 300 * 20000
    assert similarity.top_lists_by_dot(queries, items.limit(0), 3).count() == similarity.top_lists_by_dot(queries.limit(0), items, 3).count() == 0
    assert similarity.top_lists_by_dot(queries.limit(1), items.limit(2), 3).select(F.size("ids")).first()[0] == 2


def test_top_n_of_many_equal_vectors(spark):
    data = np.random.default_rng(3).normal(size=(40, 64))
    rows = [(f"v{k:02d}c{c:02d}", (data[k] / np.linalg.norm(data[k])).tolist()) for k in range(40) for c in range(30)]
    df = spark.createDataFrame(rows, "id string, vec array<double>")
    found = collections.defaultdict(list)
    for r in similarity.top_n_by_dot(df, df, 35, exclude_same_id=True, block_rows=37).collect():
        found[r["query_id"]].append((r["rank"], r["item_id"], r["score"]))
    for name, got in found.items():
        got = [g[1:] for g in sorted(got)]
        assert [i for i, _ in got[:29]] == sorted(f"{name[:3]}c{c:02d}" for c in range(30) if f"{name[:3]}c{c:02d}" != name)
        assert len({s for _, s in got[:29]}) == 1 and len({i[:3] for i, _ in got[29:]}) == 1 and got[29][0].endswith("c00")


def test_similar_items_leave_themselves_out(spark):
    df, data = vector_table(spark, 40, 4, 3)
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    scores = unit @ unit.T
    rows = similarity.similar_items(df, 5, block_rows=11).collect()
    assert len(rows) == 200
    for r in rows:
        i, j = int(r["query_id"][1:]), int(r["item_id"][1:])
        assert i != j
        order = [x for x in np.argsort(-scores[i]) if x != i]
        assert order[r["rank"] - 1] == j


def brute_history(rows, items, vectors, width, offset):
    def vec(feed, day):
        return vectors.get((feed, day), np.zeros(width))

    def unit(v):
        norm = np.linalg.norm(v)
        return v / norm if norm else v

    def day(text, n):
        return str((pd.Timestamp(text) + pd.Timedelta(days=n)).date())

    out = {}
    for event_id, device, feed, date in rows:
        past = [f for d, dt, f in items if d == device and dt == day(date, offset)]
        target = vec(feed, day(date, -1))
        sims = [float(unit(vec(f, day(date, -1))) @ unit(target)) for f in past]
        out[event_id] = sum(sims) / len(sims) if sims else 0.0
    return out


@pytest.mark.parametrize("offset", [-1, 1])
def test_history_similarity(spark, offset):
    rng = random.Random(9)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    rows = [(i, f"d{rng.randint(0, 3)}", f"f{rng.randint(0, 5)}", rng.choice(days)) for i in range(80)]
    items = [(f"d{rng.randint(0, 2)}", rng.choice(days), f"f{rng.randint(0, 6)}") for _ in range(60)]
    vectors = {
        (f"f{f}", str((pd.Timestamp(d) - pd.Timedelta(days=1)).date())): np.array([rng.gauss(0, 1) for _ in range(3)])
        for f in range(5)
        for d in days
        if rng.random() < 0.8
    }
    df = spark.createDataFrame(rows, "event_id int, device_id string, feed_id string, label_date string")
    history = spark.createDataFrame(items, "device_id string, dt string, feed_id string")
    table = spark.createDataFrame([(k[0], k[1], [float(x) for x in v]) for k, v in vectors.items()], "id string, dt string, vec array<double>")
    scored = similarity.add_history_similarity(df, history, table, 3, history_offset=offset, salt_by=["event_id"]).collect()
    expected = brute_history(rows, items, vectors, 3, offset)
    assert len(scored) == len(rows)
    for r in scored:
        assert r["history_sim"] == pytest.approx(expected[r["event_id"]], abs=1e-9)
        assert len(r["feed_vec"]) == 3


def test_cosine_examples(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 2.0]), ([1.0, 2.0], [2.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine_similarity(F.col("a"), F.col("b"))).collect()] == pytest.approx([1.0, 0.0, 0.8])


def slots(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_encodings(spark):
    ages = spark.createDataFrame([(8,), (0,), (1,), (2,), (4,)], "age int")
    age = F.col("age")
    assert slots(ages, encode.value_one_hot(age, ["0.0", "1.0", "2.0"])) == [[], [0], [1], [2], []]
    assert slots(ages, encode.value_one_hot(age, ["0.0", "1.0", "2.0"], mode="reference")) == [[]] * 5
    assert slots(ages, encode.value_one_hot(age, ["0", "4"], mode="reference")) == [[], [0], [], [], [0]]
    values = spark.createDataFrame([(-1.0,), (0.0,), (4.0,), (5.0,), (9.0,), (10.0,)], "v double")
    assert slots(values, encode.threshold_one_hot(F.col("v"), [0, 5, 10])) == [[], [0], [0], [1], [1], []]
    leaves = spark.createDataFrame([([3.0, 5.0],)], "l array<double>")
    assert slots(leaves, encode.leaf_one_hot(F.col("l"), 2)) == [[3, 13]]
    with pytest.raises(Exception, match="unknown label"):
        slots(ages, encode.label_one_hot(age, ["0", "1"]))


def test_sparse_vector(spark):
    df = spark.createDataFrame([([1, 4],), ([],)], "i array<int>")
    assert slots(df, sparse_vector(F.col("i"), 6)) == [Vectors.sparse(6, [1, 4], [1.0, 1.0]), Vectors.sparse(6, [], [])]


def test_split_columns(spark):
    df = spark.createDataFrame([("a,b",), ("c",)], "t string")
    split, names = encode.split_columns(df, "t", encode.max_parts(df, "t"))
    assert [tuple(r[n] for n in names) for r in split.collect()] == [("a", "b"), ("c", None)]


def test_score_functions(spark):
    df = spark.createDataFrame([(x / 4.0,) for x in range(-12, 13)], "x double")
    for r in df.select("x", gaussian_cdf(F.col("x")).alias("c"), sigmoid(F.col("x")).alias("s")).collect():
        assert r["c"] == pytest.approx(0.5 * (1 + math.erf(r["x"] / math.sqrt(2))), abs=1e-6)
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-r["x"])))
    flat = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 1.0)], "g string, x double")
    assert {r["x_norm"] for r in normalize_scores(flat, "x", ["g"]).collect()} == {0.5}


def scored_rows(n=500, seed=3, levels=60):
    rng = random.Random(seed)
    return [(round(rng.random() * levels) / levels, int(rng.random() < 0.4)) for _ in range(n)]


def test_areas_match_spark(spark):
    df = spark.createDataFrame([(float(s), float(t)) for s, t in scored_rows()], "score double, label double")
    found = binary_eval.areas(df).first()
    for metric, column in (("areaUnderROC", "auroc"), ("areaUnderPR", "aupr")):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0)
        assert found[column] == pytest.approx(evaluator.evaluate(df), abs=1e-9)


@pytest.mark.parametrize("range_rows", [1, 5, 100])
def test_score_table_any_ranges(spark, range_rows):
    rows = scored_rows(levels=37)
    df = spark.createDataFrame(rows, "score double, label int").repartition(3)
    expected, tp, fp = [], 0, 0
    for rank, score in enumerate(sorted({s for s, _ in rows}, reverse=True), 1):
        pos = sum(t for s, t in rows if s == score)
        tp, fp = tp + pos, fp + sum(1 for s, _ in rows if s == score) - pos
        expected.append((rank, score, tp, fp))
    table = binary_eval.score_table(df, "score", "label", range_rows).orderBy("rank").collect()
    assert [(r["rank"], r["score"], r["cum_pos"], r["cum_neg"]) for r in table] == expected


def test_curve_of_very_many_scores_has_ranges_from_the_data(spark):
    n = 1_000_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n / n).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    table = binary_eval.score_table(rows, "score", "label", 1000)
    bad = table.where((F.round((1 - F.col("score")) * n) != F.col("rank")) | (F.col("cum_pos") + F.col("cum_neg") != F.col("rank")))
    assert bad.count() == 0 and table.count() == n
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_range" in plan
    area = binary_eval.areas(rows, range_rows=1000).first()["auroc"]
    assert area == pytest.approx(binary_eval.areas(rows, range_rows=n).first()["auroc"], abs=1e-12) and abs(area - 0.5) < 0.01


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.3, 1), (0.5, 1)], "score double, label int")
    row = binary_eval.areas(df).first()
    assert row["auroc"] is None and row["aupr"] is None and row["positives"] == 2


def test_curve_and_report(spark):
    rows = [(0.9, 1), (0.8, 1), (0.7, 0), (0.3, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    curve = {r["threshold"]: r for r in binary_eval.threshold_curve(df, bins=0).collect()}
    assert curve[0.8]["precision"] == 1.0 and curve[0.8]["recall"] == pytest.approx(2 / 3)
    assert curve[0.3]["f1"] == pytest.approx(6 / 7)
    assert tuple(binary_eval.best_threshold(df).first()) == pytest.approx((6 / 7, 0.3))
    binned = binary_eval.threshold_curve(df, bins=2).orderBy("point").collect()
    assert [r["threshold"] for r in binned] == [0.8, 0.3, 0.1]
    report = binary_eval.classification_report(binary_eval.with_prediction(df, "score")).first()
    assert report["accuracy"] == pytest.approx(0.6) and report["rows"] == 5
    assert binary_eval.error_rate(binary_eval.with_prediction(df, "score")).first()["error"] == pytest.approx(0.4)


LISTS = "prediction array<int>, label array<int>"


def metrics_of(spark, prediction, label, **options):
    df = spark.createDataFrame([(prediction, label)], LISTS)
    return ranking_eval.ranking_metrics(df, **options).first()


def test_ranking_examples(spark):
    row = metrics_of(spark, [1, 2], [2, 3], k=5, n_items=10)
    assert row["mrr"] == 0.5 and row["fcp"] == 0.0 and row["map"] == 0.25
    assert row["precisionAtk"] == pytest.approx(0.2) and row["ndcgAt"] == pytest.approx(0.38685, abs=1e-5)
    assert row["diversityAtK"] == 0.2 and row["maxDiversity"] == pytest.approx(0.3)
    assert metrics_of(spark, [1, 2], [2, 3, 4])["recallAtK"] == 0.5
    assert metrics_of(spark, [1, 2], [2, 3, 4])["trueRecallAtK"] == pytest.approx(1 / 3)
    empty = metrics_of(spark, [], [1])
    assert empty["recallAtK"] is None and empty["fcp"] is None and empty["map"] == 0.0
    nothing = metrics_of(spark, [1], [])
    assert nothing["ndcgAt"] == nothing["precisionAtk"] == nothing["mrr"] == 0.0


def test_ranking_matches_spark_metrics(spark):
    from pyspark.ml.evaluation import RankingEvaluator

    rng = random.Random(4)
    rows = [
        ([float(x) for x in rng.sample(range(20), rng.randint(0, 12))], [float(x) for x in rng.sample(range(20), rng.randint(0, 8))])
        for _ in range(60)
    ]
    df = spark.createDataFrame(rows, "prediction array<double>, label array<double>")
    found = ranking_eval.ranking_metrics(df, k=5).first()
    for ours, theirs in (("map", "meanAveragePrecision"), ("ndcgAt", "ndcgAtK"), ("precisionAtk", "precisionAtK")):
        assert found[ours] == pytest.approx(RankingEvaluator(metricName=theirs, k=5).evaluate(df), abs=1e-12)


def test_ranking_evaluator_class(spark, tmp_path):
    df = spark.createDataFrame([([1, 2], [2, 3])], LISTS)
    evaluator = ranking_eval.RankingMetricsEvaluator(metricName="mrr")
    assert evaluator.evaluate(df) == 0.5
    assert evaluator.setMetricName("precisionAtk").setTopK(2).evaluate(df) == 0.5
    with pytest.raises(ValueError):
        ranking_eval.RankingMetricsEvaluator(metricName="diversityAtK").evaluate(df)
    with pytest.raises(ValueError):
        ranking_eval.RankingMetricsEvaluator(metricName="mapk").evaluate(df)
    evaluator.save(str(tmp_path / "e"))
    assert ranking_eval.RankingMetricsEvaluator.load(str(tmp_path / "e")).evaluate(df) == 0.5


def test_missing_rates(spark):
    df = spark.createDataFrame([("", 1.0, 1), (None, float("nan"), 1), ("x", None, 0), ("y", 2.0, 0)], "t string, v double, label int")
    rates = {r["column"]: (r["positive_rate"], r["negative_rate"]) for r in profile.missing_rates(df).collect()}
    assert rates == {"t": (1.0, 0.0), "v": (0.5, 0.5), "label": (0.0, 0.0)}


def test_collision_report(spark):
    df = spark.createDataFrame([("bat,mouse",), ("horse,bat",)], "tags string")
    total = {a: sum(r["tags"] for r in profile.hash_collisions(df, "tags", a).collect()) for a in ("tag", "hash32", "hash64")}
    assert total == {"tag": 3, "hash32": 3, "hash64": 3}
    exact = spark.createDataFrame([("bat00,mouse00,horse00,体育00",)], "tags string")
    buckets = [r["bucket"] for r in profile.hash_collisions(exact, "tags", "hash64", mode="reference").collect()]
    assert sorted(buckets) == [101, 201, 231, 255]
    sane = [r["bucket"] for r in profile.hash_collisions(df, "tags", "hash64").collect()]
    assert all(0 <= b < 300 for b in sane)


def test_duplicates_by_hash(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("a",)], "t string")
    assert sorted(r["copies"] for r in profile.duplicate_groups(df, "t").collect()) == [1, 3]


def test_plans_read_needed_columns_only(spark):
    from rankweave.plans import views

    df = cleaning.active_users(views.interactions(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    sequences_plan = sequences.user_sequences(views.interactions(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "event_type" in sequences_plan and "value" not in sequences_plan.split("ReadSchema")[1].split("\n")[0]


def test_building_a_join_starts_no_job(spark):
    rows = spark.range(10).selectExpr("id", "CAST(id % 3 AS STRING) AS device_id", "CAST(id AS STRING) AS feed_id", "1 AS label", "'2024-01-02' AS label_date")
    vectors = spark.range(3).selectExpr("CAST(id AS STRING) AS id", "'2024-01-01' AS dt", "array(1.0D, 2.0D) AS vec")
    items = rows.select("device_id", rows.label_date.alias("dt"), "feed_id")
    spark.sparkContext.setJobGroup("building", "")
    try:
        cleaning.multi_record_users(rows)
        cleaning.best_label_of_repeat_users(rows)
        similarity.previous_day_vectors(rows, vectors, "feed_id", 2, "v")
        similarity.add_history_similarity(rows, items, vectors, 2)
        similarity.top_n_by_dot(vectors.select("id", "vec"), vectors.select("id", "vec"), 2)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_wide_products(spark):
    from pyspark.ml.feature import Interaction, VectorAssembler
    from pyspark.ml.linalg import Vectors

    from rankweave.models.feature_stages import FeatureSet
    from rankweave.models.stages import ColumnProduct

    data = [(1, Vectors.sparse(3, [0, 2], [2.0, 0.0]), Vectors.dense([0.0, 3.0]), 2.0), (2, Vectors.dense([1.0, 0.0, -1.0]), Vectors.dense([1.0, 2.0]), 0.0), (3, Vectors.sparse(3, [], []), Vectors.dense([1.0, 2.0]), 5.0)]
    rows = spark.createDataFrame(data, ["id", "a", "b", "n"])
    ours = ColumnProduct(inputCols=["a", "b", "n"], widths=[3, 2, 0], outputCol="p").transform(rows)
    listed = VectorAssembler(inputCols=["n"], outputCol="n_vec").transform(rows)
    for name, size in (("a", 3), ("b", 2)):
        slots = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": str(i)} for i in range(size)]}, "num_attrs": size}}
        listed = listed.withColumn(name, F.col(name).alias(name, metadata=slots))
    spark_own = Interaction(inputCols=["a", "b", "n_vec"], outputCol="p").transform(listed)
    want = {r["id"]: r["p"].toArray().tolist() for r in spark_own.collect()}
    assert {r["id"]: r["p"].toArray().tolist() for r in ours.collect()} == want
    with pytest.raises(ValueError):
        ColumnProduct(inputCols=["a", "b"], outputCol="p").transform(rows)
    with pytest.raises(ValueError):
        ColumnProduct(inputCols=["a", "b"], widths=[100_000, 100_000], outputCol="p").transform(rows)

    tags = spark.createDataFrame([(1, "x,y", 1, 0.5, 3.0), (2, "x", 9, 2.5, float("nan"))], "id int, tags string, kind int, ctr double, age double")
    wide = FeatureSet(tags={"tags": 50_000}, one_hot={"kind": ["1", "2"]}, numbers=["ctr"], buckets={"age": [2.0]}, products={"p": ["tags", "kind", "ctr"], "q": ["tags", "age"]})
    for stage in wide.stages():
        tags = stage.transform(tags)
    got = {r["id"]: r for r in tags.collect()}
    assert got[1]["p_vec"].size == 100_000 and sorted(got[1]["p_vec"].values) == [0.5, 0.5]
    assert [i // 2 for i in got[1]["p_vec"].indices] == list(got[1]["tags_vec"].indices)
    assert [i - 1 for i in got[1]["q_vec"].indices] == [2 * i for i in got[1]["tags_vec"].indices]
    assert len(got[2]["p_vec"].indices) == len(got[2]["q_vec"].indices) == 0
    assert got[1]["features"].size == 50_000 + 2 + 1 + 1 + 100_000 + 100_000


def test_names_of_lists(spark, monkeypatch):
    from rankweave.operators import naming

    monkeypatch.setattr(naming, "BLOCK_IDS", 7)
    monkeypatch.setattr(naming, "CHUNK_LISTS", 3)
    monkeypatch.setattr(naming, "SHARE_CHUNKS", 4)
    rng = random.Random(8)
    names = {i: f"name {i}" for i in range(60) if i % 9}
    lists = [(f"u{k}", [rng.choice([1, 1, 1, rng.randrange(60), None, 10**12, -5]) for _ in range(rng.randrange(6))], [k]) for k in range(100)]
    lists += [("none", None, None), (None, [1, 2], [])]
    df = spark.createDataFrame(lists, "device string, ids array<long>, extra array<int>").repartition(5)
    known = spark.createDataFrame([*names.items(), (1, "name 1"), (1, "z"), (None, "nobody")], "id long, name string")
    got = sorted(map(repr, (tuple(r) for r in naming.name_lists(df, known, "device").collect())))
    assert got == sorted(repr((d, i, e, None if i is None else [names.get(x) for x in i])) for d, i, e in lists)
    plan = naming.name_lists(df, known, "device")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert naming.name_lists(df.limit(0), known, "device").count() == 0
    assert naming.name_lists(df, known.limit(0), "device").where("size(filter(names, n -> n is not null)) > 0").count() == 0
