"""Null groups, keys, items and weights, and settings that must not change a result."""

import math

import pytest
from pyspark.sql import functions as F

from rankweave.functions.scores import normalize_scores
from rankweave.functions.tag_hash import weighted_tag_hash
from rankweave.functions.tags import tag_map
from rankweave.operators import joins, sequences
from rankweave.operators.binary_eval import classification_report
from rankweave.operators.ranking_eval import list_metrics

LOG = "device_id string, feed_id string, ts timestamp, event_id long, label int"


@pytest.fixture(scope="module")
def log(spark):
    rows = [("u", f"i{k}", None if k % 3 == 0 else f"2024-01-01 00:{k:02d}:00", k, 1) for k in range(10)]
    rows += [(None, f"n{k}", f"2024-01-01 00:{k:02d}:00", 100 + k, 1) for k in range(6)]
    return spark.createDataFrame(rows, "device_id string, feed_id string, ts string, event_id long, label int").withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("part_size", [1, 2, 3, 100])
def test_sequences_do_not_depend_on_the_part_size(log, part_size):
    lists = sequences.positive_lists(log, part_size=part_size)
    rows = sequences.sequence_items(lists, ["device_id"], "label", part_size).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.position):
        got.setdefault(r.device_id, []).append((r.position, r.item))
    dated = [f"i{k}" for k in range(10) if k % 3 == 0] + [f"i{k}" for k in range(10) if k % 3]
    assert got == {"u": list(enumerate(dated)), None: [(k, f"n{k}") for k in range(6)]}


def test_positions_keep_all_rows(log):
    placed = sequences.ordered_positions(log, ["device_id"], ["ts", "event_id"], F.date_trunc("minute", "ts")).collect()
    assert sorted(r._position for r in placed if r.device_id == "u") == list(range(10))
    assert sorted(r._position for r in placed if r.device_id is None) == list(range(6))


def test_report_of_a_null_group_and_null_labels(spark):
    rows = [(None, 1, 1.0), (None, 0, 0.0), ("a", 1, 0.0), ("a", 1, 1.0), ("b", None, 1.0), ("b", 1, 1.0)]
    df = spark.createDataFrame(rows, "g string, label int, prediction double")
    got = {r.g: (r.rows, r.accuracy, r.weighted_f1) for r in classification_report(df, groups=["g"]).collect()}
    assert got[None] == (2, 1.0, 1.0)
    assert got["a"][:2] == (2, 0.5) and math.isclose(got["a"][2], 2 / 3)
    assert got["b"][:2] == (2, 0.5) and math.isclose(got["b"][2], 0.5 * 2 / 3)
    words = spark.createDataFrame([("x", "x"), ("y", "x")], "label string, prediction string")
    assert classification_report(words).first().accuracy == 0.5


def test_list_metrics_with_null_items(spark):
    rows = [(["a", None, "b"], ["a", None]), (["a", "c", "b"], ["a"])]
    first, second = list_metrics(spark.createDataFrame(rows, "prediction array<string>, label array<string>"), 2).collect()
    for name in ("map", "ndcgAt", "precisionAtk", "recallAtK", "trueRecallAtK", "mrr"):
        assert first[name] == second[name]


def test_unreadable_weights_are_left_out(spark):
    df = spark.createDataFrame([("{a:x,b:2}",), ("{b:2}",)], "t string")
    weights = [r.w for r in df.select(weighted_tag_hash(tag_map(F.col("t")), 50).alias("w")).collect()]
    assert weights[0] == weights[1] and weights[0][0].weight == 2.0


def test_scores_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, s double")
    got = sorted((r.g is None, round(r.s_norm, 3)) for r in normalize_scores(df, "s", ["g"], "sigmoid").collect())
    assert got == [(False, 0.5), (True, 0.33), (True, 0.67)]


def test_every_hot_key_is_split(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_HOT_KEYS", 2)
    left = spark.createDataFrame([(k % 5, k) for k in range(100)], "k int, v int")
    assert joins.hot_keys(joins.key_counts(left, ["k"]), ["k"], 10).count() == 5
    right = spark.createDataFrame([(k, str(k)) for k in range(5)], "k int, name string")
    joined = joins.skew_safe_join(left, right, ["k"], share_rows=10, counts=joins.key_counts(left, ["k"])).collect()
    assert len(joined) == 100 and all(r.name == str(r.k) for r in joined)
