"""Scans, sinks and saved models on files written to a temporary folder."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors

from rankweave.functions.dates import eval_days, train_days, vector_days
from rankweave.models import trees
from rankweave.models.fm import FMModel
from rankweave.models.stages import KeyValueExtractor, LeafOneHot, TagHasher, TagUnionHasher, ThresholdOneHot, ValueOneHot
from rankweave.sources import logs, model_store, schemas, vectors

DAYS = ["2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11", "2024-01-12"]


def log_rows(day, n):
    names = schemas.FEATURE_LOG.names
    for i in range(n):
        row = dict.fromkeys(names, "")
        row.update(device_id=f"d{i % 3}", feed_id=str(1234500 + i), label=str(i % 2), label_date=day, timestamp=str(i), ctr_7="0.5", has_title="true")
        yield "\t".join(row[n] for n in names)


@pytest.fixture(scope="module")
def log_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("logs")
    for i, day in enumerate(DAYS):
        (root / "daily" / f"dt={day}").mkdir(parents=True)
        (root / "daily" / f"dt={day}" / "log.txt").write_text("\n".join(log_rows(day, 4 + i)) + "\n")
        (root / "hourly" / day / "05").mkdir(parents=True)
        lines = list(log_rows(day, 4))
        (root / "hourly" / day / "05" / "part-0").write_text("\n".join(lines) + "\n")
        (root / "hourly" / day / "05" / "part-1").write_text(lines[0].replace("\t0\t" + day, "\t1\t" + day) + "\n")
    return root


def dates(df):
    return sorted({r[0] for r in df.select("label_date").distinct().collect()})


def test_schema():
    kinds = [f.dataType.simpleString() for f in schemas.FEATURE_LOG.fields]
    assert len(kinds) == 46
    assert {k: kinds.count(k) for k in set(kinds)} == {"string": 30, "int": 12, "double": 3, "boolean": 1}


def test_day_ranges():
    assert train_days("2024-03-01", 1) == ["2024-03-01", "2024-02-29"]
    assert eval_days("2023-12-31", 1) == ["2024-01-01", "2024-01-02"]
    assert vector_days("2024-01-10", 1, "train") == ["2024-01-09", "2024-01-08"]
    assert vector_days("2024-01-10", 1, "eval") == ["2024-01-09", "2024-01-10"]


def test_dated_scans(spark, log_root):
    root = str(log_root / "daily")
    train = logs.training_log(spark, root, "2024-01-10", 2)
    assert dates(train) == DAYS[:3] and train.count() == 4 + 5 + 6
    assert dates(logs.evaluation_log(spark, root, "2024-01-10", 1, file_name="log.txt")) == DAYS[3:]
    prepared = logs.prepare_log(train, rate=1, only_active=True, keys=["device_id", "feed_id"])
    assert {r[0] for r in prepared.select("income").distinct().collect()} == {"null:0.0"}
    assert {r[0] for r in prepared.select("age").distinct().collect()} == {0}
    labels = logs.read_labels(spark, root, "2024-01-11")
    assert labels.columns == ["device_id", "feed_id", "label"]
    assert {r["feed_id"] for r in labels.collect()} == {12345}


def test_realtime_scan_keeps_best_label(spark, log_root):
    rows = logs.realtime_log(spark, str(log_root / "hourly"), "2024-01-09", 1, "train")
    assert dates(rows) == DAYS[:2] and rows.count() == 8
    first = rows.where("feed_id = '1234500'").select("label").distinct().collect()
    assert [r[0] for r in first] == [1]
    assert dates(logs.realtime_log(spark, str(log_root / "hourly"), "2024-01-11", 1, "eval")) == DAYS[3:]


def test_literal_rows(spark):
    row = logs.evaluation_rows(spark, "rows", rows=[{"device_id": "a", "label": 0}]).first()
    assert row["device_id"] == "a" and row["label"] == 0 and row["age"] is None


def test_ratings(spark, tmp_path):
    (tmp_path / "part-r-0").write_text("a::123456::3.5\nb::9900000000123::12\n")
    rows = logs.read_ratings(spark, str(tmp_path / "part-r-*")).orderBy("device_id").collect()
    assert [tuple(r) for r in rows] == [("a", 1234, 3.5), ("b", 99000000001, 10.0)]


def test_libsvm(spark, tmp_path):
    (tmp_path / "d.txt").write_text("1 1:0.5 3:2\n0 2:1\n")
    df = logs.read_libsvm(spark, str(tmp_path / "d.txt"), 3)
    assert sorted(r["label"] for r in df.collect()) == [0.0, 1.0]


def test_vectors_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("i1", [0.5, -1.0]), ("i2", [0.0, 2.0])], "id string, vec array<double>")
    for day in ("2024-01-09", "2024-01-10"):
        vectors.write_vectors(df, str(tmp_path / f"wordvec_{day.replace('-', '_')}.txt"), day)
    rows = vectors.read_daily_vectors(spark, str(tmp_path), "2024-01-10", 1, "eval").collect()
    assert {(r["id"], r["dt"], tuple(r["vec"])) for r in rows} == {
        (i, d, v) for i, v in (("i1", (0.5, -1.0)), ("i2", (0.0, 2.0))) for d in ("2024-01-09", "2024-01-10")
    }


def test_similar_file(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 1), ("a", "c", 2), ("b", "a", 1)], "query_id string, item_id string, rank int")
    vectors.write_similar(df, str(tmp_path / "sim"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "sim")).collect()) == ["a b,c", "b a"]


def test_sequence_and_history_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("d1", ["x", "y"], "2024-01-09"), ("d2", ["z"], "2024-01-10")], "device_id string, feeds array<string>, dt string"
    )
    vectors.write_sequences(df, "feeds", str(tmp_path / "seq"), single_file=True)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "seq")).collect()) == ["x y", "z"]
    vectors.write_history(df, str(tmp_path / "hist"))
    rows = vectors.read_history(spark, str(tmp_path / "hist"), "2024-01-10", 1, "eval").collect()
    assert {tuple(r[c] for c in ("device_id", "feeds", "dt")) for r in rows} == {
        ("d1", "x y", "2024-01-09"),
        ("d2", "z", "2024-01-10"),
    }


def test_feature_pipeline_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([("bat:1,mouse", "horse", "4:0.5", 7.0), ("null:0.0", "", "x", 99.0)], "a string, b string, kv string, n double")
    stages = [
        TagHasher(inputCol="a", outputCol="a_vec", dim=10),
        TagUnionHasher(inputCols=["a", "b"], outputCol="ab_vec", dim=20, topKs=[5, 5], filters=[True, False], seed=54321),
        KeyValueExtractor(inputCol="kv", outputCol="key"),
        ValueOneHot(inputCol="key", outputCol="key_vec", values=["1", "4"]),
        ThresholdOneHot(inputCol="n", outputCol="n_vec", thresholds=[0, 5, 10]),
        VectorAssembler(inputCols=["a_vec", "ab_vec", "key_vec", "n_vec"], outputCol="features"),
    ]
    model = Pipeline(stages=stages).fit(df)
    model_store.save_pipeline(model, str(tmp_path / "p"))
    again, last = model_store.load_pipeline(str(tmp_path / "p"))
    assert last.getOutputCol() == "features"
    expected = [r["features"] for r in model.transform(df).collect()]
    assert [r["features"] for r in again.transform(df).collect()] == expected
    assert expected[0].size == 34 and set(expected[0].indices[:2]) == {4, 7}
    assert list(expected[0].indices[-2:]) == [31, 33]
    assert model_store.score_pipeline(df, str(tmp_path / "p")).count() == 2


def test_stage_checks(spark):
    df = spark.createDataFrame([("a", 1)], "a string, n int")
    with pytest.raises(ValueError, match="do not exist"):
        TagHasher(inputCol="zz", outputCol="o").transform(df)
    with pytest.raises(ValueError, match="already exists"):
        TagHasher(inputCol="a", outputCol="n").transform(df)
    with pytest.raises(TypeError):
        TagHasher(inputCol="n", outputCol="o").transform(df)


def test_leaf_stack_save_and_score(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    df = spark.createDataFrame([(Vectors.dense(v), int(v[0] * v[1] > 0)) for v in x], ["features", "label"])
    model = trees.fit_leaf_lr(df, rounds=4, depth=3, reg=0.01)
    model_store.save_pipeline(model, str(tmp_path / "stack"))
    scored = model_store.score_pipeline(df, str(tmp_path / "stack"))
    width = 4 * 2**4
    rows = scored.select("leaf_vec", "prediction", "label").collect()
    for r in rows:
        assert r["leaf_vec"].size == width
        assert sorted(int(i) // 16 for i in r["leaf_vec"].indices) == [0, 1, 2, 3]
    assert sum(r["prediction"] == r["label"] for r in rows) > 240


def test_leaf_example(spark):
    df = spark.createDataFrame([([3.0, 5.0],)], "leaf array<double>")
    vec = LeafOneHot(inputCol="leaf", outputCol="v", trees=2, depth=2).transform(df).first()["v"]
    assert vec.size == 16 and list(vec.indices) == [3, 13]


def test_fm_batch_scoring(spark, tmp_path):
    FMModel(1.0, np.array([1.0, 2.0]), np.array([[1.0], [3.0]]), "regression").save(spark, str(tmp_path / "fm"))
    df = spark.createDataFrame([(Vectors.dense([1.0, 1.0]),)], ["features"])
    assert model_store.score_fm(spark, df, str(tmp_path / "fm"), link=False).first()["score"] == 7.0


def test_report_and_schema_json(spark, tmp_path):
    df = spark.createDataFrame([("{}", 0.5)], "setting string, weighted_f1 double")
    model_store.write_report(df, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 1
    assert '"weighted_f1"' in schemas.schema_json(df)


def test_workers_do_not_have_the_package(spark):
    """Every other test of this session runs with such workers, so none of the queries needs it there."""

    def look(batches):
        import importlib.util

        import pyarrow as pa

        for _ in batches:
            yield pa.record_batch([pa.array([importlib.util.find_spec(name) is not None for name in ("rankweave", "tests", "corpus_pipeline")])], names=["found"])

    assert [r.found for r in spark.range(1, numPartitions=1).mapInArrow(look, "found boolean").collect()] == [False] * 3
