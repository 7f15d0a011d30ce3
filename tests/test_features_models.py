from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starlens.operators import evaluation, features, models
from starlens.sources import writers

SCHEMA = """review_id STRING, parent_asin STRING, label INT, helpful_vote INT, price DECIMAL(12,2),
    average_rating DOUBLE, rating_number INT, review_year INT, review_month INT,
    verified_purchase BOOLEAN, main_category STRING, store STRING"""


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (str(i), "p", (1, 2, 3, 5)[i % 4], i % 3, None, 4.5, 10, 2020, 1 + i % 12, i % 2 == 0,
         ("A", "B", None)[i % 3], f"s{i % 5}")
        for i in range(120)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def dataset(table):
    data, names = features.build_dataset(table, store_top_k=3)
    return data.cache(), names.cache()


@pytest.fixture(scope="module")
def data(dataset):
    return dataset[0]


@pytest.fixture(scope="module")
def names(dataset):
    return dataset[1]


def test_contract(table):
    assert features.check_contract(table) is table
    with pytest.raises(ValueError, match="store"):
        features.check_contract(table.drop("store"))
    with pytest.raises(ValueError, match="numeric: price"):
        features.check_contract(table.withColumn("price", F.lit("1")))


def test_top_k_ties_by_name(spark):
    df = spark.createDataFrame([(c,) for c in "bbaaccd"], "c STRING")
    got = {r["c"]: r["o"] for r in features.bucket_top_k(df, "c", 2, out="o").collect()}
    assert got == {"a": "a", "b": "b", "c": "other", "d": "other"}
    with pytest.raises(ValueError):
        features.bucket_top_k(df, "c", 0)


def test_text_labels_are_indexed(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "kind STRING")
    got = sorted((r["kind"], r["label"]) for r in features.index_label(df, "kind").collect())
    assert got == [("x", 1.0), ("y", 0.0), ("y", 0.0)]


def test_names_cover_every_slot(data, names):
    first = data.first()
    for col in ("features", "features_nb"):
        held = {r["idx"]: r["name"] for r in names.where(F.col("vector") == col).collect()}
        assert sorted(held) == list(range(first[col].size)) == list(range(features.vector_dimension(data, col)))
    assert held[0] == "verified_purchase_num"
    assert {"main_category=unknown", "main_category=__unknown", "store=other"} <= set(held.values())


def test_dictionary_over_many_ranges(spark):
    """Frequencies that tie over the borders of ranges; values fill all of them."""
    rows = [(f"v{i:04d}",) for i in range(1500) for _ in range(1 + i % 3)] + [(None,)] * 50
    df = spark.createDataFrame(rows, "c STRING").repartition(5)
    got = {r["value"]: r["index"] for r in features.dictionary(df, "c").collect()}
    ordered = sorted({v for (v,) in rows if v}, key=lambda v: (-(1 + int(v[1:]) % 3), v))
    assert got == {v: i for i, v in enumerate(ordered)}
    assert features.dictionary(df.limit(0), "c").count() == 0


def test_unseen_values_have_the_last_slot(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c STRING")
    encoding = features.fit_encoding(seen, ("c",))
    late = encoding.apply(spark.createDataFrame([("a",), ("z",), (None,), ("b",)], "c STRING")).collect()
    assert {r["c"]: (r["c_idx"], list(r["c_ohe"])) for r in late} == {
        "b": (0.0, [1, 0, 0]), "a": (1.0, [0, 1, 0]), "z": (2.0, [0, 0, 1]), None: (2.0, [0, 0, 1]),
    }


def test_no_list_of_values_reaches_the_driver(table):
    """The plan of an encoded frame names no value; only sizes are literals."""
    encoded, _ = features.index_and_encode(features.clean_categories(features.index_label(table)), ("store_clean",))
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "s1" not in plan and "s4" not in plan and "Join" in plan
    assert "vals" not in str(encoded.schema["store_clean_idx"].metadata)


def test_sanitize(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, Vectors.dense([nan, -1.0, inf, 2.0])), (1, Vectors.sparse(6, [1, 4], [3.0, 7.0])), (2, None)]
    schema = StructType([StructField("i", IntegerType()), StructField("features", VectorUDT())])
    got = features.sanitize(spark.createDataFrame(rows, schema), 5).orderBy("i").collect()
    assert [list(r["features"]) for r in got] == [[0, 0, 0, 2, 0], [0, 3, 0, 0, 7], [0] * 5]


def test_sparse_vectors_survive_storage(spark, tmp_path):
    df = spark.createDataFrame(
        [(Vectors.sparse(6, [1, 4], [3.0, 7.0]), 1), (Vectors.dense([1.0, 2.0]), 2)], ["features", "label"]
    )
    writers.write_parquet(df, str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert features.vector_dimension(stored) == 6
    df.write.json(str(tmp_path / "j"))
    for back in (stored, features.normalize_vectors(spark.read.json(str(tmp_path / "j")))):
        got = {r["label"]: list(r["features"]) for r in back.collect()}
        assert got == {1: [0, 3, 0, 0, 7, 0], 2: [1, 2]}


def test_array_features_become_vectors(spark):
    df = spark.createDataFrame([([1, 2], 3)], "features ARRAY<INT>, label INT")
    row = features.normalize_vectors(df).first()
    assert list(row["features"]) == [1.0, 2.0] and row["label"] == 3.0
    with pytest.raises(ValueError):
        features.normalize_vectors(df.drop("label"))


def test_split_folders(spark, tmp_path, data):
    split = features.with_split(data).select("review_id", "features", "split")
    writers.write_split(split, str(tmp_path / "s"))
    sizes = [writers.read_split(spark, str(tmp_path / "s"), part).count() for part in ("train", "test")]
    train, test = features.key_split(data)
    assert sizes == [train.count(), test.count()] and sum(sizes) == 120


def test_naive_bayes_predicts_label_values(data):
    train, test = features.key_split(data)
    model = models.nb_estimator().fit(train)
    labels = models.class_labels(train)
    assert labels == [1.0, 2.0, 3.0, 5.0]
    raw = {r["prediction"] for r in model.transform(test).select("prediction").distinct().collect()}
    got = {r["prediction"] for r in models.predict_classes(model, test, labels).select("prediction").distinct().collect()}
    assert got == {labels[int(i)] for i in raw}


def test_naive_bayes_tables(spark, data, names):
    train, _ = features.key_split(data)
    model = models.nb_estimator().fit(train).stages[-1]
    labels = models.class_labels(train)
    theta = models.nb_theta(model, names, labels)
    assert theta.count() == names.where("vector = 'features_nb'").count() * len(labels)
    total = theta.groupBy("label_value").agg(F.sum(F.exp("log_conditional_probability")).alias("p"))
    assert all(r["p"] == pytest.approx(1) for r in total.collect())
    probs = evaluation.prior_probs(models.nb_priors(spark, model, labels))
    assert probs.agg(F.sum("prior")).first()[0] == pytest.approx(1)


def test_cross_validated_forest(spark, data, names):
    train, test = features.key_split(data)
    rf = models.rf_estimator()
    assert len(models.rf_grid(rf)) == 4 and len(models.nb_grid(models.nb_estimator())) == 4
    best = models.cross_validate(rf, models.rf_grid(rf, (2,), (2,)), train, folds=2).bestModel
    table = models.rf_importance(best, names)
    got = table.orderBy("rank").collect()
    values = [r["importance"] for r in got]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
    assert evaluation.top_importance(table, 3).count() == 3
    assert models.predict(best, test).columns == ["label", "prediction"]


def test_forests_split_common_flags_by_thresholds(data):
    """The same forest as with sets of categories, and flags that no row has are still known as flags."""
    kept = data.select("features", "label").repartition(4).cache()
    plain = models.numeric_flags(kept)
    before, after = (df.schema["features"].metadata["ml_attr"] for df in (kept, plain))
    assert after["num_attrs"] == before["num_attrs"]
    slots = [{a["idx"]: a.get("name") for kind in found["attrs"].values() for a in kind} for found in (before, after)]
    assert slots[0] == slots[1]
    ones = [sum(column) for column in zip(*(r["features"] for r in kept.collect()), strict=True)]
    flags = {a["idx"] for a in before["attrs"]["binary"]}
    assert {a["idx"] for a in after["attrs"]["binary"]} == {i for i in flags if ones[i] in (0, 120)} != set()
    rf = models.rf_estimator().setNumTrees(5).setMaxDepth(6)
    forests = [rf.fit(df) for df in (kept, plain)]
    assert forests[0].featureImportances == forests[1].featureImportances
    guesses = [[(r["label"], r["probability"]) for r in f.transform(kept).collect()] for f in forests]
    assert guesses[0] == guesses[1]
    assert " in {" in forests[0].toDebugString and " in {" not in forests[1].toDebugString
    bare = kept.select("label", F.col("features").alias("features", metadata={}))
    assert models.numeric_flags(bare) is bare


def test_forests_without_binary_slots(data):
    """Flags that are the same in all rows may be numbers as well: the forest is the same."""
    kept = data.select("features", "label").repartition(4).cache()
    plain = models.numeric_flags(kept, constant=True)
    assert "binary" not in plain.schema["features"].metadata["ml_attr"]["attrs"]
    rf = models.rf_estimator().setNumTrees(5).setMaxDepth(6)
    forests = [rf.fit(df) for df in (kept, plain)]
    assert forests[0].featureImportances == forests[1].featureImportances
    guesses = [[(r["label"], r["probability"]) for r in f.transform(kept).collect()] for f in forests]
    assert guesses[0] == guesses[1]


def test_naive_bayes_from_counted_rows(spark, data):
    """Equal vectors of a label are one row with a weight, and the model is the same."""
    train = data.select("label", "features_nb").unionByName(data.select("label", "features_nb").where("label = 2"))
    counted = models.counted_rows(train)
    assert counted.count() < train.count() == counted.agg(F.sum("n")).first()[0]
    plain = models.nb_estimator().fit(train)
    weighed = models.nb_estimator(weight="n").fit(counted)
    assert weighed.stages[-1].theta.toArray() == pytest.approx(plain.stages[-1].theta.toArray(), abs=1e-12)
    assert weighed.stages[-1].pi.toArray() == pytest.approx(plain.stages[-1].pi.toArray(), abs=1e-12)
    assert weighed.stages[0].originalMin == plain.stages[0].originalMin
    labels = models.class_labels(counted)
    guesses = [sorted(models.predict_classes(m, data, labels).collect()) for m in (plain, weighed)]
    assert guesses[0] == guesses[1]


@pytest.fixture(scope="module")
def predictions(spark):
    pairs = [(1, 1), (1, 2), (2, 2), (2, 2), (3, 1), (4, 4), (4, 2), (4, 4)]
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], ["label", "prediction"])


def test_scores_equal_spark_evaluator(predictions):
    row = evaluation.evaluation_row(predictions, "m", "t").first()
    for ours, theirs in {
        "f1": "f1", "accuracy": "accuracy", "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }.items():
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(predictions)
        assert row[ours] == pytest.approx(value, abs=1e-12)


def test_confusion(predictions):
    table = evaluation.confusion(predictions)
    assert table.count() == 25 and evaluation.confusion_pairs(table).count() == 6
    shares = evaluation.confusion_normalized(table)
    got = {(r["actual"], r["predicted"]): r["share"] for r in shares.collect()}
    assert got[4, 4] == 0.666667 and got[1, 2] == 0.5
    assert all(got[5, p] == 0 for p in range(1, 6))


def test_majority_baseline(spark):
    train = spark.createDataFrame([(3,), (3,), (2,), (2,), (5,), (None,)], "label INT")
    assert tuple(evaluation.majority_label(train).first()) == (2, 2)
    test = spark.createDataFrame([(2,), (3,), (3,)], "label INT")
    rows = evaluation.baseline_metrics(evaluation.predict_majority(train, test)).collect()
    got = {(r["label"], r["metric"]): r["value"] for r in rows}
    assert got["all", "accuracy"] == 0.333333 and got["all", "macro_f1"] == 0.25
    assert (got["2", "precision"], got["2", "recall"], got["3", "f1"]) == (0.333333, 1.0, 0.0)
    unseen = spark.createDataFrame([(4,)], "label INT")
    rows = evaluation.baseline_metrics(evaluation.predict_majority(train, unseen)).collect()
    assert {(r["label"], r["metric"]): r["value"] for r in rows}["2", "support"] == 0


def test_saved_model(tmp_path, data):
    model = models.nb_estimator().fit(data)
    for _ in range(2):
        models.save_model(model, str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    labels = models.class_labels(data)
    assert models.predict_classes(again, data, labels).count() == 120


def test_cleaning_scalars_equals_cleaning_vectors(table, data):
    encoded, _ = features.index_and_encode(
        features.bucket_top_k(
            features.clean_categories(features.index_label(table)), "store_clean", 3, out="store_bucketed"
        )
    )
    late = features.assemble(encoded)
    late = features.sanitize(late, features.vector_dimension(late))
    pick = ("review_id", vector_to_array(F.col("features")).alias("v"))
    assert sorted(map(tuple, late.select(*pick).collect())) == sorted(map(tuple, data.select(*pick).collect()))
