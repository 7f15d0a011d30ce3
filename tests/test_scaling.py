"""What keeps the registered queries' time and disk in step with their input."""

import json

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import adapter, registered
from starlens.operators import features, profiling, staging
from starlens.sources import schemas, writers


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parquet_of_texts_is_zstd(spark, tmp_path):
    """F19, F20"""
    df = spark.range(2000).select(F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(i)).cast("string")) for i in range(20)]).alias("t"))
    writers.write_parquet(df, str(tmp_path / "z"))
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(str(tmp_path / "z")).inputFiles())
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(df).count() == 0


def test_vectors_through_json_by_their_schema(spark, tmp_path):
    """F17"""
    rows = [(Vectors.sparse(4, [1, 3], [2.5, 1.0]), 1.0), (Vectors.dense(0.0, 0.25), 2.0), (None, 3.0)]
    kind = spark.createDataFrame(rows[:2], ["features", "label"]).schema
    df = spark.createDataFrame(rows, kind)
    writers.write_vectors(df, str(tmp_path / "v"))
    back = features.normalize_vectors(writers.read_vectors(spark, str(tmp_path / "v"), df.schema))
    got = {r["label"]: r["features"] for r in back.collect()}
    assert got == {1.0: rows[0][0], 2.0: rows[1][0], 3.0: None}


def test_staging_reads_only_the_fields_it_shows(spark):
    """F21"""
    cells = {"rating": "4.5", "title": "t", "text": "x" * 50, "user_id": "u", "parent_asin": "p", "timestamp": 5, "verified_purchase": [1]}
    lines = spark.createDataFrame([(json.dumps(cells),), (json.dumps({**cells, "asin": None}),), ("{broken",)], ["value"])
    for columns in (("review_id", "asin"), ("helpful_vote", "review_timestamp"), ("verified_purchase", "images_json", "rating")):
        some = staging.stage_reviews(lines, columns)
        assert some.columns == list(columns)
        assert "StructField(text," not in optimized(some)
        assert some.collect() == staging.stage_reviews(lines).select(*columns).collect()


@pytest.fixture
def tables(spark, tmp_path):
    """One order of eight lines, two without a quantity, and documents that JSON has to escape or that are null."""
    lines = spark.range(8).select(
        (F.col("id") % 3).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"),
        F.col("id").cast("int").alias("l_linenumber"), F.when(F.col("id") % 4 != 2, F.col("id") * 1.0).alias("l_quantity"),
        F.lit(0.1).alias("l_discount"), (F.col("id") % 2 / 100).alias("l_tax"), F.element_at(F.array(*map(F.lit, "NAR")), F.col("id").cast("int") % 3 + 1).alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.lit("2020-02-03").cast("timestamp").alias("l_shipdate"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(0, 7, "1-URGENT"), (1, None, None)], "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    texts = [(0, 'a "verified_purchase":true, \\ \n é'), (1, None), (2, "")]
    spark.createDataFrame(texts, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_texts_become_json_before_the_join(spark, tables):
    """F21, F22, F26"""
    lines = adapter.review_lines(spark, tables)
    assert "StructType(StructField(text," in optimized(lines).replace(" ", "")
    found = [r["value"] for r in lines.collect()]
    assert len(found) == 8
    cells = [json.loads(v) for v in found]
    assert {c.get("text") for c in cells} == {'a "verified_purchase":true, \\ \n é', "", None}
    explicit = [c for c in cells if len(c) == 10]
    assert explicit and list(explicit[0]) == [
        "rating", "title", "text", "images", "asin", "parent_asin", "user_id", "timestamp", "helpful_vote",
        "verified_purchase",
    ]


def test_raw_profile_makes_two_facts_a_row(spark):
    """F18, F23"""
    rows = spark.createDataFrame(
        [("k", "p", "u", "5", "text", "1"), ("k", "p", "u", "5", " ", "1"), ("l", "p", None, "x", "longer text", "1")],
        "review_id STRING, parent_asin STRING, user_id STRING, rating STRING, review_text STRING, review_timestamp STRING",
    )
    df = profiling.profile_before(rows)
    assert "lambdafunction" not in optimized(df)
    got = {(r["metric"], r["field"]): r["value"] for r in df.collect()}
    assert got[("total_rows", "")] == 3 and got[("duplicate_rows", "review_key")] == 1
    assert got[("count", "5")] == 2 and got[("count", "invalid")] == 1 and got[("count", "user_id")] == 1
    assert got[("min_len", "review_text")] == 4 and got[("max_len", "review_text")] == 11
    none = {(r["metric"], r["field"]): r["value"] for r in profiling.profile_before(rows.limit(0)).collect()}
    assert none[("total_rows", "")] == 0 and ("count", "5") not in none


def test_models_store_only_what_they_read(spark):
    """F17, F25, F27 to F30"""
    assert registered.dataset(spark, "/root/testdata/sf0.001").columns == list(registered.MODEL_COLUMNS)
    assert set(schemas.FEATURE_COLUMNS) - set(registered.MODEL_COLUMNS)
