from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from starlens.operators import quality, staging
from starlens.sources import readers, schemas, writers


def lines(spark, *objects):
    cells = [(o if isinstance(o, str) else json.dumps(o, ensure_ascii=False),) for o in objects]
    return spark.createDataFrame(cells, "value STRING")


REVIEW = {
    "rating": 4.5, "title": "t", "text": "x", "images": [{"u": "é", "n": None}], "asin": "A",
    "parent_asin": "P", "user_id": "U", "timestamp": 1617000000123, "helpful_vote": 2,
    "verified_purchase": True,
}


def test_stage_reviews(spark):
    row = staging.stage_reviews(lines(spark, REVIEW)).first()
    assert row["review_id"] == hashlib.sha256(b"U|P|1617000000123|A").hexdigest()
    assert (row["rating"], row["helpful_vote"], row["verified_purchase"]) == (4, 2, True)
    assert row["images_json"] == '[{"u":"é","n":null}]'
    assert row.__fields__ == schemas.column_names(schemas.STAGED_REVIEWS)


def test_absent_and_null_key_parts_differ(spark):
    absent = {k: v for k, v in REVIEW.items() if k != "asin"}
    rows = staging.stage_reviews(lines(spark, absent, {**REVIEW, "asin": None})).collect()
    expected = [hashlib.sha256(t).hexdigest() for t in (b"U|P|1617000000123|", b"U|P|1617000000123|None")]
    assert [r["review_id"] for r in rows] == expected


@pytest.mark.parametrize(
    "value, expected", [
        (True, True), (False, False), (None, False), (1, True), (0, False), ("yes", True), ("false", True),
        ("0", True), ("", False), (0.0, False), ([], False), ({}, False), ([0], True), ({"a": 0}, True),
    ],
)
def test_verified_truth(spark, value, expected):
    row = staging.stage_reviews(lines(spark, {**REVIEW, "verified_purchase": value})).first()
    assert row["verified_purchase"] is expected


def test_stage_metadata(spark):
    product = {"parent_asin": "P", "title": "t", "price": 1.5, "features": ["b", "a"],
               "details": {"z": 1.50, "a": None}, "description": None}
    rows = staging.stage_metadata(
        lines(spark, product, {**product, "parent_asin": ""}, {**product, "parent_asin": None}, {"title": "t"})
    ).collect()
    assert len(rows) == 1
    assert rows[0]["features_text"] == '["b","a"]'
    assert rows[0]["details_json"] == '{"z":1.5,"a":null}'
    assert rows[0]["description_text"] is None and rows[0]["price"] == "1.5"


def reviews(spark, *rows):
    return spark.createDataFrame(rows, "parent_asin STRING, review_id STRING, n INT, note STRING")


def test_dedupe_takes_the_first_by_order(spark):
    df = reviews(spark, ("p", "1", 2, "b"), ("p", "1", 1, "z"), ("p", "1", 1, "y"), ("q", "1", 5, None),
                 ("p", "1", 1, None))
    got = {tuple(r) for r in staging.dedupe(df, order_cols=["n"]).collect()}
    assert got == {("p", "1", 1, None), ("q", "1", 5, None)}


def test_counts_agree_with_the_rows(spark):
    df = reviews(spark, *[("p", str(i % 4), i, "a") for i in range(10)], ("x", "1", 1, ""), ("x", "1", 1, ""))
    products = spark.createDataFrame([("p",), ("",)], "parent_asin STRING")
    assert tuple(staging.staging_counts(df, products).first()) == (4, 2, 6)
    assert staging.stage_linked_reviews(df, products).count() == 4


def test_jsonl_reader_skips_blank_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\n  \t\n{"a":2}\n', encoding="utf-8")
    assert readers.read_json_lines(spark, str(tmp_path)).count() == 2
    assert readers.read_json_lines(spark, str(tmp_path), limit=1).count() == 1


def test_csv_round_trip(spark, tmp_path):
    cells = ['say "hi"', "two\nlines", None, " padded ", "a,b", "\\back"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i INT, c STRING")
    writers.write_csv(df, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), "i INT, c STRING").orderBy("i").collect()
    assert [r["c"] for r in back] == cells


def test_single_csv_is_one_file(spark, tmp_path):
    path = writers.write_single_csv(spark.range(0, 3, 1, 3).toDF("a"), str(tmp_path / "one.csv"))
    assert (tmp_path / "one.csv").is_file() and readers.read_csv(spark, path).count() == 3


def test_csv_files_are_bounded_by_bytes(spark, tmp_path):
    # Digests don't compress, so shuffled bytes are near those written.
    digests = [F.sha2(F.concat_ws("-", "id", F.lit(i)), 512) for i in range(20)]
    wide = spark.range(4000).select(F.concat(*digests).alias("c"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1MB")
    try:
        writers.write_csv(wide.coalesce(1), str(tmp_path / "w"))
    finally:
        spark.conf.set(setting, before)
    back = readers.read_csv(spark, str(tmp_path / "w"))
    assert back.count() == 4000 and len(back.inputFiles()) > 2


def test_table_is_preferred_to_its_path(spark, tmp_path):
    spark.range(2).createOrReplaceTempView("seen")
    assert readers.read_table_or_path(spark, "seen", str(tmp_path)).count() == 2


def test_missing_keys(spark):
    df = lines(spark, REVIEW, {"rating": 1}, "not json")
    report = {r["subject"]: r["value"] for r in quality.missing_keys(df, ("rating", "asin"), "r").collect()}
    assert report == {"r": 1, "r.rating": 0, "r.asin": 1}


def test_require_raises(spark):
    report = quality.min_rows(spark.range(3), 2, "t")
    assert quality.require(report) is report
    with pytest.raises(ValueError, match="min_rows t=3"):
        quality.require(quality.min_rows(spark.range(3), 4, "t"))


def test_sample_bounds(spark):
    df = spark.range(10)
    assert staging.sample(df) is df
    with pytest.raises(ValueError):
        staging.sample(df, 0)
