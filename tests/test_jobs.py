"""The stages one after the other, on the smallest tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import adapter
from checks.registered import QUERIES
from starlens import jobs
from starlens.plans import warehouse
from starlens.sources import readers


def test_stages(spark, small, tmp_path):
    out = str(tmp_path)
    lines = adapter.review_lines(spark, small, copies=True)
    # Only complete lines are accepted by the ingest.
    lines.filter("value LIKE '%\"asin\":%'").write.text(f"{out}/raw/reviews")
    products = adapter.metadata_lines(spark, small)
    products.filter("value NOT LIKE '%\"parent_asin\":null%'").write.text(f"{out}/raw/metadata")

    raw = (f"{out}/raw/reviews", f"{out}/raw/metadata")
    report = jobs.ingest(spark, *raw, f"{out}/staged", min_reviews=1, min_metadata=1)
    assert report.filter("NOT ok").count() == 0
    found = {(r["check"], r["subject"]): r["value"] for r in report.collect()}
    assert found["staged_rows", "reviews"] == spark.read.text(raw[0]).count() == found["row_count", "reviews.all"]
    assert found["staged_rows", "metadata"] < spark.read.text(raw[1]).count()  # empty keys are skipped
    with pytest.raises(ValueError, match="min_rows reviews"):
        jobs.ingest(spark, *raw, f"{out}/small")
    limited = jobs.ingest(spark, *raw, f"{out}/limited", limit=120)
    found = {(r["check"], r["subject"]): r["value"] for r in limited.collect()}
    assert found["staged_rows", "reviews"] == 120 == found["row_count", "reviews.all"]
    counts = spark.read.parquet(f"{out}/staged/load_counts").first()
    assert counts["deduped"] > 0 and counts["skipped_missing_meta"] > 0

    staged = spark.read.parquet(f"{out}/staged/reviews")
    reviews = warehouse.build_reviews(staged, f"{out}/warehouse/reviews")
    metadata = spark.read.parquet(f"{out}/staged/metadata")
    answers = jobs.answer_questions(reviews, metadata, f"{out}/answers")
    assert sum(r["review_count"] for r in answers["q2"].collect()) == counts["written"]
    csv = readers.read_csv(spark, f"{out}/answers/q2.csv", answers["q2"].schema)
    assert csv.collect() == answers["q2"].orderBy("review_year", "review_month").collect()

    table = jobs.feature_table(reviews, metadata, f"{out}/features")
    data = jobs.prepare_dataset(table, f"{out}/ml", store_top_k=5)
    assert data.count() == table.count()
    scores = jobs.train_models(
        spark, f"{out}/ml", f"{out}/models", trees=(2,), depths=(2,), smoothing=(1.0,), folds=2
    )
    assert {r["model"]: r["model_type"] for r in scores.collect()} == {
        "model1": "random_forest", "model2": "naive_bayes",
    }
    theta = readers.read_csv(spark, f"{out}/models/nb_theta_long.csv")
    slots = spark.read.parquet(f"{out}/ml/manifest").filter("vector = 'features_nb'").count()
    assert theta.count() % slots == 0


def test_text_rows_to_cleaned_records_and_baseline(spark, small, tmp_path):
    rows = adapter.text_rows(spark, small)
    report = {r["item"]: r["value"] for r in jobs.clean_text_rows(rows, str(tmp_path)).collect()}
    cleaned = spark.read.parquet(f"{tmp_path}/cleaned")
    sizes = {r["split"]: r["n"] for r in cleaned.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {part: str(n) for part, n in sizes.items()} == {"train": report["train_rows"], "test": report["test_rows"]}
    assert int(report["kept_rows"]) + int(report["dropped_rows"]) == rows.count()
    expected = {(r["label"], r["metric"]): r["value"] for r in QUERIES["ml_baseline_metrics"](spark, small).collect()}
    found = spark.read.parquet(f"{tmp_path}/baseline_metrics").collect()
    assert {(r["label"], r["metric"]): r["value"] for r in found} == expected


def test_absent_keys_up_to_a_share(spark, tmp_path):
    review = '{"rating":5,%s"text":"t","asin":"a","parent_asin":"p","user_id":"u%d","timestamp":%d}'
    lines = [review % ('"title":"t",' if i else "", i, i) for i in range(10)]
    spark.createDataFrame([(x,) for x in lines], "value STRING").write.text(f"{tmp_path}/r")
    spark.createDataFrame([('{"parent_asin":"p","title":"t"}',)], "value STRING").write.text(f"{tmp_path}/m")
    raw, least = (f"{tmp_path}/r", f"{tmp_path}/m"), {"min_reviews": 1, "min_metadata": 1}
    with pytest.raises(ValueError, match="missing_key reviews.title=1"):
        jobs.ingest(spark, *raw, f"{tmp_path}/a", **least)
    jobs.ingest(spark, *raw, f"{tmp_path}/b", **least, allowed_missing=0.1)
    assert spark.read.parquet(f"{tmp_path}/b/reviews").count() == 10


def test_first_rows_are_exact_and_stay(spark):
    df = spark.range(0, 1000, 1, 7)
    kept = readers.first_rows(df, 333)
    assert sorted(r["id"] for r in kept.collect()) == list(range(333)) == sorted(r["id"] for r in kept.collect())
    assert readers.first_rows(df, 0).count() == 0 and readers.first_rows(df, 5000).count() == 1000


def test_stored_rollup_gives_the_same_answers(spark, small, tmp_path):
    columns = ("parent_asin", "rating", "helpful_vote", "verified_purchase")
    reviews, metadata = adapter.reviews(spark, small, *columns), adapter.metadata(spark, small)
    answers = jobs.answer_questions(reviews, metadata, str(tmp_path))
    for name, query in (("q1", "q1_category_purchase"), ("q3", "q3_risky_stores"),
                        ("q4", "q4_price_band"), ("q5", "q5_negative_helpfulness")):
        expected = QUERIES[query](spark, small).collect()
        assert sorted(map(str, answers[name].collect())) == sorted(map(str, expected))
    for name, query in (("category_heatmap", "nb_category_heatmap"), ("top_stores", "nb_top15_stores"),
                        ("price_order", "nb_price_order"), ("top_categories", "nb_top20_categories")):
        assert sorted(map(str, answers[name].collect())) == sorted(map(str, QUERIES[query](spark, small).collect()))
    assert answers["month_series"].count() == answers["q2"].count()
