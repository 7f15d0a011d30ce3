"""The whole way from raw lines to answers and tuned models, one function per stage.

Each stage reads what the stage before it stored, so a lost executor costs the
running stage only and no stage repeats another one's joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starlens.functions.pricing import clean_price
from starlens.operators import evaluation, features, models, profiling, quality, staging
from starlens.operators.folds import with_fold_place, with_folds
from starlens.plans import analytics, warehouse
from starlens.session import prepare
from starlens.sources import readers, schemas, writers

# Which of several copies of a review is kept.
FIRST_COPY = ("review_timestamp", "user_id", "asin", "rating", "helpful_vote")


def ingest(
    spark: SparkSession,
    review_lines: str,
    metadata_lines: str,
    out: str,
    min_reviews: int | None = None,
    min_metadata: int | None = None,
    limit: int | None = None,
    allowed_missing: float = 0.0,
) -> DataFrame:
    """Stage JSON lines as Parquet under ``out`` and return the audit of the result.

    Lines and rows are counted while they are written, so nothing is read again for
    that. With ``limit``, that many lines are stored first and everything sees those.
    The least numbers of rows are those of a full load, or 1 under a limit.

    Raises when too many lines lack a required key (a share of ``allowed_missing`` may),
    a table is too small, a constraint is broken, or rows got lost on the way to storage.
    """
    prepare(spark)
    least = [quality.FULL_REVIEWS, quality.FULL_METADATA] if limit is None else [1, 1]
    min_reviews = least[0] if min_reviews is None else min_reviews
    min_metadata = least[1] if min_metadata is None else min_metadata
    read = {name: Observation(f"{name}_lines") for name in ("reviews", "metadata")}
    kept = {name: Observation(f"{name}_rows") for name in ("reviews", "metadata", "linked")}
    rows = F.count(F.lit(1)).alias("rows")

    raw = readers.read_json_lines(spark, metadata_lines, limit).observe(
        read["metadata"], F.count_if(_no_product()).alias("_skipped"),
        *quality.key_counts(schemas.REQUIRED_METADATA_KEYS),
    )
    products = staging.stage_metadata(raw).withColumn("price", clean_price(F.col("price")))
    writers.write_parquet(products.observe(kept["metadata"], rows), f"{out}/metadata")
    products = spark.read.parquet(f"{out}/metadata")

    raw = readers.read_json_lines(spark, review_lines, limit).observe(
        read["reviews"], *quality.key_counts(schemas.REQUIRED_REVIEW_KEYS)
    )
    writers.write_parquet(staging.stage_reviews(raw).observe(kept["reviews"], rows), f"{out}/staged_reviews")
    quality.require(
        quality.key_report(
            _row(spark, read["reviews"]), schemas.REQUIRED_REVIEW_KEYS, "reviews", allowed_missing
        ).unionByName(
            quality.key_report(_row(spark, read["metadata"]), schemas.REQUIRED_METADATA_KEYS, "metadata", allowed_missing)
        )
    )
    staged = spark.read.parquet(f"{out}/staged_reviews")
    linked = staging.stage_linked_reviews(staged, products, FIRST_COPY)
    writers.write_parquet(linked.observe(kept["linked"], rows), f"{out}/reviews")
    reviews = spark.read.parquet(f"{out}/reviews")
    writers.write_parquet(staging.staging_counts(staged, products), f"{out}/load_counts")
    expected = spark.read.parquet(f"{out}/load_counts").first()
    found = {name: observed.get["rows"] for name, observed in kept.items()}
    lines = {name: observed.get["_lines"] for name, observed in read.items()}
    accounted = found["linked"] + expected["skipped_missing_meta"] + expected["deduped"]
    report = (
        quality.count_report(
            spark,
            {
                "reviews": (found["reviews"], lines["reviews"]),
                "metadata": (found["metadata"], lines["metadata"] - read["metadata"].get["_skipped"]),
            },
            "staged_rows",
        )
        .unionByName(
            quality.count_report(
                spark,
                {"reviews": (found["linked"], expected["written"]), "reviews.all": (accounted, found["reviews"])},
                "row_count",
            )
        )
        .unionByName(quality.gate_report(spark, {"reviews": (found["linked"], min_reviews), "metadata": (found["metadata"], min_metadata)}))
        .unionByName(quality.constraint_audit(reviews, products))
    )
    return quality.require(report)


def _no_product() -> Column:
    """Product lines that staging skips: no key, or an empty one."""
    return F.coalesce(F.get_json_object("value", "$.parent_asin"), F.lit("")) == ""


def _row(spark: SparkSession, observed: Observation) -> DataFrame:
    """The metrics of an observation as a frame of one row."""
    return spark.createDataFrame([tuple(observed.get.values())], list(observed.get))


def answer_questions(reviews: DataFrame, metadata: DataFrame, out: str) -> dict[str, DataFrame]:
    """Answer the five questions, store each as Parquet and CSV, and return the stored answers.

    The reshaped views of the answers (``VIEWS``) are stored with them. The reviews are read twice: for the monthly trend and for the rollup that
    serves the other four.
    """
    spark = prepare(reviews.sparkSession)
    writers.write_parquet(analytics.purchase_rollup(reviews), f"{out}/rollup")
    rollup = spark.read.parquet(f"{out}/rollup")
    answers = {
        "q1": analytics.category_purchase(reviews, metadata, rollup=rollup),
        "q2": analytics.monthly_trend(reviews),
        "q3": analytics.risky_stores(reviews, metadata, rollup=rollup),
        "q4": analytics.price_band_quality(reviews, metadata, rollup=rollup),
        "q5": analytics.negative_helpfulness(reviews, metadata, rollup=rollup),
    }
    stored = {}
    for name, answer in answers.items():
        writers.write_parquet(answer, f"{out}/{name}")
        stored[name] = spark.read.parquet(f"{out}/{name}")
        writers.write_single_csv(stored[name].orderBy(*_order(name)), f"{out}/{name}.csv")
    for name, (source, view) in VIEWS.items():
        writers.write_parquet(view(stored[source]), f"{out}/{name}")
        stored[name] = spark.read.parquet(f"{out}/{name}")
    return stored


# Reshaped answers: the name of each, the answer it shows, and how.
VIEWS = {
    "category_heatmap": ("q1", analytics.category_heatmap),
    "month_series": ("q2", analytics.month_series),
    "top_stores": ("q3", analytics.top_stores),
    "price_order": ("q4", analytics.price_order),
    "top_categories": ("q5", analytics.top_categories),
}


def clean_text_rows(rows: DataFrame, out: str) -> DataFrame:
    """Profile rows of text cells, clean and split them, and score the majority baseline.

    Everything is stored under ``out``: profiles before and after, the report made from
    them, the cleaned records by split, class balance and the baseline. Returns the report.
    """
    spark = prepare(rows.sparkSession)

    def stored(df: DataFrame, name: str) -> DataFrame:
        writers.write_parquet(df, f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    before = stored(profiling.profile_before(rows), "profile_before")
    after = stored(profiling.profile_after(rows), "profile_after")
    writers.write_split(profiling.hash_split(profiling.clean_records(rows)), f"{out}/cleaned")
    cleaned = spark.read.parquet(f"{out}/cleaned")
    stored(profiling.class_balance(cleaned), "class_balance")
    train, test = (cleaned.filter(F.col("split") == part).select("label") for part in ("train", "test"))
    predictions = stored(evaluation.predict_majority(train, test), "baseline_predictions")
    stored(evaluation.baseline_metrics(predictions), "baseline_metrics")
    writers.write_single_csv(evaluation.confusion_pairs(evaluation.confusion(predictions)), f"{out}/baseline_confusion.csv")
    report = stored(profiling.quality_report(before, after), "quality_report")
    writers.write_single_csv(report.orderBy("position"), f"{out}/quality_report.csv")
    return report


def _order(name: str) -> list:
    by = {
        "q1": ["main_category", "purchase_type"],
        "q2": ["review_year", "review_month"],
        "q3": [F.desc("low_rating_share"), "avg_rating", F.desc("review_count"), "store"],
        "q4": [F.desc("review_count"), "price_band"],
        "q5": [
            F.desc("low_rating_helpful_votes"), F.desc("low_rating_share"),
            F.desc("review_count"), "main_category",
        ],
    }
    return by[name]


def feature_table(reviews: DataFrame, metadata: DataFrame, out: str) -> DataFrame:
    """Store the feature table by month and return it."""
    return warehouse.write_features(warehouse.build_features(reviews, metadata), out)


def prepare_dataset(
    table: DataFrame,
    out: str,
    store_top_k: int = features.STORE_TOP_K,
    sample_fraction: float = 1.0,
    train_ratio: float = 0.7,
    seed: int = 42,
) -> DataFrame:
    """Store vectors with their split and place among folds, and the slot names under ``out``; return the dataset."""
    spark = prepare(table.sparkSession)
    writers.write_parquet(features.bucket_rows(table, store_top_k), f"{out}/rows")
    data, manifest = features.encode_rows(spark.read.parquet(f"{out}/rows"))
    writers.write_parquet(manifest, f"{out}/manifest")
    split = features.with_split(staging.sample(data, sample_fraction, seed), train_ratio, seed)
    split = with_fold_place(split).select("features", "features_nb", "label", "fold_place", "split")
    writers.write_split(split, f"{out}/dataset")
    return spark.read.parquet(f"{out}/dataset")


def train_models(
    spark: SparkSession,
    path: str,
    out: str,
    trees: Sequence[int] = models.RF_TREES,
    depths: Sequence[int] = models.RF_DEPTHS,
    smoothing: Sequence[float] = models.NB_SMOOTHING,
    folds: int = models.FOLDS,
    parallelism: int = models.PARALLELISM,
) -> DataFrame:
    """Tune both classifiers on the stored training rows and store everything about them.

    Returns the stored evaluation: one row per model on the test rows.
    """
    prepare(spark)
    train = with_folds(writers.read_split(spark, f"{path}/dataset", "train"), folds)
    test = writers.read_split(spark, f"{path}/dataset", "test")
    manifest = spark.read.parquet(f"{path}/manifest")
    labels = models.class_labels(train)
    rf = models.rf_estimator()
    rows = []
    for model, kind in (("model1", "random_forest"), ("model2", "naive_bayes")):
        if kind == "naive_bayes":
            best, points = models.tune_bayes(train, smoothing, folds)
        else:
            tuned = models.cross_validate(rf, models.rf_grid(rf, trees, depths), train, folds, parallelism)
            best, points = tuned.bestModel, models.grid_scores(spark, tuned)
        writers.write_single_csv(points, f"{out}/{model}_grid.csv")
        models.save_model(best, f"{out}/models/{model}")
        if kind == "naive_bayes":
            predicted = models.predict_classes(best, test, labels)
            bayes = best.stages[-1]
            # Classes times slots may be many rows; the priors are one row per class.
            writers.write_csv(models.nb_theta(bayes, manifest, labels), f"{out}/nb_theta_long.csv")
            priors = models.nb_priors(spark, bayes, labels)
            writers.write_single_csv(priors, f"{out}/nb_class_priors.csv")
        else:
            predicted = models.predict(best, test)
            ranked = models.rf_importance(best, manifest)
            writers.write_csv(ranked, f"{out}/rf_feature_importance.csv")
        writers.write_parquet(predicted, f"{out}/{model}_predictions")
        predictions = spark.read.parquet(f"{out}/{model}_predictions")
        rows.append(evaluation.evaluation_row(predictions, model, kind))
        table = evaluation.confusion_pairs(evaluation.confusion(predictions))
        writers.write_single_csv(table, f"{out}/{model}_confusion.csv")
    writers.write_parquet(rows[0].unionByName(rows[1]), f"{out}/evaluation")
    scores = spark.read.parquet(f"{out}/evaluation")
    writers.write_single_csv(scores, f"{out}/evaluation.csv")
    return scores
