"""What the physical plans must and must not contain, and how builds behave."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from checks import adapter
from starlens.operators import profiling, staging
from starlens.plans import analytics, warehouse


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def large_tables(spark):
    """Sort-merge joins and small skew limits, so that test data behaves like big data."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        yield


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the reviews belong to one product."""
    reviews = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("parent_asin"),
        F.sha2(F.col("id").cast("string"), 256).alias("review_id"),
        (F.col("id") % 6).cast("int").alias("rating"),
        F.lit(1).alias("helpful_vote"),
        F.lit(True).alias("verified_purchase"),
    )
    products = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("parent_asin"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("main_category"),
        F.lit("s").alias("store"),
        F.lit(None).cast("decimal(12,2)").alias("price"),
    )
    return reviews, products


def test_hot_product_is_split_in_row_joins(spark, skewed):
    with large_tables(spark):
        for joined in (warehouse.join_metadata(*skewed), staging.keep_known_parents(*skewed),
                       staging.stage_linked_reviews(*skewed)):
            rows = joined.collect()
            assert len(rows) == 40000
            assert "skew=true" in plan_of(joined)


def test_aggregates_shuffle_sums_not_reviews(spark, skewed):
    with large_tables(spark):
        df = analytics.category_purchase(*skewed)
        df.collect()
        plan = plan_of(df).split("Initial Plan")[0]
        assert "partial_count" in plan and "skew=true" not in plan


def test_copies_collapse_before_the_shuffle(spark):
    one_key = spark.range(0, 20000, 1, 8).select(
        F.lit("p").alias("parent_asin"), F.lit("r").alias("review_id"), (F.col("id") % 5).alias("n")
    )
    df = staging.dedupe(one_key)
    assert [tuple(r) for r in df.collect()] == [("p", "r", 0)]
    assert "partial_min" in plan_of(df) and "Window" not in plan_of(df)


def test_scans_read_the_needed_columns_only(spark, small):
    df = analytics.price_band_quality(
        adapter.reviews(spark, small, "parent_asin", "rating", "helpful_vote", "verified_purchase"),
        adapter.metadata(spark, small),
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all("l_shipdate" not in s and "p_name" not in s for s in scans)


def test_drop_counts_do_not_move_texts(spark, small):
    df = profiling.drop_reason_counts(adapter.text_rows(spark, small))
    aggregate = [x for x in plan_of(df).splitlines() if "partial_min" in x]
    assert aggregate and all("review_text" not in x for x in aggregate)


def test_month_filter_prunes_partitions(spark, small, tmp_path):
    table = warehouse.build_reviews(adapter.landing_reviews(spark, small), str(tmp_path / "w"))
    year = table.filter("review_year = 1996 AND review_month = 2")
    assert "PartitionFilters: [isnotnull(review_year" in plan_of(year)
    assert year.count() > 0


def test_rebuild_replaces_everything(spark, small, tmp_path):
    path = str(tmp_path / "w")
    landing = adapter.landing_reviews(spark, small)
    for build in (warehouse.build_reviews, lambda df, to: warehouse.write_features(warehouse.optimize_reviews(df), to)):
        build(landing, path)
        first = landing.filter(
            warehouse.normalize_epoch(F.col("review_timestamp")).between("1996-01-01", "1996-01-31")
        )
        assert {r["review_year"] for r in build(first, path).select("review_year").collect()} == {1996}


def test_update_replaces_only_its_months(spark, small, tmp_path):
    landing = adapter.landing_reviews(spark, small)
    path = str(tmp_path / "w")
    table = warehouse.build_reviews(landing, path)
    total, january = table.count(), table.filter("review_year = 1996 AND review_month = 1").count()
    first = landing.filter(
        warehouse.normalize_epoch(F.col("review_timestamp")).between("1996-01-01", "1996-01-31")
    )
    again = warehouse.update_reviews(first.limit(3), path)
    assert again.count() == total - january + 3


def test_bucketed_tables_join_without_exchange(spark, small, tmp_path):
    spark.sql("DROP TABLE IF EXISTS r_b")
    spark.sql("DROP TABLE IF EXISTS m_b")
    landing = adapter.landing_reviews(spark, small)
    reviews = warehouse.build_bucketed_reviews(landing, "r_b", str(tmp_path / "r"), 4)
    products = warehouse.build_bucketed_metadata(
        adapter.landing_metadata(spark, small), "m_b", str(tmp_path / "m"), 4
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        joined = warehouse.join_metadata(reviews, products)
        assert "Exchange" not in plan_of(joined)
    total = reviews.count()
    warehouse.build_bucketed_reviews(landing.limit(1), "r_b", str(tmp_path / "r"), 4)
    assert spark.table("r_b").count() == 1 < total


def test_bucketed_rows_are_written_where_they_are(spark, tmp_path):
    """Texts aren't shuffled: each of four tasks writes its own rows of the one month and bucket."""
    spark.sql("DROP TABLE IF EXISTS here_b")
    rows = spark.range(0, 400, 1, 4).select(
        F.col("id").cast("string").alias("review_id"), F.lit("p").alias("parent_asin"),
        F.lit(1617000000).alias("review_timestamp"), F.repeat(F.col("id").cast("string"), 50).alias("review_text"),
    )
    table = warehouse.build_bucketed_reviews(rows, "here_b", str(tmp_path / "r"), 4)
    assert table.count() == 400 == table.where("review_text = repeat(review_id, 50)").count()
    assert len(table.inputFiles()) == 4
    spark.sql("DROP TABLE here_b")


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("review_id"), F.lit("p").alias("parent_asin"),
        (F.lit(1617000000) + F.col("id") % 2).alias("review_timestamp"),
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="500KB"):
        table = warehouse.build_reviews(rows, str(tmp_path / "w"))
    assert table.count() == 60000 and len(table.inputFiles()) > 2


def test_month_files_compress_texts_over_large_pages(spark, tmp_path):
    """A text of a megabyte ago is found again; pages of 128 KB were compressed each for itself."""
    number = F.col("id") % 280
    hashes = [F.sha2(F.concat(number.cast("string"), F.lit(f"-{i}")), 256) for i in range(64)]
    rows = spark.range(0, 560, 1, 1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("review_id"), F.lit(1617000000).alias("review_timestamp"),
        F.concat(*hashes).alias("review_text"),
    )
    table = warehouse.build_reviews(rows, str(tmp_path / "w"))
    assert table.select("review_text").distinct().count() == 280 and table.count() == 560
    size = sum(f.stat().st_size for f in (tmp_path / "w").rglob("*.parquet"))
    assert size < 560 * 4096 / 2 * 0.75  # four bits a digit, half of the texts once more


def test_feature_rows_need_their_columns(spark):
    with pytest.raises(ValueError, match="review_text"):
        warehouse.clean_feature_rows(spark.range(1))


def test_deduplication_shuffles_no_text_of_single_rows(spark):
    """Only keys, and rows of repeated keys, go through an exchange."""
    rows = spark.range(0, 5000, 1, 4).select(
        F.lit("p").alias("parent_asin"), (F.col("id") % 4900).cast("string").alias("review_id"),
        F.col("id").alias("review_timestamp"), F.repeat(F.lit("text "), 50).alias("review_text"),
    )
    df = staging.dedupe(rows, order_cols=("review_timestamp",))
    kept = df.collect()
    assert len(kept) == 4900 and max(r["review_timestamp"] for r in kept) == 4899
    plan = plan_of(df).split("Initial Plan")[0]
    assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
