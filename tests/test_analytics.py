from __future__ import annotations

from decimal import Decimal

import pytest

from starlens.plans import analytics

R = "parent_asin STRING, rating INT, helpful_vote INT, verified_purchase BOOLEAN"
M = "parent_asin STRING, main_category STRING, store STRING, price DECIMAL(12,2)"


@pytest.fixture(scope="module")
def frames(spark):
    rows = [
        ("p", 1, 4, True), ("p", 2, None, True), ("p", 5, 1, True), ("p", 4, 0, False),
        ("p", 3, 3, None), ("q", 5, None, True), ("z", 2, 6, None), (None, 1, 2, True),
    ]
    products = [("p", "A", "s", Decimal("10.00")), ("q", None, " ", None), ("p2", "B", "t", None)]
    return spark.createDataFrame(rows, R), spark.createDataFrame(products, M)


def rows_of(df, *names):
    return sorted(map(tuple, df.select(*names).collect()))


CATEGORY = (
    "main_category", "purchase_type", "review_count", "avg_rating", "avg_helpful_vote",
    "low_rating_share",
)
HELPFULNESS = (
    "main_category", "review_count", "low_rating_count", "low_rating_share",
    "low_rating_helpful_votes", "avg_helpful_on_low_ratings",
)


def test_category_rows_by_hand(frames):
    assert rows_of(analytics.category_purchase(*frames, 1), *CATEGORY) == [
        ("A", "not_verified", 2, 3.5, 1.5, 0.0),
        ("A", "verified", 3, 2.6667, 2.5, 0.6667),
        ("unknown", "not_verified", 1, 2.0, 6.0, 1.0),
        ("unknown", "verified", 2, 3.0, 2.0, 0.5),
    ]


def test_helpfulness_rows_by_hand(frames):
    assert rows_of(analytics.negative_helpfulness(*frames, 1), *HELPFULNESS) == [
        ("A", 5, 2, 0.4, 4, 4.0),
        ("unknown", 3, 2, 0.6667, 8, 4.0),
    ]


def test_repeated_products_multiply_reviews(frames):
    reviews, products = frames
    doubled = products.unionAll(products)
    assert rows_of(analytics.category_purchase(reviews, doubled, 1), *CATEGORY) == [
        ("A", "not_verified", 4, 3.5, 1.5, 0.0),
        ("A", "verified", 6, 2.6667, 2.5, 0.6667),
        ("unknown", "not_verified", 1, 2.0, 6.0, 1.0),
        ("unknown", "verified", 3, 3.6667, 2.0, 0.3333),
    ]


def test_category_threshold(spark):
    rows = [("p", 3, 1, True)] * 499 + [("q", 3, 1, None)] * 500
    products = [("p", "A", "s", None), ("q", "B", "s", None)]
    got = analytics.category_purchase(
        spark.createDataFrame(rows, R), spark.createDataFrame(products, M)
    ).collect()
    assert [(r["main_category"], r["purchase_type"], r["review_count"]) for r in got] == [
        ("B", "not_verified", 500)
    ]


def test_no_low_ratings_average_is_null(spark):
    reviews = spark.createDataFrame([("p", 5, 3, True)], R)
    products = spark.createDataFrame([("p", "A", "s", None)], M)
    row = analytics.negative_helpfulness(reviews, products, 1).first()
    assert row["avg_helpful_on_low_ratings"] is None and row["low_rating_helpful_votes"] == 0


def test_stores_tie_by_name(spark):
    reviews = spark.createDataFrame([("p", 1, 0, True), ("q", 1, 0, True)], R)
    products = spark.createDataFrame([("p", "A", "zed", None), ("q", "A", "abe", None)], M)
    got = analytics.risky_stores(reviews, products, min_count=1, top=1).collect()
    assert [r["store"] for r in got] == ["abe"]
    assert analytics.top_stores(analytics.risky_stores(reviews, products, 1), 1).count() == 1


def test_preview(frames):
    assert analytics.preview(frames[0]).count() == 5
