"""Column lists of the tables, in table order (fixed values)."""

from __future__ import annotations

# JSON review line. Numbers that may also arrive as text are read as text, and
# so are nested values: Spark then keeps them as compact JSON, with their key
# order and inner nulls, while it parses the line once. The flag is read as a
# variant, which tells text from numbers and booleans.
RAW_REVIEW = """
    rating STRING, title STRING, text STRING, asin STRING, parent_asin STRING,
    user_id STRING, timestamp STRING, helpful_vote STRING, verified_purchase VARIANT,
    images STRING
"""

# JSON product line.
RAW_METADATA = """
    parent_asin STRING, main_category STRING, title STRING, average_rating DOUBLE,
    rating_number INT, price STRING, store STRING, features STRING,
    description STRING, categories STRING, details STRING
"""

REQUIRED_REVIEW_KEYS = (
    "rating", "title", "text", "asin", "parent_asin", "user_id", "timestamp",
)
REQUIRED_METADATA_KEYS = ("parent_asin", "title")

# Landing zone: epoch numbers and price text, as they come out of an export.
LANDING_REVIEWS = """
    review_id STRING, parent_asin STRING, user_id STRING, asin STRING, rating INT,
    review_title STRING, review_text STRING, review_timestamp BIGINT,
    helpful_vote INT, verified_purchase BOOLEAN, images_json STRING
"""
LANDING_METADATA = """
    parent_asin STRING, main_category STRING, title STRING, average_rating DOUBLE,
    rating_number INT, price STRING, store STRING, features_text STRING,
    description_text STRING, categories_json STRING, details_json STRING
"""

# Typed tables.
STAGED_REVIEWS = LANDING_REVIEWS.replace(
    "review_timestamp BIGINT", "review_timestamp TIMESTAMP"
)
STAGED_METADATA = LANDING_METADATA.replace("price STRING", "price DECIMAL(12,2)")

# Longest text each key column may hold.
KEY_LENGTHS = {
    "reviews": {"review_id": 64, "parent_asin": 32, "user_id": 128, "asin": 32},
    "metadata": {"parent_asin": 32},
}
NOT_NULL = {
    "reviews": ("review_id", "parent_asin", "user_id", "rating", "review_timestamp"),
    "metadata": ("parent_asin",),
}

FEATURE_COLUMNS = (
    "review_id", "parent_asin", "user_id", "asin", "label", "review_title", "review_text",
    "helpful_vote", "verified_purchase", "main_category", "store", "price",
    "average_rating", "rating_number", "review_year", "review_month",
)


def column_names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.replace("(12,2)", "").split(",")]
