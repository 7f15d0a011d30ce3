"""From raw JSON lines to typed, deduplicated review and product rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.functions import text
from starlens.functions.keys import sha256_key
from starlens.functions.measures import whole_number, whole_rating
from starlens.functions.temporal import from_millis
from starlens.session import scratch_path
from starlens.sources import schemas

REVIEW_KEY = ("parent_asin", "review_id")

# So many hashes take some 300 MB of each executor.
BROADCAST_HASHES = 5_000_000


def _key_part(field: str) -> Column:
    """Text of one key field: an absent field is empty, an explicit null reads ``None``."""
    present = F.array_contains(F.json_object_keys("value"), field)
    return F.coalesce(F.col(f"raw.{field}"), F.when(present, F.lit("None")))


# Raw fields of a staged column whose name differs from theirs.
RAW_FIELDS = {
    "review_id": ("user_id", "parent_asin", "timestamp", "asin"), "review_title": ("title",),
    "review_text": ("text",), "review_timestamp": ("timestamp",), "images_json": ("images",),
}


def _raw_schema(columns: Sequence[str]) -> str:
    """The part of the raw schema that these staged columns are made of."""
    wanted = {field for c in columns for field in RAW_FIELDS.get(c, (c,))}
    return ", ".join(f for f in schemas.RAW_REVIEW.split(",") if f.split()[0] in wanted)


def stage_reviews(
    lines: DataFrame, columns: Sequence[str] = tuple(schemas.column_names(schemas.STAGED_REVIEWS))
) -> DataFrame:
    """Review rows (11 columns, or some ``columns`` of them) from JSON lines in column ``value``.

    Only the fields of these columns are read from a line; the others are passed over.
    """
    parsed = lines.withColumn("raw", F.from_json("value", _raw_schema(columns)))
    staged = {
        "review_id": sha256_key(*map(_key_part, RAW_FIELDS["review_id"])),
        "rating": whole_rating(F.col("raw.rating")),
        "review_title": F.col("raw.title"),
        "review_text": F.col("raw.text"),
        "review_timestamp": from_millis(whole_number(F.col("raw.timestamp"))),
        "helpful_vote": whole_number(F.col("raw.helpful_vote"), "int"),
        "verified_purchase": text.json_truthy(F.col("raw.verified_purchase")),
        "images_json": F.col("raw.images"),
    }
    return parsed.select(*[(staged[c] if c in staged else F.col(f"raw.{c}")).alias(c) for c in columns])


def stage_metadata(lines: DataFrame) -> DataFrame:
    """Product rows (11 columns) from JSON lines; rows without a product key are dropped."""
    return (
        lines.withColumn("raw", F.from_json("value", schemas.RAW_METADATA))
        .filter(F.col("raw.parent_asin") != "")
        .select(
            "raw.parent_asin",
            "raw.main_category",
            "raw.title",
            "raw.average_rating",
            "raw.rating_number",
            "raw.price",
            "raw.store",
            F.col("raw.features").alias("features_text"),
            F.col("raw.description").alias("description_text"),
            F.col("raw.categories").alias("categories_json"),
            F.col("raw.details").alias("details_json"),
        )
    )


def keep_known_parents(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
    """Reviews whose product is in the metadata."""
    return reviews.join(metadata.select("parent_asin"), "parent_asin", "left_semi").select(
        *reviews.columns
    )


def by_repetition(df: DataFrame, keys: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key surely occurs once, and all others; NULL equals NULL.

    Keys are counted by a 64-bit hash, so that only hashes are shuffled. The few keys that
    share a hash with another go with the repeated ones. Hashes that occur again are stored
    and sent to the executors, so that no row moves; above ``BROADCAST_HASHES`` Spark decides
    how to join.

    ``df`` is computed once here, and once for each of the two results.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "repeated")
    hashed = F.xxhash64(*keys)
    counted = df.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    counted.where("_n > 1").select("_hash").write.parquet(path)
    repeated = spark.read.parquet(path)
    if repeated.count() <= BROADCAST_HASHES:
        repeated = F.broadcast(repeated)
    same = hashed == repeated["_hash"]
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def dedupe(
    df: DataFrame,
    keys: Sequence[str] = REVIEW_KEY,
    order_cols: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the first by ``order_cols``, then by the remaining columns.

    Keys are counted first. Rows of a key that occurs once pass as they are: no shuffle
    of whole rows (see ``by_repetition``). Only rows of repeated keys are compared. The
    first of them is a minimum, not a window rank: copies collapse to one row per map task
    before the shuffle, so a key that holds a large part of all rows never meets in one task.

    ``df`` is computed twice more; store it first when it is costly.
    """
    named = [c for c in order_cols if isinstance(c, str)]
    order = [
        F.col(c) if isinstance(c, str) else c.alias(f"_order_{i}") for i, c in enumerate(order_cols)
    ]
    rest = [F.col(c) for c in df.columns if c not in named and c not in keys]
    single, several = by_repetition(df, keys)
    first = (
        several.groupBy(*keys)
        .agg(F.min(F.struct(*order, *rest, F.lit(0).alias("_last"))).alias("_first"))
        .select(*[F.col(c if c in keys else f"_first.{c}").alias(c) for c in df.columns])
    )
    return single.unionByName(first)


def stage_linked_reviews(
    reviews: DataFrame, metadata: DataFrame, order_cols: Sequence[str | Column] = ()
) -> DataFrame:
    """Deduplicated reviews of known products.

    Duplicates go first. Joining first would leave the rows partitioned by
    product, and Spark would reuse that partitioning for the deduplication: a
    hot product would then stay in one task that adaptive execution cannot split.
    """
    return keep_known_parents(dedupe(reviews, REVIEW_KEY, order_cols), metadata)


def parent_totals(reviews: DataFrame) -> DataFrame:
    """Rows and distinct review keys per product, each key counted once."""
    return (
        reviews.groupBy(*REVIEW_KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("parent_asin")
        .agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("keys"))
    )


def staging_counts(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row: written, skipped (no metadata) and deduped review counts."""
    known = metadata.select("parent_asin").filter(F.col("parent_asin") != "").distinct()
    flagged = parent_totals(reviews).join(
        known.withColumn("known", F.lit(True)), "parent_asin", "left"
    )
    missing = F.col("known").isNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return flagged.agg(
        total(F.when(~missing, F.col("keys"))).alias("written"),
        total(F.when(missing, F.col("rows"))).alias("skipped_missing_meta"),
        total(F.when(~missing, F.col("rows") - F.col("keys"))).alias("deduped"),
    )


def sample(df: DataFrame, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement; a fraction of 1 keeps every row."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return df if fraction == 1 else df.sample(False, fraction, seed)
