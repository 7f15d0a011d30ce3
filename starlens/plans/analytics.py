"""The analytic questions over reviews and product metadata.

The four questions that need product columns aggregate reviews by product
before the join. What is shuffled is then one row of sums per product and map
task instead of the reviews, and a product with a third of all reviews is as
cheap as any other. The sums are additive, so the joined rows give the same
averages as joined reviews would. For the same reason these questions also take
a stored ``purchase_rollup`` as ``rollup``: one pass over the reviews then
serves all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.functions.measures import mean, share
from starlens.functions.pricing import band_position, price_band

UNKNOWN = "unknown"
PURCHASE_TYPES = ("verified", "not_verified")

# Additive measures carried by a rollup, with the row-level value each one sums.
MEASURES = (
    "reviews", "rated", "stars", "voted", "votes", "low", "low_voted", "low_votes", "verified",
)


def _is_verified() -> Column:
    return F.coalesce(F.col("verified_purchase"), F.lit(False))


def _low() -> Column:
    return F.coalesce(F.col("rating") <= 2, F.lit(False))


def _measures(rows: Column | None = None, prefix: str = "") -> list[Column]:
    """Partial sums over the rows that satisfy ``rows`` (all rows by default)."""

    def only(condition: Column) -> Column:
        return condition if rows is None else rows & condition

    everything = F.lit(True)
    votes, stars = F.col("helpful_vote"), F.col("rating")
    values = {
        "reviews": F.count_if(only(everything)),
        "rated": F.count_if(only(stars.isNotNull())),
        "stars": F.sum(F.when(only(everything), stars)),
        "voted": F.count_if(only(votes.isNotNull())),
        "votes": F.sum(F.when(only(everything), votes)),
        "low": F.count_if(only(_low())),
        "low_voted": F.count_if(only(_low() & votes.isNotNull())),
        "low_votes": F.sum(F.when(only(_low()), votes)),
        "verified": F.count_if(only(_is_verified())),
    }
    return [values[name].alias(prefix + name) for name in MEASURES]


def product_rollup(reviews: DataFrame) -> DataFrame:
    """One row of additive measures per product."""
    return reviews.groupBy("parent_asin").agg(*_measures())


def purchase_rollup(reviews: DataFrame) -> DataFrame:
    """One row per product and purchase type.

    Both types are summed side by side and unfolded afterwards: grouping by the
    type as well would partition the rows by a key the join cannot use.
    """
    sides = {"verified": _is_verified(), "not_verified": ~_is_verified()}
    wide = reviews.groupBy("parent_asin").agg(
        *[m for side, rows in sides.items() for m in _measures(rows, side + "_")]
    )
    unfolded = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(side).alias("purchase_type"),
                    *[F.col(f"{side}_{m}").alias(m) for m in MEASURES],
                )
                for side in sides
            ]
        )
    )
    return wide.select("parent_asin", unfolded).filter("reviews > 0")


def _regroup(rollup: DataFrame, metadata: DataFrame, column: str, *keys: Column) -> DataFrame:
    """Join a rollup with one product column and sum it up by ``keys``."""
    joined = rollup.join(metadata.select("parent_asin", column), "parent_asin", "left")
    return joined.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def _label(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN)).alias(column)


def _count() -> Column:
    return F.col("reviews").alias("review_count")


def _avg_rating() -> Column:
    return mean(F.col("stars"), F.col("rated")).alias("avg_rating")


def _avg_votes() -> Column:
    return mean(F.col("votes"), F.col("voted")).alias("avg_helpful_vote")


def _low_share() -> Column:
    return share(F.col("low"), F.col("reviews")).alias("low_rating_share")


def _verified_ratio() -> Column:
    return share(F.col("verified"), F.col("reviews")).alias("verified_purchase_ratio")


def _low_votes_or_zero() -> Column:
    """Votes on low ratings; other ratings count as zero, so only their absence leaves NULL."""
    votes = F.col("low_votes")
    return F.when(F.col("low") < F.col("reviews"), F.coalesce(votes, F.lit(0))).otherwise(votes)


def category_purchase(
    reviews: DataFrame,
    metadata: DataFrame,
    min_count: int = 500,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Rating quality by product category and purchase type."""
    sums = _regroup(
        rollup or purchase_rollup(reviews), metadata, "main_category", _label("main_category"),
        F.col("purchase_type"),
    )
    return (
        sums.filter(F.col("reviews") >= min_count)
        .select(
            "main_category", "purchase_type", _count(), _avg_rating(), _avg_votes(), _low_share()
        )
        .orderBy("main_category", "purchase_type")
    )


def monthly_trend(reviews: DataFrame) -> DataFrame:
    """Volume and quality per calendar month."""
    return (
        reviews.groupBy("review_year", "review_month")
        .agg(*_measures())
        .select(
            "review_year", "review_month", _count(), _avg_rating(), _low_share(),
            _verified_ratio(), _avg_votes(),
        )
        .orderBy("review_year", "review_month")
    )


def risky_stores(
    reviews: DataFrame,
    metadata: DataFrame,
    min_count: int = 200,
    top: int = 20,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Stores with the largest share of low ratings; the store name settles ties."""
    sums = _regroup(rollup or product_rollup(reviews), metadata, "store", _label("store"))
    return (
        sums.filter(F.col("reviews") >= min_count)
        .select(
            "store", _count(), _avg_rating(), _low_share(), _avg_votes(), _verified_ratio()
        )
        .orderBy(F.desc("low_rating_share"), "avg_rating", F.desc("review_count"), "store")
        .limit(top)
    )


def price_band_quality(
    reviews: DataFrame, metadata: DataFrame, rollup: DataFrame | None = None
) -> DataFrame:
    """Volume and quality by price band."""
    band = price_band(F.col("price")).alias("price_band")
    return (
        _regroup(rollup or product_rollup(reviews), metadata, "price", band)
        .select("price_band", _count(), _avg_rating(), _low_share(), _avg_votes())
        .orderBy(F.desc("review_count"), "price_band")
    )


def negative_helpfulness(
    reviews: DataFrame,
    metadata: DataFrame,
    min_count: int = 500,
    top: int = 20,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """How helpful readers find low ratings, by category."""
    sums = _regroup(
        rollup or product_rollup(reviews), metadata, "main_category", _label("main_category")
    )
    return (
        sums.filter(F.col("reviews") >= min_count)
        .select(
            "main_category",
            _count(),
            F.col("low").alias("low_rating_count"),
            _low_share(),
            _low_votes_or_zero().alias("low_rating_helpful_votes"),
            mean(F.col("low_votes"), F.col("low_voted")).alias("avg_helpful_on_low_ratings"),
        )
        .orderBy(
            F.desc("low_rating_helpful_votes"),
            F.desc("low_rating_share"),
            F.desc("review_count"),
            "main_category",
        )
        .limit(top)
    )


def table_counts(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )

    return counted("metadata", metadata).unionByName(counted("reviews", reviews))


def preview(df: DataFrame, order: Sequence[str] = (), n: int = 5) -> DataFrame:
    """The first rows by key, or by all columns without one: the same ones each time."""
    return df.orderBy(*(order or df.columns)).limit(n)


def category_heatmap(by_category: DataFrame, top: int = 12) -> DataFrame:
    """The largest category/purchase cells as one row per category."""
    cells = (
        by_category.filter(F.col("main_category") != UNKNOWN)
        .orderBy(F.desc("review_count"), "main_category", "purchase_type")
        .limit(top)
    )
    return (
        cells.groupBy("main_category")
        .pivot("purchase_type", list(PURCHASE_TYPES))
        .agg(
            F.first("avg_rating").alias("avg_rating"),
            F.first("low_rating_share").alias("low_rating_share"),
        )
        .orderBy("main_category")
    )


def month_series(trend: DataFrame) -> DataFrame:
    """Monthly series on first-of-month dates."""
    day = F.make_date("review_year", "review_month", F.lit(1))
    return trend.select(
        day.alias("review_date"), "review_count", "avg_rating", "low_rating_share",
        "verified_purchase_ratio",
    ).orderBy("review_date")


def top_stores(stores: DataFrame, top: int = 15) -> DataFrame:
    return (
        stores.select(
            "store", "review_count", "avg_rating", "low_rating_share", "avg_helpful_vote"
        )
        .orderBy(F.desc("low_rating_share"), "avg_rating", F.desc("review_count"), "store")
        .limit(top)
    )


def price_order(bands: DataFrame) -> DataFrame:
    """Price bands from cheap to dear, the unknown price last."""
    return bands.withColumn("band_position", band_position(F.col("price_band"))).orderBy(
        "band_position"
    )


def top_categories(by_category: DataFrame, top: int = 20) -> DataFrame:
    return by_category.orderBy(F.desc("review_count"), "main_category").limit(top)
