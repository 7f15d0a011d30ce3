"""Feature contract, category encoding, vector assembly and splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StructType

from starlens.functions import text
from starlens.functions.keys import key_fraction, review_key
from starlens.functions.vectors import entries, sparse_vector, vector_of
from starlens.session import scratch_path

# Fixed values.
NUMERIC_FEATURES = (
    "helpful_vote", "price", "average_rating", "rating_number", "review_year", "review_month",
)
OTHER_FEATURES = ("verified_purchase", "main_category", "store")
FLAG = "verified_purchase_num"
CATEGORIES = {"main_category": "main_category_clean", "store": "store_bucketed"}
STORE_TOP_K = 200

# A lookup of this many names is a few megabytes, small enough to send to every executor.
BROADCAST_ROWS = 100_000


def check_contract(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Return ``df`` if it has every feature column with a usable type, else raise."""
    missing = [
        c for c in (label_col, *OTHER_FEATURES, *NUMERIC_FEATURES) if c not in df.columns
    ]
    if missing:
        raise ValueError("missing feature columns: " + ", ".join(missing))
    textual = [
        c for c in NUMERIC_FEATURES if not isinstance(df.schema[c].dataType, NumericType)
    ]
    if textual:
        raise ValueError("columns must be numeric: " + ", ".join(textual))
    return df


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, n, index): positions of the values by falling frequency, equal ones by name.

    Sorted ranges number their own values, and each range starts after all before it, so
    no task and no driver holds the list. NULL has no position. The result is stored:
    a range keeps its rows however often the dictionary is read.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "dictionary")
    counts = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = (F.desc("n"), F.asc("value"))
    ranged = counts.where("value IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    # The upper bits of a place are its range, the lower 33 bits the row within.
    held = spark.read.parquet(path).select(
        "value", "n", F.shiftright("place", 33).alias("range"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row")
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = held.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    starts = starts.select("range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    return held.join(starts, "range").select("value", "n", (F.col("start") + F.col("row")).alias("index"))


def index_label(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Numeric labels as double; other labels by falling frequency, NULL labels dropped."""
    if isinstance(df.schema[label_col].dataType, NumericType):
        return df.withColumn("label", F.col(label_col).cast("double"))
    places = dictionary(df, label_col).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
    indexed = df.join(places, F.col(label_col).cast("string") == F.col("_value")).drop("_value")
    return indexed.withColumn("label", F.col("_index").cast("double")).drop("_index")


def clean_categories(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "main_category_clean": text.category_or_unknown(F.col("main_category")),
            "store_clean": text.category_or_unknown(F.col("store")),
            FLAG: text.verified_as_number(F.col("verified_purchase")),
        }
    )


def bucket_top_k(
    df: DataFrame,
    col: str,
    k: int = STORE_TOP_K,
    other: str = "other",
    out: str | None = None,
) -> DataFrame:
    """Keep the ``k`` most frequent names of ``col`` (ties by name), fold the rest.

    The names are joined back rather than listed in the query. They are sent to
    the executors only when ``k`` proves them small; otherwise Spark decides.
    """
    if k <= 0:
        raise ValueError("k must be > 0")
    frequent = (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), F.asc(col))
        .limit(k)
        .select(F.col(col).alias("_name"))
    )
    if k <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)
    name = F.coalesce(F.col("_name"), F.lit(other)).alias(out or f"{col}_bucketed")
    return df.join(frequent, F.col(col) == F.col("_name"), "left").select(
        *[F.col(c) for c in df.columns], name
    )


@dataclass(frozen=True)
class Encoding:
    """The dictionary of each category column, and how many values it has.

    A column has a slot for each value and one for unseen values and NULL, the last.
    """

    dictionaries: dict[str, DataFrame]
    sizes: dict[str, int]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add position and one-hot vector of each column. Spark joins by measured size."""
        columns = df.columns
        for i, (c, places) in enumerate(self.dictionaries.items()):
            named = places.select(F.col("value").alias(f"_value_{i}"), F.col("index").alias(f"_index_{i}"))
            df = df.join(named, F.col(c).cast("string") == F.col(f"_value_{i}"), "left")
        unseen = [F.lit(self.sizes[c]) for c in self.dictionaries]
        df = df.select(
            *columns,
            *[
                F.coalesce(F.col(f"_index_{i}"), unseen[i]).cast("double").alias(f"{c}_idx")
                for i, c in enumerate(self.dictionaries)
            ],
        )
        indexed = [f"{c}_idx" for c in self.dictionaries]
        slots = OneHotEncoder(
            inputCols=indexed, outputCols=[f"{c}_ohe" for c in self.dictionaries], handleInvalid="keep"
        )
        # The largest position is all that it has to know, so it is fitted from one row.
        largest = df.sparkSession.createDataFrame([tuple(float(n) for n in self.sizes.values())], indexed)
        return slots.fit(largest).transform(df)

    def manifest(self, spark: SparkSession) -> DataFrame:
        """(vector, idx, name) rows for the assembled vectors; as many rows as slots."""
        sources = {column: source for source, column in CATEGORIES.items()}
        parts = []
        for vector, numbers in (("features", (*NUMERIC_FEATURES, FLAG)), ("features_nb", (FLAG,))):
            plain = [(vector, i, name) for i, name in enumerate(numbers)]
            first = len(numbers)
            for c, places in self.dictionaries.items():
                name = F.concat(F.lit(f"{sources.get(c, c)}="), F.col("value"))
                idx = (F.col("index") + first).cast("int")
                parts.append(places.select(F.lit(vector).alias("vector"), idx.alias("idx"), name.alias("name")))
                first += self.sizes[c] + 1
                plain.append((vector, first - 1, f"{sources.get(c, c)}=__unknown"))
            parts.append(spark.createDataFrame(plain, "vector STRING, idx INT, name STRING"))
        return reduce(DataFrame.unionByName, parts)


def fit_encoding(df: DataFrame, cols: Sequence[str] = tuple(CATEGORIES.values())) -> Encoding:
    dictionaries = {c: dictionary(df, c) for c in cols}
    return Encoding(dictionaries, {c: places.count() for c, places in dictionaries.items()})


def index_and_encode(
    df: DataFrame, cols: Sequence[str] = tuple(CATEGORIES.values())
) -> tuple[DataFrame, Encoding]:
    encoding = fit_encoding(df, cols)
    return encoding.apply(df), encoding


def clean_numeric(df: DataFrame) -> DataFrame:
    """Missing, NaN, infinite and negative numbers become zero.

    Cleaning scalars before assembly gives the same vectors as cleaning the
    vectors, and leaves sparse vectors sparse.
    """
    zero = F.lit(0.0)

    def cleaned(name: str) -> Column:
        value = F.col(name).cast("double")
        usable = (value > zero) & (value < F.lit(float("inf")))
        return F.when(usable, value).otherwise(zero)

    return df.withColumns({c: cleaned(c) for c in NUMERIC_FEATURES})


def assemble(df: DataFrame) -> DataFrame:
    """Add ``features`` (numbers, flag, one-hots) and ``features_nb`` (flag, one-hots)."""
    discrete = [FLAG, *[f"{c}_ohe" for c in CATEGORIES.values()]]
    for output, inputs in (
        ("features", [*NUMERIC_FEATURES, *discrete]),
        ("features_nb", discrete),
    ):
        df = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep").transform(df)
    return df


def bucket_rows(features: DataFrame, store_top_k: int = STORE_TOP_K) -> DataFrame:
    """Feature rows with a numeric label, filled categories and bucketed stores."""
    cleaned = clean_categories(index_label(check_contract(features)))
    return bucket_top_k(cleaned, "store_clean", store_top_k, out=CATEGORIES["store"])


def encode_rows(bucketed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bucketed rows to vectors, with the source columns kept, and the names of their slots.

    Fitting the dictionaries reads the rows once for each: store them first when they are
    costly to compute.
    """
    encoded, encoding = index_and_encode(bucketed)
    return assemble(clean_numeric(encoded)), encoding.manifest(bucketed.sparkSession)


def build_dataset(features: DataFrame, store_top_k: int = STORE_TOP_K) -> tuple[DataFrame, DataFrame]:
    """Feature table to vectors and slot names: the whole chain."""
    return encode_rows(bucket_rows(features, store_top_k))


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Spark's random split; the outcome varies with the partitioning."""
    return df.randomSplit(list(weights), seed)


def with_split(df: DataFrame, train_ratio: float = 0.7, seed: int = 42) -> DataFrame:
    """Add ``split`` by review key: stable under any partitioning or retry."""
    fraction = key_fraction(review_key(F.col("parent_asin"), F.col("review_id")), seed)
    return df.withColumn("split", F.when(fraction < train_ratio, "train").otherwise("test"))


def key_split(
    df: DataFrame, train_ratio: float = 0.7, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of ``with_split``."""
    split = with_split(df, train_ratio, seed)
    return split.filter("split = 'train'"), split.filter("split = 'test'")


def sanitize(df: DataFrame, dim: int, col: str = "features") -> DataFrame:
    """Cut or zero-pad vectors to ``dim`` and zero NaN, infinite and negative values.

    Only slots that aren't zero are looked at, and the result is sparse. Use the
    dimension of the training data for the test data as well.
    """
    usable = F.filter(
        entries(F.col(col)),
        lambda e: (e["slot"] < dim) & (e["value"] > 0) & (e["value"] < F.lit(float("inf"))),
    )
    none = F.array().cast("array<struct<slot:int,value:double>>")
    return df.withColumn(col, sparse_vector(dim, F.coalesce(usable, none)))


def vector_dimension(df: DataFrame, col: str = "features") -> int:
    """Vector width from the column's attributes, or the largest width in the data."""
    attributes = df.schema[col].metadata.get("ml_attr", {})
    if attributes.get("num_attrs"):
        return attributes["num_attrs"]
    widest = df.agg(F.max(_width(F.col(col))).alias("n")).first()["n"]
    if widest is None:
        raise ValueError(f"no vectors in column {col!r}")
    return widest


def _width(vector: Column) -> Column:
    held = F.unwrap_udt(vector)
    return F.coalesce(held["size"], F.size(held["values"]))


def _as_vector(df: DataFrame, col: str) -> Column:
    kind, value = df.schema[col].dataType, F.col(col)
    if isinstance(kind, ArrayType):
        return array_to_vector(value.cast("array<double>"))
    if not (isinstance(kind, StructType) and "values" in kind.names):
        return value
    values = value["values"].cast("array<double>")
    if "indices" not in kind.names:
        return array_to_vector(values)
    return vector_of(value["size"].cast("int"), value["indices"].cast("array<int>"), values)


def normalize_vectors(df: DataFrame) -> DataFrame:
    """Vectors read from JSON back to vector columns; the label becomes a double.

    A sparse vector read as a struct keeps its positions.
    """
    missing = [c for c in ("features", "label") if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    vectors = [c for c in ("features", "features_nb") if c in df.columns]
    return df.select(
        *[_as_vector(df, c).alias(c) for c in vectors], F.col("label").cast("double").alias("label")
    )
