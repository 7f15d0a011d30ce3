"""The given order tables in the shape of reviews and products.

A line item is a review: its part is the product, its order's customer the
author and one of the documents its text. Orders and documents are joined only
when a query asks for their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.functions.keys import sha256_key
from starlens.plans.warehouse import clean_metadata, optimize_reviews
from starlens.sources import schemas

FROM_ORDERS = {"user_id", "review_title", "review_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by order, which is also how the join with the orders wants them.

    The small files of the given tables have one row group each, so their one
    reading task would do all the work on the texts as well.
    """
    return table(spark, sf_dir, "lineitem").repartition("l_orderkey")


def facts(
    spark: SparkSession, sf_dir: str, *columns: str, copies: bool = False, text: Column | None = None
) -> DataFrame:
    """Review cells per line item; ``copies`` repeats some reviews with small changes.

    ``text`` is what to show of a document, made before the join: once a document.
    """
    wide = {"review_text", "review_id"}.intersection(columns)
    df = line_items(spark, sf_dir) if wide else table(spark, sf_dir, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    if FROM_ORDERS.intersection(columns):
        orders = table(spark, sf_dir, "orders")
        df = df.join(orders, F.col("o_orderkey") == order, "left")
    else:
        df = df.withColumns({"o_custkey": F.lit(None), "o_orderpriority": F.lit(None)})
    if "review_text" in columns:
        documents = table(spark, sf_dir, "documents").select("doc_id", (F.col("text") if text is None else text).alias("text"))
        n = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
        df = df.withColumn("_doc", order % n).join(documents, F.col("_doc") == F.col("doc_id"), "left")
    else:
        df = df.withColumn("text", F.lit(None).cast("string"))
    copy = F.lit(0)
    if copies:
        once = F.array(F.lit(0))
        copy = F.explode(F.when(order % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(once))
    again = F.when(F.col("copy") == 1, " again").otherwise("")
    millis = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    asin = F.col("l_suppkey").cast("string")
    # A tenth of the parts is sold under a key that no product has.
    part = F.col("l_partkey").cast("string")
    parent = F.when(F.col("l_partkey") % 10 == 9, F.concat(F.lit("none-"), part)).otherwise(part)
    votes = F.when(F.col("l_discount") != 0, (F.col("l_tax") * 100 + 0.5).cast("int") - 1)
    return df.withColumn("copy", copy).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        parent.alias("parent_asin"),
        asin.alias("asin"),
        (F.col("l_quantity").cast("int") % 6).alias("rating"),
        ((F.col("l_quantity").cast("int") % 11) / 2.0).cast("double").alias("half_rating"),
        F.concat("o_orderpriority", again).alias("review_title"),
        F.col("text").alias("review_text"),
        millis.alias("millis"),
        F.when(line % 2 == 0, millis)
        .otherwise((millis / 1000).cast("bigint"))
        .alias("review_timestamp"),
        (votes + F.col("copy")).alias("helpful_vote"),
        F.when(F.col("l_returnflag") == "N", True)
        .when(F.col("l_returnflag") == "A", False)
        .alias("verified_purchase"),
        F.when(F.col("l_linestatus") == "O", F.array(F.concat(F.lit("img/"), asin))).alias("images"),
        line.alias("line"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def landing_reviews(
    spark: SparkSession, sf_dir: str, *columns: str, copies: bool = False
) -> DataFrame:
    """Landing rows; ``columns`` limits them (all columns but the text by default)."""
    wanted = columns or [
        c for c in schemas.column_names(schemas.LANDING_REVIEWS) if c != "review_text"
    ]
    df = facts(spark, sf_dir, *wanted, copies=copies)
    key = sha256_key(*map(F.col, ("user_id", "parent_asin", "millis", "asin")))
    return df.withColumns(
        {"review_id": key, "images_json": F.to_json("images")}
    ).select(*wanted)


def reviews(spark: SparkSession, sf_dir: str, *columns: str, copies: bool = False) -> DataFrame:
    """Warehouse reviews: landing columns with timestamp, year and month."""
    wanted = dict.fromkeys((*columns, "review_timestamp"))
    return optimize_reviews(landing_reviews(spark, sf_dir, *wanted, copies=copies))


def landing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product rows, one for each part."""
    key = F.col("p_partkey")
    price = F.concat(
        F.lit("$"), F.round((F.col("p_retailprice") - 900) * 4, 2).cast("decimal(12,2)").cast("string")
    )
    return (
        table(spark, sf_dir, "part")
        .select(
            key.cast("string").alias("parent_asin"),
            F.when(key % 13 != 0, F.col("p_type")).alias("main_category"),
            F.col("p_name").alias("title"),
            (F.col("p_size") / 10.0).cast("double").alias("average_rating"),
            (F.col("p_size") * 10).alias("rating_number"),
            F.when(key % 7 == 0, None).when(key % 11 == 0, "").otherwise(price).alias("price"),
            F.when(key % 17 == 0, "  ").otherwise(F.col("p_brand")).alias("store"),
            F.to_json(F.array("p_brand")).alias("features_text"),
            F.lit(None).cast("string").alias("description_text"),
            F.to_json(F.array("p_type")).alias("categories_json"),
            F.lit(None).cast("string").alias("details_json"),
        )
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_metadata(landing_metadata(spark, sf_dir))


def _members(cells: list[Column], explicit: bool) -> Column:
    """The members of a JSON object without its braces."""
    value = F.to_json(F.struct(*cells), {"ignoreNullFields": str(not explicit).lower()})
    return F.substr(value, F.lit(2), F.length(value) - 2)


def review_lines(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """JSON review lines. Empty cells are left out, or written as null on line 3 of an order.

    The member of the text is made once a document, so only short cells are turned to JSON here.
    """
    member = _members([F.col("text")], explicit=False)
    df = facts(spark, sf_dir, "user_id", "review_title", "review_text", copies=copies, text=member)
    before = [F.col("half_rating").alias("rating"), F.col("review_title").alias("title")]
    after = [
        F.col("images"),
        F.when(F.col("tax") != 0, F.col("asin")).alias("asin"),
        F.col("parent_asin"),
        F.col("user_id"),
        F.col("millis").alias("timestamp"),
        F.col("helpful_vote"),
        F.col("verified_purchase"),
    ]

    def either(cells: list[Column]) -> Column:
        return F.when(F.col("line") == 3, _members(cells, explicit=True)).otherwise(_members(cells, explicit=False))

    none = F.when(F.col("line") == 3, F.lit('"text":null'))
    # Lines 5 and up spell the flag in other ways that mean the same.
    end = either(after)
    flag, other = '"verified_purchase":', end
    for meant, spellings in (("true", ('"false"', '"0"', "1.5", "[0]")), ("false", ("0.00", "[]", '""', "{}"))):
        chosen = F.element_at(F.array(*map(F.lit, spellings)), F.col("quantity") % len(spellings) + 1)
        other = F.replace(other, F.lit(flag + meant), F.concat(F.lit(flag), chosen))
    end = F.when(F.col("line") >= 5, other).otherwise(end)
    held = F.coalesce(F.nullif(F.col("review_text"), F.lit("")), none)
    members = F.concat_ws(",", F.nullif(either(before), F.lit("")), held, F.nullif(F.col("_end"), F.lit("")))
    value = F.concat(F.lit("{"), members, F.lit("}"))
    # No line without a spelling.
    return df.withColumn("_end", end).select(F.when(F.col("_end").isNotNull(), value).alias("value"))


def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    details = F.struct(
        F.concat("p_brand", F.lit(" é")).alias("Größe"),
        size.alias("Size"),
        F.col("p_retailprice").alias("Price"),
        F.lit(None).cast("string").alias("Note"),
    )
    cells = F.struct(
        F.when(key % 31 == 0, "").when(key % 29 != 0, key.cast("string")).alias("parent_asin"),
        F.when(key % 13 != 0, F.col("p_type")).alias("main_category"),
        F.col("p_name").alias("title"),
        (size / 10.0).cast("double").alias("average_rating"),
        (size * 10).alias("rating_number"),
        F.when(key % 7 != 0, F.col("p_retailprice")).alias("price"),
        F.col("p_brand").alias("store"),
        F.when(key % 7 != 0, F.array("p_brand", "p_type")).alias("features"),
        F.array_compact(F.array(F.when(size % 2 == 0, F.col("p_name")))).alias("description"),
        F.array("p_type", F.lit('say "hi"')).alias("categories"),
        F.when(key % 5 != 0, details).alias("details"),
    )
    return table(spark, sf_dir, "part").select(
        F.to_json(cells, {"ignoreNullFields": "false"}).alias("value")
    )


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as text cells with repeats, blanks and unreadable numbers, for cleaning jobs."""
    df = facts(spark, sf_dir, "user_id", "review_title", "review_text", "review_id", copies=True)
    quantity, line = F.col("quantity"), F.col("line")
    whole = F.col("rating").cast("string")
    padded = F.concat(F.lit("\t"), F.col("review_text"), F.lit(" \n"))
    key = sha256_key(*map(F.col, ("user_id", "parent_asin", "millis", "asin")))

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    return df.select(
        key.alias("review_id"),
        F.concat(F.col("parent_asin"), F.lit(" ")).alias("parent_asin"),
        F.when(F.col("user_id").cast("bigint") % 97 == 0, " \t").otherwise(F.col("user_id")).alias(
            "user_id"
        ),
        F.col("asin"),
        F.when(quantity == 50, "n/a")
        .when(quantity == 49, "nan")
        .when(line == 7, F.concat(whole, F.lit(".7")))
        .otherwise(whole)
        .alias("rating"),
        F.col("review_title"),
        text(
            F.when(F.col("tax") + F.col("discount") > 0.17, None)
            .when(line == 1, padded)
            .otherwise(F.col("review_text"))
        ).alias("review_text"),
        F.col("millis").cast("string").alias("review_timestamp"),
        text(F.col("helpful_vote").cast("string")).alias("helpful_vote"),
        F.when(F.col("verified_purchase"), " True ")
        .when(~F.col("verified_purchase"), "no")
        .otherwise("")
        .alias("verified_purchase"),
        text(F.to_json("images")).alias("images_json"),
    )
