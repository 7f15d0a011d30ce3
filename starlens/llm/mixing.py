"""Temperature mixing: flattened source shares, realised by permutations of blocks.

A source's weight is its share of all tokens to the power of an exponent from 0 to 1,
normalised. The exponent is bisected (each pass over the sources tries a grid of
exponents and keeps the bracket) to meet one of two targets: the smallest exponent under
which no source is repeated more than ``REPETITIONS`` times, or the one whose weights
have a given entropy, as a fraction of the largest.

A source's documents are dealt to ``BLOCKS`` blocks by a hash. Its token budget is its
weight times the whole budget; it is spent in passes over its blocks, each in another
order by hash. Full passes take every block; the last one takes blocks in its order as
long as each brings the sum closer to the budget. So a document's number of copies is that
of its block, and ``place`` is its block's rank in the first pass. The whole budget is
the smallest that takes every document at least once, unless another is given.

Tokens are words between white space of ASCII. Defined results: a null source is a source of
its own; a null or empty text has no tokens and follows its block. A source without
tokens has weight 0 and is taken once. Rows with the same id lie in the same block.
Repeated rows count each. An empty table gives no rows. Extra columns pass through
``repeated`` as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.keys import free_name
from starlens.session import scratch_path

BLOCKS = 64
REPETITIONS = 2.0
QUERY_REPETITIONS = 1.5
GRID = 32
PASSES = 5
SEED = 5
WORD = r"[^ \t\n\x0B\f\r]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def block_of(doc_id: Column, source: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), doc_id, source), F.lit(BLOCKS)).cast("int")


def counted(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        block_of(F.col("doc_id").cast("long"), F.col("source")).alias("block"),
        token_count(F.col("text")).alias("n_tokens"),
    )


def find_exponent(sources: DataFrame, repetitions: float | None = REPETITIONS, entropy: float | None = None) -> float:
    """The exponent that meets the entropy if one is given, else the limit of repetitions.

    ``sources`` has column ``share`` (above 0, sums to 1). Nothing but sums per exponent
    comes to the driver.
    """
    low, high = 0.0, 1.0
    kinds, largest = sources.agg(F.count("*"), F.max("share")).first()
    if kinds < 2:
        return 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        tried = sources.select("share", F.explode(F.array(*[F.lit(x) for x in grid])).alias("exponent"))
        raised = tried.withColumn("raised", F.pow("share", F.col("exponent")))
        sums = raised.groupBy("exponent").agg(
            F.sum("raised").alias("total"),
            F.sum(F.col("raised") * F.log("raised")).alias("weighed"),
            F.max(F.pow(F.col("share") / F.lit(largest), F.col("exponent") - 1)).alias("most"),
        )
        found = {r["exponent"]: r for r in sums.collect()}  # GRID + 1 rows

        def enough(x: float, found=found) -> bool:
            """Whether the target holds at this exponent; both only ever do from some on."""
            r = found[x]
            if entropy is not None:
                return math.log(r["total"]) - r["weighed"] / r["total"] <= entropy * math.log(kinds)
            return r["most"] <= repetitions

        first = next((i for i, x in enumerate(grid) if enough(x)), GRID)
        low, high = grid[max(first - 1, 0)], grid[first]
    return high


def plan(
    tokens: DataFrame,
    repetitions: float = REPETITIONS,
    entropy: float | None = None,
    budget_tokens: int | None = None,
) -> DataFrame:
    """source, block, weight, copies and place, for each block that holds a document."""
    spark = tokens.sparkSession
    folder = scratch_path(spark, "mixing")
    tokens.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    totals = blocks.groupBy("source").agg(F.sum("tokens").alias("in_source"))
    whole = totals.agg(F.sum("in_source")).first()[0] or 0
    shares = totals.where("in_source > 0").select("source", "in_source", (F.col("in_source") / F.lit(float(max(whole, 1)))).alias("share"))
    shares.write.parquet(f"{folder}/shares")
    shares = spark.read.parquet(f"{folder}/shares")
    exponent = find_exponent(shares, repetitions, entropy)
    raised = shares.withColumn("raised", F.pow("share", F.lit(exponent)))
    norm, once = raised.agg(F.sum("raised"), F.max(F.col("in_source") / F.col("raised"))).first()
    weights = raised.withColumn("weight", F.col("raised") / F.lit(norm or 1.0))
    budget = float(budget_tokens) if budget_tokens is not None else (once or 0.0) * (norm or 1.0)
    weights = weights.withColumn("wanted", F.col("weight") * F.lit(budget))
    # The source of the largest share gets its own tokens up to rounding: a full pass.
    weights = weights.withColumn("full", F.floor(F.col("wanted") / F.col("in_source") + F.lit(1e-9)))
    weights = weights.withColumn("rest", F.greatest(F.lit(0.0), F.col("wanted") - F.col("full") * F.col("in_source")))
    joined = blocks.join(weights.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
    order = F.xxhash64(F.lit(SEED), F.lit("last"), "source", "block")
    last = Window.partitionBy("source").orderBy(order, "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(SEED), F.lit("first"), "source", "block"), "block")
    extra = (F.sum("tokens").over(last) - F.col("tokens") / 2 < F.col("rest")).cast("long")
    return joined.select(
        "source",
        "block",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce(F.col("full") + extra, F.lit(1)).cast("long").alias("copies"),
        F.row_number().over(first).alias("place"),
    )


def stored_plan(tokens: DataFrame, **targets) -> DataFrame:
    """The plan as a table, whose size Spark knows when it joins it."""
    spark = tokens.sparkSession
    folder = scratch_path(spark, "mixing-plan")
    plan(tokens, **targets).write.parquet(folder)
    return spark.read.parquet(folder)


def mixed(documents: DataFrame, **targets) -> DataFrame:
    """doc_id, source, n_tokens, weight, block, copies and place of every document."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "mixing-tokens")
    counted(documents).write.parquet(folder)
    tokens = spark.read.parquet(folder)
    planned = stored_plan(tokens, **targets).withColumnsRenamed({"source": "of", "block": "of_block"})
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    return tokens.join(planned, same).select("doc_id", "source", "n_tokens", "weight", "block", "copies", "place")


def repeated(documents: DataFrame, **targets) -> DataFrame:
    """The documents, each as often as the mixture takes it."""
    key, copies, copy = (free_name(documents.columns, f"_mixing_{n}") for n in ("key", "copies", "copy"))
    planned = stored_plan(counted(documents), **targets)
    planned = planned.select(F.struct("source", "block").alias(key), F.col("copies").alias(copies))
    keyed = documents.withColumn(
        key, F.struct("source", block_of(F.col("doc_id").cast("long"), F.col("source")).alias("block"))
    )
    joined = keyed.join(planned, keyed[key].eqNullSafe(planned[key]))
    taken = joined.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return taken.select(*[keyed[c] for c in documents.columns])


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """At a limit that exponent 0 doesn't meet where sources are of much the same size."""
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"), repetitions=QUERY_REPETITIONS)
