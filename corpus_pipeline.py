"""Documents to a mixed, clean token store, in five stages.

Each stage takes all that the one before it kept and, but for the last, returns rows
with the columns of documents. Stages are written to the shared folder and read again, so
a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm import decontamination, mixing, near_duplicates, token_store, toxicity
from starlens.llm.keys import free_name
from starlens.llm.queries import ready
from starlens.session import scratch_path

#: Near duplicates of the stage; the query op6_near_duplicates has limits of its own.
STAGE_WORDS, STAGE_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold; those without words stay."""
    ready(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs.columns, "_toxicity")
    return toxicity.score_documents(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    ready(spark)
    return near_duplicates.one_of_each(docs, STAGE_WORDS, STAGE_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark."""
    ready(spark)
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and again as often as its source's weight asks."""
    return mixing.repeated(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ascending order of ids, as read back from the store's files."""
    return token_store.store_documents(ready(spark), docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_store", store_tokens),
]

# Neither the network's scores nor the tokenizer's ids can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written and read again."""
    ready(spark)
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
