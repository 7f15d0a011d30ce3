"""The numbered operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from starlens.llm.cross_entropy import op1_cross_entropy
from starlens.llm.decontamination import op7_decontamination
from starlens.llm.fingerprints import op2_fingerprints
from starlens.llm.languages import op9_language_id
from starlens.llm.lexical_search import ORACLE_SQL as LEXICAL_SEARCH_SQL
from starlens.llm.lexical_search import op12_lexical_search
from starlens.llm.mixing import op5_mixing
from starlens.llm.near_duplicates import op6_near_duplicates
from starlens.llm.packing import op11_packing
from starlens.llm.secrets import op3_secrets
from starlens.llm.token_counts import op8_token_counts
from starlens.llm.token_store import op4_token_store
from starlens.llm.toxicity import op10_toxicity
from starlens.llm.whitening import op13_whitening
from starlens.session import prepare

ROOT = str(Path(__file__).resolve().parents[2])
#: Rows of one Arrow batch; long texts make larger batches than most tables have.
BATCH_ROWS = "1000"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and bound the batches that they get."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(x for x in (ROOT, environment.get("PYTHONPATH", "")) if x)
    return spark


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ready(spark), sf_dir)

    return run


QUERIES = {
    q.__name__: registered(q)
    for q in (
        op1_cross_entropy,
        op2_fingerprints,
        op3_secrets,
        op4_token_store,
        op5_mixing,
        op6_near_duplicates,
        op7_decontamination,
        op8_token_counts,
        op9_language_id,
        op10_toxicity,
        op11_packing,
        op12_lexical_search,
        op13_whitening,
    )
}

ORACLE: dict[str, str] = {"op12_lexical_search": LEXICAL_SEARCH_SQL}
