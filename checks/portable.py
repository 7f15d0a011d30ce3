"""Column types that read the same in every client.

A number or flag that may be missing, a decimal and a date come back as
different Python or pandas types from Spark and from DuckDB. The checks show
such columns as doubles or text on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVIEW = {"helpful_vote": "DOUBLE", "verified_purchase": "STRING"}
PRICE = {"price": "DOUBLE"}

SHOWN_AS: dict[str, dict[str, str]] = {
    "q_left_join_fact_dim": {"helpful_vote": "DOUBLE", **PRICE},
    "nb_month_series": {"review_date": "STRING"},
    "src_jsonl": {"helpful_vote": "DOUBLE"},
    "snk_csv": {"helpful_vote": "DOUBLE"},
    "snk_parquet_overwrite": REVIEW,
    "src_ext_parquet": REVIEW,
    "src_table_fallback": PRICE,
    "src_table_catalog": PRICE,
    "stg_review_map": {"helpful_vote": "DOUBLE"},
    "stg_semi_join": REVIEW,
    "stg_dedupe": REVIEW,
    "stg_linked_reviews": REVIEW,
    "wh_price_clean": PRICE,
    "ft_vote_clamp": {"helpful_vote": "DOUBLE"},
    "lg_safe_int": {"parsed": "DOUBLE"},
    "ft_validity_filter": REVIEW,
    "wh_reviews_optimized": REVIEW,
    "wh_reviews_bucketed": REVIEW,
    "wh_metadata_bucketed": PRICE,
    "ft_ml_features": {"verified_purchase": "STRING", "rating_number": "DOUBLE", **PRICE},
}


def portable(name: str, df: DataFrame) -> DataFrame:
    casts = {c: F.col(c).cast(kind) for c, kind in SHOWN_AS.get(name, {}).items()}
    return df.withColumns(casts) if casts else df


def portable_sql(name: str, sql: str) -> str:
    casts = ", ".join(
        f"CAST({c} AS {kind.replace('STRING', 'VARCHAR')}) AS {c}"
        for c, kind in SHOWN_AS.get(name, {}).items()
    )
    return f"SELECT * REPLACE ({casts}) FROM ({sql})" if casts else sql
