"""Audits. Each returns (check, subject, value, ok) rows and fails nothing by itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.operators.staging import parent_totals
from starlens.sources import schemas

# The smallest accepted full load.
FULL_REVIEWS, FULL_METADATA = 2_000_000, 10_000


def _report(measured: DataFrame, rows: Sequence[tuple[str, str, Column, Column]]) -> DataFrame:
    """Turn a one-row frame of counts into report rows."""
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(subject).alias("subject"),
            value.cast("bigint").alias("value"),
            ok.alias("ok"),
        )
        for check, subject, value, ok in rows
    ]
    return measured.select(F.inline(F.array(*entries)))


def _counts(flags: dict[str, Column]) -> list[Column]:
    return [F.count_if(flag).alias(name) for name, flag in flags.items()]


def key_counts(keys: Sequence[str]) -> list[Column]:
    """Aggregates over lines in column ``value``: all, unreadable ones, those without each key."""
    present = F.json_object_keys("value")
    flags = {key: present.isNotNull() & ~F.array_contains(present, key) for key in keys}
    return [F.count(F.lit(1)).alias("_lines"), F.count_if(present.isNull()).alias("_unreadable"), *_counts(flags)]


def missing_keys(
    lines: DataFrame, keys: Sequence[str], subject: str, allowed: float = 0.0
) -> DataFrame:
    """Lines lacking each required key, over all lines, and lines that are not objects.

    A key may be absent from a share ``allowed`` of the lines.
    """
    return key_report(lines.agg(*key_counts(keys)), keys, subject, allowed)


def key_report(counted: DataFrame, keys: Sequence[str], subject: str, allowed: float = 0.0) -> DataFrame:
    """The audit rows of one row of ``key_counts``."""
    rows = [("unreadable", subject, F.col("_unreadable"), F.col("_unreadable") == 0)]
    few = F.col("_lines") * allowed
    rows += [("missing_key", f"{subject}.{key}", F.col(key), F.col(key) <= few) for key in keys]
    return _report(counted, rows)


def count_report(spark: SparkSession, counts: dict[str, tuple[int, int]], check: str) -> DataFrame:
    """(found, expected) counts by subject, such as those taken while tables were written."""
    rows = [(check, subject, found, found == expected) for subject, (found, expected) in counts.items()]
    return spark.createDataFrame(rows, "check STRING, subject STRING, value BIGINT, ok BOOLEAN")


def gate_report(spark: SparkSession, counts: dict[str, tuple[int, int]]) -> DataFrame:
    """(found, least) counts by subject, taken before; ok when there are enough."""
    rows = [("min_rows", subject, found, found >= least) for subject, (found, least) in counts.items()]
    return spark.createDataFrame(rows, "check STRING, subject STRING, value BIGINT, ok BOOLEAN")


def min_rows(df: DataFrame, n: int, subject: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _report(counted, [("min_rows", subject, F.col("n"), F.col("n") >= n)])


def row_count(df: DataFrame, expected: int, subject: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _report(counted, [("row_count", subject, F.col("n"), F.col("n") == expected)])


def reconcile(source: DataFrame, loaded: DataFrame, subject: str) -> DataFrame:
    """Rows in the source and in the loaded table; ok when they agree."""
    none = F.lit(0).cast("bigint")
    count = F.count(F.lit(1))
    both = (
        source.agg(count.alias("source_rows"), none.alias("loaded_rows"))
        .unionByName(loaded.agg(none.alias("source_rows"), count.alias("loaded_rows")))
        .agg(F.sum("source_rows").alias("s"), F.sum("loaded_rows").alias("t"))
    )
    same = F.col("s") == F.col("t")
    return _report(
        both,
        [("source_rows", subject, F.col("s"), same), ("loaded_rows", subject, F.col("t"), same)],
    )


def constraint_audit(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
    """Violations of the primary keys, NOT NULL, foreign key and text length rules.

    A primary key counts its surplus rows. The foreign key is checked once per
    product, after the reviews are counted by product.
    """
    frames = {"reviews": reviews, "metadata": metadata}
    parts = [_column_audit(frames[name], name) for name in ("reviews", "metadata")]

    products = metadata.groupBy("parent_asin").agg(F.count(F.lit(1)).alias("copies"))
    surplus = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus")
    parts.append(
        _report(
            products.agg(surplus),
            [("primary_key", "metadata", F.col("surplus"), F.col("surplus") == 0)],
        )
    )

    linked = parent_totals(reviews).join(
        products.select("parent_asin", F.lit(True).alias("known")), "parent_asin", "left"
    )
    orphan = F.col("known").isNull() & F.col("parent_asin").isNotNull()
    zero = F.lit(0)
    totals = linked.agg(
        F.coalesce(F.sum(F.col("rows") - F.col("keys")), zero).alias("surplus"),
        F.coalesce(F.sum(F.when(orphan, F.col("rows"))), zero).alias("orphans"),
    )
    parts.append(
        _report(
            totals,
            [
                ("primary_key", "reviews", F.col("surplus"), F.col("surplus") == 0),
                ("foreign_key", "reviews.parent_asin", F.col("orphans"), F.col("orphans") == 0),
            ],
        )
    )
    return reduce(DataFrame.unionByName, parts)


def _column_audit(df: DataFrame, name: str) -> DataFrame:
    flags = {f"not_null.{c}": F.col(c).isNull() for c in schemas.NOT_NULL[name]}
    flags |= {
        f"max_length.{c}": F.length(c) > longest for c, longest in schemas.KEY_LENGTHS[name].items()
    }
    rows = []
    for flag in flags:
        check, column = flag.split(".")
        count = F.col(f"`{flag}`")
        rows.append((check, f"{name}.{column}", count, count == 0))
    return _report(df.agg(*_counts(flags)), rows)


def require(report: DataFrame) -> DataFrame:
    """Raise when any row of a report is not ok; the report has a few rows only."""
    failed = report.filter(~F.col("ok")).collect()
    if failed:
        detail = "; ".join(f"{r['check']} {r['subject']}={r['value']}" for r in failed)
        raise ValueError(f"data checks failed: {detail}")
    return report
