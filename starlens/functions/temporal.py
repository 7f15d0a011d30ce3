"""Epoch numbers, timestamps and calendar columns (UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: seconds up to 3000-01-01; anything larger is in milliseconds.
LARGEST_EPOCH_SECONDS = 32503680000


def from_millis(col: Column) -> Column:
    return F.timestamp_millis(col.cast("bigint"))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with a UTC offset; the fraction is printed only when there is one."""
    fraction = F.when(
        F.date_format(ts, "SSSSSS") == "000000", F.lit("")
    ).otherwise(F.date_format(ts, ".SSSSSS"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def normalize_epoch(col: Column) -> Column:
    """Timestamp of an epoch number given in seconds or in milliseconds.

    Milliseconds are cut to whole seconds.
    """
    seconds = F.when(
        col > F.lit(LARGEST_EPOCH_SECONDS), (col / F.lit(1000)).cast("bigint")
    ).otherwise(col.cast("bigint"))
    return F.timestamp_seconds(seconds)


def with_year_month(df: DataFrame, ts: str = "review_timestamp") -> DataFrame:
    return df.withColumns({"review_year": F.year(ts), "review_month": F.month(ts)})
