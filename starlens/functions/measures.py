"""Rounded averages rebuilt from additive partial sums.

Averages are not additive, so jobs that aggregate before a join carry sums and
counts and finish the division here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_rating(col: Column) -> Column:
    """Nearest whole number, halves to the even side; NULL if it is none that fits."""
    return F.bround(col.try_cast("double")).try_cast("int")


def whole_number(col: Column, kind: str = "bigint") -> Column:
    """Text of a whole number, also when written with a fraction of zeros; NULL if it is none."""
    number = col.try_cast("double")
    whole = F.when(number == F.floor(number), number)
    return F.coalesce(col.try_cast(kind), whole.try_cast(kind))


def mean(total: Column, n: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(total, n), digits)


def share(hits: Column, n: Column, digits: int = 4) -> Column:
    """Share of rows as a decimal average: five digits first, then ``digits``."""
    wide = "decimal(20,0)"
    exact = F.try_divide(hits.cast(wide), n.cast(wide))
    return F.round(F.round(exact, 5), digits).cast("double")


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    """``part / whole``, zero when there is nothing to divide by."""
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), digits)
