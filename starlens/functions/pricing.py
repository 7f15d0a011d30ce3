"""Price cells and price bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound (inclusive) of each band after the first, in order.
BAND_STEPS = ((25, "25_75"), (75, "75_150"), (150, "150_300"), (300, "300_plus"))
FIRST_BAND = "0_25"
NO_PRICE = "unknown"
BAND_ORDER = (FIRST_BAND, *(name for _, name in BAND_STEPS), NO_PRICE)


def clean_price(col: Column) -> Column:
    """Decimal price from free text; blank or unreadable text gives NULL."""
    return F.regexp_replace(col, "[^0-9.-]", "").try_cast("decimal(12,2)")


def price_band(price: Column) -> Column:
    band = F.when(price.isNull(), NO_PRICE)
    for lower, name in reversed(BAND_STEPS):
        band = band.when(price >= lower, name)
    return band.otherwise(FIRST_BAND)


def band_position(band: Column) -> Column:
    """1-based place of a band in business order."""
    return F.array_position(F.array(*map(F.lit, BAND_ORDER)), band).cast("int")
