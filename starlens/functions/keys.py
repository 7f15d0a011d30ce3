"""Surrogate keys and key-based splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlens.functions.text import strip

# Fixed value: the largest number twelve hex digits can hold.
BUCKET_SPAN = 16**12 - 1


def sha256_key(*parts: Column) -> Column:
    """SHA-256 over the parts joined with ``|``; a missing part counts as empty text.

    The parts are filled before joining because ``concat_ws`` leaves NULLs out,
    which would give different keys the same text.
    """
    filled = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws("|", *filled), 256)


def review_key(parent_asin: Column, review_id: Column) -> Column:
    empty = F.lit("")
    return F.concat_ws(
        "|", F.coalesce(strip(parent_asin), empty), F.coalesce(strip(review_id), empty)
    )


def key_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1] that depends on the seed and the key only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(BUCKET_SPAN))
