"""Text, boolean and integer cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
WHITESPACE_CODE_POINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# The spellings of true accepted in text columns.
TRUE_WORDS = ("1", "true", "yes", "y")

# JSON values that count as false; quoted text does unless it is empty.
FALSY_JSON = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")

# Text that reads as a finite decimal number.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


WHITESPACE = "".join(map(chr, WHITESPACE_CODE_POINTS))


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks (SQL ``trim`` keeps tabs)."""
    return F.btrim(col, F.lit(WHITESPACE))


def strip_long(col: Column) -> Column:
    """``strip`` for long texts: trimming indexes the whole text, so only those that need it are trimmed."""
    white = F.lit(WHITESPACE)
    ends = F.contains(white, F.substring(col, -1, 1)) | F.contains(white, F.substring(col, 1, 1))
    return F.when(ends, strip(col)).otherwise(col)


def is_empty(col: Column) -> Column:
    """True for NULL and for text that is nothing but white space.

    Trimming on the left stops at the first other character; trimming on the
    right would index the whole text.
    """
    return F.coalesce(F.ltrim(col, F.lit(WHITESPACE)) == "", F.lit(True))


def safe_int(col: Column) -> Column:
    """Whole part of a numeric text, NULL when it is not a finite number."""
    cell = strip(col)
    return F.when(cell.rlike(NUMBER_PATTERN), cell.try_cast("double").try_cast("bigint"))


def safe_int_or(col: Column, default: int = 0) -> Column:
    return F.coalesce(safe_int(col), F.lit(default).cast("bigint"))


def clamp_votes(col: Column) -> Column:
    """Missing and negative vote counts become zero."""
    return F.greatest(F.coalesce(col, F.lit(0)), F.lit(0))


def verified_or_false(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def verified_from_text(col: Column) -> Column:
    return F.coalesce(F.lower(strip(col)).isin(*TRUE_WORDS), F.lit(False))


def verified_as_number(col: Column) -> Column:
    return F.when(col, F.lit(1.0)).otherwise(F.lit(0.0))


def json_truthy(col: Column) -> Column:
    """Truth value of a JSON cell read as a variant; a missing cell is false.

    The texts ``"false"`` and ``"0"`` are true, as all text that isn't empty.
    """
    return F.coalesce(~F.to_json(col).isin(*FALSY_JSON), F.lit(False))


def category_or_unknown(col: Column) -> Column:
    """Blank-trimmed label; missing and blank labels become ``unknown``."""
    cleaned = F.trim(col.cast("string"))
    return F.when(F.length(cleaned) > 0, cleaned).otherwise(F.lit("unknown"))
