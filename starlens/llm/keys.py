"""Keys of rows and names of helper columns for tables of any kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(text: Column) -> Column:
    """128 bits of digest of a text, which tell texts with the same id apart; null for null."""
    return F.unhex(F.md5(text.cast("string")))


def free_name(columns: list[str], name: str) -> str:
    """The name, lengthened until no column has it in any case."""
    held = {c.lower() for c in columns}
    while name.lower() in held:
        name += "_"
    return name
