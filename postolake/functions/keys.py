"""Row keys for exact deduplication."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postolake.functions.text import _col

KEY_SEPARATOR = "|"


def row_key_text(columns: list[Column | str]) -> Column:
    """COALESCE(x::text, '') joined by '|' over the given columns.

    NULL and '' give the same text, so they are equal for deduplication. The
    text of a double is Spark's shortest round-trip form, which is injective,
    so grouping on it equals grouping on the values. As in the source system,
    a value that itself contains '|' can make two different rows equal
    ('A|B','C' and 'A','B|C'); survey fields do not hold that character.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def blank_key_text(n_columns: int) -> str:
    """Key text of a row whose columns are all NULL or ''."""
    return KEY_SEPARATOR * (n_columns - 1)


def row_hash(columns: list[Column | str]) -> Column:
    """128-bit md5 of the row key: collision-free in practice, unlike 64 bits."""
    return F.md5(row_key_text(columns))
