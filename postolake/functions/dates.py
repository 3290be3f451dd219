"""Date parsing and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postolake.functions.text import _col, is_blank

# ASCII whitespace the source system skips around a date before parsing.
_ASCII_EDGE_WS = r"\A\s+|\s+\z"

# Shapes a date text must have before a parse is attempted: parsing a text of
# the wrong shape costs an exception per row.
_DMY_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]+$"
_YMD_SHAPE = r"^[0-9]+-[0-9]{1,2}-[0-9]{1,2}$"

# Strict day/month/4-digit-year text: one- or two-digit day and month, a day
# may also be written as space + digit.
_DMY_STRICT = r"^(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])/(1[0-2]|0[1-9]|[1-9])/([0-9]{4})$"


def safe_date(c: Column | str) -> Column:
    """SAFE_DATE: blank -> NULL, else d/m/y, else y-m-d, else NULL.

    One-digit day and month are accepted, a two-digit year stays year 20, an
    impossible date (31/02) is NULL. Never raises under ANSI mode.
    """
    raw = _col(c)
    text = F.regexp_replace(raw, _ASCII_EDGE_WS, "")
    parsed = F.when(text.rlike(_DMY_SHAPE), F.try_to_date(text, "d/M/y")).when(
        text.rlike(_YMD_SHAPE), F.try_to_date(text, "y-M-d")
    )
    return F.when(is_blank(raw), F.lit(None).cast("date")).otherwise(parsed)


def matches_dmy_format(c: Column | str) -> Column:
    """True when text is a valid calendar date written as %d/%m/%Y.

    Mirrors strptime: whole-string match, four-digit year, real date.
    """
    raw = _col(c)
    day = F.regexp_extract(raw, _DMY_STRICT, 1)
    month = F.regexp_extract(raw, _DMY_STRICT, 2)
    year = F.regexp_extract(raw, _DMY_STRICT, 3)
    iso = F.concat_ws("-", year, F.lpad(F.trim(month), 2, "0"), F.lpad(F.trim(day), 2, "0"))
    return raw.rlike(_DMY_STRICT) & F.try_to_date(iso, "yyyy-MM-dd").isNotNull() & (year != "0000")


def month_start(year: Column | str, month: Column | str) -> Column:
    """MAKE_DATE(ano, mes, 1)."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def quarter_start(year: Column | str, quarter: Column | str) -> Column:
    """MAKE_DATE(ano, (trimestre - 1) * 3 + 1, 1)."""
    return F.make_date(_col(year), (_col(quarter) - 1) * 3 + 1, F.lit(1))
