"""Numeric parsing and exact rounding helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postolake.functions.text import _col

# A plain decimal literal, optionally signed, with exponent, surrounded by
# ASCII whitespace; or inf / infinity / nan. Spark's cast alone would also take
# Java suffixes such as '1.5d', which the source system rejects.
_NUMBER = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity|nan))\s*$"
)


def br_decimal(c: Column | str) -> Column:
    """Brazilian number text ('1.234,56') to DOUBLE.

    Dots are dropped and the comma becomes the decimal point, then the text is
    cast; unparseable text gives NULL. '5.29' therefore reads as 529.0, as in
    the source system.
    """
    text = F.replace(F.replace(_col(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def exact_mean(c: Column | str, digits: int = 3) -> Column:
    """ROUND(AVG(x), digits), half away from zero, independent of sum order.

    The mean is taken on DECIMAL(24,6) values: the sum is exact and the single
    division keeps 20 fractional digits, so the final rounding never suffers
    from an earlier one. Returns DOUBLE. Aggregate expression.
    """
    value = _col(c).cast("decimal(24,6)")
    total = F.sum(value).cast("decimal(24,6)")
    count = F.count(value).cast("decimal(14,0)")
    return F.round(total / F.nullif(count, F.lit(0).cast("decimal(14,0)")), digits).cast("double")


def exact_percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """ROUND(100 * part / whole, digits) on exact decimals, as DOUBLE."""
    p = _col(part).cast("decimal(18,0)")
    w = _col(whole).cast("decimal(18,0)")
    return F.round(p * F.lit(100).cast("decimal(3,0)") / w, digits).cast("double")


def ratio_percent(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole in DOUBLE arithmetic (NULL when whole is 0)."""
    return (_col(part).cast("double") * F.lit(100.0).cast("double")) / F.nullif(
        _col(whole).cast("double"), F.lit(0.0).cast("double")
    )
