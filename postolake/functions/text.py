"""Text cleaning as Column expressions (JVM side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (general category Zs), which
# TRIM strips at either end; TAB and other controls are not among them.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_WIDE_SPACES = [ch for ch in SPACE_SEPARATORS if ch != " "]


def trim_spaces(c: Column | str) -> Column:
    """TRIM that strips Unicode space separators but keeps tabs.

    Plain spaces are trimmed on the byte-level fast path; the character-set
    trim (which walks every character) runs only for the rare value whose
    first or last character is still a wider space separator such as NBSP.
    """
    ascii_trimmed = F.trim(_col(c))
    wide_edge = F.substring(ascii_trimmed, 1, 1).isin(_WIDE_SPACES) | F.substring(
        ascii_trimmed, -1, 1
    ).isin(_WIDE_SPACES)
    return F.when(wide_edge, F.trim(ascii_trimmed, F.lit(SPACE_SEPARATORS))).otherwise(ascii_trimmed)


def clean_text(c: Column | str) -> Column:
    """UPPER(TRIM(x)); whitespace-only input becomes '' (not NULL)."""
    return F.upper(trim_spaces(c))


def digits_only(c: Column | str) -> Column:
    """Keep ASCII digits only (CNPJ, CEP); leading zeros are kept."""
    return F.regexp_replace(_col(c), r"\D", "")


def strip_nul(c: Column | str) -> Column:
    """Remove NUL characters, which downstream stores reject."""
    return F.replace(_col(c), F.lit("\u0000"), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """NULLIF(x, '')."""
    return F.nullif(_col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """LENGTH(TRIM(x)) = 0 (NULL for NULL input)."""
    return F.length(trim_spaces(c)) == 0


def label_or_default(c: Column | str, default: str) -> Column:
    """COALESCE(NULLIF(x, ''), default)."""
    return F.coalesce(blank_to_null(c), F.lit(default))
