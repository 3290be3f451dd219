"""Column functions (scalar operators) of the lakehouse."""

from postolake.functions.dates import matches_dmy_format, month_start, quarter_start, safe_date
from postolake.functions.keys import blank_key_text, row_hash, row_key_text
from postolake.functions.numbers import br_decimal, exact_mean, exact_percent, ratio_percent
from postolake.functions.unicode_fix import fix_unicode, fix_unicode_native
from postolake.functions.text import (
    blank_to_null,
    clean_text,
    digits_only,
    is_blank,
    label_or_default,
    strip_nul,
    trim_spaces,
)

__all__ = [
    "blank_key_text", "blank_to_null", "br_decimal", "clean_text", "digits_only",
    "exact_mean", "exact_percent", "fix_unicode", "fix_unicode_native", "is_blank", "label_or_default", "matches_dmy_format",
    "month_start", "quarter_start", "ratio_percent", "row_hash", "row_key_text",
    "safe_date", "strip_nul", "trim_spaces",
]
