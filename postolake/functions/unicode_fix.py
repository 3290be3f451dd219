"""Mojibake repair (FIX_UNICODE).

Text whose UTF-8 bytes were once read as latin-1 shows 'Ã' or 'Â' in front of
other characters. The repair normalises to NFKC and then takes the bytes back:
as long as a value still shows one of the two letters, it is written as latin-1
and read as UTF-8, at most ``MAX_ROUNDS`` times; a value that cannot make the
trip keeps its last form.

* ``fix_unicode`` works on whole Arrow batches; each round touches only the
  values that are still suspicious.
* ``fix_unicode_native`` is one round with built-in functions only (stays in
  whole-stage codegen), without the normalisation.
"""

from __future__ import annotations

from functools import partial
from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postolake.functions.text import _col

MAX_ROUNDS = 5
_MARKS = "[ÃÂ]"
_HIGHEST = "\u00ff"  # last character latin-1 can write


def _one_round(values: pd.Series) -> pd.Series:
    """The values that can be read back one step; others are missing from the result."""
    writable = values[values.map(max) <= _HIGHEST]
    taken_back = writable.map(lambda v: v.encode("latin-1").decode("utf-8", "replace"))
    # a replacement character that the value did not hold marks bytes that are no UTF-8
    sound = taken_back.map(lambda v: v.count("\ufffd")) == 0
    return taken_back[sound]


def repair_batch(values: pd.Series) -> pd.Series:
    """Repair a batch of strings; nulls stay null."""
    # not Arrow's utf8_normalize, whose NFKC leaves letters decomposed
    out = values.map(partial(normalize, "NFKC"), na_action="ignore")
    open_ = out[out.str.contains(_MARKS, regex=True, na=False)]
    for _ in range(MAX_ROUNDS):
        if open_.empty:
            break
        better = _one_round(open_)
        out.loc[better.index] = better
        open_ = better[better.str.contains(_MARKS, regex=True, na=False)]
    return out


@F.pandas_udf(StringType())
def fix_unicode(s: pd.Series) -> pd.Series:
    return repair_batch(s)


def fix_unicode_native(c: Column | str) -> Column:
    """Single latin-1 -> UTF-8 round, only where it is safe and needed."""
    x = _col(c)
    latin1_only = x.rlike(r"^[\x{0}-\x{FF}]*$")
    suspicious = x.rlike("[ÃÂ]")
    as_bytes = F.encode(x, "ISO-8859-1")
    repaired = F.when(F.is_valid_utf8(as_bytes.cast("string")), F.decode(as_bytes, "UTF-8"))
    return F.when(suspicious & latin1_only, F.coalesce(repaired, x)).otherwise(x)


def register(spark) -> None:
    """Expose the UDF to SQL as FIX_UNICODE (as the source system does)."""
    spark.udf.register("FIX_UNICODE", fix_unicode)
