"""Spark SQL surface: gold tables as views, cleaning rules as SQL functions.

Users who query the star schema in SQL keep doing so: ``register_gold_views``
exposes the five gold tables under their usual names, and
``register_sql_functions`` defines SQL functions that mirror the Column
functions (same rules, plain SQL bodies) plus ``FIX_UNICODE``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from postolake.functions.text import SPACE_SEPARATORS
from postolake.functions.unicode_fix import register as register_fix_unicode
from postolake.operators.gold import Gold

GOLD_VIEW_NAMES = {
    "dim_data": "dim_data",
    "dim_produto": "dim_produto",
    "dim_localidade": "dim_localidade",
    "dim_posto": "dim_posto",
    "fact": "fact_precos_combustivel",
}


def register_gold_views(spark: SparkSession, gold: Gold, prefix: str = "") -> None:
    for attr, view in GOLD_VIEW_NAMES.items():
        getattr(gold, attr).createOrReplaceTempView(prefix + view)


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPACES = _sql_str(SPACE_SEPARATORS)
_NUMBER = _sql_str(
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
)
_DMY_SHAPE = _sql_str(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]+$")
_YMD_SHAPE = _sql_str(r"^[0-9]+-[0-9]{1,2}-[0-9]{1,2}$")
_EDGE_WS = _sql_str(r"\A\s+|\s+\z")

_WIDE = ", ".join(_sql_str(ch) for ch in SPACE_SEPARATORS if ch != " ")
# Same fast path as the Column function: byte-level ASCII trim, full set trim
# only when an edge character is a wider space separator.
_TRIM = (
    f"CASE WHEN substring(trim(s), 1, 1) IN ({_WIDE}) OR substring(trim(s), -1, 1) IN ({_WIDE}) "
    f"THEN trim(BOTH {_SPACES} FROM trim(s)) ELSE trim(s) END"
)

SQL_FUNCTIONS = {
    "clean_text": f"(s STRING) RETURNS STRING RETURN upper({_TRIM})",
    "trim_spaces": f"(s STRING) RETURNS STRING RETURN {_TRIM}",
    "digits_only": r"(s STRING) RETURNS STRING RETURN regexp_replace(s, '\\D', '')",
    "br_decimal": (
        "(s STRING) RETURNS DOUBLE RETURN CASE WHEN replace(replace(s, '.', ''), ',', '.') "
        f"RLIKE {_NUMBER} THEN try_cast(replace(replace(s, '.', ''), ',', '.') AS DOUBLE) END"
    ),
    "safe_date": (
        f"(s STRING) RETURNS DATE RETURN CASE WHEN length(trim(BOTH {_SPACES} FROM s)) = 0 THEN NULL "
        f"WHEN regexp_replace(s, {_EDGE_WS}, '') RLIKE {_DMY_SHAPE} "
        f"THEN try_to_date(regexp_replace(s, {_EDGE_WS}, ''), 'd/M/y') "
        f"WHEN regexp_replace(s, {_EDGE_WS}, '') RLIKE {_YMD_SHAPE} "
        f"THEN try_to_date(regexp_replace(s, {_EDGE_WS}, ''), 'y-M-d') END"
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Define the SQL functions (temporary, session scope); returns their names."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    register_fix_unicode(spark)
    return [*SQL_FUNCTIONS, "FIX_UNICODE"]
