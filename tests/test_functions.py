import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from postolake.functions import (
    br_decimal,
    clean_text,
    digits_only,
    exact_mean,
    exact_percent,
    matches_dmy_format,
    safe_date,
    strip_nul,
    trim_spaces,
)
from postolake.functions.unicode_fix import fix_unicode, fix_unicode_native, repair_batch


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


def test_clean_text_cases(spark):
    assert one(spark, "  são paulo ", clean_text) == "SÃO PAULO"
    assert one(spark, " sp ", clean_text) == "SP"  # NBSP stripped
    assert one(spark, "\tsp\t", clean_text) == "\tSP\t"  # tab kept
    assert one(spark, "   ", clean_text) == ""  # spaces only -> ''
    assert one(spark, None, clean_text) is None
    assert one(spark, "　x ", trim_spaces) == "x"


def test_digits_only(spark):
    assert one(spark, "12.345.678/0001-90", digits_only) == "12345678000190"
    assert one(spark, "01310-100", digits_only) == "01310100"
    assert one(spark, "", digits_only) == ""


def test_safe_date_cases(spark):
    d = dt.date(2020, 3, 5)
    for text in ["5/3/2020", " 05/03/2020 ", "2020-3-5", "05/03/2020", "2020-03-05"]:
        assert one(spark, text, safe_date) == d, text
    for text in ["31/02/2020", "", "   ", "abc", None, "2020/03/05"]:
        assert one(spark, text, safe_date) is None, text
    assert one(spark, "05/03/20", lambda c: F.year(safe_date(c))) == 20


def test_br_decimal_cases(spark):
    assert one(spark, "1.234,56", br_decimal) == 1234.56
    assert one(spark, "5,29", br_decimal) == 5.29
    assert one(spark, "5.29", br_decimal) == 529.0
    for text in [None, "", "n/d", "1,5d", "abc"]:
        assert one(spark, text, br_decimal) is None, text


def test_strip_nul(spark):
    assert one(spark, "a\x00b", strip_nul) == "ab"


def test_dmy_format(spark):
    ok = ["05/03/2020", "5/3/2020", "31/12/1999", " 5/03/2020"]
    bad = ["2020-03-05", "31/02/2020", "05/03/20", "05/03/2020 ", "1/1/0000", "00/01/2020"]
    for t in ok:
        assert one(spark, t, matches_dmy_format) is True, t
    for t in bad:
        assert one(spark, t, matches_dmy_format) is False, t


def test_exact_mean_and_percent(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.001,), (None,)], "v double")
    assert df.agg(exact_mean("v").alias("m")).first()["m"] == 1.667
    ties = spark.createDataFrame([(0.0005,), (0.0005,)], "v double")
    assert ties.agg(exact_mean("v").alias("m")).first()["m"] == 0.001  # half away from zero
    neg = spark.createDataFrame([(-0.0005,)], "v double")
    assert neg.agg(exact_mean("v").alias("m")).first()["m"] == -0.001
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(exact_mean("v").alias("m")).first()["m"] is None
    p = spark.createDataFrame([(1, 3)], "a long, b long").select(exact_percent("a", "b").alias("p"))
    assert p.first()["p"] == 33.33


def test_fix_unicode(spark):
    broken = "SÃ£o Paulo"
    assert repair_batch(pd.Series([broken, None, "", "Ã", "Ã漢"], index=[9, 3, 5, 7, 1])).tolist() == ["São Paulo", None, "", "Ã", "Ã漢"]
    assert repair_batch(pd.Series(["ﬁ"])).tolist() == ["fi"]  # NFKC
    assert one(spark, broken, fix_unicode) == "São Paulo"
    assert one(spark, broken, fix_unicode_native) == "São Paulo"
    assert one(spark, "São Paulo", fix_unicode_native) == "São Paulo"


def test_sql_functions_agree_with_column_functions(spark):
    from postolake.plans.sql_api import register_sql_functions

    register_sql_functions(spark)
    values = ["  são paulo ", " sp ", "\tsp\t", "   ", None, "5/3/2020", " 2020-3-5 ", "1.234,56", "1,5d",
              "12.345.678/0001-90", "　x ", "31/02/2020"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    df.createOrReplaceTempView("fn_cases")
    sql = spark.sql(
        "SELECT x, clean_text(x) c, trim_spaces(x) t, digits_only(x) d, br_decimal(x) b, safe_date(x) s FROM fn_cases"
    )
    col = df.select(
        "x", clean_text("x").alias("c"), trim_spaces("x").alias("t"), digits_only("x").alias("d"),
        br_decimal("x").alias("b"), safe_date("x").alias("s"),
    )
    key = lambda r: str(r["x"])
    assert sorted(sql.collect(), key=key) == sorted(col.collect(), key=key)
