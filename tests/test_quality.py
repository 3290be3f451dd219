from conftest import bronze_rows
from test_silver import BASE

from postolake.operators.quality import default_suite, run_suite, suite_success, unexpected_values


def results(spark, rows, **kw):
    return {r["ordinal"]: r for r in run_suite(bronze_rows(spark, rows), **kw).collect()}


def test_all_pass(spark):
    res = results(spark, [BASE, dict(BASE, estado_sigla="RJ")])
    assert len(res) == 7 and all(r["success"] for r in res.values())
    assert suite_success(run_suite(bronze_rows(spark, [BASE]))).first()["success"] is True


def test_each_failure_and_nulls_ignored(spark):
    rows = [
        BASE,
        dict(BASE, estado_sigla=None, produto=None),  # Q1, Q2 fail; Q4 ignores the NULL
        dict(BASE, data_coleta="2020-03-05"),  # Q3
        dict(BASE, estado_sigla="sp"),  # Q4
        dict(BASE, unidade_medida="R$ / galão"),  # Q5
        dict(BASE, regiao_sigla="XX"),  # Q7
        dict(BASE, regiao_sigla=None),  # ignored by Q7
    ]
    res = results(spark, rows)
    assert [res[i]["unexpected_count"] for i in range(1, 8)] == [1, 1, 1, 1, 1, 0, 1]
    assert [res[i]["success"] for i in range(1, 8)] == [False, False, False, False, False, True, False]
    assert res[4]["missing_count"] == 1 and res[4]["unexpected_percent"] == 100.0 / 6
    assert res[1]["unexpected_percent"] == 100.0 / 7
    top = unexpected_values(bronze_rows(spark, rows)).collect()
    assert {(r["ordinal"], r["value"]) for r in top} == {
        (1, None), (2, None), (3, "2020-03-05"), (4, "sp"), (5, "R$ / galão"), (7, "XX")
    }


def test_missing_column_and_first_file(spark):
    df = bronze_rows(spark, [BASE, dict(BASE, estado_sigla="zz", filename="b.csv")]).drop("CNPJ da Revenda")
    res = {r["ordinal"]: r for r in run_suite(df).collect()}
    assert res[6]["success"] is False and res[6]["unexpected_count"] is None
    first = {r["ordinal"]: r for r in run_suite(df, sample="first").collect()}
    assert first[4]["success"] is True and first[4]["element_count"] == 1
    ext = run_suite(bronze_rows(spark, [BASE]), default_suite(include_products=True, include_columns=True))
    assert ext.count() == 9 and all(r["success"] for r in ext.collect())
