"""V5, D1, T1."""

import datetime as dt
from decimal import Decimal

from regline.layout import EMPRESAS
from regline.operators.quality import dedupe, duplicate_report, typed_view, with_check_digit


def records_df(spark, rows):
    cols = ["file_path", "line"] + EMPRESAS.names
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in cols))


def test_check_digits(spark):
    df = spark.createDataFrame([("40506070000211",), ("40506070000194",), ("405060700001AB",), (None,)], "cnpj string")
    got = {r.cnpj: r.dv_status for r in with_check_digit(df).collect()}
    assert got == {"40506070000211": "ok", "40506070000194": "bad", "405060700001AB": "not_checkable", None: None}


def test_dedupe_keeps_same_winner(spark):
    rows = [
        {"file_path": "b", "line": "x", "cnpj": "1", "razao_social": "from b"},
        {"file_path": "a", "line": "z", "cnpj": "1", "razao_social": "from a z"},
        {"file_path": "a", "line": "y", "cnpj": "1", "razao_social": "from a y"},
        {"file_path": "a", "line": "q", "cnpj": "2", "razao_social": "only"},
    ]
    for order in (rows, rows[::-1]):
        got = {r.cnpj: r.razao_social for r in dedupe(records_df(spark, order).repartition(3)).collect()}
        assert got == {"1": "from a y", "2": "only"}


def test_duplicate_report(spark):
    df = records_df(spark, [{"cnpj": "1"}, {"cnpj": "1"}, {"cnpj": "2"}])
    assert [(r.cnpj, r.copies) for r in duplicate_report(df).collect()] == [("1", 2)]


def test_typed_view(spark):
    rows = [
        {"cnpj": "1", "data_abertura": "20201301", "data_situacao_cadastral": "20200101", "opcao_mei": "S",
         "opcao_simples_nacional": "X", "capital_social": "100000,50"},
        {"cnpj": "2", "data_abertura": "00000000", "capital_social": "abc"},
        {"cnpj": "3", "data_abertura": "19990215", "opcao_mei": "N", "capital_social": "100000.00"},
    ]
    got = {r.cnpj: r for r in typed_view(records_df(spark, rows)).collect()}
    assert got["1"].data_abertura is None
    assert got["1"].data_situacao_cadastral == dt.date(2020, 1, 1)
    assert got["1"].opcao_mei is True and got["1"].opcao_simples_nacional is None
    assert got["1"].capital_social == Decimal("100000.50")
    assert got["1"].cast_errors == "data_abertura,opcao_simples_nacional"
    assert got["2"].cast_errors == "data_abertura,capital_social"
    assert got["3"].data_abertura == dt.date(1999, 2, 15) and got["3"].opcao_mei is False
    assert got["3"].cast_errors is None


def test_against_stored_both_paths(spark):
    from regline.operators.quality import against_stored

    new = records_df(spark, [{"cnpj": "1"}, {"cnpj": "2"}, {"cnpj": "2"}, {"cnpj": "3"}])
    stored = records_df(spark, [{"cnpj": "2"}, {"cnpj": "9"}])
    for threshold in ("10m", "-1"):  # broadcast joins, then shuffled ones
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = sorted(r.cnpj for r in against_stored(new, stored).collect())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == ["1", "3"]


def test_dedupe_without_duplicates_is_a_plain_projection(spark):
    df = records_df(spark, [{"file_path": "a", "cnpj": str(i)} for i in range(5)])
    out = dedupe(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sorted(r.cnpj for r in out.collect()) == [str(i) for i in range(5)]


def test_null_key_is_one_group(spark):
    df = records_df(spark, [{"file_path": "b", "cnpj": None, "razao_social": "x"},
                            {"file_path": "a", "cnpj": None, "razao_social": "y"},
                            {"file_path": "a", "cnpj": "1"}])
    got = sorted((str(r.cnpj), str(r.razao_social)) for r in dedupe(df).collect())
    assert got == [("1", "None"), ("None", "y")]
