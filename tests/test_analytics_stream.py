"""D2-D6, D8, D9, R1, R2, and the driver contract."""

import os

import pytest
from conftest import GOOD, record_line

from regline.layout import EMPRESAS
from regline.operators import analytics, releases
from regline.streaming.incremental import incremental_ingest, read_ingested


def recs(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in EMPRESAS.names) for r in rows],
                                 ", ".join(f"{c} string" for c in EMPRESAS.names))


def test_count_by_code_null_group_and_ties(spark):
    df = recs(spark, [{"cnpj": "1", "uf": "SP"}, {"cnpj": "2", "uf": "RJ"}, {"cnpj": "3"}, {"cnpj": "4", "uf": "SP"}])
    assert [(r.uf, r.total) for r in analytics.count_by_code(df, "uf").collect()] == [("SP", 2), (None, 1), ("RJ", 1)]


def test_enrich_and_unknown(spark):
    df = recs(spark, [{"cnpj": "1", "natureza_juridica": "2062"}, {"cnpj": "2", "natureza_juridica": "9999"}, {"cnpj": "3"}])
    dim = spark.createDataFrame([("2062", "Sociedade")], "code string, description string")
    out = {r.cnpj: r.natureza for r in analytics.enrich(df, {"natureza_juridica": (dim, "natureza")}).collect()}
    assert out == {"1": "Sociedade", "2": None, "3": None}
    unk = [(r.code, r.records) for r in analytics.unknown_codes(df, {"natureza_juridica": (dim, "n")}).collect()]
    assert unk == [("9999", 1)]


def test_load_code_tables_plain_and_zip(spark, write_files):
    import io
    import zipfile

    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("CNAEs.csv", "1091101;Desenvolvimento de programas\r\n".encode("latin-1"))
    root = write_files({"Naturezas.csv": "2062;Sociedade Empresária Limitada\r\n".encode("latin-1"),
                        "CNAEs.zip": buf.getvalue()})
    tables_ = analytics.load_code_tables(spark, root)
    assert set(tables_) == {"natureza_juridica", "cnae_fiscal"}
    df = recs(spark, [{"cnpj": "1", "natureza_juridica": "2062", "cnae_fiscal": "1091101"}])
    r = analytics.enrich(df, tables_).first()
    assert r.natureza_descricao == "Sociedade Empresária Limitada"
    assert r.cnae_descricao == "Desenvolvimento de programas"


@pytest.mark.parametrize("zipped", [(), ("Naturezas", "CNAEs"), ("CNAEs", "Municipios", "Naturezas", "Qualificacoes")])
def test_unknown_codes_of_several_files(spark, write_files, zipped):
    import io
    import zipfile

    files = {}
    for family, code in {"Naturezas": "2062", "CNAEs": "1091101", "Municipios": "0000007", "Qualificacoes": "05"}.items():
        data = f"{code};Descrição\r\n".encode("latin-1")
        if family in zipped:
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w") as zf:
                zf.writestr(f"{family}.csv", data)
            files[f"{family}.zip"] = buf.getvalue()
        else:
            files[f"{family}.csv"] = data
    known = {"natureza_juridica": "2062", "cnae_fiscal": "1091101", "codigo_municipio": "0000007",
             "qualificacao_representante_legal": "05"}
    df = recs(spark, [known, {**known, "cnae_fiscal": "9"}, {**known, "cnae_fiscal": "9", "codigo_municipio": "8"}, {}])
    unknown = analytics.unknown_codes(df, analytics.load_code_tables(spark, write_files(files)))
    assert sorted(map(tuple, unknown.collect())) == [("cnae_fiscal", "9", 2), ("codigo_municipio", "8", 1)]


def test_code_table_unknown_equals_its_sql(spark, tmp_path):
    import duckdb

    from regline.plans import catalog, oracle

    con = duckdb.connect()
    for table, rows in {
        "customer": "SELECT k AS c_custkey, 'C' || k AS c_name, CAST(k % 40 AS INTEGER) AS c_nationkey, 1.5 * k AS c_acctbal "
                    "FROM (SELECT unnest(range(1, 120) || [3, 58]) AS k)",
        "nation": "SELECT CAST(range AS INTEGER) AS n_nationkey, 'N' || range AS n_name FROM range(25)",
        "region": "SELECT CAST(range AS INTEGER) AS r_regionkey, 'R' || range AS r_name FROM range(5)",
    }.items():
        con.execute(f"CREATE TABLE {table} AS {rows}")
        con.execute(f"COPY {table} TO '{tmp_path}/{table}.parquet'")
    got = catalog.QUERIES["code_table_unknown"](spark, str(tmp_path))
    want = con.execute(oracle.oracle_sql()["code_table_unknown"]).fetchall()
    assert len({column for column, _, _ in want}) == 4  # every code column has codes that its table lacks
    assert sorted(map(tuple, got.select("code_column", "code", "records").collect())) == sorted(want)


def test_lookup_and_search(spark):
    df = recs(spark, [{"cnpj": f"{i:014d}", "razao_social": f"Acme {i}", "uf": "SP" if i % 2 else "RJ"} for i in range(10)])
    ids = spark.createDataFrame([("00000000000003",), ("00000000000003",), ("99",)], "cnpj string")
    for threshold in ("10m", "-1"):  # broadcast ids + scan, then shuffle joins
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = sorted((r.cnpj, r.found) for r in analytics.lookup(df, ids).collect())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == [("00000000000003", True), ("99", False)]
    page1 = [r.cnpj for r in analytics.search_page(df, "ACME", {"uf": "SP"}, size=2).collect()]
    page2 = [r.cnpj for r in analytics.search_page(df, "acme", {"uf": "SP"}, after=page1[-1], size=2).collect()]
    assert page1 == ["00000000000001", "00000000000003"] and page2 == ["00000000000005", "00000000000007"]
    assert analytics.lookup_one(df, "00000000000005").count() == 1


def test_diff_and_apply(spark):
    old = recs(spark, [{"cnpj": "1", "razao_social": "a"}, {"cnpj": "2", "razao_social": "b"}, {"cnpj": "3"}])
    new = recs(spark, [{"cnpj": "2", "razao_social": "B"}, {"cnpj": "3"}, {"cnpj": "4", "razao_social": "d"}])
    diff = releases.release_diff(old, new)
    assert {r.cnpj: r.change for r in diff.collect()} == {"1": "deleted", "2": "updated", "3": "unchanged", "4": "inserted"}
    snap = releases.apply_diff(old, diff)
    assert sorted(map(tuple, snap.collect())) == sorted(map(tuple, new.collect()))


def test_incremental_ingest_takes_only_new_files(spark, tmp_path):
    watched, target, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(watched)

    def put(name, ids):
        with open(os.path.join(watched, name), "wb") as f:
            for i in ids:
                f.write(record_line({**GOOD, 0: f"{i:08d}"}) + b"\r\n")

    put("Empresas0.csv", [1, 2, 2])
    assert incremental_ingest(spark, watched, target, ckpt) == 1
    put("Empresas1.csv", [3, 1])  # id 1 was stored by the first run
    put("Empresas2.csv", [4])
    assert incremental_ingest(spark, watched, target, ckpt, max_files_per_trigger=1) == 2
    assert incremental_ingest(spark, watched, target, ckpt) == 0
    got = sorted(r.cnpj[:8] for r in read_ingested(spark, target).collect())
    assert got == ["00000001", "00000002", "00000003", "00000004"]


def test_bytes_per_trigger_bounds_intake(spark, tmp_path):
    watched, target, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(watched)
    for f in range(3):
        with open(os.path.join(watched, f"Empresas{f}.csv"), "wb") as out:
            out.write(record_line({**GOOD, 0: f"{f + 1:08d}"}) + b"\r\n")
    # Each file is larger than the budget, so every micro-batch takes one file.
    assert incremental_ingest(spark, watched, target, ckpt, max_bytes_per_trigger=10) == 3
    assert read_ingested(spark, target).count() == 3


def test_more_micro_batches_than_the_progress_history(spark, tmp_path):
    watched, target, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(watched)
    for f in range(5):
        with open(os.path.join(watched, f"Empresas{f}.csv"), "wb") as out:
            out.write(record_line({**GOOD, 0: f"{f + 1:08d}"}) + b"\r\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert incremental_ingest(spark, watched, target, ckpt, max_files_per_trigger=1) == 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_an_unreadable_table_is_an_error(spark, tmp_path):
    import pytest

    watched, target, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(watched)
    with open(os.path.join(watched, "Empresas0.csv"), "wb") as out:
        out.write(record_line(GOOD) + b"\r\n")
    os.makedirs(f"{target}/table/batch_id=0")
    with open(f"{target}/table/batch_id=0/part-0.parquet", "wb") as out:
        out.write(b"this is no Parquet file")
    with pytest.raises(Exception, match="Parquet|FAILED_READ_FILE|footer|CANNOT_READ_FILE"):
        incremental_ingest(spark, watched, target, ckpt)


def test_entry_contract(spark):
    import __spark_entry__ as e

    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 40
    out = e.entry(spark)
    assert out.columns == ["uf", "total"] and out.count() > 0
