"""S9-S13, D7, D10, M1-M3."""

from conftest import GOOD, record_line

from regline.layout import EMPRESAS
from regline.operators.stats import batches_for, stats_frame, with_rates
from regline.plans.ingest import ingest
from regline.sinks import export, tables


def one_record(spark, **values):
    row = tuple(values.get(c) for c in EMPRESAS.names)
    return spark.createDataFrame([row], ", ".join(f"{c} string" for c in EMPRESAS.names))


REF = dict(cnpj="40506070000211", razao_social="Padaria do Porto", cnae_fiscal="1091101", situacao_cadastral="08",
           data_situacao_cadastral="20110315", uf="PE", codigo_municipio="2611606", cep="50030230",
           ddd_telefone_1="81", data_abertura="19990704", natureza_juridica="2135",
           qualificacao_representante_legal="05", opcao_simples_nacional="S", opcao_mei="N",
           capital_social="2500.50")


def test_copy_text_line(spark):
    line = export.copy_text(one_record(spark, **REF)).first().value
    parts = line.split("\t")
    assert len(parts) == 22
    assert parts[0] == "40506070000211" and parts[9] == "\\N" and parts[21] == "2500.50"
    assert parts.count("\\N") == 7


def test_copy_text_escapes(spark):
    line = export.copy_text(one_record(spark, cnpj="1", razao_social="a\tb\\c\nd\re")).first().value
    assert line.split("\t")[1] == "a\\tb\\\\c\\nd\\re"


def test_batches():
    assert batches_for(3, 3) == 1 and batches_for(4, 2) == 2 and batches_for(0, 100) == 0
    assert batches_for(1000, 100_000) == 1 and batches_for(100_001, 100_000) == 2


def test_rates(spark):
    s = stats_frame(spark, {"records_processed": 1000, "records_written": 1000, "bytes_read": 1048576})
    r = with_rates(s, 1.5).first()
    assert round(r.records_per_sec, 2) == 666.67 and round(r.mb_per_sec, 2) == 0.67
    zero = with_rates(s, 0.0).first()
    assert zero.records_per_sec == 0.0 and zero.mb_per_sec == 0.0


def test_max_records_per_file(spark, tmp_path):
    df = spark.range(10).selectExpr("cast(id as string) as cnpj", "'SP' as uf").coalesce(1)
    path = str(tmp_path / "out")
    df.write.option("maxRecordsPerFile", 4).parquet(path)
    per_file = sorted(r.rows for r in tables.rows_per_file(spark, path).collect())
    assert per_file == [2, 4, 4]


def test_ensure_table_twice_and_append(spark, tmp_path):
    name = "t_ensure"
    loc = str(tmp_path / "t")
    tables.ensure_table(spark, name, location=loc)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (x STRING) USING parquet LOCATION '{loc}2'")
    tables.append(one_record(spark, **REF), name)
    got = spark.table(name).first()
    assert got.cnpj == "40506070000211" and got.uf == "PE"
    assert set(spark.table(name).columns) == set(EMPRESAS.names)
    spark.sql(f"DROP TABLE {name}")


def test_varchar_limit_enforced_on_table(spark, tmp_path):
    import pytest

    name = "t_width"
    tables.ensure_table(spark, name, location=str(tmp_path / "w"))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|length"):
        tables.append(one_record(spark, **{**REF, "cep": "405060709"}), name)
    spark.sql(f"DROP TABLE {name}")


def test_csv_and_parquet_roundtrip(spark, tmp_path):
    rec = one_record(spark, **{**REF, "razao_social": ' a "quoted", \\ name\t'})
    for fmt in ("parquet", "csv", "json"):
        path = str(tmp_path / fmt)
        export.write_export(rec, path, fmt)
        back = export.read_export(spark, path, fmt, rec.schema).select(*EMPRESAS.names)
        assert back.collect() == rec.collect(), fmt


def test_ingest_end_to_end(spark, write_files, tmp_path):
    good2 = {**GOOD, 0: "87654321"}
    data = (record_line(GOOD) + b"\r\n") * 2 + record_line(good2) + b"\n" + b"short\r\n\r\n" + record_line({**GOOD, 29: "405060709"}) + b"\n"
    root = write_files({"Empresas0.csv": data, "Empresas1.csv": b"", "Socios0.csv": b"ignored\n"})
    res = ingest(spark, root, str(tmp_path / "target"), batch_size=1)
    s = res.stats.first()
    assert (s.lines_read, s.records_processed, s.records_written, s.duplicates_dropped) == (5, 3, 2, 1)
    assert (s.rejected_too_few_fields, s.rejected_overwide, s.errors, s.files_read, s.batches_sent) == (1, 1, 2, 2, 3)
    assert s.bytes_read == len(data)
    assert sorted(r.cnpj for r in res.table(spark).collect()) == ["40506070000211", "87654321000211"]
    q = {r.reason for r in res.quarantine(spark).collect()}
    assert q == {"too_few_fields", "overwide"}


def test_missing_named_file_counts_as_failed(spark, write_files, tmp_path):
    root = write_files({"Empresas0.csv": record_line(GOOD) + b"\n"})
    res = ingest(spark, root, str(tmp_path / "t"), names=["Empresas0.csv", "Empresas7.csv"])
    s = res.stats.first()
    assert (s.files_read, s.files_failed, s.records_written, s.errors) == (1, 1, 1, 1)


def test_ingest_code_table_with_caller_layout(spark, write_files, tmp_path):
    from regline.layout import code_table_layout

    data = "0001;Agricultura\r\n0002;Pesca\r\n0001;Agricultura\r\nsem código\r\n".encode("latin-1")
    root = write_files({"CNAEs.csv": data})
    res = ingest(spark, root, str(tmp_path / "t"), layout=code_table_layout(), families=("CNAEs",))
    got = sorted(tuple(r) for r in res.table(spark, code_table_layout()).collect())
    assert got == [("0001", "Agricultura"), ("0002", "Pesca")]
    s = res.stats.first()
    assert (s.lines_read, s.rejected_too_few_fields, s.duplicates_dropped) == (4, 1, 1)


def test_command_line(spark, write_files, tmp_path, capsys):
    import json

    from regline.__main__ import main

    root = write_files({"Empresas0.csv": record_line(GOOD) + b"\r\n" + b"x\r\n"})
    assert main(["ingest", root, str(tmp_path / "t"), "--batch-size", "10"]) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (stats["records_written"], stats["rejected_too_few_fields"], stats["batches_sent"]) == (1, 1, 1)
    assert main(["export", str(tmp_path / "t" / "table"), str(tmp_path / "copy"), "--format", "copy"]) == 0
    assert spark.read.text(str(tmp_path / "copy")).first().value.startswith("40506070000211\t")
    assert main(["status", root]) == 0
    assert "0 archive(s)" in capsys.readouterr().out


def test_ingest_with_filter_and_trim(spark, write_files, tmp_path):
    data = b"".join(
        record_line({**GOOD, 0: f"{i:08d}", 4: f"  Nome {i}\t", 14: "02" if i % 2 else "08"}) + b"\r\n" for i in range(6)
    )
    root = write_files({"Empresas0.csv": data})
    res = ingest(spark, root, str(tmp_path / "t"), trim=True, record_filter="situacao_cadastral = '02'")
    rows = sorted((r.cnpj[:8], r.razao_social) for r in res.table(spark).collect())
    assert rows == [("00000001", "Nome 1"), ("00000003", "Nome 3"), ("00000005", "Nome 5")]
    s = res.stats.first()
    assert (s.records_processed, s.records_written, s.records_filtered, s.duplicates_dropped) == (6, 3, 3, 0)


def test_filter_and_copies_are_counted_apart(spark, write_files, tmp_path):
    data = (record_line({**GOOD, 14: "02"}) + b"\n") * 3 + record_line({**GOOD, 0: "00000001", 14: "08"}) + b"\n"
    res = ingest(spark, write_files({"Empresas0.csv": data}), str(tmp_path / "t"), record_filter="situacao_cadastral = '02'")
    s = res.stats.first()
    assert (s.records_written, s.duplicates_dropped, s.records_filtered, s.already_stored) == (1, 2, 1, 0)


def test_clean_load_has_an_empty_quarantine_and_leaves_no_staging(spark, write_files, tmp_path):
    import os

    res = ingest(spark, write_files({"Empresas0.csv": record_line(GOOD) + b"\n"}), str(tmp_path / "t"))
    assert res.quarantine(spark).count() == 0 and res.table(spark).count() == 1
    kept = {d for d, _, files in os.walk(tmp_path / "t") if any(f.endswith(".parquet") for f in files)}
    assert all("/table/" in d for d in kept)


def test_loads_add_to_one_table_and_the_smallest_line_wins(spark, tmp_path):
    def folder(name, files):
        (tmp_path / name).mkdir()
        for file, rows in files.items():
            lines = b"".join(record_line({**GOOD, 0: i, 4: n}) + b"\r\n" for i, n in rows)
            (tmp_path / name / file).write_bytes(lines)
        return str(tmp_path / name)

    first = folder("a", {"Empresas0.csv": [("00000001", "ZZZ"), ("00000001", "AAA"), ("00000002", "x")],
                         "Empresas1.csv": [("00000002", "b"), ("00000003", "c")]})
    second = folder("b", {"Empresas0.csv": [("00000003", "late"), ("00000004", "d"), ("00000004", "a")]})
    target = str(tmp_path / "t")
    ingest(spark, first, target)
    res = ingest(spark, second, target)
    s = res.stats.first()
    assert (s.records_written, s.duplicates_dropped, s.already_stored) == (1, 1, 1)
    got = sorted((r.cnpj[7], r.razao_social) for r in res.table(spark).collect())
    assert got == [("1", "AAA"), ("2", "x"), ("3", "c"), ("4", "a")]
    # The same rule on parsed records.
    from regline.operators import quality, records
    from regline.sources.text import read_lines

    kept = quality.dedupe(records.accepted(records.classify(read_lines(spark, first)), lineage=True))
    assert sorted((r.cnpj[7], r.razao_social) for r in kept.collect()) == [("1", "AAA"), ("2", "x"), ("3", "c")]


def test_command_line_audit(spark, write_files, tmp_path, capsys):
    import hashlib

    from regline.__main__ import main

    root = write_files({"Empresas0.zip": b"not a zip", "Empresas0.csv": b"abc"})
    manifest = tmp_path / "SHA256SUMS"
    manifest.write_text(f"{hashlib.sha256(b'abc').hexdigest()}  Empresas0.csv\n{'0' * 64}  Empresas0.zip\n")
    assert main(["audit", root, "--manifest", str(manifest)]) == 0
    out = capsys.readouterr().out
    assert "Empresas0.zip\tnot_zip" in out
    assert "Empresas0.csv\tok" in out and "Empresas0.zip\tmismatch" in out
