"""Plain files that cannot be read to their end."""

import struct
import zlib

import pytest
from conftest import record_line

from regline.plans import ingest as ingest_module
from regline.plans.ingest import ingest, read_ledger
from regline.sources import text


def lines(numbers, end=b"\r\n"):
    return b"".join(record_line({0: f"{n:08d}", 1: "0001", 2: "00", 32: "U1"}) + end for n in numbers)


def checksums(data, wrong_from=None):
    """Hadoop's checksum file of ``data``; chunks from ``wrong_from`` on don't match."""
    chunks = [data[i : i + 512] for i in range(0, len(data), 512)]
    sums = [zlib.crc32(c) ^ (wrong_from is not None and i >= wrong_from) for i, c in enumerate(chunks)]
    return b"crc\x00" + struct.pack(">i", 512) + b"".join(struct.pack(">I", s) for s in sums)


def test_an_unreadable_file_is_counted_and_the_others_load(spark, write_files, tmp_path):
    target, ledger = str(tmp_path / "target"), str(tmp_path / "ledger")
    bad = lines([3, 4])
    root = write_files({
        "Empresas0.csv": lines([1, 2]) + lines([5], end=b""), "Empresas1.csv": bad, ".Empresas1.csv.crc": checksums(bad, 0),
        "Empresas2.zip": b"PK\x03\x04 cut", "Empresas3.csv": b"", "Empresas4.csv": b"\r\n\n" + lines([6], end=b"\n"),
    })
    first = ingest(spark, root, target, ledger_path=ledger)
    got = first.stats.first()
    assert (got.files_failed, got.files_read, got.records_written, got.errors) == (2, 3, 4, 2)
    assert sorted(r.file_name for r in read_ledger(spark, ledger).collect()) == ["Empresas0.csv", "Empresas3.csv", "Empresas4.csv"]
    # Mended, it's loaded by the next run.
    write_files({".Empresas1.csv.crc": checksums(bad)})
    second = ingest(spark, root, target, ledger_path=ledger)
    got = second.stats.first()
    assert (got.files_failed, got.files_read, got.records_written) == (1, 1, 2)
    assert sorted(int(r.cnpj[:8]) for r in second.table(spark).collect()) == [1, 2, 3, 4, 5, 6]


def test_a_file_that_breaks_off_counts_as_failed(spark, write_files, tmp_path):
    data = lines(range(4000))
    root = write_files({"Empresas0.csv": data, ".Empresas0.csv.crc": checksums(data, len(data) // 512 - 1), "Empresas1.csv": lines([9001])})
    loaded = ingest(spark, root, str(tmp_path / "target"))
    got = loaded.stats.first()
    assert (got.files_failed, got.files_read) == (1, 1) and 1 <= got.records_written < 4001
    assert loaded.table(spark).where("cnpj LIKE '00009001%'").count() == 1


def test_an_error_that_has_passed_fails_the_load_and_leaves_nothing(spark, write_files, tmp_path, monkeypatch):
    bad = lines([3, 4])
    root = write_files({"Empresas0.csv": lines([1]), "Empresas1.csv": bad, ".Empresas1.csv.crc": checksums(bad, 0)})
    monkeypatch.setattr(ingest_module, "short_files", lambda *args: [])
    with pytest.raises(RuntimeError, match="run the load again"):
        ingest(spark, root, str(tmp_path / "target"))
    from regline.sinks.tables import read_partitioned

    assert read_partitioned(spark, str(tmp_path / "target/table")).count() == 0


def test_a_file_that_cannot_be_opened(spark, write_files, tmp_path, monkeypatch):
    from regline.sources import fs

    root = write_files({"Empresas0.csv": lines([1]), "Empresas1.csv": lines([2])})

    def opens(uri, original=fs.open_input):
        if uri.endswith("Empresas1.csv"):
            raise PermissionError(uri)
        return original(uri)

    monkeypatch.setattr(fs, "open_input", opens)
    got = ingest(spark, root, str(tmp_path / "target")).stats.first()
    assert (got.files_failed, got.files_read, got.records_written) == (1, 1, 1)


@pytest.mark.parametrize("end", [b"", b"\n", b"\r\n", b"\r"])
def test_expected_bytes_are_those_of_the_lines(spark, write_files, end):
    root = write_files({"a.csv": b"one\n\n\r\ntwo" + end, "b.csv": b"", "c d.csv": b"\n"})
    files = text.list_files(spark, root).collect()
    expected = text.expected_bytes(files)
    assert text.short_files(spark, expected) == []
    total = text.read_raw(spark, list(expected)).agg(text.line_bytes()).first()[0]
    assert total == sum(expected.values())
