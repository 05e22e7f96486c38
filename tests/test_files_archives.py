"""File lists, selection, ZIP members, audit, checksums, skip."""

import hashlib
import io
import zipfile

from pyspark.sql import functions as F

from regline.plans.ingest import read_release, resolve_inputs
from regline.sources import archives, files, text


def zip_bytes(members: dict) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members.items():
            zf.writestr(name, data)
    return buf.getvalue()


def test_missing_file_among_several(spark, write_files):
    d = write_files({"A0.csv": b"x\ny\n", "A1.csv": b"z\n"})
    lines, status = text.read_file_list(spark, d, ["A0.csv", "A1.csv", "A9.csv"])
    assert lines.count() == 3
    assert {r.file_name: r.status for r in status.collect()} == {"A0.csv": "ok", "A1.csv": "ok", "A9.csv": "missing"}


def test_dataset_selection(spark, write_files):
    d = write_files({"Empresas0.zip": b"", "Empresas1.zip": b"", "Socios3.zip": b"", "Cnaes.zip": b""})
    rows = {r.file_name: (r.dataset, r.part_no, r.selected) for r in text.dataset_files(spark, d, families=["Empresas"]).collect()}
    assert rows == {"Empresas0.zip": ("Empresas", 0, True), "Empresas1.zip": ("Empresas", 1, True),
                    "Socios3.zip": ("Socios", 3, False), "Cnaes.zip": ("Cnaes", None, False)}


def test_zip_members(spark, write_files):
    d = write_files({
        "Empresas0.zip": zip_bytes({"Empresas0.csv": b"a\r\nb\xe7\r\n\r\nc", "X.CSV": b"skip\n"}),
        "Empresas1.zip": b"not a zip at all",
    })
    inputs = resolve_inputs(spark, d)
    assert len(inputs.zips) == 2 and not inputs.text
    got = sorted((r.file_name, r.line) for r in read_release(spark, inputs).collect())
    assert got == [("Empresas0.csv", "a"), ("Empresas0.csv", "bç"), ("Empresas0.csv", "c")]


def test_plain_files_and_archives_are_both_read(spark, write_files):
    d = write_files({"Empresas0.zip": zip_bytes({"Empresas0.csv": b"zipped\n"}), "Empresas1.csv": b"plain\n", "Socios0.csv": b"x\n"})
    inputs = resolve_inputs(spark, d, names=None)
    assert sorted(r.line for r in read_release(spark, inputs).collect()) == ["plain", "zipped"]
    assert inputs.left_out == ("Socios0.csv",)


def test_a_release_without_a_part_is_incomplete(spark, write_files):
    d = write_files({f"Empresas{i}.{'csv' if i % 2 else 'zip'}": b"" for i in range(10) if i != 7})
    assert resolve_inputs(spark, d).missing == ()
    assert resolve_inputs(spark, d, complete=True).missing == ("Empresas7.zip",)
    from regline.layout import release_files

    assert len(release_files()) == 36


def test_an_archive_is_left_out_by_size_only_on_request(spark, write_files, tmp_path):
    from conftest import GOOD, record_line

    from regline.plans.ingest import ingest

    d = write_files({"Empresas0.zip": zip_bytes({"Empresas0.csv": record_line(GOOD) + b"\n"})})
    s = ingest(spark, d, str(tmp_path / "a"), max_total_bytes=10).stats.first()
    assert (s.files_read, s.files_failed, s.records_written, s.errors) == (0, 1, 0, 1)
    s = ingest(spark, d, str(tmp_path / "b")).stats.first()
    assert (s.files_read, s.files_failed, s.records_written) == (1, 0, 1)


def test_a_damaged_member_fails_alone_and_is_tried_again(spark, write_files, tmp_path):
    from conftest import GOOD, record_line

    from regline.plans.ingest import ingest

    lines = b"".join(record_line({**GOOD, 0: f"{i:08d}"}) + b"\r\n" for i in range(300))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("Empresas0.csv", lines)
    whole = buf.getvalue()
    at = len(whole) // 3
    d = write_files({"Empresas0.zip": whole[:at] + bytes(40) + whole[at + 40 :],
                     "Empresas1.zip": zip_bytes({"Empresas1.csv": record_line({**GOOD, 0: "99999999"}) + b"\n"})})
    target, ledger = str(tmp_path / "t"), str(tmp_path / "ledger")
    first = ingest(spark, d, target, ledger_path=ledger).stats.first()
    assert (first.files_read, first.files_failed) == (1, 1) and first.errors >= 1
    (tmp_path / "in" / "Empresas0.zip").write_bytes(whole)
    second = ingest(spark, d, target, ledger_path=ledger)
    assert (second.stats.first().files_read, second.stats.first().files_failed) == (1, 0)
    assert second.table(spark).select("cnpj").distinct().count() == second.table(spark).count() == 301


def test_the_same_name_and_length_in_another_folder_is_new(spark, tmp_path):
    from conftest import GOOD, record_line

    from regline.plans.ingest import ingest

    target, ledger = str(tmp_path / "t"), str(tmp_path / "ledger")
    written = []
    for month, ident in (("m1", "00000001"), ("m2", "00000002")):
        (tmp_path / month).mkdir()
        (tmp_path / month / "Empresas0.csv").write_bytes(record_line({**GOOD, 0: ident}) + b"\n")
        written.append(ingest(spark, str(tmp_path / month), target, ledger_path=ledger).stats.first().records_written)
    named = ingest(spark, str(tmp_path / "m1"), target, ledger_path=ledger, names=["Empresas0.csv"]).stats.first()
    assert written == [1, 1] and (named.files_read, named.files_failed, named.errors) == (0, 0, 0)


def test_archive_limit_exactly_ten_gib_passes(spark):
    df = spark.createDataFrame([(True, 10 * 1024**3), (True, 10 * 1024**3 + 1), (False, 0)], "is_zip boolean, total bigint")
    got = [r.v for r in df.select(archives.verdict(F.col("is_zip"), F.col("total")).alias("v")).collect()]
    assert got == ["ok", "oversize", "not_zip"]


def test_archive_audit(spark, write_files):
    d = write_files({"E0.zip": zip_bytes({"E0.csv": b"12345", "R.CSV": b"12"}), "Bad.zip": b"nope"})
    got = {r.archive: (r.is_zip, r.members, r.csv_members, r.total_bytes, r.verdict)
           for r in archives.archive_audit(spark, d).collect()}
    assert got == {"E0.zip": (True, 2, 1, 7, "ok"), "Bad.zip": (False, 0, 0, 0, "not_zip")}
    small = {r.archive: r.verdict for r in archives.archive_audit(spark, d, max_total_bytes=6).collect()}
    assert small["E0.zip"] == "oversize"


def test_cache_listing_sorted_and_missing_folder(spark, write_files, tmp_path):
    d = write_files({"b.zip": b"12", "a.zip": b"1", "c.txt": b""})
    assert [r.file_name for r in files.cache_listing(spark, d).collect()] == ["a.zip", "b.zip"]
    assert files.cache_listing(spark, str(tmp_path / "nowhere")).count() == 0


def test_checksums(spark, write_files):
    d = write_files({"a.csv": b"hello world", "b.csv": b"x", "c.csv": b""})
    manifest = spark.createDataFrame(
        [("a.csv", hashlib.sha256(b"hello world").hexdigest()), ("b.csv", "0" * 64), ("z.csv", "1" * 64)],
        "file_name string, expected_sha256 string",
    )
    got = {r.file_name: r.status for r in files.verify_checksums(spark, d, manifest).collect()}
    assert got == {"a.csv": "ok", "b.csv": "mismatch", "c.csv": "unchecked", "z.csv": "missing"}
    lengths = {r.file_name: r.length for r in text.list_files(spark, d).collect()}
    assert lengths == {"a.csv": 11, "b.csv": 1, "c.csv": 0}


def test_skip_already_ingested(spark, write_files):
    d = write_files({"a.csv": b"1", "b.csv": b"22", "c.csv": b"333"})
    listing = text.list_files(spark, d).select("file_name", "length")
    ledger = spark.createDataFrame([("a.csv", 1, None), ("b.csv", 5, None)], "file_name string, length bigint, sha256 string")
    assert sorted(r.file_name for r in files.not_yet_ingested(listing, ledger).collect()) == ["b.csv", "c.csv"]


def test_ledger_takes_only_new_archives(spark, write_files, tmp_path):
    from conftest import GOOD, record_line

    from regline.plans.ingest import ingest

    d = write_files({"Empresas0.zip": zip_bytes({"Empresas0.csv": record_line(GOOD) + b"\r\n"})})
    ledger = str(tmp_path / "ledger")
    first = ingest(spark, d, str(tmp_path / "t1"), ledger_path=ledger).stats.first()
    assert (first.files_read, first.records_written) == (1, 1)
    again = ingest(spark, d, str(tmp_path / "t2"), ledger_path=ledger).stats.first()
    assert (again.files_read, again.lines_read) == (0, 0)
    (tmp_path / "in" / "Empresas1.zip").write_bytes(zip_bytes({"Empresas1.csv": record_line({**GOOD, 0: "87654321"}) + b"\n"}))
    third = ingest(spark, d, str(tmp_path / "t3"), ledger_path=ledger).stats.first()
    assert (third.files_read, third.records_written) == (1, 1)


def test_large_compressed_member_is_spread(spark, write_files):
    import zipfile as z

    buf = io.BytesIO()
    with z.ZipFile(buf, "w", compression=z.ZIP_DEFLATED) as zf:
        zf.writestr("Empresas0.csv", b"".join(b"line %d\r\n" % i for i in range(500)))
    d = write_files({"Empresas0.zip": buf.getvalue()})
    paths = [r.path for r in text.list_files(spark, d).collect()]
    assert archives.plan_archives(spark, paths).spread is None  # small member: no shuffle
    n = archives.plan_archives(spark, paths, spread_bytes=100).spread
    assert n is not None and n >= 8
    lines = archives.read_zip_lines(spark, paths, spread_bytes=100)
    assert lines.rdd.getNumPartitions() == n
    assert sorted(r.line for r in lines.collect()) == sorted(f"line {i}" for i in range(500))


def test_unreadable_archive_counts_as_failed_file(spark, write_files, tmp_path):
    from conftest import GOOD, record_line

    from regline.plans.ingest import ingest

    d = write_files({
        "Empresas0.zip": zip_bytes({"Empresas0.csv": record_line(GOOD) + b"\r\n"}),
        "Empresas1.zip": b"this is not an archive",
    })
    s = ingest(spark, d, str(tmp_path / "t")).stats.first()
    assert (s.files_read, s.files_failed, s.records_written, s.errors) == (1, 1, 1, 1)


def test_hadoop_schemes_map_to_arrow():
    from regline.sources.fs import arrow_uri

    assert arrow_uri("s3a://bucket/rel/Empresas0.zip") == "s3://bucket/rel/Empresas0.zip"
    assert arrow_uri("hdfs://name/rel/a.csv") == "hdfs://name/rel/a.csv"  # other schemes stay as they are
    assert arrow_uri("file:/tmp/a.csv") == "file:/tmp/a.csv"
