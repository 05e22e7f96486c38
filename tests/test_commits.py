"""Loads and micro-batches as commits of one table."""

import io
import zipfile

import pytest
from conftest import record_line

from regline.operators.keys import KeyIndex
from regline.plans import ingest as ingest_module
from regline.plans.ingest import ingest
from regline.sinks.commits import Commits
from regline.sinks.tables import read_partitioned
from regline.streaming import incremental
from regline.streaming.incremental import incremental_ingest, load_counters, read_ingested, read_quarantine


def line(number, name="n", uf="U1"):
    return record_line({0: f"{number:08d}", 1: "0001", 2: "00", 4: name, 32: uf})


def lines(*numbers, **more):
    return b"\r\n".join(line(n, **more) for n in numbers) + b"\r\n"


def zipped(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, data in members.items():
            zf.writestr(name, data)
    return buf.getvalue()


def keys(table):
    return sorted(int(r.cnpj[:8]) for r in table.select("cnpj").collect())


def test_a_load_that_fails_before_its_commit_is_not_seen(spark, write_files, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    root = write_files({"Empresas0.csv": lines(1, 2)})
    ingest(spark, root, target)
    write_files({"Empresas1.csv": lines(3, 4)})

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Commits, "commit", fails)
        with pytest.raises(RuntimeError, match="lost"):
            ingest(spark, root, target)
    assert len(list((tmp_path / "target/table").glob("load=*"))) == 2
    assert keys(read_partitioned(spark, f"{target}/table")) == [1, 2]
    # Nor does the key index take its keys: the same load again stores them.
    again = ingest(spark, root, target)
    assert keys(again.table(spark)) == [1, 2, 3, 4] and again.stats.first().records_written == 2


def test_a_replayed_micro_batch_adds_nothing_and_a_failed_one_is_replaced(spark, write_files, tmp_path, monkeypatch):
    target, ckpt = str(tmp_path / "target"), str(tmp_path / "ckpt")
    root = write_files({"Empresas0.csv": lines(1, 2)})

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Commits, "commit", fails)
        with pytest.raises(Exception, match="lost"):
            incremental_ingest(spark, root, target, ckpt)
    assert read_ingested(spark, target).count() == 0
    assert incremental_ingest(spark, root, target, ckpt) == 1
    table = tmp_path / "target/table"
    assert len(list(table.glob("load=*"))) == 1 and len(list(table.glob("_commits/*.json"))) == 1
    assert not list((tmp_path / "target/loads").rglob("outcome=accepted"))
    # The checkpoint forgets that batch 0 was finished, as after a crash right behind the commit.
    for done in (tmp_path / "ckpt/commits").iterdir():
        done.unlink()
    assert incremental_ingest(spark, root, target, ckpt) == 1
    assert keys(read_ingested(spark, target)) == [1, 2] and load_counters(spark, target).count() == 1


def test_batch_stream_and_batch_share_one_table(spark, write_files, tmp_path):
    target, ckpt = str(tmp_path / "target"), str(tmp_path / "ckpt")
    root = write_files({"Empresas0.csv": lines(1, 2, uf="AA") + b"short;line\r\n"})
    ingest(spark, root, target)
    write_files({"Empresas1.zip": zipped({"a.csv": lines(2, 3, uf="BB"), "b.csv": lines(4, uf="01")})})
    assert incremental_ingest(spark, root, target, ckpt) == 1
    write_files({"Empresas2.csv": lines(4, 5, name="later", uf="AA")})
    last = ingest(spark, root, target)
    got = last.table(spark)
    assert keys(got) == [1, 2, 3, 4, 5] and keys(got.where("uf = '01'")) == [4] and keys(got.where("razao_social = 'later'")) == [5]
    assert {r.cnpj[7]: r.batch_id for r in read_ingested(spark, target).collect()} == {"1": None, "2": None, "3": 0, "4": 0, "5": None}
    # One filter on uf leaves only that value's folders of each load.
    scan = got.where("uf = 'AA'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uf" in scan
    counters = {r.batch_id: r for r in load_counters(spark, target).where("batch_id IS NOT NULL").collect()}
    assert (counters[0].files_read, counters[0].records_written) == (2, 2)
    assert (counters[0].duplicates_dropped, counters[0].already_stored) == (1, 2)  # 2 comes twice in the batch; 1 and 2 are stored
    assert [r.file_name for r in read_quarantine(spark, target).collect()] == ["Empresas0.csv"] * 3


def test_archives_come_in_rounds_and_a_damaged_one_is_counted(spark, write_files, tmp_path):
    target, ckpt = str(tmp_path / "target"), str(tmp_path / "ckpt")
    root = write_files({"A.zip": zipped({"a.csv": lines(1, 2)}), "B.zip": b"no archive", "notes.txt": lines(9)})
    assert incremental_ingest(spark, root, target, ckpt) == 1
    write_files({"C.zip": zipped({"c.csv": lines(2, 3), "d.txt": lines(8)}), "D.csv": lines(4)})
    assert incremental_ingest(spark, root, target, ckpt, max_files_per_trigger=1) == 2
    assert incremental_ingest(spark, root, target, ckpt) == 0
    assert keys(read_ingested(spark, target)) == [1, 2, 3, 4]
    rows = sorted(load_counters(spark, target).collect(), key=lambda r: r.batch_id)
    assert [(r.files_read, r.files_failed) for r in rows] == [(1, 1), (1, 0), (1, 0)]


def test_the_stream_lists_files_and_reads_no_content(spark, write_files, monkeypatch, tmp_path):
    root = write_files({"A.csv": lines(1)})
    plans = []

    def keep(target, checkpoint, done, **how):
        return lambda batch, batch_id: plans.append((batch.columns, batch.collect()[0].asDict()))

    monkeypatch.setattr(incremental, "_batch_loader", keep)
    incremental_ingest(spark, root, str(tmp_path / "target"), str(tmp_path / "ckpt"))
    [(columns, row)] = plans
    assert columns == ["path", "file_name", "length", "modification_time"] and row["file_name"] == "A.csv"
    # Content over this limit is an error where it's read.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1")
    try:
        incremental_ingest(spark, root, str(tmp_path / "target"), str(tmp_path / "ckpt2"))
        assert len(plans) == 2
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_a_folder_that_no_commit_names_is_refused(spark, write_files, tmp_path):
    target = str(tmp_path / "target")
    spark.createDataFrame([("1",)], "cnpj string").write.parquet(f"{target}/table/other")
    with pytest.raises(ValueError, match="no commit names"):
        ingest(spark, write_files({"Empresas0.csv": lines(1)}), target)


def test_loads_without_records_are_commits_too(spark, write_files, tmp_path):
    target = str(tmp_path / "target")
    root = write_files({"Empresas0.csv": b"short;line\r\n", "Empresas1.csv": b""})
    first = ingest(spark, root, target)
    assert first.table(spark).count() == 0 and first.table(spark).columns == ingest_module.EMPRESAS.names
    write_files({"Empresas1.csv": lines(7)})
    second = ingest(spark, root, target)
    assert keys(second.table(spark)) == [7] and load_counters(spark, target).count() == 2
    index = KeyIndex(spark, f"{target}/keys", second.table_path)
    index.catch_up()
    assert [r.cnpj[:8] for r in index.keys().collect()] == ["00000007"]
