"""The index of stored keys, alone and under a load and a stream."""

import pytest
from conftest import record_line

from regline.operators import keys as key_module
from regline.operators.keys import KeyIndex
from regline.plans.ingest import ingest
from regline.streaming.incremental import incremental_ingest, read_ingested


def stored(spark, path, values):
    spark.createDataFrame([(v, "x") for v in values], "cnpj string, uf string").coalesce(1).write.mode("append").parquet(path)


def table_of(spark, tmp_path, values):
    spark.createDataFrame([(v,) for v in values], "cnpj string").write.parquet(path := str(tmp_path / "asked"))
    return spark.read.parquet(path)


@pytest.fixture
def index(spark, tmp_path):
    return lambda **more: KeyIndex(spark, str(tmp_path / "keys"), str(tmp_path / "table"), **more)


def all_keys(index):
    return sorted(r.cnpj for r in index.keys().collect())


def test_each_file_is_indexed_once(spark, tmp_path, index):
    assert index(buckets=4).catch_up() == 0 and all_keys(index()) == []
    stored(spark, str(tmp_path / "table"), ["1", "2", None])
    assert index().catch_up() == 1 and index().catch_up() == 0
    stored(spark, str(tmp_path / "table"), ["3", "2"])
    again = index()
    assert again.catch_up() == 1 and all_keys(again) == ["1", "2", "2", "3"] and again.buckets == 4
    records = spark.createDataFrame([("2", 1), ("4", 2), (None, 3), ("4", 4)], "cnpj string, n int")
    assert sorted(r.n for r in again.unseen(records).collect()) == [2, 3, 4]
    assert again.unseen(records.where("false")).count() == 0


def test_files_left_for_later(spark, tmp_path, index):
    stored(spark, str(tmp_path / "table/batch_id=0"), ["1"])
    stored(spark, str(tmp_path / "table/batch_id=1"), ["2"])
    it = index()
    assert it.catch_up(apart_from="/batch_id=1/") == 1 and all_keys(it) == ["1"]
    assert it.catch_up() == 1 and all_keys(it) == ["1", "2"]


def test_a_failure_between_keys_and_list_of_files_does_no_harm(spark, tmp_path, index, monkeypatch):
    stored(spark, str(tmp_path / "table"), ["1", "2"])
    it = index()

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "_cover", fails)
        with pytest.raises(RuntimeError):
            it.catch_up()
    after = index()
    assert after.catch_up() == 1 and set(all_keys(after)) == {"1", "2"}
    assert sorted(r.cnpj for r in after.found(table_of(spark, tmp_path, ["1", "9"])).collect()) == ["1"]


def test_compaction_sizes_the_buckets_and_survives_reopening(spark, tmp_path, index, monkeypatch):
    monkeypatch.setattr(key_module, "COMPACT_FILES", 3)
    monkeypatch.setattr(key_module, "BUCKET_KEYS", 40)
    it = index(buckets=2)
    for k in range(7):
        stored(spark, str(tmp_path / "table"), [f"{i:014d}" for i in range(30 * k, 30 * k + 40)])
        it.catch_up()
        assert len(it.keys().inputFiles()) < 3 * it.buckets + it.buckets
    it.compact(bucket_keys=40)
    assert len(it.keys().inputFiles()) == it.buckets == 6  # 220 keys
    assert all_keys(index()) == [f"{i:014d}" for i in range(220)] and index().catch_up() == 0


def test_the_index_is_not_shuffled_and_few_keys_prune_to_their_buckets(spark, tmp_path, index, monkeypatch):
    stored(spark, str(tmp_path / "table"), [f"{i:014d}" for i in range(500)])
    it = index(buckets=16)
    it.catch_up()
    asked = table_of(spark, tmp_path, [f"{i:014d}" for i in (3, 499, 900)])
    few = it.found(asked)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: " in plan and int(plan.split("SelectedBucketsCount: ")[1].split(" ")[0]) <= 3
    assert sorted(r.cnpj for r in few.collect()) == [f"{i:014d}" for i in (3, 499)]
    monkeypatch.setattr(key_module, "FILTER_KEYS", 0)
    many = it.found(asked)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert any(it.location in f for f in many.inputFiles()) and not any("/table/" in f for f in many.inputFiles())
    assert sorted(r.cnpj for r in many.collect()) == [f"{i:014d}" for i in (3, 499)]


def line(number, name="n"):
    return record_line({0: f"{number:08d}", 1: "0001", 2: "00", 4: name, 32: "U1"})


def test_a_second_load_reads_the_index_and_not_the_table(spark, write_files, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    root = write_files({"Empresas0.csv": b"\n".join(line(i) for i in range(50))})
    ingest(spark, root, target)
    write_files({"Empresas1.csv": b"\n".join(line(i, "later") for i in range(40, 60))})
    seen = []
    monkeypatch.setattr(KeyIndex, "found", lambda self, keys, f=KeyIndex.found: seen.append(f(self, keys)) or seen[-1])
    second = ingest(spark, root, target, names=["Empresas1.csv"])
    table = second.table(spark)
    assert table.count() == 60 and table.where("razao_social = 'later'").count() == 10
    assert second.stats.first().already_stored == 10
    read = seen[0].inputFiles()
    assert any(f"{target}/keys/" in f for f in read) and not any(f"{target}/table/" in f for f in read)


def test_a_stream_indexes_each_batch_and_leaves_no_staged_lines(spark, write_files, tmp_path):
    target, ckpt = str(tmp_path / "target"), str(tmp_path / "ckpt")
    root = write_files({"Empresas0.csv": b"\n".join(line(i) for i in range(30))})
    assert incremental_ingest(spark, root, target, ckpt) == 1
    write_files({"Empresas1.csv": b"\n".join(line(i, "later") for i in range(20, 50))})
    assert incremental_ingest(spark, root, target, ckpt) == 1
    got = read_ingested(spark, target)
    assert got.count() == 50 and got.where("razao_social = 'later'").count() == 20
    assert not list((tmp_path / "target/_staging").rglob("outcome=accepted"))
