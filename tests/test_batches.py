"""Chunks of an exact size, and sinks that take whole batches or none."""

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import functions as F

from regline.session import fresh_dir
from regline.sinks import batches
from regline.sinks.batches import ParquetTarget, Refused, Target


def numbers(spark, n, parts):
    return spark.range(0, n, 1, parts).select(F.col("id").alias("k"), F.format_string("%05d", "id").alias("name"))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_chunks_are_full_and_follow_the_order(spark, parts):
    mixed = numbers(spark, 103, parts).repartition(parts, "name")
    got = batches.with_chunks(mixed, 10, ["k"]).collect()
    assert sorted((r.k, r.chunk) for r in got) == [(k, k // 10) for k in range(103)]


@pytest.mark.parametrize("parts", [1, 5])
def test_chunks_without_an_order_are_full_too(spark, parts):
    sizes = batches.with_chunks(numbers(spark, 57, parts), 25).groupBy("chunk").count().collect()
    assert sorted((r.chunk, r["count"]) for r in sizes) == [(0, 25), (1, 25), (2, 7)]


def test_chunks_of_nothing_and_of_no_size(spark):
    assert batches.with_chunks(numbers(spark, 0, 1), 10).count() == 0
    with pytest.raises(ValueError):
        batches.with_chunks(numbers(spark, 3, 1), 0)


def test_one_file_for_each_chunk(spark):
    path = fresh_dir(spark, "chunk-files")
    batches.write_chunks(numbers(spark, 31, 4), path, 8, ["k"])
    files = spark.read.parquet(path).groupBy("chunk", F.col("_metadata.file_path")).count().collect()
    assert sorted((int(r.chunk), r["count"]) for r in files) == [(0, 8), (1, 8), (2, 8), (3, 7)]


def test_chunk_files_are_alone_in_their_folders_and_listed_by_few_tasks(spark):
    path = fresh_dir(spark, "chunk-files")
    batches.write_chunks(numbers(spark, 401, 3), path, 2, ["k"])
    names = [p.name for p in Path(path.removeprefix("file:")).rglob("*") if p.is_file() and p.name != "_SUCCESS"]
    assert len(names) == 201 and all(n.endswith(".parquet") for n in names)  # none beside them, as checksums are
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("list-chunks", "")
    rows = batches.read_chunks(spark, path, "chunk bigint, k bigint, name string")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("list-chunks")]
    listed = [tracker.getStageInfo(i).numTasks for j in jobs for i in j.stageIds]
    assert listed and max(listed) <= 4 * spark.sparkContext.defaultParallelism
    files = rows.groupBy("chunk").agg(F.min("k"), F.max("name"), F.count("k"), F.count_distinct("_metadata.file_path")).collect()
    assert sorted(map(tuple, files)) == [(c, 2 * c, f"{min(2 * c + 1, 400):05d}", 2 - (c == 200), 1) for c in range(201)]


@pytest.mark.parametrize("options", [{}, {"compression": "zstd"}])
def test_chunk_files_keep_types_and_large_chunks(spark, options):
    from pyspark.testing import assertDataFrameEqual

    path = fresh_dir(spark, "chunk-files")
    rows = spark.range(0, 30_000, 1, 3).selectExpr(
        "id", "if(id % 3 = 0, null, cast(id / 100 as decimal(15,2))) AS d", "timestamp_seconds(id) AS t", "date_from_unix_date(int(id)) AS day",
        "array(struct(id AS a, string(id) AS b)) AS s", "cast(string(id) as binary) AS raw", "id / 7 AS x",
    )
    batches.write_chunks(rows, path, 25_000, ["id"], **options)
    got = spark.read.parquet(path)
    assert {(r.chunk, r["count"]) for r in got.groupBy(F.col("chunk").cast("int").alias("chunk")).count().collect()} == {(0, 25_000), (1, 5_000)}
    assert got.drop("chunk").schema.simpleString() == rows.schema.simpleString()
    assertDataFrameEqual(got.drop("chunk"), rows)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        batches.write_chunks(rows, path, 25_000, **options)


def test_chunk_files_of_nothing_and_of_an_attempt_that_was_lost(spark):
    path = fresh_dir(spark, "chunk-files")
    batches.write_chunks(numbers(spark, 0, 1), path, 8, ["k"])
    assert batches.read_chunks(spark, path, "chunk bigint, k bigint").count() == 0
    writer = batches.ChunkWriter({"path": fresh_dir(spark, "chunk-files"), "codec": "snappy"})
    batch = pa.record_batch({"k": [1, 2, 3], "chunk": [0, 0, 1]})
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))  # two attempts of one task
    writer.commit([kept, None])
    assert lost.chunks == kept.chunks == [0, 1]
    assert sorted(map(tuple, batches.read_chunks(spark, writer.path, "k bigint, chunk bigint").collect())) == [(1, 0), (2, 0), (3, 1)]


def test_a_refused_batch_is_set_aside_and_the_others_stay(spark):
    path = fresh_dir(spark, "sink")
    rows = numbers(spark, 50, 3).withColumn("name", F.when(F.col("k").isin(12, 33), "far too wide").otherwise(F.col("name")))
    batches.send_batches(rows, path, size=10, order_by=["k"], widths={"name": 5})
    assert batches.sink_counters(spark, path).first().asDict() == {
        "batches_sent": 3, "batches_failed": 2, "records_written": 30, "records_refused": 20,
    }
    kept = {r.k for r in batches.read_sink(spark, path, "k bigint, name string").collect()}
    assert kept == {*range(10), *range(20, 30), *range(40, 50)}
    refused = batches.read_sink(spark, path, "k bigint, name string, _batch bigint", refused=True).collect()
    assert {(r.k, r._batch) for r in refused} == {(k, k // 10) for k in [*range(10, 20), *range(30, 40)]}
    report = {r.batch: (r.rows, r.sent, r.error) for r in batches.batch_report(spark, path).collect()}
    assert report == {0: (10, True, None), 1: (10, False, "name"), 2: (10, True, None), 3: (10, False, "name"), 4: (10, True, None)}


def test_writes_add_up_and_a_write_under_its_name_is_replaced(spark):
    path = fresh_dir(spark, "sink")
    batches.send_batches(numbers(spark, 5, 1), path, size=2, load="a")
    batches.send_batches(numbers(spark, 7, 1), path, size=2, load="b")
    assert batches.read_sink(spark, path, "k bigint").count() == 12
    batches.send_batches(numbers(spark, 5, 1), path, size=2, load="a")
    assert batches.read_sink(spark, path, "k bigint").count() == 12
    assert batches.sink_counters(spark, path).first().batches_sent == 7


def test_a_sink_that_breaks_leaves_nothing_to_read(spark):
    class Breaks(ParquetTarget):
        def put(self, batch):
            super().put(batch)
            raise OSError("the disk is gone")

    path = fresh_dir(spark, "sink")
    batches.send_batches(numbers(spark, 4, 1), path, size=2)
    with pytest.raises(PythonException, match="the disk is gone"):
        batches.send_batches(numbers(spark, 4, 1), path, Breaks, size=2)
    assert batches.read_sink(spark, path, "k bigint").count() == 4


def test_a_sink_of_ones_own(spark):
    class OddOnly(Target):
        """Takes batches whose first key is odd."""

        def send(self, batch):
            if batch.column("k")[0].as_py() % 2 == 0:
                raise Refused("even")

    path = fresh_dir(spark, "sink")
    batches.send_batches(numbers(spark, 9, 2), path, OddOnly, size=3, order_by=["k"])
    report = {r.batch: r.error for r in batches.batch_report(spark, path).collect()}
    assert report == {0: "even", 1: None, 2: "even"}


def test_load_ready_text_and_an_empty_write(spark):
    path = fresh_dir(spark, "sink")
    rows = numbers(spark, 6, 2).select("k", F.concat_ws("\t", "k", "name").alias("value"))
    batches.send_batches(rows.where("k < 0"), path, batches.CopyTextTarget, size=4)
    assert batches.read_copy_sink(spark, path).count() == 0
    batches.send_batches(rows, path, batches.CopyTextTarget, size=4)
    assert {r.value for r in batches.read_copy_sink(spark, path).collect()} == {f"{k}\t{k:05d}" for k in range(6)}


def test_numbering_neither_sorts_nor_deals_out_the_records(spark):
    plan = batches.with_chunks(numbers(spark, 20, 4), 6)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
