"""Incremental ingest (R1) with bounded intake (R2) on Structured Streaming.

The stream is one of files, not of lines: the file source lists plain files
and archives, its checkpoint remembers which were taken, and only their names
travel (the content column is pruned, so nothing is read for it). Each
micro-batch is then one load of its files, by the same code as a batch load,
and one commit of the same table: ``sinks.commits``. A micro-batch that is
replayed after a failure finds its commit, or starts over in a new folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.layout import EMPRESAS, Layout
from regline.operators.records import REASONS
from regline.operators.stats import STATS_SCHEMA
from regline.plans.ingest import Inputs, load_inputs, staged_schema
from regline.sinks.commits import Commits
from regline.sinks.tables import table_schema
from regline.sources import fs

#: What Spark's reader of whole files gives; a stream has to be told.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: A load's id ends with the number of its micro-batch, a try's name with one part more.
STREAM_LOAD = r"^stream-[0-9a-f]+-(\d+)(-|$)"


def stream_files(
    spark: SparkSession,
    source_dir: str,
    glob: str = "*.{csv,zip}",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder (path, file_name, length, modification_time). Empty files hold no line and do not appear."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(source_dir).select(
        "path",
        F.substring_index("path", "/", -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )


def stream_load_id(checkpoint: str, batch_id: int) -> str:
    """The id of a micro-batch's load: the stream's own id, which its checkpoint keeps, and the batch's number."""
    with fs.open_input(f"{checkpoint.rstrip('/')}/metadata") as stream:
        query = json.loads(stream.read())["id"]
    return f"stream-{query.replace('-', '')[:12]}-{batch_id:06d}"


def _batch_loader(target: str, checkpoint: str, done: set[int], **how):
    """``done`` gets the ids of the micro-batches loaded (the function runs on the driver)."""

    def load(batch: DataFrame, batch_id: int) -> None:
        load_id = stream_load_id(checkpoint, batch_id)
        if not Commits(f"{target}/table").committed(load_id):
            files = sorted(batch.collect(), key=lambda f: f.path)  # file metadata, as the source's own log holds it
            load_inputs(batch.sparkSession, Inputs(files), target, load_id, **how)
        done.add(batch_id)

    return load


def incremental_ingest(
    spark: SparkSession,
    source_dir: str,
    target: str,
    checkpoint: str,
    layout: Layout = EMPRESAS,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    deduplicate: bool = True,
    skip_stored_keys: bool = True,
    timeout_secs: int | None = None,
    glob: str = "*.{csv,zip}",
    batch_size: int = 100_000,
) -> int:
    """R1 + R2: one ``availableNow`` run over plain files and archives not yet
    taken; returns the number of micro-batches it ran. It takes as long as it
    needs unless ``timeout_secs`` is given. ``target`` may be that of batch
    loads: with ``skip_stored_keys`` no key is stored that any of them holds.

    A file that cannot be read to its end counts as failed, and the others
    load; the checkpoint has it as taken, so it is loaded again only by a batch
    load or under another name.
    """
    files = stream_files(spark, source_dir, glob, max_files_per_trigger, max_bytes_per_trigger)
    done: set[int] = set()
    loader = _batch_loader(
        target, checkpoint, done, layout=layout, deduplicate=deduplicate, against_stored=skip_stored_keys, batch_size=batch_size
    )
    query = (
        files.writeStream.foreachBatch(loader)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(timeout_secs)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"incremental ingest did not finish in {timeout_secs}s")
    if query.exception():
        raise query.exception()
    return len(done)


def read_ingested(spark: SparkSession, target: str, layout: Layout = EMPRESAS) -> DataFrame:
    """The stored table and, for records that a stream brought, the number of their micro-batch."""
    batch = F.regexp_extract("load", STREAM_LOAD, 1)
    return Commits(f"{target}/table").read(spark, table_schema(layout)).select(
        *layout.names, F.when(batch != "", batch).cast("bigint").alias("batch_id")
    )


def load_counters(spark: SparkSession, target: str) -> DataFrame:
    """M1 of every load and micro-batch committed to ``target``: its id, ``batch_id`` for a stream's, and its counters.

    They were observed in the passes that wrote the data and are part of the
    commit, so a replay counts once.
    """
    batch = F.regexp_extract("load", STREAM_LOAD, 1)
    counters = Commits(f"{target}/table").counters(spark, STATS_SCHEMA)
    return counters.withColumn("batch_id", F.when(batch != "", batch).cast("bigint"))


def read_quarantine(spark: SparkSession, target: str, layout: Layout = EMPRESAS) -> DataFrame:
    """Rejected lines of every committed load and micro-batch."""
    rejected = " + ".join(f"rejected_{reason}" for reason in REASONS)
    loads = load_counters(spark, target).where(f"{rejected} > 0").select("load").collect()
    schema = staged_schema(layout).rsplit(",", 1)[0]  # the folders named below are those of one outcome
    folders = [f"{target}/loads/{row.load}/outcome=rejected" for row in loads]
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.select("file_path", "file_name", "line", "n_fields", "reason", "detail")
