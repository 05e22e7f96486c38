"""Registered queries: one per operator of the inventory, each reading the
driver's tables through registry files that Spark renders from them.

Every callable takes (spark, sf_dir) and returns a DataFrame; the SQL twin
of each lives in plans/oracle.py under the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.layout import EMPRESAS
from regline.operators import analytics, quality, records, releases, stats
from regline.operators.keys import KeyIndex
from regline.plans.fixtures import registry_release
from regline.plans.ingest import IngestResult, ingest
from regline.plans.sizing import buckets_for
from regline.session import fresh_dir, shared_dir, staged
from regline.sinks import batches, export, tables
from regline.sources import archives, files, text
from regline.streaming import incremental

R = EMPRESAS.names


def _root(spark: SparkSession, sf: str, variant: str = "plain") -> str:
    return registry_release(spark, sf, variant)


def _lines(spark: SparkSession, sf: str, variant: str = "plain") -> DataFrame:
    return text.read_lines(spark, _root(spark, sf, variant))


def _classified(spark: SparkSession, sf: str, trim: bool = False, variant: str = "plain") -> DataFrame:
    return records.classify(_lines(spark, sf, variant), trim=trim)


def _accepted(spark: SparkSession, sf: str, lineage: bool = False) -> DataFrame:
    return records.accepted(_classified(spark, sf), lineage=lineage)


def _clean(spark: SparkSession, sf: str, variant: str = "plain") -> DataFrame:
    """Accepted records, one per key, from columnar staging of the parsed lines."""
    return quality.dedupe(staged(records.accepted(_classified(spark, sf, variant=variant), lineage=True), "parsed"))


_LOADED: dict[tuple[str, str, str], IngestResult] = {}


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The table of a finished load: what the analytics queries work on. Loaded once per session."""
    key = (spark.sparkContext.applicationId, shared_dir(spark), sf)
    if key not in _LOADED:
        _LOADED[key] = _ingest(spark, sf)
    return _LOADED[key].table(spark)


# ---- scans and sources ---------------------------------------------------

def q_raw_line_scan(spark, sf):
    return _lines(spark, sf).select("file_name", "line")


def q_drop_blank_lines(spark, sf):
    raw = text.read_lines(spark, _root(spark, sf), keep_blank=True)
    blank = F.col("line") == ""
    return raw.agg(
        F.count_if(blank).cast("bigint").alias("blank_lines"),
        F.count_if(~blank).cast("bigint").alias("kept_lines"),
        F.count_if(F.col("line").rlike("^ +$")).cast("bigint").alias("space_lines"),
    )


def q_multi_file_scan(spark, sf):
    wanted = [f"Empresas{i}.csv" for i in range(5)] + ["Empresas9.csv"]  # every file, plus one missing
    lines, status = text.read_file_list(spark, _root(spark, sf), wanted)
    per_file = lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    return status.join(per_file, "file_name", "left").select(
        "file_name", "status", F.coalesce("n", F.lit(0)).cast("bigint").alias("lines")
    )


def q_dataset_file_selection(spark, sf):
    return text.dataset_files(spark, _root(spark, sf), names=["Empresas1.csv", "Empresas3.csv"]).select(
        "file_name", "dataset", "part_no", "selected"
    )


def q_zip_archive_scan(spark, sf):
    root = _root(spark, sf, "zip")
    paths = [r.path for r in text.list_files(spark, root, "*.zip").select("path").collect()]
    return archives.read_zip_lines(spark, paths).select("file_name", "line")


def q_archive_audit(spark, sf):
    return archives.archive_audit(spark, _root(spark, sf, "zip"))


def q_cache_listing(spark, sf):
    listed = files.cache_listing(spark, _root(spark, sf, "zip"))
    return listed.select("file_name", (F.col("size_mib") * 1024 * 1024 == F.col("length")).alias("size_in_mib"))


def q_sha256_verify(spark, sf):
    wrong = spark.createDataFrame(
        [("Empresas1.csv", "0" * 64), ("Empresas9.csv", "f" * 64)], "file_name string, expected_sha256 string"
    )
    # One file's digest taken in another way.
    right = spark.read.format("binaryFile").load(f"{_root(spark, sf)}/Empresas3.csv").select(
        F.lit("Empresas3.csv").alias("file_name"), F.sha2("content", 256).alias("expected_sha256")
    )
    manifest = wrong.unionByName(right)
    return files.verify_checksums(spark, _root(spark, sf), manifest).select("file_name", "status")


def q_skip_already_ingested(spark, sf):
    root = _root(spark, sf)
    listing = text.list_files(spark, root).select("file_name", "length")
    ledger = listing.where(F.col("file_name").isin("Empresas0.csv", "Empresas1.csv")).unionByName(
        listing.where(F.col("file_name") == "Empresas2.csv").select("file_name", (F.col("length") + 1).alias("length"))
    ).withColumn("sha256", F.lit(None).cast("string"))
    return files.not_yet_ingested(listing, ledger).select("file_name")


# ---- projections and validation -------------------------------------------

def q_split_fields(spark, sf):
    return _classified(spark, sf).groupBy("n_fields").agg(F.count(F.lit(1)).alias("lines"))


def q_assemble_cnpj(spark, sf):
    c = records.classify(_lines(spark, sf), check_widths=False)
    return c.where(F.col("reason").isNull()).select("cnpj")


def q_project_record(spark, sf):
    return _accepted(spark, sf)


def q_empty_to_null(spark, sf):
    acc = _accepted(spark, sf)
    nulls = acc.agg(*[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in R])
    pairs = ", ".join(f"'{c}', `{c}`" for c in R)
    return nulls.selectExpr(f"stack({len(R)}, {pairs}) AS (column_name, nulls)").select(
        "column_name", F.col("nulls").cast("bigint").alias("nulls")
    )


def q_trim_field(spark, sf):
    return records.accepted(_classified(spark, sf, trim=True)).select("cnpj", "razao_social")


def q_decode_text(spark, sf):
    return _accepted(spark, sf).select(
        "cnpj",
        "razao_social",
        F.length("razao_social").cast("bigint").alias("chars"),
        F.octet_length("razao_social").cast("bigint").alias("utf8_bytes"),
    )


def q_min_field_count(spark, sf):
    return records.quarantine(_classified(spark, sf)).where("reason = 'too_few_fields'").select(
        "file_name", "line", "n_fields"
    )


def q_cnpj_part_widths(spark, sf):
    return records.quarantine(_classified(spark, sf)).where("reason = 'bad_cnpj_width'").select("file_name", "line")


def q_reject_routing(spark, sf):
    return records.reason_counts(_classified(spark, sf))


def q_column_width_check(spark, sf):
    return _classified(spark, sf).where("reason = 'overwide'").select("cnpj", "detail")


def q_primary_key_check(spark, sf):
    return quality.duplicate_report(_accepted(spark, sf))


def q_primary_key_dedupe(spark, sf):
    return _clean(spark, sf).select("cnpj", "razao_social", "uf")


# ---- quality, typed view --------------------------------------------------

def q_cnpj_check_digit(spark, sf):
    return quality.with_check_digit(_stored(spark, sf)).select("cnpj", "dv_status")


def q_typed_view(spark, sf):
    return quality.typed_view(_stored(spark, sf))


# ---- the whole load, sinks, statistics -------------------------------------

def _ingest(spark, sf, **kw):
    return ingest(spark, _root(spark, sf), fresh_dir(spark, "ingest"), **kw)


def q_ingest_table(spark, sf):
    return _ingest(spark, sf).table(spark)


def q_import_counters(spark, sf):
    return _ingest(spark, sf, batch_size=100).stats.drop("elapsed_secs", "records_per_sec", "mb_per_sec")


def q_throughput_rates(spark, sf):
    """M2 as facts that hold for any timing."""
    run = _ingest(spark, sf).stats
    zero = stats.with_rates(run.drop("elapsed_secs", "records_per_sec", "mb_per_sec"), 0.0).first()

    def close(a, b):
        return F.abs(a - b) <= F.abs(b) * 1e-9

    return run.select(
        "records_written",
        (F.col("elapsed_secs") > 0).alias("took_time"),
        close(F.col("records_per_sec"), F.col("records_written") / F.col("elapsed_secs")).alias("records_rate_follows"),
        close(F.col("mb_per_sec"), F.col("bytes_read") / 1048576 / F.col("elapsed_secs")).alias("mb_rate_follows"),
        F.lit(zero.records_per_sec == 0.0 and zero.mb_per_sec == 0.0).alias("no_time_gives_zero"),
    )


def q_ingest_zip(spark, sf):
    """The whole load from archives, one of which is no archive."""
    return ingest(spark, _root(spark, sf, "zip"), fresh_dir(spark, "ingest")).table(spark)


def q_import_counters_zip(spark, sf):
    loaded = ingest(spark, _root(spark, sf, "zip"), fresh_dir(spark, "ingest"), families=None, batch_size=100)
    return loaded.stats.drop("elapsed_secs", "records_per_sec", "mb_per_sec")


def q_ingest_mixed(spark, sf):
    """Plain files and archives of one release in one load."""
    return ingest(spark, _root(spark, sf, "mixed"), fresh_dir(spark, "ingest")).table(spark)


def q_ingest_unreadable(spark, sf):
    """A release with a plain file that fails its checksum and a ZIP cut short: the ledger's files, and what was counted."""
    from regline.plans.fixtures import registry_lines, source_rows, write_files
    from regline.session import ship_package
    from regline.sources import fs

    ship_package(spark)
    root, ledger = fresh_dir(spark, "damaged"), fresh_dir(spark, "ledger")
    write_files(registry_lines(source_rows(spark, sf)), root).collect()
    # Hadoop's local file system compares a file with the checksums next to it, here those of nothing.
    fs.write_bytes(f"{root}/.Empresas1.csv.crc", b"crc\x00" + (512).to_bytes(4, "big"))
    fs.write_bytes(f"{root}/Empresas7.zip", b"PK\x03\x04 cut short")
    loaded = ingest(spark, root, fresh_dir(spark, "ingest"), ledger_path=ledger)
    counted = loaded.stats.select(F.lit(1).alias("one"), "records_written", "files_read", "files_failed")
    taken = spark.read.parquet(ledger).select("file_name", F.lit(1).alias("one"))
    return taken.join(counted, "one").drop("one")


def q_ingest_twice(spark, sf):
    """Files 0 and 1, then the whole folder with the same ledger, into one table."""
    target, ledger = fresh_dir(spark, "ingest"), fresh_dir(spark, "ledger")
    first = ["Empresas0.csv", "Empresas1.csv"]
    ingest(spark, _root(spark, sf), target, names=first, ledger_path=ledger)
    second = ingest(spark, _root(spark, sf), target, ledger_path=ledger)
    # And files already loaded once more, without a ledger: their keys are stored, so nothing comes twice.
    again = ingest(spark, _root(spark, sf), target, names=first)
    counted = second.stats.select(F.lit(1).alias("one"), F.col("files_read").alias("second_files_read")).join(
        again.stats.select(F.lit(1).alias("one"), F.col("records_written").alias("again_written")), "one"
    )
    return again.table(spark).withColumn("one", F.lit(1)).join(counted, "one").drop("one")


def q_key_index(spark, sf):
    """The keys indexed after two loads into one table: a row for each, and the files that hold them."""
    target = fresh_dir(spark, "ingest")
    for names in (["Empresas0.csv", "Empresas1.csv"], None):
        result = ingest(spark, _root(spark, sf), target, names=names)
    index = KeyIndex(spark, f"{target}/keys", result.table_path)
    index.catch_up()
    return index.keys().groupBy("cnpj").agg(F.count(F.lit(1)).alias("entries"))


def q_stored_key_lookup(spark, sf):
    """Of the release's keys, those that a load of its files 0 and 1 has stored."""
    target = fresh_dir(spark, "ingest")
    result = ingest(spark, _root(spark, sf), target, names=["Empresas0.csv", "Empresas1.csv"])
    index = KeyIndex(spark, f"{target}/keys", result.table_path)
    index.catch_up()
    keys = staged(_accepted(spark, sf).select("cnpj").distinct(), "keys")
    stored = index.found(keys).select("cnpj", F.lit(True).alias("stored"))
    return keys.join(stored, "cnpj", "left").select("cnpj", F.coalesce("stored", F.lit(False)).alias("stored"))


def q_per_file_report(spark, sf):
    root = _root(spark, sf)
    return stats.per_file_report(_classified(spark, sf), text.list_files(spark, root, "*.csv"))


def _new_table(spark) -> tuple[str, str]:
    return f"regline_{uuid.uuid4().hex[:10]}", fresh_dir(spark, "table")


def q_table_append(spark, sf):
    name, location = _new_table(spark)
    tables.ensure_table(spark, name, location=location)
    tables.append(_clean(spark, sf), name)
    return spark.table(name).select(*R)


def q_ensure_table(spark, sf):
    name, location = _new_table(spark)
    tables.ensure_table(spark, name, location=location)
    # A second, different definition under the same name is ignored.
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (other STRING) USING parquet LOCATION '{location}-other'")
    tables.append(_clean(spark, sf), name)
    t = spark.table(name)
    return t.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("uf").alias("ufs"),
        F.lit(len(t.columns)).cast("bigint").alias("columns"),
    )


def q_copy_text_export(spark, sf):
    path = fresh_dir(spark, "copy")
    export.write_copy_text(_clean(spark, sf), path)
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))


def q_layout_and_statistics(spark, sf):
    name, location = _new_table(spark)
    tables.ensure_table(spark, name, location=location)
    tables.append(_clean(spark, sf), name)
    tables.analyze(spark, name)
    per_column = {
        c: dict(map(tuple, spark.sql(f"DESCRIBE EXTENDED {name} {c}").collect())) for c in ("uf", "cnae_fiscal", "situacao_cadastral")
    }
    rows = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").first().data_type.split(", ")[1].split()[0])
    known = [(c, rows, int(s["num_nulls"]), int(s["distinct_count"])) for c, s in per_column.items()]
    found = spark.createDataFrame(known, "column_name string, rows bigint, nulls bigint, approx_values bigint")
    # What the layout is for: a filter on the partition and sort columns.
    hits = spark.table(name).where("uf = 'U3' AND cnae_fiscal = '6200003'").count()
    return found.select("column_name", "rows", "nulls", (F.col("approx_values") > 0).alias("has_values"), F.lit(hits).alias("hits"))


def q_bounded_output_chunks(spark, sf):
    path = fresh_dir(spark, "chunks")
    tables.write_partitioned(_clean(spark, sf), path, max_records_per_file=50)
    per_file = tables.rows_per_file(spark, path)
    return per_file.agg(
        F.sum("rows").cast("bigint").alias("records"),
        F.count_if(F.col("rows") > 50).cast("bigint").alias("oversize_files"),
    )


def q_exact_chunks(spark, sf):
    """One file for each chunk of 50 records in the order of their keys."""
    path = fresh_dir(spark, "exact-chunks")
    batches.write_chunks(_stored(spark, sf), path, 50, ["cnpj"])
    rows = batches.read_chunks(spark, path, "chunk bigint, cnpj string").select("*", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("cnpj").alias("first_cnpj"),
        F.max("cnpj").alias("last_cnpj"),
        F.count_distinct("file").alias("files"),
    )


def _sent(spark, sf) -> str:
    """A sink that got the release in batches of 15, rows with a value over its width included: it refuses those batches."""
    parsed = records.classify(_lines(spark, sf), check_widths=False)
    rows = quality.dedupe(staged(records.accepted(parsed, lineage=True), "parsed"))
    path = fresh_dir(spark, "sink")
    batches.send_batches(rows.select(*R), path, size=15, order_by=["cnpj"], widths=batches.varchar_widths())
    return path


def q_sink_batches(spark, sf):
    return batches.batch_report(spark, _sent(spark, sf))


def q_sink_counters(spark, sf):
    return batches.sink_counters(spark, _sent(spark, sf))


def q_sink_rows(spark, sf):
    return batches.read_sink(spark, _sent(spark, sf), tables.table_schema())


def q_record_filter(spark, sf):
    return analytics.record_filter(_accepted(spark, sf), "situacao_cadastral = '02' AND opcao_mei = 'S'").select(
        "cnpj", "razao_social", "situacao_cadastral", "opcao_mei"
    )


def _code_tables(spark, sf):
    # The fixture folder holds all four code tables.
    tables_ = analytics.load_code_tables(spark, _root(spark, sf, "codes"))
    return {
        "codigo_municipio": (tables_["codigo_municipio"][0], "municipio"),
        "natureza_juridica": (tables_["natureza_juridica"][0], "natureza"),
        "cnae_fiscal": (tables_["cnae_fiscal"][0], "cnae"),
        "qualificacao_representante_legal": (tables_["qualificacao_representante_legal"][0], "qualificacao"),
    }


def q_code_table_enrichment(spark, sf):
    return analytics.enrich(_stored(spark, sf), _code_tables(spark, sf)).select(
        "cnpj", "codigo_municipio", "municipio", "natureza_juridica", "natureza", "cnae_fiscal", "cnae",
        "qualificacao_representante_legal", "qualificacao",
    )


def q_code_table_unknown(spark, sf):
    return analytics.unknown_codes(_stored(spark, sf), _code_tables(spark, sf))


def q_count_by_code(spark, sf):
    return analytics.count_by_code(_stored(spark, sf), "uf")


def q_count_by_situacao(spark, sf):
    return analytics.count_by_code(_stored(spark, sf), "situacao_cadastral")


def q_lookup_by_cnpj(spark, sf):
    k = F.col("o_custkey")
    ids = (
        spark.read.parquet(f"{sf}/orders.parquet")
        .select(F.concat(F.lpad(k.cast("string"), 8, "0"), F.lit("0001"), F.lpad((k % 100).cast("string"), 2, "0")).alias("cnpj"))
    )
    return analytics.lookup(_stored(spark, sf), ids).select("cnpj", "found", "razao_social", "uf")


def q_search_and_page(spark, sf):
    clean = _stored(spark, sf)
    criteria = dict(name_contains="Customer#", equals={"uf": "U3"}, size=20)
    first = analytics.search_page(clean, **criteria).select("cnpj").collect()
    after = first[-1].cnpj if first else None
    return analytics.search_page(clean, after=after, **criteria).select("cnpj", "razao_social", "uf")


def _export_roundtrip(spark, sf, fmt):
    path = fresh_dir(spark, f"export-{fmt}")
    clean = _clean(spark, sf)
    export.write_export(clean, path, fmt)
    return export.read_export(spark, path, fmt, clean.schema).select(*R)


def q_file_export_parquet(spark, sf):
    return _export_roundtrip(spark, sf, "parquet")


def q_file_export_csv(spark, sf):
    return _export_roundtrip(spark, sf, "csv")


def q_multi_sink_fanout(spark, sf):
    base = fresh_dir(spark, "fanout")
    clean = _clean(spark, sf)
    targets = [(fmt, f"{base}/{fmt}") for fmt in ("parquet", "csv", "json")]
    export.fanout(clean, targets)
    counts = [
        export.read_export(spark, path, fmt, clean.schema).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(fmt).alias("format"), "rows"
        )
        for fmt, path in targets
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def q_multi_sink_fanout_rows(spark, sf):
    """Every column of every row of each sink."""
    base = fresh_dir(spark, "fanout")
    clean = _stored(spark, sf)
    targets = [(fmt, f"{base}/{fmt}") for fmt in ("parquet", "csv", "json")]
    export.fanout(clean, targets)
    parts = [export.read_export(spark, path, fmt, clean.schema).select(F.lit(fmt).alias("format"), *R) for fmt, path in targets]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_release_diff(spark, sf):
    # Both releases stored as snapshots bucketed by cnpj: the diff's full
    # outer join then runs bucket by bucket without shuffling either side.
    listing = [text.list_files(spark, _root(spark, sf, v)).agg(F.sum("length")).first()[0] for v in ("releaseA", "releaseB")]
    buckets = buckets_for(max(listing), spark.sparkContext.defaultParallelism)
    snaps = []
    for variant in ("releaseA", "releaseB"):
        name, location = _new_table(spark)
        snaps.append(tables.write_snapshot(_clean(spark, sf, variant), name, location, buckets))
    return releases.release_diff(*snaps).select("cnpj", "change")


def q_apply_diff(spark, sf):
    old, new = _clean(spark, sf, "releaseA"), _clean(spark, sf, "releaseB")
    stored, changes_dir, out = fresh_dir(spark, "snapshot-a"), fresh_dir(spark, "changes"), fresh_dir(spark, "snapshot-b")
    old.write.parquet(stored)
    releases.changes(releases.release_diff(spark.read.parquet(stored), new)).write.parquet(changes_dir)
    snapshot = releases.apply_diff(spark.read.parquet(stored), spark.read.parquet(changes_dir))
    snapshot.write.parquet(out)
    return spark.read.parquet(out).select(*R)


def q_apply_in_place(spark, sf):
    """Release A as a partitioned snapshot, changed to release B partition by partition; a second run changes nothing."""
    path, changes_dir = fresh_dir(spark, "snapshot"), fresh_dir(spark, "changes")
    tables.write_partitioned(_clean(spark, sf, "releaseA"), path)
    diff = releases.release_diff(tables.read_partitioned(spark, path), _clean(spark, sf, "releaseB"))
    releases.changes(diff).write.parquet(changes_dir)
    for _ in range(2):
        releases.apply_in_place(spark, path, spark.read.parquet(changes_dir))
    return tables.read_partitioned(spark, path)


def _stream_in_rounds(spark, sf, max_files_per_trigger=None, archive=False, batch_size=100_000):
    """Render the release into a watched folder in two rounds (files 0-1,
    then 2-3), ingest after each, then once more with nothing new."""
    from regline.plans.fixtures import registry_lines, source_rows, write_files
    from regline.session import ship_package

    ship_package(spark)
    watched, target, ckpt = fresh_dir(spark, "watched"), fresh_dir(spark, "stream"), fresh_dir(spark, "ckpt")
    lines = registry_lines(source_rows(spark, sf))
    first = F.col("file_name").isin("Empresas0.csv", "Empresas1.csv")
    for part in (lines.where(first), lines.where(~first), None):
        if part is not None:
            write_files(part, watched, archive=archive).collect()
        incremental.incremental_ingest(
            spark, watched, target, ckpt, max_files_per_trigger=max_files_per_trigger, batch_size=batch_size
        )
    return target


def q_incremental_file_ingest(spark, sf):
    return incremental.read_ingested(spark, _stream_in_rounds(spark, sf)).select(*R)


def q_incremental_archives(spark, sf):
    """Two rounds of archives through one checkpoint."""
    return incremental.read_ingested(spark, _stream_in_rounds(spark, sf, archive=True)).select(*R)


def q_bounded_intake(spark, sf):
    table = incremental.read_ingested(spark, _stream_in_rounds(spark, sf, max_files_per_trigger=1))
    return table.agg(
        F.count_distinct("batch_id").cast("bigint").alias("batches"), F.count(F.lit(1)).alias("records")
    )


def q_stream_counters(spark, sf):
    """The counters of the micro-batches, one file each, added up. A copy is dropped in its batch or as already stored."""
    target = _stream_in_rounds(spark, sf, max_files_per_trigger=1, batch_size=100)
    total = stats.summed(incremental.load_counters(spark, target).where("batch_id IS NOT NULL"))
    return total.select(
        "*", (F.col("duplicates_dropped") + F.col("already_stored")).alias("copies")
    ).drop("duplicates_dropped", "already_stored")


def q_stream_quarantine(spark, sf):
    target = _stream_in_rounds(spark, sf, max_files_per_trigger=1)
    return incremental.read_quarantine(spark, target).select("file_name", "line", "reason")


def q_batch_and_stream(spark, sf):
    """File 0 by a batch load, the folder by a stream, and the folder by a batch load again: one table."""
    root, target, ckpt = _root(spark, sf), fresh_dir(spark, "ingest"), fresh_dir(spark, "ckpt")
    ingest(spark, root, target, names=["Empresas0.csv"])
    incremental.incremental_ingest(spark, root, target, ckpt, glob="*.csv", max_files_per_trigger=2)
    last = ingest(spark, root, target)
    again = last.stats.select(F.lit(1).alias("one"), F.col("records_written").alias("again_written"))
    return last.table(spark).withColumn("one", F.lit(1)).join(again, "one").drop("one")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
