"""Physical-plan properties the design relies on at scale."""

from conftest import GOOD, record_line

from regline.layout import EMPRESAS
from regline.operators import analytics, records, releases
from regline.operators.quality import dedupe
from regline.plans.ingest import ingest
from regline.sinks import tables
from regline.sources.text import read_lines


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_line_is_split_once_even_under_filters(spark, write_files):
    root = write_files({"Empresas0.csv": record_line(GOOD) + b"\n"})
    acc = records.accepted(records.classify(read_lines(spark, root)))
    plan = optimized(acc.select("cnpj"))
    assert plan.count("split(") == 1


def test_parse_stage_is_one_codegen_stage_without_shuffle(spark, write_files):
    root = write_files({"Empresas0.csv": record_line(GOOD) + b"\n"})
    plan = executed(records.classify(read_lines(spark, root)))
    assert "Exchange" not in plan and ("WholeStageCodegen" in plan or "*(" in plan)


def test_dedupe_broadcasts_bounded_key_list(spark, write_files):
    rows = [record_line({**GOOD, 0: f"{i % 5:08d}"}) for i in range(20)]
    root = write_files({"Empresas0.csv": b"\n".join(rows) + b"\n"})
    recs = records.accepted(records.classify(read_lines(spark, root)), lineage=True).checkpoint(eager=True)
    plan = executed(dedupe(recs))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "LeftSemi" in plan


def test_table_filters_reach_the_scan(spark, write_files, tmp_path):
    data = b"".join(record_line({**GOOD, 0: f"{i:08d}", 32: "SP" if i % 2 else "RJ"}) + b"\n" for i in range(10))
    res = ingest(spark, write_files({"Empresas0.csv": data}), str(tmp_path / "t"))
    t = res.table(spark)
    one = executed(analytics.lookup_one(t, "00000003000211"))
    assert "PushedFilters: [IsNotNull(cnpj), EqualTo(cnpj,00000003000211)]" in one
    page = executed(analytics.search_page(t, "empresa", {"uf": "SP", "cnae_fiscal": "1091101"}, size=5))
    assert "PartitionFilters: [isnotnull(uf" in page and "EqualTo(cnae_fiscal,1091101)" in page
    assert "TakeOrderedAndProject" in page
    counts = executed(analytics.count_by_code(t, "uf"))
    assert "ReadSchema: struct<>" in counts  # only the partition column is needed


def test_bucketed_snapshots_diff_without_shuffle(spark, tmp_path):
    cols = [f"cast(null as string) as {c}" for c in EMPRESAS.names if c not in ("cnpj", "razao_social")]
    snaps = []
    for name, mod in (("snap_a", 3), ("snap_b", 5)):
        df = spark.range(0, 200, 1, 4).where(f"id % {mod} != 0").selectExpr(
            "lpad(cast(id as string), 14, '0') as cnpj", "cast(id as string) as razao_social", *cols
        )
        snaps.append(tables.write_snapshot(df, name, str(tmp_path / name), buckets=4))
    diff = releases.release_diff(*snaps)
    plan = executed(diff)
    assert "Exchange" not in plan and "Sort " not in plan.replace("SortMergeJoin", "")
    assert len(list((tmp_path / "snap_a").glob("*.parquet"))) <= 4  # one file per bucket
    counts = {r.change: r.records for r in releases.diff_summary(diff).collect()}
    assert counts == {"inserted": 53, "deleted": 26, "unchanged": 107}  # ids 0-199: %3 vs %5
    for name in ("snap_a", "snap_b"):
        spark.sql(f"DROP TABLE {name}")


def test_registered_analytics_scan_the_stored_table(spark):
    import __spark_entry__ as entry

    queries, sf = entry.queries(), "/root/testdata/sf0.001"
    for name in ("cnpj_check_digit", "typed_view", "count_by_code", "search_and_page", "code_table_enrichment", "lookup_by_cnpj"):
        plan = executed(queries[name](spark, sf))
        assert "FileScan parquet" in plan and "ExistingRDD" not in plan, name
    page = executed(queries["search_and_page"](spark, sf))
    assert "PartitionFilters: [isnotnull(uf" in page and "IsNotNull(cnpj)" in page[page.index("PushedFilters") :]


def test_no_gather_under_a_limit_in_key_checks(spark):
    from regline.operators.quality import against_stored

    one = spark.range(5).selectExpr("cast(id as string) cnpj")
    for df in (against_stored(one, one), analytics.lookup(one.selectExpr("*", "'x' as uf"), one)):
        plan = executed(df)
        assert "SinglePartition" not in plan and "LocalLimit" not in plan
