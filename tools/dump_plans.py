"""Write PLANS.md: the physical plan tree of each main job at sf0.01.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from regline.layout import code_table_layout  # noqa: E402
from regline.operators import analytics, quality, records, releases  # noqa: E402
from regline.plans.fixtures import registry_release  # noqa: E402
from regline.plans.ingest import ingest, records_of, staged_frame, unique_lines  # noqa: E402
from regline.session import fresh_dir, get_session, staged  # noqa: E402
from regline.sinks import tables  # noqa: E402
from regline.sources import archives, text  # noqa: E402


def tree(df) -> str:
    """The operator tree of the executed plan, with scans' pushdown details."""
    plan = df._jdf.queryExecution().executedPlan().toString().replace("\r", "\\r")
    lines = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        m = re.search(r"(PartitionFilters: \[[^\]]*\]).*(PushedFilters: \[[^\]]*\]).*(ReadSchema: \S+)", line)
        op = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?([A-Za-z]+(?: [A-Za-z]+)?)", line)
        if not op:
            continue
        prefix, stage, name = op.groups()
        head = f"{prefix}{stage or ''}{name}"
        jt = re.search(r"\b(LeftAnti|LeftSemi|LeftOuter|RightOuter|FullOuter|Inner)\b", line)
        if "Join" in name and jt:
            head += " " + jt.group(1)
        if m:
            head += "  " + "  ".join(m.groups())
        lines.append(head[:260])
    return "\n".join(lines)


def main(sf_dir: str) -> None:
    spark = get_session("local[8]", 8)
    root = registry_release(spark, sf_dir, "plain")
    res = ingest(spark, root, fresh_dir(spark, "plans"))
    table = res.table(spark)
    lines = staged(staged_frame(records.classify(text.read_lines(spark, root))).where("outcome = 'accepted'"), "plans")
    codes = registry_release(spark, sf_dir, "codes")
    mun = records.parse_records(text.read_lines(spark, f"{codes}/Municipios.csv"), code_table_layout())
    nat = records.parse_records(text.read_lines(spark, f"{codes}/Naturezas.csv"), code_table_layout())
    zroot = registry_release(spark, sf_dir, "zip")
    zpaths = [r.path for r in text.list_files(spark, zroot, "*.zip").collect()]
    snaps = [
        tables.write_snapshot(table, f"plan_snap_{i}", fresh_dir(spark, "snap"), buckets=8) for i in range(2)
    ]
    ids = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.concat(F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("0001"),
                 F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0")).alias("cnpj"))
    jobs = [
        ("Stage: text -> classified rows (written partitioned by outcome)",
         staged_frame(records.classify(text.read_lines(spark, root)))),
        ("Stage from ZIP members (Python Data Source, one partition per member)",
         staged_frame(records.classify(archives.read_zip_lines(spark, zpaths)))),
        ("Publish: one line per key, split into columns, rebalanced by uf, sorted",
         tables.laid_out(records_of(unique_lines(lines, "cnpj")[0]))),
        ("Duplicate report (V5)", quality.duplicate_report(table)),
        ("Count by code (D4)", analytics.count_by_code(table, "uf")),
        ("Lookup one id (D5)", analytics.lookup_one(table, "00000002000102")),
        ("Lookup a batch of ids (D5)", analytics.lookup(table, ids)),
        ("Search page (D6)", analytics.search_page(table, "customer#", {"uf": "U3", "cnae_fiscal": "6200003"}, size=20)),
        ("Enrichment with code tables (D3)",
         analytics.enrich(table, {"codigo_municipio": (mun, "municipio"), "natureza_juridica": (nat, "natureza")})),
        ("Release diff of two bucketed snapshots (D8)", releases.release_diff(*snaps)),
        ("Check digits (D1)", quality.with_check_digit(table)),
        ("Typed view (T1)", quality.typed_view(table)),
    ]
    out = ["# PLANS", "",
           f"Executed physical plans at `{sf_dir}` (generated by `tools/dump_plans.py`; AQE may re-plan at run time,",
           "e.g. coalescing shuffle partitions or turning a join into a broadcast when a side turns out small).", ""]
    for title, df in jobs:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    for i in range(2):
        spark.sql(f"DROP TABLE plan_snap_{i}")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
