"""Command line: the reference's `importar` and `status`, plus export.

    python -m regline ingest ROOT TARGET [--files NAME ...] [--batch-size N]
                             [--trim] [--keep-duplicates] [--ledger PATH]
                             [--complete] [--max-total-bytes N]
    python -m regline status DIR
    python -m regline audit DIR [--manifest SHA256SUMS]
    python -m regline export TABLE_DIR OUT --format parquet|csv|json|copy
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="regline")
    sub = parser.add_subparsers(dest="command", required=True)
    p_in = sub.add_parser("ingest", help="load a release folder (plain .csv files and .zip archives)")
    p_in.add_argument("root")
    p_in.add_argument("target")
    p_in.add_argument("--files", nargs="*", help="only these file names")
    p_in.add_argument("--batch-size", type=int, default=100_000)
    p_in.add_argument("--max-records-per-file", type=int)
    p_in.add_argument("--complete", action="store_true", help="count missing parts of the release as failed files")
    p_in.add_argument("--max-total-bytes", type=int, help="leave out archives that unpack to more")
    p_in.add_argument("--trim", action="store_true", help="remove spaces and tabs around fields")
    p_in.add_argument("--keep-duplicates", action="store_true", help="do not reduce to one record per id")
    p_in.add_argument("--ledger", help="table of files already taken; only new files are loaded")
    p_st = sub.add_parser("status", help="archives in a folder, by name, with size in MiB")
    p_st.add_argument("dir")
    p_au = sub.add_parser("audit", help="archive checks (ZIP, size limit) and optional SHA-256 manifest")
    p_au.add_argument("dir")
    p_au.add_argument("--manifest", help="text file of '<sha256>  <file name>' lines")
    p_ex = sub.add_parser("export", help="write a stored table as files")
    p_ex.add_argument("table_dir")
    p_ex.add_argument("out")
    p_ex.add_argument("--format", choices=["parquet", "csv", "json", "copy"], default="parquet")
    args = parser.parse_args(argv)

    from regline.session import get_session

    spark = get_session()
    if args.command == "ingest":
        from regline.plans.ingest import ingest

        result = ingest(
            spark,
            args.root,
            args.target,
            names=args.files or None,
            families=None if args.files else ("Empresas",),
            trim=args.trim,
            deduplicate=not args.keep_duplicates,
            batch_size=args.batch_size,
            max_records_per_file=args.max_records_per_file,
            ledger_path=args.ledger,
            complete=args.complete,
            max_total_bytes=args.max_total_bytes,
        )
        print(json.dumps(result.stats.first().asDict()))
        return 0
    if args.command == "status":
        from regline.sources.files import cache_listing

        rows = cache_listing(spark, args.dir).collect()
        for r in rows:
            print(f"{r.file_name}\t{r.size_mib:.1f} MiB")
        print(f"{len(rows)} archive(s)")
        return 0
    if args.command == "audit":
        from regline.sources.archives import archive_audit
        from regline.sources.files import verify_checksums

        for r in archive_audit(spark, args.dir).orderBy("archive").collect():
            print(f"{r.archive}\t{r.verdict}\tmembers={r.members}\tcsv={r.csv_members}\tbytes={r.total_bytes}")
        if args.manifest:
            # Manifest lines "<hex digest>  <file name>" (sha256sum format), read as a table.
            from pyspark.sql import functions as F

            lines = spark.read.text(args.manifest).where(F.trim("value") != "")
            manifest = lines.select(
                F.lower(F.regexp_extract("value", r"^([0-9A-Fa-f]{64})", 1)).alias("expected_sha256"),
                F.regexp_extract("value", r"^[0-9A-Fa-f]{64}\s+\*?(.+)$", 1).alias("file_name"),
            )
            for r in verify_checksums(spark, args.dir, manifest).orderBy("file_name").collect():
                print(f"{r.file_name}\t{r.status}")
        return 0
    from regline.sinks import export, tables

    records = tables.read_partitioned(spark, args.table_dir)
    if args.format == "copy":
        export.write_copy_text(records, args.out)
    else:
        export.write_export(records, args.out, args.format)
    return 0


if __name__ == "__main__":
    sys.exit(main())
