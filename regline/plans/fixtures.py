"""Turn the driver's tables into real registry files (Latin-1, CRLF, ';').

There is no company registry among the test tables, so ``customer`` rows are
rendered to raw lines by fixed rules, written to the shared folder, and the
operators read those files back exactly as they would read a release.
With k = the row key:

* id = lpad(k,8) || '0001' || lpad(k%100,2); name = 'São ' || name
* k%17=0: only the first 10 fields (too_few_fields)
* k%19=0: 7-character first id part (bad_cnpj_width)
* k%23=0: followed by a blank line; k%29=0: line written twice
* k%31=0: 9-character cep (overwide); k%37=0 (not k%17): 40 fields
* k%41=0: LF instead of CRLF; k%43=0 / k%47=0: invalid opening date
* k%53=0: name padded with a space and ending in backslash + tab
* releases: A drops k%13=0, B drops k%11=0 and renames k%7=0
* file = Empresas<k % n_files>.csv, plus one empty Empresas<n_files>.csv

The oracle SQL derives the expected results from the same rules on
``customer`` directly, never by parsing these lines.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.session import ship_package, shared_dir
from regline.sources import fs

FIXTURE_VERSION = "4"
N_FILES = 4
JUNK_MEMBER = "LEIAME.CSV"
NOT_A_ZIP = "Corrompido.zip"


def _lp(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def source_rows(spark: SparkSession, sf_dir: str, table: str = "customer") -> DataFrame:
    """(k, name, nk, bal) from a driver table."""
    if table == "customer":
        return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
            F.col("c_custkey").alias("k"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").cast("bigint").alias("nk"),
            F.col("c_acctbal").alias("bal"),
        )
    if table == "lineitem":
        li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        return li.select(
            k.alias("k"),
            F.concat(F.lit("Item#"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("name"),
            (F.col("l_suppkey") % 25).alias("nk"),
            F.col("l_extendedprice").alias("bal"),
        )
    raise ValueError(f"no rendering rule for table {table!r}")


def field_values(release: str | None = None) -> list[Column]:
    """The 37 source fields of one registry line, by the rules above."""
    k, nk = F.col("k"), F.col("nk")
    name = F.col("name")
    if release == "B":
        name = F.when(k % 7 == 0, F.concat(name, F.lit(" Ltda"))).otherwise(name)
    opening = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (k * 37 % 10000).cast("int")), "yyyyMMdd")
    month = _lp(k % 12 + 1, 2)
    v = [F.lit("")] * 37
    v[0] = F.when(k % 19 == 0, F.substring(_lp(k, 8), 2, 7)).otherwise(_lp(k, 8))
    v[1] = F.lit("0001")
    v[2] = _lp(k % 100, 2)
    v[3] = F.when(k % 43 == 0, F.lit("20201301")).when(k % 47 == 0, F.lit("00000000")).otherwise(opening)
    v[4] = F.when(k % 53 == 0, F.concat(F.lit(" São "), name, F.lit("\\\t"))).otherwise(F.concat(F.lit("São "), name))
    v[5] = F.concat(F.lit("620"), _lp(k % 7, 4))
    v[6] = F.concat(F.lit('"'), (k % 10).cast("string"), F.lit('"'))
    v[7] = _lp(k % 50, 2)
    v[10] = F.when(k % 3 == 0, F.lit("S")).when(k % 3 == 1, F.lit("N")).otherwise(F.lit(""))
    v[11] = F.when(k % 3 == 0, F.concat(F.lit("2007"), month, F.lit("01"))).otherwise(F.lit(""))
    v[13] = F.when(k % 4 == 0, F.lit("S")).otherwise(F.lit("N"))
    v[14] = _lp(k % 5, 2)
    v[15] = F.concat(F.lit("2020"), month, _lp(k % 28 + 1, 2))
    v[19] = _lp(nk % 7, 4)
    v[21] = _lp(nk, 7)
    v[22] = _lp(k % 89 + 10, 2)
    v[24] = F.when(k % 2 == 0, _lp(k % 88 + 11, 2)).otherwise(F.lit(""))
    v[29] = F.when(k % 31 == 0, _lp(k, 9)).otherwise(_lp(k * 13 % 100000000, 8))
    v[32] = F.concat(F.lit("U"), (nk % 10).cast("string"))
    v[33] = F.lit("BR")
    v[36] = F.col("bal").cast("decimal(15,2)").cast("string")
    return v


def registry_lines(src: DataFrame, n_files: int = N_FILES, release: str | None = None) -> DataFrame:
    """One row per physical line: (file_name, k, seq, data) with its line end."""
    k = F.col("k")
    if release == "A":
        src = src.where(k % 13 != 0)
    elif release == "B":
        src = src.where(k % 11 != 0)
    v = field_values(release)
    full = F.concat_ws(";", *v)
    text = (
        F.when(k % 17 == 0, F.concat_ws(";", *v[:10]))
        .when(k % 37 == 0, F.concat_ws(";", full, F.lit("x37"), F.lit("x38"), F.lit("x39")))
        .otherwise(full)
    )
    end = F.when(k % 41 == 0, F.lit("\n")).otherwise(F.lit("\r\n"))
    line = F.concat(text, end)
    physical = F.array(
        F.struct(F.lit(0).alias("seq"), line.alias("data")),
        F.when(k % 29 == 0, F.struct(F.lit(1).alias("seq"), line.alias("data"))),
        F.when(k % 23 == 0, F.struct(F.lit(2).alias("seq"), end.alias("data"))),
    )
    return (
        src.select(
            F.concat(F.lit("Empresas"), (k % n_files).cast("string"), F.lit(".csv")).alias("file_name"),
            k,
            F.explode(F.filter(physical, lambda s: s.isNotNull())).alias("p"),
        )
        .select("file_name", "k", "p.seq", "p.data")
    )


def code_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipios.csv and Qualificacoes.csv from nation, Naturezas.csv and CNAEs.csv from region (code;description)."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    mun = nation.select(
        F.lit("Municipios.csv").alias("file_name"),
        F.col("n_nationkey").cast("bigint").alias("k"),
        F.lit(0).alias("seq"),
        F.concat(_lp(F.col("n_nationkey"), 7), F.lit(";Município "), F.col("n_name"), F.lit("\r\n")).alias("data"),
    )
    nat = region.select(
        F.lit("Naturezas.csv").alias("file_name"),
        F.col("r_regionkey").cast("bigint").alias("k"),
        F.lit(0).alias("seq"),
        F.concat(_lp(F.col("r_regionkey"), 4), F.lit(";Natureza "), F.col("r_name"), F.lit("\r\n")).alias("data"),
    )
    cnae = region.select(
        F.lit("CNAEs.csv").alias("file_name"),
        F.col("r_regionkey").cast("bigint").alias("k"),
        F.lit(0).alias("seq"),
        F.concat(F.lit("620"), _lp(F.col("r_regionkey"), 4), F.lit(";CNAE "), F.col("r_name"), F.lit("\r\n")).alias("data"),
    )
    qual = nation.select(
        F.lit("Qualificacoes.csv").alias("file_name"),
        F.col("n_nationkey").cast("bigint").alias("k"),
        F.lit(0).alias("seq"),
        F.concat(_lp(F.col("n_nationkey"), 2), F.lit(";Qualificação "), F.col("n_name"), F.lit("\r\n")).alias("data"),
    )
    return mun.unionByName(nat).unionByName(cnae).unionByName(qual)


def _writer(root: str, archive: bool):
    """mapInPandas body: stream each file's sorted lines to one Latin-1 file."""

    def write(batches):
        import zipfile

        import pandas as pd

        from regline.sources import fs as _fs

        open_files: dict = {}
        stats: dict = {}

        def handle(name):
            if name not in open_files:
                if archive:
                    stream = _fs.open_output(f"{root}/{name[:-4]}.zip")
                    zf = zipfile.ZipFile(stream, "w", compression=zipfile.ZIP_DEFLATED)
                    member = zf.open(name, "w", force_zip64=True)
                    open_files[name] = (stream, zf, member)
                else:
                    open_files[name] = (_fs.open_output(f"{root}/{name}"), None, None)
                stats[name] = [0, 0]
            return open_files[name]

        for pdf in batches:
            for name, grp in pdf.groupby("file_name", sort=False):
                data = "".join(grp["data"].tolist()).encode("latin-1")
                stream, zf, member = handle(name)
                (member or stream).write(data)
                stats[name][0] += len(data)
                stats[name][1] += len(grp)
        for name, (stream, zf, member) in open_files.items():
            if zf is not None:
                member.close()
                zf.writestr(JUNK_MEMBER, "nao;e;um;registro\r\n".encode("latin-1"))
                zf.close()
            stream.close()
        if stats:
            yield pd.DataFrame(
                {
                    "file_name": pd.Series(list(stats), dtype=object),
                    "bytes": pd.Series([s[0] for s in stats.values()], dtype="int64"),
                    "lines": pd.Series([s[1] for s in stats.values()], dtype="int64"),
                }
            )

    return write


def write_files(lines: DataFrame, root: str, archive: bool = False, n_tasks: int | None = None) -> DataFrame:
    """Write (file_name, k, seq, data) rows as files below ``root``.

    Each file is produced by one task, streaming its rows in key order;
    files are spread over tasks by a hash of their name. Returns the
    per-file report (an action has been run).
    """
    n = n_tasks or max(1, lines.select("file_name").distinct().count())
    return (
        lines.repartition(n, "file_name")
        .sortWithinPartitions("file_name", "k", "seq")
        .mapInPandas(_writer(root, archive), "file_name string, bytes bigint, lines bigint")
    )


def _key(sf_dir: str, variant: str) -> str:
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    return f"{digest}-{variant}-v{FIXTURE_VERSION}"


def fixture_root(spark: SparkSession, sf_dir: str, variant: str) -> str:
    return f"{shared_dir(spark)}/regline-fixtures/{_key(sf_dir, variant)}"


def registry_release(
    spark: SparkSession,
    sf_dir: str,
    variant: str = "plain",
    table: str = "customer",
    n_files: int = N_FILES,
) -> str:
    """Render (once per session) and return the folder of a fixture release.

    variant: plain | zip | mixed (files 0 and 1 plain, the others zipped) |
    releaseA | releaseB | codes
    """
    root = fixture_root(spark, sf_dir, f"{table}-{variant}-{n_files}")
    ship_package(spark)
    with _RENDER_LOCK:  # callers on several threads render each release once
        if not fs.exists(f"{root}/_READY"):
            _render(spark, sf_dir, variant, table, n_files, root)
    return root


_RENDER_LOCK = threading.Lock()


def _render(spark: SparkSession, sf_dir: str, variant: str, table: str, n_files: int, root: str) -> None:
    if variant == "codes":
        lines = code_table_lines(spark, sf_dir)
    else:
        release = {"releaseA": "A", "releaseB": "B"}.get(variant)
        lines = registry_lines(source_rows(spark, sf_dir, table), n_files, release)
    archive = variant == "zip"
    if variant == "mixed":
        plain = F.col("file_name").isin("Empresas0.csv", "Empresas1.csv")
        write_files(lines.where(plain), root, n_tasks=n_files).collect()
        write_files(lines.where(~plain), root, archive=True, n_tasks=n_files).collect()
    else:
        write_files(lines, root, archive=archive, n_tasks=n_files).collect()
    if variant != "codes":
        empty = f"Empresas{n_files}"
        if archive:
            import io
            import zipfile

            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w") as zf:
                zf.writestr(f"{empty}.csv", b"")
            fs.write_bytes(f"{root}/{empty}.zip", buf.getvalue())
            fs.write_bytes(f"{root}/{NOT_A_ZIP}", b"not an archive\r\n")
        else:
            fs.write_bytes(f"{root}/{empty}.csv", b"")
    fs.write_bytes(f"{root}/_READY", b"")
