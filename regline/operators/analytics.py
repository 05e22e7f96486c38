"""Work on stored records: filter (D2), code tables (D3), counts (D4),
lookup (D5), search with paging (D6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regline.session import staged

def record_filter(records: DataFrame, predicate: str | Column) -> DataFrame:
    """Caller-given predicate on record columns, before the sink."""
    return records.where(F.expr(predicate) if isinstance(predicate, str) else predicate)


def enrich(
    records: DataFrame,
    code_tables: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """D3: for each code column, add its description from a (code, description) table.

    ``code_tables``: code column -> (table, name of the description column).
    Left joins: an unknown code keeps its row with a NULL description.
    Code tables are de-duplicated on code so a join never multiplies rows, and
    staged, so the planner broadcasts those that are small in bytes.
    """
    out = records
    for column, (table, described_as) in code_tables.items():
        dim = table.groupBy("code").agg(F.min("description").alias(described_as))
        dim = staged(dim.withColumnRenamed("code", column), "code-table")
        out = out.join(dim, column, "left")
    return out


# The registry's code-table file families and the record column
# each one describes (countries and reasons describe no column of this layout).
CODE_TABLE_FAMILIES = {
    "CNAEs": ("cnae_fiscal", "cnae_descricao"),
    "Naturezas": ("natureza_juridica", "natureza_descricao"),
    "Municipios": ("codigo_municipio", "municipio"),
    "Qualificacoes": ("qualificacao_representante_legal", "qualificacao_descricao"),
}


def load_code_tables(spark, root: str, families: Mapping[str, tuple[str, str]] = CODE_TABLE_FAMILIES) -> dict:
    """D3: the code tables present in a release folder, ready for ``enrich``.

    Each family present (plain .csv and .zip) is read with the same scan and
    checks as the records, through the two-column (code;description) layout.
    Returns {record column: (table, description column name)}; the families
    not found are those whose column is missing from it.
    """
    from regline.layout import code_table_layout
    from regline.operators.records import parse_records
    from regline.plans.ingest import read_release, resolve_inputs

    out = {}
    for family, (column, described_as) in families.items():
        inputs = resolve_inputs(spark, root, families=(family,))
        if not inputs.files:
            continue
        out[column] = (parse_records(read_release(spark, inputs), code_table_layout()), described_as)
    return out


def unknown_codes(
    records: DataFrame,
    code_tables: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """D3 companion: (code_column, code, records) for codes missing from their table.

    Counts are aggregated before the anti join, so the join sees one row per
    distinct code rather than one per record.
    """
    parts = []
    for column, (table, _) in code_tables.items():
        counted = records.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("code")).agg(
            F.count(F.lit(1)).alias("records")
        )
        known = table.select("code").distinct()
        parts.append(
            counted.join(known, "code", "left_anti").select(
                F.lit(column).alias("code_column"), "code", F.col("records").cast("bigint").alias("records")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_by_code(records: DataFrame, column: str) -> DataFrame:
    """Records per value of any column, NULL its own group, largest first,
    ties by the value. Partial aggregation keeps hot values cheap."""
    return (
        records.groupBy(column)
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc_nulls_first(column))
    )


def lookup(records: DataFrame, ids: DataFrame, key: str = "cnpj") -> DataFrame:
    """A batch of ids -> their records plus ``found``; unknown ids stay.

    A lookup batch is usually tiny next to the table. The ids are staged, so
    the planner knows their bytes: a small batch is broadcast and the table is
    only scanned (semi join, no shuffle of the table), and the few hits are
    then matched to the ids. For a huge one it shuffles.
    """
    wanted = staged(ids.select(key).distinct(), "lookup-ids")
    hit = records.withColumn("_hit", F.lit(True)).join(wanted, key, "left_semi")
    return wanted.join(hit, key, "left").select(
        key, F.coalesce(F.col("_hit"), F.lit(False)).alias("found"), *[c for c in records.columns if c != key]
    )


def lookup_one(records: DataFrame, value: str, key: str = "cnpj") -> DataFrame:
    """D5 for a single id: a pushed-down equality filter."""
    return records.where(F.col(key) == F.lit(value))


def search_page(
    records: DataFrame,
    name_contains: str | None = None,
    equals: Mapping[str, str] | None = None,
    after: str | None = None,
    size: int = 20,
    key: str = "cnpj",
    name_column: str = "razao_social",
) -> DataFrame:
    """Equality on codes, case-insensitive substring on the name, keyset
    paging (key > after), sorted by key, at most ``size`` rows.

    orderBy + limit plans as a top-k (TakeOrderedAndProject): each task keeps
    only its best ``size`` rows.
    """
    cond = F.lit(True)
    for column, value in (equals or {}).items():
        cond = cond & (F.col(column) == F.lit(value))
    if name_contains:
        cond = cond & F.lower(F.col(name_column)).contains(name_contains.lower())
    if after is not None:
        cond = cond & (F.col(key) > F.lit(after))
    return records.where(cond).orderBy(key).limit(size)
