"""Lines -> records: split (P2), key (P3), projection (P4), NULLs (P5),
trim (P6), and row validation with a reason (V1, V2, V3, V4).

``classify`` returns ONE DataFrame in which every line carries either a NULL
``reason`` (accepted) or the first rule it broke. Accepted records and the
quarantine are two filters of it, so one scan feeds both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regline.functions.checks import width_violations
from regline.functions.columns import empty_to_null, field_at, split_fields, trim_blank
from regline.layout import EMPRESAS, Layout

REASONS = ("too_few_fields", "bad_cnpj_width", "overwide")
LINEAGE = ("file_path", "file_name", "line")


def record_columns(fields: str, layout: Layout, trim: bool = False) -> list:
    """P3 + P4 + P5 (+ P6): the layout's columns from the split fields."""
    cols = []
    for f in layout.fields:
        if f.name == layout.key and layout.key_parts:
            # Parts joined as they are, no trimming, no case change.
            value = F.concat(*[field_at(fields, pos) for pos, _ in layout.key_parts])
        elif f.position is None:
            value = F.lit(None).cast("string")
        else:
            value = field_at(fields, f.position)
            if trim:
                value = trim_blank(value)
        cols.append(empty_to_null(value).alias(f.name))
    return cols


def classify(
    lines: DataFrame,
    layout: Layout = EMPRESAS,
    trim: bool = False,
    check_widths: bool = True,
) -> DataFrame:
    """(file_path, file_name, line) -> lineage + n_fields, reason, detail + record.

    Reasons, first match wins: too_few_fields (V1), bad_cnpj_width (V2),
    overwide (V4, detail = offending columns).
    """
    # The split runs once per line. Emitting it through a one-element explode
    # (a Generate node) keeps later filters (reason IS NULL, ...) from being
    # pushed below it: pushed through a plain projection, every reference to a
    # field would be rewritten into its own split of the whole line.
    parsed = lines.select(*LINEAGE, F.explode(F.array(split_fields("line", layout.delimiter))).alias("fields"))
    n = F.size("fields")
    bad_key = F.lit(False)
    for pos, width in layout.key_parts:
        bad_key = bad_key | (F.length(field_at("fields", pos)) != F.lit(width))
    early = F.when(n < layout.min_fields, F.lit("too_few_fields")).when(bad_key, F.lit("bad_cnpj_width"))
    staged = parsed.select(
        *LINEAGE,
        n.alias("n_fields"),
        early.alias("reason"),
        *record_columns("fields", layout, trim),
    )
    if not check_widths:
        return staged.withColumn("detail", F.lit(None).cast("string")).select(
            *LINEAGE, "n_fields", "reason", "detail", *layout.names
        )
    # Computed once as a column; the next projection only refers to it.
    checked = staged.select("*", width_violations(layout).alias("_over"))
    return checked.select(
        *LINEAGE,
        "n_fields",
        F.coalesce(F.col("reason"), F.when(F.col("_over").isNotNull(), F.lit("overwide"))).alias("reason"),
        F.when(F.col("reason").isNull(), F.col("_over")).alias("detail"),
        *layout.names,
    )


def accepted(classified: DataFrame, layout: Layout = EMPRESAS, lineage: bool = False) -> DataFrame:
    cols = (["file_path", "line"] if lineage else []) + layout.names
    return classified.where(F.col("reason").isNull()).select(*cols)


def quarantine(classified: DataFrame) -> DataFrame:
    """V3: rejected lines keep their text, file and reason."""
    return classified.where(F.col("reason").isNotNull()).select(
        "file_path", "file_name", "line", "n_fields", "reason", "detail"
    )


def reason_counts(classified: DataFrame) -> DataFrame:
    """V3: lines per outcome; accepted lines count under 'accepted'."""
    return classified.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("lines")
    )


def parse_records(lines: DataFrame, layout: Layout = EMPRESAS, trim: bool = False) -> DataFrame:
    """Lines -> accepted records only (the reference's normalize step)."""
    return accepted(classify(lines, layout, trim=trim, check_widths=False), layout)
