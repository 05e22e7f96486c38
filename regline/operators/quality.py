"""Record quality: key uniqueness (V5), check digits (D1), typed view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regline.functions.checks import names_where, typed_value
from regline.layout import EMPRESAS, Layout
from regline.session import staged


def duplicate_report(records: DataFrame, key: str = "cnpj") -> DataFrame:
    """V5: keys held by more than one record, with their number of copies.

    A hash aggregate with map-side partial counts, so a key holding a third
    of all rows collapses to one row per task before the shuffle.
    """
    return (
        records.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select(key, F.col("copies").cast("bigint").alias("copies"))
    )


def _winners(records: DataFrame, layout: Layout, order: tuple[str, ...]) -> DataFrame:
    rest = [c for c in layout.names if c != layout.key]
    winner = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("w")
    return records.groupBy(layout.key).agg(winner).select(layout.key, *[F.col(f"w.{c}").alias(c) for c in rest])


def dedupe(
    records: DataFrame,
    layout: Layout = EMPRESAS,
    order: tuple[str, ...] = ("file_path", "line"),
) -> DataFrame:
    """V5: keep one record per key, always the same one.

    The winner is the smallest (file path, line text, record); text rows carry
    no position, so nothing depends on task order, and copies that tie on all
    of these are identical.

    Hash first: a key-only hash aggregate (with map-side partial counts) finds
    the keys held more than once. Records of all other keys pass through with
    no shuffle where the key list is small enough to broadcast; only the rows of
    duplicated keys go through ``min(struct)``, whose partial aggregation
    reduces a hot key (say, a third of all rows) to one row per task before
    the shuffle. Nothing buffers a whole key group in one task.
    """
    key = layout.key
    # Computed once and written to the shared folder (survives lost
    # executors); the count and both joins then read that copy, and the
    # planner knows its bytes and broadcasts it only below its threshold.
    dup_keys = staged(
        records.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key), "duplicated-keys"
    )
    if dup_keys.isEmpty():  # the usual case for a clean release: nothing to join
        return records.select(*layout.names)
    keys = dup_keys.withColumnRenamed(key, "_dup_key")
    # Null-safe, so a NULL key is one group here too, as in the aggregate path.
    same = F.col(key).eqNullSafe(F.col("_dup_key"))
    unique = records.join(keys, same, "left_anti").select(*layout.names)
    repeated = records.join(keys, same, "left_semi")
    return unique.unionByName(_winners(repeated, layout, order).select(*layout.names))


def against_stored(records: DataFrame, stored: DataFrame, key: str = "cnpj") -> DataFrame:
    """V5 across loads: records whose key is not yet stored.

    A new load (or micro-batch) is usually far smaller than the stored table.
    Its keys are written first, so the planner knows their size: where they
    are few it broadcasts them and only scans the stored key column; the few
    keys found are then removed from the new records.
    """
    keys = staged(records.select(key).distinct(), "new-keys")
    found = staged(stored.select(key).join(keys, key, "left_semi").distinct(), "stored-keys")
    return records.join(found, key, "left_anti")


def with_check_digit(records: DataFrame, key: str = "cnpj") -> DataFrame:
    """Add ``dv_status``; a bad digit is flagged, never rejected.

    Staged projections: the 14 character values are computed once, then the
    two weighted sums, then the verdict, instead of one expression that
    repeats the first digit's sum inside the second.
    """
    from regline.functions.checks import (
        CHECKABLE_ID,
        FIRST_DIGIT_WEIGHTS,
        SECOND_DIGIT_WEIGHTS,
        char_value,
        check_digit,
    )

    c = F.col(key)
    vals = records.select("*", *[char_value(c, i + 1).alias(f"_v{i}") for i in range(14)])
    v = [F.col(f"_v{i}") for i in range(14)]
    first = vals.select("*", check_digit(sum((v[i] * w for i, w in enumerate(FIRST_DIGIT_WEIGHTS)), F.lit(0))).alias("_d1"))
    second = first.select(
        "*",
        check_digit(
            sum((v[i] * w for i, w in enumerate(SECOND_DIGIT_WEIGHTS[:12])), F.lit(0)) + F.col("_d1") * SECOND_DIGIT_WEIGHTS[12]
        ).alias("_d2"),
    )
    status = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(~c.rlike(CHECKABLE_ID), F.lit("not_checkable"))
        .when((F.col("_d1") == v[12]) & (F.col("_d2") == v[13]), F.lit("ok"))
        .otherwise(F.lit("bad"))
    )
    return second.select(*records.columns, status.alias("dv_status"))


def typed_view(records: DataFrame, layout: Layout = EMPRESAS) -> DataFrame:
    """Dates, S/N flags and the capital as typed values + ``cast_errors``.

    Each value is parsed once; ``cast_errors`` compares the parsed column with
    its text in a second projection.
    """
    typed = [f for f in layout.fields if f.kind != "string"]
    parsed = records.select(*layout.names, *[typed_value(f.name, f.kind).alias(f"_t_{f.name}") for f in typed])
    errors = names_where([(f.name, F.col(f.name).isNotNull() & F.col(f"_t_{f.name}").isNull()) for f in typed])
    return parsed.select(
        *[F.col(f"_t_{f.name}").alias(f.name) if f.kind != "string" else F.col(f.name) for f in layout.fields],
        errors.alias("cast_errors"),
    )
