"""Row-level checks as Column expressions: widths, check digits, typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regline.layout import Layout


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def names_where(conditions: list[tuple[str, Column]]) -> Column:
    """Comma list of the names whose condition holds, NULL when none does.

    ``concat_ws`` skips NULLs, so no higher-order function is needed and the
    expression stays in generated code.
    """
    joined = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in conditions])
    return F.nullif(joined, F.lit(""))


def width_violations(layout: Layout) -> Column:
    """V4: names of columns longer than their VARCHAR(n) limit."""
    return names_where(
        [(f.name, F.length(F.col(f.name)) > F.lit(f.width)) for f in layout.fields if f.width is not None]
    )


# Fixed values of the public modulus-11 check-digit rule for the 14-character
# company id: weights of the first and of the second check digit.
FIRST_DIGIT_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_DIGIT_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CHECKABLE_ID = r"^[0-9A-Z]{12}[0-9]{2}$"


def char_value(c: Column, pos: int) -> Column:
    # Character value is its code minus 48: digits 0-9, letters A=17 ... Z=42.
    return F.ascii(F.substring(c, pos, 1)) - F.lit(48)


def check_digit(total: Column) -> Column:
    r = total % F.lit(11)
    return F.when(r < 2, F.lit(0)).otherwise(F.lit(11) - r)


def typed_value(c: Column | str, kind: str) -> Column:
    """Text -> typed value; anything unparseable becomes NULL."""
    c = _c(c)
    if kind == "date":
        return F.try_to_date(c, "yyyyMMdd")
    if kind == "flag":
        return F.when(c == "S", F.lit(True)).when(c == "N", F.lit(False)).otherwise(F.lit(None).cast("boolean"))
    if kind == "decimal":
        return F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(15,2)")
    return c
