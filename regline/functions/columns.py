"""Column expressions shared by batch and streaming plans.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_text(raw: Column | str, encoding: str = "ISO-8859-1") -> Column:
    """Raw line bytes -> text. The text source does not decode by itself."""
    return F.decode(_c(raw).cast("binary"), encoding)


def strip_line_end(line: Column | str) -> Column:
    """Remove exactly one carriage return at the very end.

    ``dbl\\r\\r`` keeps its first CR. No regex: it cost more than the scan.
    """
    c = _c(line)
    return F.when(F.endswith(c, F.lit("\r")), F.left(c, F.length(c) - 1)).otherwise(c)


def java_literal_regex(sep: str) -> str:
    """A regex matching ``sep`` literally. A single plain character is kept
    as is, which lets the split take its single-byte fast path."""
    if len(sep) == 1 and sep not in ".$|()[]{}^?*+\\":
        return sep
    if "\\E" in sep:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return "\\Q" + sep + "\\E"


def split_fields(line: Column | str, sep: str = ";") -> Column:
    """Split at every separator, keeping leading, inner and trailing empties.

    No quoting or escaping: a quote is an ordinary character.
    """
    return F.split(_c(line), java_literal_regex(sep), -1)


def field_at(fields: Column | str, position: int) -> Column:
    """Field by 0-based position; NULL past the end (``get`` never raises)."""
    return F.get(_c(fields), F.lit(position))


def empty_to_null(c: Column | str) -> Column:
    """P5: the empty string is the only missing value; a space is kept."""
    return F.nullif(_c(c), F.lit(""))


def trim_blank(c: Column | str) -> Column:
    """Remove spaces and tabs (only those) at both ends."""
    return F.btrim(_c(c), F.lit(" \t"))


def escape_copy_text(c: Column | str) -> Column:
    """Escape backslash first, then tab, line feed and carriage return."""
    out = F.replace(_c(c), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("\t"), F.lit("\\t"))
    out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    return F.replace(out, F.lit("\r"), F.lit("\\r"))


def copy_text_line(cols: list[str]) -> Column:
    """One tab-separated line, ``\\N`` for NULL."""
    return F.concat_ws("\t", *[F.coalesce(escape_copy_text(c), F.lit("\\N")) for c in cols])
