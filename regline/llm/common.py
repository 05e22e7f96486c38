"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regline.session import fresh_dir, ship_package

# A word is a run of anything but space, tab, LF, VT, FF and CR.
WORD = "[^\\x20\\x09-\\x0D]+"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared folder and read it back.

    Cuts the lineage: a task lost later rereads columns instead of
    recomputing, and the rows (with any generated ids) are fixed.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_python(df: DataFrame) -> None:
    """Executors running our Python functions need this package."""
    ship_package(df.sparkSession)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores put before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
