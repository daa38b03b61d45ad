"""Columns that are computed once, however often they are used."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows and columns, with the given columns computed at this point.

    The optimizer copies expressions into the filters and Python UDFs that use
    them, once per mention, and a chain of rules that each mention their text
    twice or more grows beyond all bounds. It does not look through a generator,
    here one that yields a single row per row.
    """
    held = df.select(
        *[c for c in df.columns if c not in columns],
        F.explode(F.array(F.struct(*columns))).alias("_held"),
    )
    return held.select(
        *[F.col("_held")[c].alias(c) if c in columns else F.col(c) for c in df.columns]
    )
