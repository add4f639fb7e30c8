"""Row-level transforms: explode, filter, project."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import split_like_java


def explode_fields(lines: DataFrame, col: str = "value", sep: str = ",",
                   keep: list[str] | None = None, out: str = "field") -> DataFrame:
    """FlatMap a line into one row per field (P1), with Java split rules."""
    return lines.select(*(keep or []),
                        F.explode(split_like_java(F.col(col), sep)).alias(out))


def filter_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Keep rows whose ``col`` starts with ``prefix`` (P2). Pushed to the
    scan as a ``StringStartsWith`` filter when ``col`` is a stored column."""
    return df.filter(F.col(col).startswith(prefix))


def project(df: DataFrame, *cols) -> DataFrame:
    """Projection."""
    return df.select(*cols)


def with_length(df: DataFrame, col: str, out: str = "id_length") -> DataFrame:
    """``(col, length(col))`` (P4). Counts characters (code points)."""
    return df.select(F.col(col), F.length(F.col(col)).cast("bigint").alias(out))
