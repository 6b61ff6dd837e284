"""Set operations, ordering and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def concat_align(*frames: DataFrame) -> DataFrame:
    """Stack by name; columns a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def set_difference(df: DataFrame, col: str, vocabulary: DataFrame, vocabulary_col: str | None = None) -> DataFrame:
    """Distinct non-NULL values of ``col`` that the vocabulary does not list."""
    allowed = vocabulary.select(F.col(vocabulary_col or col).alias(col))
    return df.select(col).filter(F.col(col).isNotNull()).distinct().join(allowed, col, "left_anti")


def order_rows(df: DataFrame, by: Sequence[Column | str] | None = None) -> DataFrame:
    """ORDER BY the given columns, or all of them from left to right."""
    return df.orderBy(*(by or df.columns))


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
