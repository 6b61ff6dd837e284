"""Wide / long reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cells(key: str, value: Column, names: Mapping, how) -> list[Column]:
    return [how(F.col(key) == k, value).alias(str(name)) for k, name in names.items()]


def _names(values: Sequence | Mapping) -> Mapping:
    return values if isinstance(values, Mapping) else {v: v for v in values}


def pivot_unique(
    df: DataFrame, index: Sequence[str], key: str, value: str, values: Sequence | Mapping
) -> DataFrame:
    """Pivot that fails on a duplicate cell. ``values`` lists the keys, or maps them to names.

    The check is part of the aggregation, so the data is read once.
    """
    problem = F.lit(f"pivot: more than one {value} for an index and {key}")

    def cell(hit: Column, v: Column) -> Column:
        unique = F.count(F.when(hit, 1)) <= 1
        return F.when(unique, F.max(F.when(hit, v))).otherwise(F.raise_error(problem))

    return df.groupBy(*index).agg(*_cells(key, F.col(value), _names(values), cell))


def pivot_first(
    df: DataFrame, index: Sequence[str], key: str, value: str, values: Sequence | Mapping, order: Sequence[str]
) -> DataFrame:
    """Pivot keeping the first value in ``order``."""
    place = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*index).agg(
        *_cells(key, F.col(value), _names(values), lambda hit, v: F.min_by(v, F.when(hit, place)))
    )


def pivot_max(df: DataFrame, index: Sequence[str], key: str, value: str, values: Sequence | Mapping) -> DataFrame:
    return df.groupBy(*index).agg(
        *_cells(key, F.col(value), _names(values), lambda hit, v: F.max(F.when(hit, v)))
    )


def unpivot_drop_nulls(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str
) -> DataFrame:
    """Wide to long without the NULL cells."""
    return df.unpivot(list(ids), list(cols), name, value).filter(F.col(value).isNotNull())


def melt_keep_nulls(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long, NULL cells included."""
    return df.unpivot(list(ids), list(cols), name, value)


def coalesce_columns(df: DataFrame, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Ordered fallbacks; the source columns are dropped."""
    out = df.withColumns({name: F.coalesce(*[F.col(c) for c in cols]) for name, cols in rules.items()})
    return out.drop(*[c for name, cols in rules.items() for c in cols if c != name and c not in rules])


def interval_to_points(
    df: DataFrame, start: str, end: str, point: str = "admin_dttm", kind: str = "timestamp_type"
) -> DataFrame:
    """Each (start, end) row becomes two timestamped rows; a missing end gives none."""
    points = F.array(
        F.struct(F.lit(start).alias("k"), F.col(start).alias("t")),
        F.struct(F.lit(end).alias("k"), F.col(end).alias("t")),
    )
    rest = [c for c in df.columns if c not in (start, end)]
    exploded = df.select(*rest, F.explode(points).alias("__p"))
    return exploded.select(*rest, F.col("__p.k").alias(kind), F.col("__p.t").alias(point)).filter(
        F.col(point).isNotNull()
    )


def pivot_wide_fill_null(
    df: DataFrame, index: Sequence[str], key: str, value: str, values: Sequence | Mapping
) -> DataFrame:
    """Categories to columns, absent ones NULL; several values in a cell resolve to the smallest."""
    return df.groupBy(*index).agg(
        *_cells(key, F.col(value), _names(values), lambda hit, v: F.min(F.when(hit, v)))
    )
