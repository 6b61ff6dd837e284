"""Key helpers shared by the operators: null-safe joins and duplicate-free lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal key names where NULL equals NULL; keeps one copy of each key."""
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, all_of([F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on]), how)
    if how in ("left_semi", "left_anti"):
        return joined
    full = how in ("full", "outer", "full_outer", "right", "right_outer")
    keys = [(F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")) if full else F.col(f"l.{k}")).alias(k) for k in on]
    rest = [F.col(f"l.{c}") for c in left.columns if c not in on]
    rest += [F.col(f"r.{c}") for c in right.columns if c not in on]
    return joined.select(*keys, *rest)


_DEFAULTS: dict[type, str] = {
    T.StringType: "",
    T.BooleanType: "false",
    T.TimestampType: "1970-01-01 00:00:00",
    T.TimestampNTZType: "1970-01-01 00:00:00",
    T.DateType: "1970-01-01",
}


def with_null_free_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add NULL-free stand-ins for ``keys`` so that windows and equi-joins share one exchange.

    Each nullable key gets a flag plus the value with a typed default; the pair is one-to-one
    with the key including NULL.
    """
    names: list[str] = []
    extra: dict[str, Column] = {}
    for i, key in enumerate(keys):
        field = df.schema[key]
        if not field.nullable:
            names.append(key)
            continue
        default = F.lit(_DEFAULTS.get(type(field.dataType), "0")).cast(field.dataType)
        extra[f"__null{i}"] = F.col(key).isNull()
        extra[f"__key{i}"] = F.coalesce(F.col(key), default)
        names += [f"__null{i}", f"__key{i}"]
    return df.withColumns(extra) if extra else df, names


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order`` (NULL keys form one group).

    The rank filter is planned with a partial group limit, so every task keeps at most one row
    per key before the shuffle and a hot key costs no more than any other.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def last_per_key(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(ordinal).desc_nulls_last()])
