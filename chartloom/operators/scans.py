"""Running columns over ordered history, exact and safe for hot keys.

A plain window over ``PARTITION BY key ORDER BY time`` puts a whole key into one task. Here the history of a large key is cut into
ranges of its full order:

1. about one place in ``chunk_rows`` is drawn by a hash of key and order; the drawn places are the bounds of their key's ranges.
   Keys that are much smaller have none and stay whole. The hash-smallest ``MAX_CHUNKS`` places are kept, so what is sent to all
   tasks has a fixed size and ranges grow only beyond ``chunk_rows * MAX_CHUNKS`` rows;
2. rows are shuffled once, by key and range, and the window runs inside the range;
3. the ranges of keys that have bounds are summarised with a partial aggregate (a few values per range), a small window over the
   summaries gives what the earlier ranges contribute, and this is looked up for every row.

Bounds are places in the full order, not times, so a key that holds a third of all rows is spread over many tasks, be it over many
days, at one instant, or without any time. Rows that agree in the key and the whole order share a range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.operators.keys import with_null_free_keys
from chartloom.session import shared_folder

#: Rows of a file of a written table. A scan task takes files up to a number of bytes, each with an opening cost, and well encoded rows
#: are a few bytes on disk but far more in a sort: small files bound the rows of a task.
FILE_ROWS = 250_000
#: Rows of a range, and the most bounds there are: together they limit tasks and what is broadcast.
CHUNK_ROWS, MAX_CHUNKS = 100_000, 16_384


@dataclass(frozen=True)
class Running:
    """One running column. ``kind``: last (non-NULL so far), any, number, or lag."""

    kind: str
    expr: Column | str | None = None


def last_so_far(expr: Column | str) -> Running:
    return Running("last", expr)


def any_so_far(flag: Column | str) -> Running:
    return Running("any", flag)


def row_number() -> Running:
    return Running("number")


def lag(expr: Column | str) -> Running:
    return Running("lag", expr)


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: for inputs that are expensive to compute and read more than once."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per key that is cut: its bounds in order, and every ``__step``-th of them (``__heads``)."""
    drawn = df.select(*keys, *order).withColumn("__h", F.xxhash64(*keys, *order))
    drawn = drawn.filter(F.pmod(F.col("__h"), F.lit(max(1, chunk_rows))) == 0).distinct()
    kept = drawn.orderBy("__h", *keys, *order).limit(MAX_CHUNKS)
    bounds = kept.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("__bounds"))
    step = F.ceil(F.sqrt(F.size("__bounds"))).cast("int")
    heads = F.filter("__bounds", lambda b, i: i % F.col("__step") == 0)
    return bounds.withColumn("__step", step).withColumn("__heads", heads)


def range_number(order: Sequence[str]) -> Column:
    """How many bounds lie before the row: first among the heads, then in the one stretch that is left (0 without bounds)."""
    place = F.struct(*[F.col(c) for c in order])
    past = F.size(F.filter("__heads", lambda b: b < place))
    stretch = F.slice("__bounds", (past - 1) * F.col("__step") + 1, F.col("__step"))
    within = (past - 1) * F.col("__step") + F.size(F.filter(stretch, lambda b: b < place))
    return F.when(F.col("__bounds").isNull() | (past == 0), F.lit(0)).otherwise(within)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Running],
    chunk_rows: int = CHUNK_ROWS,
    whole: int | None = None,
    keep_range: bool = False,
) -> DataFrame:
    """Add running columns over ``keys`` in ascending ``order``.

    The full ``order`` list must be total for a deterministic result. NULL keys form one group, NULLs come first in the order. The
    input is read three times (bounds, summaries of cut keys, rows): pass ``materialised`` rows if it is expensive. Rows that agree
    in the first ``whole`` columns of the order (default: all) stay in one range. With ``keep_range`` the columns stay by which the
    result is partitioned (``range_keys``): what is grouped by them and more columns needs no further shuffle.
    """
    base, on = with_null_free_keys(df, keys)
    cut_by = list(order)[: whole or len(order)]
    place = F.struct(*[F.col(c) for c in order])
    # named columns are used as they are, other expressions are computed before the shuffle
    inputs = {f"__in_{name}": run.expr for name, run in columns.items() if isinstance(run.expr, Column)}
    named = {run.expr for run in columns.values() if isinstance(run.expr, str)}
    base = base.withColumns(inputs) if inputs else base
    base = base.drop(*[c for c in columns if c in df.columns and c not in {*keys, *order, *named}])
    bounds = range_bounds(base, on, cut_by, chunk_rows)

    inside = W.partitionBy(*on, "__chunk").orderBy(*order)
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*on).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)

    local, summary, carried, final = {}, [], {}, {}
    for name, run in columns.items():
        here, part, carry = f"__here_{name}", f"__part_{name}", f"__carry_{name}"
        source = F.col(run.expr if isinstance(run.expr, str) else f"__in_{name}")
        if run.kind == "last":
            local[here] = F.last(source, ignorenulls=True).over(so_far)
            summary.append(F.max_by(source, F.when(source.isNotNull(), place)).alias(part))
            carried[carry] = F.last(part, ignorenulls=True).over(before)
            final[name] = F.coalesce(F.col(here), F.col(carry))
        elif run.kind == "any":
            local[here] = F.max(source).over(so_far)
            summary.append(F.max(source).alias(part))
            carried[carry] = F.max(part).over(before)
            final[name] = F.coalesce(F.greatest(F.col(here), F.col(carry)), F.lit(False))
        elif run.kind == "number":
            local[here] = F.row_number().over(inside)
            summary.append(F.count(F.lit(1)).alias(part))
            carried[carry] = F.sum(part).over(before)
            final[name] = F.col(here) + F.coalesce(F.col(carry), F.lit(0))
        elif run.kind == "lag":
            boxed = F.struct(source.alias("v"))
            local[here] = F.lag(boxed).over(inside)
            summary.append(F.max_by(boxed, place).alias(part))
            carried[carry] = F.last(part).over(before)
            final[name] = F.coalesce(F.col(here), F.col(carry))["v"]
        else:
            raise ValueError(f"unknown running column kind: {run.kind}")

    # both broadcast sides have at most MAX_CHUNKS bounds, and one range more for each key that has any
    def placed(how: str) -> DataFrame:
        marked = base.join(F.broadcast(bounds), on, how)
        return marked.withColumn("__chunk", range_number(cut_by)).drop("__bounds", "__step", "__heads")

    parts = placed("inner").groupBy(*on, "__chunk").agg(*summary).withColumns(carried).select(*on, "__chunk", *carried)
    rows = placed("left").withColumns(local).join(F.broadcast(parts), [*on, "__chunk"], "left").withColumns(final)
    kept = [c for c in df.columns if c not in columns]
    return rows.select(*kept, *columns, *([c for c in [*on, "__chunk"] if c not in kept] if keep_range else []))


def range_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The columns by which a result of ``running(keep_range=True)`` is partitioned."""
    made = [c for i, k in enumerate(keys) for c in ([f"__null{i}", f"__key{i}"] if f"__key{i}" in df.columns else [k])]
    return [*made, "__chunk"]
