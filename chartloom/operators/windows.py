"""De-duplication, ranking and ordered-history operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.operators import scans
from chartloom.operators.keys import any_of, first_per_key, null_safe_join, with_null_free_keys

#: Bytes of group texts that the rows of a piece receive.
TEXT_BYTES = 1 << 28


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_keys(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key. ``order`` should be total; it replaces the accidental order of a file."""
    return first_per_key(df, keys, order)


def distinct_on(df: DataFrame, keys: Sequence[str], not_null: str, order: Sequence[Column | str]) -> DataFrame:
    """DISTINCT ON (keys) among rows with ``not_null`` present; NULL keys are equal."""
    return first_per_key(df.filter(F.col(not_null).isNotNull()), keys, order)


def earliest_of(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, into: str
) -> DataFrame:
    """FULL JOIN on key, COALESCE of the two times, earliest one per key (keys without are dropped)."""
    a = left.filter(F.col(left_time).isNotNull()).groupBy(key).agg(F.min(left_time).alias("__left"))
    b = right.filter(F.col(right_time).isNotNull()).groupBy(key).agg(F.min(right_time).alias("__right"))
    return a.join(b, key, "full").select(key, F.coalesce("__left", "__right").alias(into))


def qualify_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1."""
    return first_per_key(df, keys, order)


def ranked_dedup(
    df: DataFrame,
    keys: Sequence[str],
    applies: Column,
    category: str,
    ranking: Sequence[str],
    order: Sequence[str],
    exclude: Column | None = None,
) -> DataFrame:
    """One row per key; among rows where ``applies``, prefer the best-ranked category.

    Rows whose category is NULL are not ranked: the survivor is the earlier (in ``order``) of the
    best ranked row and the first unranked row. ``exclude`` drops rows whose key has duplicates.
    """
    ranked = F.coalesce(applies, F.lit(False)) & F.col(category).isNotNull()
    position = F.array_position(F.array(*[F.lit(r) for r in ranking]), F.col(category))
    df = df.withColumns({"__ranked": ranked, "__pos": F.when(ranked, position).otherwise(F.lit(0).cast("bigint"))})
    if exclude is None:
        kept = first_per_key(df, [*keys, "__ranked"], [F.col("__pos"), *order])
    else:
        best = first_per_key(df.filter("__ranked"), keys, [F.col("__pos"), *order])
        kept = df.filter(~F.col("__ranked")).unionByName(best)
        crowded = kept.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("__dup"))
        kept = null_safe_join(kept, crowded, keys, "left")
        kept = kept.filter(~(F.col("__dup") & F.coalesce(exclude, F.lit(False)))).drop("__dup")
    return first_per_key(kept, keys, order).drop("__ranked", "__pos")


def running_last_non_null(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, into: str | None = None, **kw
) -> DataFrame:
    """LAST_VALUE(value IGNORE NULLS) up to the current row."""
    return scans.running(df, keys, order, {into or value: scans.last_so_far(value)}, **kw)


def running_any(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, into: str, **kw) -> DataFrame:
    """TRUE from the first row of the key where ``flag`` holds."""
    return scans.running(df, keys, order, {into: scans.any_so_far(flag)}, **kw)


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "rn", **kw) -> DataFrame:
    """ROW_NUMBER over the key's history."""
    return scans.running(df, keys, order, {into: scans.row_number()}, **kw)


def window_string_agg(
    df: DataFrame, keys: Sequence[str], value: str, into: str, sep: str = ", ", distinct: bool = False
) -> DataFrame:
    """Every row gets the sorted, joined values of its whole group (NULLs skipped, NULL if none).

    Equal values are counted before they are gathered and the text is built once per group. What the rows of a group receive grows
    with the square of its rows, so a group is cut into pieces that receive ``TEXT_BYTES`` each, and pieces are dealt to all tasks.
    A group of several pieces has thousands of rows, so the table of these groups is small against the rows and is broadcast.
    """
    base, on = with_null_free_keys(df, keys)
    counts = base.groupBy(*on, value).agg(F.count(F.lit(1)).alias("__n"))
    there = F.col(value).isNotNull()
    pairs = F.sort_array(F.collect_list(F.when(there, F.struct(F.col(value).alias("v"), F.col("__n").cast("int").alias("n")))))
    words = F.transform(pairs, lambda p: p["v"]) if distinct else F.flatten(
        F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"]))
    )
    length = F.sum(F.when(there, (F.octet_length(F.col(value).cast("string")) + len(sep)) * (F.lit(1) if distinct else F.col("__n"))))
    pieces = F.greatest(F.lit(1), F.ceil(F.sum("__n") * length.cast("double") / TEXT_BYTES).cast("int")).alias("__pieces")
    texts = counts.groupBy(*on).agg(F.when(F.size(pairs) > 0, F.array_join(words, sep)).alias(into), pieces)
    texts = texts.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))).drop("__pieces")
    large = F.broadcast(counts.groupBy(*on).agg(pieces).filter("__pieces > 1"))
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    piece = F.coalesce(F.pmod(F.xxhash64(*hashed), F.col("__pieces")).cast("int"), F.lit(0))
    # by a fixed number: the rows are narrow and the pieces are not, so they must not be coalesced by size
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = base.join(large, on, "left").withColumn("__piece", piece).repartition(tasks, *on, "__piece")
    return dealt.join(texts, [*on, "__piece"], "left").select(*keys, *[c for c in df.columns if c not in keys], into)


def window_string_in_place(df: DataFrame, within: Sequence[str], value: str, into: str, sep: str = ", ") -> DataFrame:
    """``window_string_agg`` for rows that are already partitioned by some of the columns ``within`` and have small groups: one
    window, no join and no shuffle."""
    values = F.collect_list(value).over(W.partitionBy(*within))
    return df.withColumn(into, F.when(F.size(values) > 0, F.array_join(F.sort_array(values), sep)))


def partition_count(df: DataFrame, keys: Sequence[str], into: str = "n") -> DataFrame:
    """COUNT(*) OVER (PARTITION BY keys) as a pre-aggregated count joined back."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(into))
    return null_safe_join(df, counts, keys, "left")


def deprioritised_first(
    df: DataFrame, key: str, value: str, last_pattern: str, order: Sequence[str] = ()
) -> DataFrame:
    """One row per key, taking a value that contains ``last_pattern`` (any case) only if there is no other."""
    late = F.when(F.lower(F.col(value)).contains(last_pattern.lower()), 9).otherwise(1)
    return first_per_key(df, [key], [late, *(order or [value])])


def overlap_check(df: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str] = (), **kw) -> DataFrame:
    """Intervals that start before the previous interval of the same key has ended."""
    prev = f"{end}_prev"
    out = scans.running(df, keys, [start, *tie], {prev: scans.lag(end)}, **kw)
    return out.filter(F.col(start) < F.col(prev))


def find_duplicates(df: DataFrame, keys: Sequence[str] = ("hadm_id", "time", "itemid")) -> DataFrame:
    """All rows whose key occurs more than once (NULL keys are equal)."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).drop("__n")
    return null_safe_join(df, repeated, list(keys), "left_semi")


def check_duplicates(df: DataFrame, additional: Sequence[str] = ()) -> DataFrame:
    """``find_duplicates`` on a harmonised table."""
    return find_duplicates(df, ["hospitalization_id", "recorded_dttm", *additional])


def concurrent_values(df: DataFrame, keys: Sequence[str], value: str, into: str) -> DataFrame:
    """Rows of groups with several distinct values, with those values listed."""
    multi = df.groupBy(*keys).agg(F.countDistinct(value).alias("__n")).filter(F.col("__n") > 1)
    hits = null_safe_join(df, multi, keys, "inner").withColumnRenamed("__n", f"n_{into}")
    return window_string_agg(hits, keys, value, into, "; ", distinct=True)
