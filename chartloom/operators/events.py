"""Event extraction, projection and row predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.profiling import item_value_stats

# ---- fixed values ----
EXCLUDED_LABELS = ["NO MAPPING", "UNSURE", "MAPPED ELSEWHERE", "SPECIAL CASE", "ALREADY MAPPED"]
BASE_RENAMES = {"subject_id": "patient_id", "hadm_id": "hospitalization_id"}
CHART_COLUMNS = ["itemid", "label", "hadm_id", "stay_id", "charttime AS time", "value", "valuenum", "valueuom"]
PROCEDURE_COLUMNS = ["itemid", "label", "hadm_id", "stay_id", "endtime AS time", "value", "valueuom"]
PROJECTIONS = {"chartevents": CHART_COLUMNS, "procedureevents": PROCEDURE_COLUMNS}
# ---- end of fixed values ----

def vocabulary_values(df: DataFrame, col: str) -> list:
    """Distinct values of a vocabulary column on the driver, as a list that can be pushed to the scan.

    For curated vocabularies. An item set that grows with the data stays a DataFrame, which ``only_items`` joins.
    """
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def only_items(events: DataFrame, items: Iterable | DataFrame, item: str = "itemid") -> DataFrame:
    """Rows of the given items: a list is pushed to the scan, a DataFrame becomes a semi join."""
    if isinstance(items, DataFrame):
        return events.join(items.select(item).distinct(), item, "left_semi")
    return events.filter(F.col(item).isin(list(items)))


def fetch_events_by_table(
    events: DataFrame,
    dictionary: DataFrame,
    items: Iterable | DataFrame,
    table: str,
    original: bool = False,
    item: str = "itemid",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Events of one event table with their dictionary attributes.

    Chart events expose ``charttime`` as ``time``, procedures ``endtime``; other tables keep all
    columns. ``extra`` adds columns to the fixed projection.
    """
    joined = only_items(events, items, item).join(dictionary, item, "left")
    if original or table not in PROJECTIONS:
        return joined
    return joined.selectExpr(*PROJECTIONS[table], *extra)


def fetch_events(
    tables: Mapping[str, DataFrame],
    dictionary: DataFrame,
    items: Iterable | DataFrame,
    original: bool = False,
    item: str = "itemid",
    links: str = "linksto",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Route items to their event tables through the dictionary and stack the events by name.

    A list of items is split per table on the driver from the (small) dictionary, so each scan gets its own pushed-down item filter
    and tables without items are not read. A DataFrame of items (column ``item``) may be of any size: nothing of it comes to the
    driver, every given table is semi-joined with its part. Items that the dictionary does not link have no events
    (``check_known_items`` reports them).
    """
    if isinstance(items, DataFrame):
        linked = items.select(item).distinct().join(dictionary.select(item, F.col(links).alias("__links")).distinct(), item)
        parts = [
            fetch_events_by_table(df, dictionary, linked.filter(F.col("__links") == name), name, original, item, extra)
            for name, df in sorted(tables.items())
        ]
        return reduce(stack_events, parts)
    wanted = sorted(set(items))
    # bounded by the wanted items times the event tables
    routed = dictionary.filter(F.col(item).isin(wanted)).select(links, item).distinct().collect()
    by_table: dict[str, list] = {}
    for row in routed:
        by_table.setdefault(row[0], []).append(row[1])
    unknown = sorted(set(by_table) - set(tables) - {None})
    if unknown:
        raise ValueError(f"items link to event tables that were not given: {unknown}")
    parts = [
        fetch_events_by_table(tables[name], dictionary, sorted(ids), name, original, item, extra)
        for name, ids in sorted((k, v) for k, v in by_table.items() if k is not None)
    ]
    if not parts:
        raise ValueError("none of the items is in the dictionary")
    out = parts[0]
    for part in parts[1:]:
        out = stack_events(out, part)
    return out


def stack_events(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; a shared column of different types becomes text (mixed value columns)."""
    types_a, types_b = dict(a.dtypes), dict(b.dtypes)
    clash = [c for c in types_a if c in types_b and types_a[c] != types_b[c]]
    for c in clash:
        a, b = a.withColumn(c, F.col(c).cast("string")), b.withColumn(c, F.col(c).cast("string"))
    return a.unionByName(b, allowMissingColumns=True)


def fetch_labs(
    labs: DataFrame, items: Iterable | DataFrame, item: str = "itemid", encounter: str = "hadm_id"
) -> DataFrame:
    """Laboratory events of the given items that belong to an encounter."""
    return only_items(labs, items, item).filter(F.col(encounter).isNotNull())


def relevant_items(
    mapping: DataFrame,
    decision: str,
    excluded_labels: Sequence[str] = tuple(EXCLUDED_LABELS),
    excluded_items: Sequence = (),
    item: str = "itemid",
) -> DataFrame:
    """Distinct items whose decision is not excluded; a NULL decision is kept."""
    keep = ~F.coalesce(F.col(decision).isin(list(excluded_labels)), F.lit(False))
    if excluded_items:
        keep = keep & ~F.coalesce(F.col(item).isin(list(excluded_items)), F.lit(False))
    return mapping.filter(keep).select(item).distinct()


def include_decision(mapping: DataFrame, labels: str | Sequence[str], decision: str = "decision") -> DataFrame:
    labels = [labels] if isinstance(labels, str) else list(labels)
    return mapping.filter(F.col(decision).isin(labels))


def filter_contains(df: DataFrame, col: str, text: str) -> DataFrame:
    """Substring filter on the text form of a column, where a missing value reads "nan"."""
    return df.filter(F.coalesce(F.col(col).cast("string"), F.lit("nan")).contains(text))


def items_by_id_width(df: DataFrame, width: int, item: str = "itemid") -> DataFrame:
    """Items whose id has ``width`` digits."""
    return df.filter(F.length(F.col(item).cast("bigint").cast("string")) == width)


def drop_null_and_sentinel(df: DataFrame, not_null: str, col: str, sentinel: str = "UNKNOWN") -> DataFrame:
    """Drop rows without an encounter or with the sentinel; a NULL in ``col`` is kept."""
    return df.filter(F.col(not_null).isNotNull() & ~F.col(col).eqNullSafe(F.lit(sentinel)))


def guarded_sentinel_drop(
    df: DataFrame, expected_item, value: str = "value", item: str = "itemid", sentinel: str = "None"
) -> DataFrame:
    """Drop sentinel rows; the job fails on one that belongs to another item than expected.

    The check is part of the filter, so building the plan runs nothing; ``sentinel_violations`` reports what fails.
    """
    is_sentinel = F.col(value).eqNullSafe(F.lit(sentinel))
    stray = F.raise_error(F.lit(f"rows with {value}={sentinel!r} must all have {item}={expected_item}")).cast("boolean")
    return df.filter(F.when(is_sentinel, F.when(F.col(item).eqNullSafe(F.lit(expected_item)), False).otherwise(stray)).otherwise(True))


def sentinel_violations(
    df: DataFrame, expected_item, value: str = "value", item: str = "itemid", sentinel: str = "None"
) -> DataFrame:
    """``violation, itemid, n``: sentinel rows of other items, and the expected item if it has none (n = 0)."""
    seen = df.filter(F.col(value) == sentinel).groupBy(F.col(item).alias("itemid")).agg(F.count(F.lit(1)).alias("n"))
    stray = seen.filter(~F.col("itemid").eqNullSafe(F.lit(expected_item))).select(F.lit("other item").alias("violation"), "itemid", "n")
    kind = df.schema[item].dataType
    total = seen.agg(F.coalesce(F.sum(F.when(F.col("itemid") == F.lit(expected_item), F.col("n"))), F.lit(0)).cast("long").alias("n"))
    absent = total.filter("n = 0").select(F.lit("no row of the item").alias("violation"), F.lit(expected_item).cast(kind).alias("itemid"), "n")
    return stray.unionByName(absent)


def rename_reorder(
    df: DataFrame, renames: Mapping[str, str], columns: Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename, then take exactly ``columns``: missing ones are NULL, others are dropped."""
    types = types or {}
    df = df.withColumnsRenamed({k: v for k, v in {**BASE_RENAMES, **renames}.items() if k in df.columns})
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c) for c in columns]
    )


def sort_events(df: DataFrame, encounter: str = "hadm_id", extra: Sequence[str] = ()) -> DataFrame:
    """Parse the time columns and order by encounter and time (interval, chart or generic shape)."""
    if {"starttime", "endtime"} <= set(df.columns):
        times, tail = ["starttime", "endtime"], ["storetime"]
    elif "charttime" in df.columns:
        times, tail = ["charttime"], ["storetime"]
    elif "time" in df.columns:
        times, tail = ["time"], []
    else:
        return df
    df = df.withColumns({t: F.col(t).cast("timestamp") for t in times})
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in [encounter, *times, *tail, *extra]])


def select_regex(df: DataFrame, pattern: str, cast: str | None = None) -> DataFrame:
    """Columns whose name contains a match of ``pattern``."""
    import re

    names = [c for c in df.columns if re.search(pattern, c)]
    return df.select(*[F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in names])


def select_exclude(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def select_replace(df: DataFrame, **exprs: Column) -> DataFrame:
    """Replace existing columns in place, evaluated on the input row."""
    missing = set(exprs) - set(df.columns)
    if missing:
        raise ValueError(f"cannot replace unknown columns: {sorted(missing)}")
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def item_search(
    tables: Mapping[str, DataFrame],
    dictionary: DataFrame,
    keyword: str,
    col: str = "label",
    case_sensitive: bool = False,
    item: str = "itemid",
    links: str = "linksto",
) -> DataFrame:
    """Items whose dictionary text contains the keyword, with their usage statistics.

    Without a match the result is a single row holding the keyword.
    """
    text = F.col(col)
    hit = text.contains(keyword) if case_sensitive else F.lower(text).contains(keyword.lower())
    found = dictionary.filter(hit)
    parts = [item_value_stats(table, found.filter(F.col(links) == name), name, item) for name, table in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    spark = dictionary.sparkSession
    kw = spark.range(1).select(F.lit(keyword).alias("kw"))
    # a one-row left side keeps the keyword when nothing matched
    return kw.join(out.withColumn("kw", F.lit(keyword)), "kw", "left").orderBy(F.col("count").desc_nulls_last())
