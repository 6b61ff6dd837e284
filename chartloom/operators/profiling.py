"""Aggregations and profiling reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.keys import first_per_key, null_safe_join
from chartloom.operators.quantiles import exact_quantiles

ITEM_COLUMNS = ["itemid", "label", "abbreviation", "linksto", "category", "unitname", "param_type"]


def _text(col: Column) -> Column:
    """NULL prints as nothing inside a concatenation."""
    return F.coalesce(col.cast("string"), F.lit(""))


def item_stats_numeric(df: DataFrame, keys: Sequence[str], value: str, into: str = "value_instances") -> DataFrame:
    """Per item: row count and a min / mean / max text."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.concat(
            F.lit("Min: "), _text(F.min(value)), F.lit(", Mean: "), _text(F.round(F.avg(value), 2)),
            F.lit(", Max: "), _text(F.max(value)),
        ).alias(into),
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str, keep: Column | None = None) -> DataFrame:
    """Per item and value: number of rows. The long form of a breakdown, for any number of values."""
    keep = F.col(value).isNotNull() & (F.col(value) != "") if keep is None else keep
    return df.filter(keep).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def breakdown(
    df: DataFrame, keys: Sequence[str], value: str, into: str, keep: Column | None = None, sep: str = ", "
) -> DataFrame:
    """Per item: ``value: n`` pairs, most frequent first (ties by value).

    Rows are counted per value before anything is gathered, so a group holds one entry per
    distinct value. A NULL value prints as an empty name.
    """
    counts = value_counts(df, keys, value, keep)
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), _text(F.col(value)).alias("v"))))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(p["v"], F.lit(": "), (-p["m"]).cast("string"))), sep)
    return counts.groupBy(*keys).agg(text.alias(into))


def item_stats_categorical(df: DataFrame, keys: Sequence[str], value: str, into: str = "value_instances") -> DataFrame:
    total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return null_safe_join(total, breakdown(df, keys, value, into), keys, "left")


def item_stats_datetime(df: DataFrame, keys: Sequence[str], value: str, into: str = "value_instances") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.concat(F.lit("Earliest: "), _text(F.min(value)), F.lit(", Latest: "), _text(F.max(value))).alias(into),
    )


def exact_medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Exact median of several columns per key, as ``<col>_median``, in one quantile pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(*keys, F.explode(cells).alias("__cell")).select(*keys, "__cell.c", "__cell.v")
    medians = exact_quantiles(long, [*keys, "c"], "v", {"m": 0.5})
    return medians.groupBy(*keys).agg(*[F.max(F.when(F.col("c") == c, F.col("m"))).alias(f"{c}_median") for c in cols])


def spread(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key: count, and min, exact median and max of each column."""
    ends = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        *[a for c in cols for a in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))],
    )
    return null_safe_join(ends, exact_medians(df, keys, cols), keys, "left")


def _range_text(col: str) -> Column:
    parts = [_text(F.round(F.col(f"{col}_{end}"), 2)) for end in ("min", "median", "max")]
    return F.concat(parts[0], F.lit(", "), parts[1], F.lit(", "), parts[2])


def item_stats_rate_amount(
    df: DataFrame, keys: Sequence[str], rate: str, amount: str, into: str = "value_instances"
) -> DataFrame:
    """Per item: min, median, max of rate and amount as one text."""
    text = F.concat(F.lit("Rate: "), _range_text(rate), F.lit("; Amount: "), _range_text(amount))
    return spread(df, keys, [rate, amount]).select(*keys, "count", text.alias(into))


def item_stats_uom_breakdown(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], non_empty: Mapping[str, str] | None = None
) -> DataFrame:
    """One breakdown text per unit or order-category column, named ``<col>_instances``.

    ``non_empty`` names another column whose value must not be empty instead of the column's own,
    e.g. ``{"amountuom": "rateuom"}``.
    """
    def cell(col: str) -> Column:
        other = (non_empty or {}).get(col, col)
        keep = F.col(col).isNotNull() & (F.col(other) != "")
        return F.when(keep, F.struct(F.lit(col).alias("c"), F.col(col).cast("string").alias("v")))

    # all columns are counted in one pass; the empty cell keeps items without any value
    empty = F.struct(F.lit("").alias("c"), F.lit("").alias("v"))
    cells = df.select(*keys, F.explode(F.array_compact(F.array(empty, *[cell(c) for c in cols]))).alias("__cell"))
    counts = cells.groupBy(*keys, F.col("__cell.c").alias("__c"), F.col("__cell.v").alias("__v")).agg(
        F.count(F.lit(1)).alias("__n")
    )

    def text(col: str) -> Column:
        pair = F.struct((-F.col("__n")).alias("m"), F.col("__v").alias("v"))
        pairs = F.sort_array(F.collect_list(F.when(F.col("__c") == col, pair)))
        parts = F.transform(pairs, lambda p: F.concat(p["v"], F.lit(": "), (-p["m"]).cast("string")))
        return F.when(F.size(pairs) > 0, F.array_join(parts, ", ")).alias(f"{col}_instances")

    return counts.groupBy(*keys).agg(*[text(c) for c in cols])


# Columns broken down per event table.
INPUT_BREAKDOWNS = [
    "amountuom", "rateuom", "ordercategoryname", "secondaryordercategoryname", "ordercategorydescription",
]

# The statistic of an item without events.
EMPTY_STATS = {
    "chartevents": "Min: , Mean: , Max: ",
    "procedureevents": "Min: , Mean: , Max: ",
    "datetimeevents": "Earliest: , Latest: ",
    "inputevents": "Rate: , , ; Amount: , , ",
    "ingredientevents": "Rate: , , ; Amount: , , ",
    "outputevents": "Min: , Median: , Max: ",
}


def item_value_stats(events: DataFrame, items: DataFrame, table: str, item: str = "itemid") -> DataFrame:
    """Usage statistics of dictionary items in one event table; the statistic depends on the table.

    An item without events counts 1, as its outer-joined row does.
    """
    used = events.join(items.select(item, "param_type"), item, "left_semi" if table != "chartevents" else "inner")
    keys = [item]
    if table not in EMPTY_STATS:
        raise NotImplementedError(f"no item statistics for event table {table!r}")
    if table == "chartevents":
        numeric = item_stats_numeric(used.filter(F.col("param_type") == "Numeric"), keys, "valuenum")
        texts = item_stats_categorical(used.filter(F.col("param_type").isin("Text", "Checkbox")), keys, "value")
        named = F.coalesce(F.col("param_type").isin("Numeric", "Text", "Checkbox"), F.lit(False))
        other = used.filter(~named).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("count"), F.first("param_type").alias("value_instances")
        )
        stats = numeric.unionByName(texts).unionByName(other)
    elif table == "procedureevents":
        stats = item_stats_numeric(used, keys, "value")
    elif table == "datetimeevents":
        stats = item_stats_datetime(used, keys, "value")
    elif table in ("inputevents", "ingredientevents"):
        stats = item_stats_rate_amount(used, keys, "rate", "amount")
        if table == "inputevents":
            stats = stats.join(
                item_stats_uom_breakdown(used, keys, INPUT_BREAKDOWNS, {"amountuom": "rateuom"}), keys, "left"
            )
    else:
        text = F.concat(
            F.lit("Min: "), _text(F.round("value_min", 2)), F.lit(", Median: "), _text(F.round("value_median", 2)),
            F.lit(", Max: "), _text(F.round("value_max", 2)),
        )
        stats = spread(used, keys, ["value"]).select(*keys, "count", text.alias("value_instances")).join(
            breakdown(used, keys, "valueuom", "valueuom_instances"), keys, "left"
        )
    described = items.select(*[c for c in ITEM_COLUMNS if c in items.columns])
    empty = F.lit(EMPTY_STATS[table])
    if table == "chartevents":
        empty = F.when(F.col("param_type") == "Numeric", empty).when(
            ~F.coalesce(F.col("param_type").isin("Text", "Checkbox"), F.lit(False)), F.col("param_type")
        )
    unused = F.col("count").isNull()
    return described.join(stats, item, "left").withColumns({
        "value_instances": F.when(unused, empty).otherwise(F.col("value_instances")),
        "count": F.coalesce(F.col("count"), F.lit(1).cast("bigint")),
    })


def lab_item_stats(labs: DataFrame, dictionary: DataFrame, keep: Column, item: str = "itemid") -> DataFrame:
    """Lab usage: min, mean, median, max and a unit breakdown that keeps the missing unit."""
    used = labs.join(dictionary.filter(keep), item)
    keys = [item]
    base = used.groupBy(item, "label", "fluid", "category").agg(
        F.count(F.lit(1)).alias("n"), F.min("valuenum").alias("lo"), F.avg("valuenum").alias("mean"),
        F.max("valuenum").alias("hi"),
    )
    base = base.join(exact_quantiles(used, keys, "valuenum", {"median": 0.5}), keys, "left")
    base = base.join(breakdown(used, keys, "valueuom", "uom_instances", F.lit(True), "; "), keys, "left")
    value = F.concat(*[
        part for label, c in (("min: ", "lo"), ("; mean: ", "mean"), ("; median: ", "median"), ("; max: ", "hi"))
        for part in (F.lit(label), F.round(F.col(c), 1).cast("string"))
    ])
    return base.select(
        item, "label", F.lit("").alias("abbreviation"), "fluid", "category", "n", value.alias("value_instances"),
        "uom_instances",
    )


def most_frequent(
    df: DataFrame, entity: str, attributes: Sequence[str], recency: str, uninformative: Column
) -> DataFrame:
    """Most frequent attribute combination per entity: count, then informative, then most recent.

    Remaining ties are settled by the attributes themselves.
    """
    flagged = df.withColumn("__flag", F.coalesce(uninformative, F.lit(False)).cast("int"))
    grouped = flagged.groupBy(entity, *attributes, "__flag").agg(
        F.count(F.lit(1)).alias("__count"), F.max(recency).alias("__recent")
    )
    order = [F.col("__count").desc(), F.col("__flag"), F.col("__recent").desc(), *[F.col(a) for a in attributes]]
    return first_per_key(grouped, [entity], order).select(entity, *attributes)


def conditional_pivot_max(df: DataFrame, keys: Sequence[str], columns: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """MAX(CASE WHEN condition THEN value END) per key for every named column."""
    return df.groupBy(*keys).agg(*[F.max(F.when(cond, value)).alias(name) for name, (cond, value) in columns.items()])


def first_value_per_group(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """The value of the first row in ``order`` per key (NULLs count as values)."""
    box = F.min_by(F.struct(F.col(value).alias("v")), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(key).agg(box["v"].alias(value))


def inconsistent_entities(df: DataFrame, entity: str, cols: Sequence[str]) -> DataFrame:
    """Entities with more than one distinct value in any of ``cols``, with the counts."""
    counts = df.groupBy(entity).agg(*[F.countDistinct(c).alias(f"unique_{c}") for c in cols])
    keep = F.lit(False)
    for c in cols:
        keep = keep | (F.col(f"unique_{c}") > 1)
    return counts.filter(keep)


def inconsistency_summary(df: DataFrame, entity: str, cols: Sequence[str]) -> DataFrame:
    """One row: entities in total, and per column how many (and what share) have several values."""
    per_entity = df.groupBy(entity).agg(*[F.countDistinct(c).alias(c) for c in cols])
    total = F.count(entity)
    many = {c: F.count(F.when(F.col(entity).isNotNull() & (F.col(c) > 1), 1)) for c in cols}
    return per_entity.agg(
        total.alias("n_entities"), *[n.alias(f"n_{c}") for c, n in many.items()],
        *[F.round(n / total, 4).alias(f"share_{c}") for c, n in many.items()],
    )


def net_volume(df: DataFrame, keys: Sequence[str], is_in: Column, is_out: Column, volume: str) -> DataFrame:
    """Per key: which directions occur, their volumes, and the signed net (in counts negative)."""
    v = F.col(volume)
    return df.filter(is_in | is_out).groupBy(*keys).agg(
        F.max(F.when(is_in, 1).otherwise(0)).alias("has_in"),
        F.max(F.when(is_out, 1).otherwise(0)).alias("has_out"),
        F.sum(F.when(is_in, v).otherwise(0)).alias("vol_in"),
        F.sum(F.when(is_out, v).otherwise(0)).alias("vol_out"),
        F.sum(F.when(is_in, -v).otherwise(v)).alias("net_volume"),
    )


def cooccurrence_summary(net: DataFrame) -> DataFrame:
    """Counts and net-volume statistics per in/out pattern."""
    both = (F.col("has_in") == 1) & (F.col("has_out") == 1)
    pattern = (
        F.when(both, "both_in_and_out").when(F.col("has_in") == 1, "in_only").when(F.col("has_out") == 1, "out_only")
    )
    tagged = net.withColumn("cooccur_pattern", pattern)
    stats = tagged.groupBy("cooccur_pattern").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("net_volume") < 0, 1)).alias("n_net_negative"),
        F.count(F.when(F.col("net_volume") == 0, 1)).alias("n_net_zero"),
        F.round(F.avg("net_volume"), 1).alias("avg_net"),
    )
    median = exact_quantiles(tagged, ["cooccur_pattern"], "net_volume", {"median_net": 0.5})
    return null_safe_join(stats, median, ["cooccur_pattern"], "left").withColumn(
        "median_net", F.round("median_net", 1)
    )


# The profile's quantiles.
PROFILE_QUANTILES = {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def quantile_profile(df: DataFrame, value: str, keys: Sequence[str] = (), keep: Column | None = None) -> DataFrame:
    """min, p5, p25, median, p75, p95, max and the number of non-positive values, per key.

    ``keep`` is the FILTER clause of the quantiles; counts and ends see all rows.
    """
    keys = list(keys)
    ends = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.count(F.when(F.col(value) <= 0, 1)).alias("n_nonpositive"),
    )
    inner = exact_quantiles(df if keep is None else df.filter(keep), keys, value, PROFILE_QUANTILES)
    if not keys:
        # two one-row frames
        return ends.join(F.broadcast(inner), F.lit(True), "left")
    return null_safe_join(ends, inner, keys, "left")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Total rows and NULL count per column, in one pass."""
    cols = cols or df.columns
    return df.agg(
        F.count(F.lit(1)).alias("n_total"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n_null_{c}") for c in cols]
    )


def category_distribution(df: DataFrame, by: Sequence[str], value: str | None = None) -> DataFrame:
    """Rows per category combination, percent of the total, and optionally mean and median."""
    by = list(by)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.round(F.avg(value), 1).alias("avg_value"))
    out = df.groupBy(*by).agg(*aggs)
    # the total comes from the per-category counts, not from a one-partition window over rows
    total = out.agg(F.sum("n").alias("__total")).withColumn("__one", F.lit(1))
    out = out.withColumn("__one", F.lit(1)).join(total, "__one")
    out = out.withColumn("percent", F.round(F.col("n") / F.col("__total") * 100, 2)).drop("__one", "__total")
    if value:
        median = exact_quantiles(df, by, value, {"median_value": 0.5})
        out = null_safe_join(out, median, by, "left").withColumn("median_value", F.round("median_value", 1))
    return out


def cohort_profile(tables: Mapping[str, DataFrame], ids: Mapping[str, str]) -> DataFrame:
    """Per table: rows and distinct ids; ``ids`` maps output names to id columns (NULL if absent)."""
    parts = []
    for name, df in tables.items():
        counts = [
            (F.countDistinct(col) if col in df.columns else F.lit(None).cast("bigint")).alias(out)
            for out, col in ids.items()
        ]
        parts.append(df.agg(F.count(F.lit(1)).alias("total_rows"), *counts).select(
            F.lit(name).alias("table_name"), "total_rows", *ids
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def id_overlaps(tables: Mapping[str, DataFrame], ids: str) -> DataFrame:
    """Per pair of tables (a table with itself included): distinct ids that both hold; NULL is no id.

    Every id gets a bit per table that holds it. Bits of one id merge in the tasks and once more by id, so all tables are read once
    and their distinct ids are shuffled once, for any number of pairs; what is left is one count per combination of tables.
    """
    if len(tables) > 63:
        raise ValueError("at most 63 tables")
    marked = [df.filter(F.col(ids).isNotNull()).select(F.col(ids).alias("id"), F.lit(1 << k).alias("bits")) for k, df in enumerate(tables.values())]
    held = reduce(DataFrame.union, marked).groupBy("id").agg(F.bit_or("bits").alias("bits"))
    combinations = held.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    names = list(tables)
    pairs = F.array(*[
        F.struct(F.lit(a).alias("table_a"), F.lit(b).alias("table_b"), F.lit(1 << i | 1 << j).alias("both"))
        for i, a in enumerate(names) for j, b in enumerate(names) if i <= j
    ])
    totals = combinations.select("bits", "n", F.inline(pairs)).groupBy("table_a", "table_b")
    return totals.agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("both")) == F.col("both"), F.col("n")).otherwise(0)).alias("n_ids"))


def version_delta(old: DataFrame, new: DataFrame, category: str) -> DataFrame:
    """Rows per category in two versions; the delta is NULL where the new version has none."""
    a = old.groupBy(category).agg(F.count(F.lit(1)).alias("old_n"))
    b = new.groupBy(category).agg(F.count(F.lit(1)).alias("new_n"))
    both = a.join(b, category, "full")
    return both.withColumn("delta", F.col("new_n") - F.coalesce(F.col("old_n"), F.lit(0)))


def missingness_compare(raw: DataFrame, imputed: DataFrame, category: str, value: str) -> DataFrame:
    """Rows and percent NULL per category, raw against imputed."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(category).agg(
            F.count(F.lit(1)).alias(f"{tag}_n"),
            F.round(F.count(F.when(F.col(value).isNull(), 1)) * 100.0 / F.count(F.lit(1)), 2).alias(f"{tag}_null_pct"),
        )

    return side(raw, "raw").join(side(imputed, "imputed"), category, "full")


def value_distributions(versions: Mapping[str, DataFrame], category: str, value: str) -> DataFrame:
    """Rows per category and value for several versions, stacked with a version tag."""
    parts = [
        df.filter(F.col(value).isNotNull()).groupBy(category, value).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("version", F.lit(tag))
        for tag, df in versions.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
