"""Mapping joins, outer joins, look-back and as-of joins, cohort joins.

No join is hinted: small sides are broadcast by Catalyst or AQE when their measured size is under
the session threshold, and fall back to a shuffled join beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import similarity
from chartloom.operators import scans
from chartloom.operators.keys import all_of, last_per_key, null_safe_join

# ---- fixed values ----
MAPPER_EXCLUDED_LABELS = ["NO MAPPING", "UNSURE", "MAPPED ELSEWHERE", "ALREADY MAPPED", "NOT AVAILABLE"]
NO_MAPPING = "NO MAPPING"
# ---- end of fixed values ----


def value_map(
    mapping: DataFrame,
    key: str,
    value: str,
    *,
    order: str | None = None,
    decision: str | None = "decision",
    excluded_labels: Sequence[str] = tuple(MAPPER_EXCLUDED_LABELS),
    excluded_items: Sequence = (),
    item: str = "itemid",
) -> DataFrame:
    """Key → value lookup with one row per key (last one in ``order`` wins), columns key / value."""
    if excluded_items and item in mapping.columns:
        mapping = mapping.filter(~F.coalesce(F.col(item).isin(list(excluded_items)), F.lit(False)))
    if decision and decision in mapping.columns:
        mapping = mapping.filter(~F.coalesce(F.col(decision).isin(list(excluded_labels)), F.lit(False)))
    order = order or ("_ordinal" if "_ordinal" in mapping.columns else value)
    rows = mapping.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.nullif(F.col(value), F.lit(NO_MAPPING)).alias("value"), F.col(order).alias("_order")
    )
    return last_per_key(rows, ["key"], "_order").drop("_order")


def dict_map(df: DataFrame, lookup: DataFrame, on: str | Column, into: str) -> DataFrame:
    """Add ``into`` by looking ``on`` up; unmatched keys give NULL."""
    on = F.col(on) if isinstance(on, str) else on
    right = lookup.select(F.col("key").alias("__key"), F.col("value").alias(into))
    return df.join(right, on == F.col("__key"), "left").drop("__key")


def dict_map_default(df: DataFrame, lookup: DataFrame, on: str, into: str, null_value: str) -> DataFrame:
    """As ``dict_map``, with an explicit value for a NULL key."""
    mapped = dict_map(df, lookup, on, into)
    return mapped.withColumn(into, F.when(F.col(on).isNull(), F.lit(null_value)).otherwise(F.col(into)))


def strict_dict_map(df: DataFrame, lookup: DataFrame, on: str, into: str) -> DataFrame:
    """Map the trimmed key; an unknown non-NULL key fails the job."""
    right = lookup.select(
        F.col("key").alias("__key"), F.col("value").alias("__value"), F.lit(True).alias("__known")
    )
    joined = df.join(right, F.trim(F.col(on)) == F.col("__key"), "left")
    problem = F.concat(F.lit(f"unknown value in {on}: "), F.col(on))
    out = F.when(F.col(on).isNotNull() & F.col("__known").isNull(), F.raise_error(problem)).otherwise(F.col("__value"))
    return joined.withColumn(into, out).drop("__key", "__value", "__known")


def left_join_filtered_dim(df: DataFrame, dim: DataFrame, on: str | Sequence[str], keep: Column) -> DataFrame:
    """LEFT JOIN whose filter belongs to the ON clause: rows without a kept match stay."""
    return df.join(dim.filter(keep), on, "left")


def two_step_null_safe_lookup(
    df: DataFrame,
    general: DataFrame,
    special: DataFrame,
    keys: Sequence[str],
    value: str,
    general_only: Column,
    special_keys: Sequence[str],
    special_when: Column,
) -> DataFrame:
    """Null-safe lookup on several keys with a per-item fallback; the first answer wins.

    Both lookups are reduced to one row per key first, so the row count cannot change; a key with different answers fails the job.
    """

    def only(lookup: DataFrame, on: Sequence[str], into: str) -> DataFrame:
        problem = F.raise_error(F.concat(F.lit(f"ambiguous {value}: "), F.array_join(F.sort_array(F.collect_set(value)), " / ")))
        answer = F.when(F.count_distinct(value) > 1, problem.cast(lookup.schema[value].dataType)).otherwise(F.max(value))
        return lookup.groupBy(*on).agg(answer.alias(into))

    g, s = only(general.filter(general_only), list(keys), "__general"), only(special, list(special_keys), "__special")
    out = null_safe_join(df, g, list(keys), "left")
    out = null_safe_join(out, s, list(special_keys), "left")
    fallback = F.when(special_when, F.col("__special"))
    return out.withColumn(value, F.coalesce(F.col("__general"), fallback)).drop("__general", "__special")


def inner_join_dim(events: DataFrame, dim: DataFrame, on: str, not_null: Sequence[str]) -> DataFrame:
    """Mapped events only, with the listed columns present."""
    return events.filter(all_of([F.col(c).isNotNull() for c in not_null])).join(dim, on)


def left_join_trim_key(df: DataFrame, dim: DataFrame, on: Sequence[str], text: str) -> DataFrame:
    """LEFT JOIN on ids plus trimmed text; the dimension's key columns are not kept."""
    right = dim.withColumn("__text", F.trim(F.col(text))).drop(text)
    left = df.withColumn("__text", F.trim(F.col(text)))
    return left.join(right, [*on, "__text"], "left").drop("__text")


def full_outer_coalesce(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN with merged keys; NULL keys never match."""
    return left.join(right, list(on), "full")


def full_outer_chain(frames: Sequence[DataFrame], on: str, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """FULL OUTER JOIN of several one-row-per-key frames, then column defaults."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, on, "full")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN in which NULL keys match each other."""
    return null_safe_join(left, right, on, "full")


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    hours: float = 6,
    suffix: str = "_prev",
    chunk_rows: int = scans.CHUNK_ROWS,
) -> DataFrame:
    """Values of the previous row of the same key, if it is less than ``hours`` old.

    A NULL key never has a previous row.
    """
    time = order[0]
    prior = F.struct(F.col(time).alias("__at"), *[F.col(v) for v in values])
    out = scans.running(df, keys, order, {"__prior": scans.lag(prior)}, chunk_rows)
    age = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("__prior.__at").cast("timestamp"))
    fresh = all_of([F.col(k).isNotNull() for k in keys]) & (age < int(hours * 3_600_000_000))
    return out.withColumns({f"{v}{suffix}": F.when(fresh, F.col(f"__prior.{v}")) for v in values}).drop("__prior")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    right_order: Sequence[str] = (),
    how: str = "inner",
    chunk_rows: int = scans.CHUNK_ROWS,
) -> DataFrame:
    """For each left row the latest right row of the same key at or before it.

    ``how="inner"`` drops left rows without one, ``"left"`` keeps them. Right rows at one instant
    are told apart by ``right_order`` (the largest wins). Both sides are stacked and the right row
    is carried forward, so the work is one shuffle whatever the number of matches per key.
    """
    payload = [c for c in right.columns if c not in keys]
    l = left.filter(all_of([F.col(k).isNotNull() for k in keys])) if how == "inner" else left
    l = l.select(
        *keys, F.col(left_time).alias("__time"), F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__left"),
    )
    r = right.filter(all_of([F.col(k).isNotNull() for k in [*keys, right_time]])).select(
        *keys, F.col(right_time).alias("__time"), F.lit(0).alias("__side"),
        F.struct(*[F.col(c) for c in payload]).alias("__right"),
        *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(right_order)],
    )
    both = l.unionByName(r, allowMissingColumns=True)
    order = ["__time", "__side", *[f"__tie{i}" for i in range(len(right_order))]]
    out = scans.running(both, keys, order, {"__match": scans.last_so_far("__right")}, chunk_rows)
    out = out.filter(F.col("__side") == 1)
    if how == "inner":
        out = out.filter(F.col("__match").isNotNull())
    return out.select("__left.*", *[F.col(f"__match.{c}").alias(c) for c in payload])


def semi_join_cohort(df: DataFrame, cohort: DataFrame, on: str) -> DataFrame:
    """Rows whose id is in the cohort."""
    return df.join(cohort.select(on), on, "left_semi")


def right_join_cohort(df: DataFrame, cohort: DataFrame, left_id: str, cohort_id: str) -> DataFrame:
    """Every id of an external list, with the matching rows where there are any.

    Written as matches plus unmatched ids: a RIGHT JOIN would have to shuffle the large side even
    for a short list, and could not split a hot id.
    """
    ids = cohort.select(F.col(cohort_id).alias("__id"))
    matched = df.join(ids, F.col(left_id) == F.col("__id"))
    seen = df.select(F.col(left_id).alias("__id")).join(ids, "__id", "left_semi").distinct()
    unmatched = ids.join(seen, "__id", "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True).withColumnRenamed("__id", cohort_id)


def replicate(df: DataFrame, suffixes: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """N copies of every row, told apart by an id suffix; no shuffle."""
    copies = df.withColumn("__suffix", F.explode(F.array(*[F.lit(s) for s in suffixes])))
    return copies.withColumns({c: F.concat(F.col(c).cast("string"), F.col("__suffix")) for c in id_cols}).drop(
        "__suffix"
    )


def fuzzy_match(
    df: DataFrame, name: str, categories: Sequence[str] | DataFrame, into: str = "category", min_score: float = 80.0
) -> DataFrame:
    """Nearest category of each distinct name by Levenshtein ratio, NULL under ``min_score``.

    Names are de-duplicated first. A list of categories is held as a literal, so no pairs are shuffled, and ``score`` is the best
    score of any category. For long vocabularies take a DataFrame (its first column): names meet only categories with which they
    share a segment, see ``fuzzy_candidates``; ``score`` is NULL where none reaches ``min_score``, and ``n_candidates`` is the number
    of categories that were compared. Equal scores go to the alphabetically first category.
    """
    names = df.select(name).where(F.col(name).isNotNull()).distinct()
    if isinstance(categories, DataFrame):
        vocabulary = categories.select(F.col(categories.columns[0]).alias("__c")).where(F.col("__c").isNotNull()).distinct()
        pairs = fuzzy_candidates(names, name, vocabulary, "__c", min_score).withColumn("__s", similarity(F.col(name), F.col("__c")))
        close = F.when(F.col("__s") >= min_score, F.struct((-F.col("__s")).alias("s"), F.col("__c").alias("c")))
        best = pairs.groupBy(name).agg(F.min(close).alias("__b"), F.count(F.lit(1)).alias("n_candidates"))
        return names.join(best, name, "left").select(
            name, F.col("__b.c").alias(into), (-F.col("__b.s")).alias("score"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates")
        )
    choices = F.array(*[F.lit(c) for c in sorted(set(categories), reverse=True)])
    scored = F.transform(
        choices, lambda c, i: F.struct(similarity(F.col(name), c).alias("score"), i.alias("i"), c.alias("c"))
    )
    best = F.array_max(scored)
    return names.withColumn("__best", best).select(
        name,
        F.when(F.col("__best.score") >= min_score, F.col("__best.c")).alias(into),
        F.col("__best.score").alias("score"),
    )


def fuzzy_candidates(names: DataFrame, name: str, categories: DataFrame, category: str, min_score: float) -> DataFrame:
    """Pairs of a name and a category among which are all that reach ``min_score``.

    A score allows ``d`` edits between texts of given lengths. A category is cut into d + 1 segments; d edits leave one of them as it
    is, moved by d places at most. Categories are indexed by their segments and the length of the name looked for, and names look up
    their substrings of the lengths such segments have: a join on text and length, whatever the number of categories. Texts so
    short that they have no d + 1 segments are joined on their lengths.
    """
    share = min_score / 100
    edits = lambda longest: F.floor(F.lit(1 - share) * longest + F.lit(1e-9)).cast("int")
    low = lambda n: F.ceil(n * F.lit(share) - F.lit(1e-9)).cast("int")
    high = lambda n: F.floor(n / F.lit(max(share, 0.01)) + F.lit(1e-9)).cast("int")

    index = categories.select(F.col(category).alias("__c"), F.lower(category).alias("__t")).withColumn("__n", F.length("__t"))
    index = index.withColumn("__l", F.explode(F.sequence(low(F.col("__n")), high(F.col("__n")))))
    index = index.withColumn("__d", edits(F.greatest("__n", "__l"))).withColumn("__w", F.floor(F.col("__n") / (F.col("__d") + 1)).cast("int"))
    texts = names.select(F.col(name), F.lower(name).alias("__q")).withColumn("__l", F.length("__q"))

    short = index.filter("__w < 1").select("__c", "__l")
    by_length = texts.join(short, "__l").select(name, "__c")

    # d + 1 segments of width w or w + 1, the wider ones last
    first_wide = F.col("__d") + 1 - (F.col("__n") - F.col("__w") * (F.col("__d") + 1))

    def segment(i: Column) -> Column:
        extra = F.greatest(i - first_wide, F.lit(0))
        width = F.col("__w") + F.when(i >= first_wide, 1).otherwise(0)
        at = i * F.col("__w") + extra
        return F.struct(at.alias("at"), F.substr(F.col("__t"), at + 1, width).alias("s"))

    cut = index.filter("__w >= 1").select("__c", "__l", "__d", F.inline(F.transform(F.sequence(F.lit(0), F.col("__d")), segment)))
    widths = cut.groupBy("__l").agg(F.collect_set(F.length("s")).alias("__ws"))  # a few lengths per length of name
    starts = F.sequence(F.lit(0), F.col("__l") - F.col("w"))
    probes = texts.join(widths, "__l").select(name, "__l", "__q", F.explode("__ws").alias("w")).filter("w <= __l")
    probes = probes.select(name, "__l", F.inline(F.transform(starts, lambda k: F.struct(k.alias("k"), F.substr(F.col("__q"), k + 1, F.col("w")).alias("s")))))
    by_segment = probes.join(cut, ["__l", "s"]).filter(F.abs(F.col("k") - F.col("at")) <= F.col("__d")).select(name, "__c")
    return by_segment.unionByName(by_length).distinct().withColumnRenamed("__c", category)
