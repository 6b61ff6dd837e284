"""Mixing sources to target weights: repetition rates per source, whole copies plus one hash-seeded Bernoulli copy.

Tokens are aggregated per source. Targets are shares of all tokens by weight, at most ``max_rate`` times what a source holds; the
excess is shared again by weight among the others. With the rate of its source, a document is emitted floor(rate) times, and once
more if a hash of seed and id falls below the fraction: the decision depends on nothing else, so reruns and retries agree.

The water level has a closed form: sources in order of (cap / weight) reach their cap one after another, so a source is capped
exactly if the level shared by it and all later ones would lift it above its cap. One row per source goes through that ordered
window, never a document row. The level is a quotient of integers, so the rates do not depend on the order of summation.

Defined cases: a NULL text has size 0; NULL is a source of its own, ranked last; a source without tokens has target and rate 0,
so its documents are not emitted; repeated rows share one decision; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chartloom.llm.common import WORD, quoted, text_of, unused

MAX_RATE = 3
SEED = "mix-1"


def n_words(text_col: str) -> Column:
    return F.expr(f"regexp_count(coalesce(cast(`{text_col}` as string), ''), '{WORD.replace(chr(92), chr(92) * 2)}')").cast("long")


def rotating_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1..cycle, repeating over the sources by code point, NULL last; in: source, out: source, weight."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))


def targets(sizes: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """``source, source_size, weight`` → plus ``target`` and ``rate``; integer weights."""
    big = "decimal(38,0)"
    t = sizes.withColumns({"cap": (F.col("source_size") * max_rate).cast(big), "w": F.col("weight").cast(big)})
    order = W.orderBy((F.col("cap") / F.col("w")).cast("double"), F.col("source").asc_nulls_last())
    t = t.withColumns({
        "total": F.sum("source_size").over(W.partitionBy()).cast(big),
        "before": F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast(big),
        "rest": F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)).cast(big),
    })
    t = t.withColumn("capped", (F.col("total") - F.col("before")) * F.col("w") > F.col("cap") * F.col("rest"))
    level = W.partitionBy()
    free = t.withColumns({
        "left": F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(level), F.lit(0)),
        "open": F.sum(F.when(~F.col("capped"), F.col("w"))).over(level),
    })
    share = (F.col("w") * F.col("left")).cast("double") / F.col("open").cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    out = free.withColumn("target", target)
    rate = F.when(F.col("source_size") == 0, 0.0).otherwise(F.col("target") / F.col("source_size").cast("double"))
    return out.select("source", "source_size", "weight", "target", rate.alias("rate"))


def draw(seed: str, id_col: Column) -> Column:
    """A uniform number in [0, 1) of seed and id: 52 bits of a SHA-256 digest."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def rates_of(docs: DataFrame, text_col: str, source_col: str, weights: DataFrame | None, max_rate: int) -> DataFrame:
    sizes = docs.groupBy(quoted(source_col).alias("source")).agg(F.sum(n_words(text_col)).alias("source_size"))
    if weights is None:
        return targets(rotating_weights(sizes), max_rate)
    own = weights.select(F.col("source").alias("__source"), "weight")
    named = sizes.join(own, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    return targets(named.withColumn("weight", F.coalesce("weight", F.lit(0))).filter("weight > 0"), max_rate)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: DataFrame | None = None, max_rate: int = MAX_RATE, seed: str = SEED,
) -> DataFrame:
    """Decisions: id, size, source, source_size, target, rate, copies, taken.

    ``weights`` (source, weight; positive integers): sources it does not name are not taken (no row). None: 1, 2, 3 repeating.
    """
    rates = rates_of(docs, text_col, source_col, weights, max_rate).withColumnRenamed("source", "__source")
    rows = docs.select(quoted(id_col).alias("id"), quoted(source_col).alias("source"), n_words(text_col).alias("size"))
    copies = F.floor("rate") + (draw(seed, F.col("id")) < F.col("rate") - F.floor("rate")).cast("long")
    return (
        rows.join(rates, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("copies", copies)
        .select("id", "size", "source", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def emit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: DataFrame | None = None, max_rate: int = MAX_RATE, seed: str = SEED,
) -> DataFrame:
    """The mixture itself: each document as many times as decided, with its own columns."""
    source, rate, copy = (unused(docs, c) for c in ("__source", "__rate", "__copy"))
    rates = rates_of(docs, text_col, source_col, weights, max_rate).select(F.col("source").alias(source), F.col("rate").alias(rate))
    whole = F.floor(rate)
    copies = whole + (draw(seed, quoted(id_col)) < F.col(rate) - whole).cast("long")
    return (
        docs.join(rates, quoted(source_col).eqNullSafe(F.col(source)))
        .withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(*[quoted(c) for c in docs.columns])
    )
