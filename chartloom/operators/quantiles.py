"""Exact interpolated quantiles by radix selection, without holding a group in memory.

``percentile``/``median`` keep every distinct value of a group in one buffer. Here values become whole numbers in the same order (the
bits of the double), which are read in three digits from the top:

1. rows are counted by group and first digit, folded in every task before anything is shuffled; running sums over the digits tell
   which of them hold the wanted positions, for all quantiles together;
2. only rows under those digits are counted by their next digit, in the same way; then those under the digits found there by the last.

A digit whose rows all have one value needs no further level, so columns with few values are done after the first. No row is
repeated for any quantile. A value that fills a group is one counter. Infinities and NaN (the largest value) are values like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.operators.keys import with_null_free_keys

#: Bits below each digit: the first has sign, exponent and eight bits of the fraction, the others 22 bits each.
BELOW = (44, 22, 0)


def with_ordered_bits(df: DataFrame, value: str, into: str) -> DataFrame:
    """Adds a whole number per double, in the same order: exponent and fraction, negated for negative values; -0.0 is 0.0.

    Step by step, so that no step repeats the one before; the result is never NULL, so joins on its digits add no filter.
    """
    v, size, plain, ratio, exponent = F.col(value), F.col("__size"), F.col("__plain"), F.col("__ratio"), F.col("__exponent")
    df = df.withColumn("__size", F.abs(v))
    df = df.withColumn("__plain", (size >= 2.0**-1022) & (size < float("inf")))
    df = df.withColumn("__exponent", F.when(plain, F.least(F.floor(F.log2(size)), F.lit(1023))).otherwise(0))
    # exact: division by a power of two; the logarithm may have rounded over one
    df = df.withColumn("__ratio", F.when(plain, size / F.pow(F.lit(2.0), exponent)).otherwise(1.0))
    df = df.withColumn("__exponent", exponent + F.when(ratio >= 2, 1).when(ratio < 1, -1).otherwise(0))
    df = df.withColumn("__ratio", ratio * F.when(ratio >= 2, 0.5).when(ratio < 1, 2.0).otherwise(1.0))
    bits = (
        F.when(plain, (exponent + 1023) * F.lit(1 << 52) + ((ratio - 1) * float(1 << 52)).cast("long"))
        .when(F.isnan(v), F.lit(2047 * (1 << 52) + 1))
        .when(size == float("inf"), F.lit(2047 * (1 << 52)))
        .otherwise((size * 2.0**537 * 2.0**537).cast("long"))
    )
    df = df.withColumn("__bits", F.coalesce(bits, F.lit(0)))
    signed = F.when((v < 0) & ~F.isnan(v), -F.col("__bits")).otherwise(F.col("__bits"))
    kept = [c for c in df.columns if c not in ("__size", "__plain", "__exponent", "__ratio", "__bits")]
    return df.select(*kept, signed.alias(into))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row per key with a column per named quantile (linear interpolation, NULLs ignored).

    Groups without any value do not appear.
    """
    keys, probs = list(keys), list(quantiles.values())
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    rows, on = with_null_free_keys(rows, keys)
    kept = [k for k in keys if k not in on]
    rows = with_ordered_bits(rows.select(*on, "__v"), "__v", "__bits")

    def wanted(n: Column) -> Column:
        """The zero-based ranks on both sides of every position."""
        at = [(n - 1) * F.lit(float(p)) for p in probs]
        return F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)])

    found, digits, start = None, [], F.lit(0)
    for level, below in enumerate(BELOW):
        digit = f"__d{level}"
        rows = rows.withColumn(digit, F.shiftright("__bits", below))
        counted = rows.groupBy(*on, *digits, digit, *(["__n", "__start"] if level else [])).agg(
            F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
        group = W.partitionBy(*on, *digits)
        if level == 0:
            counted = counted.withColumn("__n", F.sum("__c").over(group)).withColumn("__start", F.lit(0).cast("long"))
        upto = group.orderBy(digit).rowsBetween(W.unboundedPreceding, W.currentRow)
        counted = counted.withColumn("__to", F.col("__start") + F.sum("__c").over(upto))
        counted = counted.withColumn("__from", F.col("__to") - F.col("__c"))
        digits = [*digits, digit]
        held = F.exists(wanted(F.col("__n")), lambda at: (at >= F.col("__from")) & (at < F.col("__to")))
        hit = counted.filter(held).select(*on, *digits, "__n", "__from", "__to", "__lo", "__hi")
        single = F.col("__lo") == F.col("__hi") if below else F.lit(True)
        done = hit.filter(single).select(*on, "__n", "__from", "__to", F.col("__lo").alias("__x"))
        found = done if found is None else found.unionByName(done)
        if below:
            deeper = hit.filter(~single).select(*on, *digits, "__n", F.col("__from").alias("__start"))
            rows = rows.drop("__n", "__start")
            # without keys there are two digits per quantile at most: the only side that is broadcast by hint
            rows = rows.join(deeper if on else F.broadcast(deeper), [*on, *digits])

    def at(pos: Column) -> Column:
        # zero-based rank p belongs to the value whose count range holds it
        return F.max(F.when((F.col("__from") <= pos) & (pos < F.col("__to")), F.col("__x")))

    picks, results = [], []
    for i, (name, p) in enumerate(quantiles.items()):
        pos = (F.col("__n") - 1) * F.lit(float(p))
        a, b, w = F.col(f"__a{i}"), F.col(f"__b{i}"), pos - F.floor(pos)
        picks += [at(F.floor(pos)).alias(f"__a{i}"), at(F.ceil(pos)).alias(f"__b{i}")]
        results.append(F.when((w == 0) | (a == b), a).otherwise(a * (1 - w) + b * w).alias(name))
    picked = found.groupBy(*on, "__n").agg(*picks)
    back = [F.when(~F.col(f"__null{i}"), F.col(f"__key{i}")).alias(k) if k in kept else F.col(k) for i, k in enumerate(keys)]
    return picked.select(*back, *results)
