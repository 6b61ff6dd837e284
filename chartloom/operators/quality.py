"""Data-quality checks over built tables.

Each check returns a violations frame (table, check, column, value, n); ``failure_cases`` stacks
the checks of a declared schema into one report.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.operators.keys import all_of, null_safe_join

REPORT = ["table", "check", "column", "value", "n"]


def _report(df: DataFrame, table: str, check: str, column: Column | str, value: Column, n: Column) -> DataFrame:
    column = F.lit(column) if isinstance(column, str) else column
    return df.select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), column.alias("column"),
        value.cast("string").alias("value"), n.cast("bigint").alias("n"),
    )


def check_schema(df: DataFrame, table: str, schema: T.StructType, strict: bool = True, count: bool = False) -> DataFrame:
    """Missing, unexpected and differently typed columns, from the schemas alone.

    ``count`` asks for the number of rows concerned as ``n`` (NULL otherwise), which computes the table.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    problems = [("missing", c, t) for c, t in wanted.items() if c not in actual]
    problems += [("type", c, actual[c]) for c, t in wanted.items() if c in actual and actual[c] != t]
    if strict:
        problems += [("unexpected", c, t) for c, t in actual.items() if c not in wanted]
    found = F.array(*[
        F.struct(F.lit(f"schema_{kind}").alias("check"), F.lit(c).alias("column"), F.lit(t).alias("value"))
        for kind, c, t in problems or [("none", "", "")]
    ])
    one = df.agg(F.count(F.lit(1)).alias("n")) if count and problems else df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("n"))
    rows = one.select("n", F.explode(found).alias("p"))
    return rows.select(F.lit(table).alias("table"), "p.check", "p.column", "p.value", "n").filter(
        F.col("check") != "schema_none"
    )


def check_not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """NULL counts of required columns, one pass for all of them."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = counts.unpivot([], list(cols), "column", "n").filter(F.col("n") > 0)
    return _report(long, table, "not_null", F.col("column"), F.lit(None), F.col("n"))


def check_isin(df: DataFrame, table: str, col: str, allowed: Sequence | DataFrame) -> DataFrame:
    """Values outside the permitted set (NULL is not checked here)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if isinstance(allowed, DataFrame):
        bad = counts.join(allowed.select(F.col(allowed.columns[0]).alias(col)), col, "left_anti")
    else:
        bad = counts.filter(~F.col(col).isin(list(allowed)))
    return _report(bad, table, "isin", col, F.col(col), F.col("n"))


def check_range(df: DataFrame, table: str, col: str, low: float, high: float) -> DataFrame:
    bad = df.filter(~F.col(col).between(low, high)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return _report(bad, table, "range", col, F.col(col), F.col("n"))


def check_all_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "n")
    return _report(counts.filter(F.col("n") > 0), table, "all_null", F.col("column"), F.lit(None), F.col("n"))


def check_unique_values_eq(df: DataFrame, table: str, col: str, expected: DataFrame | Sequence) -> DataFrame:
    """Values seen but not expected, and values expected but never seen (n = 0)."""
    seen = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if not isinstance(expected, DataFrame):
        words = F.array(*[F.lit(str(v)) for v in expected])
        expected = df.sparkSession.range(1).select(F.explode(words).alias("v"))
    else:
        expected = expected.select(F.col(expected.columns[0]).cast("string").alias("v"))
    both = seen.join(expected.distinct().withColumn("ok", F.lit(True)), "v", "full")
    bad = both.filter(F.col("ok").isNull() | F.col("n").isNull())
    return _report(bad, table, "unique_values_eq", col, F.col("v"), F.coalesce(F.col("n"), F.lit(0)))


def check_unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    value = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return _report(bad, table, "unique_key", "|".join(keys), value, F.col("n"))


def check_row_count_preserved(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """A violation when a lookup changed the number of rows."""
    b = before.agg(F.count(F.lit(1)).alias("before")).withColumn("one", F.lit(1))
    a = after.agg(F.count(F.lit(1)).alias("after")).withColumn("one", F.lit(1))
    bad = b.join(a, "one").filter(F.col("before") != F.col("after"))
    return _report(
        bad, table, "row_count_preserved", "*", F.concat_ws("->", "before", "after"), F.col("after") - F.col("before")
    )


def check_all_value_null_rows(df: DataFrame, table: str, names: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows without any name and without any value."""
    bad = df.filter(all_of([F.col(c).isNull() for c in [*names, *values]])).agg(F.count(F.lit(1)).alias("n"))
    return _report(bad.filter(F.col("n") > 0), table, "all_value_null_rows", "*", F.lit(None), F.col("n"))


def check_mapping_ambiguity(mapping: DataFrame, table: str, key: str, category: str) -> DataFrame:
    """Dictionary keys that map to more than one category."""
    bad = mapping.groupBy(key).agg(F.countDistinct(category).alias("n")).filter(F.col("n") > 1)
    return _report(bad, table, "mapping_ambiguity", key, F.col(key), F.col("n"))


def check_castable(df: DataFrame, table: str, col: str, to: str) -> DataFrame:
    """Values that are present but do not read as the wanted type, which the tables then show as NULL."""
    bad = df.filter(F.col(col).isNotNull() & F.col(col).cast("string").try_cast(to).isNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return _report(bad, table, f"castable_{to}", col, F.col(col), F.col("n"))


def check_known_items(items: DataFrame, dictionary: DataFrame, table: str, item: str = "itemid", links: str = "linksto") -> DataFrame:
    """Wanted items that the dictionary does not have or does not link to an event table: they have no events in any table."""
    known = dictionary.select(F.col(item).alias("__i"), F.col(links).isNotNull().alias("linked")).groupBy("__i").agg(F.max("linked").alias("linked"))
    wanted = items.filter(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    bad = wanted.join(known, F.col(item) == F.col("__i"), "left").filter(~F.coalesce("linked", F.lit(False)))
    return _report(bad, table, "known_items", item, F.col(item), F.col("n"))


def check_conflicting_cells(df: DataFrame, table: str, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """Cells of a pivot (keys, name) with more than one different value; ``n`` is the number of values."""
    bad = df.groupBy(*keys, name).agg(F.count_distinct(value).alias("n")).filter(F.col("n") > 1)
    cell = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in [*keys, name]])
    return _report(bad, table, "conflicting_cells", value, cell, F.col("n"))


def failing_rows(df: DataFrame, violations: DataFrame, col: str) -> DataFrame:
    """The offending rows behind value-level violations of one column."""
    bad = violations.filter(F.col("column") == col).select(F.col("value").alias("__v")).distinct()
    return null_safe_join(df.withColumn("__v", F.col(col).cast("string")), bad, ["__v"], "left_semi").drop("__v")


@dataclass(frozen=True)
class TableRules:
    """Declared constraints of one output table."""

    schema: T.StructType
    strict: bool = True
    required: Sequence[str] = ()
    isin: Mapping[str, Sequence | DataFrame] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    all_null: Sequence[str] = ()
    values_eq: Mapping[str, Sequence | DataFrame] = field(default_factory=dict)


def failure_cases(df: DataFrame, table: str, rules: TableRules) -> DataFrame:
    """All violations of a table's rules in one frame; nothing stops at the first failure.

    Rules on single cells share one pass: each row yields its violating cells, which are counted. Only value sets given as a
    DataFrame, and sets that must be seen as a whole, read the table again.
    """
    have = set(df.columns)
    parts = [check_schema(df, table, rules.schema, rules.strict)]
    nothing = F.lit(None).cast("string")

    def cell(bad: Column, check: str, c: str, value: Column) -> Column:
        return F.when(bad, F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), value.alias("value")))

    text = {c: F.col(c).cast("string") for c in have}
    cells = [cell(F.col(c).isNull(), "not_null", c, nothing) for c in rules.required if c in have]
    cells += [cell(F.col(c).isNotNull(), "all_null", c, nothing) for c in rules.all_null if c in have]
    cells += [
        cell(~F.col(c).isin(list(v)), "isin", c, text[c]) for c, v in rules.isin.items() if c in have and not isinstance(v, DataFrame)
    ]
    cells += [cell(~F.col(c).between(lo, hi), "range", c, text[c]) for c, (lo, hi) in rules.ranges.items() if c in have]
    if cells:
        bad = df.select(F.explode(F.array_compact(F.array(*cells))).alias("p")).groupBy("p.check", "p.column", "p.value")
        counted = bad.agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(F.lit(table).alias("table"), "check", "column", "value", "n"))
    parts += [check_isin(df, table, c, v) for c, v in rules.isin.items() if c in have and isinstance(v, DataFrame)]
    parts += [check_unique_values_eq(df, table, c, v) for c, v in rules.values_eq.items() if c in have]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Metric:
    """One rule as two aggregates: how many rows break it, and the least offending value."""

    name: str
    check: str
    column: str
    count: Column
    example: Column
    missing: bool = False  # a violation if the count is zero

    def columns(self) -> list[Column]:
        return [self.count.alias(f"{self.name}_n"), self.example.alias(f"{self.name}_v")]


def observed_rules(df: DataFrame, rules: TableRules) -> list[Metric]:
    """The rules on cells as aggregates of fixed size, for ``Dataset.observe`` while the table is written.

    Value sets are lists here (``rules_for`` reads them from their vocabularies).
    """
    have, out = set(df.columns), []

    def add(check: str, c: str, bad: Column, value: Column | None = None, missing: bool = False) -> None:
        text = F.lit(None).cast("string") if value is None else value.cast("string")
        out.append(Metric(f"m{len(out)}", check, c, F.count_if(bad), F.min(text if missing else F.when(bad, text)), missing))

    def listed(values: Sequence | DataFrame, c: str) -> list:
        if isinstance(values, DataFrame):
            raise TypeError(f"{c}: permitted values must be a list here, see rules_for")
        return list(values)

    for c in rules.required:
        if c in have:
            add("not_null", c, F.col(c).isNull())
    for c in rules.all_null:
        if c in have:
            add("all_null", c, F.col(c).isNotNull())
    for c, values in rules.isin.items():
        if c in have:
            add("isin", c, F.col(c).isNotNull() & ~F.col(c).isin(listed(values, c)), F.col(c))
    for c, (low, high) in rules.ranges.items():
        if c in have:
            add("range", c, ~F.col(c).between(low, high), F.col(c))
    for c, values in rules.values_eq.items():
        if c in have:
            add("unique_values_eq", c, F.col(c).isNotNull() & ~F.col(c).cast("string").isin([str(v) for v in listed(values, c)]), F.col(c))
            for v in values:
                add("value_missing", c, F.col(c).cast("string") == str(v), F.lit(str(v)), missing=True)
    return out


def report_of(df: DataFrame, table: str, rules: TableRules, metrics: Sequence[Metric], found: Mapping) -> list[tuple]:
    """Violations (table, check, column, example, n) from observed aggregates and from the schemas."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in rules.schema}
    rows = [(table, "schema_missing", c, t, None) for c, t in wanted.items() if c not in actual]
    rows += [(table, "schema_type", c, actual[c], None) for c, t in wanted.items() if c in actual and actual[c] != t]
    if rules.strict:
        rows += [(table, "schema_unexpected", c, t, None) for c, t in actual.items() if c not in wanted]
    for m in metrics:
        n, example = found[f"{m.name}_n"], found[f"{m.name}_v"]
        if m.missing and n == 0:
            rows.append((table, m.check, m.column, example, 0))
        elif not m.missing and n > 0:
            rows.append((table, m.check, m.column, example, n))
    return rows


class RowCountChanged(AssertionError):
    """A step that must keep its rows has changed their number."""


class RowGuard:
    """Row counts on both sides of steps that must keep them, collected while the result is computed.

    Counts of a retried task can be too high, so a difference is confirmed by counting before it is an error.
    """

    def __init__(self) -> None:
        self._open: list[tuple[str, DataFrame, DataFrame, Observation, Observation]] = []

    def keep(self, name: str, before: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``step(before)``, whose rows will be compared with those of ``before``."""
        first, last, one = Observation(), Observation(), F.count(F.lit(1)).alias("n")
        after = step(before.observe(first, one))
        self._open.append((name, before, step(before), first, last))
        return after.observe(last, one)

    def confirm(self) -> dict[str, int]:
        """To be called when the result has been written: rows per step; raises ``RowCountChanged``."""
        counts = {}
        for name, before, after, first, last in self._open:
            counts[name] = first.get["n"]
            if counts[name] != last.get["n"]:
                a, b = before.count(), after.count()
                if a != b:
                    raise RowCountChanged(f"{name}: {a} rows before, {b} after")
                counts[name] = a
        self._open.clear()
        return counts
