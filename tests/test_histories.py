"""Running columns, as-of joins, quantiles and de-duplication against brute force."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.operators import joins, scans, windows
from chartloom.operators.quantiles import exact_quantiles

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "id int, k string, t timestamp_ntz, v string, f boolean"


def history(seed: int, n: int = 400, hot: float = 0.5):
    """Rows with NULL keys, NULL values, ties and one key that holds half of everything."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < hot else rnd.choice(["a", "b", None])
        at = T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 6, 30))
        out.append((i, key, at, rnd.choice([None, "x", "y"]), rnd.random() < 0.05))
    return out


def grouped(data):
    by_key = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        by_key.setdefault(r[1], []).append(r)
    return by_key


@pytest.mark.parametrize("seed, chunk", [(1, 1), (2, 7), (3, 50), (4, 1_000_000)])
def test_running_matches_brute_force(spark, seed, chunk):
    data = history(seed)
    df = spark.createDataFrame(data, SCHEMA)
    out = scans.running(df, ["k"], ["t", "id"], {
        "last": scans.last_so_far("v"), "any": scans.any_so_far("f"), "n": scans.row_number(), "prev": scans.lag("v"),
    }, chunk)
    got = {r["id"]: (r["last"], r["any"], r["n"], r["prev"]) for r in out.collect()}
    want = {}
    for rows in grouped(data).values():
        last, seen, prev = None, False, None
        for n, r in enumerate(rows, 1):
            last, seen = r[3] if r[3] is not None else last, seen or r[4]
            want[r[0]] = (last, seen, n, prev)
            prev = r[3]
    assert got == want


def test_running_shuffles_rows_once(spark):
    """Wide rows pass one exchange; bounds and summaries are aggregates that are sent to all tasks."""
    df = spark.createDataFrame(history(5), SCHEMA).withColumn("wide", F.lit("w"))
    plan = scans.running(df, ["k"], ["t", "id"], {"n": scans.row_number()})._jdf.queryExecution().executedPlan().toString()
    nodes = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("__chunk" in n and "Partial" not in n for n in nodes) >= 1 and "SortMergeJoin" not in plan


def test_running_of_null_times_and_ties(spark):
    """NULL times come first; rows at one instant are told apart by the rest of the order, and may be cut anywhere."""
    rnd = random.Random(8)
    data = [(i, rnd.choice(["a", None]), rnd.choice([None, T0]), rnd.choice([None, "x", "y"]), False) for i in range(300)]
    got = scans.running(spark.createDataFrame(data, SCHEMA), ["k"], ["t", "id"], {"n": scans.row_number(), "v": scans.last_so_far("v")}, 5)
    got = {r["id"]: (r["n"], r["v"]) for r in got.collect()}
    for key in ("a", None):
        last = None
        rows = sorted((r for r in data if r[1] == key), key=lambda r: (r[2] is not None, r[0]))
        for n, r in enumerate(rows, 1):
            last = r[3] if r[3] is not None else last
            assert got[r[0]] == (n, last)


def test_instants_stay_whole(spark):
    """With ``whole`` rows of one instant share a range, and the result is grouped by instant without another shuffle."""
    df = spark.createDataFrame(history(9), SCHEMA)
    out = scans.running(df, ["k"], ["t", "id"], {"n": scans.row_number()}, 10, whole=1, keep_range=True)
    keys = scans.range_keys(out, ["k"])
    assert out.groupBy("k", "t").agg(F.countDistinct("__chunk").alias("c")).filter("c > 1").count() == 0
    assert out.select("__chunk").distinct().count() > 3
    grouped = windows.window_string_in_place(out, [*keys, "t"], "v", "s")
    count = lambda d: d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert count(grouped) == count(out)


def test_running_replaces_its_own_input(spark):
    data = history(6)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["id"]: r["v"] for r in windows.running_last_non_null(df, ["k"], ["t", "id"], "v").collect()}
    for rows in grouped(data).values():
        last = None
        for r in rows:
            last = r[3] if r[3] is not None else last
            assert got[r[0]] == last


def test_lookback_window_and_null_key(spark):
    data = history(7)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["id"]: r["id_prev"] for r in joins.lookback(df, ["k"], ["t", "id"], ["id"], hours=6).collect()}
    for key, rows in grouped(data).items():
        for prev, r in zip([None, *rows], rows):
            fresh = key is not None and prev is not None and prev[2] > r[2] - dt.timedelta(hours=6)
            assert got[r[0]] == (prev[0] if fresh else None)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_join_matches_brute_force(spark, how):
    left = [r[:3] for r in history(11, 150)]
    right = [(1000 + r[0], r[1], r[2]) for r in history(12, 150)]
    l = spark.createDataFrame(left, "lid int, k string, tout timestamp_ntz")
    r = spark.createDataFrame(right, "rid int, k string, tin timestamp_ntz")
    got = {x["lid"]: x["rid"] for x in joins.asof_join(l, r, ["k"], "tout", "tin", ["rid"], how).collect()}
    want = {}
    for lid, key, at in left:
        before = [(t, rid) for rid, k, t in right if key is not None and k == key and t <= at]
        if before or how == "left":
            want[lid] = max(before)[1] if before else None
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 5, 1_199, 1_200, 11_999, 12_001, 30_000])
def test_exact_quantiles(spark, n):
    rnd = np.random.default_rng(n)
    values = np.round(rnd.lognormal(3, 2, n), 2)
    df = spark.createDataFrame([(None, float(v)) for v in values] + [("nulls", None)], "k string, v double")
    probs = {"p0": 0.0, "p1": 0.001, "p5": 0.05, "p50": 0.5, "p999": 0.999, "p100": 1.0}
    got = exact_quantiles(df, ["k"], "v", probs).collect()
    assert len(got) == 1 and got[0]["k"] is None
    for name, p in probs.items():
        assert got[0][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("n", [3, 100, 5_000, 50_000])
def test_exact_quantiles_of_infinities(spark, n):
    """As the built-in percentile, with infinities, NaN and a value that fills half of the group."""
    rnd = np.random.default_rng(n)
    values = [float(v) for v in rnd.normal(0, 1, n)] + [float("-inf")] * (n // 3) + [float("inf")] * (n // 5) + [float("nan")] * 2 + [0.25] * n
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = {"a": 0.0, "b": 0.05, "c": 0.3, "d": 0.5, "e": 0.9, "f": 1.0}
    got = exact_quantiles(df, [], "v", probs).first()
    ordered = sorted(values, key=lambda v: (v != v, v))
    for name, p in probs.items():
        pos = (len(values) - 1) * p
        a, b, w = ordered[int(np.floor(pos))], ordered[int(np.ceil(pos))], pos - np.floor(pos)
        want = a if w == 0 or a == b else a * (1 - w) + b * w
        assert got[name] == pytest.approx(want, nan_ok=True)


def test_exact_quantiles_hot_value(spark):
    """A value that fills most of a group is counted, not gathered."""
    values = [5.0] * 20_000 + [float(i) for i in range(9_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.9}).first()
    assert (row["m"], row["q"]) == (np.quantile(values, 0.5), pytest.approx(np.quantile(values, 0.9)))


def test_ranked_dedup_keeps_unranked_first(spark, rows):
    data = [
        (1, "a", "t", 7, "Low"), (2, "a", "t", 7, "High"), (3, "a", "t", 7, None),
        (4, "b", "t", 7, None), (5, "b", "t", 7, "High"), (6, "c", "t", 8, "Low"), (7, "c", "t", 8, "High"),
        (8, None, "t", 7, "Low"), (9, None, "t", 7, "High"),
    ]
    df = spark.createDataFrame(data, "id int, h string, t string, item int, cat string")
    out = windows.ranked_dedup(df, ["h", "t", "item"], F.col("item") == 7, "cat", ["High", "Low"], ["id"])
    # a: best is 2; b: the unranked 4 precedes 5; c is not the ranked item; NULL keys are one group
    assert rows(out, "id") == [(2,), (4,), (6,), (9,)]


def test_dedup_is_preaggregated(spark):
    df = spark.createDataFrame(history(3), SCHEMA)
    plan = windows.dedup_keys(df, ["k"], ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_window_string_agg_variants_agree(spark, rows):
    df = spark.createDataFrame(history(9), SCHEMA)
    plainly = windows.window_string_agg(df, ["k", "t"], "v", "s")
    in_place = windows.window_string_in_place(df, ["k", "t"], "v", "s")
    assert rows(plainly, "id", "s") == rows(in_place, "id", "s")
    by = {}
    for i, k, t, v, _ in history(9):
        by.setdefault((k, t), []).append(v)
    for r in plainly.collect():
        values = sorted(v for v in by[(r["k"], r["t"])] if v is not None)
        assert r["s"] == (", ".join(values) if values else None)


@pytest.mark.parametrize("distinct", [False, True])
def test_window_string_agg_deals_a_large_group(spark, monkeypatch, distinct):
    """What the rows of a group receive grows with the square of its rows: it must not be one task's work."""
    monkeypatch.setattr(windows, "TEXT_BYTES", 20_000, raising=False)
    data = [(i, None if i % 2 else 7, "ab"[i % 4 == 0] if i % 3 else None) for i in range(2000)] + [(i, 8, None) for i in range(2000, 2003)]
    df = spark.createDataFrame(data, "id int, k int, v string")
    got = windows.window_string_agg(df, ["k"], "v", "s", distinct=distinct).withColumn("task", F.spark_partition_id()).collect()
    values = {k: sorted(v for _, j, v in data if j == k and v is not None) for k in (None, 7, 8)}
    texts = {k: ", ".join(sorted(set(v)) if distinct else v) or None for k, v in values.items()}
    assert sorted((r["id"], r["s"]) for r in got) == [(i, texts[k]) for i, k, _ in data]
    if not distinct:
        assert all(len({r["task"] for r in got if r["k"] == k}) > 2 for k in (None, 7))


def test_written_tables_have_small_files(spark, monkeypatch):
    """A scan task sorts the rows of all its files before it shuffles them, so a file must not hold all rows of a large task."""
    monkeypatch.setattr(scans, "FILE_ROWS", 100, raising=False)
    table = scans.materialised(spark.range(0, 1000, 1, 1), "small-files")
    files = table.groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in files) == 1000 and max(r["count"] for r in files) <= 100


def test_find_duplicates_null_keys(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, k string")
    assert rows(windows.find_duplicates(df, ["k"]), "id") == [(1,), (2,)]


@pytest.mark.parametrize("time", ["moving", "one instant", "none"])
def test_hot_key_is_spread_over_tasks(spark, time):
    """One key with all rows, over many days, at one instant or without times: the window is computed in many partitions."""
    at = {"moving": "timestamp_ntz'2024-03-01' + id * INTERVAL '5' MINUTE", "one instant": "timestamp_ntz'2024-03-01'", "none": "cast(NULL AS timestamp_ntz)"}
    df = spark.range(40_000).selectExpr("'hot' AS k", "id", f"{at[time]} AS t")
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {key: spark.conf.get(key) for key in off}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        out = scans.running(df, ["k"], ["t", "id"], {"n": scans.row_number(), "prev": scans.lag("id")}, 500)
        sizes = [r["c"] for r in out.select(F.spark_partition_id().alias("p"), "n").groupBy("p").agg(F.count("n").alias("c"), F.max("n")).collect()]
        assert out.filter("n <> id + 1 OR NOT (prev <=> nullif(id - 1, -1))").count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 40_000 and len(sizes) >= 16 and max(sizes) < 40_000 / 8


def test_ordered_bits(spark):
    from chartloom.operators.quantiles import with_ordered_bits

    rnd = np.random.default_rng(4)
    edge = [0.0, -0.0, 5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, float("inf"), float("nan")]
    near = [f * 2.0**e for e in range(-1020, 1020, 17) for f in (1.0, 1 - 2**-53, 1 + 2**-52)]
    values = [s * v for v in [*edge, *near, *np.exp(rnd.normal(0, 50, 3000)).tolist()] for s in (1, -1)]
    df = with_ordered_bits(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", "b")
    pairs = [(r["v"], r["b"]) for r in df.collect()]
    for v, b in pairs:
        if v == v:
            assert b == int(np.copysign(1, v)) * int(np.array([abs(v)]).view(np.int64)[0])
        else:
            assert b > max(x for w, x in pairs if w == w)


def test_quantiles_read_in_levels(spark):
    """Values that share all but their last bits need every level; nothing is exploded."""
    values = [1.0 + k * 2.0**-52 for k in range(3_000)] + [1.0 + k * 2.0**-30 for k in range(1_000)]
    df = spark.createDataFrame([(i % 2 and "a" or None, v) for i, v in enumerate(values)], "k string, v double")
    out = exact_quantiles(df, ["k"], "v", {"q": 0.25, "m": 0.5, "t": 0.875})
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: r for r in out.collect()}
    for key, part in (("a", values[1::2]), (None, values[::2])):
        for name, p in (("q", 0.25), ("m", 0.5), ("t", 0.875)):
            assert got[key][name] == pytest.approx(np.quantile(part, p), rel=1e-16)
