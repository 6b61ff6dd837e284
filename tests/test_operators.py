"""Mapping, reshape, event and quality operators on small cases."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartloom.operators import events, joins, profiling, quality, reshape, sets
from chartloom.plans import cohort
from chartloom.sources.vocabulary import vocabulary


def mapping(spark):
    return vocabulary(spark, "k string, v string, decision string", [
        ("a", "first", "TO MAP"), ("a", "second", "TO MAP"), ("b", "NO MAPPING", "TO MAP"), ("c", "x", "UNSURE"),
        ("d", "y", None), (None, "z", "TO MAP"),
    ])


def test_value_map_last_wins_and_null_decision_kept(spark, rows):
    assert rows(joins.value_map(mapping(spark), "k", "v")) == [("a", "second"), ("b", None), ("d", "y")]


def test_strict_map_fails_on_unknown(spark):
    df = spark.createDataFrame([("a ",), (None,)], "s string")
    lookup = joins.value_map(mapping(spark), "k", "v")
    assert {r["o"] for r in joins.strict_dict_map(df, lookup, "s", "o").collect()} == {"second", None}
    bad = spark.createDataFrame([("zzz",)], "s string")
    with pytest.raises(PySparkException, match="unknown value"):
        joins.strict_dict_map(bad, lookup, "s", "o").collect()


def test_small_dimension_is_broadcast_without_hint(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    plan = joins.dict_map(df, joins.value_map(mapping(spark), "k", "v"), "s", "o")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_outer_merge_matches_null_keys(spark, rows):
    l = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    r = spark.createDataFrame([(None, 3), ("b", 4)], "k string, y int")
    assert rows(joins.outer_merge(l, r, ["k"])) == [("a", 2, None), ("b", None, 4), (None, 1, 3)]
    assert len(joins.full_outer_coalesce(l, r, ["k"]).collect()) == 4


def test_fuzzy_match(spark, rows):
    df = spark.createDataFrame([("norepinephrin",), ("Norepinephrine",), ("zz",), (None,)], "n string")
    out = joins.fuzzy_match(df, "n", ["norepinephrine", "epinephrine"])
    assert rows(out, "n", "category") == [
        ("Norepinephrine", "norepinephrine"), ("norepinephrin", "norepinephrine"), ("zz", None),
    ]


def test_pivot_unique_raises_on_duplicate_cell(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], "i int, k string, v int")
    assert rows(reshape.pivot_unique(df, ["i"], "k", "v", ["a", "b", "c"])) == [(1, 5, 6, None), (2, 7, None, None)]
    with pytest.raises(PySparkException, match="more than one"):
        reshape.pivot_unique(df.union(df.filter("i = 2")), ["i"], "k", "v", ["a", "b"]).collect()


def test_unpivot_and_melt(spark):
    df = spark.createDataFrame([(1, None, 2)], "i int, a int, b int")
    assert reshape.unpivot_drop_nulls(df, ["i"], ["a", "b"], "n", "v").count() == 1
    assert reshape.melt_keep_nulls(df, ["i"], ["a", "b"], "n", "v").count() == 2


def test_guarded_sentinel_drop(spark):
    schema = "itemid int, value string"
    ok = spark.createDataFrame([(1, "None"), (1, None), (2, "x")], schema)
    assert events.guarded_sentinel_drop(ok, 1).count() == 2
    assert events.sentinel_violations(ok, 1).count() == 0
    for bad, reasons in (
        ([(1, "None"), (2, "None")], {"other item"}), ([(2, "x")], {"no row of the item"}), ([(2, "None")], {"other item", "no row of the item"}),
    ):
        df = spark.createDataFrame(bad, schema)
        assert {r["violation"] for r in events.sentinel_violations(df, 1).collect()} == reasons
        plan = events.guarded_sentinel_drop(df, 1)  # building it runs nothing
        if "other item" in reasons:
            with pytest.raises(Exception, match="must all have"):
                plan.collect()


def test_fuzzy_match_with_a_table_of_categories(spark):
    """The segment index finds what scoring all pairs finds, for any number of categories, and compares few of them."""
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))
    names = spark.createDataFrame([(word(),) for _ in range(80)] + [(None,), ("",)], "n string")
    categories = sorted({word() for _ in range(150)} | {""})
    for least in (50.0, 80.0, 100.0):
        by_list = {r["n"]: r["category"] for r in joins.fuzzy_match(names, "n", categories, min_score=least).collect()}
        table = spark.createDataFrame([(c,) for c in categories], "c string")
        by_join = {r["n"]: r["category"] for r in joins.fuzzy_match(names, "n", table, min_score=least).collect()}
        assert by_join == by_list
    many = spark.range(3000).selectExpr("concat('category ', id) AS c")
    assert joins.fuzzy_match(spark.createDataFrame([("category 2999",)], "n string"), "n", many).first()["category"] == "category 2999"
    # longer texts, edited: all pairs against the index
    rnd = random.Random(5)
    terms = sorted({"".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(4, 24))) for _ in range(300)})

    def edited(t):
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(t) + 1)
            t = rnd.choice([t[:i] + rnd.choice("abcdefgh") + t[i:], t[:i] + t[i + 1 :], t[:i] + "x" + t[i + 1 :]])
        return t.upper() if rnd.random() < 0.2 else t

    names = spark.createDataFrame([(edited(rnd.choice(terms)),) for _ in range(200)], "n string")
    table = spark.createDataFrame([(c,) for c in terms], "c string")
    for least in (70.0, 80.0, 90.0):
        want = {r["n"]: (r["category"], r["score"] if r["category"] else None) for r in joins.fuzzy_match(names, "n", terms, min_score=least).collect()}
        got = joins.fuzzy_match(names, "n", table, min_score=least).collect()
        assert {r["n"]: (r["category"], r["score"]) for r in got} == want
        assert sum(r["n_candidates"] for r in got) < len(got) * len(terms) / 4


def test_what_would_be_lost_is_reported(spark):
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, None), (4, "7.5"), (4, "x")], "itemid int, v string")
    got = {(r["value"], r["n"]) for r in quality.check_castable(df, "t", "v", "int").collect()}
    assert got == {("x", 2), ("7.5", 1)}
    dictionary = spark.createDataFrame([(1, "chartevents"), (2, None), (3, "labevents"), (3, None)], "itemid int, linksto string")
    got = {(r["value"], r["n"]) for r in quality.check_known_items(df, dictionary, "t").collect()}
    assert got == {("2", 1), ("4", 2)}
    got = [(r["value"], r["n"]) for r in quality.check_conflicting_cells(df, "t", [], "itemid", "v").collect()]
    assert got == [("4", 2)]


def test_any_number_of_copies():
    assert [cohort.letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_sorted_order_of_rows(spark):
    """The order itself, not only the set of rows."""
    rnd = random.Random(1)
    data = [(rnd.choice([None, 1, 2, 3]), f"2020-01-0{rnd.randint(1, 9)} 00:00:00", i) for i in range(200)]
    got = events.sort_events(spark.createDataFrame(data, "hadm_id int, time string, i int").repartition(5), extra=["i"]).collect()
    assert [r["i"] for r in got] == [r[2] for r in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))]
    got = sets.order_rows(spark.createDataFrame(data, "h int, t string, i int").repartition(5), ["i"]).collect()
    assert [r["i"] for r in got] == list(range(200))


def test_drop_null_and_sentinel_keeps_null(spark, rows):
    df = spark.createDataFrame([(1, "UNKNOWN"), (2, None), (None, "x"), (3, "y")], "h int, c string")
    assert rows(events.drop_null_and_sentinel(df, "h", "c"), "h") == [(2,), (3,)]


def test_fetch_events_routes_and_pushes_items(spark, tmp_path):
    chart = spark.createDataFrame(
        [(1, 10, 100, "2024-01-01", "a", 1.0, "u"), (2, 10, 100, "2024-01-01", "b", 1.0, "u")],
        "itemid int, hadm_id int, stay_id int, charttime string, value string, valuenum double, valueuom string",
    )
    chart.write.parquet(str(tmp_path / "c"))
    procedures = spark.createDataFrame(
        [(3, 10, 100, "2024-01-02", 5.0, "min")],
        "itemid int, hadm_id int, stay_id int, endtime string, value double, valueuom string",
    )
    items = vocabulary(spark, "itemid int, label string, linksto string", [
        (1, "one", "chartevents"), (2, "two", "chartevents"), (3, "three", "procedureevents"),
    ])
    tables = {"chartevents": spark.read.parquet(str(tmp_path / "c")), "procedureevents": procedures}
    out = events.fetch_events(tables, items, [1, 3])
    assert {(r["itemid"], r["value"], r["valuenum"]) for r in out.collect()} == {(1, "a", 1.0), (3, "5.0", None)}
    assert "PushedFilters: [IsNotNull(itemid), EqualTo(itemid,1)]" in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="not given"):
        events.fetch_events({"chartevents": tables["chartevents"]}, items, [1, 3])


def test_item_search_without_events_and_without_match(spark):
    items = vocabulary(
        spark, "itemid int, label string, abbreviation string, linksto string, category string, unitname string, param_type string",
        [(1, "Heart Rate", "HR", "chartevents", "V", "bpm", "Numeric"), (2, "Rate", "R", "chartevents", "V", None, "Text")],
    )
    chart = spark.createDataFrame([(2, "x", None), (2, "x", None), (2, "y", None)], "itemid int, value string, valuenum double")
    found = {r["itemid"]: (r["kw"], r["count"], r["value_instances"]) for r in events.item_search({"chartevents": chart}, items, "rate").collect()}
    assert found == {1: ("rate", 1, "Min: , Mean: , Max: "), 2: ("rate", 3, "x: 2, y: 1")}
    none = events.item_search({"chartevents": chart}, items, "zzz").collect()
    assert len(none) == 1 and none[0]["kw"] == "zzz" and none[0]["itemid"] is None


def test_item_stats_of_every_event_table(spark):
    items = vocabulary(spark, "itemid int, label string, linksto string, param_type string", [(1, "one", "t", "Numeric")])
    inputs = spark.createDataFrame(
        [(1, 1.0, 2.0, "mg", "mg/h", "c", None, "d"), (1, 3.0, 4.0, "mg", "", "c", "s", "d")],
        "itemid int, rate double, amount double, amountuom string, rateuom string, ordercategoryname string, secondaryordercategoryname string, ordercategorydescription string",
    )
    row = profiling.item_value_stats(inputs, items, "inputevents").first()
    assert row["value_instances"] == "Rate: 1.0, 2.0, 3.0; Amount: 2.0, 3.0, 4.0"
    assert row["amountuom_instances"] == "mg: 1" and row["ordercategoryname_instances"] == "c: 2"
    outputs = spark.createDataFrame([(1, 5.0, "mL"), (1, 8.0, "mL")], "itemid int, value double, valueuom string")
    row = profiling.item_value_stats(outputs, items, "outputevents").first()
    assert (row["value_instances"], row["valueuom_instances"]) == ("Min: 5.0, Median: 6.5, Max: 8.0", "mL: 2")
    dates = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-02-01")], "itemid int, value string")
    row = profiling.item_value_stats(dates, items, "datetimeevents").first()
    assert row["value_instances"] == "Earliest: 2024-01-01, Latest: 2024-02-01"
    with pytest.raises(NotImplementedError):
        profiling.item_value_stats(dates, items, "elsewhere")


def test_set_difference_ignores_null(spark, rows):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "c string")
    assert rows(sets.set_difference(df, "c", vocabulary(spark, "c string", [("a",)]))) == [("b",)]


def test_failure_cases_collects_everything(spark, rows):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "bad", 3.0), (None, "ok", 0.5)], "id string, cat string, fio2 double")
    schema = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("cat", T.StringType()), T.StructField("fio2", T.DoubleType()),
        T.StructField("gone", T.StringType()),
    ])
    rules = quality.TableRules(
        schema, required=["id"], isin={"cat": ["ok"]}, ranges={"fio2": (0.2, 1.0)}, values_eq={"cat": ["ok", "never"]},
    )
    assert rows(quality.failure_cases(df, "t", rules), "check", "column", "value", "n") == [
        ("isin", "cat", "bad", 1), ("not_null", "id", None, 1), ("range", "fio2", "3.0", 1),
        ("schema_missing", "gone", "string", None), ("unique_values_eq", "cat", "bad", 1),
        ("unique_values_eq", "cat", "never", 0),
    ]


def test_vocabulary_values(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (3,)], "itemid int")
    assert events.vocabulary_values(df, "itemid") == [1, 3]


def test_fetch_events_by_a_table_of_items(spark, rows):
    """A DataFrame of items gives what the list gives, and nothing of it comes to the driver."""
    chart = spark.createDataFrame(
        [(1, 10, 5, "t", "a", 1.0, "u"), (2, 10, 5, "t", "b", 2.0, "u"), (9, 10, 5, "t", "c", 3.0, "u")],
        "itemid int, hadm_id int, stay_id int, charttime string, value string, valuenum double, valueuom string",
    )
    procedures = spark.createDataFrame([(3, 10, 5, "t", "d", "u")], "itemid int, hadm_id int, stay_id int, endtime string, value string, valueuom string")
    dictionary = vocabulary(spark, "itemid int, label string, linksto string", [(1, "x", "chartevents"), (2, "y", "chartevents"), (3, "z", "procedureevents")])
    tables = {"chartevents": chart, "procedureevents": procedures}
    items = spark.createDataFrame([(1,), (3,), (3,), (77,), (None,)], "itemid int")
    by_table, by_list = events.fetch_events(tables, dictionary, items), events.fetch_events(tables, dictionary, [1, 3])
    assert rows(by_table, *by_list.columns) == rows(by_list) and by_list.count() == 2


def test_ambiguous_route_fails(spark):
    df = spark.createDataFrame([("a", 1)], "k string, i int")
    general = spark.createDataFrame([("a", "iv"), ("a", "iv")], "k string, r string")
    special = spark.createDataFrame([("a", 1, "po")], "k string, i int, r string")
    look = lambda g: joins.two_step_null_safe_lookup(df, g, special, ["k"], "r", F.lit(True), ["k", "i"], F.lit(True)).collect()
    assert [r["r"] for r in look(general)] == ["iv"]
    with pytest.raises(Exception, match="ambiguous r: im / iv"):
        look(general.union(spark.createDataFrame([("a", "im")], "k string, r string")))


def test_id_overlaps(spark, rows):
    """Equal to exact distinct counts, NULL and repeated ids included; empty tables hold nothing."""
    rnd = random.Random(4)
    data = {n: [rnd.choice([None, *range(30)]) for _ in range(k)] for n, k in (("a", 40), ("b", 25), ("c", 0))}
    tables = {n: spark.createDataFrame([(i,) for i in ids], "id int") for n, ids in data.items()}
    held = {n: {i for i in ids if i is not None} for n, ids in data.items()}
    want = {("a", "a"): "aa", ("a", "b"): "ab", ("a", "c"): "ac", ("b", "b"): "bb", ("b", "c"): "bc", ("c", "c"): "cc"}
    got = {(r["table_a"], r["table_b"]): r["n_ids"] for r in profiling.id_overlaps(tables, "id").collect()}
    assert got == {k: len(held[v[0]] & held[v[1]]) for k, v in want.items()}
