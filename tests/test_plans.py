"""Table plans on small hand-made sources."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.functions.time import Zone
from chartloom.plans import encounters, medication
from chartloom.plans.build import Inputs, build_tables, check_tables, read_checks
from chartloom.plans.schemas import RULES
from chartloom.sources.catalog import MODULES, Catalog, csv_to_parquet, csv_to_parquet_many, read_source
from chartloom.sources.outputs import OutputStore, read_output, write_output
from chartloom.sources.vocabulary import read_mapping, vocabulary

INTERVAL = (
    "hadm_id long, starttime timestamp_ntz, endtime timestamp_ntz, linkorderid long, med_category string, "
    "statusdescription string, rate double, rateuom string, itemid int, label string, med_route_name string, "
    "med_route_category string"
)


def at(hour: int, minute: int = 0) -> dt.datetime:
    return dt.datetime(2130, 5, 6, hour, minute)


def interval(start, end, order, drug, status, rate, hadm=1):
    return (hadm, start, end, order, drug, status, rate, "u", 1, drug.title(), "drip", "iv")


def flattened(spark, data):
    df = spark.createDataFrame(data, INTERVAL)
    out = medication.dedup_actions(medication.flatten(df))
    return [
        (r["med_order_id"], r["med_category"], r["admin_dttm"].strftime("%H:%M"), r["mar_action_name"], r["mar_action_category"], r["med_dose"])
        for r in out.orderBy("med_order_id", "med_category", "admin_dttm", "mar_action_name").collect()
    ]


def test_flatten_start_change_pause_restart_finish(spark):
    data = [
        interval(at(3), at(4), 10, "alpha", "ChangeDose/Rate", 0.1),
        interval(at(4), at(5), 10, "alpha", "Paused", 0.2),  # pause, gap, restart
        interval(at(6), at(7), 10, "alpha", "Paused", 0.3),  # paused and restarted at 07:00
        interval(at(7), at(8), 10, "alpha", "FinishedRunning", 0.4),
    ]
    assert flattened(spark, data) == [
        (10, "alpha", "03:00", "[Started]", "start", 0.1),
        (10, "alpha", "04:00", "ChangeDose/Rate", "dose_change", 0.2),
        (10, "alpha", "05:00", "Paused", "stop", 0.0),
        (10, "alpha", "06:00", "[Restarted]", "start", 0.3),
        (10, "alpha", "07:00", "Paused, [Restarted]", "going", 0.4),
        (10, "alpha", "08:00", "FinishedRunning", "stop", 0.0),
    ]


def test_flatten_keeps_orders_and_drugs_apart(spark):
    data = [
        interval(at(1), at(2), 10, "alpha", "ChangeDose/Rate", 1.0), interval(at(2), at(3), 10, "alpha", "Stopped", 2.0),
        interval(at(1), at(2), 10, "beta", "ChangeDose/Rate", 5.0), interval(at(2), at(3), 10, "beta", "Paused", 6.0),
        interval(at(2), at(4), 11, "alpha", "Stopped", 9.0),
    ]
    assert flattened(spark, data) == [
        (10, "alpha", "01:00", "[Started]", "start", 1.0), (10, "alpha", "02:00", "ChangeDose/Rate", "dose_change", 2.0),
        (10, "alpha", "03:00", "Stopped", "stop", 0.0), (10, "beta", "01:00", "[Started]", "start", 5.0),
        (10, "beta", "02:00", "ChangeDose/Rate", "dose_change", 6.0), (10, "beta", "03:00", "Paused", "stop", 0.0),
        (11, "alpha", "02:00", "[Started]", "start", 9.0), (11, "alpha", "04:00", "Stopped", "stop", 0.0),
    ]


def test_flatten_bolus_and_unruled_duplicates(spark):
    data = [
        interval(at(1), at(2), 10, "alpha", "ChangeDose/Rate", 1.0), interval(at(2), at(3), 10, "alpha", "Bolus", 7.0),
        # two ends at 05:00 have no rule: both rows stay
        interval(at(4), at(5), 12, "alpha", "FinishedRunning", 1.0), interval(at(4, 30), at(5), 12, "alpha", "FinishedRunning", 2.0),
    ]
    assert flattened(spark, data) == [
        (10, "alpha", "01:00", "[Started]", "start", 1.0),
        (10, "alpha", "02:00", "ChangeDose/Rate, [Started Bolus]", "dose_change", 7.0),
        (10, "alpha", "03:00", "[Finished Bolus]", "dose_change", 1.0 * 7.0),
        (12, "alpha", "04:00", "[Started]", "start", 1.0), (12, "alpha", "04:30", "[Restarted]", "start", 2.0),
        (12, "alpha", "05:00", "FinishedRunning", "stop", 0.0), (12, "alpha", "05:00", "FinishedRunning", "stop", 0.0),
    ]


RACES = [("WHITE", "White", "Non-Hispanic"), ("ASIAN", "Asian", "Non-Hispanic"), ("DECLINED", "Unknown", "Unknown"),
         ("LATINO", "Other", "Hispanic")]


@pytest.mark.parametrize("visits, expected", [
    (["WHITE", "ASIAN", "ASIAN"], "ASIAN"),  # most frequent
    (["ASIAN", "WHITE"], "WHITE"),  # tie: most recent
    (["WHITE", "DECLINED"], "WHITE"),  # uninformative is disregarded
    (["LATINO", "DECLINED"], "LATINO"),  # "Other" with a known ethnicity is informative
    (["DECLINED"], "DECLINED"),
    ([None], None),
])
def test_race_selection(spark, visits, expected):
    rows = [(1, i, race, at(i)) for i, race in enumerate(visits)]
    admissions = spark.createDataFrame(rows, "subject_id int, hadm_id int, race string, admittime timestamp_ntz")
    mapping = vocabulary(spark, "source_race string, race string, ethnicity string", RACES)
    out = encounters.race_ethnicity(admissions, mapping).collect()
    assert len(out) == 1 and out[0]["race_name"] == expected
    assert out[0]["race_category"] is not None


def test_read_mapping(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('\ufeffsrc_a,dst_b,note\n1.0,"x, y","two\nlines"\n,z,\n', encoding="utf-8")
    df = read_mapping(spark, str(path), columns="src_|dst_", types={"src_a": "int"}, strip_prefix="^(src|dst)_")
    assert [tuple(r) for r in df.orderBy("_ordinal").select("a", "b").collect()] == [(1, "x, y"), (None, "z")]


def test_catalog_paths(spark, tmp_path):
    catalog = Catalog(csv_dir=str(tmp_path))
    assert catalog.path(spark, "patients", "csv").endswith("/hosp/patients.csv.gz")
    assert catalog.path(spark, "patients") == f"{tmp_path}/parquet/patients.parquet"
    for module in MODULES:
        (tmp_path / "parquet" / module).mkdir(parents=True)
    assert catalog.path(spark, "d_items") == f"{tmp_path}/parquet/icu/d_items.parquet"
    with pytest.raises(ValueError, match="unknown source table"):
        catalog.path(spark, "nope")
    with pytest.raises(ValueError, match="unsupported format"):
        catalog.path(spark, "patients", "orc")


def test_csv_conversion_skips_and_overwrites(spark, tmp_path):
    import gzip

    (tmp_path / "hosp").mkdir()
    path = tmp_path / "hosp" / "patients.csv.gz"
    path.write_bytes(gzip.compress(b"subject_id,gender\n1,F\n2,M\n"))
    catalog = Catalog(csv_dir=str(tmp_path))
    csv_to_parquet(spark, catalog, "patients")
    with pytest.raises(FileExistsError):
        csv_to_parquet(spark, catalog, "patients")
    assert csv_to_parquet_many(spark, catalog, ["patients"])["patients"].startswith("skipped")
    path.write_bytes(gzip.compress(b"subject_id,gender\n1,F\n2,M\n3,F\n"))
    csv_to_parquet(spark, catalog, "patients", overwrite=True, schema="subject_id bigint, gender string", cluster_by=["subject_id"])
    assert read_source(spark, catalog, "patients").count() == 3


def test_write_output_clusters(spark, tmp_path):
    store = OutputStore(str(tmp_path), name="x")
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("hospitalization_id"), "id")
    write_output(df, store, "t", cluster_by="hospitalization_id", partitions=3)
    assert read_output(spark, store, "t").count() == 100


def test_build_reports_failures_and_goes_on(spark, tmp_path):
    diagnoses = spark.createDataFrame([(1, "A1", 10, 1), (2, "B2", 8, 2)], "hadm_id int, icd_code string, icd_version int, seq_num int")
    inputs = Inputs({"diagnoses_icd": diagnoses}, {}, Zone())
    store = OutputStore(str(tmp_path))
    outcome = build_tables(inputs, store, ["patient", "hospital_diagnosis"])
    assert outcome["patient"].startswith("failed: KeyError")
    built = read_output(spark, store, "hospital_diagnosis")
    assert built.schema.fieldNames() == RULES["hospital_diagnosis"].schema.fieldNames()
    report = {(r["check"], r["column"], r["n"]) for r in check_tables({"hospital_diagnosis": built}).collect()}
    assert report == {("not_null", "diagnosis_code_format", 1)}
    observed = {(r["check"], r["column"], r["n"]) for r in read_checks(spark, store).collect()}
    assert observed == report  # collected while the table was written


def test_failed_build_leaves_the_old_release(spark, tmp_path, monkeypatch):
    """A build that is killed between tables publishes none of them; versions are found by build, and expire."""
    from chartloom.plans import build
    from chartloom.sources import outputs

    store = OutputStore(str(tmp_path))
    table = lambda n: spark.createDataFrame([(str(i), "A", 10) for i in range(n)], "hadm_id string, icd_code string, icd_version int")
    monkeypatch.setattr(build, "TABLES", {"a": lambda i: i.sources["a"], "b": lambda i: i.sources["b"]})
    build_tables(Inputs({"a": table(3), "b": table(4)}, {}), store)
    assert [read_output(spark, store, n).count() for n in "ab"] == [3, 4]

    def killed(i):
        raise KeyboardInterrupt

    monkeypatch.setattr(build, "TABLES", {"a": lambda i: i.sources["a"], "b": killed})
    with pytest.raises(KeyboardInterrupt):
        build_tables(Inputs({"a": table(30)}, {}), store)
    assert [read_output(spark, store, n).count() for n in "ab"] == [3, 4]
    # a job that fails while it writes
    broken = table(5).withColumn("x", F.when(F.col("hadm_id") == "3", F.raise_error(F.lit("no"))).otherwise(F.lit("1")))
    monkeypatch.setattr(build, "TABLES", {"a": lambda i: broken, "b": lambda i: i.sources["b"]})
    outcome = build_tables(Inputs({"b": table(6)}, {}), store)
    assert outcome["a"].startswith("failed") and [read_output(spark, store, n).count() for n in "ab"] == [3, 6]
    assert read_output(spark, store, "b", build=1).count() == 4
    assert len(outputs.expire(spark, store, "b")) == 1 and read_output(spark, store, "b").count() == 6
    with pytest.raises(FileNotFoundError):
        read_output(spark, store, "c")


def test_rules_are_observed_while_writing(spark, tmp_path):
    from chartloom.operators.quality import TableRules
    from chartloom.sources.outputs import stage_output
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "bad", 3.0), (None, "ok", 0.5), ("2", None, None)], "id string, cat string, fio2 double").repartition(3)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("gone", T.LongType())])
    rules = TableRules(schema, True, ["id"], {"cat": ["ok"]}, {"fio2": (0.2, 1.0)}, ["fio2"], {"cat": ["ok", "never"]})
    done = stage_output(df, OutputStore(str(tmp_path)), "t", "id", 2, rules)
    assert done.rows == 3 and sorted(map(str, done.report)) == sorted(map(str, [
        ("t", "schema_missing", "gone", "bigint", None), ("t", "schema_unexpected", "cat", "string", None),
        ("t", "schema_unexpected", "fio2", "double", None), ("t", "not_null", "id", None, 1), ("t", "all_null", "fio2", None, 2),
        ("t", "isin", "cat", "bad", 1), ("t", "range", "fio2", "3.0", 1), ("t", "unique_values_eq", "cat", "bad", 1),
        ("t", "value_missing", "cat", "never", 0),
    ]))


def test_row_guard(spark):
    from chartloom.operators.quality import RowCountChanged, RowGuard
    from chartloom.operators.scans import materialised

    df, dim = spark.range(50), spark.createDataFrame([(i, "x") for i in [1, 2, 2]], "id long, v string")
    guard = RowGuard()
    materialised(guard.keep("distinct look-up", df, lambda d: d.join(dim.dropDuplicates(["id"]), "id", "left")), "guard")
    assert guard.confirm() == {"distinct look-up": 50}
    materialised(guard.keep("ambiguous look-up", df, lambda d: d.join(dim, "id", "left")), "guard")
    with pytest.raises(RowCountChanged, match="50 rows before, 51 after"):
        guard.confirm()


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    """Only the needed columns are read, and items and presence are filtered at the scan."""
    from chartloom.plans import fluids

    path = str(tmp_path / "outputevents")
    spark.createDataFrame(
        [(1, at(1), 10, 5.0, "mL", "note"), (1, at(2), 11, None, "mL", "note"), (None, at(3), 10, 5.0, "mL", "note")],
        "hadm_id int, charttime timestamp_ntz, itemid int, value double, valueuom string, note string",
    ).write.parquet(path)
    mapping = vocabulary(spark, "itemid int, label string, output_category string, output_group string, decision string", [
        (10, "a", "x", "g", "TO MAP"), (11, "b", "y", "g", "TO MAP"), (12, "c", "z", "g", "NO MAPPING"),
    ])
    out = fluids.fluid_events(spark.read.parquet(path), mapping, "output")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1
    assert "ReadSchema: struct<hadm_id:int,charttime:timestamp_ntz,itemid:int,value:double>" in plan
    assert "In(itemid, [10,11])" in plan and "IsNotNull(hadm_id)" in plan and "IsNotNull(value)" in plan
    assert "BroadcastHashJoin" in plan


def test_one_shuffle_per_label_table(spark):
    """Encounter look-ups never shuffle the event side."""
    transfers = spark.range(100).select(
        F.col("id").alias("subject_id"), F.col("id").alias("hadm_id"), F.lit("Ward").alias("careunit"),
        F.current_timestamp().alias("intime"), F.current_timestamp().alias("outtime"),
    ).repartition(3)
    units = vocabulary(spark, "careunit string, location_category string, location_type string", [("Ward", "ward", None)])
    plan = encounters.adt(transfers, units, "s")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_isolates_are_told_apart_by_their_sensitivities(spark):
    """Two orders with the same sensitivities are one isolate, a third with others is another; flags are no antibiotic."""
    from chartloom.plans import microbiology

    def row(hour, drug, result, organism="E. Coli"):
        return (1, 2, at(1), at(9), at(hour), "Blood", "Culture", "cult", organism, drug, result)

    data = [
        row(1, "cefepime", "Resistant"), row(1, "Gentamicin 5", "susceptible"), row(2, "gentamicin", "Susceptible"), row(2, "Cefepime", "resistant "),
        row(3, "cefepime", "susceptible"), row(3, "ESBL", "positive"), row(3, None, "resistant"), row(1, "cefepime", "intermediate", "yeast"),
    ]
    schema = "patient_id int, hospitalization_id int, lab_collect_dttm timestamp_ntz, lab_result_dttm timestamp_ntz, lab_order_dttm timestamp_ntz," \
        " fluid_name string, micro_order_name string, method_name string, organism_name string, antibiotic_name string, susceptibility_name string"
    names = "organism_name string, organism_category string, organism_group string"
    ontology = vocabulary(spark, names, [("e. coli", "escherichia_coli", "gram negative"), ("E. COLI", "escherichia_coli", "gram negative")])
    cultures = spark.createDataFrame(data, schema)
    out = microbiology.microbiology_culture(cultures, ontology)
    got = sorted((r["organism_category"] or "", r["organism_id"], r["n_orders"], r["antibiotic_category"], r["susceptibility_category"]) for r in out.collect())
    assert got == [
        ("", 1, 1, "cefepime", "intermediate"),
        ("escherichia_coli", 1, 2, "cefepime", "non_susceptible"), ("escherichia_coli", 1, 2, "gentamicin", "susceptible"),
        ("escherichia_coli", 2, 1, "cefepime", "susceptible"),
    ]
    doubtful = vocabulary(spark, names, [("e. coli", "a", "x"), ("E. coli", "b", "x")])
    assert microbiology.ambiguous_organisms(cultures, doubtful).count() == 7
    with pytest.raises(Exception, match="ambiguous organism"):
        microbiology.microbiology_culture(cultures, doubtful).collect()


def nodes(plan):
    """All operators of a physical plan."""
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return list(nodes(df.filter("true")._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def recorded(monkeypatch, module, spark, into):
    """Keeps the plans of what a module writes while it builds its plan."""
    from chartloom.operators.scans import materialised

    def write(df, purpose):
        into[purpose] = static_plan(spark, df)
        return materialised(df, purpose)

    monkeypatch.setattr(module, "materialised", write)


def test_assessments_read_chart_events_twice(spark, tmp_path, monkeypatch):
    from chartloom.plans import assessments

    items = [(i, f"label {i}", "chartevents") for i in [assessments.RASS_ITEM, *assessments.BRADEN_ITEMS, *assessments.CAM_ITEMS, *assessments.SBT_CATEGORIES]]
    path, schema = str(tmp_path / "chart"), "subject_id int, hadm_id int, stay_id int, itemid int, charttime timestamp_ntz, storetime timestamp_ntz, value string, valuenum double, valueuom string"
    data = [(1, 2, 3, i, at(1), at(2), "3", 3.0, None) for i, _, _ in items] + [(1, 2, 3, i, at(1), at(2), "x", 4.0, None) for i in assessments.RAW_GCS_CATEGORIES]
    spark.createDataFrame(data, schema).write.parquet(path)
    written = {}
    recorded(monkeypatch, assessments, spark, written)
    out = assessments.patient_assessments(
        {"chartevents": spark.read.parquet(path)}, vocabulary(spark, "itemid int, label string, linksto string", items),
        spark.createDataFrame([(2, 3)], "hadm_id int, stay_id int"), vocabulary(spark, "assessment_category string, assessment_group string", [("RASS", "g")]),
    )
    scans_of = lambda plan: sum("Scan parquet" in n.nodeName() and path in n.toString() for n in plan)
    assert set(written) == {"assessments", "coma-scale"}
    assert sum(map(scans_of, written.values())) + scans_of(static_plan(spark, out)) == 2
    assert out.filter("assessment_category = 'gcs_total' AND numerical_value = 12").count() == 1


def test_continuous_medications_shuffle_rows_twice(spark, monkeypatch):
    """Intervals once, for de-duplication; points once, by order key and range, for numbers and for actions."""
    written = {}
    recorded(monkeypatch, medication.scans, spark, written)
    df = spark.createDataFrame([interval(at(1), at(2), 10, "alpha", "Stopped", 1.0)], INTERVAL)
    points = medication.flatten(medication.dedup_intervals(df))
    final = static_plan(spark, medication.dedup_actions(points))

    def row_shuffles(plan, column):
        found = [n for n in plan if n.nodeName() == "Exchange" and "hashpartitioning" in n.toString().split("\n")[0]]
        return sum(column in n.output().toString() for n in found)

    assert row_shuffles(written["medication-points"], "label") == 1
    assert row_shuffles(final, "med_name") == 1
