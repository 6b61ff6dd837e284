"""Conversion, output and build queries. They write whole tables to the shared folder and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.catalogue import tables_a as a
from chartloom.catalogue.base import QUERIES, Tables, Vocabulary, query, with_ctes
from chartloom.plans import codes, encounters, fluids
from chartloom.plans.build import CHECKS, Inputs, build_tables, check_tables
from chartloom.plans.schemas import RULES, rules_for
from chartloom.session import shared_folder
from chartloom.sources.catalog import Catalog, csv_to_parquet, csv_to_parquet_many, read_source
from chartloom.sources.outputs import OutputStore, publish, read_output, stage_output, write_output
from chartloom.sources.vocabulary import read_mapping

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


def _csv_catalog(t: Tables, **tables) -> Catalog:
    catalog = Catalog(csv_dir=shared_folder(t.spark, "csv"))
    for name, df in tables.items():
        df.write.option("header", True).option("compression", "gzip").csv(catalog.path(t.spark, name, "csv"))
    return catalog


@query("csv_to_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def convert_one(t: Tables):
    catalog = _csv_catalog(t, patients=t.customer)
    csv_to_parquet(t.spark, catalog, "patients", schema=CUSTOMER)
    return read_source(t.spark, catalog, "patients")


@query("read_source_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def read_csv(t: Tables):
    return read_source(t.spark, _csv_catalog(t, patients=t.supplier), "patients", "csv", SUPPLIER)


@query(
    "csv_to_parquet_many",
    """SELECT 'chartevents' AS table_name, CAST(event_id AS VARCHAR) AS id, event_type AS text, user_id AS number FROM events
    UNION ALL SELECT 'patients', CAST(c_custkey AS VARCHAR), c_name, c_nationkey FROM customer""",
)
def convert_many(t: Tables):
    catalog = _csv_catalog(t, patients=t.customer, chartevents=t.events)
    csv_to_parquet_many(t.spark, catalog, ["patients"])
    # the second call skips what exists and converts the rest
    csv_to_parquet_many(t.spark, catalog, ["patients", "chartevents"])
    columns = {"patients": ("c_custkey", "c_name", "c_nationkey"), "chartevents": ("event_id", "event_type", "user_id")}
    parts = [
        read_source(t.spark, catalog, n).select(
            F.lit(n).alias("table_name"), F.col(i).cast("string").alias("id"), F.col(text).alias("text"), F.col(number).cast("bigint").alias("number")
        )
        for n, (i, text, number) in columns.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "read_mapping",
    "SELECT CAST(p_partkey AS INT) AS partkey, p_name AS name, CAST(p_retailprice AS VARCHAR) AS retailprice FROM part",
)
def mapping_file(t: Tables):
    path = shared_folder(t.spark, "mapping")
    t.part.write.option("header", True).csv(path)
    out = read_mapping(t.spark, path, columns="key$|name|price", types={"p_partkey": "int"}, strip_prefix="^p_")
    return out.drop("_ordinal")


@query("write_read_output", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def outputs(t: Tables):
    store = OutputStore(shared_folder(t.spark, "outputs"))
    write_output(t.orders, store, "orders", cluster_by="o_custkey")
    return read_output(t.spark, store, "orders")


BUILT = ["output", "input", "hospitalization", "hospital_diagnosis"]
PLANS = {
    "output": a.fluid_sql("output", a.OUTPUT_ITEMS), "input": a.fluid_sql("input", a.INPUT_ITEMS),
    "hospitalization": QUERIES["plan_hospitalization"].sql, "hospital_diagnosis": QUERIES["plan_hospital_diagnosis"].sql,
}
# the vocabulary of permitted output categories lacks one that is mapped
PERMITTED = Vocabulary("output_category string, output_group string", [("indwelling_urinary_catheter", "urine"), ("drain", "other")])
INPUT_PERMITTED = Vocabulary("input_category string, input_group string", [("flush_irrigation_urine", "flush_irrigation")])


def _built(t: Tables, tables: list[str], vocabularies: dict) -> OutputStore:
    sources = {
        "outputevents": t.derive(a.FLUID_EVENTS), "admissions": t.derive(a.ADMISSIONS), "patients": t.derive(a.PATIENTS),
        "diagnoses_icd": t.derive(a.DIAGNOSES),
    }
    inputs = Inputs(sources, {"output": a.OUTPUT_ITEMS.df(t), "input": a.INPUT_ITEMS.df(t), "discharge": a.DISCHARGES.df(t), **vocabularies})
    store = OutputStore(shared_folder(t.spark, "build"))
    build_tables(inputs, store, tables)
    return store


_CELLS = {
    "output": "recorded_dttm AS at, output_name AS name, output_category AS category, CAST(output_volume AS DOUBLE) AS value",
    "input": "recorded_dttm AS at, input_name AS name, input_category AS category, CAST(input_volume AS DOUBLE) AS value",
    "hospitalization": "admission_dttm AS at, patient_id AS name, discharge_category AS category, CAST(age_at_admission AS DOUBLE) AS value",
    "hospital_diagnosis": "CAST(NULL AS TIMESTAMP) AS at, diagnosis_code AS name, diagnosis_code_format AS category, CAST(NULL AS DOUBLE) AS value",
}


@query("build_tables", " UNION ALL ".join(f"SELECT '{n}' AS table_name, hospitalization_id, {_CELLS[n]} FROM ({PLANS[n]})" for n in BUILT))
def build(t: Tables):
    # "adt" has no source here: its failure is reported and the rest is still built and published together
    store = _built(t, [*BUILT[:2], "adt", *BUILT[2:]], {})
    tables = [read_output(t.spark, store, n).selectExpr(f"'{n}' AS table_name", "hospitalization_id", *_CELLS[n].replace("TIMESTAMP", "TIMESTAMP_LTZ").split(", ")) for n in BUILT]
    return reduce(DataFrame.unionByName, tables)


def _rule_sql(table: str) -> list[str]:
    """Declared rules as plain counts: (table, check, column, value, n)."""
    rules, out = RULES[table], []
    permitted = dict(rules.isin)
    if table == "output":
        permitted |= {c: [r[i] for r in PERMITTED.rows] for i, c in enumerate(["output_category", "output_group"])}
    if table == "input":
        permitted |= {c: [r[i] for r in INPUT_PERMITTED.rows] for i, c in enumerate(["input_category", "input_group"])}
    head = "SELECT '{t}' AS \"table\", '{k}' AS \"check\", '{c}' AS \"column\", {v} AS value, COUNT(*) AS n FROM built_{t} WHERE {w}"
    for kind, columns, where in (("not_null", rules.required, "IS NULL"), ("all_null", rules.all_null, "IS NOT NULL")):
        out += [head.format(t=table, k=kind, c=c, v="CAST(NULL AS VARCHAR)", w=f"{c} {where}") + " HAVING COUNT(*) > 0" for c in columns]
    for c, values in permitted.items():
        words = ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)
        out.append(head.format(t=table, k="isin", c=c, v=f"CAST({c} AS VARCHAR)", w=f"{c} NOT IN ({words})") + f" GROUP BY {c}")
    return out


RULES_SQL = " UNION ALL ".join(s for n in BUILT for s in _rule_sql(n))
_BUILT_SQL = {f"built_{n}": PLANS[n] for n in BUILT}


@query("check_tables", with_ctes(RULES_SQL, **_BUILT_SQL))
def checked(t: Tables):
    """Value by value, over built tables read back, with permitted values from vocabularies."""
    store = _built(t, BUILT, {})
    return check_tables({n: read_output(t.spark, store, n) for n in BUILT}, {"output": PERMITTED.df(t), "input": INPUT_PERMITTED.df(t)})


@query("check_on_write", with_ctes(
    f"""SELECT "table", "check", "column", MIN(value) AS example, CAST(SUM(n) AS BIGINT) AS n FROM ({RULES_SQL}) GROUP BY ALL""", **_BUILT_SQL
))
def checked_on_write(t: Tables):
    """Rule by rule, collected while the tables were written: no table is read for it."""
    items = {"output": a.OUTPUT_ITEMS.df(t), "input": a.INPUT_ITEMS.df(t)}
    store = OutputStore(shared_folder(t.spark, "checked"))
    wanted = {"output": PERMITTED.df(t), "input": INPUT_PERMITTED.df(t)}
    done = []
    for n in BUILT:
        df = {
            "output": lambda: fluids.fluid_events(t.derive(a.FLUID_EVENTS), items["output"], "output"),
            "input": lambda: fluids.fluid_events(t.derive(a.FLUID_EVENTS), items["input"], "input"),
            "hospitalization": lambda: encounters.hospitalization(t.derive(a.ADMISSIONS), t.derive(a.PATIENTS), a.DISCHARGES.df(t)),
            "hospital_diagnosis": lambda: codes.hospital_diagnosis(t.derive(a.DIAGNOSES)),
        }[n]()
        done.append(stage_output(df, store, n, "hospitalization_id", rules=rules_for(n, wanted)))
    publish(t.spark, store, done)
    return t.spark.createDataFrame([row for s in done for row in s.report], CHECKS)
