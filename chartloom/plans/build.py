"""Build a chosen set of output tables; one failure does not stop the rest."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.time import Zone
from chartloom.operators.quality import RowGuard, failure_cases
from chartloom.operators.scans import materialised
from chartloom.plans import assessments, circulatory, codes, encounters, fluids, measurements, medication, respiratory
from chartloom.plans.schemas import rules_for
from chartloom.sources.outputs import OutputStore, Staged, publish, published, stage_output

log = logging.getLogger("chartloom.build")


@dataclass
class Inputs:
    """Source tables and vocabularies by name, plus what is particular to the site."""

    sources: Mapping[str, DataFrame]
    vocabularies: Mapping[str, DataFrame]
    zone: Zone = Zone()
    hospital_id: str = "site"
    source_name: str = "SOURCE"
    _written: dict[str, DataFrame] = field(default_factory=dict)

    def once(self, name: str, make: Callable[[], DataFrame], guard: RowGuard | None = None) -> DataFrame:
        """An intermediate that several tables start from, written to the shared folder when first asked for."""
        if name not in self._written:
            made = materialised(make(), name)
            if guard:
                guard.confirm()
            self._written[name] = made
        return self._written[name]

    @property
    def events(self) -> dict[str, DataFrame]:
        names = ["chartevents", "procedureevents", "datetimeevents", "inputevents", "ingredientevents", "outputevents"]
        return {n: self.sources[n] for n in names if n in self.sources}


def _medication(i: Inputs) -> tuple[DataFrame, DataFrame]:
    v = i.vocabularies
    guard = RowGuard()
    shared = i.once("medication-orders", lambda: medication.mapped_orders(
        i.events, i.sources["d_items"], v["med_category"], v["med_route_category"], v["med_route_category_special"], guard
    ), guard)
    return medication.from_mapped(shared, v["continuous_med_groups"], v["intermittent_med_groups"], v.get("mar_action_dedup"), i.zone)


TABLES: dict[str, Callable[[Inputs], DataFrame]] = {
    "patient": lambda i: encounters.patient(
        i.sources["patients"], i.sources["admissions"], i.vocabularies["race_ethnicity"], i.zone
    ),
    "hospitalization": lambda i: encounters.hospitalization(
        i.sources["admissions"], i.sources["patients"], i.vocabularies["discharge"], i.zone
    ),
    "adt": lambda i: encounters.adt(i.sources["transfers"], i.vocabularies["adt"], i.hospital_id, i.zone),
    "vitals": lambda i: measurements.vitals(i.events, i.sources["d_items"], i.vocabularies["vitals"], i.zone),
    "labs": lambda i: measurements.labs(
        i.sources["labevents"], i.sources["chartevents"], i.vocabularies["labs"],
        i.vocabularies["lab_order_categories"], i.zone,
    ),
    "patient_assessments": lambda i: assessments.patient_assessments(
        i.events, i.sources["d_items"], i.sources["icustays"], i.vocabularies["assessment_groups"], i.zone,
        i.source_name,
    ),
    "patient_assessments_raw_gcs": lambda i: assessments.raw_gcs(i.events, i.sources["d_items"], i.zone),
    "respiratory_support": lambda i: respiratory.respiratory_support(
        i.events, i.sources["d_items"], i.vocabularies["respiratory_support"], i.vocabularies["device_category"],
        i.vocabularies["mode_category"], i.zone,
    ),
    "medication_admin_continuous": lambda i: _medication(i)[0],
    "medication_admin_intermittent": lambda i: _medication(i)[1],
    "position": lambda i: fluids.position(i.events, i.sources["d_items"], i.zone),
    "crrt_therapy": lambda i: fluids.crrt_therapy(i.events, i.sources["d_items"], i.vocabularies["dialysis"], i.zone),
    "ecmo_mcs": lambda i: circulatory.circulatory_support(
        i.sources["chartevents"], i.vocabularies["ecmo_mcs"], i.vocabularies["ecmo_mcs_device"], i.zone
    ),
    "code_status": lambda i: encounters.code_status(
        i.events, i.sources["d_items"], i.sources["admissions"], i.zone
    ),
    "hospital_diagnosis": lambda i: codes.hospital_diagnosis(i.sources["diagnoses_icd"]),
    "patient_procedures": lambda i: codes.patient_procedures(
        i.sources["procedures_icd"], i.sources["hcpcsevents"], i.zone
    ),
    "input": lambda i: fluids.fluid_events(i.sources["outputevents"], i.vocabularies["input"], "input", i.zone),
    "output": lambda i: fluids.fluid_events(i.sources["outputevents"], i.vocabularies["output"], "output", i.zone),
}


def build_tables(
    inputs: Inputs, store: OutputStore, tables: Iterable[str] | None = None, cluster: bool = True
) -> dict[str, str]:
    """Write the tables, then publish all that succeeded in one step; returns table → path, or "failed: <reason>".

    Rules are checked while a table is written (``read_checks``); violations do not keep it from being published. Until the last
    step readers see the release as it was.
    """
    outcome: dict[str, str] = {}
    staged: list[Staged] = []
    spark: SparkSession | None = None
    for name in tables if tables is not None else TABLES:
        try:
            df = TABLES[name](inputs)
            spark = df.sparkSession
            key = next((k for k in ("hospitalization_id", "patient_id") if k in df.columns), None)
            done = stage_output(df, store, name, key if cluster else None, rules=rules_for(name, inputs.vocabularies))
            staged.append(done)
            outcome[name] = done.path
        except Exception as exc:  # reported per table, the others go on
            log.exception("building %s failed", name)
            outcome[name] = f"failed: {type(exc).__name__}: {str(exc).splitlines()[0] if str(exc) else ''}"
    if staged:
        number = publish(spark, store, staged)
        rows = [(number, *row) for s in staged for row in s.report]
        spark.createDataFrame(rows, "build bigint, " + CHECKS).coalesce(1).write.mode("append").parquet(f"{store.release}/_checks")
    return outcome


CHECKS = "table string, check string, column string, example string, n bigint"


def read_checks(spark: SparkSession, store: OutputStore, build: int | None = None) -> DataFrame:
    """What the rules found while the tables of a build (the last by default) were written: one row per rule that was broken."""
    found = spark.read.schema("build bigint, " + CHECKS).parquet(f"{store.release}/_checks")
    number = build or published(spark, store).agg(F.max("build")).first()[0]
    return found.filter(F.col("build") == number).drop("build")


def check_tables(tables: Mapping[str, DataFrame], vocabularies: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One report of all violations, value by value, over tables that exist already and have declared rules."""
    rules = {name: rules_for(name, vocabularies or {}) for name in tables}
    return reduce(DataFrame.unionByName, [failure_cases(df, name, rules[name]) for name, df in tables.items() if rules[name]])
