"""Microbiology cultures: categories by rule, isolates told apart by their sensitivities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.functions.culture_rules import antibiotic_category, fluid_category, method_category, susceptibility_category
from chartloom.operators.keys import null_safe_join

# ---- fixed values ----
LOWERED = ["micro_order_name", "fluid_name", "method_name", "organism_name", "antibiotic_name", "susceptibility_name"]
NOT_AN_ANTIBIOTIC = "esbl"
CULTURE = [
    "patient_id", "hospitalization_id", "lab_collect_dttm", "lab_result_dttm", "fluid_category", "method_category",
    "organism_category", "organism_group",
]
# ---- end of fixed values ----


def organisms(ontology: DataFrame) -> DataFrame:
    """One row per organism name; a name with two categories or groups fails the job instead of multiplying rows."""
    problem = F.raise_error(F.concat(F.lit("ambiguous organism: "), F.col("organism_name"))).cast("string")

    def only(c: str):
        return F.when(F.count_distinct(c) > 1, problem).otherwise(F.max(c)).alias(c)

    named = ontology.select(F.lower("organism_name").alias("organism_name"), "organism_category", "organism_group")
    return named.groupBy("organism_name").agg(only("organism_category"), only("organism_group"))


def categorised(rows: DataFrame, ontology: DataFrame) -> DataFrame:
    """Cultures with organism, method, fluid, antibiotic and susceptibility categories.

    Rows whose antibiotic is missing or only flags a resistance are left out.
    """
    df = rows.withColumns({c: F.lower(c) for c in LOWERED})
    df = df.filter(F.col("antibiotic_name") != NOT_AN_ANTIBIOTIC)
    df = df.join(organisms(ontology), "organism_name", "left")
    return df.withColumns({
        "method_category": method_category(F.col("method_name")),
        "fluid_category": fluid_category(F.col("fluid_name"), F.col("micro_order_name"), F.col("method_name")),
        "antibiotic_category": antibiotic_category(F.col("antibiotic_name")),
        "susceptibility_category": susceptibility_category(F.col("susceptibility_name")),
    })


def sensitivities(df: DataFrame, isolate: Sequence[str]) -> DataFrame:
    """Antibiotics wide, for any set of them: one row per isolate with its sorted (antibiotic, susceptibility) entries and their text.

    Several values of one cell resolve to the smallest that is present.
    """
    cells = df.groupBy(*CULTURE, *isolate, "antibiotic_category").agg(F.min("susceptibility_category").alias("susceptibility_category"))
    entry = F.struct("antibiotic_category", "susceptibility_category")
    wide = cells.groupBy(*CULTURE, *isolate).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    text = F.transform("entries", lambda e: F.concat(e["antibiotic_category"], F.lit("="), F.coalesce(e["susceptibility_category"], F.lit(""))))
    return wide.withColumn("signature", F.array_join(text, "|"))


def microbiology_culture(
    rows: DataFrame, ontology: DataFrame, isolate: Sequence[str] = ("lab_order_dttm", "micro_order_name")
) -> DataFrame:
    """One row per culture, isolate and antibiotic.

    Rows that agree in the culture and in the columns ``isolate`` belong to one isolate. Isolates of a culture with the same
    sensitivities are one; different ones are numbered by their signature, from 1.
    """
    wide = sensitivities(categorised(rows, ontology), isolate)
    distinct = wide.groupBy(*CULTURE, "signature").agg(F.first("entries").alias("entries"), F.count(F.lit(1)).alias("n_orders"))
    numbered = distinct.withColumn("organism_id", F.row_number().over(W.partitionBy(*CULTURE).orderBy("signature")))
    return numbered.select(*CULTURE, "organism_id", "n_orders", F.inline("entries"))


def susceptibility_table(long: DataFrame, antibiotics: Sequence[str]) -> DataFrame:
    """Isolates with one column per listed antibiotic (NULL where not tested)."""
    cells = [F.max(F.when(F.col("antibiotic_category") == a, F.col("susceptibility_category"))).alias(a) for a in antibiotics]
    return long.groupBy(*CULTURE, "organism_id").agg(*cells)


def ambiguous_organisms(rows: DataFrame, ontology: DataFrame) -> DataFrame:
    """Rows of names that the ontology maps to more than one category or group: what would fail ``organisms``."""
    bad = ontology.groupBy(F.lower("organism_name").alias("organism_name")).agg(
        F.greatest(F.count_distinct("organism_category"), F.count_distinct("organism_group")).alias("n")
    ).filter("n > 1")
    return null_safe_join(rows.withColumn("organism_name", F.lower("organism_name")), bad, ["organism_name"], "inner")
