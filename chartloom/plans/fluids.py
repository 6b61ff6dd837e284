"""Fluid input / output, position and renal-replacement tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import case_map
from chartloom.functions.time import Zone
from chartloom.operators.events import fetch_events, filter_contains, include_decision, vocabulary_values
from chartloom.operators.joins import inner_join_dim
from chartloom.operators.reshape import pivot_unique

# ---- fixed values ----
MAPPED = "TO MAP"
POSITION_ITEM = 224093
CRRT_TABLE = "crrt"
CRRT_RATES = [
    "blood_flow_rate", "pre_filter_replacement_fluid_rate", "post_filter_replacement_fluid_rate",
    "dialysate_flow_rate", "ultrafiltration_out",
]
# ---- end of fixed values ----


def fluid_events(output_events: DataFrame, mapping: DataFrame, kind: str, zone: Zone = Zone()) -> DataFrame:
    """``kind`` is "input" or "output"; the mapping has ``<kind>_category`` and ``<kind>_group``."""
    wanted = include_decision(mapping, MAPPED).select("itemid", "label", f"{kind}_category", f"{kind}_group")
    # the item list also goes to the scan as a pushed-down filter
    events = output_events.filter(F.col("itemid").isin(vocabulary_values(wanted, "itemid")))
    df = inner_join_dim(events.select("hadm_id", "charttime", "itemid", "value"), wanted, "itemid", ["hadm_id", "value"])
    return df.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), zone.to_utc("charttime").alias("recorded_dttm"),
        F.col("label").alias(f"{kind}_name"), f"{kind}_category", f"{kind}_group",
        F.col("value").cast("float").alias(f"{kind}_volume"),
    )


def position(
    tables: dict[str, DataFrame], dictionary: DataFrame, zone: Zone = Zone(), item: int = POSITION_ITEM
) -> DataFrame:
    events = fetch_events(tables, dictionary, [item])
    return events.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), zone.to_utc("time").alias("recorded_dttm"),
        F.col("value").cast("string").alias("position_name"),
        case_map("value", {"Prone": "prone"}, "not_prone").alias("position_category"),
    )


def crrt_therapy(
    tables: dict[str, DataFrame], dictionary: DataFrame, mapping: DataFrame, zone: Zone = Zone(),
    variable: str = "variable",
) -> DataFrame:
    """The mapping names the output variable of each item in column ``variable``."""
    items = filter_contains(mapping, "table", CRRT_TABLE).select("itemid", F.col(variable).alias("crrt_variable"))
    events = fetch_events(tables, dictionary, vocabulary_values(items, "itemid")).select(
        "itemid", "hadm_id", "time", F.col("value").cast("string").alias("value")
    )
    wide = pivot_unique(
        events.join(items, "itemid"), ["hadm_id", "time"], "crrt_variable", "value", ["crrt_mode_name", *CRRT_RATES]
    )
    return wide.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), F.lit(None).cast("string").alias("device_id"),
        zone.to_utc("time").alias("recorded_dttm"), "crrt_mode_name",
        F.lower("crrt_mode_name").alias("crrt_mode_category"),
        F.lit(None).cast("string").alias("dialysis_machine_name"),
        *[F.col(c).cast("float").alias(c) for c in CRRT_RATES],
    )
