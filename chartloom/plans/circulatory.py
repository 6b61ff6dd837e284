"""Mechanical circulatory support table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import case_map, extract_number, null_if, text_after
from chartloom.functions.time import Zone
from chartloom.operators.events import vocabulary_values
from chartloom.operators.joins import full_outer_coalesce, inner_join_dim, left_join_trim_key
from chartloom.operators.profiling import conditional_pivot_max

# ---- fixed values ----
DEVICE = "device_name"
CONTROL = "control_parameter_category:"
DEFAULT_CATEGORY = {
    "ecmo_ecmo": "ecmo_other_unspec",
    "ecmo_ch": "ecmo_other_unspec",
    "hm2": "heartmate_2",
    "rvad": "rvad_other_unspec",
    "centrimag_lv": "centrimag_lv",
    "centrimag_rv": "centrimag_rv",
    "heartware": "heartware",
    "impella_r": "impella_rp",
}
DEFAULT_GROUP = {
    "ecmo_ecmo": "ecmo",
    "ecmo_ch": "ecmo",
    "hm2": "durable_lvad",
    "durable_vad": "durable_lvad",
    "heartware": "durable_lvad",
    "rvad": "temporary_rvad",
    "centrimag_lv": "temporary_lvad",
    "centrimag_rv": "temporary_rvad",
    "impella_l": "impella_lvad",
    "impella_r": "temporary_rvad",
}
COLUMNS = [
    "hospitalization_id", "recorded_dttm", "_device_context", "device_name", "device_category", "mcs_group",
    "ecmo_configuration_category", "control_parameter_name", "control_parameter_category",
    "control_parameter_value", "flow", "sweep_set", "fdo2_set",
]
# ---- end of fixed values ----


def mapped_events(chart_events: DataFrame, mapping: DataFrame) -> DataFrame:
    items = mapping.filter(F.trim("variable") != "").select("itemid", "variable", "label", "device_context")
    events = chart_events.filter(F.col("itemid").isin(vocabulary_values(items, "itemid")))
    events = events.select("hadm_id", "charttime", "itemid", "value", "valuenum")
    return inner_join_dim(events, items, "itemid", ["hadm_id"])


def device_events(events: DataFrame, devices: DataFrame) -> DataFrame:
    dim = devices.select(
        "itemid", "value", F.col("label").alias("device_label"), "device_category", "mcs_group",
        null_if("ecmo_configuration_category", "NA").alias("ecmo_configuration_category"),
    )
    named = left_join_trim_key(events.filter(F.col("variable") == DEVICE), dim, ["itemid"], "value")
    return named.select(
        "hadm_id", "charttime", "device_context",
        F.concat("device_label", F.lit(" = "), "value").alias("device_name"),
        "device_category", "mcs_group", "ecmo_configuration_category",
    )


def measurements(events: DataFrame) -> DataFrame:
    variable, value, number = F.col("variable"), F.col("value"), F.col("valuenum").cast("double")
    control = variable.startswith(CONTROL)
    rpm, power = variable == f"{CONTROL}rpm", variable == f"{CONTROL}impella_power"
    setting = F.when(rpm, number).otherwise(extract_number(value, r"\d+").cast("double"))
    return conditional_pivot_max(
        events.filter(variable != DEVICE), ["hadm_id", "charttime", "device_context"],
        {
            "flow": (variable == "flow", number),
            "sweep_set": (variable == "sweep_set", extract_number(value)),
            "fdo2_set": (variable == "fdo2_set", number / 100.0),
            "control_parameter_name": (control, F.col("label")),
            "control_parameter_category": (control, text_after(variable)),
            "control_parameter_value": (rpm | power, setting),
        },
    )


def circulatory_support(
    chart_events: DataFrame, mapping: DataFrame, devices: DataFrame, zone: Zone = Zone()
) -> DataFrame:
    events = mapped_events(chart_events, mapping)
    both = full_outer_coalesce(
        measurements(events), device_events(events, devices), ["hadm_id", "charttime", "device_context"]
    )
    out = both.withColumns({
        "hospitalization_id": F.col("hadm_id").cast("string"),
        "recorded_dttm": zone.to_utc("charttime"),
        "_device_context": F.col("device_context"),
        "device_category": F.coalesce("device_category", case_map("device_context", DEFAULT_CATEGORY)),
        "mcs_group": F.coalesce("mcs_group", case_map("device_context", DEFAULT_GROUP)),
        **{c: F.col(c).cast("float") for c in ("control_parameter_value", "flow", "sweep_set", "fdo2_set")},
    })
    return out.select(*COLUMNS)
