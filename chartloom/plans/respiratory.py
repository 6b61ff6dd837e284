"""Respiratory-support table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.numeric import clean_fraction
from chartloom.functions.time import Zone
from chartloom.operators.events import (
    fetch_events, guarded_sentinel_drop, relevant_items, rename_reorder, vocabulary_values,
)
from chartloom.operators.joins import dict_map, strict_dict_map, value_map
from chartloom.operators.reshape import coalesce_columns, pivot_unique
from chartloom.operators.scans import materialised
from chartloom.operators.windows import ranked_dedup, running_any

# ---- fixed values ----
DEVICE_RANKING = [
    "IMV", "NIPPV", "CPAP", "High Flow NC", "Face Mask", "Trach Collar", "Nasal Cannula", "Room Air", "Other",
]
DEVICE_ITEM, FIO2_VARIABLE, BRAND_ITEM = 226732, "fio2_set", 223848
TRACH_DEVICES = ["Tracheostomy tube", "Trach mask"]
COALESCED = {
    "tracheostomy": [225448, 226237],
    "lpm_set": [223834, 227287],
    "tidal_volume_obs": [224685, 224686, 224421],
    "resp_rate_set": [224688, 227581],
    "resp_rate_obs": [224690, 224422],
    "flow_rate_set": [224691, 227582],
    "peep_set": [220339, 227579],
    "mode_name": [223849, 229314, 227577],
}
SINGLE_ITEMS = {
    226732: "device_name",
    223848: "vent_brand_name",
    223835: "fio2_set",
    224684: "tidal_volume_set",
    224702: "pressure_control_set",
    224701: "pressure_support_set",
    227580: "peak_inspiratory_pressure_set",
    224738: "inspiratory_time_set",
    224696: "plateau_pressure_obs",
    224695: "peak_inspiratory_pressure_obs",
    224700: "peep_obs",
    224687: "minute_vent_obs",
    224697: "mean_airway_pressure_obs",
}
COLUMNS = [
    "hospitalization_id", "recorded_dttm", "device_name", "device_category", "vent_brand_name", "mode_name",
    "mode_category", "tracheostomy", "fio2_set", "lpm_set", "tidal_volume_set", "resp_rate_set",
    "pressure_control_set", "pressure_support_set", "flow_rate_set", "peak_inspiratory_pressure_set",
    "inspiratory_time_set", "peep_set", "tidal_volume_obs", "resp_rate_obs", "plateau_pressure_obs",
    "peak_inspiratory_pressure_obs", "peep_obs", "minute_vent_obs", "mean_airway_pressure_obs",
]
# ---- end of fixed values ----


def respiratory_events(
    tables: dict[str, DataFrame], dictionary: DataFrame, mapping: DataFrame, devices: DataFrame,
    exclude: Column | None = None,
) -> DataFrame:
    """Long, cleaned events with one value per encounter, time and item."""
    ids = vocabulary_values(relevant_items(mapping, "variable"), "itemid")
    events = fetch_events(tables, dictionary, ids, extra=["storetime"]).withColumn("value", F.col("value").cast("string"))
    events = guarded_sentinel_drop(events, DEVICE_ITEM)
    events = dict_map(events, value_map(mapping, "itemid", "variable", decision="variable"), "itemid", "variable")
    cleaned = F.when(
        F.col("variable") == FIO2_VARIABLE, clean_fraction(F.col("value").try_cast("double")).cast("string")
    ).otherwise(F.col("value"))
    events = events.withColumn("value", cleaned).filter(F.col("value").isNotNull())
    is_device = F.col("itemid") == DEVICE_ITEM
    lookup = device_lookup(devices)
    events = events.withColumn("__device", F.when(is_device, F.col("value")))
    events = strict_dict_map(events, lookup, "__device", "device_category").drop("__device", "label", "variable")
    return ranked_dedup(
        events, ["hadm_id", "time", "itemid"], is_device, "device_category", DEVICE_RANKING, ["storetime", "value"],
        exclude,
    )


def device_lookup(devices: DataFrame) -> DataFrame:
    devices = devices.withColumn("device_name", F.trim("device_name"))
    return value_map(
        devices, "device_name", "device_category", decision="device_category", excluded_items=[BRAND_ITEM]
    )


def respiratory_support(
    tables: dict[str, DataFrame], dictionary: DataFrame, mapping: DataFrame, devices: DataFrame, modes: DataFrame,
    zone: Zone = Zone(), exclude: Column | None = None,
) -> DataFrame:
    """``exclude`` drops the rows it selects wherever they still have duplicates after ranking."""
    long = respiratory_events(tables, dictionary, mapping, devices, exclude)
    ids = [i for group in COALESCED.values() for i in group]
    wide = pivot_unique(
        long, ["hadm_id", "time"], "itemid", "value", {**{i: str(i) for i in ids}, **SINGLE_ITEMS}
    )
    wide = coalesce_columns(wide, {name: [str(i) for i in group] for name, group in COALESCED.items()})
    wide = strict_dict_map(wide, device_lookup(devices), "device_name", "device_category")
    mode_map = value_map(modes, "mode_name", "mode_category", decision="mode_category")
    wide = dict_map(wide, mode_map, "mode_name", "mode_category")
    out = rename_reorder(wide, {"time": "recorded_dttm"}, COLUMNS)
    numbers = [c for c in COLUMNS if c.endswith(("_set", "_obs"))]
    out = out.withColumns({c: F.col(c).try_cast("double") for c in numbers})
    out = out.withColumn("hospitalization_id", F.col("hospitalization_id").cast("string"))
    implied = F.coalesce(F.trim("device_name").isin(TRACH_DEVICES), F.lit(False)) | F.coalesce(
        F.col("tracheostomy").try_cast("double") == 1, F.lit(False)
    )
    # written once, read for bounds, summaries and rows; the wall-clock order is kept for the running flag, then the time becomes UTC
    out = running_any(materialised(out.withColumn("__implied", implied), "respiratory"), ["hospitalization_id"], ["recorded_dttm"], F.col("__implied"), "tracheostomy")
    return out.withColumn("recorded_dttm", zone.to_utc("recorded_dttm")).select(*COLUMNS)
