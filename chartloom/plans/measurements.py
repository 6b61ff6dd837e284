"""Vital-sign and laboratory tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.numeric import convert_when, f_to_c, lb_to_kg
from chartloom.functions.text import parse_comment_number
from chartloom.functions.time import Zone
from chartloom.operators.events import (
    EXCLUDED_LABELS, fetch_events, fetch_labs, include_decision, items_by_id_width, relevant_items, vocabulary_values,
)
from chartloom.operators.joins import dict_map, left_join_filtered_dim, value_map
from chartloom.operators.reshape import coalesce_columns, pivot_unique
from chartloom.operators.sets import concat_align, union_all
from chartloom.operators.windows import dedup_keys, distinct_on

# ---- fixed values ----
TEMPERATURE = "temp_c"
WEIGHT_LB_ITEM = 226531
TEMP_F_ITEM, TEMP_C_ITEM, TEMP_SITE_ITEM = 223761, 223762, 224642
TEMP_F_NAME, TEMP_C_NAME = "Temperature Fahrenheit", "Temperature Celsius"
VITAL_KEYS = ["hospitalization_id", "recorded_dttm", "vital_category", "vital_value"]
VITAL_COLUMNS = [
    "hospitalization_id", "recorded_dttm", "vital_name", "vital_category", "vital_value", "meas_site_name",
]
CONVERT = "TO MAP, CONVERT UOM"
LAB_DECISIONS = ["TO MAP, CONVERT UOM", "TO MAP, AS IS", "UNSURE"]
LAB_KEYS = ["hospitalization_id", "lab_collect_dttm", "lab_result_dttm", "lab_category", "lab_value_numeric"]
LAB_ITEM_WIDTH, CHART_ITEM_WIDTH = 5, 6
# ---- end of fixed values ----


def vitals(
    tables: dict[str, DataFrame], dictionary: DataFrame, mapping: DataFrame, zone: Zone = Zone(),
    name_col: str = "vital_name",
) -> DataFrame:
    """Mapped vital signs plus temperature, which is pivoted so that site and both units meet."""
    items = relevant_items(mapping, "vital_category", [*EXCLUDED_LABELS, TEMPERATURE])
    events = fetch_events(tables, dictionary, vocabulary_values(items, "itemid"), extra=["storetime"])
    number = F.when(F.col("itemid") == WEIGHT_LB_ITEM, lb_to_kg(F.col("value").try_cast("double"))).otherwise(
        F.col("value").try_cast("double")
    )
    events = events.withColumn("vital_value", number)
    events = dict_map(events, value_map(mapping, "itemid", name_col), "itemid", "vital_name")
    events = dict_map(events, value_map(mapping, "itemid", "vital_category"), "itemid", "vital_category")
    standard = events.select(
        F.col("hadm_id").alias("hospitalization_id"), F.col("time").alias("recorded_dttm"), "vital_name",
        "vital_category", "vital_value", F.lit(None).cast("string").alias("meas_site_name"),
        F.lit(0).alias("__part"), "storetime", "itemid",
    )
    temps = fetch_events(tables, dictionary, [TEMP_F_ITEM, TEMP_C_ITEM, TEMP_SITE_ITEM])
    wide = pivot_unique(
        temps, ["hadm_id", "time"], "itemid", "value",
        {TEMP_F_ITEM: "fahrenheit", TEMP_C_ITEM: "celsius", TEMP_SITE_ITEM: "meas_site_name"},
    )
    wide = wide.withColumns({
        "vital_name": F.when(F.col("celsius").isNotNull(), TEMP_C_NAME).otherwise(TEMP_F_NAME),
        "celsius": F.col("celsius").try_cast("double"),
        "converted": f_to_c(F.col("fahrenheit").try_cast("double")),
    })
    temperature = coalesce_columns(wide, {"vital_value": ["celsius", "converted"]}).filter(
        F.col("vital_value").isNotNull()
    ).select(
        F.col("hadm_id").alias("hospitalization_id"), F.col("time").alias("recorded_dttm"), "vital_name",
        F.lit(TEMPERATURE).alias("vital_category"), "vital_value", "meas_site_name", F.lit(1).alias("__part"),
    )
    both = concat_align(standard, temperature)
    kept = dedup_keys(both, VITAL_KEYS, ["__part", "storetime", "itemid", "meas_site_name"])
    return kept.select(*VITAL_COLUMNS).withColumns({
        "hospitalization_id": F.col("hospitalization_id").cast("string"),
        "recorded_dttm": zone.to_utc("recorded_dttm"),
    })


def labs(
    lab_events: DataFrame, chart_events: DataFrame, mapping: DataFrame, order_categories: DataFrame,
    zone: Zone = Zone(),
) -> DataFrame:
    """Lab events and lab-like chart events, unit-converted, de-duplicated and categorised."""
    wanted = include_decision(mapping.filter(F.col("itemid").isNotNull()), LAB_DECISIONS)
    lab_ids = vocabulary_values(items_by_id_width(wanted, LAB_ITEM_WIDTH), "itemid")
    chart_ids = vocabulary_values(items_by_id_width(wanted, CHART_ITEM_WIDTH), "itemid")

    le = fetch_labs(lab_events, lab_ids)
    missing = F.col("valuenum").isNull()
    le = le.withColumns({
        "text": F.when(missing, F.col("comments")).otherwise(F.coalesce("value", "comments")),
        "valuenum": F.when(missing, parse_comment_number("comments")).otherwise(F.col("valuenum")),
    })
    ce = chart_events.filter(F.col("itemid").isin(chart_ids)).withColumn(
        "text", F.coalesce(F.col("value").cast("string"), F.lit(""))
    )

    def mapped(events: DataFrame) -> DataFrame:
        dim = mapping.select("itemid", "label", "lab_category", "decision", "conversion_multiplier", "target_uom")
        df = left_join_filtered_dim(events, dim, "itemid", F.col("decision").isin(LAB_DECISIONS))
        number, text = convert_when(F.col("decision") == CONVERT, "conversion_multiplier", "valuenum", F.col("text"))
        return df.filter(F.col("lab_category").isNotNull()).select(
            F.col("hadm_id").alias("hospitalization_id"), F.col("charttime").alias("lab_collect_dttm"),
            F.col("storetime").alias("lab_result_dttm"), F.col("label").alias("lab_name"), "lab_category",
            number.cast("double").alias("lab_value_numeric"), text.alias("lab_value"),
            F.col("target_uom").alias("reference_unit"),
        )

    shared = ["hadm_id", "itemid", "charttime", "storetime", "valuenum", "text"]
    both = union_all(mapped(le.select(*shared)), mapped(ce.select(*shared)))
    kept = distinct_on(both, LAB_KEYS, "lab_result_dttm", ["lab_name", "lab_value", "reference_unit"])
    out = kept.join(order_categories.select("lab_category", "lab_order_category"), "lab_category", "left")
    empty = F.lit(None).cast("string")
    collected = zone.to_utc("lab_collect_dttm")
    return out.select(
        F.col("hospitalization_id").cast("string").alias("hospitalization_id"),
        collected.alias("lab_order_dttm"), collected.alias("lab_collect_dttm"),
        zone.to_utc("lab_result_dttm").alias("lab_result_dttm"), empty.alias("lab_order_name"), "lab_order_category",
        "lab_name", "lab_category", "lab_value", "lab_value_numeric", "reference_unit",
        empty.alias("lab_specimen_name"), empty.alias("lab_specimen_category"), empty.alias("lab_loinc_code"),
    )
