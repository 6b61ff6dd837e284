"""Patient-assessment tables: coma scale, sedation, skin risk, delirium, breathing trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.numeric import coma_total
from chartloom.functions.text import case_map, prefix_number, strict_sum, text_to_ordinal, three_valued_delirium
from chartloom.functions.time import Zone
from chartloom.operators.events import fetch_events, only_items
from chartloom.operators.joins import dict_map, lookback, value_map
from chartloom.operators.profiling import conditional_pivot_max
from chartloom.operators.reshape import melt_keep_nulls, pivot_first, pivot_max
from chartloom.operators.scans import materialised
from chartloom.operators.sets import concat_align, union_all
from chartloom.operators.windows import dedup_keys

# ---- fixed values ----
COLUMNS = [
    "hospitalization_id", "recorded_dttm", "assessment_name", "assessment_category", "assessment_group",
    "numerical_value", "categorical_value", "text_value",
]
GCS_VERBAL, GCS_MOTOR, GCS_EYES = 223900, 223901, 220739
INTUBATED = "No Response-ETT"
GCS_CATEGORIES = {"gcs": "gcs_total", "gcs_motor": "gcs_motor", "gcs_verbal": "gcs_verbal", "gcs_eyes": "gcs_eye"}
RAW_GCS_CATEGORIES = {GCS_VERBAL: "gcs_verbal", GCS_MOTOR: "gcs_motor", GCS_EYES: "gcs_eyes"}
RAW_GCS_GROUP = "Neurological"
RASS_ITEM = 228096
RASS_NAME, RASS_CATEGORY = "Richmond-RAS Scale", "RASS"
COMPUTED = "COMPUTED FROM SUB-SCORES; NOT ORIGINALLY AVAILABLE IN {source}"
BRADEN_ITEMS = [224054, 224055, 224056, 224057, 224058, 224059]
BRADEN_LABELS = {
    "Braden Activity": "braden_activity",
    "Braden Friction/Shear": "braden_friction",
    "Braden Mobility": "braden_mobility",
    "Braden Moisture": "braden_moisture",
    "Braden Nutrition": "braden_nutrition",
    "Braden Sensory Perception": "braden_sensory",
}
BRADEN_WORDS = {
    "braden_activity": ["Bedfast", "Chairfast", "Walks Occasionally", "Walks Frequently"],
    "braden_friction": ["Problem", "Potential Problem", "No Apparent Problem"],
    "braden_mobility": ["Completely Immobile", "Very Limited", "Slight Limitations", "No Limitations"],
    "braden_moisture": ["Consistently Moist", "Moist", "Occasionally Moist", "Rarely Moist"],
    "braden_nutrition": ["Very Poor", "Probably Inadequate", "Adequate", "Excellent"],
    "braden_sensory": ["Completely Limited", "Very Limited", "Slight Impairment", "No Impairment"],
}
CAM_ITEMS = [228300, 228337, 229326, 228301, 228336, 229325, 228302, 228334, 228303, 228335, 229324]
CAM_MENTAL_ITEM, CAM_MENTAL_LABEL = 228300, "CAM-ICU MS Change"
CAM_LABELS = {
    "CAM-ICU MS Change": "cam_mental",
    "CAM-ICU Inattention": "cam_inattention",
    "CAM-ICU Disorganized thinking": "cam_thinking",
    "CAM-ICU RASS LOC": "cam_loc",
    "CAM-ICU Altered LOC": "cam_loc",
}
SBT_CATEGORIES = {224717: "sbt_delivery_pass_fail", 224833: "sbt_fail_reason", 224716: "sbt_fail_reason"}
SBT_RESULTS = {"Yes": "Pass", "No": "Fail"}
# ---- end of fixed values ----


def coma_scale(chart_events: DataFrame) -> DataFrame:
    """Coma-scale components and total per stay and time, completed from the previous six hours."""
    events = only_items(chart_events, [GCS_VERBAL, GCS_MOTOR, GCS_EYES])
    is_verbal, ett = F.col("itemid") == GCS_VERBAL, F.col("value") == INTUBATED
    base = conditional_pivot_max(events, ["subject_id", "stay_id", "charttime"], {
        "motor": (F.col("itemid") == GCS_MOTOR, F.col("valuenum").cast("double")),
        "verbal": (is_verbal, F.when(ett, F.lit(0.0)).otherwise(F.col("valuenum").cast("double"))),
        "eyes": (F.col("itemid") == GCS_EYES, F.col("valuenum").cast("double")),
        "unable": (is_verbal & ett, F.lit(1)),
    })
    base = materialised(base, "coma-scale")
    df = lookback(base, ["stay_id"], ["charttime", "subject_id"], ["motor", "verbal", "eyes"], hours=6)
    c = F.col
    return df.select(
        "subject_id", "stay_id", "charttime",
        coma_total(c("motor"), c("verbal"), c("eyes"), c("motor_prev"), c("verbal_prev"), c("eyes_prev")).alias("gcs"),
        F.coalesce("motor", "motor_prev").alias("gcs_motor"),
        F.coalesce("verbal", "verbal_prev").alias("gcs_verbal"),
        F.coalesce("eyes", "eyes_prev").alias("gcs_eyes"),
        F.coalesce("unable", F.lit(0)).alias("gcs_unable"),
    )


def gcs(chart_events: DataFrame, icu_stays: DataFrame) -> DataFrame:
    wide = coma_scale(chart_events).join(icu_stays.select("hadm_id", "stay_id").distinct(), "stay_id", "left")
    long = melt_keep_nulls(
        wide, ["hadm_id", "charttime"], list(GCS_CATEGORIES), "assessment_name", "numerical_value"
    ).filter(F.col("hadm_id").isNotNull())
    return long.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), F.col("charttime").alias("recorded_dttm"),
        "assessment_name", case_map("assessment_name", GCS_CATEGORIES).alias("assessment_category"), "numerical_value",
    )


def charted(tables: dict[str, DataFrame], dictionary: DataFrame) -> DataFrame:
    """Events of all instruments but the coma scale, fetched once and written: every instrument reads this narrow table."""
    items = [RASS_ITEM, *BRADEN_ITEMS, *CAM_ITEMS, *SBT_CATEGORIES]
    events = fetch_events(tables, dictionary, items, extra=["storetime"])
    label = F.when(F.col("itemid") == CAM_MENTAL_ITEM, CAM_MENTAL_LABEL).otherwise(F.col("label"))
    return materialised(
        events.select("hadm_id", "time", "itemid", label.alias("label"), "value", "storetime"), "assessments"
    )


def sedation(events: DataFrame) -> DataFrame:
    scored = events.filter(F.col("itemid") == RASS_ITEM).select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), F.col("time").alias("recorded_dttm"),
        F.lit(RASS_NAME).alias("assessment_name"), F.lit(RASS_CATEGORY).alias("assessment_category"),
        prefix_number("value").alias("numerical_value"), F.col("value").alias("text_value"), "storetime",
    )
    keys = ["hospitalization_id", "recorded_dttm", "assessment_category", "numerical_value"]
    return dedup_keys(scored, keys, ["storetime", "text_value"]).drop("storetime")


def _entry(name: Column | str, category: str, number: Column, words: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        name.alias("assessment_name"), F.lit(category).alias("assessment_category"),
        number.cast("double").alias("numerical_value"), words.cast("string").alias("categorical_value"),
    )


def sheets(events: DataFrame, source: str = "SOURCE") -> DataFrame:
    """Skin-risk sub-scores with the charted words, delirium answers, and both totals: one pivot and one fan-out for all cells."""
    cells = {**BRADEN_LABELS, **{label: label for label in CAM_LABELS}}
    kept = events.filter(F.col("itemid").isin([*BRADEN_ITEMS, *CAM_ITEMS]))
    wide = pivot_first(kept, ["hadm_id", "time"], "label", "value", cells, ["storetime", "value"])
    cell = {label: F.col(f"`{label}`") for label in CAM_LABELS}
    wide = wide.withColumns({f"{c}_score": text_to_ordinal(c, w) for c, w in BRADEN_WORDS.items()}).withColumns({
        "braden_total": strict_sum(*[f"{c}_score" for c in BRADEN_WORDS]),
        "cam_total": three_valued_delirium(
            cell["CAM-ICU MS Change"], cell["CAM-ICU Inattention"], cell["CAM-ICU Disorganized thinking"],
            F.coalesce(cell["CAM-ICU Altered LOC"], cell["CAM-ICU RASS LOC"]),
        ),
    })
    nothing, computed = F.lit(None), COMPUTED.format(source=source)
    entries = [
        *[_entry(label, c, F.col(f"{c}_score"), F.col(c)) for label, c in BRADEN_LABELS.items()],
        _entry(computed, "braden_total", F.col("braden_total"), nothing),
        *[_entry(label, category, nothing, cell[label]) for label, category in CAM_LABELS.items()],
        _entry(computed, "cam_total", nothing, F.col("cam_total")),
    ]
    present = F.filter(F.array(*entries), lambda e: e["numerical_value"].isNotNull() | e["categorical_value"].isNotNull())
    return wide.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), F.col("time").alias("recorded_dttm"), F.inline(present)
    )


def breathing_trials(events: DataFrame) -> DataFrame:
    category, value = F.col("assessment_category"), F.col("value")
    trials = events.filter(F.col("itemid").isin(list(SBT_CATEGORIES)))
    return trials.withColumn("assessment_category", case_map("itemid", SBT_CATEGORIES)).select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), F.col("time").alias("recorded_dttm"),
        F.col("label").alias("assessment_name"), "assessment_category",
        F.when(category == "sbt_delivery_pass_fail", case_map("value", SBT_RESULTS)).alias("categorical_value"),
        F.when(category == "sbt_fail_reason", value).alias("text_value"),
    )


def patient_assessments(
    tables: dict[str, DataFrame], dictionary: DataFrame, icu_stays: DataFrame, groups: DataFrame, zone: Zone = Zone(),
    source: str = "SOURCE",
) -> DataFrame:
    """``groups`` maps assessment_category to assessment_group; ``source`` names the source system.

    Chart events are read twice: for the coma scale, by stay, and for all other instruments.
    """
    events = charted(tables, dictionary)
    df = concat_align(
        gcs(tables["chartevents"], icu_stays), sedation(events), sheets(events, source), breathing_trials(events)
    )
    lookup = value_map(groups, "assessment_category", "assessment_group", decision=None)
    df = dict_map(df, lookup, "assessment_category", "assessment_group")
    return df.withColumns({
        "recorded_dttm": zone.to_utc("recorded_dttm"), "numerical_value": F.col("numerical_value").cast("float"),
    }).select(*COLUMNS)


def raw_gcs(tables: dict[str, DataFrame], dictionary: DataFrame, zone: Zone = Zone()) -> DataFrame:
    """Coma-scale components as charted; an intubated verbal score is missing, not zero."""
    events = fetch_events(tables, dictionary, list(RAW_GCS_CATEGORIES))
    return events.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"), zone.to_utc("time").alias("recorded_dttm"),
        F.col("label").alias("assessment_name"),
        case_map("itemid", RAW_GCS_CATEGORIES).alias("assessment_category"),
        F.lit(RAW_GCS_GROUP).alias("assessment_group"),
        F.when(~F.col("value").eqNullSafe(INTUBATED), F.col("valuenum").cast("float")).alias("numerical_value"),
        F.col("value").alias("categorical_value"), F.lit(None).cast("string").alias("text_value"),
    )


def raw_gcs_with_total(raw: DataFrame, source: str = "SOURCE") -> DataFrame:
    """The raw components plus a total wherever all three are present at one time."""
    keys = ["hospitalization_id", "recorded_dttm"]
    parts = list(RAW_GCS_CATEGORIES.values())
    wide = pivot_max(raw, keys, "assessment_category", "numerical_value", parts)
    empty = F.lit(None).cast("string")
    total = wide.withColumn("total", strict_sum(*parts)).filter(F.col("total").isNotNull()).select(
        *keys, F.lit(COMPUTED.format(source=source)).alias("assessment_name"), F.lit("gcs_total").alias("assessment_category"),
        F.lit(RAW_GCS_GROUP).alias("assessment_group"), F.col("total").alias("numerical_value"),
        empty.alias("categorical_value"), empty.alias("text_value"),
    )
    return union_all(total, raw.select(*total.columns))
