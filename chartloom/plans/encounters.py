"""Patient, hospitalization, location and code-status tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import case_map
from chartloom.functions.time import Zone, age_at_event
from chartloom.operators.events import drop_null_and_sentinel, fetch_events, rename_reorder
from chartloom.operators.joins import dict_map, dict_map_default, value_map
from chartloom.operators.profiling import first_value_per_group, most_frequent
from chartloom.operators.windows import earliest_of

# ---- fixed values ----
SEX = {"M": "Male", "F": "Female"}
UNINFORMATIVE = ["Other", "Unknown"]
LANGUAGES = {
    "English": "English",
    "Spanish": "Spanish",
    "Russian": "Russian",
    "Chinese": "Chinese",
    "Kabuverdianu": "Portuguese",
    "Portuguese": "Portuguese",
    "Haitian": "Haitian Creole",
    "Other": "Other and unspecified languages",
    "Vietnamese": "Vietnamese",
    "Italian": "Italian",
    "Modern Greek (1453-)": "Greek",
    "Arabic": "Arabic",
    "American Sign Language": "Sign Language",
    "Persian": "Persian",
    "Polish": "Polish",
    "Korean": "Korean",
    "Thai": "Thai, Lao, or other Tai-Kadai languages",
    "Khmer": "Khmer",
    "Amharic": "Amharic, Somali, or other Afro-Asiatic languages",
    "Hindi": "Hindi",
    "French": "French",
    "Somali": "Amharic, Somali, or other Afro-Asiatic languages",
    "Japanese": "Japanese",
    "Bengali": "Bengali",
    "Armenian": "Armenian",
}
NO_LANGUAGE = "Unknown or NA"
PATIENT_DEFAULTS = {
    "race_category": "Unknown",
    "ethnicity_category": "Unknown",
    "sex_category": "Unknown",
    "language_category": NO_LANGUAGE,
}
PATIENT_COLUMNS = [
    "patient_id", "race_name", "race_category", "ethnicity_name", "ethnicity_category", "sex_name", "sex_category",
    "birth_date", "death_dttm", "language_name", "language_category",
]
ADMISSION_TYPES = {
    "DIRECT EMER.": "ed",
    "OBSERVATION ADMIT": "ed",
    "URGENT": "ed",
    "EW EMER.": "ed",
    "EU OBSERVATION": "ed",
    "DIRECT OBSERVATION": "direct",
    "ELECTIVE": "elective",
    "AMBULATORY OBSERVATION": "direct",
    "SURGICAL SAME DAY ADMISSION": "elective",
}
NO_ADMISSION_TYPE = "other"
NO_DISCHARGE = "Missing"
HOSPITALIZATION_RENAMES = {
    "admittime": "admission_dttm",
    "dischtime": "discharge_dttm",
    "admission_type": "admission_type_name",
    "discharge_location": "discharge_name",
}
HOSPITALIZATION_COLUMNS = [
    "patient_id", "hospitalization_id", "hospitalization_joined_id", "admission_dttm", "discharge_dttm",
    "age_at_admission", "admission_type_name", "admission_type_category", "discharge_name", "discharge_category",
    "zipcode_nine_digit", "zipcode_five_digit", "census_block_code", "census_block_group_code", "census_tract",
    "state_code", "county_code",
]
ADT_RENAMES = {"intime": "in_dttm", "outtime": "out_dttm", "careunit": "location_name"}
ADT_COLUMNS = [
    "patient_id", "hospitalization_id", "hospital_id", "in_dttm", "out_dttm", "location_name", "location_category",
    "location_type",
]
HOSPITAL_TYPE = "academic"
CODE_STATUS_ITEM = 223758
CODE_STATUS = {
    "Full code": "Full",
    "DNR / DNI": "DNR/DNI",
    "DNI (do not intubate)": "DNI_only",
    "DNR (do not resuscitate)": "DNR",
    "Comfort measures only": "AND",
}
# ---- end of fixed values ----


def race_ethnicity(admissions: DataFrame, mapping: DataFrame, key: str = "source_race") -> DataFrame:
    """One race / ethnicity per patient: most frequent, then informative, then most recent."""
    df = admissions.select(
        F.col("subject_id").alias("patient_id"), F.col("race").alias("race_name"),
        F.col("race").alias("ethnicity_name"), "admittime",
    )
    df = dict_map_default(df, value_map(mapping, key, "race"), "race_name", "race_category", "Unknown")
    df = dict_map_default(df, value_map(mapping, key, "ethnicity"), "ethnicity_name", "ethnicity_category", "Unknown")
    uninformative = F.col("race_category").isin(UNINFORMATIVE) & F.col("ethnicity_category").isin(UNINFORMATIVE)
    attributes = ["race_name", "race_category", "ethnicity_name", "ethnicity_category"]
    return most_frequent(df, "patient_id", attributes, "admittime", uninformative)


def patient(
    patients: DataFrame, admissions: DataFrame, race_mapping: DataFrame, zone: Zone = Zone(),
    race_key: str = "source_race",
) -> DataFrame:
    race = race_ethnicity(admissions, race_mapping, race_key)
    sex = patients.select(
        F.col("subject_id").alias("patient_id"), F.col("gender").alias("sex_name"),
        case_map("gender", SEX).alias("sex_category"),
    )
    death = earliest_of(admissions, patients, "subject_id", "deathtime", "dod", "death_dttm")
    death = death.withColumnRenamed("subject_id", "patient_id")
    language = first_value_per_group(admissions, "subject_id", "language", ["hadm_id"]).select(
        F.col("subject_id").alias("patient_id"), F.col("language").alias("language_name"),
        F.when(F.col("language").isNull(), NO_LANGUAGE).otherwise(case_map("language", LANGUAGES)).alias(
            "language_category"
        ),
    )
    # one row per patient in each frame and no column in common: stacked and folded in one shuffle
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [race, sex, death, language])
    columns = [c for c in stacked.columns if c != "patient_id"]
    merged = stacked.filter("patient_id IS NOT NULL").groupBy("patient_id").agg(*[F.max(c).alias(c) for c in columns])
    merged = merged.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in PATIENT_DEFAULTS.items()})
    return merged.select(
        F.col("patient_id").cast("string").alias("patient_id"), "race_name", "race_category", "ethnicity_name",
        "ethnicity_category", "sex_name", "sex_category", F.lit(None).cast("date").alias("birth_date"),
        zone.to_utc("death_dttm").alias("death_dttm"), "language_name", "language_category",
    )


def hospitalization(
    admissions: DataFrame, patients: DataFrame, discharge_mapping: DataFrame, zone: Zone = Zone()
) -> DataFrame:
    anchors = patients.select("subject_id", "anchor_age", "anchor_year")
    df = admissions.join(anchors, "subject_id", "left")
    df = df.withColumn("age_at_admission", age_at_event("anchor_age", "anchor_year", "admittime").cast("bigint"))
    lookup = value_map(discharge_mapping, "discharge_location", "disposition_category")
    df = dict_map_default(df, lookup, "discharge_location", "discharge_category", NO_DISCHARGE)
    df = df.withColumn(
        "admission_type_category",
        F.when(F.col("admission_type").isNull(), NO_ADMISSION_TYPE).otherwise(case_map("admission_type", ADMISSION_TYPES)),
    )
    out = rename_reorder(df, HOSPITALIZATION_RENAMES, HOSPITALIZATION_COLUMNS)
    return out.select(*[
        zone.to_utc(c).alias(c) if c.endswith("dttm")
        else F.col(c) if c == "age_at_admission"
        else F.col(c).cast("string").alias(c)
        for c in out.columns
    ])


def adt(transfers: DataFrame, mapping: DataFrame, hospital_id: str, zone: Zone = Zone()) -> DataFrame:
    df = drop_null_and_sentinel(transfers, "hadm_id", "careunit", "UNKNOWN")
    df = dict_map(df, value_map(mapping, "careunit", "location_category"), "careunit", "location_category")
    df = dict_map(df, value_map(mapping, "careunit", "location_type"), "careunit", "location_type")
    df = rename_reorder(df, ADT_RENAMES, ADT_COLUMNS)
    return df.select(
        F.col("patient_id").cast("string").alias("patient_id"),
        F.col("hospitalization_id").cast("bigint").cast("string").alias("hospitalization_id"),
        F.lit(hospital_id).alias("hospital_id"), zone.to_utc("in_dttm").alias("in_dttm"),
        zone.to_utc("out_dttm").alias("out_dttm"), "location_name", "location_category", "location_type",
        F.lit(HOSPITAL_TYPE).alias("hospital_type"),
    )


def code_status(
    tables: dict[str, DataFrame], dictionary: DataFrame, admissions: DataFrame, zone: Zone = Zone(),
    item: int = CODE_STATUS_ITEM,
) -> DataFrame:
    events = fetch_events(tables, dictionary, [item])
    df = events.join(admissions.select("hadm_id", "subject_id"), "hadm_id", "left")
    return df.select(
        F.col("subject_id").cast("string").alias("patient_id"), zone.to_utc("time").alias("start_dttm"),
        F.col("value").cast("string").alias("code_status_name"),
        case_map(F.col("value").cast("string"), CODE_STATUS).alias("code_status_category"),
    )
