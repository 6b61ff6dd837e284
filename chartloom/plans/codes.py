"""Diagnosis and procedure code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import case_map, classify_code
from chartloom.functions.time import Zone
from chartloom.operators.sets import union_all

# ---- fixed values ----
DIAGNOSIS_FORMATS = {"10": "ICD10CM", "9": "ICD9CM"}
PROCEDURE_FORMATS = {"10": "ICD10PCS", "9": "ICD9"}
# ---- end of fixed values ----


def hospital_diagnosis(diagnoses: DataFrame) -> DataFrame:
    seq = F.col("seq_num")
    return diagnoses.select(
        F.col("hadm_id").cast("string").alias("hospitalization_id"),
        F.col("icd_code").cast("string").alias("diagnosis_code"),
        case_map(F.col("icd_version").cast("string"), DIAGNOSIS_FORMATS).alias("diagnosis_code_format"),
        F.when(seq == 1, 1).when(seq > 1, 0).alias("diagnosis_primary"),
        F.lit(None).cast("int").alias("poa_present"),
    )


def patient_procedures(icd: DataFrame, hcpcs: DataFrame, zone: Zone = Zone()) -> DataFrame:
    def shape(df: DataFrame, code: str, fmt) -> DataFrame:
        return df.select(
            F.col("hadm_id").cast("string").alias("hospitalization_id"),
            F.lit(None).cast("string").alias("billing_provider_id"),
            F.lit(None).cast("string").alias("performing_provider_id"),
            F.col(code).cast("string").alias("procedure_code"),
            fmt.alias("procedure_code_format"),
            zone.to_utc("chartdate").alias("procedure_billed_dttm"),
        )

    # the version may be stored as a number or as text
    icd_format = case_map(F.col("icd_version").cast("string"), PROCEDURE_FORMATS)
    return union_all(
        shape(icd, "icd_code", icd_format),
        shape(hcpcs, "hcpcs_cd", classify_code(F.col("hcpcs_cd").cast("string"))),
    )
