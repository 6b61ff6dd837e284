"""Declared schema and constraints of every output table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chartloom.operators.events import vocabulary_values
from chartloom.operators.quality import TableRules

S, D, F32, I, B, TS, DATE, L = (
    T.StringType(), T.DoubleType(), T.FloatType(), T.IntegerType(), T.BooleanType(), T.TimestampType(), T.DateType(),
    T.LongType(),
)


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols.items()])


# ---- fixed values: schemas and permitted values ----
GEOGRAPHY = [
    "zipcode_nine_digit", "zipcode_five_digit", "census_block_code", "census_block_group_code", "census_tract",
    "state_code", "county_code",
]
DEVICES = ["IMV", "NIPPV", "CPAP", "High Flow NC", "Face Mask", "Trach Collar", "Nasal Cannula", "Other"]
MODES = [
    "Assist Control-Volume Control", "Pressure Control", "Pressure-Regulated Volume Control", "SIMV",
    "Pressure Support/CPAP", "Volume Support", "Other", "Blow by",
]
ADMISSION_TYPES = ["ed", "direct", "elective", "other", "facility", "osh"]
DISCHARGES = [
    "Home", "Skilled Nursing Facility (SNF)", "Expired", "Acute Inpatient Rehab Facility", "Hospice",
    "Long Term Care Hospital (LTACH)", "Acute Care Hospital", "Group Home", "Chemical Dependency",
    "Against Medical Advice (AMA)", "Assisted Living", "Still Admitted", "Missing", "Other", "Psychiatric Hospital",
    "Shelter", "Jail",
]
CODE_STATUSES = ["DNR", "DNAR", "UDNR", "DNR/DNI", "DNAR/DNI", "AND", "Full", "Presume Full", "Other", "DNI_only"]
CRRT_MODES = ["scuf", "cvvh", "cvvhd", "cvvhdf", "avvh"]
CONTINUOUS_ACTIONS = ["dose_change", "start", "stop", "going", "other"]
INTERMITTENT_ACTIONS = ["given", "other"]
CONTINUOUS_ROUTES = ["im", "iv", "inhaled"]
INTERMITTENT_ROUTES = ["im", "iv", "enteral", "buccal_sublingual", "intrapleural"]

_MEDICATION = _schema(
    hospitalization_id=S, med_order_id=S, admin_dttm=TS, med_name=S, med_category=S, mar_action_name=S,
    mar_action_category=S, med_dose=F32, med_dose_unit=S, med_route_name=S, med_route_category=S, med_group=S,
)
_ASSESSMENT = TableRules(
    schema=_schema(
        hospitalization_id=S, recorded_dttm=TS, assessment_name=S, assessment_category=S, assessment_group=S,
        numerical_value=F32, categorical_value=S, text_value=S,
    ),
    strict=False,
    required=["hospitalization_id", "recorded_dttm", "assessment_name", "assessment_category", "assessment_group"],
)
_RESPIRATORY_NUMBERS = [
    "fio2_set", "lpm_set", "tidal_volume_set", "resp_rate_set", "pressure_control_set", "pressure_support_set",
    "flow_rate_set", "peak_inspiratory_pressure_set", "inspiratory_time_set", "peep_set", "tidal_volume_obs",
    "resp_rate_obs", "plateau_pressure_obs", "peak_inspiratory_pressure_obs", "peep_obs", "minute_vent_obs",
    "mean_airway_pressure_obs",
]

RULES: dict[str, TableRules] = {
    "patient": TableRules(
        schema=_schema(
            patient_id=S, race_name=S, race_category=S, ethnicity_name=S, ethnicity_category=S, sex_name=S,
            sex_category=S, birth_date=DATE, death_dttm=TS, language_name=S, language_category=S,
        ),
        strict=False,
        required=["patient_id", "race_category", "ethnicity_category", "language_category"],
    ),
    "hospitalization": TableRules(
        schema=_schema(
            patient_id=S, hospitalization_id=S, hospitalization_joined_id=S, admission_dttm=TS, discharge_dttm=TS,
            age_at_admission=L, admission_type_name=S, admission_type_category=S, discharge_name=S,
            discharge_category=S, **{c: S for c in GEOGRAPHY},
        ),
        required=[
            "patient_id", "hospitalization_id", "admission_dttm", "discharge_dttm", "age_at_admission",
            "admission_type_category", "discharge_category",
        ],
        isin={"admission_type_category": ADMISSION_TYPES, "discharge_category": DISCHARGES},
        all_null=GEOGRAPHY,
    ),
    "labs": TableRules(
        schema=_schema(
            hospitalization_id=S, lab_order_dttm=TS, lab_collect_dttm=TS, lab_result_dttm=TS, lab_order_name=S,
            lab_order_category=S, lab_name=S, lab_category=S, lab_value=S, lab_value_numeric=D, reference_unit=S,
            lab_specimen_name=S, lab_specimen_category=S, lab_loinc_code=S,
        ),
        required=[
            "hospitalization_id", "lab_order_dttm", "lab_collect_dttm", "lab_result_dttm", "lab_order_category",
            "lab_name", "lab_category",
        ],
        all_null=["lab_order_name", "lab_specimen_name", "lab_specimen_category", "lab_loinc_code"],
    ),
    "patient_assessments": _ASSESSMENT,
    "patient_assessments_raw_gcs": _ASSESSMENT,
    "respiratory_support": TableRules(
        schema=_schema(
            hospitalization_id=S, recorded_dttm=TS, device_name=S, device_category=S, vent_brand_name=S, mode_name=S,
            mode_category=S, tracheostomy=B, **{c: D for c in _RESPIRATORY_NUMBERS},
        ),
        required=["hospitalization_id", "recorded_dttm", "tracheostomy"],
        isin={"device_category": DEVICES},
        ranges={"fio2_set": (0.2, 1.0)},
        values_eq={"mode_category": MODES},
    ),
    "medication_admin_continuous": TableRules(
        schema=_MEDICATION, required=_MEDICATION.names,
        isin={"mar_action_category": CONTINUOUS_ACTIONS, "med_route_category": CONTINUOUS_ROUTES},
    ),
    "medication_admin_intermittent": TableRules(
        schema=_MEDICATION, required=_MEDICATION.names,
        isin={"mar_action_category": INTERMITTENT_ACTIONS, "med_route_category": INTERMITTENT_ROUTES},
    ),
    "crrt_therapy": TableRules(
        schema=_schema(
            hospitalization_id=S, device_id=S, recorded_dttm=TS, crrt_mode_name=S, crrt_mode_category=S,
            dialysis_machine_name=S, blood_flow_rate=F32, pre_filter_replacement_fluid_rate=F32,
            post_filter_replacement_fluid_rate=F32, dialysate_flow_rate=F32, ultrafiltration_out=F32,
        ),
        required=["hospitalization_id", "recorded_dttm"],
        isin={"crrt_mode_category": CRRT_MODES},
        all_null=["device_id", "dialysis_machine_name"],
    ),
    "ecmo_mcs": TableRules(
        schema=_schema(
            hospitalization_id=S, recorded_dttm=TS, _device_context=S, device_name=S, device_category=S, mcs_group=S,
            ecmo_configuration_category=S, control_parameter_name=S, control_parameter_category=S,
            control_parameter_value=F32, flow=F32, sweep_set=F32, fdo2_set=F32,
        ),
        required=["hospitalization_id", "recorded_dttm"],
    ),
    "code_status": TableRules(
        schema=_schema(patient_id=S, start_dttm=TS, code_status_name=S, code_status_category=S),
        required=["patient_id", "start_dttm", "code_status_name", "code_status_category"],
        isin={"code_status_category": CODE_STATUSES},
    ),
    "hospital_diagnosis": TableRules(
        schema=_schema(
            hospitalization_id=S, diagnosis_code=S, diagnosis_code_format=S, diagnosis_primary=I, poa_present=I
        ),
        required=["hospitalization_id", "diagnosis_code", "diagnosis_code_format", "diagnosis_primary"],
        isin={"diagnosis_code_format": ["ICD10CM", "ICD9CM"], "diagnosis_primary": [0, 1]},
        all_null=["poa_present"],
    ),
    "patient_procedures": TableRules(
        schema=_schema(
            hospitalization_id=S, billing_provider_id=S, performing_provider_id=S, procedure_code=S,
            procedure_code_format=S, procedure_billed_dttm=TS,
        ),
        required=["hospitalization_id", "procedure_code", "procedure_code_format", "procedure_billed_dttm"],
        isin={"procedure_code_format": ["CPT", "ICD10PCS", "HCPCS", "ICD9"]},
        all_null=["billing_provider_id", "performing_provider_id"],
    ),
    "input": TableRules(
        schema=_schema(
            hospitalization_id=S, recorded_dttm=TS, input_name=S, input_category=S, input_group=S, input_volume=F32
        ),
        required=[
            "hospitalization_id", "recorded_dttm", "input_name", "input_category", "input_group", "input_volume"
        ],
    ),
    "output": TableRules(
        schema=_schema(
            hospitalization_id=S, recorded_dttm=TS, output_name=S, output_category=S, output_group=S, output_volume=F32
        ),
        required=[
            "hospitalization_id", "recorded_dttm", "output_name", "output_category", "output_group", "output_volume"
        ],
    ),
}
# ---- end of fixed values ----


#: Columns whose permitted values come from a vocabulary: table -> column -> (vocabulary, its column).
VOCABULARY_RULES = {
    "labs": {"lab_category": ("labs", "lab_category")},
    "input": {"input_category": ("input", "input_category"), "input_group": ("input", "input_group")},
    "output": {"output_category": ("output", "output_category"), "output_group": ("output", "output_group")},
    "vitals": {"vital_category": ("vitals", "vital_category")},
    "medication_admin_continuous": {"med_category": ("med_category", "med_category"), "med_group": ("continuous_med_groups", "med_group")},
    "medication_admin_intermittent": {"med_category": ("med_category", "med_category"), "med_group": ("intermittent_med_groups", "med_group")},
}


def rules_for(table: str, vocabularies: Mapping[str, DataFrame]) -> TableRules | None:
    """A table's rules, with permitted values read from the curated vocabularies that are given."""
    base = RULES.get(table)
    if base is None:
        return None
    read = {
        column: vocabulary_values(vocabularies[name], source)
        for column, (name, source) in VOCABULARY_RULES.get(table, {}).items()
        if name in vocabularies and source in vocabularies[name].columns
    }
    return TableRules(base.schema, base.strict, base.required, {**base.isin, **read}, base.ranges, base.all_null, base.values_eq)
