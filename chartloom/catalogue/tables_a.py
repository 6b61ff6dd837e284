"""Table plans over benchmark tables shaped like source tables: encounters, codes, fluids, measurements."""

from __future__ import annotations

from chartloom.catalogue.base import Tables, Vocabulary, query, with_ctes
from chartloom.catalogue.scalars import CODES, utc_sql
from chartloom.plans import codes, encounters, fluids, measurements

K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
# wall-clock times in March, across the spring clock change
AT = "ts + INTERVAL '60' DAY"


def map_sql(vocabulary: Vocabulary, key: str, value: str, where: str = "TRUE") -> str:
    """One row per key, the last one wins."""
    return f"""SELECT {key} AS k, {value} AS v FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _ordinal DESC) AS r
    FROM ({vocabulary.sql}) m WHERE {where} AND {key} IS NOT NULL) WHERE r = 1"""


# ---- fluids -------------------------------------------------------------------------------

FLUID_EVENTS = f"""
SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS hadm_id, {AT} AS charttime,
  CASE event_type WHEN 'view' THEN 226559 WHEN 'click' THEN 226560 WHEN 'purchase' THEN 227488 WHEN 'signup' THEN 226561 ELSE 226999 END AS itemid,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events"""
OUTPUT_ITEMS = Vocabulary(
    "itemid int, label string, output_category string, output_group string, decision string",
    [
        (226559, "Catheter", "indwelling_urinary_catheter", "urine", "TO MAP"),
        (226560, "Void", "urethral", "urine", "TO MAP"),
        (226561, "External", "external_urinary_catheter", "urine", "TO MAP"),
        (226999, "Other", "other", "other", "UNSURE"),
    ],
)
INPUT_ITEMS = Vocabulary(
    "itemid int, label string, input_category string, input_group string, decision string",
    [(227488, "Irrigant In", "flush_irrigation_urine", "flush_irrigation", "TO MAP")],
)


def fluid_sql(kind: str, items: Vocabulary) -> str:
    return with_ctes(
        f"""SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, {utc_sql('charttime')} AS recorded_dttm, label AS {kind}_name,
        {kind}_category, {kind}_group, CAST(CAST(value AS FLOAT) AS DOUBLE) AS {kind}_volume
        FROM e JOIN m USING (itemid) WHERE decision = 'TO MAP' AND hadm_id IS NOT NULL AND value IS NOT NULL""",
        e=FLUID_EVENTS, m=items.sql,
    )


@query("plan_output", fluid_sql("output", OUTPUT_ITEMS))
def plan_output(t: Tables):
    return fluids.fluid_events(t.derive(FLUID_EVENTS), OUTPUT_ITEMS.df(t), "output")


@query("plan_input", fluid_sql("input", INPUT_ITEMS))
def plan_input(t: Tables):
    return fluids.fluid_events(t.derive(FLUID_EVENTS), INPUT_ITEMS.df(t), "input")


CHARTED = f"""
SELECT CASE event_type WHEN 'view' THEN 224093 WHEN 'click' THEN 223758 WHEN 'purchase' THEN 224093 WHEN 'signup' THEN 223758 ELSE 1 END AS itemid,
  user_id * 15 AS hadm_id, user_id AS stay_id, {AT} AS charttime, {AT} AS storetime, value AS valuenum, 'u' AS valueuom,
  CASE event_type WHEN 'view' THEN 'Prone' WHEN 'click' THEN CASE event_id % 5 WHEN 0 THEN 'Full code' WHEN 1 THEN 'DNR / DNI'
    WHEN 2 THEN 'DNI (do not intubate)' WHEN 3 THEN 'Comfort measures only' ELSE 'unheard of' END
    WHEN 'purchase' THEN 'Left Side' WHEN 'signup' THEN 'DNR (do not resuscitate)' END AS value FROM events"""
CHART_ITEMS = Vocabulary(
    "itemid int, label string, linksto string",
    [(224093, "Position", "chartevents"), (223758, "Code Status", "chartevents"), (1, "Other", "chartevents")],
)
ADMITTED = "SELECT c_custkey AS hadm_id, c_custkey % 100 AS subject_id FROM customer"


@query(
    "plan_position",
    with_ctes(
        f"""SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, {utc_sql('charttime')} AS recorded_dttm, value AS position_name,
        CASE WHEN value = 'Prone' THEN 'prone' ELSE 'not_prone' END AS position_category FROM c WHERE itemid = 224093""",
        c=CHARTED,
    ),
)
def plan_position(t: Tables):
    return fluids.position({"chartevents": t.derive(CHARTED)}, CHART_ITEMS.df(t))


@query(
    "plan_code_status",
    with_ctes(
        f"""SELECT CAST(subject_id AS VARCHAR) AS patient_id, {utc_sql('charttime')} AS start_dttm, value AS code_status_name,
        CASE value WHEN 'Full code' THEN 'Full' WHEN 'DNR / DNI' THEN 'DNR/DNI' WHEN 'DNI (do not intubate)' THEN 'DNI_only'
        WHEN 'DNR (do not resuscitate)' THEN 'DNR' WHEN 'Comfort measures only' THEN 'AND' END AS code_status_category
        FROM c LEFT JOIN a USING (hadm_id) WHERE itemid = 223758""",
        c=CHARTED, a=ADMITTED,
    ),
)
def plan_code_status(t: Tables):
    return encounters.code_status({"chartevents": t.derive(CHARTED)}, CHART_ITEMS.df(t), t.derive(ADMITTED))


CRRT_ITEMS = Vocabulary(
    "itemid int, label string, linksto string, table string, variable string",
    [
        (226457, "Ultrafiltrate Output", "chartevents", "crrt_therapy", "ultrafiltration_out"),
        (224154, "Dialysate Rate", "chartevents", "crrt_therapy", "dialysate_flow_rate"),
        (224144, "Blood Flow", "chartevents", "crrt_therapy", "blood_flow_rate"),
        (228005, "Prefilter Rate", "chartevents", "crrt_therapy", "pre_filter_replacement_fluid_rate"),
        (227290, "Mode", "chartevents", "crrt_therapy", "crrt_mode_name"),
        (228006, "Postfilter Rate", "chartevents", None, "post_filter_replacement_fluid_rate"),
    ],
)
CRRT_EVENTS = f"""
SELECT itemid, hadm_id, hadm_id AS stay_id, charttime, charttime AS storetime, MAX(v) AS valuenum, 'u' AS valueuom,
  CASE WHEN itemid = 227290 THEN MAX(mode) ELSE CAST(MAX(v) AS STRING) END AS value
FROM (SELECT CASE event_id % 6 WHEN 0 THEN 226457 WHEN 1 THEN 224154 WHEN 2 THEN 224144 WHEN 3 THEN 228005 WHEN 4 THEN 227290 ELSE 228006 END AS itemid,
    user_id AS hadm_id, date_trunc('day', {AT}) + INTERVAL '150' MINUTE AS charttime, value AS v,
    CASE event_type WHEN 'view' THEN 'CVVH' WHEN 'click' THEN 'CVVHDF' ELSE 'SCUF' END AS mode FROM events) s
GROUP BY itemid, hadm_id, charttime"""


def _cell(item: int, cast: bool = True) -> str:
    cell = f"MAX(CASE WHEN itemid = {item} THEN value END)"
    return f"CAST(CAST({cell} AS FLOAT) AS DOUBLE)" if cast else cell


@query(
    "plan_crrt_therapy",
    with_ctes(
        f"""SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, CAST(NULL AS VARCHAR) AS device_id, {utc_sql('charttime')} AS recorded_dttm,
        {_cell(227290, False)} AS crrt_mode_name, lower({_cell(227290, False)}) AS crrt_mode_category, CAST(NULL AS VARCHAR) AS dialysis_machine_name,
        {_cell(224144)} AS blood_flow_rate, {_cell(228005)} AS pre_filter_replacement_fluid_rate, CAST(NULL AS DOUBLE) AS post_filter_replacement_fluid_rate,
        {_cell(224154)} AS dialysate_flow_rate, {_cell(226457)} AS ultrafiltration_out FROM c WHERE itemid <> 228006 GROUP BY hadm_id, charttime""",
        c=CRRT_EVENTS,
    ),
)
def plan_crrt_therapy(t: Tables):
    items = CRRT_ITEMS.df(t)
    dictionary = items.select("itemid", "label", "linksto")
    return fluids.crrt_therapy({"chartevents": t.derive(CRRT_EVENTS)}, dictionary, items)


# ---- codes --------------------------------------------------------------------------------

DIAGNOSES = """
SELECT l_orderkey AS hadm_id, 'D' || CAST(l_partkey AS STRING) AS icd_code, CASE l_returnflag WHEN 'A' THEN 9 WHEN 'R' THEN 10 END AS icd_version,
  CASE WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END AS seq_num, l_shipdate AS chartdate FROM lineitem"""


@query(
    "plan_hospital_diagnosis",
    with_ctes(
        """SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, icd_code AS diagnosis_code,
        CASE WHEN icd_version = 10 THEN 'ICD10CM' WHEN icd_version = 9 THEN 'ICD9CM' END AS diagnosis_code_format,
        CASE WHEN seq_num = 1 THEN 1 WHEN seq_num > 1 THEN 0 END AS diagnosis_primary, CAST(NULL AS INT) AS poa_present FROM d""",
        d=DIAGNOSES,
    ),
)
def plan_hospital_diagnosis(t: Tables):
    return codes.hospital_diagnosis(t.derive(DIAGNOSES))


HCPCS = f"SELECT user_id AS hadm_id, code AS hcpcs_cd, date_trunc('day', {AT}) AS chartdate FROM ({CODES}) c JOIN events USING (event_id)"


@query(
    "plan_patient_procedures",
    with_ctes(
        f"""SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, CAST(NULL AS VARCHAR) AS billing_provider_id, CAST(NULL AS VARCHAR) AS performing_provider_id,
        icd_code AS procedure_code, CASE icd_version WHEN 10 THEN 'ICD10PCS' WHEN 9 THEN 'ICD9' END AS procedure_code_format, {utc_sql('chartdate')} AS procedure_billed_dttm FROM d
        UNION ALL SELECT CAST(hadm_id AS VARCHAR), NULL, NULL, hcpcs_cd, CASE WHEN regexp_matches(hcpcs_cd, '^[0-9]{{5}}$|^[0-9]{{4}}[FT]$') THEN 'CPT'
        WHEN regexp_matches(hcpcs_cd, '^[A-V][0-9]{{4}}$') THEN 'HCPCS' END, {utc_sql('chartdate')} FROM h""",
        d=DIAGNOSES, h=HCPCS,
    ),
)
def plan_patient_procedures(t: Tables):
    return codes.patient_procedures(t.derive(DIAGNOSES), t.derive(HCPCS))


# ---- encounters ---------------------------------------------------------------------------

TRANSFERS = """
SELECT o_custkey AS subject_id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS hadm_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '5-LOW' THEN 'UNKNOWN' WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN 'Ward A' ELSE 'Step Down' END AS careunit,
  o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS intime, o_orderdate + (o_orderkey % 4000) * INTERVAL '1' MINUTE AS outtime FROM orders"""
CARE_UNITS = Vocabulary(
    "careunit string, location_category string, location_type string",
    [("Emergency", "ed", None), ("Ward A", "ward", "general"), ("Step Down", "NO MAPPING", None), ("Ward A", "icu", "medical_icu")],
)


@query(
    "plan_adt",
    with_ctes(
        f"""SELECT CAST(subject_id AS VARCHAR) AS patient_id, CAST(hadm_id AS VARCHAR) AS hospitalization_id, 'site-1' AS hospital_id,
        {utc_sql('intime')} AS in_dttm, {utc_sql('outtime')} AS out_dttm, careunit AS location_name, nullif(a.v, 'NO MAPPING') AS location_category,
        b.v AS location_type, 'academic' AS hospital_type FROM t LEFT JOIN a ON careunit = a.k LEFT JOIN b ON careunit = b.k
        WHERE hadm_id IS NOT NULL AND careunit IS DISTINCT FROM 'UNKNOWN'""",
        t=TRANSFERS, a=map_sql(CARE_UNITS, "careunit", "location_category"), b=map_sql(CARE_UNITS, "careunit", "location_type"),
    ),
)
def plan_adt(t: Tables):
    return encounters.adt(t.derive(TRANSFERS), CARE_UNITS.df(t), "site-1")


ADMISSIONS = """
SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS admittime,
  o_orderdate + (o_orderkey % 5000) * INTERVAL '1' MINUTE AS dischtime,
  CASE WHEN o_orderkey % 50 = 0 THEN o_orderdate + INTERVAL '150' MINUTE END AS deathtime,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'ELECTIVE' WHEN '3-MEDIUM' THEN 'DIRECT OBSERVATION' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'NEW TYPE' END AS admission_type,
  CASE o_orderstatus WHEN 'F' THEN 'HOME' WHEN 'O' THEN 'REHAB' END AS discharge_location,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'WHITE' WHEN '2-HIGH' THEN 'OTHER' WHEN '3-MEDIUM' THEN 'HISPANIC OR LATINO' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'NOT LISTED' END AS race,
  CASE o_orderkey % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'Somali' WHEN 2 THEN NULL ELSE 'Klingon' END AS language FROM orders"""
PATIENTS = """
SELECT c_custkey AS subject_id, CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender, c_nationkey + 20 AS anchor_age,
  1990 + c_nationkey % 5 AS anchor_year, CASE WHEN c_nationkey = 7 THEN DATE '2001-05-06' END AS dod FROM customer"""
DISCHARGES = Vocabulary(
    "discharge_location string, disposition_category string",
    [("HOME", "Home"), ("REHAB", "Acute Inpatient Rehab Facility"), (None, None)],
)
RACES = Vocabulary(
    "source_race string, race string, ethnicity string",
    [("WHITE", "White", "Non-Hispanic"), ("OTHER", "Other", "Unknown"), ("HISPANIC OR LATINO", "Other", "Hispanic")],
)
NULL_COLUMNS = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}" for c in (
        "hospitalization_joined_id", "zipcode_nine_digit", "zipcode_five_digit", "census_block_code",
        "census_block_group_code", "census_tract", "state_code", "county_code",
    )
)


@query(
    "plan_hospitalization",
    with_ctes(
        f"""SELECT CAST(subject_id AS VARCHAR) AS patient_id, CAST(hadm_id AS VARCHAR) AS hospitalization_id, {NULL_COLUMNS},
        {utc_sql('admittime')} AS admission_dttm, {utc_sql('dischtime')} AS discharge_dttm,
        CAST(anchor_age + date_diff('year', make_date(anchor_year, 1, 1), CAST(admittime AS DATE)) AS BIGINT) AS age_at_admission,
        admission_type AS admission_type_name, CASE WHEN admission_type IS NULL THEN 'other' WHEN admission_type = 'URGENT' THEN 'ed'
        WHEN admission_type = 'ELECTIVE' THEN 'elective' WHEN admission_type = 'DIRECT OBSERVATION' THEN 'direct' END AS admission_type_category,
        discharge_location AS discharge_name, CASE WHEN discharge_location IS NULL THEN 'Missing' ELSE d.v END AS discharge_category
        FROM a LEFT JOIN p USING (subject_id) LEFT JOIN d ON discharge_location = d.k""",
        a=ADMISSIONS, p=PATIENTS, d=map_sql(DISCHARGES, "discharge_location", "disposition_category"),
    ),
)
def plan_hospitalization(t: Tables):
    return encounters.hospitalization(t.derive(ADMISSIONS), t.derive(PATIENTS), DISCHARGES.df(t))


@query(
    "plan_patient",
    with_ctes(
        f"""SELECT CAST(subject_id AS VARCHAR) AS patient_id, race AS race_name, COALESCE(race_category, 'Unknown') AS race_category, race AS ethnicity_name,
        COALESCE(ethnicity_category, 'Unknown') AS ethnicity_category, gender AS sex_name,
        CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Unknown' END AS sex_category, CAST(NULL AS DATE) AS birth_date,
        {utc_sql('death')} AS death_dttm, language AS language_name,
        CASE language WHEN 'English' THEN 'English' WHEN 'Somali' THEN 'Amharic, Somali, or other Afro-Asiatic languages' ELSE 'Unknown or NA' END AS language_category
        FROM best FULL JOIN p USING (subject_id) FULL JOIN dead USING (subject_id) FULL JOIN lang USING (subject_id)""",
        a=ADMISSIONS, p=PATIENTS, r=RACES.sql,
        coded="""SELECT subject_id, admittime, a.race, CASE WHEN a.race IS NULL THEN 'Unknown' ELSE r.race END AS race_category,
          CASE WHEN a.race IS NULL THEN 'Unknown' ELSE r.ethnicity END AS ethnicity_category FROM a LEFT JOIN r ON a.race = r.source_race""",
        ranked="""SELECT subject_id, race, race_category, ethnicity_category, row_number() OVER (PARTITION BY subject_id ORDER BY COUNT(*) DESC,
          CASE WHEN race_category IN ('Other', 'Unknown') AND ethnicity_category IN ('Other', 'Unknown') THEN 1 ELSE 0 END, MAX(admittime) DESC, race NULLS FIRST) AS rn
          FROM coded GROUP BY subject_id, race, race_category, ethnicity_category""",
        best="SELECT * FROM ranked WHERE rn = 1",
        dead="""SELECT subject_id, MIN(COALESCE(deathtime, CAST(dod AS TIMESTAMP))) AS death FROM (SELECT subject_id, deathtime FROM a WHERE deathtime IS NOT NULL)
          FULL JOIN p USING (subject_id) GROUP BY subject_id HAVING death IS NOT NULL""",
        lang="SELECT subject_id, (ARRAY_AGG(language ORDER BY hadm_id))[1] AS language FROM a GROUP BY subject_id",
    ),
)
def plan_patient(t: Tables):
    return encounters.patient(t.derive(PATIENTS), t.derive(ADMISSIONS), RACES.df(t))


# ---- measurements -------------------------------------------------------------------------

VITAL_EVENTS = f"""
SELECT CASE event_id % 6 WHEN 0 THEN 220179 WHEN 1 THEN 220050 WHEN 2 THEN 220045 WHEN 3 THEN 226531 WHEN 4 THEN 220001 ELSE 220045 END AS itemid,
  user_id AS hadm_id, user_id AS stay_id, date_trunc('day', {AT}) + INTERVAL '150' MINUTE AS charttime, {AT} AS storetime,
  CAST(100 + {K} % 5 AS STRING) AS value, CAST(100 + {K} % 5 AS DOUBLE) AS valuenum, 'u' AS valueuom FROM events
UNION ALL
SELECT 223761, user_id, user_id, date_trunc('hour', {AT}), MAX({AT}), CAST(CAST(900 + 2 * MIN({K}) AS DOUBLE) / 10 AS STRING), 1, 'F' FROM events
  WHERE event_type IN ('view', 'click') GROUP BY user_id, date_trunc('hour', {AT})
UNION ALL
SELECT 223762, user_id, user_id, date_trunc('hour', {AT}), MAX({AT}), CAST(CAST(350 + MIN({K}) AS DOUBLE) / 10 AS STRING), 1, 'C' FROM events
  WHERE event_type IN ('purchase') GROUP BY user_id, date_trunc('hour', {AT})
UNION ALL
SELECT 224642, user_id, user_id, date_trunc('hour', {AT}), MAX({AT}), MIN(event_type), 1, NULL FROM events GROUP BY user_id, date_trunc('hour', {AT})"""
VITAL_ITEMS = Vocabulary(
    "itemid int, label string, linksto string",
    [(i, f"item {i}", "chartevents") for i in (220179, 220050, 220045, 226531, 220001, 223761, 223762, 224642)],
)
VITAL_MAP = Vocabulary(
    "itemid int, vital_name string, vital_category string",
    [
        (220179, "Cuff systolic", "sbp"), (220050, "Line systolic", "sbp"), (220045, "Heart rate", "heart_rate"),
        (226531, "Weight (lbs)", "weight_kg"), (220001, "Unmapped", "NO MAPPING"), (223761, "Temp F", "temp_c"),
        (223762, "Temp C", "temp_c"),
    ],
)


@query(
    "plan_vitals",
    with_ctes(
        f"""SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, {utc_sql('charttime')} AS recorded_dttm, vital_name, vital_category, vital_value, meas_site_name
        FROM (SELECT *, row_number() OVER (PARTITION BY hadm_id, charttime, vital_category, vital_value ORDER BY part, storetime NULLS FIRST, itemid) AS r FROM both_parts) WHERE r = 1""",
        e=VITAL_EVENTS, m=VITAL_MAP.sql,
        both_parts="""SELECT hadm_id, charttime, vital_name, vital_category, CASE WHEN itemid = 226531 THEN round_even(CAST(value AS DOUBLE) / 2.205, 1)
            ELSE CAST(value AS DOUBLE) END AS vital_value, CAST(NULL AS VARCHAR) AS meas_site_name, 0 AS part, storetime, itemid
          FROM e JOIN m USING (itemid) WHERE vital_category NOT IN ('NO MAPPING', 'temp_c')
          UNION ALL SELECT hadm_id, charttime, CASE WHEN c IS NOT NULL THEN 'Temperature Celsius' ELSE 'Temperature Fahrenheit' END, 'temp_c',
            COALESCE(CAST(c AS DOUBLE), round_even((CAST(f AS DOUBLE) - 32) * 5 / 9, 1)), site, 1, NULL, NULL
          FROM (SELECT hadm_id, charttime, MAX(CASE WHEN itemid = 223761 THEN value END) AS f, MAX(CASE WHEN itemid = 223762 THEN value END) AS c,
            MAX(CASE WHEN itemid = 224642 THEN value END) AS site FROM e WHERE itemid IN (223761, 223762, 224642) GROUP BY ALL)
          WHERE c IS NOT NULL OR f IS NOT NULL""",
    ),
)
def plan_vitals(t: Tables):
    return measurements.vitals({"chartevents": t.derive(VITAL_EVENTS)}, VITAL_ITEMS.df(t), VITAL_MAP.df(t))


LAB_EVENTS = """
SELECT CASE WHEN l_linenumber = 5 THEN NULL ELSE l_orderkey END AS hadm_id,
  CASE l_partkey % 4 WHEN 0 THEN 50862 WHEN 1 THEN 50912 WHEN 2 THEN 51006 ELSE 59999 END AS itemid,
  l_shipdate + (l_orderkey % 1440) * INTERVAL '1' MINUTE AS charttime,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate + (l_orderkey % 2000) * INTERVAL '1' MINUTE END AS storetime,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_quantity AS STRING) END AS value, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS valuenum,
  CASE WHEN l_linestatus = 'F' THEN 'LESS THAN ' || CAST(l_linenumber AS STRING) || '.' WHEN l_linenumber = 3 THEN 'NOT DONE. 5' END AS comments FROM lineitem"""
LAB_CHART = f"""
SELECT user_id AS hadm_id, CASE event_type WHEN 'view' THEN 220545 WHEN 'click' THEN 226540 ELSE 220000 END AS itemid, {AT} AS charttime,
  {AT} AS storetime, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST({K} AS STRING) END AS value, CAST({K} AS DOUBLE) AS valuenum FROM events"""
LAB_MAP = Vocabulary(
    "itemid int, label string, lab_category string, decision string, conversion_multiplier double, target_uom string",
    [
        (50862, "Albumin", "albumin", "TO MAP, AS IS", None, "g/dL"),
        (50912, "Creatinine", "creatinine", "TO MAP, CONVERT UOM", 88.4, "umol/L"),
        (51006, "Urea", "bun", "UNSURE", None, "mg/dL"),
        (59999, "Other", "albumin", "NO MAPPING", None, None),
        (220545, "Hematocrit", None, "TO MAP, AS IS", None, "%"),
        (226540, "Hematocrit (whole)", "hematocrit", "TO MAP, AS IS", None, "%"),
        (None, "Not available", "procalcitonin", "TO MAP, AS IS", None, None),
    ],
)
LAB_ORDERS = Vocabulary(
    "lab_category string, lab_order_category string",
    [("albumin", "lft"), ("creatinine", "bmp"), ("bun", "bmp")],
)
_NUMBER = r"TRY_CAST(nullif(regexp_extract(comments, '\d+\.\d+|\d+'), '') AS DOUBLE)"


@query(
    "plan_labs",
    with_ctes(
        f"""SELECT CAST(hadm_id AS VARCHAR) AS hospitalization_id, {utc_sql('charttime')} AS lab_order_dttm, {utc_sql('charttime')} AS lab_collect_dttm,
        {utc_sql('storetime')} AS lab_result_dttm, CAST(NULL AS VARCHAR) AS lab_order_name, lab_order_category, label AS lab_name, lab_category, txt AS lab_value,
        num AS lab_value_numeric, target_uom AS reference_unit, CAST(NULL AS VARCHAR) AS lab_specimen_name, CAST(NULL AS VARCHAR) AS lab_specimen_category,
        CAST(NULL AS VARCHAR) AS lab_loinc_code FROM (SELECT *, row_number() OVER (PARTITION BY hadm_id, charttime, storetime, lab_category, num
          ORDER BY label, txt NULLS FIRST, target_uom) AS r FROM both_parts WHERE storetime IS NOT NULL) LEFT JOIN o USING (lab_category) WHERE r = 1""",
        le=LAB_EVENTS, ce=LAB_CHART, m=LAB_MAP.sql, o=LAB_ORDERS.sql,
        parsed=f"""SELECT hadm_id, itemid, charttime, storetime, COALESCE(valuenum, CASE WHEN contains(lower(comments), 'not done') OR contains(lower(comments), 'unable')
            THEN NULL ELSE {_NUMBER} END) AS num, CASE WHEN valuenum IS NULL THEN comments ELSE COALESCE(value, comments) END AS txt
          FROM le WHERE hadm_id IS NOT NULL AND itemid IN (50862, 50912, 51006)
          UNION ALL SELECT hadm_id, itemid, charttime, storetime, valuenum, COALESCE(value, '') FROM ce WHERE itemid IN (220545, 226540)""",
        both_parts="""SELECT hadm_id, charttime, storetime, label, lab_category, target_uom,
            CASE WHEN decision = 'TO MAP, CONVERT UOM' THEN num * conversion_multiplier ELSE num END AS num,
            CASE WHEN decision = 'TO MAP, CONVERT UOM' THEN CAST(num * conversion_multiplier AS VARCHAR) ELSE txt END AS txt
          FROM parsed JOIN m USING (itemid) WHERE lab_category IS NOT NULL AND decision <> 'NO MAPPING'""",
    ),
)
def plan_labs(t: Tables):
    return measurements.labs(t.derive(LAB_EVENTS), t.derive(LAB_CHART), LAB_MAP.df(t), LAB_ORDERS.df(t))
