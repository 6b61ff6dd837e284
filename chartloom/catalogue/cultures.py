"""Microbiology cultures over rows derived from the benchmark events."""

from __future__ import annotations

from chartloom.catalogue.base import Tables, Vocabulary, query, with_ctes
from chartloom.catalogue.scalars import exact_sql, rules_sql
from chartloom.functions import culture_rules as cr
from chartloom.plans import microbiology

CULTURE_ROWS = """
SELECT user_id % 40 AS patient_id, user_id % 80 AS hospitalization_id, date_trunc('day', ts) AS lab_collect_dttm,
  date_trunc('day', ts) + INTERVAL '2' DAY AS lab_result_dttm, date_trunc('hour', ts) AS lab_order_dttm,
  CASE user_id % 7 WHEN 0 THEN 'Blood culture' WHEN 1 THEN 'Right EYE swab' WHEN 2 THEN 'fluid, pd' WHEN 3 THEN 'sputum, induced'
    WHEN 4 THEN 'chest tube' WHEN 5 THEN 'unknown' END AS fluid_name,
  CASE event_id % 3 WHEN 0 THEN 'Urine Culture' WHEN 1 THEN 'other' END AS micro_order_name,
  CASE user_id % 4 WHEN 0 THEN 'Gram Stain' WHEN 1 THEN 'Culture, CSF' WHEN 2 THEN 'smear' ELSE 'aerobic culture' END AS method_name,
  CASE event_id % 5 WHEN 0 THEN 'E. Coli' WHEN 1 THEN 'candida' WHEN 2 THEN 'not listed' WHEN 3 THEN NULL ELSE 'S. aureus' END AS organism_name,
  CASE event_id % 8 WHEN 0 THEN ' Beta-Lactams' WHEN 1 THEN 'Gentamicin 500' WHEN 2 THEN 'penicillin g' WHEN 3 THEN 'cefepime'
    WHEN 4 THEN 'Tetracycline' WHEN 5 THEN 'ESBL' WHEN 6 THEN 'Trimethoprim/Sulfamethoxazole' END AS antibiotic_name,
  CASE (event_id + user_id) % 6 WHEN 0 THEN 'Resistant ' WHEN 1 THEN 'susceptible dose dependent' WHEN 2 THEN 'not reported'
    WHEN 3 THEN 'Intermediate' WHEN 4 THEN 'Susceptible' END AS susceptibility_name
FROM events"""
ORGANISMS = Vocabulary("organism_name string, organism_category string, organism_group string", [
    ("E. coli", "escherichia_coli", "gram negative"), ("Candida", "candida_albicans", "fungus"),
    ("candida", "candida_albicans", "fungus"), ("S. Aureus", "staphylococcus_aureus", "gram positive"),
])
CULTURE_KEYS = ", ".join(microbiology.CULTURE)
CULTURE_CTES = {
    "c": CULTURE_ROWS,
    "l": "SELECT * REPLACE (" + ", ".join(f"lower({c}) AS {c}" for c in microbiology.LOWERED) + ") FROM c",
    "o": f"SELECT DISTINCT lower(organism_name) AS organism_name, organism_category, organism_group FROM ({ORGANISMS.sql}) x",
    "k": f"""SELECT l.*, organism_category, organism_group, {rules_sql('method_name', cr.METHOD_RULES)} AS method_category,
        COALESCE({rules_sql('method_name', cr.METHOD_OVERRIDE_RULES)}, {rules_sql('micro_order_name', cr.ORDER_NAME_RULES)},
          {rules_sql('fluid_name', cr.FLUID_OVERRIDE_RULES)}, {rules_sql('fluid_name', cr.FLUID_NAME_RULES)}, '{cr.FLUID_FALLBACK}') AS fluid_category,
        COALESCE({exact_sql('antibiotic_name', cr.ANTIBIOTIC_EXACT)}, {rules_sql('antibiotic_name', cr.ANTIBIOTIC_RULES)}, antibiotic_name) AS antibiotic_category,
        {exact_sql('susceptibility_name', cr.SUSCEPTIBILITY)} AS susceptibility_category
        FROM l LEFT JOIN o USING (organism_name) WHERE antibiotic_name <> 'esbl'""",
    "cells": f"""SELECT {CULTURE_KEYS}, lab_order_dttm, micro_order_name, antibiotic_category, MIN(susceptibility_category) AS susceptibility_category
        FROM k GROUP BY ALL""",
    "wide": f"""SELECT {CULTURE_KEYS}, lab_order_dttm, micro_order_name,
        string_agg(antibiotic_category || '=' || COALESCE(susceptibility_category, ''), '|' ORDER BY antibiotic_category) AS signature FROM cells GROUP BY ALL""",
    "isolates": f"""SELECT {CULTURE_KEYS}, signature, COUNT(*) AS n_orders,
        ROW_NUMBER() OVER (PARTITION BY {CULTURE_KEYS} ORDER BY signature) AS organism_id FROM wide GROUP BY {CULTURE_KEYS}, signature""",
    "long": f"""SELECT {CULTURE_KEYS}, organism_id, n_orders, split_part(e, '=', 1) AS antibiotic_category, nullif(split_part(e, '=', 2), '') AS susceptibility_category
        FROM (SELECT *, unnest(string_split(signature, '|')) AS e FROM isolates)""",
}


@query("plan_microbiology", with_ctes("SELECT * FROM long", **CULTURE_CTES))
def plan_microbiology(t: Tables):
    return microbiology.microbiology_culture(t.derive(CULTURE_ROWS), ORGANISMS.df(t))


WIDE = ["cefepime", "gentamicin", "penicillin", "beta_lactams", "trimethoprim_sulfamethoxazole"]


@query("microbiology_wide", with_ctes(
    f"SELECT {CULTURE_KEYS}, organism_id, " + ", ".join(f"MAX(CASE WHEN antibiotic_category = '{a}' THEN susceptibility_category END) AS {a}" for a in WIDE)
    + f" FROM long GROUP BY {CULTURE_KEYS}, organism_id", **CULTURE_CTES,
))
def microbiology_wide(t: Tables):
    return microbiology.susceptibility_table(microbiology.microbiology_culture(t.derive(CULTURE_ROWS), ORGANISMS.df(t)), WIDE)
