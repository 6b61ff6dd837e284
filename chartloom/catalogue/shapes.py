"""SELECT texts, valid in both engines, that shape the benchmark tables like event tables."""

from __future__ import annotations

from chartloom.catalogue.base import Vocabulary

K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"

ITEM = (
    "CASE event_type WHEN 'view' THEN 220001 WHEN 'click' THEN 220002 WHEN 'purchase' THEN 220003 "
    "WHEN 'signup' THEN 51004 ELSE 51005 END"
)

CHART = f"""
SELECT {ITEM} AS itemid, user_id AS subject_id,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS hadm_id,
  user_id * 10 + event_id % 2 AS stay_id, event_id, ts AS charttime, ts - INTERVAL '10' MINUTE AS starttime,
  ts + INTERVAL '20' MINUTE AS endtime, ts + INTERVAL '5' MINUTE AS storetime,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST({K} % 7 AS STRING) END AS value, value AS valuenum,
  CASE event_id % 3 WHEN 0 THEN 'u1' WHEN 1 THEN 'u2' END AS valueuom
FROM events"""

PROCEDURE = """
SELECT CASE event_type WHEN 'view' THEN 220001 WHEN 'click' THEN 220002 WHEN 'purchase' THEN 220003
    WHEN 'signup' THEN 51004 ELSE 51005 END AS itemid,
  user_id AS hadm_id, user_id * 10 AS stay_id, event_id, ts + INTERVAL '20' MINUTE AS endtime,
  value, 'min' AS valueuom
FROM events"""

ITEMS = Vocabulary(
    "itemid int, label string, abbreviation string, linksto string, category string, unitname string, param_type string",
    [
        (220001, "Viewing rate", "VR", "chartevents", "Browse", "n", "Numeric"),
        (220002, "Click quality", "CQ", "chartevents", "Browse", None, "Text"),
        (220003, "Purchase duration", "PD", "procedureevents", "Order", "min", "Numeric"),
        (51004, "Signup date", "SD", "chartevents", "Account", None, "Date"),
        (51005, "Error rate", "ER", "chartevents", "Fault", "n", "Numeric"),
        (220009, "Unused rate", "UR", "chartevents", "Browse", "n", "Numeric"),
    ],
)

MAPPING = Vocabulary(
    "itemid int, variable string, category string, decision string",
    [
        (220001, "view", "browse", "TO MAP"),
        (220002, "click", "browse", "TO MAP"),
        (220003, "purchase", "order", None),
        (51004, "signup", "account", "UNSURE"),
        (51005, "error", "NO MAPPING", "TO MAP, AS IS"),
        (51006, "other", "none", "NO MAPPING"),
        (220002, "click", "interact", "TO MAP"),
    ],
)

TYPE_MAP = Vocabulary(
    "event_type string, category string, decision string",
    [
        ("view", "browse", "TO MAP"),
        ("click", "browse", "TO MAP"),
        ("purchase", "order", "TO MAP"),
        ("signup", "account", "UNSURE"),
        ("error", "NO MAPPING", "TO MAP"),
        ("click", "interact", "TO MAP"),
    ],
)

INPUTS = """
SELECT l_orderkey AS hadm_id, l_partkey % 40 AS itemid, l_shipdate AS starttime, l_quantity AS rate,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_tax < 0.03 THEN '' WHEN l_tax < 0.06 THEN 'mg/h' ELSE 'mL/h' END AS rateuom,
  l_extendedprice AS amount, CASE WHEN l_discount < 0.05 THEN 'mg' ELSE 'mL' END AS amountuom,
  l_returnflag AS ordercategoryname, l_linestatus AS secondaryordercategoryname
FROM lineitem"""
