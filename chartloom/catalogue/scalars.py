"""Scalar-expression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalogue.base import Tables, query, with_ctes
from chartloom.functions import culture_rules as cr
from chartloom.functions import numeric as nu
from chartloom.functions import text as tx
from chartloom.functions import time as tm

# every hour of the day, so that both clock changes of every year are hit
CLOCK = """
SELECT o_orderkey, o_orderdate + (o_orderkey % 2880) * INTERVAL '1' MINUTE AS wall,
  o_orderdate + (o_orderkey % 2880) * INTERVAL '1' MINUTE + INTERVAL '150' YEAR AS far FROM orders"""
_UTC = "(({t} AT TIME ZONE 'US/Eastern') AT TIME ZONE 'UTC')"
_LOCAL = "(({u} AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern')"


def utc_sql(t: str) -> str:
    """Ambiguous when both offsets read back as t; skipped when neither does."""
    summer, winter = f"({t} + INTERVAL 4 HOUR)", f"({t} + INTERVAL 5 HOUR)"
    is_s, is_w = f"{_LOCAL.format(u=summer)} = {t}", f"{_LOCAL.format(u=winter)} = {t}"
    return f"""CASE WHEN {is_s} AND {is_w} THEN NULL WHEN {is_s} THEN {summer} WHEN {is_w} THEN {winter}
    ELSE date_trunc('hour', {winter}) END"""


@query("local_to_utc", with_ctes(f"SELECT o_orderkey, wall, {utc_sql('wall')} AS utc FROM c", c=CLOCK))
def local_to_utc(t: Tables):
    df = t.derive(CLOCK)
    return df.select("o_orderkey", "wall", tm.local_to_utc("wall").alias("utc"))


@query(
    "local_to_utc_fixed_after_2037",
    with_ctes(f"SELECT o_orderkey, far, CASE WHEN year(far) >= 2038 THEN far + INTERVAL 5 HOUR ELSE {utc_sql('far')} END AS utc FROM c", c=CLOCK),
)
def local_to_utc_fixed(t: Tables):
    df = t.derive(CLOCK)
    return df.select("o_orderkey", "far", tm.local_to_utc("far", dst_after_2037=False).alias("utc"))


@query(
    "age_at_event",
    """SELECT o_orderkey, CAST(c_nationkey + 20 + date_diff('year', make_date(1990 + c_nationkey % 5, 1, 1), CAST(o_orderdate AS DATE)) AS INT) AS age
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def age_at_event(t: Tables):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    nation = F.col("c_nationkey")
    return df.select("o_orderkey", tm.age_at_event(nation + 20, 1990 + nation % 5, "o_orderdate").alias("age"))


LENGTHS = "SELECT event_id, ts AS a, ts + (event_id % 5) * INTERVAL '30' SECOND AS b FROM events"


@query(
    "duration_minutes",
    with_ctes(
        """SELECT event_id, EXTRACT(EPOCH FROM (b - a)) / 60 AS minutes, CASE WHEN b - a = INTERVAL '1 minute' THEN 1 ELSE 0 END AS one
        FROM l WHERE EXTRACT(EPOCH FROM (b - a)) / 60 > 0""",
        l=LENGTHS,
    ),
)
def duration_minutes(t: Tables):
    df = t.derive(LENGTHS).select(
        "event_id", tm.duration_minutes("a", "b").alias("minutes"), tm.lasts_exactly("a", "b").alias("one")
    )
    return df.filter("minutes > 0")


# body temperatures are charted with one decimal
FAHRENHEIT = "SELECT event_id, CAST(900 + CAST(regexp_extract(props, '[0-9]+', 0) AS INT) * 2 AS DOUBLE) / 10 AS f FROM events"


@query("f_to_c", with_ctes("SELECT event_id, f, round_even((f - 32) * 5 / 9, 1) AS celsius FROM t", t=FAHRENHEIT))
def f_to_c(t: Tables):
    return t.derive(FAHRENHEIT).withColumn("celsius", nu.f_to_c("f"))


@query("lb_to_kg", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2.205, 1) AS kg FROM lineitem")
def lb_to_kg(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", nu.lb_to_kg("l_quantity").alias("kg"))


@query(
    "unit_convert",
    """SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN value * 88.4 ELSE value END AS number,
    CASE WHEN event_type = 'click' THEN NULL ELSE props END AS kept_text, CASE WHEN event_type = 'click' THEN value * 88.4 END AS text_number FROM events""",
)
def unit_convert(t: Tables):
    applies = F.col("event_type") == "click"
    number, text = nu.convert_when(applies, F.lit(88.4), "value", F.col("props"))
    # the converted text is engine-formatted, so it is compared as the number it reads
    return t.events.select(
        "event_id", "event_type", number.alias("number"), F.when(~applies, text).alias("kept_text"),
        F.when(applies, text.cast("double")).alias("text_number"),
    )


@query(
    "clean_fio2",
    """SELECT event_id, v, CASE WHEN v >= 20 AND v <= 100 THEN v / 100 WHEN v > 1 AND v < 20 THEN NULL WHEN v > 0.2 AND v <= 1 THEN v END AS fio2
    FROM (SELECT event_id, value * CASE event_id % 3 WHEN 0 THEN 0.01 WHEN 1 THEN 1 ELSE 2 END AS v FROM events)""",
)
def clean_fio2(t: Tables):
    factor = F.when(F.col("event_id") % 3 == 0, 0.01).when(F.col("event_id") % 3 == 1, 1.0).otherwise(2.0)
    df = t.events.select("event_id", (F.col("value") * factor).alias("v"))
    return df.withColumn("fio2", nu.clean_fraction("v"))


COMMENTS = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'UNABLE TO REPORT. PTT < ' || CAST(value AS STRING) WHEN 1 THEN 'Not Done, was ' || CAST(value AS STRING)
  WHEN 2 THEN 'LESS THAN ' || CAST(value AS STRING) || '.  RISK <1.0' WHEN 3 THEN 'unable' WHEN 4 THEN props END AS comment FROM events"""


@query(
    "parse_comment_number",
    with_ctes(
        r"""SELECT event_id, comment, CASE WHEN contains(lower(comment), 'ptt') AND contains(lower(comment), 'unable') THEN x
        WHEN contains(lower(comment), 'not done') OR contains(lower(comment), 'unable') THEN NULL ELSE x END AS number
        FROM (SELECT *, TRY_CAST(nullif(regexp_extract(comment, '\d+\.\d+|\d+'), '') AS DOUBLE) AS x FROM c)""",
        c=COMMENTS,
    ),
)
def parse_comment_number(t: Tables):
    return t.derive(COMMENTS).select("event_id", "comment", tx.parse_comment_number("comment").alias("number"))


@query(
    "parse_text_number",
    r"""SELECT doc_id, CASE WHEN contains(lower(text), 'not done') OR contains(lower(text), 'unable')
      THEN CASE WHEN contains(lower(text), 'ptt') AND contains(lower(text), 'unable') THEN x END ELSE x END AS number
    FROM (SELECT doc_id, text, TRY_CAST(nullif(regexp_extract(text, '[0-9]+\.[0-9]+|[0-9]+'), '') AS DOUBLE) AS x FROM documents)""",
)
def parse_text_number(t: Tables):
    return t.documents.select("doc_id", tx.parse_comment_number("text").alias("number"))


@query(
    "regex_extract_number",
    r"""SELECT event_id, TRY_CAST(regexp_extract(props, '[\d\.]+') AS DOUBLE) AS setting, CAST(TRY_CAST(regexp_extract('P' || CAST(event_id % 10 AS VARCHAR), '\d+') AS FLOAT) AS DOUBLE) AS level
    FROM events""",
)
def regex_extract_number(t: Tables):
    code = F.concat(F.lit("P"), (F.col("event_id") % 10).cast("string"))
    return t.events.select(
        "event_id", tx.extract_number("props", dtype="double").alias("setting"),
        tx.extract_number(code, r"\d+").alias("level"),
    )


@query("split_part", "SELECT page_id, split_part(url, '://', 2) AS rest, split_part(url, '/', 4) AS first FROM pages")
def split_part(t: Tables):
    return t.pages.select("page_id", tx.text_after("url", "://").alias("rest"), tx.text_after("url", "/", 4).alias("first"))


@query("normalise_whitespace", r"SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations")
def normalise_whitespace(t: Tables):
    return t.conversations.select("conv_id", "turn", tx.normalise_whitespace("text").alias("text"))


@query(
    "concat_ws",
    "SELECT p_partkey, concat_ws('; ', nullif(p_brand, 'Brand#7'), p_name, nullif(p_type, 'SMALL')) AS route FROM part",
)
def concat_ws(t: Tables):
    return t.part.select("p_partkey", tx.join_present(
        F.nullif("p_brand", F.lit("Brand#7")), "p_name", F.nullif("p_type", F.lit("SMALL"))
    ).alias("route"))


@query(
    "text_to_ordinal",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS a,
    CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '1-URGENT' THEN 3 END AS b, a + b AS total FROM orders""",
)
def text_to_ordinal(t: Tables):
    df = t.orders.select(
        "o_orderkey", tx.text_to_ordinal("o_orderstatus", ["F", "O"]).alias("a"),
        tx.text_to_ordinal("o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"]).alias("b"),
    )
    return df.withColumn("total", tx.strict_sum("a", "b"))


@query(
    "prefix_number",
    "SELECT o_orderkey, TRY_CAST(trim(substring(s, 1, 3)) AS DOUBLE) AS score FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN ' -' ELSE '+' END || o_orderpriority AS s FROM orders)",
)
def prefix_number(t: Tables):
    sign = F.when(F.col("o_orderkey") % 2 == 0, " -").otherwise("+")
    return t.orders.select("o_orderkey", tx.prefix_number(F.concat(sign, "o_orderpriority")).alias("score"))


YES_NO = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Yes (x)' WHEN 1 THEN 'No' WHEN 2 THEN 'Unable' END AS a,
  CASE event_type WHEN 'view' THEN 'Yes' WHEN 'click' THEN 'No' WHEN 'error' THEN 'Unable' END AS b,
  CASE user_id % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS c, CASE WHEN value > 60 THEN 'Yes' WHEN value > 30 THEN 'No' END AS d FROM events"""


@query(
    "three_valued_rule",
    with_ctes(
        """SELECT event_id, CASE WHEN a LIKE '%Yes%' AND b LIKE '%Yes%' AND (c LIKE '%Yes%' OR d LIKE '%Yes%') THEN 'Positive'
        WHEN a LIKE '%No%' OR b LIKE '%No%' OR (c LIKE '%No%' AND d LIKE '%No%') THEN 'Negative' END AS total FROM y""",
        y=YES_NO,
    ),
)
def three_valued_rule(t: Tables):
    total = tx.three_valued_delirium(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    return t.derive(YES_NO).select("event_id", total.alias("total"))


CODES = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(10000 + event_id AS STRING) WHEN 1 THEN CAST(1000 + event_id % 900 AS STRING) || 'F'
  WHEN 2 THEN 'A' || CAST(1000 + event_id % 900 AS STRING) WHEN 3 THEN 'Z' || CAST(1000 + event_id % 900 AS STRING) ELSE event_type END AS code FROM events"""


@query(
    "code_pattern_classify",
    with_ctes(
        """SELECT event_id, code, CASE WHEN regexp_matches(code, '^[0-9]{5}$') OR regexp_matches(code, '^[0-9]{4}[FT]$') THEN 'CPT'
        WHEN regexp_matches(code, '^[A-V][0-9]{4}$') THEN 'HCPCS' END AS format FROM c""",
        c=CODES,
    ),
)
def code_pattern_classify(t: Tables):
    return t.derive(CODES).select("event_id", "code", tx.classify_code("code").alias("format"))


@query(
    "case_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Full' WHEN 'O' THEN 'Other' END AS status,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'prone' ELSE 'not_prone' END AS position FROM orders""",
)
def case_map(t: Tables):
    return t.orders.select(
        "o_orderkey", tx.case_map("o_orderstatus", {"F": "Full", "O": "Other"}).alias("status"),
        tx.case_map("o_orderpriority", {"1-URGENT": "prone"}, "not_prone").alias("position"),
    )


@query("null_if", "SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer")
def null_if(t: Tables):
    return t.customer.select("c_custkey", tx.null_if("c_mktsegment", "MACHINERY").alias("segment"))


@query(
    "impute_rate",
    """SELECT l_orderkey, l_linenumber, COALESCE(rate, l_extendedprice / l_quantity) AS rate, COALESCE(unit, l_linestatus || '/min') AS unit
    FROM (SELECT *, CASE WHEN l_tax > 0.03 THEN l_tax END AS rate, nullif(l_returnflag, 'N') AS unit FROM lineitem)""",
)
def impute_rate(t: Tables):
    rate, unit = nu.impute_rate(
        F.when(F.col("l_tax") > 0.03, F.col("l_tax")), F.nullif("l_returnflag", F.lit("N")), "l_extendedprice",
        "l_linestatus", "l_quantity",
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", rate.alias("rate"), unit.alias("unit"))


def rules_sql(col: str, rules, otherwise: str = "NULL") -> str:
    whens = " ".join(
        f"WHEN regexp_matches({col}, '(?i){p}') THEN '{c}'" if c is not None else f"WHEN regexp_matches({col}, '(?i){p}') THEN NULL"
        for p, c in rules
    )
    return f"CASE {whens} ELSE {otherwise} END"


@query(
    "regex_rule_categorise",
    f"""SELECT doc_id, {rules_sql('text', cr.METHOD_RULES)} AS method, {rules_sql('text', cr.FLUID_NAME_RULES, f"'{cr.FLUID_FALLBACK}'")} AS fluid
    FROM documents""",
)
def regex_rule_categorise(t: Tables):
    text = F.col("text")
    return t.documents.select(
        "doc_id", cr.method_category(text).alias("method"),
        tx.first_match(text, cr.FLUID_NAME_RULES, True, F.lit(cr.FLUID_FALLBACK)).alias("fluid"),
    )


CULTURE_TEXT = """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'Blood culture' WHEN 1 THEN 'Right EYE swab' WHEN 2 THEN 'fluid, pd' WHEN 3 THEN 'sputum, induced'
    WHEN 4 THEN 'chest tube' WHEN 5 THEN 'unknown' END AS fluid_name,
  CASE event_id % 4 WHEN 0 THEN 'Urine culture' WHEN 1 THEN 'wound' WHEN 2 THEN 'other' END AS order_name,
  CASE event_type WHEN 'view' THEN 'Gram Stain' WHEN 'click' THEN 'culture, csf' WHEN 'error' THEN 'smear' ELSE 'catheter tip' END AS method_name,
  CASE event_id % 6 WHEN 0 THEN ' Beta-Lactams' WHEN 1 THEN 'Gentamicin 500' WHEN 2 THEN 'penicillin g' WHEN 3 THEN 'cefepime' WHEN 4 THEN 'Tetracycline' END AS drug,
  CASE event_id % 5 WHEN 0 THEN 'Resistant ' WHEN 1 THEN 'susceptible dose dependent' WHEN 2 THEN 'not reported' WHEN 3 THEN 'Intermediate' END AS result
FROM events"""


def exact_sql(col: str, mapping) -> str:
    return f"CASE lower(trim({col})) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


@query(
    "culture_categories",
    with_ctes(
        f"""SELECT event_id, {rules_sql('method_name', cr.METHOD_RULES)} AS method,
        COALESCE({rules_sql('method_name', cr.METHOD_OVERRIDE_RULES)}, {rules_sql('order_name', cr.ORDER_NAME_RULES)},
          {rules_sql('fluid_name', cr.FLUID_OVERRIDE_RULES)}, {rules_sql('fluid_name', cr.FLUID_NAME_RULES)}, '{cr.FLUID_FALLBACK}') AS fluid,
        COALESCE({exact_sql('drug', cr.ANTIBIOTIC_EXACT)}, {rules_sql('drug', cr.ANTIBIOTIC_RULES)}, drug) AS antibiotic,
        {exact_sql('result', cr.SUSCEPTIBILITY)} AS susceptibility FROM c""",
        c=CULTURE_TEXT,
    ),
)
def culture_categories(t: Tables):
    return t.derive(CULTURE_TEXT).select(
        "event_id", cr.method_category(F.col("method_name")).alias("method"),
        cr.fluid_category(F.col("fluid_name"), F.col("order_name"), F.col("method_name")).alias("fluid"),
        cr.antibiotic_category(F.col("drug")).alias("antibiotic"),
        cr.susceptibility_category(F.col("result")).alias("susceptibility"),
    )


@query(
    "split_genus_species",
    "SELECT p_partkey, string_split(n, '_')[1] AS genus, string_split(n, '_')[2] AS species FROM (SELECT p_partkey, CASE WHEN p_size > 40 THEN p_brand ELSE replace(p_name, ' ', '_') END AS n FROM part)",
)
def split_genus_species(t: Tables):
    name = F.when(F.col("p_size") > 40, F.col("p_brand")).otherwise(F.replace("p_name", F.lit(" "), F.lit("_")))
    genus, species = tx.split_genus_species(name)
    return t.part.select("p_partkey", genus.alias("genus"), species.alias("species"))


SCORES = """
SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN NULL ELSE event_id % 7 END AS DOUBLE) AS m, CAST(CASE event_id % 4 WHEN 0 THEN NULL ELSE event_id % 6 END AS DOUBLE) AS v,
  CAST(CASE event_id % 3 WHEN 0 THEN NULL ELSE user_id % 5 END AS DOUBLE) AS e, CAST(CASE user_id % 3 WHEN 0 THEN NULL ELSE user_id % 7 END AS DOUBLE) AS pm,
  CAST(CASE user_id % 7 WHEN 0 THEN NULL ELSE user_id % 4 END AS DOUBLE) AS pv, CAST(CASE user_id % 2 WHEN 0 THEN NULL ELSE event_id % 5 END AS DOUBLE) AS pe FROM events"""


@query(
    "gcs_total",
    with_ctes(
        """SELECT event_id, CASE WHEN bool_or(tubed) THEN 15.0 ELSE sum(coalesce(now, CASE WHEN NOT was_tubed THEN before END, normal)) END AS gcs
        FROM parts JOIN states USING (event_id) GROUP BY event_id""",
        s=SCORES,
        # an intubated patient has verbal 0, or no verbal score after a reading that was 0
        states="SELECT event_id, coalesce(pv, -1) = 0 AS was_tubed, coalesce(v, CASE WHEN pv = 0 THEN 0 ELSE -1 END) = 0 AS tubed FROM s",
        parts="SELECT event_id, m AS now, pm AS before, 6.0 AS normal FROM s UNION ALL SELECT event_id, v, pv, 5.0 FROM s UNION ALL SELECT event_id, e, pe, 4.0 FROM s",
    ),
)
def gcs_total(t: Tables):
    c = F.col
    return t.derive(SCORES).select(
        "event_id", nu.coma_total(c("m"), c("v"), c("e"), c("pm"), c("pv"), c("pe")).alias("gcs")
    )


@query(
    "null_outside_range",
    "SELECT event_id, CASE WHEN value NOT BETWEEN 10 AND 60 THEN NULL ELSE value END AS value FROM events",
)
def null_outside_range(t: Tables):
    return t.events.select("event_id", nu.null_outside("value", 10, 60).alias("value"))
