"""Data-quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.catalogue import shapes
from chartloom.catalogue.base import Tables, query, with_ctes
from chartloom.operators import quality as q
from chartloom.operators.joins import dict_map, value_map

REPORT = "'{t}' AS \"table\", '{c}' AS \"check\", '{col}' AS \"column\", {v} AS value, {n} AS n"


def rep(check: str, col: str, value: str = "CAST(NULL AS VARCHAR)", n: str = "COUNT(*)", table: str = "x") -> str:
    return "SELECT " + REPORT.format(t=table, c=check, col=col, v=value, n=n)


DIRTY = """
SELECT event_id, CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id END AS hospitalization_id, nullif(event_type, 'error') AS category,
  value / 100 AS fio2, CASE WHEN event_id % 1000 = 0 THEN 'x' END AS blank, CAST(NULL AS STRING) AS empty FROM events"""
SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("hospitalization_id", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("fio2", T.DoubleType()),
    T.StructField("mode", T.StringType()), T.StructField("empty", T.StringType()),
])
SCHEMA_SQL = " UNION ALL ".join(
    f"{rep(f'schema_{kind}', col, repr(dtype))} FROM events"
    for kind, col, dtype in (("missing", "mode", "string"), ("type", "hospitalization_id", "bigint"), ("unexpected", "blank", "string"))
)


@query("check_schema", SCHEMA_SQL)
def check_schema(t: Tables):
    return q.check_schema(t.derive(DIRTY), "x", SCHEMA, count=True)


NOT_NULL_SQL = " UNION ALL ".join(
    f"{rep('not_null', c)} FROM d WHERE {c} IS NULL HAVING COUNT(*) > 0" for c in ("event_id", "hospitalization_id", "category")
)


@query("check_not_null", with_ctes(NOT_NULL_SQL, d=DIRTY))
def check_not_null(t: Tables):
    return q.check_not_null(t.derive(DIRTY), "x", ["event_id", "hospitalization_id", "category"])


ISIN_SQL = f"{rep('isin', 'category', 'category')} FROM d WHERE category NOT IN ('view', 'click') GROUP BY category"


@query("check_isin", with_ctes(ISIN_SQL, d=DIRTY))
def check_isin(t: Tables):
    return q.check_isin(t.derive(DIRTY), "x", "category", ["view", "click"])


@query(
    "check_isin_vocabulary",
    with_ctes(f"{rep('isin', 'itemid', 'CAST(itemid AS VARCHAR)')} FROM c WHERE itemid NOT IN (SELECT itemid FROM m WHERE decision = 'TO MAP') GROUP BY itemid",
              c=shapes.CHART, m=shapes.MAPPING.sql),
)
def check_isin_vocabulary(t: Tables):
    allowed = shapes.MAPPING.df(t).filter("decision = 'TO MAP'").select("itemid")
    return q.check_isin(t.derive(shapes.CHART), "x", "itemid", allowed)


RANGE_SQL = f"{rep('range', 'l_discount', 'CAST(l_discount AS VARCHAR)')} FROM lineitem WHERE l_discount NOT BETWEEN 0.02 AND 0.08 GROUP BY l_discount"


@query("check_range", RANGE_SQL)
def check_range(t: Tables):
    return q.check_range(t.lineitem, "x", "l_discount", 0.02, 0.08)


ALL_NULL_SQL = f"{rep('all_null', 'blank', n='COUNT(blank)')} FROM d HAVING COUNT(blank) > 0"


@query("check_all_null", with_ctes(ALL_NULL_SQL, d=DIRTY))
def check_all_null(t: Tables):
    return q.check_all_null(t.derive(DIRTY), "x", ["blank", "empty"])


EQ_SQL = f"""{rep('unique_values_eq', 'category', 'category')} FROM d WHERE category NOT IN ('view', 'click', 'never') GROUP BY category
UNION ALL {rep('unique_values_eq', 'category', "'never'")} FROM d WHERE category = 'never' HAVING COUNT(*) = 0"""


@query("check_unique_values_eq", with_ctes(EQ_SQL, d=DIRTY))
def check_unique_values_eq(t: Tables):
    return q.check_unique_values_eq(t.derive(DIRTY), "x", "category", ["view", "click", "never"])


@query(
    "check_unique_key",
    with_ctes(f"""{rep('unique_key', 'user_id|day', "COALESCE(CAST(user_id AS VARCHAR), 'NULL') || '|' || CAST(day AS VARCHAR)")} FROM k
    GROUP BY user_id, day HAVING COUNT(*) > 1""", k="SELECT nullif(user_id, 7) AS user_id, CAST(ts AS DATE) AS day FROM events"),
)
def check_unique_key(t: Tables):
    df = t.derive("SELECT nullif(user_id, 7) AS user_id, CAST(ts AS DATE) AS day FROM events")
    return q.check_unique_key(df, "x", ["user_id", "day"])


@query(
    "check_row_count_preserved",
    with_ctes(
        f"""{rep('row_count_preserved', '*', "CAST(a AS VARCHAR) || '->' || CAST(b AS VARCHAR)", 'b - a')} FROM (
        SELECT (SELECT COUNT(*) FROM events) AS a, (SELECT COUNT(*) FROM events JOIN m USING (event_type)) AS b) WHERE a <> b""",
        m=shapes.TYPE_MAP.sql,
    ),
)
def check_row_count_preserved(t: Tables):
    after = t.events.join(shapes.TYPE_MAP.df(t), "event_type")
    return q.check_row_count_preserved(t.events, after, "x")


@query(
    "check_row_count_preserved_lookup",
    """SELECT 'before' AS step, COUNT(*) AS n FROM events UNION ALL SELECT 'after', COUNT(*) FROM events UNION ALL SELECT 'violations', 0""",
)
def check_row_count_preserved_lookup(t: Tables):
    lookup = value_map(shapes.TYPE_MAP.df(t), "event_type", "category")
    after = dict_map(t.events, lookup, "event_type", "category")
    steps = {"before": t.events, "after": after, "violations": q.check_row_count_preserved(t.events, after, "x")}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n") for step, df in steps.items()]
    return reduce(DataFrame.unionByName, counts)


@query(
    "check_all_value_null_rows",
    with_ctes(f"{rep('all_value_null_rows', '*')} FROM d WHERE hospitalization_id IS NULL AND category IS NULL AND blank IS NULL AND empty IS NULL HAVING COUNT(*) > 0", d=DIRTY),
)
def check_all_value_null_rows(t: Tables):
    return q.check_all_value_null_rows(t.derive(DIRTY), "x", ["hospitalization_id", "category"], ["blank", "empty"])


@query(
    "check_mapping_ambiguity",
    f"{rep('mapping_ambiguity', 'p_name', 'p_name', 'COUNT(DISTINCT p_type)')} FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_type) > 1",
)
def check_mapping_ambiguity(t: Tables):
    return q.check_mapping_ambiguity(t.part, "x", "p_name", "p_type")


FAIL_RULES = q.TableRules(
    schema=SCHEMA, required=["event_id", "hospitalization_id", "category", "mode"],
    isin={"category": ["view", "click"]}, all_null=["empty"],
    values_eq={"category": ["view", "click", "never"]},
)


@query("failure_cases", with_ctes(" UNION ALL ".join([f"SELECT * REPLACE (NULL AS n) FROM ({SCHEMA_SQL})", NOT_NULL_SQL, ISIN_SQL, EQ_SQL]), d=DIRTY))
def failure_cases(t: Tables):
    return q.failure_cases(t.derive(DIRTY), "x", FAIL_RULES)


CODED = "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type WHEN event_id % 9 > 0 THEN CAST(user_id AS VARCHAR) END AS code FROM events"


@query("check_castable", with_ctes(f"{rep('castable_int', 'code', 'code')} FROM c WHERE code IS NOT NULL AND try_cast(code AS INT) IS NULL GROUP BY code", c=CODED))
def check_castable(t: Tables):
    return q.check_castable(t.derive(CODED.replace("VARCHAR", "STRING")), "x", "code", "int")


@query(
    "check_known_items",
    with_ctes(
        f"{rep('known_items', 'itemid', 'CAST(itemid AS VARCHAR)')} FROM w WHERE itemid NOT IN (SELECT itemid FROM d WHERE linksto IS NOT NULL) GROUP BY itemid",
        w="SELECT l_partkey AS itemid FROM lineitem", d="SELECT p_partkey AS itemid, CASE WHEN p_size > 25 THEN 'chartevents' END AS linksto FROM part WHERE p_size < 45",
    ),
)
def check_known_items(t: Tables):
    parts = t.part.filter("p_size < 45").selectExpr("p_partkey AS itemid", "CASE WHEN p_size > 25 THEN 'chartevents' END AS linksto")
    return q.check_known_items(t.lineitem.selectExpr("l_partkey AS itemid"), parts, "x")


@query(
    "check_conflicting_cells",
    f"{rep('conflicting_cells', 'value', 'user_id || chr(124) || event_type', 'COUNT(DISTINCT value)')} FROM events GROUP BY user_id, event_type HAVING COUNT(DISTINCT value) > 1",
)
def check_conflicting_cells(t: Tables):
    return q.check_conflicting_cells(t.events, "x", ["user_id"], "event_type", "value")


@query(
    "failing_rows",
    with_ctes("SELECT event_id, category FROM d WHERE category NOT IN ('view', 'click')", d=DIRTY),
)
def failing_rows(t: Tables):
    df = t.derive(DIRTY)
    return q.failing_rows(df, q.check_isin(df, "x", "category", ["view", "click"]), "category").select(
        "event_id", "category"
    )

