"""Sources, event extraction, projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalogue import shapes
from chartloom.catalogue.base import Tables, query, with_ctes
from chartloom.operators import events as ev
from chartloom.operators import sets
from chartloom.session import shared_folder
from chartloom.sources import catalog as sources
from chartloom.sources.catalog import Catalog

CHART_SQL = "itemid, label, hadm_id, stay_id, charttime AS time, value, valuenum, valueuom"


@query(
    "read_source",
    "SELECT l_returnflag, COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_returnflag",
)
def read_source(t: Tables):
    catalog = Catalog(parquet_dir=shared_folder(t.spark, "source"))
    t.lineitem.write.parquet(catalog.path(t.spark, "labevents"))
    return sources.read_source(t.spark, catalog, "labevents").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("orders")
    )


@query(
    "fetch_events_by_table",
    with_ctes(
        f"SELECT {CHART_SQL} FROM c LEFT JOIN d USING (itemid) WHERE itemid IN (220001, 220002, 51005)",
        c=shapes.CHART, d=shapes.ITEMS.sql,
    ),
)
def fetch_events_by_table(t: Tables):
    chart = t.derive(shapes.CHART)
    return ev.fetch_events_by_table(chart, shapes.ITEMS.df(t), [220001, 220002, 51005], "chartevents")


@query(
    "fetch_events",
    with_ctes(
        """SELECT itemid, label, hadm_id, stay_id, charttime AS time, value, valuenum, valueuom
        FROM c JOIN d USING (itemid) WHERE itemid IN (220001, 51004) AND linksto = 'chartevents'
        UNION ALL
        SELECT itemid, label, hadm_id, stay_id, endtime, CAST(value AS VARCHAR), NULL, valueuom
        FROM p JOIN d USING (itemid) WHERE itemid = 220003 AND linksto = 'procedureevents'""",
        c=shapes.CHART, p=shapes.PROCEDURE, d=shapes.ITEMS.sql,
    ),
)
def fetch_events(t: Tables):
    tables = {"chartevents": t.derive(shapes.CHART), "procedureevents": t.derive(shapes.PROCEDURE)}
    return ev.fetch_events(tables, shapes.ITEMS.df(t), [220001, 51004, 220003])


@query(
    "fetch_labs",
    with_ctes(
        "SELECT event_id, itemid, hadm_id, valuenum FROM c WHERE itemid IN (51004, 51005) AND hadm_id IS NOT NULL",
        c=shapes.CHART,
    ),
)
def fetch_labs(t: Tables):
    return ev.fetch_labs(t.derive(shapes.CHART), [51004, 51005]).select("event_id", "itemid", "hadm_id", "valuenum")


@query(
    "relevant_items",
    with_ctes(
        """SELECT itemid, COUNT(*) AS n FROM c
        WHERE itemid IN (SELECT itemid FROM m WHERE decision IS NULL
            OR decision NOT IN ('NO MAPPING', 'UNSURE', 'MAPPED ELSEWHERE', 'SPECIAL CASE', 'ALREADY MAPPED'))
        GROUP BY itemid""",
        c=shapes.CHART, m=shapes.MAPPING.sql,
    ),
)
def relevant_items(t: Tables):
    items = ev.relevant_items(shapes.MAPPING.df(t), "decision")
    return ev.only_items(t.derive(shapes.CHART), items).groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))


@query(
    "include_decision",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def include_decision(t: Tables):
    return ev.include_decision(t.orders, ["1-URGENT", "2-HIGH"], "o_orderpriority").select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "filter_contains",
    with_ctes("SELECT event_id, value FROM c WHERE value IS NULL OR contains(value, 'n')", c=shapes.CHART),
)
def filter_contains(t: Tables):
    return ev.filter_contains(t.derive(shapes.CHART), "value", "n").select("event_id", "value")


@query(
    "filter_contains_text",
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'",
)
def filter_contains_text(t: Tables):
    return ev.filter_contains(t.part, "p_name", "ring").select("p_partkey", "p_name")


@query(
    "items_by_id_width",
    "SELECT p_partkey, p_brand FROM part WHERE length(CAST(p_partkey AS VARCHAR)) = 3",
)
def items_by_id_width(t: Tables):
    return ev.items_by_id_width(t.part, 3, "p_partkey").select("p_partkey", "p_brand")


@query(
    "drop_null_and_sentinel",
    with_ctes(
        "SELECT event_id, hadm_id, value FROM c WHERE hadm_id IS NOT NULL AND value IS DISTINCT FROM '3'",
        c=shapes.CHART,
    ),
)
def drop_null_and_sentinel(t: Tables):
    return ev.drop_null_and_sentinel(t.derive(shapes.CHART), "hadm_id", "value", "3").select(
        "event_id", "hadm_id", "value"
    )


GUARDED = f"SELECT event_id, itemid, CASE WHEN itemid = 220002 AND valuenum < 5 THEN 'None' ELSE value END AS value FROM ({shapes.CHART}) s"


@query(
    "guarded_sentinel_drop",
    with_ctes("SELECT event_id, itemid, value FROM g WHERE value IS DISTINCT FROM 'None'", g=GUARDED),
)
def guarded_sentinel_drop(t: Tables):
    return ev.guarded_sentinel_drop(t.derive(GUARDED), 220002)


@query(
    "sentinel_violations",
    with_ctes(
        """SELECT 'other item' AS violation, itemid, count(*) AS n FROM g
        WHERE value = 'None' AND itemid IS DISTINCT FROM 220001 GROUP BY itemid
        UNION ALL SELECT 'no row of the item', 220001, 0 WHERE NOT EXISTS (SELECT 1 FROM g WHERE value = 'None' AND itemid = 220001)""",
        g=GUARDED,
    ),
)
def sentinel_violations(t: Tables):
    return ev.sentinel_violations(t.derive(GUARDED), 220001)


@query(
    "rename_reorder",
    with_ctes(
        """SELECT hadm_id AS hospitalization_id, charttime AS recorded_dttm, subject_id AS patient_id,
        CAST(NULL AS VARCHAR) AS meas_site_name, valuenum AS vital_value FROM c""",
        c=shapes.CHART,
    ),
)
def rename_reorder(t: Tables):
    return ev.rename_reorder(
        t.derive(shapes.CHART), {"charttime": "recorded_dttm", "valuenum": "vital_value"},
        ["hospitalization_id", "recorded_dttm", "patient_id", "meas_site_name", "vital_value"],
    )


@query(
    "sort_events",
    with_ctes(
        "SELECT event_id, hadm_id, charttime, storetime FROM c ORDER BY hadm_id NULLS LAST, charttime, storetime, event_id",
        c=shapes.CHART,
    ),
)
def sort_events(t: Tables):
    chart = t.derive(shapes.CHART).select("event_id", "hadm_id", "charttime", "storetime")
    return ev.sort_events(chart, extra=["event_id"])


@query("select_regex", "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def select_regex(t: Tables):
    return ev.select_regex(t.orders, "^o_order")


@query("select_exclude", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def select_exclude(t: Tables):
    return ev.select_exclude(t.customer, "c_acctbal")


@query(
    "select_replace",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN l_extendedprice / l_quantity ELSE l_quantity END AS l_quantity,
    l_returnflag || '/min' AS l_returnflag FROM lineitem""",
)
def select_replace(t: Tables):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_extendedprice")
    return ev.select_replace(
        df,
        l_quantity=F.when(F.col("l_quantity") < 10, F.col("l_extendedprice") / F.col("l_quantity")).otherwise(
            F.col("l_quantity")
        ),
        l_returnflag=F.concat("l_returnflag", F.lit("/min")),
    ).drop("l_extendedprice")


SEARCH_SQL = with_ctes(
    """, hits AS (SELECT * FROM d WHERE label ILIKE '%RATE%'),
    num AS (SELECT i.itemid, i.label, i.abbreviation, i.linksto, i.category, i.unitname, i.param_type, COUNT(*) AS count,
        'Min: ' || COALESCE(CAST(MIN(valuenum) AS VARCHAR), '') || ', Mean: ' || COALESCE(CAST(ROUND(AVG(valuenum), 2) AS VARCHAR), '')
          || ', Max: ' || COALESCE(CAST(MAX(valuenum) AS VARCHAR), '') AS value_instances
      FROM hits i LEFT JOIN c USING (itemid) WHERE i.linksto = 'chartevents' GROUP BY ALL)
    SELECT 'RATE' AS kw, * FROM num""".lstrip(", "),
    c=shapes.CHART, d=shapes.ITEMS.sql,
).replace(") hits AS", "), hits AS")


@query("item_search", SEARCH_SQL)
def item_search(t: Tables):
    return ev.item_search({"chartevents": t.derive(shapes.CHART)}, shapes.ITEMS.df(t), "RATE")


@query(
    "item_search_no_match",
    "SELECT 'zzz' AS kw, p_name AS label, CAST(NULL AS BIGINT) AS count FROM (SELECT 1) LEFT JOIN part ON contains(p_name, 'zzz')",
)
def item_search_no_match(t: Tables):
    parts = t.part.select(F.col("p_partkey").cast("int").alias("itemid"), F.col("p_name").alias("label"), F.lit("chartevents").alias("linksto"), F.lit("Numeric").alias("param_type"))
    out = ev.item_search({"chartevents": t.derive(shapes.CHART)}, parts, "zzz", case_sensitive=True)
    return out.select("kw", "label", "count")


@query(
    "union_all",
    """SELECT n_name AS name, n_regionkey AS k FROM nation UNION ALL SELECT r_name, r_regionkey FROM region
    UNION ALL SELECT s_name, s_nationkey FROM supplier""",
)
def union_all(t: Tables):
    return sets.union_all(
        t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("k")),
        t.region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")),
        t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("k")),
    )


@query(
    "concat_align",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def concat_align(t: Tables):
    return sets.concat_align(
        t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                          F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")),
    )


@query(
    "set_difference",
    with_ctes(
        "SELECT DISTINCT itemid FROM c WHERE itemid NOT IN (SELECT itemid FROM m WHERE decision = 'TO MAP')",
        c=shapes.CHART, m=shapes.MAPPING.sql,
    ),
)
def set_difference(t: Tables):
    allowed = ev.include_decision(shapes.MAPPING.df(t), "TO MAP")
    return sets.set_difference(t.derive(shapes.CHART), "itemid", allowed)


@query(
    "set_difference_large",
    "SELECT DISTINCT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
)
def set_difference_large(t: Tables):
    return sets.set_difference(
        t.lineitem, "l_orderkey", t.orders.filter(F.col("o_orderstatus") == "F"), "o_orderkey"
    )


@query("order_by", "SELECT c_mktsegment, c_nationkey, c_custkey FROM customer ORDER BY ALL")
def order_by(t: Tables):
    return sets.order_rows(t.customer.select("c_mktsegment", "c_nationkey", "c_custkey"))


@query(
    "limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def limit(t: Tables):
    ordered = sets.order_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return sets.limit_rows(ordered, 100)
