"""Aggregation and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalogue import shapes
from chartloom.catalogue.base import Tables, query, with_ctes
from chartloom.operators import profiling as pf
from chartloom.operators.quantiles import exact_quantiles


def _cat(label: str, expr: str) -> str:
    return f"'{label}' || COALESCE(CAST({expr} AS VARCHAR), '')"


def breakdown_sql(col: str, keys: str, source: str, where: str, sep: str = ", ") -> str:
    return f"""SELECT {keys}, STRING_AGG(v || ': ' || CAST(n AS VARCHAR), '{sep}' ORDER BY n DESC, v) AS {col}_instances
    FROM (SELECT {keys}, COALESCE(CAST({col} AS VARCHAR), '') AS v, COUNT(*) AS n FROM {source} WHERE {where} GROUP BY ALL) GROUP BY {keys}"""


@query(
    "item_stats_numeric",
    f"""SELECT event_type, COUNT(*) AS count, {_cat('Min: ', 'MIN(value)')} || {_cat(', Mean: ', 'ROUND(AVG(value), 2)')}
    || {_cat(', Max: ', 'MAX(value)')} AS value_instances FROM events GROUP BY event_type""",
)
def item_stats_numeric(t: Tables):
    return pf.item_stats_numeric(t.events, ["event_type"], "value")


@query(
    "item_stats_categorical",
    with_ctes(
        """SELECT t.p_brand, t.count, b.p_type_instances AS value_instances FROM
        (SELECT p_brand, COUNT(*) AS count FROM part GROUP BY p_brand) t LEFT JOIN b USING (p_brand)""",
        b=breakdown_sql("p_type", "p_brand", "part", "p_type <> ''"),
    ),
)
def item_stats_categorical(t: Tables):
    return pf.item_stats_categorical(t.part, ["p_brand"], "p_type")


@query(
    "item_value_counts",
    "SELECT source, lang, COUNT(*) AS n FROM documents WHERE lang <> '' GROUP BY source, lang",
)
def item_value_counts(t: Tables):
    return pf.value_counts(t.documents, ["source"], "lang")


@query(
    "item_stats_datetime",
    """SELECT l_returnflag, COUNT(*) AS count, 'Earliest: ' || CAST(MIN(l_shipdate) AS VARCHAR) || ', Latest: '
    || CAST(MAX(l_shipdate) AS VARCHAR) AS value_instances FROM lineitem GROUP BY l_returnflag""",
)
def item_stats_datetime(t: Tables):
    return pf.item_stats_datetime(t.lineitem, ["l_returnflag"], "l_shipdate")


@query(
    "item_stats_rate_amount",
    with_ctes(
        f"""SELECT itemid, COUNT(*) AS count, {_cat('Rate: ', 'ROUND(MIN(rate), 2)')} || {_cat(', ', 'ROUND(MEDIAN(rate), 2)')}
        || {_cat(', ', 'ROUND(MAX(rate), 2)')} || {_cat('; Amount: ', 'ROUND(MIN(amount), 2)')} || {_cat(', ', 'ROUND(MEDIAN(amount), 2)')}
        || {_cat(', ', 'ROUND(MAX(amount), 2)')} AS value_instances FROM i GROUP BY itemid""",
        i=shapes.INPUTS,
    ),
)
def item_stats_rate_amount(t: Tables):
    return pf.item_stats_rate_amount(t.derive(shapes.INPUTS), ["itemid"], "rate", "amount")


BREAKDOWNS = {
    "amountuom": "amountuom IS NOT NULL AND rateuom <> ''",
    "rateuom": "rateuom <> ''",
    "ordercategoryname": "ordercategoryname <> ''",
    "secondaryordercategoryname": "secondaryordercategoryname <> ''",
}


@query(
    "item_stats_uom_breakdown",
    with_ctes(
        "SELECT * FROM (SELECT DISTINCT itemid FROM i) "
        + " ".join(f"LEFT JOIN b{n} USING (itemid)" for n in range(len(BREAKDOWNS))),
        i=shapes.INPUTS,
        **{f"b{n}": breakdown_sql(c, "itemid", "i", w) for n, (c, w) in enumerate(BREAKDOWNS.items())},
    ),
)
def item_stats_uom_breakdown(t: Tables):
    return pf.item_stats_uom_breakdown(t.derive(shapes.INPUTS), ["itemid"], list(BREAKDOWNS), {"amountuom": "rateuom"})


LABS = """
SELECT p_size AS itemid, l_extendedprice AS valuenum, CASE WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.05 THEN 'g' ELSE 'mg' END AS valueuom
FROM lineitem JOIN part ON l_partkey = p_partkey"""
LAB_ITEMS = "SELECT p_size AS itemid, MIN(p_name) AS label, MIN(p_type) AS fluid, MIN(p_brand) AS category FROM part GROUP BY p_size"


@query(
    "lab_item_stats",
    with_ctes(
        """SELECT itemid, label, '' AS abbreviation, fluid, category, COUNT(*) AS n, 'min: ' || ROUND(MIN(valuenum), 1) || '; mean: ' || ROUND(AVG(valuenum), 1)
        || '; median: ' || ROUND(MEDIAN(valuenum), 1) || '; max: ' || ROUND(MAX(valuenum), 1) AS value_instances,
        ANY_VALUE(valueuom_instances) AS uom_instances
        FROM l JOIN d USING (itemid) JOIN b USING (itemid) WHERE contains(lower(label), 'blue') GROUP BY itemid, label, fluid, category""",
        l=LABS, d=LAB_ITEMS, b=breakdown_sql("valueuom", "itemid", "l", "TRUE", "; "),
    ),
)
def lab_item_stats(t: Tables):
    return pf.lab_item_stats(t.derive(LABS), t.derive(LAB_ITEMS), F.lower("label").contains("blue"))


@query(
    "group_rank_first",
    """SELECT user_id, event_type, grade FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, flag, recent DESC, event_type, grade) AS r FROM (
        SELECT user_id, event_type, value > 50 AS grade, CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END AS flag,
          COUNT(*) AS n, MAX(ts) AS recent FROM events GROUP BY ALL)) WHERE r = 1""",
)
def group_rank_first(t: Tables):
    df = t.events.select("user_id", "event_type", (F.col("value") > 50).alias("grade"), "ts")
    return pf.most_frequent(
        df, "user_id", ["event_type", "grade"], "ts", F.col("event_type").isin("error", "signup")
    )


@query(
    "conditional_pivot_max",
    """SELECT user_id, date_trunc('day', ts) AS day, MAX(CASE WHEN event_type = 'view' THEN value END) AS view_v,
    MAX(CASE WHEN event_type = 'click' THEN value END) AS click_v, MAX(CASE WHEN event_type = 'error' THEN props END) AS error_p
    FROM events GROUP BY 1, 2""",
)
def conditional_pivot_max(t: Tables):
    df = t.events.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    kind = F.col("event_type")
    return pf.conditional_pivot_max(df, ["user_id", "day"], {
        "view_v": (kind == "view", F.col("value")), "click_v": (kind == "click", F.col("value")),
        "error_p": (kind == "error", F.col("props")),
    })


@query(
    "first_per_group",
    """SELECT o_custkey, (ARRAY_AGG(o_orderpriority ORDER BY o_orderdate, o_orderkey))[1] AS o_orderpriority
    FROM (SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_orderdate, o_orderkey FROM orders) GROUP BY o_custkey""",
)
def first_per_group(t: Tables):
    df = t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return pf.first_value_per_group(df, "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"])


@query(
    "count_distinct_having",
    """SELECT o_custkey, COUNT(DISTINCT o_orderstatus) AS unique_o_orderstatus, COUNT(DISTINCT o_orderpriority) AS unique_o_orderpriority
    FROM orders GROUP BY o_custkey HAVING unique_o_orderstatus > 1 OR unique_o_orderpriority > 1""",
)
def count_distinct_having(t: Tables):
    return pf.inconsistent_entities(t.orders, "o_custkey", ["o_orderstatus", "o_orderpriority"])


@query(
    "count_distinct_summary",
    """SELECT COUNT(*) AS n_entities, COUNT(*) FILTER (WHERE s > 1) AS n_o_orderstatus, COUNT(*) FILTER (WHERE p > 1) AS n_o_orderpriority,
    ROUND(COUNT(*) FILTER (WHERE s > 1) / COUNT(*), 4) AS share_o_orderstatus, ROUND(COUNT(*) FILTER (WHERE p > 1) / COUNT(*), 4) AS share_o_orderpriority
    FROM (SELECT o_custkey, COUNT(DISTINCT o_orderstatus) AS s, COUNT(DISTINCT o_orderpriority) AS p FROM orders GROUP BY o_custkey)""",
)
def count_distinct_summary(t: Tables):
    return pf.inconsistency_summary(t.orders, "o_custkey", ["o_orderstatus", "o_orderpriority"])


NET = """
SELECT user_id, date_trunc('day', ts) AS day, CAST(MAX(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INT) AS has_in,
  CAST(MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS has_out,
  SUM(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS vol_in, SUM(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS vol_out,
  SUM(CASE WHEN event_type = 'click' THEN -value ELSE value END) AS net_volume
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2"""


def _net(t: Tables):
    df = t.events.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    kind = F.col("event_type")
    return pf.net_volume(df, ["user_id", "day"], kind == "click", kind == "purchase", "value")


@query(
    "net_volume",
    with_ctes(
        """SELECT user_id, day, has_in, has_out, ROUND(vol_in, 2) AS vol_in, ROUND(vol_out, 2) AS vol_out, ROUND(net_volume, 2) AS net_volume
        FROM net""",
        net=NET,
    ),
)
def net_volume(t: Tables):
    return _net(t).withColumns({c: F.round(c, 2) for c in ("vol_in", "vol_out", "net_volume")})


@query(
    "cooccurrence_summary",
    with_ctes(
        """SELECT CASE WHEN has_in = 1 AND has_out = 1 THEN 'both_in_and_out' WHEN has_in = 1 THEN 'in_only' WHEN has_out = 1 THEN 'out_only' END
        AS cooccur_pattern, COUNT(*) AS n_rows, COUNT(CASE WHEN net_volume < 0 THEN 1 END) AS n_net_negative,
        COUNT(CASE WHEN net_volume = 0 THEN 1 END) AS n_net_zero, ROUND(AVG(net_volume), 1) AS avg_net, ROUND(MEDIAN(net_volume), 1) AS median_net
        FROM (SELECT * REPLACE (ROUND(net_volume, 2) AS net_volume) FROM net) GROUP BY 1""",
        net=NET,
    ),
)
def cooccurrence_summary(t: Tables):
    return pf.cooccurrence_summary(_net(t).withColumn("net_volume", F.round("net_volume", 2)))


PROFILE = """COUNT(*) AS n, MIN({v}) AS min, MAX({v}) AS max, COUNT(CASE WHEN {v} <= 0 THEN 1 END) AS n_nonpositive,
ROUND(QUANTILE_CONT({v}, 0.05){f}, 4) AS p5, ROUND(QUANTILE_CONT({v}, 0.25){f}, 4) AS p25, ROUND(MEDIAN({v}){f}, 4) AS median,
ROUND(QUANTILE_CONT({v}, 0.75){f}, 4) AS p75, ROUND(QUANTILE_CONT({v}, 0.95){f}, 4) AS p95"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in pf.PROFILE_QUANTILES})


@query("quantile_profile", f"SELECT {PROFILE.format(v='l_extendedprice', f='')} FROM lineitem")
def quantile_profile(t: Tables):
    return _rounded(pf.quantile_profile(t.lineitem, "l_extendedprice"))


@query(
    "quantile_profile_by_group",
    "SELECT l_returnflag, l_linestatus, "
    + PROFILE.format(v="l_extendedprice", f=" FILTER (WHERE l_discount > 0.02)") + " FROM lineitem GROUP BY ALL",
)
def quantile_profile_by_group(t: Tables):
    return _rounded(pf.quantile_profile(
        t.lineitem, "l_extendedprice", ["l_returnflag", "l_linestatus"], F.col("l_discount") > 0.02
    ))


@query(
    "exact_quantiles",
    """SELECT event_type, ROUND(QUANTILE_CONT(value, 0.1), 4) AS p10, ROUND(MEDIAN(value), 4) AS p50,
    ROUND(QUANTILE_CONT(value, 0.999), 4) AS p999 FROM events GROUP BY event_type""",
)
def quantiles(t: Tables):
    out = exact_quantiles(t.events, ["event_type"], "value", {"p10": 0.1, "p50": 0.5, "p999": 0.999})
    return out.withColumns({c: F.round(c, 4) for c in ("p10", "p50", "p999")})


GAPS = "SELECT nullif(l_returnflag, 'N') AS flag, nullif(l_linenumber, 1) AS line, CASE WHEN l_tax > 0.05 THEN l_tax END AS tax FROM lineitem"


@query(
    "null_profile",
    with_ctes(
        """SELECT COUNT(*) AS n_total, COUNT(*) - COUNT(flag) AS n_null_flag, COUNT(*) - COUNT(line) AS n_null_line,
        COUNT(*) - COUNT(tax) AS n_null_tax FROM g""",
        g=GAPS,
    ),
)
def null_profile(t: Tables):
    return pf.null_profile(t.derive(GAPS))


BY_PRIORITY = "SELECT o_orderstatus, o_orderpriority, CAST(o_custkey AS DOUBLE) AS v FROM orders"


@query(
    "category_distribution",
    with_ctes(
        """SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, ROUND(AVG(v), 1) AS avg_value, ROUND(MEDIAN(v), 1) AS median_value,
        ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS percent FROM o GROUP BY o_orderstatus, o_orderpriority""",
        o=BY_PRIORITY,
    ),
)
def category_distribution(t: Tables):
    return pf.category_distribution(t.derive(BY_PRIORITY), ["o_orderstatus", "o_orderpriority"], "v")


@query(
    "cohort_profile",
    """SELECT 'orders' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT o_orderkey) AS unique_orders, COUNT(DISTINCT o_custkey) AS unique_customers FROM orders
    UNION ALL SELECT 'lineitem', COUNT(*), COUNT(DISTINCT l_orderkey), NULL FROM lineitem
    UNION ALL SELECT 'customer', COUNT(*), NULL, COUNT(DISTINCT c_custkey) FROM customer""",
)
def cohort_profile(t: Tables):
    tables = {
        "orders": t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")),
        "lineitem": t.lineitem.select(F.col("l_orderkey").alias("order_id")),
        "customer": t.customer.select(F.col("c_custkey").alias("customer_id")),
    }
    return pf.cohort_profile(tables, {"unique_orders": "order_id", "unique_customers": "customer_id"})


HOLDERS = {
    "customers": "SELECT c_custkey AS id FROM customer", "buyers": "SELECT nullif(o_custkey, 7) AS id FROM orders",
    "visitors": "SELECT user_id AS id FROM events", "suppliers": "SELECT s_suppkey AS id FROM supplier",
}


@query(
    "cohort_overlap",
    " UNION ALL ".join(
        f"SELECT '{a}' AS table_a, '{b}' AS table_b, COUNT(*) AS n_ids FROM (SELECT DISTINCT id FROM ({HOLDERS[a]}) WHERE id IS NOT NULL) x"
        f" WHERE id IN (SELECT id FROM ({HOLDERS[b]}) y WHERE id IS NOT NULL)"
        for i, a in enumerate(HOLDERS) for b in list(HOLDERS)[i:]
    ),
)
def cohort_overlap(t: Tables):
    return pf.id_overlaps({name: t.derive(sql) for name, sql in HOLDERS.items()}, "id")


OLD_NEW = "o_orderpriority AS category FROM orders WHERE"


@query(
    "version_delta",
    f"""SELECT category, o.n AS old_n, w.n AS new_n, w.n - COALESCE(o.n, 0) AS delta FROM
    (SELECT {OLD_NEW.replace('AS category', 'AS category, COUNT(*) AS n')} o_orderdate < '1998-01-01' AND o_orderpriority <> '5-LOW' GROUP BY 1) o
    FULL JOIN (SELECT {OLD_NEW.replace('AS category', 'AS category, COUNT(*) AS n')} o_orderdate >= '1996-01-01' AND o_orderpriority <> '1-URGENT' GROUP BY 1) w
    USING (category)""",
)
def version_delta(t: Tables):
    df = t.orders.select(F.col("o_orderpriority").alias("category"), "o_orderdate")
    old = df.filter("o_orderdate < timestamp_ntz'1998-01-01' AND category <> '5-LOW'")
    new = df.filter("o_orderdate >= timestamp_ntz'1996-01-01' AND category <> '1-URGENT'")
    return pf.version_delta(old, new, "category")


RAW = "SELECT event_type AS category, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ROUND(value / 10, 0) END AS v FROM events"
FILLED = """SELECT CASE event_type WHEN 'error' THEN 'fault' ELSE event_type END AS category,
  CASE WHEN event_id % 21 = 0 THEN NULL ELSE ROUND(value / 10, 0) END AS v FROM events"""


@query(
    "missingness_compare",
    with_ctes(
        """SELECT category, raw_n, raw_null_pct, imputed_n, imputed_null_pct FROM
        (SELECT category, COUNT(*) AS raw_n, ROUND((COUNT(*) - COUNT(v)) * 100.0 / COUNT(*), 2) AS raw_null_pct FROM r GROUP BY 1)
        FULL JOIN (SELECT category, COUNT(*) AS imputed_n, ROUND((COUNT(*) - COUNT(v)) * 100.0 / COUNT(*), 2) AS imputed_null_pct FROM f GROUP BY 1)
        USING (category)""",
        r=RAW, f=FILLED,
    ),
)
def missingness_compare(t: Tables):
    out = pf.missingness_compare(t.derive(RAW), t.derive(FILLED), "category", "v")
    return out.withColumns({c: F.col(c).cast("double") for c in ("raw_null_pct", "imputed_null_pct")})


@query(
    "value_distributions",
    with_ctes(
        """SELECT category, v, COUNT(*) AS n, 'raw' AS version FROM r WHERE v IS NOT NULL GROUP BY category, v
        UNION ALL SELECT category, v, COUNT(*), 'imputed' FROM f WHERE v IS NOT NULL GROUP BY category, v""",
        r=RAW, f=FILLED,
    ),
)
def value_distributions(t: Tables):
    return pf.value_distributions({"raw": t.derive(RAW), "imputed": t.derive(FILLED)}, "category", "v")
