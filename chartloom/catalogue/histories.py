"""De-duplication, ranking, running-state and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalogue.base import Tables, query, with_ctes
from chartloom.operators import reshape as rs
from chartloom.operators import windows as wn


@query("dedup_exact", "SELECT DISTINCT user_id, event_type, date_trunc('day', ts) AS day FROM events")
def dedup_exact(t: Tables):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    return wn.dedup_exact(t.events.select("user_id", "event_type", day))


DAILY = "SELECT CASE WHEN user_id % 12 = 0 THEN NULL ELSE user_id END AS user_id, event_type, date_trunc('day', ts) AS day, event_id, ts, value FROM events"


@query(
    "dedup_keys",
    with_ctes(
        """SELECT user_id, event_type, day, event_id, ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts, event_id) AS r FROM d) WHERE r = 1""",
        d=DAILY,
    ),
)
def dedup_keys(t: Tables):
    return wn.dedup_keys(t.derive(DAILY), ["user_id", "event_type", "day"], ["ts", "event_id"])


RESULTS = """
SELECT l_orderkey AS hadm_id, l_partkey % 3 AS category, l_quantity AS v, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS result_at,
  l_suppkey, l_linenumber FROM lineitem"""


@query(
    "distinct_on",
    with_ctes(
        """SELECT hadm_id, category, v, result_at, l_suppkey, l_linenumber FROM (
        SELECT *, row_number() OVER (PARTITION BY hadm_id, category ORDER BY result_at, l_linenumber, l_suppkey, v) AS r
        FROM x WHERE result_at IS NOT NULL) WHERE r = 1""",
        x=RESULTS,
    ),
)
def distinct_on(t: Tables):
    return wn.distinct_on(
        t.derive(RESULTS), ["hadm_id", "category"], "result_at", ["result_at", "l_linenumber", "l_suppkey", "v"]
    )


# ids of some users are shifted on one side, so that both sides have ids of their own
LEFT_TIMES = "SELECT CASE WHEN user_id % 3 > 0 THEN user_id ELSE -user_id END AS id, CASE WHEN event_type = 'error' THEN ts END AS deathtime FROM events"
RIGHT_TIMES = """SELECT CASE WHEN user_id % 4 > 0 THEN user_id ELSE user_id + 1000000 END AS id,
  CASE WHEN event_type = 'signup' AND user_id % 5 > 0 THEN ts END AS dod FROM events"""


@query(
    "distinct_on_ordered",
    with_ctes(
        """SELECT id, died FROM (SELECT id, died, row_number() OVER (PARTITION BY id ORDER BY died) AS r FROM (
          SELECT id, COALESCE(deathtime, dod) AS died FROM (SELECT DISTINCT * FROM l WHERE deathtime IS NOT NULL) FULL JOIN r USING (id))
        WHERE died IS NOT NULL) WHERE r = 1""",
        l=LEFT_TIMES, r=RIGHT_TIMES,
    ),
)
def distinct_on_ordered(t: Tables):
    return wn.earliest_of(t.derive(LEFT_TIMES), t.derive(RIGHT_TIMES), "id", "deathtime", "dod", "died")


@query(
    "qualify_row_number",
    """SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def qualify_row_number(t: Tables):
    df = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return wn.qualify_first(df, ["o_custkey", "o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"])


RANKING = ["purchase", "signup", "click", "view"]
READINGS = """
SELECT user_id AS hadm_id, date_trunc('day', ts) AS time, event_id % 2 AS itemid, event_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS category FROM events"""
RANKED_SQL = """, k AS (SELECT *, CASE category WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3 WHEN 'view' THEN 4 END AS pos FROM x),
    top AS (SELECT *, row_number() OVER (PARTITION BY hadm_id, time, itemid ORDER BY pos, event_id) AS pr FROM k
      WHERE itemid = 1 AND category IS NOT NULL),
    kept AS (SELECT hadm_id, time, itemid, event_id, category FROM top WHERE pr = 1
      UNION ALL SELECT hadm_id, time, itemid, event_id, category FROM k WHERE NOT (itemid = 1 AND category IS NOT NULL))
    """


@query(
    "ranked_device_dedup",
    with_ctes("{}", x=READINGS).replace(" {}", RANKED_SQL)
    + """SELECT hadm_id, time, itemid, event_id, category FROM (
      SELECT *, row_number() OVER (PARTITION BY hadm_id, time, itemid ORDER BY event_id) AS r FROM kept) WHERE r = 1""",
)
def ranked_device_dedup(t: Tables):
    return wn.ranked_dedup(
        t.derive(READINGS), ["hadm_id", "time", "itemid"], F.col("itemid") == 1, "category", RANKING, ["event_id"]
    )


@query(
    "ranked_device_dedup_excluding",
    with_ctes("{}", x=READINGS).replace(" {}", RANKED_SQL)
    + """SELECT hadm_id, time, itemid, event_id, category FROM (
      SELECT *, row_number() OVER (PARTITION BY hadm_id, time, itemid ORDER BY event_id) AS r FROM (
        SELECT *, COUNT(*) OVER (PARTITION BY hadm_id, time, itemid) AS n FROM kept) WHERE NOT (n > 1 AND hadm_id = 41)) WHERE r = 1""",
)
def ranked_device_dedup_excluding(t: Tables):
    return wn.ranked_dedup(
        t.derive(READINGS), ["hadm_id", "time", "itemid"], F.col("itemid") == 1, "category", RANKING, ["event_id"],
        exclude=F.col("hadm_id") == 41,
    )


UNITS = """
SELECT event_id, CASE WHEN user_id % 12 = 0 THEN NULL ELSE user_id END AS user_id, event_type, ts,
  CASE WHEN event_id % 3 > 0 THEN NULL ELSE CAST(event_id % 8 AS STRING) END AS unit FROM events"""


@query(
    "running_last_non_null",
    with_ctes(
        """SELECT event_id, user_id, event_type, ts, unit, LAST_VALUE(unit IGNORE NULLS) OVER (
        PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_unit FROM u""",
        u=UNITS,
    ),
)
def running_last_non_null(t: Tables):
    return wn.running_last_non_null(t.derive(UNITS), ["user_id", "event_type"], ["ts", "event_id"], "unit", "last_unit")


@query(
    "running_any",
    with_ctes(
        """SELECT event_id, user_id, ts, bool_or(event_type = 'purchase' AND unit = '3') OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ever FROM
        (SELECT event_id, user_id, ts, event_type, COALESCE(unit, '') AS unit FROM u)""",
        u=UNITS,
    ),
)
def running_any(t: Tables):
    df = t.derive(UNITS)
    flag = (F.col("event_type") == "purchase") & (F.coalesce("unit", F.lit("")) == "3")
    return wn.running_any(df, ["user_id"], ["ts", "event_id"], flag, "ever").select("event_id", "user_id", "ts", "ever")


@query(
    "sequence_label",
    with_ctes(
        """SELECT event_id, user_id, event_type, rn, CASE WHEN rn = 1 THEN '[Started]' ELSE '[Restarted]' END AS label FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM u)""",
        u=UNITS,
    ),
)
def sequence_label(t: Tables):
    df = wn.sequence_number(t.derive(UNITS), ["user_id", "event_type"], ["ts", "event_id"])
    label = F.when(F.col("rn") == 1, "[Started]").otherwise("[Restarted]")
    return df.select("event_id", "user_id", "event_type", "rn", label.alias("label"))


DAY_KINDS = "SELECT event_id, CASE WHEN user_id % 12 = 0 THEN NULL ELSE user_id END AS user_id, date_trunc('day', ts) AS day, nullif(event_type, 'error') AS kind FROM events"


@query(
    "window_string_agg",
    with_ctes(
        "SELECT event_id, user_id, day, kind, s AS kinds FROM d JOIN (SELECT user_id AS u2, day AS d2, STRING_AGG(kind, ', ' ORDER BY kind) AS s FROM d GROUP BY ALL) "
        "ON user_id IS NOT DISTINCT FROM u2 AND day = d2",
        d=DAY_KINDS,
    ),
)
def window_string_agg(t: Tables):
    return wn.window_string_agg(t.derive(DAY_KINDS), ["user_id", "day"], "kind", "kinds")


@query(
    "window_string_agg_distinct",
    with_ctes(
        """SELECT event_id, user_id, day, kind, s AS concurrent, n AS n_concurrent FROM d JOIN (
        SELECT user_id AS u2, day AS d2, STRING_AGG(DISTINCT kind, '; ' ORDER BY kind) AS s, COUNT(DISTINCT kind) AS n FROM d GROUP BY ALL)
        ON user_id IS NOT DISTINCT FROM u2 AND day = d2 WHERE n > 1""",
        d=DAY_KINDS,
    ),
)
def window_string_agg_distinct(t: Tables):
    return wn.concurrent_values(t.derive(DAY_KINDS), ["user_id", "day"], "kind", "concurrent")


@query(
    "partition_count",
    with_ctes("SELECT *, COUNT(*) OVER (PARTITION BY user_id, kind) AS n FROM d", d=DAY_KINDS),
)
def partition_count(t: Tables):
    return wn.partition_count(t.derive(DAY_KINDS), ["user_id", "kind"])


@query(
    "deprioritised_first",
    """SELECT p_brand, p_type FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand
    ORDER BY CASE WHEN p_type ILIKE '%econ%' THEN 9 ELSE 1 END, p_type) AS r FROM part) WHERE r = 1""",
)
def deprioritised_first(t: Tables):
    return wn.deprioritised_first(t.part.select("p_brand", "p_type"), "p_brand", "p_type", "Econ")


INTERVALS = "SELECT event_id, user_id, event_type, ts AS starttime, ts + (event_id % 700) * INTERVAL '1' MINUTE AS endtime FROM events"


@query(
    "overlap_check",
    with_ctes(
        """SELECT event_id, user_id, event_type, starttime, endtime, endtime_prev FROM (
        SELECT *, LAG(endtime) OVER (PARTITION BY user_id, event_type ORDER BY starttime, event_id) AS endtime_prev FROM i)
        WHERE starttime < endtime_prev""",
        i=INTERVALS,
    ),
)
def overlap_check(t: Tables):
    return wn.overlap_check(t.derive(INTERVALS), ["user_id", "event_type"], "starttime", "endtime", ["event_id"])


@query(
    "find_duplicates",
    with_ctes("SELECT * EXCLUDE (n) FROM (SELECT *, COUNT(*) OVER (PARTITION BY user_id, day, kind) AS n FROM d) WHERE n > 1", d=DAY_KINDS),
)
def find_duplicates(t: Tables):
    return wn.find_duplicates(t.derive(DAY_KINDS), ["user_id", "day", "kind"])


HARMONISED = "SELECT user_id AS hospitalization_id, date_trunc('hour', ts) AS recorded_dttm, event_type AS category, event_id FROM events"


@query(
    "check_duplicates",
    with_ctes(
        "SELECT * EXCLUDE (n) FROM (SELECT *, COUNT(*) OVER (PARTITION BY hospitalization_id, recorded_dttm, category) AS n FROM h) WHERE n > 1",
        h=HARMONISED,
    ),
)
def check_duplicates(t: Tables):
    return wn.check_duplicates(t.derive(HARMONISED), ["category"])


ONE_PER_CELL = "SELECT user_id, date_trunc('day', ts) AS day, event_type, MAX(value) AS v, MIN(event_id) AS first_id FROM events GROUP BY 1, 2, 3"
TYPES = ["view", "click", "purchase", "signup", "error"]
WIDE_SQL = ", ".join(f"MAX(CASE WHEN event_type = '{k}' THEN v END) AS {k}" for k in TYPES)


@query("pivot_unique", with_ctes(f"SELECT user_id, day, {WIDE_SQL} FROM s GROUP BY user_id, day", s=ONE_PER_CELL))
def pivot_unique(t: Tables):
    return rs.pivot_unique(t.derive(ONE_PER_CELL), ["user_id", "day"], "event_type", "v", TYPES)


DAYS = "SELECT user_id, date_trunc('day', ts) AS day, event_type, ts, event_id, value AS v FROM events"
FIRST_SQL = ", ".join(
    f"(ARRAY_AGG(v ORDER BY ts, event_id) FILTER (WHERE event_type = '{k}'))[1] AS {k}" for k in TYPES
)


@query("pivot_first", with_ctes(f"SELECT user_id, day, {FIRST_SQL} FROM d GROUP BY user_id, day", d=DAYS))
def pivot_first(t: Tables):
    return rs.pivot_first(t.derive(DAYS), ["user_id", "day"], "event_type", "v", TYPES, ["ts", "event_id"])


@query("pivot_max", with_ctes(f"SELECT user_id, day, {WIDE_SQL} FROM d GROUP BY user_id, day", d=DAYS))
def pivot_max(t: Tables):
    return rs.pivot_max(t.derive(DAYS), ["user_id", "day"], "event_type", "v", TYPES)


WIDE = f"SELECT user_id, day, {WIDE_SQL} FROM ({DAYS}) d GROUP BY user_id, day"


@query(
    "unpivot_drop_nulls",
    with_ctes(f"UNPIVOT w ON {', '.join(TYPES)} INTO NAME kind VALUE v", w=WIDE),
)
def unpivot_drop_nulls(t: Tables):
    return rs.unpivot_drop_nulls(t.derive(WIDE), ["user_id", "day"], TYPES, "kind", "v")


@query(
    "melt_keep_nulls",
    with_ctes(" UNION ALL ".join(f"SELECT user_id, day, '{k}' AS kind, {k} AS v FROM w" for k in TYPES), w=WIDE),
)
def melt_keep_nulls(t: Tables):
    return rs.melt_keep_nulls(t.derive(WIDE), ["user_id", "day"], TYPES, "kind", "v")


@query(
    "coalesce_columns",
    with_ctes("SELECT user_id, day, COALESCE(view, click, purchase) AS seen, COALESCE(signup, error) AS other FROM w", w=WIDE),
)
def coalesce_columns(t: Tables):
    return rs.coalesce_columns(
        t.derive(WIDE), {"seen": ["view", "click", "purchase"], "other": ["signup", "error"]}
    )


SPANS = "SELECT o_orderkey, o_orderdate AS starttime, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END AS endtime, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey"


@query(
    "interval_to_points",
    with_ctes(
        """SELECT o_orderkey, l_linenumber, 'starttime' AS timestamp_type, starttime AS admin_dttm FROM s
        UNION ALL SELECT o_orderkey, l_linenumber, 'endtime', endtime FROM s WHERE endtime IS NOT NULL""",
        s=SPANS,
    ),
)
def interval_to_points(t: Tables):
    return rs.interval_to_points(t.derive(SPANS), "starttime", "endtime")


CULTURES = "SELECT o_custkey, o_orderstatus AS drug, o_orderpriority AS susceptibility FROM orders"


@query(
    "pivot_wide_fill_null",
    with_ctes(
        "SELECT o_custkey, MIN(CASE WHEN drug = 'F' THEN susceptibility END) AS F, MIN(CASE WHEN drug = 'O' THEN susceptibility END) AS O, "
        "MIN(CASE WHEN drug = 'P' THEN susceptibility END) AS P FROM c GROUP BY o_custkey",
        c=CULTURES,
    ),
)
def pivot_wide_fill_null(t: Tables):
    return rs.pivot_wide_fill_null(t.derive(CULTURES), ["o_custkey"], "drug", "susceptibility", ["F", "O", "P"])

