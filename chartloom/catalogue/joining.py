"""Mapping joins, outer joins, look-back, as-of and cohort queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalogue import shapes
from chartloom.catalogue.base import Tables, Vocabulary, query, with_ctes
from chartloom.operators import joins
from chartloom.plans import cohort

EXCLUDED = "('NO MAPPING', 'UNSURE', 'MAPPED ELSEWHERE', 'ALREADY MAPPED', 'NOT AVAILABLE')"
LOOKUP = f"""
SELECT event_type AS key, CASE WHEN category = 'NO MAPPING' THEN NULL ELSE category END AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY _ordinal DESC) AS r
  FROM tm WHERE decision NOT IN {EXCLUDED}) WHERE r = 1"""


def _lookup(t: Tables):
    return joins.value_map(shapes.TYPE_MAP.df(t), "event_type", "category")


@query(
    "dict_map",
    with_ctes(
        "SELECT event_id, event_type, value AS v, k.cat AS category FROM events LEFT JOIN (SELECT key, value AS cat FROM lk) k ON event_type = k.key",
        tm=shapes.TYPE_MAP.sql, lk=LOOKUP,
    ),
)
def dict_map(t: Tables):
    df = t.events.select("event_id", "event_type", F.col("value").alias("v"))
    return joins.dict_map(df, _lookup(t), "event_type", "category")


NULLED = "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS kind FROM events"


@query(
    "dict_map_default",
    with_ctes(
        """SELECT event_id, kind, CASE WHEN kind IS NULL THEN 'Unknown' ELSE k.value END AS category
        FROM n LEFT JOIN lk k ON kind = k.key""",
        tm=shapes.TYPE_MAP.sql, lk=LOOKUP, n=NULLED,
    ),
)
def dict_map_default(t: Tables):
    return joins.dict_map_default(t.derive(NULLED), _lookup(t), "kind", "category", "Unknown")


PADDED = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ' ' || kind ELSE kind || '  ' END AS kind FROM (
SELECT event_id, CASE event_type WHEN 'signup' THEN 'view' ELSE event_type END AS kind FROM events) e"""


@query(
    "strict_dict_map",
    with_ctes(
        "SELECT event_id, kind, k.value AS category FROM p LEFT JOIN lk k ON trim(kind) = k.key",
        tm=shapes.TYPE_MAP.sql, lk=LOOKUP, p=PADDED,
    ),
)
def strict_dict_map(t: Tables):
    return joins.strict_dict_map(t.derive(PADDED), _lookup(t), "kind", "category")


@query(
    "left_join_filtered_dim",
    with_ctes(
        """SELECT event_id, c.itemid, m.variable, m.decision FROM c
        LEFT JOIN m ON c.itemid = m.itemid AND m.decision IN ('TO MAP', 'UNSURE')""",
        c=shapes.CHART, m=shapes.MAPPING.sql,
    ),
)
def left_join_filtered_dim(t: Tables):
    dim = shapes.MAPPING.df(t).select("itemid", "variable", "decision")
    df = t.derive(shapes.CHART).select("event_id", "itemid")
    return joins.left_join_filtered_dim(df, dim, "itemid", F.col("decision").isin("TO MAP", "UNSURE"))


ORDER_ROWS = """
SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS a,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_linestatus END AS b,
  CASE WHEN l_quantity < 25 THEN 'low' END AS c, l_partkey % 5 AS item FROM lineitem"""
ROUTES = Vocabulary("a string, b string, c string, route string", [
    ("A", "F", "low", "iv"), ("A", None, "low", "im"), (None, "O", None, "iv"), (None, None, "low", "SPECIAL"),
    ("R", None, None, "UNINFORMATIVE"), ("R", "F", None, "enteral"),
])
SPECIAL = Vocabulary("a string, c string, item bigint, route string", [
    (None, "low", 0, "iv"), (None, "low", 1, "im"), ("R", None, 2, "enteral"), ("A", "low", 3, "never"),
])


@query(
    "multi_key_null_safe_join",
    with_ctes(
        """SELECT o.l_orderkey, o.l_linenumber, o.a, o.b, o.c, o.item, COALESCE(r.route, s.route) AS route FROM o
        LEFT JOIN r ON o.a IS NOT DISTINCT FROM r.a AND o.b IS NOT DISTINCT FROM r.b AND o.c IS NOT DISTINCT FROM r.c
            AND r.route NOT IN ('SPECIAL', 'UNINFORMATIVE')
        LEFT JOIN s ON o.a IS NOT DISTINCT FROM s.a AND o.b IS NULL AND o.c IS NOT DISTINCT FROM s.c AND o.item = s.item""",
        o=ORDER_ROWS, r=ROUTES.sql, s=SPECIAL.sql,
    ),
)
def multi_key_null_safe_join(t: Tables):
    return joins.two_step_null_safe_lookup(
        t.derive(ORDER_ROWS), ROUTES.df(t), SPECIAL.df(t), ["a", "b", "c"], "route",
        ~F.col("route").isin("SPECIAL", "UNINFORMATIVE"), ["a", "c", "item"], F.col("b").isNull(),
    )


@query(
    "inner_join_dim",
    with_ctes(
        """SELECT event_id, c.itemid, hadm_id, value, m.variable, m.category FROM c JOIN m USING (itemid)
        WHERE m.decision = 'TO MAP' AND hadm_id IS NOT NULL AND value IS NOT NULL""",
        c=shapes.CHART, m=shapes.MAPPING.sql,
    ),
)
def inner_join_dim(t: Tables):
    dim = shapes.MAPPING.df(t).filter("decision = 'TO MAP'").select("itemid", "variable", "category")
    df = t.derive(shapes.CHART).select("event_id", "itemid", "hadm_id", "value")
    return joins.inner_join_dim(df, dim, "itemid", ["hadm_id", "value"])


TYPES_BY_BRAND = Vocabulary("size int, kind string, grade string", [
    (11, "ECONOMY ", "a"), (11, " SMALL", "b"), (28, "ECONOMY", "c"), (5, "SMALL", "d"), (5, " PROMO ", "e"),
])
PART_KINDS = "SELECT p_partkey, p_size AS size, CASE WHEN p_partkey % 2 = 0 THEN p_type || ' ' ELSE p_type END AS kind FROM part"


@query(
    "left_join_trim_key",
    with_ctes(
        """SELECT p.p_partkey, p.size, p.kind, d.grade FROM p
        LEFT JOIN d ON p.size = d.size AND trim(p.kind) = trim(d.kind)""",
        p=PART_KINDS, d=TYPES_BY_BRAND.sql,
    ),
)
def left_join_trim_key(t: Tables):
    dim = TYPES_BY_BRAND.df(t).drop("_ordinal")
    return joins.left_join_trim_key(t.derive(PART_KINDS), dim, ["size"], "kind")


CLICKS = "SELECT CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id END AS user_id, date_trunc('day', ts) AS day, COUNT(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1, 2"
BUYS = "SELECT CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id END AS user_id, date_trunc('day', ts) AS day, MAX(value) AS top FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"


@query(
    "full_outer_coalesce",
    with_ctes(
        """SELECT COALESCE(c.user_id, b.user_id) AS user_id, COALESCE(c.day, b.day) AS day, clicks, top,
        CASE WHEN top IS NULL THEN 'none' WHEN top > 50 THEN 'high' ELSE 'low' END AS grade
        FROM c FULL JOIN b ON c.user_id = b.user_id AND c.day = b.day""",
        c=CLICKS, b=BUYS,
    ),
)
def full_outer_coalesce(t: Tables):
    both = joins.full_outer_coalesce(t.derive(CLICKS), t.derive(BUYS), ["user_id", "day"])
    top = F.col("top")
    return both.withColumn("grade", F.when(top.isNull(), "none").when(top > 50, "high").otherwise("low"))


KINDS = {"view": "COUNT(*)", "click": "MAX(value)", "purchase": "MIN(value)", "signup": "MAX(event_type)"}


def _per_user(kind: str, value: str) -> str:
    # every second kind has even keys only, so that each side has keys without a partner
    key = f"user_id * {1 + list(KINDS).index(kind) % 2}"
    return f"SELECT {key} AS user_id, {value} AS {kind}_v FROM events WHERE event_type = '{kind}' GROUP BY {key}"



@query(
    "full_outer_chain",
    with_ctes(
        """SELECT user_id, view_v, click_v, purchase_v, COALESCE(signup_v, 'Unknown') AS signup_v
        FROM a FULL JOIN b USING (user_id) FULL JOIN c USING (user_id) FULL JOIN d USING (user_id)""",
        **{alias: _per_user(k, v) for alias, (k, v) in zip("abcd", KINDS.items())},
    ),
)
def full_outer_chain(t: Tables):
    frames = [t.derive(_per_user(k, v)) for k, v in KINDS.items()]
    return joins.full_outer_chain(frames, "user_id", {"signup_v": "Unknown"})


@query(
    "outer_merge",
    with_ctes(
        """SELECT COALESCE(c.user_id, b.user_id) AS user_id, COALESCE(c.day, b.day) AS day, clicks, top
        FROM c FULL JOIN b ON c.user_id IS NOT DISTINCT FROM b.user_id AND c.day IS NOT DISTINCT FROM b.day""",
        c=CLICKS, b=BUYS,
    ),
)
def outer_merge(t: Tables):
    return joins.outer_merge(t.derive(CLICKS), t.derive(BUYS), ["user_id", "day"])


STAYS = "SELECT event_id, ts, CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS stay, event_type, value AS v FROM events"


@query(
    "lookback_self_join",
    with_ctes(
        """SELECT b.event_id, b.ts, b.stay, b.event_type, b.v, p.v AS v_prev, p.event_id AS event_id_prev FROM r b
        LEFT JOIN r p ON b.stay = p.stay AND b.rn = p.rn + 1 AND p.ts > b.ts - INTERVAL '6' HOUR""",
        s=STAYS, r="SELECT *, row_number() OVER (PARTITION BY stay ORDER BY ts, event_id) AS rn FROM s",
    ),
)
def lookback_self_join(t: Tables):
    return joins.lookback(t.derive(STAYS), ["stay"], ["ts", "event_id"], ["v", "event_id"], hours=6)


BUY_TIMES = "SELECT event_id AS buy_id, user_id, ts AS time_out FROM events WHERE event_type = 'purchase'"
CLICK_TIMES = "SELECT event_id AS click_id, user_id, ts AS time_in FROM events WHERE event_type = 'click'"
GAP = "ROUND(EXTRACT(EPOCH FROM (time_out - time_in)) / 3600, 2)"
ASOF = """SELECT b.buy_id, b.user_id, b.time_out, c.click_id, c.time_in, {gap} AS gap_hrs FROM b
{kind} JOIN c ON b.user_id = c.user_id AND b.time_out >= c.time_in"""


def _asof(t: Tables, how: str):
    out = joins.asof_join(
        t.derive(BUY_TIMES), t.derive(CLICK_TIMES), ["user_id"], "time_out", "time_in", ["click_id"], how
    )
    micros = F.unix_micros(F.col("time_out").cast("timestamp")) - F.unix_micros(F.col("time_in").cast("timestamp"))
    return out.withColumn("gap_hrs", F.round(micros / 3_600_000_000, 2))


@query("asof_join", with_ctes(ASOF.format(kind="ASOF", gap=GAP), b=BUY_TIMES, c=CLICK_TIMES))
def asof_join(t: Tables):
    return _asof(t, "inner")


@query("asof_join_left", with_ctes(ASOF.format(kind="ASOF LEFT", gap=GAP), b=BUY_TIMES, c=CLICK_TIMES))
def asof_join_left(t: Tables):
    return _asof(t, "left")


@query(
    "semi_join_cohort",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def semi_join_cohort(t: Tables):
    cohort = t.customer.filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return joins.semi_join_cohort(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), cohort, "o_custkey")


@query(
    "right_join_cohort",
    """SELECT o_orderkey, o_custkey, c_custkey FROM orders RIGHT JOIN
    (SELECT c_custkey FROM customer WHERE c_acctbal < 5000) c ON o_custkey = c_custkey""",
)
def right_join_cohort(t: Tables):
    ids = t.customer.filter("c_acctbal < 5000").select("c_custkey")
    return joins.right_join_cohort(t.orders.select("o_orderkey", "o_custkey"), ids, "o_custkey", "c_custkey")


VISITS = "SELECT CAST(o_custkey AS STRING) AS patient_id, CAST(o_orderkey AS STRING) AS hospitalization_id FROM orders"
LISTED = "SELECT CAST(c_custkey AS STRING) AS listed_id FROM customer WHERE c_mktsegment = 'MACHINERY'"
LINES = "SELECT CAST(l_orderkey AS STRING) AS hospitalization_id, l_linenumber, l_quantity FROM lineitem"


@query(
    "plan_cohort_extract",
    with_ctes(
        """SELECT 'lines' AS table_name, COUNT(*) AS n, ROUND(SUM(l_quantity), 1) AS total FROM l WHERE hospitalization_id IN
          (SELECT hospitalization_id FROM v JOIN c ON patient_id = listed_id)
        UNION ALL SELECT 'persons', COUNT(*), NULL FROM (SELECT DISTINCT patient_id FROM v) WHERE patient_id IN (SELECT listed_id FROM c)""",
        v=VISITS, c=LISTED, l=LINES,
    ),
)
def cohort_extract(t: Tables):
    visits = t.derive(VISITS)
    ids = cohort.cohort_ids(visits, t.derive(LISTED), "listed_id")
    parts = cohort.extract({"lines": t.derive(LINES), "persons": visits.select("patient_id").distinct()}, ids)
    lines = parts["lines"].agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 1).alias("total"))
    persons = parts["persons"].agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("total"))
    return lines.select(F.lit("lines").alias("table_name"), "n", "total").unionByName(
        persons.select(F.lit("persons").alias("table_name"), "n", "total")
    )


@query(
    "plan_scale_up",
    with_ctes(
        "SELECT patient_id || s.x AS patient_id, hospitalization_id || s.x AS hospitalization_id FROM v CROSS JOIN (SELECT unnest(['A', 'B', 'C']) AS x) s",
        v=VISITS,
    ),
)
def scale_up(t: Tables):
    return cohort.scale_up({"hospitalization": t.derive(VISITS)}, copies=3)["hospitalization"]


@query(
    "cross_join_replicate",
    """SELECT CAST(o_orderkey AS VARCHAR) || s.x AS o_orderkey, CAST(o_custkey AS VARCHAR) || s.x AS o_custkey, o_totalprice
    FROM orders CROSS JOIN (SELECT unnest(['A', 'B', 'C', 'D']) AS x) s""",
)
def cross_join_replicate(t: Tables):
    df = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.replicate(df, ["A", "B", "C", "D"], ["o_orderkey", "o_custkey"])


CATEGORIES = ["big ring", "blue bolts", "green widget", "large gear", "red widget", "small rings", "tiny gear"]


@query(
    "fuzzy_match",
    with_ctes(
        """SELECT p_name, CASE WHEN score >= 80 THEN c END AS category, ROUND(score, 4) AS score FROM (
          SELECT p_name, c, score, row_number() OVER (PARTITION BY p_name ORDER BY score DESC, c) AS r FROM (
            SELECT p_name, c, 100.0 * (1 - CAST(levenshtein(lower(p_name), lower(c)) AS DOUBLE) / greatest(length(p_name), length(c))) AS score
            FROM n CROSS JOIN cats)) WHERE r = 1""",
        n="SELECT DISTINCT p_name FROM part",
        cats="SELECT unnest([" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]) AS c",
    ),
)
def fuzzy_match(t: Tables):
    return joins.fuzzy_match(t.part, "p_name", CATEGORIES).withColumn("score", F.round("score", 4))


def _words(table: str) -> str:
    """Different words of six letters or more of a table's texts, in both engines."""
    return f"SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{6,}}')) AS w FROM {table})"


@query(
    "fuzzy_match_table",
    with_ctes(
        """SELECT n.w AS name, arg_min(c.w, (-score, c.w)) FILTER (WHERE score >= 80) AS category,
          ROUND(MAX(score) FILTER (WHERE score >= 80), 4) AS score
        FROM (SELECT n.w AS a, c.w AS b, 100.0 * (1 - CAST(levenshtein(n.w, c.w) AS DOUBLE) / greatest(length(n.w), length(c.w))) AS score FROM n CROSS JOIN c) x
        JOIN n ON n.w = a JOIN c ON c.w = b GROUP BY n.w""",
        n=_words("conversations"), c=_words("benchmark"),
    ),
)
def fuzzy_match_table(t: Tables):
    """A long category table: the words of one table against those of another, through the segment index."""

    def words(df):
        found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0)))
        return df.select(found.alias("name")).distinct()

    out = joins.fuzzy_match(words(t.conversations), "name", words(t.benchmark))
    return out.select("name", "category", F.round("score", 4).alias("score"))
