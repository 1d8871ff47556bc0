"""Stand-in facts derived from the driver tables, each with the Spark
builder and the equivalent SQL (used inside the oracle queries).

  province   = nation (n_nationkey, n_name), country = region
  lodging    = lineitem at (supplier, ship month, return flag):
               weekday / weekend mean price by the ship day
  activity   = lineitem x part: category p_type, entry price p_retailprice,
               spend l_extendedprice, at the supplier's nation
  plans      = orders: start o_orderdate, end start + o_orderkey % 15 days,
               budget o_totalprice, lodging category from o_orderkey % 3
  stops      = (order, line number) -> smallest supplier nation
  prefs      = (order, p_type) -> number of lines
  ledger     = events: plan = user_id, category = event_type, amount = value
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..tables import Tables

# Stand-in for the cost-group rule: category (lower, trimmed) -> group.
COST_GROUPS = {"promo": "alimentacion", "standard": "servicios", "large": "otros"}
FOOD_CATEGORY = "PROMO"
LODGING_CATEGORIES = ("A", "N", "R")


def provinces(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("province_id"), F.col("n_name").alias("province_name"),
                           F.col("n_regionkey").alias("country_id"))


PROVINCES_SQL = """SELECT n_nationkey AS province_id, n_name AS province_name, n_regionkey AS country_id FROM nation"""


def countries(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country_name"))


COUNTRIES_SQL = """SELECT r_regionkey AS country_id, r_name AS country_name FROM region"""


def lodging_fact(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_suppkey", "l_shipdate", "l_returnflag", "l_extendedprice", "l_quantity")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    we = D.is_weekend_night("l_shipdate")
    return j.groupBy(
        F.col("n_regionkey").alias("country_id"), F.col("s_nationkey").alias("province_id"),
        F.col("l_suppkey").alias("supplier_id"), F.month("l_shipdate").alias("month"),
        F.col("l_returnflag").alias("category"),
    ).agg(
        F.avg(F.when(~we, F.col("l_extendedprice"))).alias("weekday_price"),
        F.avg(F.when(we, F.col("l_extendedprice"))).alias("weekend_price"),
        F.count(F.lit(1)).alias("n_lines"),
        (F.avg("l_quantity") / 10).alias("rating"),
    )


LODGING_FACT_SQL = """
SELECT n.n_regionkey AS country_id, s.s_nationkey AS province_id, l.l_suppkey AS supplier_id,
       CAST(month(l.l_shipdate) AS INTEGER) AS month, l.l_returnflag AS category,
       AVG(CASE WHEN NOT (dayofweek(l.l_shipdate) IN (5, 6)) THEN l.l_extendedprice END) AS weekday_price,
       AVG(CASE WHEN dayofweek(l.l_shipdate) IN (5, 6) THEN l.l_extendedprice END) AS weekend_price,
       COUNT(*) AS n_lines, AVG(l.l_quantity) / 10 AS rating
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2, 3, 4, 5
"""


def activity_fact(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                           "l_discount")
    p = t.part.select("p_partkey", "p_type", "p_brand", "p_retailprice")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    j = (li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
         .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("n_regionkey").alias("country_id"), F.col("s_nationkey").alias("province_id"),
        F.month("l_shipdate").alias("month"), F.col("p_type").alias("category"), F.col("p_brand").alias("product"),
        F.col("p_retailprice").alias("entry_price"), F.col("l_extendedprice").alias("total_spend"),
        F.col("l_quantity").alias("opinions"),
        F.when(F.col("l_orderkey") % 10 != 0, F.col("l_discount") * 50).alias("rating"),
    )


ACTIVITY_FACT_SQL = """
SELECT n.n_regionkey AS country_id, s.s_nationkey AS province_id, CAST(month(l.l_shipdate) AS INTEGER) AS month,
       p.p_type AS category, p.p_brand AS product, p.p_retailprice AS entry_price,
       l.l_extendedprice AS total_spend, l.l_quantity AS opinions,
       CASE WHEN l.l_orderkey % 10 = 0 THEN NULL ELSE l.l_discount * 50 END AS rating
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
"""


def stops(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .groupBy(F.col("l_orderkey").alias("plan_id"), F.col("l_linenumber").alias("stop_order"))
            .agg(F.min("s_nationkey").alias("province_id")))


STOPS_SQL = """
SELECT l.l_orderkey AS plan_id, l.l_linenumber AS stop_order, MIN(s.s_nationkey) AS province_id
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2
"""


def prefs(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .groupBy(F.col("l_orderkey").alias("plan_id"), F.col("p_type").alias("category"))
            .agg(F.count(F.lit(1)).alias("quantity")))


PREFS_SQL = """
SELECT l.l_orderkey AS plan_id, p.p_type AS category, COUNT(*) AS quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2
"""


def plans(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    main = stops(t).filter(F.col("stop_order") == 1).select("plan_id", F.col("province_id").alias("__p"))
    dest = main.join(n.select(F.col("n_nationkey").alias("__p"), F.col("n_regionkey").alias("__dc")), "__p")
    start = F.col("o_orderdate").cast("date")
    cat = F.element_at(F.array(*[F.lit(x) for x in LODGING_CATEGORIES]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    base = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(dest.select(F.col("plan_id").alias("o_orderkey"), "__dc"), "o_orderkey", "left"))
    return base.select(
        F.col("o_orderkey").alias("plan_id"), F.col("o_custkey").alias("user_id"),
        F.col("n_regionkey").alias("origin_country_id"),
        F.coalesce(F.col("__dc"), F.col("n_regionkey")).alias("dest_country_id"),
        start.alias("start_date"), F.date_add(start, (F.col("o_orderkey") % 15).cast("int")).alias("end_date"),
        F.col("o_totalprice").alias("budget"), F.lit("Solo").alias("trip_type"), cat.alias("lodging_category"),
        F.col("o_orderdate").alias("created_at"),
    )


PLANS_SQL = """
SELECT o.o_orderkey AS plan_id, o.o_custkey AS user_id, n.n_regionkey AS origin_country_id,
       COALESCE(d.dest_country, n.n_regionkey) AS dest_country_id,
       CAST(o.o_orderdate AS DATE) AS start_date,
       CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 15 AS INTEGER) AS DATE) AS end_date,
       o.o_totalprice AS budget, 'Solo' AS trip_type,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS lodging_category,
       o.o_orderdate AS created_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT st.plan_id, nn.n_regionkey AS dest_country
           FROM (""" + STOPS_SQL + """) st JOIN nation nn ON st.province_id = nn.n_nationkey
           WHERE st.stop_order = 1) d ON d.plan_id = o.o_orderkey
"""


def ledger(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(F.col("event_id").alias("entry_id"), F.col("user_id").alias("plan_id"),
                    F.col("ts").cast("date").alias("entry_date"), F.col("event_type").alias("category"),
                    F.col("value").alias("amount"), F.col("ts").alias("created_at"))


LEDGER_SQL = """
SELECT event_id AS entry_id, user_id AS plan_id, CAST(ts AS DATE) AS entry_date, event_type AS category,
       value AS amount, ts AS created_at FROM events
"""


def supplier_geo(t: Tables) -> DataFrame:
    """Deterministic coordinates per supplier (lat 27..44, lon -18..4.9)."""
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = t.nation.select("n_nationkey", "n_regionkey")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", "s_name", "s_nationkey", "n_regionkey", "s_acctbal",
        (F.lit(27.0) + (F.col("s_suppkey") % 171) * 0.1).alias("lat"),
        (F.lit(-18.0) + ((F.col("s_suppkey") * 7) % 230) * 0.1).alias("lon"))


SUPPLIER_GEO_SQL = """
SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_regionkey, s.s_acctbal,
       27.0 + (s.s_suppkey % 171) * 0.1 AS lat, -18.0 + ((s.s_suppkey * 7) % 230) * 0.1 AS lon
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
"""


def customer_geo(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_name", "c_nationkey", "n_regionkey",
        (F.lit(27.0) + (F.col("c_custkey") % 173) * 0.1).alias("lat"),
        (F.lit(-18.0) + ((F.col("c_custkey") * 11) % 260) * 0.1).alias("lon"))


CUSTOMER_GEO_SQL = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_regionkey,
       27.0 + (c.c_custkey % 173) * 0.1 AS lat, -18.0 + ((c.c_custkey * 11) % 260) * 0.1 AS lon
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def cost_group_sql(expr: str) -> str:
    whens = " ".join(f"WHEN lower(trim({expr})) = '{k}' THEN '{v}'" for k, v in COST_GROUPS.items())
    return f"CASE {whens} ELSE 'actividades' END"


def with_ctes(*pairs: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in pairs)
