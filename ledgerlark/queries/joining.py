"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import floor_to
from ..functions.text import bare_number
from ..operators import dedup, joins
from ..operators import timeseries as ts
from ..operators.nested import unnest
from ..operators.profile import null_profile
from .registry import query, r6, sql_r6


@query("j1_inner_join", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate::DATE AS fecha FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(t):
    return (t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("o_orderdate").alias("fecha")))


@query("j2_composite_key", f"""
WITH a AS (SELECT event_type, date_trunc('hour', ts) AS h, avg(value) AS v FROM events GROUP BY 1, 2),
b AS (SELECT event_type, date_trunc('hour', ts) AS h, max(value) AS w FROM events WHERE value > 20 GROUP BY 1, 2)
SELECT event_type, h, {sql_r6('v')} AS v, w FROM a JOIN b USING (event_type, h)""")
def _(t):
    hour = t.events.withColumn("h", floor_to("hour", F.col("ts")))
    a = hour.groupBy("event_type", "h").agg(r6(F.avg("value")).alias("v"))
    b = hour.where(F.col("value") > 20).groupBy("event_type", "h").agg(F.max("value").alias("w"))
    return a.join(b, ["event_type", "h"])


@query("j3_normalised_key", """
SELECT a.c_custkey, b.c_nationkey AS found FROM (SELECT c_custkey, replace(substr(c_name, 1, 4) || '-' || substr(c_name, 5), '-', '') AS k FROM customer) a
LEFT JOIN customer b ON a.k = b.c_name""")
def _(t):
    dashed = F.concat(F.substring("c_name", 1, 4), F.lit("-"), F.substr("c_name", F.lit(5)))
    left = t.customer.select("c_custkey", bare_number(dashed).alias("k"))
    right = t.customer.select(F.col("c_name").alias("k"), F.col("c_nationkey").alias("found"))
    return left.join(right, "k", "left").select("c_custkey", "found")


@query("j4_template_join", """
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2),
spine AS (SELECT e.event_type, s.hour FROM (SELECT DISTINCT event_type FROM events) e,
  (SELECT unnest(generate_series((SELECT min(hour) FROM h), (SELECT max(hour) FROM h), INTERVAL 1 HOUR)) AS hour) s)
SELECT event_type, hour, n FROM spine LEFT JOIN h USING (event_type, hour)""")
def _(t):
    hourly = t.events.groupBy("event_type", floor_to("hour", F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return ts.spine_of(hourly, "hour", "event_type").join(hourly, ["event_type", "hour"], "left")


@query("j5_star_join", f"""
SELECT r_name, p_brand, count(*) AS n, round(sum(l_extendedprice), 2) AS total, count(s_suppkey) AS with_supplier FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2""")
def _(t):
    star = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
            .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    return star.groupBy("r_name", "p_brand").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"),
                                                 F.count("s_suppkey").alias("with_supplier"))


@query("j6_left_anti", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')""")
def _(t):
    urgent = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"))
    return t.customer.join(urgent, t.customer.c_custkey == urgent.o_custkey, "left_anti").select("c_custkey")


_EXCLUDED = """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'"""


@query("j7_not_in_sets", f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN ({_EXCLUDED})")
def _(t):
    sets = [t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey"),
            t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey")]
    return joins.not_in(t.orders, "o_orderkey", sets).select("o_orderkey")


@query("j7_not_in_with_null", """
SELECT 'with null' AS sets, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END FROM lineitem)
UNION ALL SELECT 'without null', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <> 7)""")
def _(t):
    ids = t.lineitem.select(F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("id"))
    sets = {"with null": ids, "without null": ids.where(F.col("id").isNotNull())}
    counts = [joins.not_in(t.orders, "o_orderkey", [s]).agg(F.lit(name).alias("sets"), F.count(F.lit(1)).alias("n"))
              for name, s in sets.items()]
    return counts[0].unionByName(counts[1])


@query("j8_semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')")
def _(t):
    urgent = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"))
    return t.customer.join(urgent, t.customer.c_custkey == urgent.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("j9_profile_without_cross_join", """
SELECT 'value' AS campo, count(*) AS cantidad_total, count(*) - count(v) AS cantidad_nulos FROM (SELECT CASE WHEN event_type <> 'view' THEN value END AS v FROM events)
UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id) FROM events""")
def _(t):
    df = t.events.select(F.when(F.col("event_type") != "view", F.col("value")).alias("value"), "user_id")
    return null_profile(df, ["value", "user_id"])


@query("j10_lateral_unnest", """
SELECT doc_id, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def _(t):
    lines = unnest(t.documents.select("doc_id", F.split("text", "\n").alias("parts")), "parts", "line")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars"))


@query("j11_interval_join", """
SELECT a.o_orderkey, (SELECT count(*) FROM orders b WHERE b.o_custkey = a.o_custkey
  AND b.o_orderdate::DATE BETWEEN a.o_orderdate::DATE - 5 AND a.o_orderdate::DATE + 5) AS n_near FROM orders a""")
def _(t):
    near = joins.nearby_date_counts(t.orders, t.orders, ["o_custkey"], "o_orderdate", "o_orderdate", 5, 5)
    return near.select("o_orderkey", "n_near")


@query("j12_tolerance_join", """
SELECT a.o_orderkey, (SELECT count(*) FROM orders b WHERE b.o_custkey = a.o_custkey
  AND trunc(b.o_totalprice) BETWEEN trunc(a.o_totalprice) - 500 AND trunc(a.o_totalprice) + 500) AS n_near FROM orders a""")
def _(t):
    near = joins.nearby_amount_counts(t.orders, t.orders, ["o_custkey"], "o_totalprice", "o_totalprice", 500)
    return near.select("o_orderkey", "n_near")


@query("j13_same_month_join", """
SELECT a.o_orderkey, (SELECT count(*) FROM orders b WHERE b.o_custkey = a.o_custkey
  AND strftime(b.o_orderdate, '%Y%m') = strftime(a.o_orderdate, '%Y%m')) AS n_same FROM orders a""")
def _(t):
    return (joins.same_period_counts(t.orders, t.orders, ["o_custkey"], "o_orderdate", "o_orderdate", "MM")
            .select("o_orderkey", "n_same"))


@query("j14_validity_range", """
WITH v AS (SELECT o_custkey, min(o_orderdate)::DATE + 365 AS a, max(o_orderdate)::DATE - 365 AS b FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderdate::DATE NOT BETWEEN a AND b AND b IS NOT NULL THEN 1 ELSE 0 END AS flag FROM orders JOIN v USING (o_custkey)""")
def _(t):
    ranges = t.orders.groupBy("o_custkey").agg(F.date_add(F.to_date(F.min("o_orderdate")), 365).alias("a"),
                                               F.date_sub(F.to_date(F.max("o_orderdate")), 365).alias("b"))
    dated = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return joins.inside_validity(dated, ranges, ["o_custkey"], "d", "a", "b", "flag").select("o_orderkey", "flag")


@query("j15_latest_attribute", """
SELECT c_custkey, o_orderkey AS current_order FROM customer LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey DESC) = 1)
ON c_custkey = o_custkey""")
def _(t):
    top = dedup.by_priority(t.orders, ["o_custkey"], [F.col("o_orderstatus") == "O"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return (t.customer.join(top, t.customer.c_custkey == top.o_custkey, "left")
            .select("c_custkey", F.col("o_orderkey").alias("current_order")))


@query("j16_threshold_with_default", """
SELECT o_orderkey, coalesce(u, 40000.0)::DOUBLE AS umbral, CASE WHEN o_totalprice > coalesce(u, 40000.0) THEN 1 ELSE 0 END AS flag_anomaly FROM orders
LEFT JOIN (VALUES ('F-1-URGENT', 250000.0), ('O-2-HIGH', 120000.5), ('P-5-LOW', 90000.0)) m(k, u) ON o_orderstatus || '-' || o_orderpriority = k""")
def _(t):
    table = joins.literal_table(t.spark, [("F-1-URGENT", 250000.0), ("O-2-HIGH", 120000.5), ("P-5-LOW", 90000.0)], "k string, umbral double")
    key = F.concat("o_orderstatus", F.lit("-"), "o_orderpriority")
    out = joins.lookup_with_default(t.orders, table, key == table.k, {"umbral": F.lit(40000.0)})
    return out.select("o_orderkey", "umbral", F.when(F.col("o_totalprice") > F.col("umbral"), 1).otherwise(0).alias("flag_anomaly"))


@query("j17_bridge_join", """
SELECT o.o_orderkey * 10 AS documento_id, l_linenumber, l_partkey, l_suppkey FROM (SELECT o_orderkey, 'path/' || o_orderkey AS path FROM orders) o
JOIN (SELECT o_orderkey + 1000000 AS tmp_id, 'path/' || o_orderkey AS path FROM orders) c USING (path)
JOIN (SELECT *, l_orderkey + 1000000 AS doc FROM lineitem) ON doc = tmp_id""")
def _(t):
    path = F.concat(F.lit("path/"), F.col("o_orderkey").cast("string")).alias("path")
    originals = t.orders.select((F.col("o_orderkey") * 10).alias("id"), path)
    copies = t.orders.select((F.col("o_orderkey") + 1000000).alias("tmp_id"), path)
    entities = t.lineitem.select((F.col("l_orderkey") + 1000000).alias("documento_id"), "l_linenumber", "l_partkey", "l_suppkey")
    return joins.bridge(originals, copies, entities, "path", "id", "tmp_id", "documento_id")


@query("j18_case_insensitive_join", "SELECT n_nationkey, s_suppkey FROM nation JOIN (SELECT s_suppkey, 'nation_' || s_nationkey AS who FROM supplier) ON upper(n_name) = upper(who)")
def _(t):
    who = t.supplier.select("s_suppkey", F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("who"))
    return t.nation.join(who, F.upper("n_name") == F.upper("who")).select("n_nationkey", "s_suppkey")


@query("j19_group_join_back", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS top_price,
  max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS any_return FROM lineitem""")
def _(t):
    out = joins.attach_group(t.lineitem, ["l_orderkey"], top_price=F.max("l_extendedprice"),
                             any_return=F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "top_price", "any_return")
