"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money
from ..functions.dates import default_period_column, floor_to, instant
from ..functions.text import label_map
from ..operators.boosting import BoostedModel
from ..operators.nested import conform
from ..plans import forecast
from .registry import query, r6, sql_r6


@query("p1_select_rename", "SELECT o_orderkey AS num_factura, o_custkey AS ruc, o_totalprice AS monto FROM orders")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("num_factura"), F.col("o_custkey").alias("ruc"),
                           F.col("o_totalprice").alias("monto"))


@query("p2_drop_columns", "SELECT * EXCLUDE (l_tax, l_discount, l_shipdate) FROM lineitem")
def _(t):
    return t.lineitem.drop("l_tax", "l_discount", "l_shipdate")


@query("p3_replace_struct_fields", """
SELECT o_orderkey, o_custkey::VARCHAR AS holder, 'S/ ' || (o_orderkey % 10) AS deductible, o_orderstatus AS state FROM orders""")
def _(t):
    header = F.struct(F.col("o_custkey").alias("holder"), F.lit("0").alias("deductible"), F.col("o_orderstatus").alias("state"))
    fixed = (header.withField("holder", F.col("o_custkey").cast("string"))
             .withField("deductible", F.concat(F.lit("S/ "), (F.col("o_orderkey") % 10).cast("string"))))
    return t.orders.select("o_orderkey", fixed.alias("h")).select("o_orderkey", "h.*")


@query("p4_conform_layouts", """
SELECT o_orderkey, o_orderstatus AS titulo, NULL::VARCHAR AS sede, o_totalprice::VARCHAR IS NOT NULL AS has_monto,
       NULL::DECIMAL(38,9) AS num_cama FROM orders""")
def _(t):
    have = T.StructType.fromDDL("titulo string, monto double")
    want = T.StructType.fromDDL("titulo string, sede string, monto string, num_cama decimal(38,9)")
    source = F.struct(F.col("o_orderstatus").alias("titulo"), F.col("o_totalprice").alias("monto"))
    return (t.orders.select("o_orderkey", conform(source, have, want).alias("h"))
            .select("o_orderkey", "h.titulo", "h.sede", F.col("h.monto").isNotNull().alias("has_monto"), "h.num_cama"))


@query("p5_case_ladder", """
SELECT CASE WHEN l_quantity IS NULL THEN NULL WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
  count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    q = F.col("l_quantity")
    size = F.when(q.isNull(), None).when(q < 10, "small").when(q < 30, "medium").otherwise("large")
    return t.lineitem.groupBy(size.alias("size_class")).agg(F.count(F.lit(1)).alias("n"))


@query("p6_code_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'abierto' WHEN 'F' THEN 'cerrado' ELSE o_orderstatus END AS estado FROM orders""")
def _(t):
    status = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", label_map(status, {"O": "abierto", "F": "cerrado"}, status).alias("estado"))


@query("p7_in_lists", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND user_id NOT IN (1, 2, 3)")
def _(t):
    return (t.events.where(F.col("event_type").isin("click", "view") & ~F.col("user_id").isin(1, 2, 3))
            .select("event_id", "event_type"))


@query("p8_contains_either_way", """
SELECT p_partkey, (p_name LIKE '%' || substr(p_type, 1, 2) || '%' OR lower(p_type) LIKE '%' || substr(p_name, 1, 2) || '%') AS hit FROM part""")
def _(t):
    name, kind = F.col("p_name"), F.col("p_type")
    return t.part.select("p_partkey", (name.contains(F.substring(kind, 1, 2))
                                       | F.lower(kind).contains(F.substring(name, 1, 2))).alias("hit"))


@query("p9_ranges_and_nulls", """
SELECT o_orderkey, v NOT BETWEEN 100000 AND 300000 AS outside, v IS NULL AS missing, (v BETWEEN 1 AND 50000) IS TRUE AS low
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v FROM orders)""")
def _(t):
    v = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    return t.orders.select("o_orderkey", (~v.between(100000, 300000)).alias("outside"), v.isNull().alias("missing"),
                           v.between(1, 50000).eqNullSafe(F.lit(True)).alias("low"))


@query("p10_tolerances", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, trunc(a) = trunc(b) AS same_whole, trunc(b) BETWEEN trunc(a) - 50 AND trunc(a) + 50 AS within_50,
  round(a) <> round(b) AS rounded_differ, a - b > 0.1 AS above
FROM (SELECT *, l_extendedprice / l_quantity AS a, p_retailprice AS b FROM lineitem JOIN part ON l_partkey = p_partkey)""")
def _(t):
    a, b = F.col("l_extendedprice") / F.col("l_quantity"), F.col("p_retailprice")
    return (t.lineitem.join(t.part, t.lineitem.l_partkey == t.part.p_partkey)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", money.same_whole(a, b).alias("same_whole"),
                    money.within(a, b, 50).alias("within_50"), (F.round(a) != F.round(b)).alias("rounded_differ"),
                    (a - b > 0.1).alias("above")))


@query("p11_period_default", "SELECT (ts - INTERVAL 5 HOUR)::DATE - 1 AS period, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy(default_period_column(F.col("ts")).alias("period")).agg(F.count(F.lit(1)).alias("n"))


@query("p12_latest_hour", """
SELECT event_id, value FROM events WHERE date_trunc('hour', ts) = (SELECT date_trunc('hour', max(ts)) FROM events)""")
def _(t):
    latest = t.events.agg(floor_to("hour", F.max("ts")).alias("h")).scalar()
    return t.events.where(F.col("ts") >= latest).select("event_id", "value")


@query("p13_drop_nulls", """
SELECT event_id, v FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events) WHERE v IS NOT NULL""")
def _(t):
    return t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v")).na.drop()


@query("p14_model_column_order", f"SELECT event_id, {sql_r6('value')} AS f0, hour(ts)::DOUBLE AS f1, user_id::DOUBLE AS f2 FROM events")
def _(t):
    trained = BoostedModel(["value", "hour", "user_id"], [])
    df = t.events.select("event_id", F.col("user_id").cast("double").alias("user_id"), F.hour("ts").cast("double").alias("hour"), "value", F.lit("x").alias("extra"))
    # by place, as a model without names reads them
    return forecast.model_columns(df, trained, "event_id").toDF("event_id", "f0", "f1", "f2").withColumn("f0", r6("f0"))


@query("p15_window_universe", """
SELECT DISTINCT o_custkey, 'F' || lpad(o_orderkey::VARCHAR, 8, '0') AS factura FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 12:00:00' AND TIMESTAMP '1997-06-30 12:00:00' AND o_orderstatus <> 'P'
  AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def _(t):
    return (t.orders.where(F.col("o_orderdate").between(instant("1997-01-01 12:00:00"), instant("1997-06-30 12:00:00"))
                           & (F.col("o_orderstatus") != "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_custkey", F.concat(F.lit("F"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0")).alias("factura"))
            .distinct())
