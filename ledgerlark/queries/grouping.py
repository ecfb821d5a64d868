"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import floor_to, instant, month_start
from ..operators import aggregates as agg
from ..operators import joins, profile
from ..operators.nested import dominant_values
from ..operators.positions import row_position
from ..sources.incremental import newer_than_watermark
from .registry import query, r6, sql_r6


@query("a1_group_measures", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY 1""")
def _(t):
    p = "o_totalprice"
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(p), 2).alias("total"),
                                                 F.max(p).alias("hi"), F.min(p).alias("lo"))


@query("a2_group_by_all", "SELECT l_returnflag, l_linestatus, max(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return t.spark.sql("SELECT l_returnflag, l_linestatus, max(l_quantity) AS q, count(*) AS n FROM {l} GROUP BY ALL", l=t.lineitem)


@query("a3_duplicate_keys", "SELECT o_custkey, o_orderdate::DATE AS d, count(*) AS conteo FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return profile.duplicate_keys(t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d")), ["o_custkey", "d"])


@query("a3_rows_with_duplicate_keys", """
SELECT o_orderkey FROM orders JOIN (SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING count(*) > 1) USING (o_custkey, o_orderdate)""")
def _(t):
    return profile.rows_with_duplicate_keys(t.orders, ["o_custkey", "o_orderdate"]).select("o_orderkey")


@query("a4_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("a5_count_distinct_with_sentinel", """
SELECT k, CASE WHEN k <> 9999 THEN count(DISTINCT user_id) ELSE 0 END AS users FROM (
  SELECT user_id, CASE event_type WHEN 'click' THEN 6 WHEN 'view' THEN 156 ELSE 9999 END AS k FROM events) GROUP BY 1""")
def _(t):
    k = F.when(F.col("event_type") == "click", 6).when(F.col("event_type") == "view", 156).otherwise(9999)
    return t.events.select("user_id", k.alias("k")).groupBy("k").agg(
        agg.count_distinct_unless(F.col("k"), 9999, F.col("user_id")).alias("users"))


@query("a6_conditional_max", "SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS observed, max(o_totalprice) AS total FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(agg.max_where(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("observed"),
                                             F.max("o_totalprice").alias("total"))


@query("a7_any_flag", "SELECT l_orderkey, max(CASE WHEN p_name LIKE '%ring%' THEN 1 ELSE 0 END) AS flag FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(t):
    return (t.lineitem.join(t.part, t.lineitem.l_partkey == t.part.p_partkey).groupBy("l_orderkey")
            .agg(agg.any_flag(F.col("p_name").contains("ring")).alias("flag")))


@query("a8_safe_ratio", f"""
SELECT l_suppkey, {sql_r6("count(CASE WHEN l_returnflag = 'R' THEN 1 END) / nullif(count(CASE WHEN l_linestatus = 'O' THEN 1 END), 0)")} AS ratio FROM lineitem GROUP BY 1""")
def _(t):
    ratio = agg.share(F.count(F.when(F.col("l_returnflag") == "R", 1)), F.count(F.when(F.col("l_linestatus") == "O", 1)))
    return t.lineitem.groupBy("l_suppkey").agg(r6(ratio).alias("ratio"))


_HOLES = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders"


def _with_holes(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("o_totalprice"),
                           F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"))


@query("a9_null_profile", f"""WITH h AS ({_HOLES})
SELECT 'o_orderkey' AS campo, count(*) AS cantidad_total, count(*) - count(o_orderkey) AS cantidad_nulos FROM h
UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice) FROM h
UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority) FROM h ORDER BY 3 DESC""")
def _(t):
    return profile.null_profile(_with_holes(t)).orderBy(F.desc("cantidad_nulos"), "campo")


@query("a10_null_percentages", f"""WITH h AS ({_HOLES})
SELECT campo, {sql_r6('nulos * 100.0 / total')} AS pct_nulos FROM (
  SELECT 'o_orderkey' AS campo, count(*) AS total, count(*) - count(o_orderkey) AS nulos FROM h
  UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice) FROM h
  UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority) FROM h) WHERE nulos > 0""")
def _(t):
    return profile.null_percentages(_with_holes(t)).withColumn("pct_nulos", r6("pct_nulos"))


@query("a11_derived_sums", "SELECT l_orderkey, round(sum(l_extendedprice), 2) AS net, round(sum(l_extendedprice + l_tax), 2) AS gross FROM lineitem GROUP BY 1")
def _(t):
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    return t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum(price), 2).alias("net"), F.round(F.sum(price + tax), 2).alias("gross"))


@query("a12_group_countif", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) FILTER (l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS con_titulo FROM lineitem")
def _(t):
    out = joins.attach_group(t.lineitem, ["l_orderkey"], con_titulo=F.count_if(F.col("l_returnflag") == "R"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "con_titulo")


@query("a13_dominant_value", """
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents)
SELECT doc_id, word FROM (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(pos), word) AS rn FROM w GROUP BY 1, 2) WHERE rn = 1""")
def _(t):
    return dominant_values(t.documents, "doc_id", F.split("text", " "), "word")


@query("a14_watermark", """
WITH target AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01')
SELECT o_orderkey FROM orders WHERE o_orderdate >= coalesce((SELECT max(o_orderdate) FROM target WHERE o_orderstatus = 'F'), TIMESTAMP '1900-01-01')
  AND o_orderkey NOT IN (SELECT o_orderkey FROM target WHERE o_orderstatus = 'F')""")
def _(t):
    target = t.orders.where(F.col("o_orderdate") <= instant("2000-01-01 00:00:00"))
    return newer_than_watermark(t.orders, target, "o_orderdate", {"o_orderstatus": "F"}, "o_orderkey").select("o_orderkey")


@query("a15_distinct", "SELECT DISTINCT s_nationkey FROM supplier")
def _(t):
    return t.supplier.select("s_nationkey").distinct()


@query("a16_regression_metrics", f"""
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS y FROM events GROUP BY 1, 2),
p AS (SELECT a.event_type, a.y, b.y AS yhat FROM h a JOIN h b ON a.event_type = b.event_type AND a.hour = b.hour + INTERVAL 1 HOUR)
SELECT event_type, {sql_r6('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, {sql_r6('avg(abs(y - yhat))')} AS mae,
  {sql_r6('1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))')} AS r2 FROM p GROUP BY 1""")
def _(t):
    h = t.events.groupBy("event_type", floor_to("hour", F.col("ts")).alias("hour")).agg(F.avg("value").alias("y"))
    naive = h.select("event_type", (F.col("hour") + F.expr("interval 1 hour")).alias("hour"), F.col("y").alias("yhat"))
    metrics = agg.regression_metrics(h.join(naive, ["event_type", "hour"]), "y", "yhat", ["event_type"])
    return metrics.select("event_type", *[r6(c).alias(c) for c in ("rmse", "mae", "r2")])


@query("a17_mean_imputation", f"""
WITH h AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
SELECT event_id, {sql_r6('coalesce(v, (SELECT avg(v) FROM h))')} AS v FROM h""")
def _(t):
    holes = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return agg.fill_with_means(holes, ["v"]).withColumn("v", r6("v"))


@query("a18_keyed_grouping", """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, count(*) OVER (PARTITION BY conv_id) AS group_size, role, length(text) AS chars FROM conversations""")
def _(t):
    # a list per key has no bound, so a group is kept as rows: its key, place and size
    placed = row_position(t.conversations, ["conv_id"], [F.col("turn")], F.floor(F.col("turn") / 1000), "place")
    sized = joins.attach_group(placed, ["conv_id"], group_size=F.count(F.lit(1)))
    return sized.select("conv_id", "place", "group_size", "role", F.length("text").cast("bigint").alias("chars"))


@query("a19_monthly_counts", """
WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS periodo, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderkey, n FROM orders JOIN m ON orders.o_custkey = m.o_custkey AND date_trunc('month', o_orderdate)::DATE = periodo""")
def _(t):
    monthly = agg.monthly_distinct(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey", "n")
    return (t.orders.withColumn("periodo", month_start(F.col("o_orderdate")))
            .join(monthly, ["o_custkey", "periodo"]).select("o_orderkey", "n"))
