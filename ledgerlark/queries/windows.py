"""Window functions, sorting, paging and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import floor_to
from ..operators import dedup, joins
from ..operators import timeseries as ts
from ..operators.positions import running_max
from ..sources import io, serving
from ..sources.incremental import shared_folder
from .registry import query, r6, sql_r6


@query("w1_top1_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t):
    return dedup.latest_per_key(t.orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("w2_nulls_last", """
SELECT user_id, event_id FROM (SELECT *, CASE WHEN event_type <> 'view' THEN ts END AS t2 FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t2 IS NULL, t2 ASC, event_id DESC) = 1""")
def _(t):
    holes = t.events.withColumn("t2", F.when(F.col("event_type") != "view", F.col("ts")))
    return dedup.top_per_key(holes, ["user_id"], [F.asc_nulls_last("t2"), F.desc("event_id")]).select("user_id", "event_id")


@query("w3_priority_dedup", """
SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END, o_totalprice DESC, o_orderkey) = 1""")
def _(t):
    status = F.col("o_orderstatus")
    return (dedup.by_priority(t.orders, ["o_custkey"], [status == "F", status == "O"], [F.desc("o_totalprice"), F.asc("o_orderkey")])
            .select("o_custkey", "o_orderkey"))


@query("w4_two_stage_dedup", """
SELECT o_custkey, o_orderkey FROM (SELECT * FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC) = 1)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey DESC) = 1""")
def _(t):
    return (dedup.newest_batch_then_earliest(t.orders, ["o_custkey"], "o_orderpriority", "o_orderdate", ["o_orderkey"])
            .select("o_custkey", "o_orderkey"))


@query("w5_group_size", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey) AS total_por_factura FROM lineitem")
def _(t):
    out = joins.attach_group(t.lineitem, ["l_orderkey"], total_por_factura=F.count(F.lit(1)))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "total_por_factura")


@query("w6_prefix_max", "SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS so_far FROM orders")
def _(t):
    out = running_max(t.orders, ["o_custkey"], [F.col("o_orderdate")], F.trunc("o_orderdate", "MM"), so_far=F.col("o_totalprice"))
    return out.select("o_orderkey", "so_far")


def _placed(t):
    readings = t.events.groupBy("event_type", floor_to("hour", F.col("ts")).alias("hour")).agg(F.sum("value").alias("v"))
    return ts.reading_position(readings, "event_type", "hour")


_H = "WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, sum(value) AS v FROM events GROUP BY 1, 2)"


@query("w7_lags", f"""{_H}
SELECT event_type, hour, {", ".join(sql_r6(f'lag(v, {k}) OVER w') + f" AS v_lag_{k}" for k in ts.LAGS)}
FROM h WINDOW w AS (PARTITION BY event_type ORDER BY hour)""")
def _(t):
    out = ts.lag_and_rolling(_placed(t), "event_type", "position", ["v"], windows=(), rows_per_chunk=100)
    return out.select("event_type", "hour", *[r6(f"v_lag_{k}").alias(f"v_lag_{k}") for k in ts.LAGS])


def _rolling_sql(function: str, name: str) -> str:
    parts = []
    for w in ts.ROLLING_WINDOWS:
        frame = f"(PARTITION BY event_type ORDER BY hour ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        parts.append(sql_r6(f"CASE WHEN count(v) OVER {frame} = {w} THEN {function}(v) OVER {frame} END") + f" AS v_rolling_{name}_{w}")
    return f"{_H} SELECT event_type, hour, {', '.join(parts)} FROM h"


@query("w8_rolling_mean", _rolling_sql("avg", "mean"))
def _(t):
    out = ts.lag_and_rolling(_placed(t), "event_type", "position", ["v"], lags=(), rows_per_chunk=100)
    return out.select("event_type", "hour", *[r6(f"v_rolling_mean_{w}").alias(f"v_rolling_mean_{w}") for w in ts.ROLLING_WINDOWS])


@query("w9_rolling_deviation", _rolling_sql("stddev_samp", "std"))
def _(t):
    out = ts.lag_and_rolling(_placed(t), "event_type", "position", ["v"], lags=(), rows_per_chunk=100)
    return out.select("event_type", "hour", *[r6(f"v_rolling_std_{w}").alias(f"v_rolling_std_{w}") for w in ts.ROLLING_WINDOWS])


_WIDE_KEY = ["l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@query("w10_many_column_dedup", f"""
SELECT {', '.join(_WIDE_KEY)}, l_orderkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY {', '.join(_WIDE_KEY)} ORDER BY try_cast(l_orderkey::VARCHAR AS BIGINT) DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def _(t):
    lot = F.col("l_orderkey").cast("string").try_cast("bigint")
    return (dedup.top_per_key(t.lineitem, _WIDE_KEY, [lot.desc(), F.desc("l_suppkey"), F.desc("l_extendedprice")])
            .select(*_WIDE_KEY, "l_orderkey", "l_suppkey"))


@query("t1_order_by", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus ASC NULLS FIRST, o_totalprice DESC NULLS LAST, o_orderkey")
def _(t):
    return (t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
            .orderBy(F.asc_nulls_first("o_orderstatus"), F.desc_nulls_last("o_totalprice"), "o_orderkey"))


@query("t3_top_20", "SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(t):
    return (t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
            .orderBy(F.desc("spend"), "o_custkey").limit(20))


@query("t4_page", "SELECT o_orderkey, o_orderdate::DATE AS d FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100")
def _(t):
    rows = io.page(t.orders, [F.desc("o_orderdate"), F.asc("o_orderkey")], number=3, size=50)
    return rows.select("o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("t4_stored_page", "SELECT o_orderkey, o_orderdate::DATE AS d FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 10000")
def _(t):
    path = shared_folder(t.spark, "listing")
    serving.write_listing(t.orders.select("o_orderkey", "o_orderdate"), path, [F.desc("o_orderdate"), F.asc("o_orderkey")])
    return serving.page(t.spark, path, number=201, size=50).select("o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("t5_first_row", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 LIMIT 1")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderstatus").limit(1)


@query("u1_union_by_name", """
SELECT o_orderkey, 'alert' AS message, o_totalprice AS trama, o_totalprice / 2 AS ocr FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'Factura OK', o_totalprice, o_totalprice / 2 FROM orders WHERE o_orderstatus <> 'F'""")
def _(t):
    price = F.col("o_totalprice")
    alerts = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("alert").alias("message"), price.alias("trama"), (price / 2).alias("ocr"))
    fine = t.orders.where("o_orderstatus <> 'F'").select((price / 2).alias("ocr"), price.alias("trama"), "o_orderkey", F.lit("Factura OK").alias("message"))
    return alerts.unionByName(fine)


@query("u2_union_different_columns", """
SELECT o_orderkey AS key, o_totalprice AS price, NULL::DOUBLE AS quantity FROM orders UNION ALL SELECT l_orderkey, NULL, l_quantity FROM lineitem""")
def _(t):
    return (t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
            .unionByName(t.lineitem.select(F.col("l_orderkey").alias("key"), F.col("l_quantity").alias("quantity")), allowMissingColumns=True))


@query("u3_union_of_ids", "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    return (t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
            .union(t.lineitem.where("l_returnflag = 'R'").select("l_orderkey")).distinct())


@query("u5_union_with_constants", """
SELECT o_orderkey, 1 AS flag_abono, 'Pagado' AS dsc_abono FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 0, '' FROM orders WHERE o_orderstatus = 'O'""")
def _(t):
    paid = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit(1).alias("flag_abono"), F.lit("Pagado").alias("dsc_abono"))
    rest = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", F.lit(0).alias("flag_abono"), F.lit("").alias("dsc_abono"))
    return paid.unionByName(rest)


@query("u6_tagged_layouts", """
SELECT o_orderkey, 'SUMMARY' AS type, o_totalprice AS total, NULL::VARCHAR AS titulo FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, 'T1', NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'T2', o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def _(t):
    # one pass over the table instead of a scan per layout
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "O", "SUMMARY").when(status == "F", "T1").when(status == "P", "T2").alias("type"),
        F.when(status.isin("O", "P"), F.col("o_totalprice")).alias("total"),
        F.when(status.isin("F", "P"), F.col("o_orderpriority")).alias("titulo"))
