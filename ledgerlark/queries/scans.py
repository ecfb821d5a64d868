"""Scans, sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import floor_to, instant
from ..operators.joins import literal_table, lookup_with_default
from ..sources import chart_pages, feed, incremental, io, serving
from .registry import Tables, query, r6, sql_r6

FROM, TO = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


@query("s1_read_projected", "SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND event_type = 'error'")
def _(t: Tables):
    return io.read_projected(t.spark, f"{t.folder}/events.parquet", ["event_id", "ts", "value"],
                             [F.col("ts") >= instant(FROM), F.col("event_type") == "error"])


@query("s2_read_period", """
SELECT user_id, value, ts FROM (
  SELECT user_id, value, strptime(strftime(ts, '%d/%m/%Y%H:%M:'), '%d/%m/%Y%H:%M:') AS ts FROM events)
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND value IS NOT NULL AND user_id IS NOT NULL""")
def _(t):
    texts = t.events.withColumn("ts", F.date_format("ts", "dd/MM/yyyyHH:mm:"))
    return io.read_period(texts, "ts", instant(FROM), instant(TO), ["user_id", "value"], text_format=True)


@query("s2_stored_period", """
SELECT user_id, value, strptime(strftime(ts, '%d/%m/%Y%H:%M:'), '%d/%m/%Y%H:%M:') AS ts FROM events
WHERE date_trunc('minute', ts) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND value IS NOT NULL AND user_id IS NOT NULL""")
def _(t):
    path = incremental.shared_folder(t.spark, "readings")
    texts = t.events.select("user_id", "value", F.date_format("ts", "dd/MM/yyyyHH:mm:").alias("ts"))
    serving.write_by_day(texts, path, "ts", ["user_id"], text_format=True)
    return serving.read_period(t.spark, path, "ts", dt.datetime.fromisoformat(FROM), dt.datetime.fromisoformat(TO), ["user_id", "value"])


@query("s3_query_source", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1""")
def _(t):
    return io.query_source(t.spark, """
        SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders}
        WHERE o_orderdate BETWEEN CAST(:start AS TIMESTAMP_NTZ) AND CAST(:end AS TIMESTAMP_NTZ) GROUP BY o_orderstatus""",
        {"start": "1996-01-01 00:00:00", "end": "1999-12-31 00:00:00"}, orders=t.orders)


@query("s4_json_records", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def _(t):
    return io.json_records(t.events.select("event_id", "props"), "props", "k bigint")


def feed_documents(t: Tables):
    """Orders written as the feed writes its invoices: all text, several lots per number."""
    o = t.orders
    return o.select(
        F.concat(F.lit("2010025117"), (F.col("o_custkey") % 7).cast("string")).alias("RUCIPRESS"),
        F.concat(F.lit("F"), F.lpad((F.col("o_orderkey") / 2).cast("bigint").cast("string"), 11, "0")).alias("NUMERODOCUMENTOPAGO"),
        F.concat(F.lit("L"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("CODIGOLOTE"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("FECHAEMISION"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderstatus")).otherwise(((F.col("o_orderkey") % 2) + 1).cast("string")).alias("TIPOMONEDA"),
        F.col("o_orderpriority").alias("CODIGOPRODUCTO"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("s/d")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("MONTOTOTAL"),
        F.lit("18").alias("MONTOIGV"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("MONTONETO"),
        F.lit("01").alias("CODIGOMECANISMOPAGO"),
        F.when(F.col("o_orderkey") % 3 == 0, "C").otherwise("D").alias("TIPONOTA"),
        F.col("o_orderkey").cast("string").alias("NUMERONOTA"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("MONTONOTA"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("FECHANOTA"),
        F.lit("x").alias("MOTIVONOTA"), F.date_format("o_orderdate", "yyyyMMdd").alias("FECHAPRIMERENVIO"),
    )


FEED_DOCUMENTS = """feed AS (
  SELECT '2010025117' || (o_custkey % 7) AS RUCIPRESS, 'F' || lpad((o_orderkey // 2)::VARCHAR, 11, '0') AS NUMERODOCUMENTOPAGO,
         'L' || lpad(o_orderkey::VARCHAR, 9, '0') AS CODIGOLOTE, strftime(o_orderdate, '%Y%m%d') AS FECHAEMISION,
         CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE ((o_orderkey % 2) + 1)::VARCHAR END AS TIPOMONEDA,
         o_orderpriority AS CODIGOPRODUCTO,
         CASE WHEN o_orderkey % 11 = 0 THEN 's/d' ELSE o_totalprice::DECIMAL(18,2)::VARCHAR END AS MONTOTOTAL,
         '18' AS MONTOIGV, o_totalprice::DECIMAL(18,2)::VARCHAR AS MONTONETO, '01' AS CODIGOMECANISMOPAGO,
         CASE WHEN o_orderkey % 3 = 0 THEN 'C' ELSE 'D' END AS TIPONOTA
  FROM orders),
latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY RUCIPRESS, NUMERODOCUMENTOPAGO ORDER BY CODIGOLOTE DESC) = 1)"""


@query("s5_invoice_feed", f"""WITH {FEED_DOCUMENTS}
SELECT NUMERODOCUMENTOPAGO AS numero_de_documento_de_pago, strptime(FECHAEMISION, '%Y%m%d')::DATE AS fecha_emision_tramas,
  CODIGOPRODUCTO AS codigoproducto, RUCIPRESS AS ruc_tramas,
  CASE TIPOMONEDA WHEN '1' THEN 'soles' WHEN '2' THEN 'dolares' ELSE TIPOMONEDA END AS tipo_moneda_tramas,
  try_cast(MONTOTOTAL AS DOUBLE) AS importe_total_tramas, try_cast(MONTOIGV AS DOUBLE) AS igv_tramas,
  try_cast(MONTONETO AS DOUBLE) AS subtotal_tramas, CODIGOMECANISMOPAGO AS descripcion_tramas FROM latest""")
def _(t):
    return feed.read_claim_feed("invoice", documents=feed_documents(t))


@query("s5_credit_note_feed", f"""WITH {FEED_DOCUMENTS}
SELECT NUMERODOCUMENTOPAGO AS numero_de_documento_de_pago, RUCIPRESS AS ruc, TIPONOTA,
  try_cast(MONTONETO AS DOUBLE) AS MONTONOTA, strptime(FECHAEMISION, '%Y%m%d')::DATE AS FECHANOTA FROM latest""")
def _(t):
    df = feed.read_claim_feed("credit_note", documents=feed_documents(t))
    return df.select("numero_de_documento_de_pago", F.col("ruc_tramaNC").alias("ruc"), "TIPONOTA", "MONTONOTA", "FECHANOTA")


def feed_attentions(t: Tables):
    """Line items written as attentions of the feed."""
    l = t.lineitem
    return l.select(
        F.concat(F.lit("2010025117"), (F.col("l_suppkey") % 7).cast("string")).alias("RUCIPRESS"),
        F.concat(F.lit("F"), F.lpad(F.col("l_orderkey").cast("string"), 11, "0")).alias("NUMERODOCUMENTOPAGO"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("CODIGOLOTE"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("FECHAINICIOATENCION"),
        F.lit("1").alias("TIPODOCUMENTOIDENTIDAD"), F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("NUMERODOCUMENTOIDENTIDAD"),
        F.concat(F.lit("0"), (F.col("l_partkey") % 4).cast("string")).alias("TIPODOCUMENTOPRESTACION"),
        F.lpad((F.col("l_partkey") * 1000 + F.col("l_suppkey")).cast("string"), 10, "0").alias("NUMEROAUTORIZACION"),
        (F.col("l_suppkey") % 6).cast("string").alias("SEGUNDOTIPOAUTORIZACION"), F.lit("2").alias("SEGUNDONROAUTORIZACION"),
        (F.col("l_partkey") % 10).cast("string").alias("TIPOCOBERTURA"), F.lit("c").alias("CODIGOPROFESIONALATENCION"),
        F.lit("a").alias("TIPOAFILIACIONPACIENTE"), F.lit("J06.9").alias("CODIGOCIE101"),
        F.lit(None).cast("string").alias("CODIGOCIE102"), F.lit(None).cast("string").alias("CODIGOCIE103"))


FEED_ATTENTIONS = """feed AS (
  SELECT '2010025117' || (l_suppkey % 7) AS RUCIPRESS, 'F' || lpad(l_orderkey::VARCHAR, 11, '0') AS NUMERODOCUMENTOPAGO,
    'L' || l_linenumber AS CODIGOLOTE, l_shipdate::DATE AS fecha_de_prestacion,
    lpad(l_partkey::VARCHAR, 8, '0') AS NUMERODOCUMENTOIDENTIDAD, '0' || (l_partkey % 4) AS TIPODOCUMENTOPRESTACION,
    lpad((l_partkey * 1000 + l_suppkey)::VARCHAR, 10, '0') AS NUMEROAUTORIZACION,
    (l_suppkey % 6)::VARCHAR AS SEGUNDOTIPOAUTORIZACION, (l_partkey % 10)::VARCHAR AS TIPOCOBERTURA
  FROM lineitem),
latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY RUCIPRESS, NUMERODOCUMENTOPAGO
  ORDER BY CODIGOLOTE DESC, fecha_de_prestacion ASC, NUMEROAUTORIZACION DESC, NUMERODOCUMENTOIDENTIDAD DESC, SEGUNDOTIPOAUTORIZACION DESC) = 1)"""


@query("s5_attention_feed", f"""WITH {FEED_ATTENTIONS}
SELECT RUCIPRESS, NUMERODOCUMENTOPAGO AS num_factura_trama_sited, NUMEROAUTORIZACION AS numero_del_documento_de_autorizacion,
  NUMERODOCUMENTOIDENTIDAD AS numero_del_documento_de_identidad, fecha_de_prestacion, TIPOCOBERTURA FROM latest""")
def _(t):
    df = feed.read_claim_feed("attention", attentions=feed_attentions(t))
    return df.select("RUCIPRESS", "num_factura_trama_sited", "numero_del_documento_de_autorizacion",
                     "numero_del_documento_de_identidad", "fecha_de_prestacion", "TIPOCOBERTURA")


@query("s5_letter_feed", f"""WITH {FEED_ATTENTIONS}
SELECT RUCIPRESS AS ruc_tramaCG, NUMERODOCUMENTOPAGO AS num_factura_trama_carta, fecha_de_prestacion FROM latest
WHERE TIPODOCUMENTOPRESTACION IN ('3', '03') OR SEGUNDOTIPOAUTORIZACION IN ('3', '03')""")
def _(t):
    return (feed.read_claim_feed("guarantee_letter", attentions=feed_attentions(t))
            .select("ruc_tramaCG", "num_factura_trama_carta", "fecha_de_prestacion"))


@query("s6_inline_lookup", """
SELECT n_name, coalesce(label, 'OTHER') AS label FROM nation
LEFT JOIN (VALUES (0, 'south'), (1, 'west'), (2, 'east'), (3, 'north')) v(k, label) ON n_regionkey = k""")
def _(t):
    labels = literal_table(t.spark, [(0, "south"), (1, "west"), (2, "east"), (3, "north")], "k int, label string")
    out = lookup_with_default(t.nation, labels, t.nation.n_regionkey == labels.k, {"label": F.lit("OTHER")})
    return out.select("n_name", "label")


@query("s7_append", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def _(t):
    path = incremental.shared_folder(t.spark, "append")
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("day"))
    io.append(rows, path, ["day"])
    io.append(rows, path, ["day"])
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("s8_replace_table", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    path = incremental.shared_folder(t.spark, "replace")
    for _round in range(2):
        io.replace_table(t.events.select("event_id", "event_type"), path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("s9_report_export", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(t):
    path = incremental.shared_folder(t.spark, "report")
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_orderstatus")
    folder = io.report_export(urgent, path, "2024-01-01")
    return t.spark.read.schema("o_orderkey bigint, o_orderstatus string").option("header", True).csv(folder)


@query("s11_chart_series", f"""
SELECT event_id, strftime(ts + i * INTERVAL 1 HOUR, '%d/%m/%Y%H:00:') AS READING_DATETIME, {sql_r6('value + i')} AS value
FROM events, (SELECT unnest([0, 1, 2]) AS i)""")
def _(t):
    stamps = [F.date_format(F.col("ts") + F.expr(f"interval {i} hours"), "dd/MM/yyyyHH:00:") for i in range(3)]
    points = [(F.col("value") + i).cast("decimal(18,6)").cast("string") for i in range(3)]
    page = F.concat(
        F.lit("<html><script>var a = 1;\nHighcharts.chart('container', { /* head */ chart: {type: 'line'}, // note\n xAxis: {categories: ['"),
        F.concat_ws("','", *stamps), F.lit("',]}, series: [{name: 'PM', data: ["), F.concat_ws(", ", *points),
        F.lit("]}], });\n</script></html>"))
    pages = t.events.select("event_id", page.alias("html"))
    return chart_pages.extract_chart_series(pages, "html").withColumn("value", r6("value"))


@query("s12_wide_readings", """
SELECT user_id % 7 AS station, date_trunc('hour', ts) AS hour, max(value) FILTER (event_type = 'click') AS click,
  max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'error') AS error FROM events
GROUP BY 1, 2""")
def _(t):
    series = t.events.select((F.col("user_id") % 7).alias("station"), floor_to("hour", F.col("ts")).alias("hour"), "event_type", "value")
    return chart_pages.wide_readings(series, ["station", "hour"], "event_type", "value", ["click", "view", "error"])


@query("s13_serving_lookup", f"""
SELECT event_type, date_trunc('hour', ts) AS hour, {sql_r6('avg(value)')} AS value FROM events
WHERE event_type = 'click' AND date_trunc('hour', ts) = TIMESTAMP '2024-01-10 05:00:00' GROUP BY 1, 2""")
def _(t):
    path = incremental.shared_folder(t.spark, "serving")
    hourly = t.events.groupBy("event_type", floor_to("hour", F.col("ts")).alias("hour")).agg(r6(F.avg("value")).alias("value"))
    serving.write_by_day(hourly, path, "hour", ["event_type"])
    return serving.lookup(t.spark, path, "hour", dt.datetime(2024, 1, 10, 5), event_type="click")


@query("s14_compare_window", f"""
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT event_type, count(*) AS n, {sql_r6('avg(abs(p.v - o.v))')} AS mae
FROM (SELECT event_type, hour + INTERVAL 1 HOUR AS hour, v FROM h) p JOIN h o USING (event_type, hour)
WHERE hour BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1""")
def _(t):
    hourly = t.events.groupBy("event_type", floor_to("hour", F.col("ts")).alias("hour")).agg(F.avg("value").alias("observed"))
    naive = hourly.select("event_type", (F.col("hour") + F.expr("interval 1 hour")).alias("hour"), F.col("observed").alias("predicted"))
    compared = io.compare_window(naive, hourly, ["event_type"], "hour", "predicted", "observed", instant(FROM), instant(TO))
    return compared.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("abs_error")).alias("mae"))
