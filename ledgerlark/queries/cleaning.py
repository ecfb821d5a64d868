"""Cleaning operators over text rendered from the shared tables.

The messy input of each query is one SQL expression that both engines evaluate; the
cleaning itself is the library's on one side and plain SQL on the other.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, money, text
from ..operators import dedup
from ..operators.aggregates import any_flag
from ..plans.documents import map_diagnosis
from ..sources import lookups
from .registry import Tables, query, r6, sql_r6

D, M, Y = "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')", "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')", "CAST(year(o_orderdate) AS STRING)"
_MONTH_WORDS = "CASE month(o_orderdate) " + " ".join(
    f"WHEN {n} THEN '{w}'" for w, n in dates.MONTHS.items() if w != "SEPTIEMBRE") + " END"
_WRITTEN = f"""CASE o_orderkey % 8
  WHEN 0 THEN {D} || '/' || {M} || '/' || {Y}
  WHEN 1 THEN {D} || '/' || {M} || '/' || substr({Y}, 3, 2)
  WHEN 2 THEN {Y} || '-' || {M} || '-' || {D}
  WHEN 3 THEN 'Lunes, ' || CAST(day(o_orderdate) AS STRING) || ' de ' || lower({_MONTH_WORDS}) || ' del ' || {Y} || ' 10:30'
  WHEN 4 THEN CAST(day(o_orderdate) AS STRING) || ' ' || {_MONTH_WORDS} || '  ' || {Y} || '.'
  WHEN 5 THEN '5 de Junía de ' || {Y}
  WHEN 6 THEN '31/02/' || {Y}
  ELSE '5 FOO 2025' END"""
# a two-digit year always means 20yy
_THIS_CENTURY = "make_date((2000 + year(o_orderdate) % 100)::INTEGER, month(o_orderdate)::INTEGER, day(o_orderdate)::INTEGER)"
_EXPECTED = f"CASE WHEN o_orderkey % 8 IN (0, 2, 3, 4) THEN o_orderdate::DATE WHEN o_orderkey % 8 = 1 THEN {_THIS_CENTURY} WHEN o_orderkey % 8 = 5 THEN make_date(year(o_orderdate)::INTEGER, 6, 5) END"


def orders_with(t: Tables, expression: str, name: str = "v"):
    return t.orders.withColumn(name, F.expr(expression))


@query("d1_latest_document", """
WITH h AS (SELECT o_orderkey AS id, o_custkey AS invoice, o_orderpriority AS processed, o_orderdate AS cut FROM orders WHERE o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT invoice, id, l_linenumber, l_partkey, l_suppkey FROM h JOIN lineitem ON id = l_orderkey""")
def _(t):
    headers = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("invoice"), "o_orderdate", "o_orderstatus")
    joined = dedup.latest_document(headers, t.lineitem, "invoice", ["o_orderdate"], "o_orderstatus", "F", "last", entity_id="l_orderkey")
    return joined.select("invoice", "id", "l_linenumber", "l_partkey", "l_suppkey")


@query("d1_oldest_document", """
WITH h AS (SELECT o_orderkey AS id, o_custkey AS invoice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey ASC) = 1)
SELECT invoice, id, count(*) AS pages FROM h JOIN lineitem ON id = l_orderkey GROUP BY 1, 2""")
def _(t):
    headers = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("invoice"), "o_orderdate")
    joined = dedup.latest_document(headers, t.lineitem, "invoice", ["o_orderdate"], "", None, "first", entity_id="l_orderkey")
    return joined.groupBy("invoice", "id").agg(F.count(F.lit(1)).alias("pages"))


@query("d2_latest_batch", "SELECT o_custkey, o_orderpriority AS lot, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey DESC) = 1")
def _(t):
    return (dedup.latest_batch(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderkey"])
            .select("o_custkey", F.col("o_orderpriority").alias("lot"), "o_orderkey"))


@query("d3_spanish_date", f"SELECT o_orderkey, {_EXPECTED} AS d FROM orders")
def _(t):
    return orders_with(t, _WRITTEN).select("o_orderkey", dates.spanish_date(F.col("v")).alias("d"))


@query("d4_date_parts", f"""
SELECT o_orderkey, d IS NULL AS unparsed, year(d)::INTEGER AS year, month(d)::INTEGER AS month, strftime(d, '%B') AS month_name, strftime(d, '%A') AS weekday_name
FROM (SELECT o_orderkey, {_EXPECTED} AS d FROM orders)""")
def _(t):
    parsed = orders_with(t, _WRITTEN).select("o_orderkey", dates.spanish_date(F.col("v")).alias("d"))
    return parsed.select("o_orderkey", *dates.date_parts(F.col("d")))


@query("d5_mixed_timestamp", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 2) THEN o_orderdate + INTERVAL 4 HOUR + INTERVAL 28 MINUTE + INTERVAL 1 SECOND
  WHEN o_orderkey % 7 = 1 THEN {_THIS_CENTURY} + INTERVAL 4 HOUR + INTERVAL 28 MINUTE WHEN o_orderkey % 7 = 3 THEN o_orderdate
  WHEN o_orderkey % 7 = 4 THEN {_THIS_CENTURY}::TIMESTAMP
  WHEN o_orderkey % 7 = 5 THEN o_orderdate + INTERVAL 4 HOUR + INTERVAL 28 MINUTE + INTERVAL 1 SECOND END AS at FROM orders""")
def _(t):
    written = f"""CASE o_orderkey % 7
      WHEN 0 THEN {D} || '-' || {M} || '-' || {Y} || ' 04:28:01'
      WHEN 1 THEN {D} || '/' || {M} || '/' || substr({Y}, 3, 2) || '  04:28'
      WHEN 2 THEN {D} || '/' || {M} || '/' || {Y} || '. 04:28:01 EN CLINICA'
      WHEN 3 THEN {D} || '/' || {M} || '/' || {Y} || '\n'
      WHEN 4 THEN {D} || '-' || {M} || '-' || substr({Y}, 3, 2)
      WHEN 5 THEN {D} || {M} || {Y} || '04 28 01'
      ELSE 'NPO' END"""
    return orders_with(t, written).select("o_orderkey", dates.mixed_timestamp(F.col("v")).alias("at"))


_ENTRY = f"CASE WHEN o_orderkey % 6 = 0 THEN 'sin fecha' ELSE 'Ing. ' || {D} || '/' || {M} || '/' || {Y} || ' 09:15 am' END"


@query("d6_entry_time_and_state", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate + INTERVAL 9 HOUR + INTERVAL 15 MINUTE END AS at, CASE WHEN o_orderkey % 6 = 0 THEN 'Formato inválido' ELSE 'Válido' END AS estado_fecha FROM orders""")
def _(t):
    v = F.col("v")
    return orders_with(t, _ENTRY).select("o_orderkey", dates.ddmmyyyy_hhmm(v).alias("at"), dates.ddmmyyyy_hhmm_state(v).alias("estado_fecha"))


@query("d7_strict_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE END AS d FROM orders")
def _(t):
    written = f"CASE o_orderkey % 4 WHEN 0 THEN ' ' || {D} || '/' || {M} || '/' || {Y} || ' ' WHEN 1 THEN '00/00/0000' WHEN 2 THEN CAST(day(o_orderdate) AS STRING) || '/13' ELSE 'x' END"
    return orders_with(t, written).select("o_orderkey", dates.strict_ddmmyyyy(F.col("v")).alias("d"))


@query("d8_digits_and_slashes", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderdate::DATE END AS d FROM orders")
def _(t):
    written = f"CASE o_orderkey % 3 WHEN 0 THEN 'Lima, ' || {D} || '/' || {M} || '/' || {Y} WHEN 1 THEN {D} || ' / ' || {M} || ' / ' || {Y} ELSE 'null' END"
    return orders_with(t, written).select("o_orderkey", dates.digits_and_slashes_date(F.col("v")).alias("d"))


_RUC = "CASE o_orderkey % 4 WHEN 0 THEN 'RUC 2054629' || lpad(CAST(o_custkey AS STRING), 4, '0') || ' X' WHEN 1 THEN '205462926' WHEN 2 THEN '20-54629265-8' ELSE '20100251176' END"


@query("d9_tax_id", rf"""
SELECT o_orderkey, nullif(regexp_extract(v, '\d{{11}}', 0), '') AS first, nullif(regexp_extract(v, '\d{{11}}', 0), '') IS NULL AS invalid,
  CASE WHEN length(regexp_replace(v, '[^0-9]', '', 'g')) = 11 THEN regexp_replace(v, '[^0-9]', '', 'g') END AS exact FROM (SELECT o_orderkey, {_RUC} AS v FROM orders)""")
def _(t):
    v = F.col("v")
    return orders_with(t, _RUC).select("o_orderkey", text.tax_id(v).alias("first"), text.tax_id(v).isNull().alias("invalid"), text.tax_id_exact(v).alias("exact"))


_AUT = "CASE o_orderkey % 4 WHEN 0 THEN lpad(CAST(o_orderkey AS STRING), 10, '0') WHEN 1 THEN 'AB-' || lpad(CAST(o_orderkey AS STRING), 10, '7') WHEN 2 THEN CAST(NULL AS STRING) ELSE '12' END"
_AUT_FEED = "CASE o_orderkey % 3 WHEN 0 THEN lpad(CAST(o_custkey AS STRING), 10, '0') WHEN 1 THEN CAST(o_custkey AS STRING) ELSE CAST(NULL AS STRING) END"


@query("d10_authorisation_code", f"""
SELECT o_orderkey, CASE WHEN length(d) = 10 THEN d WHEN length(f) <> 10 THEN f END AS code
FROM (SELECT o_orderkey, regexp_replace(coalesce({_AUT}, ''), '[^0-9]', '', 'g') AS d, {_AUT_FEED} AS f FROM orders)""")
def _(t):
    df = orders_with(t, _AUT).withColumn("f", F.expr(_AUT_FEED))
    return df.select("o_orderkey", text.authorisation_code(F.col("v"), F.col("f")).alias("code"))


_POLICY = "CASE p_partkey % 6 WHEN 0 THEN ' 12.34,5: ' WHEN 1 THEN 'ABC-1' WHEN 2 THEN '' WHEN 3 THEN 'E' || CAST(p_partkey AS STRING) WHEN 4 THEN lower(p_brand) ELSE CAST(p_partkey AS STRING) || '-' || CAST(p_size AS STRING) END"


@query("d11_policy_number", rf"""
SELECT p_partkey, CASE WHEN regexp_matches(upper(v), '[A-Z]{{2}}') THEN NULL ELSE nullif(v, '') END AS invoice_policy,
  CASE WHEN regexp_matches(upper(v), '[A-Z]{{2}}') THEN 1 WHEN regexp_matches(v, '^[A-Z0-9-]{{3,15}}$') THEN 0 ELSE 1 END AS invoice_invalid,
  CASE WHEN regexp_matches(v, '^[E0-9]') THEN v END AS authorisation_policy, CASE WHEN regexp_matches(v, '^[A-Z0-9-]{{3,15}}$') THEN 0 ELSE 1 END AS authorisation_invalid
FROM (SELECT p_partkey, regexp_replace(regexp_replace({_POLICY}, '\s+', '', 'g'), '[:.,]', '', 'g') AS v FROM part)""")
def _(t):
    v = F.col("v")
    return t.part.withColumn("v", F.expr(_POLICY)).select(
        "p_partkey", text.invoice_policy(v).alias("invoice_policy"), text.invoice_policy_invalid(v).alias("invoice_invalid"),
        text.authorisation_policy(v).alias("authorisation_policy"), text.authorisation_policy_invalid(v).alias("authorisation_invalid"))


_DNI = "CASE o_orderkey % 3 WHEN 0 THEN 'DNI: ' || lpad(CAST(o_custkey AS STRING), 8, '4') WHEN 1 THEN '123' ELSE CAST(NULL AS STRING) END"
_DNI_FEED = "CASE o_orderkey % 4 WHEN 0 THEN ' ' || lpad(CAST(o_custkey AS STRING), 8, '1') || ' ' WHEN 1 THEN 'CE12' WHEN 2 THEN ' ' ELSE CAST(NULL AS STRING) END"


@query("d12_identity_number", r"""
WITH i AS (SELECT o_orderkey, regexp_replace(coalesce(%s, ''), '[^0-9]', '', 'g') AS d, %s AS f FROM orders),
v AS (SELECT o_orderkey, CASE WHEN regexp_matches(d, '^[0-9]{8}$') THEN d ELSE nullif(trim(f), '') END AS dni FROM i)
SELECT o_orderkey, dni, CASE WHEN regexp_matches(dni, '^[0-9]{8}$') THEN 0 ELSE 1 END AS invalid FROM v""" % (_DNI, _DNI_FEED))
def _(t):
    df, v, f = orders_with(t, _DNI).withColumn("f", F.expr(_DNI_FEED)), F.col("v"), F.col("f")
    return df.select("o_orderkey", text.identity_number(v, f).alias("dni"), text.identity_number_invalid(v, f).alias("invalid"))


_INV_A = "CASE o_orderkey % 4 WHEN 0 THEN 'F135' || lpad(CAST(o_orderkey AS STRING), 8, '0') WHEN 1 THEN ' F135-' || lpad(CAST(o_orderkey AS STRING), 8, '0') WHEN 2 THEN '' ELSE 'F135-' || CAST(o_orderkey AS STRING) END"
_INV_B = "'F135-' || lpad(CAST(o_orderkey AS STRING), 8, '0')"


@query("d13_invoice_number_match", rf"""
WITH b AS (SELECT o_orderkey, regexp_replace({_INV_A}, '\s+', '', 'g') AS a, {_INV_B} AS b FROM orders),
n AS (SELECT o_orderkey, CASE WHEN a = '' THEN NULL WHEN strpos(a, '-') > 0 THEN a ELSE substr(a, 1, 4) || '-' || substr(a, 5) END AS normal, b FROM b)
SELECT o_orderkey, normal, CASE WHEN normal IS NULL OR b IS NULL THEN 0 WHEN contains(normal, b) OR contains(b, normal) THEN 1 ELSE 0 END AS coincide FROM n""")
def _(t):
    df = orders_with(t, _INV_A).withColumn("w", F.expr(_INV_B))
    return df.select("o_orderkey", text.invoice_number(F.col("v")).alias("normal"), text.invoice_numbers_match(F.col("v"), F.col("w")).alias("coincide"))


_COMPANY = "CASE p_partkey % 5 WHEN 0 THEN ' ' || upper(p_name) || ' S.A.C., ' WHEN 1 THEN 'null' WHEN 2 THEN '.,' WHEN 3 THEN 'CLINICA VALLE SUR S.A.' ELSE 'CLINICA DELGADO.' END"


@query("d14_company_name", rf"""
SELECT p_partkey, CASE WHEN v IN ('', 'null') THEN NULL WHEN v = 'CLINICA DELGADO' THEN 'MEDIC SER SAC' WHEN v LIKE '%VALLE SUR%' THEN 'CLINICA VALLESUR SA' ELSE v END AS name
FROM (SELECT p_partkey, regexp_replace(replace(replace({_COMPANY}, '.', ''), ',', ''), '^\s+|\s+$', '', 'g') AS v FROM part)""")
def _(t):
    v = text.company_name(F.col("v"), {"CLINICA DELGADO": "MEDIC SER SAC"}, {"VALLE SUR": "CLINICA VALLESUR SA"})
    return t.part.withColumn("v", F.expr(_COMPANY)).select("p_partkey", v.alias("name"))


_DOC = "CASE event_id % 4 WHEN 0 THEN upper(event_type) || ' .' WHEN 1 THEN 'D.n.I ' || event_type WHEN 2 THEN 'N/A' ELSE event_type END"


@query("d15_document_type", rf"""
SELECT event_id, CASE WHEN v NOT IN ('', 'STRING', 'NA', 'N/A') THEN v END AS kind, CASE WHEN v IN ('', 'STRING', 'NA', 'N/A') THEN 0 ELSE 1 END AS valid
FROM (SELECT event_id, upper(regexp_replace({_DOC}, '[^A-Z0-9]', '', 'g')) AS v FROM events)""")
def _(t):
    kind = text.document_type(F.col("v"))
    return t.events.withColumn("v", F.expr(_DOC)).select("event_id", kind.alias("kind"), F.when(kind.isNotNull(), 1).otherwise(0).alias("valid"))


_CMP = "CASE event_id % 4 WHEN 0 THEN 'CMP ' || CAST(event_id AS STRING) WHEN 1 THEN 'string 1' WHEN 2 THEN CAST(NULL AS STRING) ELSE '0.' || CAST(user_id AS STRING) || ',5' END"


@query("d16_licence_code", rf"""
SELECT event_id, CASE WHEN d <> '' AND NOT coalesce(regexp_matches(upper(v), 'STRING|NULL|N/A|NA'), false) THEN d END AS code
FROM (SELECT event_id, v, regexp_replace(coalesce(v, ''), '[^0-9]', '', 'g') AS d FROM (SELECT event_id, {_CMP} AS v FROM events))""")
def _(t):
    return t.events.withColumn("v", F.expr(_CMP)).select("event_id", text.licence_code(F.col("v")).alias("code"))


_AFF = "CASE p_partkey % 7 WHEN 0 THEN '1. Regular' WHEN 1 THEN 'potestativo' WHEN 2 THEN 'S.C.T.R.' WHEN 3 THEN 'soat' WHEN 4 THEN 'n/a' WHEN 5 THEN 'X 1' ELSE p_type END"


@query("d17_affiliation", rf"""
SELECT p_partkey, CASE WHEN length(v) <= 1 OR regexp_matches(v, 'STRING|N/A|NA') THEN NULL WHEN v LIKE '%REG%' THEN 'REGULAR' WHEN v LIKE '%POTEST%' THEN 'POTESTATIVO'
  WHEN v LIKE '%SCT%' THEN 'SCTR' WHEN v LIKE '%SOA%' THEN 'SOAT' ELSE v END AS kind FROM (SELECT p_partkey, regexp_replace(upper({_AFF}), '[^A-Z]', '', 'g') AS v FROM part)""")
def _(t):
    return t.part.withColumn("v", F.expr(_AFF)).select("p_partkey", text.affiliation(F.col("v")).alias("kind"))


_COV = "CASE p_partkey % 8 WHEN 0 THEN 'Ambulatoria onco' WHEN 1 THEN 'ONCOLOGIA HOSPITALARIA' WHEN 2 THEN ' n/a ' WHEN 3 THEN 'Hospitalizacion' WHEN 4 THEN 'emergencia' WHEN 5 THEN CAST(NULL AS STRING) WHEN 6 THEN 'Maternidad' ELSE p_type END"


def _coverage_sql(codes: str) -> str:
    return f"""SELECT p_partkey, CASE WHEN v IN ('n/a', 'na', 'string', '') THEN CASE p_size % 10 {codes} ELSE 'OTROS' END WHEN v LIKE '%ambulato%' THEN 'AMBULATORIO' WHEN v LIKE '%onco%' THEN 'ONCOLOGIA'
  WHEN v LIKE '%preve%' THEN 'PREVENCION' WHEN v LIKE '%mater%' THEN 'MATERNIDAD' WHEN v LIKE '%hospit%' THEN 'HOSPITALARIO' WHEN v LIKE '%emerg%' THEN 'EMERGENCIA' ELSE 'OTROS' END AS coverage
FROM (SELECT p_partkey, p_size, lower(trim({_COV})) AS v FROM part)"""


@query("d18_coverage_class", _coverage_sql("WHEN 4 THEN 'AMBULATORIO'"))
def _(t):
    code = (F.col("p_size") % 10).cast("string")
    return t.part.withColumn("v", F.expr(_COV)).select("p_partkey", text.coverage(F.col("v"), code).alias("coverage"))


@query("d18_coverage_from_code", """
SELECT p_partkey, CASE p_size % 10 WHEN 4 THEN 'AMBULATORIO' WHEN 1 THEN 'HOSPITALARIO' WHEN 5 THEN 'HOSPITALARIO' WHEN 6 THEN 'EMERGENCIA' ELSE 'OTROS' END AS coverage FROM part""")
def _(t):
    code = (F.col("p_size") % 10).cast("string")
    return t.part.select("p_partkey", text.coverage_from_code(code, text.COVERAGE_CODES_CONSOLIDATION).alias("coverage"))


@query("d19_product_family", """
SELECT p_partkey, CASE WHEN v IN ('1','62','59') THEN 'AMC' WHEN v IN ('S') THEN 'EPS'
  WHEN v IN ('4','11','12','38','50','52','53','95','E1','7','49','54','93','2','15','28','34','16','20') THEN 'AMI' ELSE 'OTROS' END AS family
FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'S' WHEN p_partkey % 9 = 1 THEN 'E1' ELSE p_size::VARCHAR END AS v FROM part)""")
def _(t):
    code = F.when(F.col("p_partkey") % 9 == 0, "S").when(F.col("p_partkey") % 9 == 1, "E1").otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", text.product_family(code).alias("family"))


_LKEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_PERCENT = sql_r6(r"try_cast(nullif(regexp_extract(v, '(\d+)%', 1), '') AS DOUBLE) / 100")
_PCT = "CASE l_linenumber % 3 WHEN 0 THEN 'CUBIERTO AL ' || CAST(CAST(round(l_discount * 100) AS INT) AS STRING) || '%' WHEN 1 THEN 'NINGUNO' ELSE '10 y ' || CAST(l_linenumber AS STRING) || '%' END"


@query("d20_percent_share", f"""
SELECT {_LKEY}, {_PERCENT} AS share FROM (SELECT {_LKEY}, {_PCT} AS v FROM lineitem)""")
def _(t):
    return t.lineitem.withColumn("v", F.expr(_PCT)).select(*_LKEY.split(", "), r6(money.percent_share(F.col("v"))).alias("share"))


_COPAY = "CASE l_linenumber % 5 WHEN 0 THEN 'S/. ' || CAST(CAST(l_quantity AS INT) AS STRING) || '.50 (con IGV)' WHEN 1 THEN '1 DIA DE CUARTO' WHEN 2 THEN 'Ninguna' WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' SOLES POR 2' ELSE CAST(NULL AS STRING) END"


@query("d21_first_number", rf"""
SELECT {_LKEY}, try_cast(nullif(regexp_extract(v, '\d+(?:\.\d+)?', 0), '') AS DOUBLE) AS number,
  CASE WHEN NOT lower(v) LIKE '%cuarto%' THEN try_cast(nullif(regexp_extract(v, '\d+(?:\.\d+)?', 0), '') AS DOUBLE) END AS copay FROM (SELECT {_LKEY}, {_COPAY} AS v FROM lineitem)""")
def _(t):
    v = F.col("v")
    return t.lineitem.withColumn("v", F.expr(_COPAY)).select(*_LKEY.split(", "), money.first_number(v).alias("number"), money.fixed_copay(v).alias("copay"))


_DX = "CASE p_partkey % 7 WHEN 0 THEN '1' || lpad(CAST(p_size AS STRING), 3, '2') WHEN 1 THEN '0' || lpad(CAST(p_size AS STRING), 3, '8') WHEN 2 THEN 'J06.9' WHEN 3 THEN 'CIE10' WHEN 4 THEN ' N/A' WHEN 5 THEN '12345' ELSE ' A0,' || CAST(p_size AS STRING) || ' ' END"


@query("d22_diagnosis_code", rf"""
SELECT p_partkey, CASE WHEN regexp_matches(v, 'CIE10|N/A') THEN NULL WHEN regexp_matches(v, '^1\d{{3}}$') THEN 'I' || substr(v, 2) WHEN regexp_matches(v, '^0\d{{3}}$') THEN 'O' || substr(v, 2) ELSE v END AS code
FROM (SELECT p_partkey, trim(regexp_replace({_DX}, '[.,]', '', 'g')) AS v FROM part)""")
def _(t):
    return t.part.withColumn("v", F.expr(_DX)).select("p_partkey", text.diagnosis_code(F.col("v")).alias("code"))


_FIELD = "CASE o_orderkey % 5 WHEN 0 THEN 'N. ' || CAST(o_orderkey AS STRING) WHEN 1 THEN 'string' WHEN 2 THEN '' WHEN 3 THEN 'x' ELSE CAST(NULL AS STRING) END"
_FIELD_FEED = "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN 'n/a' ELSE CAST(NULL AS STRING) END"


@query("d23_field_with_fallback", rf"""
SELECT o_orderkey, CASE WHEN a IS NULL THEN b WHEN regexp_matches(upper(a), 'STRING|N/A|NA|^$') THEN NULL ELSE regexp_replace(a, '[^0-9]', '', 'g') END AS value,
  CASE WHEN coalesce(a, b) IS NULL THEN 1 WHEN regexp_matches(upper(coalesce(a, b)), 'STRING|N/A|NA|^$') THEN 1 WHEN regexp_replace(coalesce(a, b), '[^0-9]', '', 'g') = '' THEN 1 ELSE 0 END AS invalid
FROM (SELECT o_orderkey, {_FIELD} AS a, {_FIELD_FEED} AS b FROM orders)""")
def _(t):
    df, a, b = orders_with(t, _FIELD, "a").withColumn("b", F.expr(_FIELD_FEED)), F.col("a"), F.col("b")
    return df.select("o_orderkey", text.field_with_fallback(a, b).alias("value"), text.field_with_fallback_invalid(a, b).alias("invalid"))


_AMOUNT = "CASE o_orderkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE o_totalprice END"
_AMOUNT_FEED = "CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice + 1 END"


@query("d24_amount_fallback", f"SELECT o_orderkey, CASE WHEN f IS NOT NULL AND (a = 0 OR a IS NULL) THEN f ELSE a END AS amount FROM (SELECT o_orderkey, ({_AMOUNT})::DOUBLE AS a, {_AMOUNT_FEED} AS f FROM orders)")
def _(t):
    df = orders_with(t, _AMOUNT, "a").withColumn("f", F.expr(_AMOUNT_FEED))
    return df.select("o_orderkey", money.amount_with_fallback(F.col("a").cast("double"), F.col("f")).alias("amount"))


_MONEY = """CASE o_orderkey % 6 WHEN 0 THEN 'S/. ' || CAST(o_custkey % 90 + 10 AS STRING) || ',' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || '.50' WHEN 1 THEN '80%' WHEN 2 THEN 'TOPE'
  WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN 's/' || CAST(o_custkey AS STRING) ELSE 'S/ ' || CAST(o_custkey AS STRING) || '.25 soles' END"""


@query("d25_money_text", rf"""
SELECT o_orderkey, CASE WHEN NOT regexp_matches(lower(coalesce(v, '')), '%|tope|saldo') THEN try_cast(nullif(regexp_extract(
  replace(replace(replace(replace(replace(replace(coalesce(v, ''), 'S/. ', ''), 'S/.', ''), 's/. ', ''), 'S/', ''), 's/', ''), ',', ''), '\d+(?:\.\d+)?', 0), '') AS DECIMAL(38,9)) END AS amount
FROM (SELECT o_orderkey, {_MONEY} AS v FROM orders)""")
def _(t):
    return orders_with(t, _MONEY).select("o_orderkey", money.money_text(F.col("v")).alias("amount"))


@query("d26_letter_amount", """
SELECT o_orderkey, CASE WHEN a IS NULL OR a = 0 OR a < o_totalprice THEN o_totalprice ELSE a END AS amount
FROM (SELECT o_orderkey, o_totalprice, CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN o_totalprice / 2 ELSE o_totalprice * 2 END AS a FROM orders)""")
def _(t):
    df = orders_with(t, "CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN o_totalprice / 2 ELSE o_totalprice * 2 END", "a")
    return df.select("o_orderkey", money.letter_amount(F.col("a"), F.col("o_totalprice")).alias("amount"))


_MECH = "CASE o_orderkey % 7 WHEN 0 THEN 'Pago por Servicios' WHEN 1 THEN 'cpm' WHEN 2 THEN 'AMBULATORIO CPM' WHEN 3 THEN 'Paquete quirurgico' WHEN 4 THEN 'PACIENTE MES CRONICO' WHEN 5 THEN ' ' ELSE o_orderpriority END"


@query("d27_payment_mechanism", f"""
SELECT o_orderkey, CASE upper(v) WHEN 'PAGO POR SERVICIOS' THEN 'PPS' WHEN 'CPM' THEN 'CPM' WHEN 'AMBULATORIO CPM' THEN 'CPM' WHEN 'PAQUETE QUIRURGICO' THEN 'PQ' WHEN 'PACIENTE MES CRONICO' THEN 'PMC' END AS mechanism
FROM (SELECT o_orderkey, {_MECH} AS v FROM orders)""")
def _(t):
    return orders_with(t, _MECH).select("o_orderkey", money.payment_mechanism(F.col("v")).alias("mechanism"))


_COINS = "CASE l_linenumber % 4 WHEN 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '%' WHEN 1 THEN '0 %' WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.97' ELSE CAST(CAST(l_quantity AS INT) * 5 AS STRING) END"


@query("d28_coinsurance", rf"""
SELECT {_LKEY}, CASE WHEN NOT regexp_matches(v, '[.,]') AND regexp_matches(trim(replace(v, '%', '')), '^\d+$') AND trim(replace(v, '%', ''))::BIGINT % 5 = 0 THEN trim(replace(v, '%', ''))::BIGINT END AS pct
FROM (SELECT {_LKEY}, {_COINS} AS v FROM lineitem)""")
def _(t):
    return t.lineitem.withColumn("v", F.expr(_COINS)).select(*_LKEY.split(", "), money.coinsurance_percent(F.col("v")).alias("pct"))


@query("d29_text_normal_form", rf"""
SELECT doc_id, upper(regexp_replace(translate(regexp_replace(regexp_replace(translate(replace(text, 'ß', 'SS'), '{text.DX_ACCENTED}', '{text.DX_PLAIN}'), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'),
  '{text.GREEK_LOOKALIKES}', '{text.LATIN_LOOKALIKES}'), '\s+', ' ', 'g')) AS normal FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.text_normal_form(F.col("text")).alias("normal"))


_DIAG = """CASE o_orderkey % 6 WHEN 0 THEN ' fiebre  del Dengue' WHEN 1 THEN 'Pancreatitis aguda' WHEN 2 THEN 'Ruptura traumatica de ligamentos de la muñeca y del carpo'
  WHEN 3 THEN 'Migraña complicada' WHEN 4 THEN CAST(NULL AS STRING) ELSE 'x ' || o_orderpriority END"""


@query("d30_diagnosis_equivalence", f"""
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'FIEBRE DEL DENGUE [DENGUE CLASICO]' WHEN 1 THEN 'PANCREATITIS AGUDA' WHEN 3 THEN 'Migraña (antecedente)' ELSE {_DIAG} END AS dx FROM orders""")
def _(t):
    equal = lookups.diagnosis_equivalences(t.spark)
    return map_diagnosis(orders_with(t, _DIAG), F.col("v"), equal, "mapped").select("o_orderkey", F.col("mapped").alias("dx"))


_REF = "CASE o_orderkey % 3 WHEN 0 THEN 'F135-' || CAST(o_orderkey AS STRING) WHEN 1 THEN 'null' ELSE 'F135-123456789012' END"


@query("d31_reference_number", f"SELECT o_orderkey, CASE WHEN v IS NULL OR lower(v) = 'null' THEN NULL ELSE substr(v, 1, 5) || lpad(substr(v, 6), 8, '0') END AS ref FROM (SELECT o_orderkey, {_REF} AS v FROM orders)")
def _(t):
    return orders_with(t, _REF).select("o_orderkey", text.reference_number(F.col("v")).alias("ref"))


@query("d32_invoice_projection", f"""
SELECT 'F' || lpad(o_orderkey::VARCHAR, 8, '0') AS num_factura_documento_ocr, o_totalprice AS monto_factura_ocr,
  CASE o_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS flag_compania_factura_ocr, flag_medicamento_factura_ocr
FROM orders LEFT JOIN (SELECT l_orderkey, max(CASE WHEN upper(p_name) LIKE '%RING%' THEN 1 ELSE 0 END) AS flag_medicamento_factura_ocr FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) ON o_orderkey = l_orderkey""")
def _(t):
    flags = (t.lineitem.join(t.part, t.lineitem.l_partkey == t.part.p_partkey).groupBy("l_orderkey")
             .agg(any_flag(F.upper("p_name").contains("RING")).alias("flag_medicamento_factura_ocr")))
    company = F.when(F.col("o_custkey") % 3 == 0, 1).when(F.col("o_custkey") % 3 == 1, 2).otherwise(0)
    return (t.orders.join(flags, t.orders.o_orderkey == flags.l_orderkey, "left")
            .select(text.series_number(F.lit("F"), F.col("o_orderkey").cast("string")).alias("num_factura_documento_ocr"),
                    F.col("o_totalprice").alias("monto_factura_ocr"), company.alias("flag_compania_factura_ocr"), "flag_medicamento_factura_ocr"))


@query("d33_unify_settlements", """
SELECT l_orderkey, l_suppkey, max(l_extendedprice) AS total, max(l_shipdate) AS entry, max(l_quantity) AS sub2, max(l_tax) AS deductible FROM lineitem GROUP BY ALL""")
def _(t):
    measures = {"total": "l_extendedprice", "entry": "l_shipdate", "sub2": "l_quantity", "deductible": "l_tax"}
    return t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(*[F.max(c).alias(n) for n, c in measures.items()])
