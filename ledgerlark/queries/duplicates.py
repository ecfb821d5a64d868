"""Duplicate-payment rules over invoices and claims made from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import flag
from ..operators.waterfall import match_waterfall
from ..plans import duplicates as dup
from .registry import Tables, query

K, C = "o_orderkey", "o_custkey"
YEAR_DAY = f"(CAST(concat(year(o_orderdate), '-01-01') AS DATE) + CAST({K} % 3 AS INT))"
AMOUNT = "CAST(floor(o_totalprice / 20000) * 10.25 AS DOUBLE)"
INVOICES = {
    "id": f"concat('F', {K}, 'R', {C} % 20)", "num_factura_documento_ocr": f"concat('F', {K})", "ruc_proveedor_emisor_ocr": f"concat('R', {C} % 20)",
    "dni_factura_ocr": f"concat('D', {C})", "num_siteds_ocr_val": f"CASE WHEN {K} % 7 <> 0 THEN concat('A', {C} * 2 + {K} % 2) END",
    "fecha_emision_siteds_ocr": f"(CAST(concat(year(o_orderdate), '-01-01') AS DATE) + CAST(CASE {K} % 11 WHEN 0 THEN -400 WHEN 1 THEN -7300 WHEN 2 THEN 40 ELSE {K} % 4 END AS INT))", "num_poliza_siteds_ocr": f"concat('P', {C} % 100)",
    "monto_factura_ocr": AMOUNT, "cie10_siteds_ocr": f"concat('J', {K} % 3)", "cod_cie101_trama_sited": f"concat('J', {K} % 2)",
    "processed_date": "(CAST(o_orderdate AS DATE) + CAST(300 AS INT))", "mecanismo_pago_fact_trama": f"CASE WHEN {K} % 2 = 0 THEN '02' ELSE '01' END",
    "codigoproducto_trama": f"concat('X', {K} % 2)", "mecanismo_liqui_ocr": "'01'", "numero_carta_garantia": f"concat('25-', {C} % 10)", "version": "1",
    "cod_autorizacion": f"CASE WHEN {K} % 7 <> 0 THEN concat('A', {C} * 2 + {K} % 2) END", "cod_producto_ax": f"concat('Y', {K} % 2)",
    "cod_proveedor_rs": f"concat('V', {C} % 20)", "cod_sede_proveedor": f"concat('S', {K} % 2)", "cod_contratante_origen_sistema": f"concat('C', {C} % 30)",
    "id_persona_afiliado": f"concat('M', {C})", "cod_cobertura": f"concat('B', {K} % 2)", "fec_autorizacion_rs": YEAR_DAY, "cod_tipo_contrato": f"{K} % 3",
}
CLAIMS = {
    "fec_ocurrencia": YEAR_DAY, "fec_liquidacion": f"(CAST(o_orderdate AS DATE) + CAST({K} % 60 AS INT))", "est_cuenta_por_pagar": f"CASE {K} % 3 WHEN 0 THEN 'PAG' WHEN 1 THEN 'OPT' END",
    "id_estado_siniestro_origen": f"CASE {K} % 5 WHEN 0 THEN '4' WHEN 1 THEN '8' WHEN 2 THEN 'T' WHEN 3 THEN '5' ELSE '4' END", "des_estado_siniestro_origen": "o_orderstatus",
    "num_siniestro": f"concat('N', {K})", "factura": f"CASE WHEN {K} % 4 = 0 THEN concat('F', {K}) ELSE concat('F', {K} + 1000000) END", "imp_documento": AMOUNT,
    "c_estado": f"CASE {K} % 5 WHEN 0 THEN '4' WHEN 1 THEN '8' WHEN 2 THEN 'T' WHEN 3 THEN '5' ELSE '4' END", "c_id_persona_proveedor_siniestro": f"concat('V', {C} % 20)",
    "c_id_persona_afiliado": f"concat('M', {C})", "c_id_contratante": f"concat('C', {C} % 30)", "c_id_producto": f"concat('Y', {K} % 2)", "c_id_cobertura_origen": f"concat('B', {K} % 2)",
    "c_num_diagnostico_origen": f"concat('J', {K} % 2)", "c_id_autorizacion": f"concat('A', {C} * 2 + {K} % 2)", "c_cod_mecanismo_pago": f"CASE WHEN {K} % 3 = 0 THEN '01' ELSE '02' END",
    "c_num_documento_proveedor_siniestro": f"concat('R', {C} % 20)", "c_imp_documento": AMOUNT, "c_num_documento_afiliado": f"concat('D', {C})", "c_num_poliza": f"concat('P', {C} % 100)",
    "c_cod_producto": f"concat('X', {K} % 2)", "c_carta_garantia": f"concat('25-', {C} % 10)", "c_cod_sede_proveedor_siniestro": f"concat('S', {K} % 3)", "c_cod_tipo_contrato": f"{K} % 3",
    "c_ind_devoluc": f"CASE WHEN {K} % 2 = 0 THEN 'Rechazo_Definitivo' ELSE 'Rechazo_No_Definitivo' END",
}
BASE = ("WITH inv AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in INVOICES.items()) + " FROM orders), clm AS (SELECT "
        + ", ".join(f"{e} AS {n}" for n, e in CLAIMS.items()) + " FROM orders)")
ROW = ", ".join(dup.PAYLOAD)
_AMT, _DAY = "trunc(monto_factura_ocr) = trunc(c_imp_documento)", "fec_autorizacion_rs = fec_ocurrencia"
_DATED, _PAID, _REG = "processed_date >= fec_liquidacion", "c_estado IN ('4', '8', 'T')", "cod_autorizacion IS NOT NULL"
_ATT = f"cod_proveedor_rs = c_id_persona_proveedor_siniestro AND id_persona_afiliado = c_id_persona_afiliado AND cod_contratante_origen_sistema = c_id_contratante AND cod_producto_ax = c_id_producto AND cod_cobertura = c_id_cobertura_origen AND cod_cie101_trama_sited = c_num_diagnostico_origen AND {_AMT}"
_SCAN = f"ruc_proveedor_emisor_ocr = c_num_documento_proveedor_siniestro AND dni_factura_ocr = c_num_documento_afiliado AND num_poliza_siteds_ocr = c_num_poliza AND codigoproducto_trama = c_cod_producto AND cie10_siteds_ocr = c_num_diagnostico_origen AND {_AMT}"
_NEAR = "fec_ocurrencia BETWEEN fecha_emision_siteds_ocr - 5 AND fec_autorizacion_rs + 5"
_SITE, _CONTRACT = " AND cod_sede_proveedor = c_cod_sede_proveedor_siniestro", " AND cod_tipo_contrato = c_cod_tipo_contrato"


def conditions(by_site: bool = False) -> dict[int, str]:
    site, contract = (_SITE, _CONTRACT) if by_site else ("", "")
    return {
        1: f"{_REG} AND cod_autorizacion = c_id_autorizacion AND cod_proveedor_rs = c_id_persona_proveedor_siniestro AND id_persona_afiliado = c_id_persona_afiliado AND {_AMT} AND {_DAY} AND {_DATED} AND {_PAID}{site}",
        2: f"{_REG} AND cod_autorizacion = c_id_autorizacion AND trunc(c_imp_documento) BETWEEN trunc(monto_factura_ocr) - 50 AND trunc(monto_factura_ocr) + 50 AND c_cod_mecanismo_pago = '01' AND mecanismo_pago_fact_trama = '02' AND cie10_siteds_ocr = c_num_diagnostico_origen AND {_DAY} AND {_DATED} AND {_PAID}",
        3: f"num_factura_documento_ocr = factura AND ruc_proveedor_emisor_ocr = c_num_documento_proveedor_siniestro AND {_DATED} AND {_PAID}",
        4: f"{_REG} AND cod_proveedor_rs = c_id_persona_proveedor_siniestro AND id_persona_afiliado = c_id_persona_afiliado AND cod_contratante_origen_sistema = c_id_contratante AND c_cod_mecanismo_pago = '02' AND mecanismo_pago_fact_trama = '02' AND date_trunc('month', fec_autorizacion_rs) = date_trunc('month', fec_ocurrencia) AND {_DATED} AND {_PAID}{site}{contract}",
        5: f"{_REG} AND {_ATT} AND {_DAY} AND {_DATED} AND {_PAID}",
        6: f"{_SCAN} AND {_DAY} AND {_DATED} AND {_PAID}",
        7: f"{_SCAN} AND numero_carta_garantia = c_carta_garantia AND {_NEAR} AND {_DATED} AND {_PAID}",
        8: f"{_ATT} AND {_NEAR} AND c_estado = '5' AND c_ind_devoluc = 'Rechazo_Definitivo'",
    }


ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in dup.PAYLOAD)


def invoices(t: Tables):
    return t.orders.select(*[F.expr(e).alias(n) for n, e in INVOICES.items()])


def claims(t: Tables):
    return t.orders.select(*[F.expr(e).alias(n) for n, e in CLAIMS.items()])


def run(t: Tables, rules):
    return match_waterfall(invoices(t), claims(t), rules, id="id", own="num_factura_documento_ocr", as_of=F.col("processed_date"),
                           since=F.col("fec_liquidacion"), other="factura", payload=dup.PAYLOAD, newest=["fec_ocurrencia"])


def _single(rank: int) -> str:
    unique = "HAVING count(*) = 1" if rank in (5, 6) else ""
    return f"""{BASE}, m AS (SELECT DISTINCT id, num_factura_documento_ocr AS own, {ROW} FROM inv JOIN clm ON {conditions()[rank]})
SELECT id, count(*) AS n_matches, first(factura ORDER BY {ORDER}) AS newest, first(num_siniestro ORDER BY {ORDER}) AS claim,
  first(factura ORDER BY {ORDER}) FILTER (own <> factura) AS newest_other FROM m GROUP BY 1 {unique}"""


NAMES = {1: "k1_same_authorisation", 2: "k2_near_amount_mechanism", 3: "k3_same_invoice_number", 4: "k4_same_month_cpm", 5: "k5_same_attention",
         6: "k6_same_scanned_attention", 7: "k7_letter_within_days", 8: "k8_definitive_refund"}


def _rule_query(rank: int) -> None:
    @query(NAMES[rank], _single(rank))
    def _(t):
        found = run(t, [r for r in dup.rules() if r.rank == rank])
        return found.select("id", "n_matches", F.col("best.factura").alias("newest"), F.col("best.num_siniestro").alias("claim"),
                            F.col("best_other.factura").alias("newest_other"))


for _rank in NAMES:
    _rule_query(_rank)


@query("k0_prepared_invoices", """
WITH letters AS (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'N' || o_custkey || '-2' WHEN 1 THEN 'N1' ELSE 'Nx-y' END AS nro FROM orders)
SELECT o_custkey, o_orderkey, CASE WHEN len(string_split(nro, '-')) = 2 THEN '25-' || try_cast(substr(string_split(nro, '-')[1], 2) AS BIGINT) END AS letter,
  CASE WHEN len(string_split(nro, '-')) = 2 THEN try_cast(string_split(nro, '-')[2] AS BIGINT) END AS version,
  CASE WHEN o_orderstatus = 'F' THEN '01' WHEN o_orderstatus = 'O' THEN '02' END AS mechanism
FROM letters QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey ASC) = 1""")
def _(t):
    nro = F.expr("CASE o_orderkey % 3 WHEN 0 THEN concat('N', o_custkey, '-2') WHEN 1 THEN 'N1' ELSE 'Nx-y' END")
    none = F.lit(None).cast("string")
    source = t.orders.select(
        F.col("o_custkey").alias("num_factura_documento_ocr"), F.col("o_orderkey").cast("string").alias("ruc_proveedor_emisor_ocr"),
        F.col("o_orderdate").alias("fecha_emision_siteds_ocr"), nro.alias("nro_carta"), F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderstatus") == "F", "PPS").when(F.col("o_orderstatus") == "O", "CPM").alias("mecanismo_liqui_ocr"),
        F.lit("2024-01-01").alias("processed_date"),
        *[none.alias(c) for c in ("num_documento_paciente_siteds_ocr_val", "dni_factura_ocr", "cod_autorizacion_factura_ocr", "num_siteds_ocr_val",
                                  "num_poliza_siteds_ocr", "monto_factura_ocr", "cie10_siteds_ocr", "cod_cie101_trama_sited",
                                  "mecanismo_pago_fact_trama", "codigoproducto_trama")])
    prepared = dup.prepare_invoices(source, ["key"])
    return prepared.select(F.col("num_factura_documento_ocr").alias("o_custkey"), F.col("ruc_proveedor_emisor_ocr").cast("bigint").alias("o_orderkey"),
                           F.col("numero_carta_garantia").alias("letter"), "version", F.col("mecanismo_liqui_ocr").alias("mechanism"))


def waterfall_sql(by_site: bool = False) -> str:
    steps, earlier = [], []
    for rank, condition in conditions(by_site).items():
        blocked = " AND ".join(f"id NOT IN (SELECT id FROM x{e})" for e in earlier) or "true"
        body = f"SELECT DISTINCT id, num_factura_documento_ocr AS own, processed_date, {rank} AS rule, {ROW} FROM inv JOIN clm ON {condition} WHERE {blocked}"
        if rank in (5, 6):
            body = f"SELECT * FROM ({body}) QUALIFY count(*) OVER (PARTITION BY id) = 1"
        steps.append(f"x{rank} AS MATERIALIZED ({body})")
        earlier.append(rank)
    union = " UNION ALL ".join(f"SELECT * FROM x{r}" for r in earlier)
    return f"{BASE}, {', '.join(steps)}, hits AS ({union})"


SUMMARY = f"""SELECT id, rule, count(*) AS n_matches, first(factura ORDER BY {ORDER}) AS newest, first(factura ORDER BY {ORDER}) FILTER (own <> factura) AS newest_other FROM hits GROUP BY 1, 2"""


@query("k_waterfall", f"{waterfall_sql()} {SUMMARY}")
def _(t):
    return run(t, dup.rules()).select("id", "rule", "n_matches", F.col("best.factura").alias("newest"), F.col("best_other.factura").alias("newest_other"))


@query("k11_waterfall_by_site", f"{waterfall_sql(True)} {SUMMARY}")
def _(t):
    return run(t, dup.rules(by_site=True)).select("id", "rule", "n_matches", F.col("best.factura").alias("newest"), F.col("best_other.factura").alias("newest_other"))


@query("k9_rule_results", f"""{waterfall_sql()}, top AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {ORDER}) AS rn FROM hits)
SELECT id, CASE WHEN rule = 3 AND fec_liquidacion <> processed_date THEN 0 WHEN rule = 8 THEN 0 ELSE 1 END AS flag_dup,
  fec_ocurrencia AS fec_atencion, fec_liquidacion, num_siniestro FROM top WHERE rn = 1""")
def _(t):
    matches = run(t, dup.rules()).join(invoices(t).select("id", "processed_date"), "id")
    return dup.rule_results(matches).select("id", "flag_dup", F.col("best.fec_ocurrencia").alias("fec_atencion"),
                                            F.col("best.fec_liquidacion").alias("fec_liquidacion"), F.col("best.num_siniestro").alias("num_siniestro"))


FINAL = f"""final AS (
  SELECT *, 1 AS flag_dup, 0 AS flag_devolucion FROM hits WHERE rule NOT IN (3, 8) AND own <> factura QUALIFY row_number() OVER (PARTITION BY id ORDER BY {ORDER}) = 1
  UNION ALL SELECT *, 0, 1 FROM hits WHERE rule = 8 QUALIFY row_number() OVER (PARTITION BY id ORDER BY {ORDER}) = 1)"""


@query("k10_duplicate_payments", f"""{waterfall_sql()}, {FINAL}
SELECT id, flag_dup, flag_devolucion, factura AS factura_duplicada, fec_ocurrencia AS fec_atencion, imp_documento AS monto_duplicado,
  CASE WHEN rule = 8 THEN '' WHEN est_cuenta_por_pagar = 'PAG' THEN 'Pagado' WHEN est_cuenta_por_pagar IN ('OPT', 'PGP') THEN 'Pendiente Pago' END AS dsc_abono FROM final""")
def _(t):
    found = dup.duplicate_payments(invoices(t), run(t, dup.rules()))
    return found.select("id", "flag_dup", "flag_devolucion", "factura_duplicada", "fec_atencion", "monto_duplicado", "dsc_abono")


@query("k12_attach_duplicates", f"""{waterfall_sql(True)}, {FINAL}
SELECT inv.id, flag_dup, factura AS factura_duplicada, f.num_siniestro AS "num_siniestro_factDup" FROM inv LEFT JOIN final f ON inv.num_factura_documento_ocr = f.own""")
def _(t):
    found = dup.duplicate_payments(invoices(t), run(t, dup.rules(by_site=True)))
    return dup.attach_duplicates(invoices(t), found).select("id", "flag_dup", "factura_duplicada", "num_siniestro_factDup")


@query("r5_duplicate_payment", f"""{waterfall_sql()}, {FINAL}
SELECT inv.id, CASE WHEN flag_dup = 1 THEN 1 ELSE 0 END AS flag FROM inv LEFT JOIN final f ON inv.num_factura_documento_ocr = f.own""")
def _(t):
    found = dup.attach_duplicates(invoices(t), dup.duplicate_payments(invoices(t), run(t, dup.rules())))
    return found.select("id", flag(F.col("flag_dup") == 1).alias("flag"))
