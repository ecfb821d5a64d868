"""Consolidation, claims views, reports and incremental writes over stand-ins made from orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.text import label_map, series_number
from ..operators.joins import bridge
from ..plans import claims as claim_plans
from ..plans import consolidation, enrichment, provider_feed, reports
from ..plans.config import AuditConfig
from ..sources import incremental, io, lookups
from .registry import Tables, query, r6, sql_r6

K, C, P = "o_orderkey", "o_custkey", "o_totalprice"
CONFIG = AuditConfig(network="CENTRAL", insurer="Seguros", period="2024-01-01", today=dt.date(2024, 1, 15))
NUM, RUC = f"concat('F', {K})", f"concat('R', {C} % 7)"


def view(t: Tables, columns: dict[str, str], where: str = "true", table: str = "orders"):
    df = getattr(t, table).where(where).select(*[F.expr(e).alias(n) for n, e in columns.items()])
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def cte(name: str, columns: dict[str, str], where: str = "true", table: str = "orders") -> str:
    return f"{name} AS (SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {table} WHERE {where})"


# --- consolidation ---------------------------------------------------------------------
DOCS = {
    "inv": ({"num_factura_documento_ocr": NUM, "ruc_proveedor_emisor_ocr": f"CASE WHEN {K} % 10 <> 0 THEN {RUC} END", "monto_factura_ocr": P}, "true"),
    "aut": ({"page_path": "'p'", "num_factura_siteds_ocr": NUM, "ruc_emisor_path": f"CASE WHEN {K} % 9 = 0 THEN 'R9' ELSE {RUC} END", "cie10_siteds_ocr": "o_orderpriority"}, f"{P} > 60000"),
    "nc": ({"documento_id": "'d'", "num_factura_notacredito_ocr": NUM, "subtotal_ocr_nc": f"{P} / 2"}, "o_orderstatus = 'F'"),
    "pre": ({"num_factura_preliqui_ocr": NUM, "monto_total_preliqui_ocr": P}, "o_orderstatus = 'O'"),
    "liq": ({"num_factura_liqui_ocr": NUM, "ruc_liqui_ocr": RUC, "mecanismo_liqui_ocr": "'PPS'"}, f"{P} > 90000"),
    "cg": ({"page_path": "'p'", "documento_id": "'d'", "num_factura_cartagarantia_ocr": NUM, "ruc_cg_ocr": RUC, "nro_carta": "o_orderpriority"}, "o_orderstatus <> 'P'"),
    "epi": ({"num_factura_epicrisis_ocr": NUM, "ruc_epi_ocr": RUC, "dias_hosp_epi_ocr": "1.5"}, "o_orderpriority = '1-URGENT'"),
    "rc": ({"num_factura_rc_ocr": NUM, "ruc_rc_ocr": RUC}, "o_orderpriority <> '5-LOW'"),
}
CONSOLIDATED = ["num_factura_documento_ocr", "ruc_proveedor_emisor_ocr", "cie10_siteds_ocr", "subtotal_ocr_nc", "monto_total_preliqui_ocr",
                "mecanismo_liqui_ocr", "nro_carta", "num_factura_epicrisis_ocr", "num_factura_rc_ocr"]


@query("e1_consolidated_invoice", f"""WITH {", ".join(cte(n, c, w) for n, (c, w) in DOCS.items())}
SELECT DISTINCT {", ".join(CONSOLIDATED)}, CASE WHEN num_factura_siteds_ocr IS NULL THEN 1 ELSE 0 END AS "flag_sinSiteds" FROM inv
LEFT JOIN aut ON num_factura_documento_ocr = num_factura_siteds_ocr AND ruc_proveedor_emisor_ocr = ruc_emisor_path LEFT JOIN nc ON num_factura_documento_ocr = num_factura_notacredito_ocr
LEFT JOIN pre ON num_factura_documento_ocr = num_factura_preliqui_ocr LEFT JOIN liq ON num_factura_documento_ocr = num_factura_liqui_ocr AND ruc_proveedor_emisor_ocr = ruc_liqui_ocr
LEFT JOIN cg ON num_factura_documento_ocr = num_factura_cartagarantia_ocr AND ruc_proveedor_emisor_ocr = ruc_cg_ocr LEFT JOIN epi ON num_factura_documento_ocr = num_factura_epicrisis_ocr AND ruc_proveedor_emisor_ocr = ruc_epi_ocr
LEFT JOIN rc ON num_factura_documento_ocr = num_factura_rc_ocr AND ruc_proveedor_emisor_ocr = ruc_rc_ocr WHERE ruc_proveedor_emisor_ocr IS NOT NULL""")
def _(t):
    return consolidation.consolidate(*[view(t, c, w) for c, w in DOCS.values()]).select(*CONSOLIDATED, "flag_sinSiteds")


DASHED, BARE = f"concat('F1-', {K})", f"concat('F1', {K})"
CONS = {"num_factura_documento_ocr": DASHED, "num_factura_siteds_ocr": DASHED, "ruc_proveedor_emisor_ocr": RUC, "importe_total_ocr_nc": f"{P}",
        "monto_sub_factura_ocr": f"{P} * 2", "fecha_emision_siteds_ocr": "o_orderdate"}
FEEDS = {
    "cr": ({"numero_de_documento_de_pago": BARE, "ruc_tramaNC": RUC, "TIPONOTA": "CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'D' END", "MONTONOTA": P, "FECHANOTA": "CAST(o_orderdate AS DATE)"}, "true"),
    "le": ({"num_factura_trama_carta": BARE, "ruc_tramaCG": RUC}, "o_orderpriority = '2-HIGH'"),
    "fa": ({"numero_de_documento_de_pago": BARE, "ruc_tramas": RUC, "subtotal_tramas": f"{P} / 3", "descripcion_tramas": "'01'"}, "o_orderstatus <> 'P'"),
    "sh": ({"num_factura_trama_sited": BARE, "RUCIPRESS": RUC, "CODIGOCIE101": "'J0.6'", "CODIGOCIE102": "CAST(NULL AS STRING)", "CODIGOCIE103": "'A.1'", "TIPOCOBERTURA": f"CAST({K} % 10 AS STRING)"}, f"{P} > 50000"),
}


@query("e2_feed_columns", f"""WITH {cte('c', CONS)}, {", ".join(cte(n, x, w) for n, (x, w) in FEEDS.items())}
SELECT replace(c.num_factura_documento_ocr, '-', '') AS num_factura_documento_ocr, CASE WHEN cr.numero_de_documento_de_pago IS NOT NULL THEN 1 ELSE 0 END AS "flag_conNC_trama", monto_sub_factura_ocr - "MONTONOTA" AS dif,
  CASE WHEN num_factura_trama_carta IS NOT NULL THEN 1 ELSE 0 END AS "flag_conCG_trama", subtotal_tramas AS subtotal_fact_trama, replace("CODIGOCIE101", '.', '') AS cod_cie101_trama_sited,
  CASE try_cast("TIPOCOBERTURA" AS BIGINT) WHEN 4 THEN 'AMBULATORIO' WHEN 1 THEN 'HOSPITALARIO' WHEN 5 THEN 'HOSPITALARIO' WHEN 6 THEN 'EMERGENCIA' ELSE 'OTROS' END AS cobertura_siteds_trama
FROM c LEFT JOIN (SELECT * FROM cr WHERE "TIPONOTA" = 'C') cr ON replace(c.num_factura_documento_ocr, '-', '') = cr.numero_de_documento_de_pago AND ruc_proveedor_emisor_ocr = "ruc_tramaNC"
LEFT JOIN le ON replace(c.num_factura_documento_ocr, '-', '') = num_factura_trama_carta AND ruc_proveedor_emisor_ocr = "ruc_tramaCG"
LEFT JOIN fa ON replace(c.num_factura_documento_ocr, '-', '') = fa.numero_de_documento_de_pago AND ruc_proveedor_emisor_ocr = ruc_tramas
LEFT JOIN sh ON replace(c.num_factura_documento_ocr, '-', '') = num_factura_trama_sited AND ruc_proveedor_emisor_ocr = "RUCIPRESS" """)
def _(t):
    out = consolidation.attach_feed(view(t, CONS), *[view(t, c, w) for c, w in FEEDS.values()])
    return out.select("num_factura_documento_ocr", "flag_conNC_trama", F.col("dif_montoSubFact_montoSubNC_ocr").alias("dif"), "flag_conCG_trama",
                      "subtotal_fact_trama", "cod_cie101_trama_sited", "cobertura_siteds_trama")


CPM_S = {"num_factura_liqui_ocr": NUM, "ruc_liqui_ocr": RUC, "cod_autorizacion_liqui_ocr": f"concat('A', {C} % 50)", "monto_total_liqui_ocr": f"{P} + {K} % 3",
         "fec_ingreso_liqui_ocr": f"CAST((CAST(o_orderdate AS DATE) + CAST({K} % 50 - 25 AS INT)) AS TIMESTAMP)", "num_documento_liqui_ocr": f"concat('D', {K} % 4)",
         "deducible_liqui_ocr": f"({K} % 5) * 1.0", "flag_consultaAmboMed_liqui_ocr": f"CASE WHEN {K} % 2 = 0 THEN 1 ELSE 0 END"}
CPM_A = {"num_factura_siteds_ocr": NUM, "ruc_emisor_path": RUC, "num_siteds_ocr_val": f"concat('A', {C} % 50)", "fecha_emision_siteds_ocr": "o_orderdate",
         "producto_siteds_ocr": "CASE WHEN o_orderstatus = 'F' THEN 'Planes EPS' ELSE 'x' END", "num_documento_paciente_siteds_ocr_val": f"concat('D', {K} % 3)", "copago_fijo_siteds_ocr": f"({K} % 4) * 1.0"}
CPM_C = {"num_factura_liqui_ocr": f"concat('F', CAST(floor({K} / 2.0) AS BIGINT))", "ruc_liqui_ocr": RUC, "ruc_proveedor_emisor_ocr": RUC, "processed_date": "o_orderpriority", "monto_factura_ocr": P}
CPM_BASE = f"""WITH {cte('s', CPM_S)}, {cte('a', CPM_A, "o_orderstatus <> 'P'")}, {cte('c', CPM_C)},
cpm AS (SELECT DISTINCT s.*, a.*, p.processed_date, CASE WHEN num_factura_siteds_ocr IS NULL THEN 1 ELSE 0 END AS "flag_sinSiteds" FROM s
  LEFT JOIN a ON num_factura_liqui_ocr = num_factura_siteds_ocr AND ruc_liqui_ocr = ruc_emisor_path AND cod_autorizacion_liqui_ocr = num_siteds_ocr_val
  LEFT JOIN (SELECT num_factura_liqui_ocr, ruc_liqui_ocr, max(processed_date) AS processed_date FROM c GROUP BY 1, 2) p USING (num_factura_liqui_ocr, ruc_liqui_ocr))"""


def _cpm(t: Tables):
    consolidated = view(t, CPM_C)
    return consolidation.consolidate_cpm(view(t, CPM_S), view(t, CPM_A, "o_orderstatus <> 'P'"), consolidated), consolidated


@query("e3_cpm_consolidation", f"""{CPM_BASE} SELECT num_factura_liqui_ocr, processed_date, "flag_sinSiteds", num_siteds_ocr_val FROM cpm""")
def _(t):
    return _cpm(t)[0].select("num_factura_liqui_ocr", "processed_date", "flag_sinSiteds", "num_siteds_ocr_val")


@query("e4_cpm_flags_per_invoice", f"""{CPM_BASE}, f AS (SELECT cpm.num_factura_liqui_ocr, cpm.ruc_liqui_ocr,
  CASE WHEN monto_total_liqui_ocr - monto_factura_ocr > 0.1 THEN 1 ELSE 0 END AS amount, CASE WHEN date_diff('day', fec_ingreso_liqui_ocr::DATE, fecha_emision_siteds_ocr::DATE) > 7 THEN 1 ELSE 0 END AS early,
  CASE WHEN date_diff('day', fecha_emision_siteds_ocr::DATE, fec_ingreso_liqui_ocr::DATE) > 14 THEN 1 ELSE 0 END AS late, CASE WHEN num_documento_paciente_siteds_ocr_val <> num_documento_liqui_ocr THEN 1 ELSE 0 END AS patient,
  CASE WHEN copago_fijo_siteds_ocr <> deducible_liqui_ocr AND "flag_consultaAmboMed_liqui_ocr" = 1 THEN 1 ELSE 0 END AS deductible
  FROM cpm LEFT JOIN c ON cpm.num_factura_liqui_ocr = c.num_factura_liqui_ocr AND cpm.ruc_liqui_ocr = c.ruc_proveedor_emisor_ocr)
SELECT num_factura_liqui_ocr, ruc_liqui_ocr, min(amount) AS amount, max(early) AS early, max(late) AS late, max(patient) AS patient, max(deductible) AS deductible FROM f GROUP BY 1, 2""")
def _(t):
    cpm, consolidated = _cpm(t)
    flags = consolidation.cpm_flags_per_invoice(consolidation.cpm_flags(cpm, consolidated))
    short = {"amount": "flag_montoTotal_NoCoincide_Fact_Liqui_ocr", "early": "flag_fecIngreso_liqui_ocr_menor_fecAutoSiteds_ocr",
             "late": "flag_fecIngreso_liqui_ocr_mayor15d_fecAutoSiteds_ocr", "patient": "flag_dniPaciente_Siteds_ocr_NoCoincide_Liqui_ocr",
             "deductible": "flag_deduciblePaciente_Siteds_ocr_NoCoincide_Liqui_ocr"}
    return flags.select("num_factura_liqui_ocr", "ruc_liqui_ocr", *[F.col(c).alias(n) for n, c in short.items()])


# --- claims: orders with two attentions each, refunds on some ------------------------------
CLAIM = {
    "periodo": f"CAST(CASE WHEN {K} % 8 = 0 THEN '2023-12-01' ELSE '2024-01-01' END AS DATE)", "id_siniestro": f"concat('S-A', {K} % 10, '-', {K})",
    "id_siniestro_origen": f"concat({K} % 3, 'x')", "num_siniestro": f"concat('N', {K})", "tip_reclamo": f"CASE WHEN {K} % 6 = 0 THEN 'R' ELSE 'C' END",
    "cod_serie_comprobante_siniestro": f"concat('F', {C} % 9)", "num_comprobante_siniestro": f"CAST({K} AS STRING)",
    "num_documento_proveedor_siniestro": f"CASE {K} % 4 WHEN 0 THEN '20501781291' WHEN 1 THEN '20102756364' WHEN 2 THEN '20100054184' ELSE 'X' END", "id_poliza": f"concat('P', {C})", "mto_auditado_sol": P,
    "num_documento_afiliado": f"concat('D', {C})", "id_estado_siniestro_origen": f"CASE {K} % 5 WHEN 0 THEN '4' WHEN 1 THEN '5' WHEN 2 THEN 'T' WHEN 3 THEN 'D' ELSE 'Z' END",
    "id_autorizacion": f"concat('RS-A', {K})", "fec_notificacion": "CAST((CAST(o_orderdate AS DATE) + CAST(10220 AS INT)) AS TIMESTAMP)", "fec_hora_ocurrencia": "o_orderdate", "fec_ult_liquidacion": "o_orderdate",
    "tip_caso_especial": f"CASE WHEN {K} % 7 = 0 THEN 'CONCILIACIONES' END", "mnt_pagar_base": f"{P} / 2", "ind_trama_tedef": "'SI'",
}
_NULLS = ["num_poliza", "id_producto", "cod_producto_origen", "des_producto", "des_producto_agrupado", "id_contratante", "num_documento_contratante", "nom_completo_contratante", "id_persona_afiliado",
          "nom_completo_afiliado", "id_persona_proveedor_siniestro", "nom_completo_proveedor_siniestro", "nom_comercial_proveedor_siniestro", "nom_sede_proveedor_siniestro",
          "cod_sede_proveedor_siniestro", "des_estado_siniestro_origen", "cod_mecanismo_pago", "des_mecanismo_pago"]
CLAIM.update({n: "CAST(NULL AS STRING)" for n in _NULLS})
CLAIM.update({"fec_comprobante_siniestro": "CAST(NULL AS DATE)", "num_obligacion": f"concat({K} % 100, '-', {K} % 10)", "num_carta_garantia": "CAST(NULL AS BIGINT)", "mnt_nota_credito": "CAST(NULL AS DOUBLE)", "cod_tipo_contrato": f"{K} % 200"})
COVERAGES = ["P09", "R24", "H05", "E18", "O11", "ZZZ"]


def claims(t: Tables):
    cover = lambda i: F.element_at(F.array(*[F.lit(c) for c in COVERAGES]), ((F.col(K) + i) % len(COVERAGES) + 1).cast("int"))
    attention = lambda i: F.struct(
        F.lit(i).cast("bigint").alias("num_correlativo_atencion"), cover(i).alias("id_cobertura_origen"), F.concat(F.lit("cob"), cover(i)).alias("des_cobertura"),
        F.lit(" OTRA ").alias("agrupacion_cobertura_negocio"), F.concat(F.lit("J"), ((F.col(K) + i) % 3).cast("string")).alias("num_diagnostico_origen"),
        F.lit(None).cast("string").alias("des_diagnostico_salud"), (F.col(P) / 4).alias("mnt_beneficio_sin_impuesto_aprobado_sol"), (F.col(P) / 8).alias("mnt_impuesto_aprobado_sol"))
    refund = lambda i: F.struct(F.lit(i).cast("bigint").alias("num_correlativo_devolucion"), F.when((F.col(K) + i) % 2 == 0, 382).otherwise(1).cast("bigint").alias("cod_motivo_devolucion"),
                                F.lit("motivo").alias("des_cod_motivo_devolucion"), F.concat(F.lit("g"), F.lit(i)).alias("des_cod_grupo_devolucion"),
                                F.date_add(F.to_date("o_orderdate"), i).alias("fec_devolucion_siniestro"))
    principal = F.array(F.struct(*[F.concat(F.lit(n), F.col("o_orderpriority")).alias(n) for n in (
        "id_cobertura_principal", "des_cobertura_principal", "num_diagnostico_principal", "des_diagnostico_principal")]))
    plain = [F.expr(e).alias(n) for n, e in CLAIM.items()]
    df = t.orders.select(*plain, F.array(attention(1), attention(2)).alias("atencion_salud"),
                         F.when(F.col(K) % 5 == 1, F.array(refund(1), refund(2))).alias("grupo_devolucion"), principal.alias("diagnostico_principal"))
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


CLAIM_SQL = cte("claim", CLAIM)
FACTURA = "cod_serie_comprobante_siniestro || lpad(num_comprobante_siniestro, 8, '0')"
_IN_MONTH = "periodo = DATE '2024-01-01' AND substr(id_siniestro, 4, 1) <> '9'"


@query("e5_historical_claims", f"WITH {CLAIM_SQL} SELECT DISTINCT {FACTURA} AS numero_factura, num_documento_proveedor_siniestro, num_siniestro, id_poliza, mto_auditado_sol FROM claim WHERE {_IN_MONTH} AND tip_reclamo = 'C'")
def _(t):
    return claim_plans.historical_claims(claims(t), CONFIG).drop("id_siniestro")


_ATTENTIONS = f"att AS (SELECT *, i, (['P09', 'R24', 'H05', 'E18', 'O11', 'ZZZ'])[((replace(num_siniestro, 'N', '')::BIGINT + i) % 6 + 1)::INTEGER] AS cover FROM claim, (SELECT unnest([1, 2]) AS i))"


@query("e5_claim_attentions", f"""WITH {CLAIM_SQL}, {_ATTENTIONS} SELECT DISTINCT {FACTURA} AS factura, cover AS id_cobertura_origen, CASE cover WHEN 'P09' THEN 'AMBULATORIO' WHEN 'R24' THEN 'PREVENCION' WHEN 'H05' THEN 'HOSPITALARIO'
  WHEN 'E18' THEN 'EMERGENCIA' WHEN 'O11' THEN 'ONCOLOGIA' ELSE 'OTRA' END AS agrupacion_cobertura_negocio FROM att WHERE {_IN_MONTH}""")
def _(t):
    return claim_plans.claim_attentions(claims(t), CONFIG).select("factura", "id_cobertura_origen", "agrupacion_cobertura_negocio")


PEOPLE = {"cuc": "concat('1-', c_custkey)", "periodo": "CAST('2024-01-01' AS DATE)", "des_riesgo": "CASE WHEN c_custkey % 5 <> 0 THEN 'SALUD' ELSE 'VIDA' END", "id_estado_poliza": "CASE c_custkey % 3 WHEN 0 THEN 'ACT' WHEN 1 THEN 'NDE' ELSE 'BAJ' END",
          "id_estado_certificado": "CASE WHEN c_custkey % 4 = 0 THEN 'X' ELSE 'ACT' END", "des_agrupacion_n1": "c_mktsegment"}


@query("e6_active_policies", f"""WITH {cte('p', PEOPLE, table='customer')} SELECT substr(cuc, 3) AS nro_documento_paciente, periodo, des_agrupacion_n1 FROM p
WHERE des_riesgo = 'SALUD' AND id_estado_poliza IN ('ACT', 'NO DETERMINADO', 'NDE') AND id_estado_certificado IN ('ACT', 'NO DETERMINADO', 'NDE')""")
def _(t):
    return claim_plans.active_policies(view(t, PEOPLE, table="customer"))


@query("e7_letter_state", f"""SELECT o_orderkey AS num_carta_garantia, max(d) AS fec_aprobacion_carta, max(d) + 30 AS fec_validez_carta, CASE WHEN o_orderstatus IN ('ANULADA', 'AN', 'RECHAZADA', 'F') AND o_orderstatus <> 'F' THEN 1 WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS flag_cg_anulada
FROM (SELECT o_orderkey, o_orderstatus, o_orderdate::DATE + i AS d FROM orders, (SELECT unnest([0, 7]) AS i)) GROUP BY o_orderkey, o_orderstatus""")
def _(t):
    day = F.to_date("o_orderdate")
    requests = t.orders.select(
        F.lit("2024-01-01").cast("date").alias("periodo"), F.concat(F.lit("S"), F.col(K)).alias("id_siniestro"), F.col(K).alias("num_carta_garantia"),
        F.lit("x").alias("num_carta_garantia_origen"), F.lit("r").alias("num_documento_proveedor"), F.col(P).alias("mnt_carta_garantia_total"),
        F.when(F.col("o_orderstatus") == "F", "ANULADA").otherwise("OK").alias("des_est_carta_garantia_origen"),
        F.array(*[F.struct(F.date_add(day, i).alias("fec_aprobacion")) for i in (0, 7)]).alias("carta_garantia_version"))
    return claim_plans.letter_validity(requests, CONFIG).select("num_carta_garantia", "fec_aprobacion_carta", "fec_validez_carta", "flag_cg_anulada")


@query("e7_letter_states", "SELECT DISTINCT o_custkey AS num_carta_garantia, 'r' || o_custkey % 3 AS num_documento_proveedor, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS flag_cg_anulada FROM orders WHERE o_orderkey % 8 <> 0")
def _(t):
    requests = t.orders.select(
        F.expr(CLAIM["periodo"]).alias("periodo"), F.col(C).alias("num_carta_garantia"), F.concat(F.lit("r"), F.col(C) % 3).alias("num_documento_proveedor"),
        F.when(F.col("o_orderstatus") == "F", "ANULADA").otherwise("OK").alias("des_est_carta_garantia_origen"))
    return claim_plans.letter_states(requests, CONFIG)


UNITS = {"id_origen": f"CASE WHEN {K} % 5 <> 0 THEN 'RS' ELSE 'AX' END", "id_persona": f"concat('M', {C})", "id_unidad_asegurable": f"CASE WHEN {K} % 7 = 0 THEN concat('X', {K}) ELSE concat('A', {C} % 3, '-', {K} % 2, '-', {K}) END",
         "des_estado_origen_unidad_asegurable": f"CASE WHEN {K} % 3 = 0 THEN 'VIGENTE' ELSE 'BAJA' END", "fec_inicio_vigencia": f"CASE WHEN {K} % 11 <> 0 THEN CAST(o_orderdate AS DATE) END",
         "fec_fin_vigencia": f"(CAST(o_orderdate AS DATE) + CAST({K} % 400 AS INT))"}


@query("e8_policy_validity", f"""WITH {cte('u', UNITS)}, v AS (SELECT *, CASE WHEN id_unidad_asegurable LIKE '%-%' THEN split_part(id_unidad_asegurable, '-', 1) || '-' || split_part(id_unidad_asegurable, '-', 2) END AS id_poliza FROM u WHERE id_origen = 'RS')
SELECT id_persona, id_poliza, fec_inicio_vigencia, fec_fin_vigencia FROM v QUALIFY row_number() OVER (PARTITION BY id_persona, id_poliza
  ORDER BY CASE WHEN des_estado_origen_unidad_asegurable = 'VIGENTE' THEN 1 ELSE 2 END, fec_inicio_vigencia DESC NULLS LAST, fec_fin_vigencia DESC NULLS LAST, id_unidad_asegurable) = 1""")
def _(t):
    return claim_plans.policy_validity(view(t, UNITS))


@query("e9_processed_claims", f"""WITH {CLAIM_SQL}, kept AS (SELECT *, replace(num_siniestro, 'N', '')::BIGINT AS k FROM claim WHERE {_IN_MONTH} AND tip_reclamo = 'C' AND id_estado_siniestro_origen IN ('4', '8', 'T', '5')),
rows AS (SELECT kept.*, 'J' || ((k + i) % 3) AS dx, j FROM kept, (SELECT unnest([1, 2]) AS i), (SELECT unnest([1, 2]) AS j) WHERE k % 5 = 1 OR j = 1)
SELECT DISTINCT {FACTURA} AS factura, replace(id_autorizacion, 'RS-', '') AS id_autorizacion, num_siniestro, dx AS num_diagnostico_origen, CASE WHEN id_estado_siniestro_origen = '5' THEN 2 END AS item_dev,
  CASE WHEN id_estado_siniestro_origen = '5' THEN 'motivo' END AS motivo, CASE WHEN id_estado_siniestro_origen = '5' THEN fec_hora_ocurrencia::DATE + 2 END AS fec_devolucion,
  CASE WHEN id_estado_siniestro_origen = '5' THEN CASE WHEN greatest(CASE WHEN (k + 2) % 2 = 0 THEN 382 ELSE 1 END, CASE WHEN j = 1 AND (k + 1) % 2 = 0 THEN 382 ELSE 1 END) = 382 THEN 'Rechazo_Definitivo' ELSE 'Rechazo_No_Definitivo' END END AS ind_devoluc,
  CASE WHEN k % 100 % 2 = 0 THEN 'PAG' END AS est_cuenta_por_pagar, CASE WHEN k % 4 < 2 THEN 'P' || (k % 4) END AS cod_producto, CASE WHEN k % 3 = 0 THEN '2024-' || k END AS carta_garantia FROM rows""")
def _(t):
    authorisations = t.orders.select(F.concat(F.lit("RS-A"), F.col(K)).alias("id_autorizacion"), F.col("o_orderdate").alias("fec_autorizacion"))
    # the products repeat, two of four are known, and a third of the claims has a letter
    products = t.orders.where(f"{K} % 4 < 2").select(F.concat(F.lit("X"), F.col(K) % 4).alias("cod_producto_ax"), F.concat(F.lit("P"), F.col(K) % 4).alias("cod_producto"))
    letters = t.orders.where(f"{K} % 3 = 0").select(F.expr(CLAIM["id_siniestro"]).alias("id_siniestro"), F.lit(2024).cast("bigint").alias("anio_carta_garantia"), F.col(K).cast("bigint").alias("num_carta_garantia"))
    pairs = t.orders.select((F.col(K) % 100).alias("a"), (F.col(K) % 10).alias("b")).distinct().where("a % 2 = 0")
    payables = pairs.select(F.concat_ws("-", "a", "b", F.lit("z")).alias("id_maestro_cuenta_por_pagar"), F.lit("PAG").alias("cod_est_pago"))
    settled = claims(t).withColumn("id_producto", F.concat(F.lit("AX-X"), F.substr("num_siniestro", F.lit(2)).cast("bigint") % 4))
    out = claim_plans.processed_claims(settled, authorisations, products, letters, payables, CONFIG)
    return out.select("factura", "id_autorizacion", "num_siniestro", "num_diagnostico_origen", F.col("item_dev").cast("int").alias("item_dev"), "motivo", "fec_devolucion", "ind_devoluc", "est_cuenta_por_pagar",
                      "cod_producto", "carta_garantia")


@query("e10_feed_universe", f"""WITH {CLAIM_SQL} SELECT DISTINCT {FACTURA} AS factura, num_documento_proveedor_siniestro AS ruc, l_linenumber AS attention FROM claim LEFT JOIN lineitem ON l_orderkey = replace(num_siniestro, 'N', '')::BIGINT
WHERE {_IN_MONTH} AND tip_reclamo = 'C' AND tip_caso_especial IS NULL AND num_documento_proveedor_siniestro <> 'X' AND fec_notificacion BETWEEN TIMESTAMP '2024-01-01 12:00:00' AND TIMESTAMP '2026-12-31 12:00:00'""")
def _(t):
    text = lambda c: c.cast("string")
    number, ruc = F.expr(f"concat('F', {C} % 9, lpad(CAST({K} AS STRING), 8, '0'))"), F.expr(CLAIM["num_documento_proveedor_siniestro"])
    documents = t.orders.select(number.alias("NUMERODOCUMENTOPAGO"), ruc.alias("RUCIPRESS"), F.lit("1").alias("CODIGOLOTE"), F.lit("7").alias("NUMEROLOTE"), F.lit("20240101").alias("FECHAEMISION"),
                                F.lit("x").alias("FECHAENVIO"), F.lit("4").alias("CODIGOPRODUCTO"), F.lit("9").alias("MONTOTOTAL"), F.lit("8").alias("MONTONETO"),
                                F.lit("02").alias("CODIGOMECANISMOPAGO"), F.lit("f").alias("CODIGOFINANCIADOR"))
    attentions = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col(K)).select(
        number.alias("NUMERODOCUMENTOPAGO"), ruc.alias("RUCIPRESS"), F.lit("d").alias("NUMERODOCUMENTOIDENTIDAD"), text(F.col("l_linenumber")).alias("NUMEROAUTORIZACION"),
        F.lit("4").alias("TIPOCOBERTURA"), F.lit("20240101").alias("FECHAINICIOATENCION"), F.lit("J").alias("CODIGOCIE101")))
    out = provider_feed.feed_universe(documents, attentions, claims(t), "2024-01-01 12:00:00", "2026-12-31 12:00:00", CONFIG)
    return out.select(F.col("num_factura_documento_ocr").alias("factura"), F.col("ruc_proveedor_emisor_ocr").alias("ruc"), F.col("num_siteds_ocr_val").cast("int").alias("attention"))


@query("e11_contract_and_clinic_classes", """
SELECT o_orderkey, CASE WHEN c IN (6,156,191,189,154,4,3,153,188,322) THEN c ELSE 9999 END AS cod_tipo_contrato_cronico, CASE WHEN c IN (154,189,4) THEN 'PACIENTE MES DIABETES' WHEN c IN (156,191,6) THEN 'PACIENTE MES DISLIPIDEMIA'
  WHEN c IN (153,188,3) THEN 'PACIENTE MES ASMA' WHEN c IN (322) THEN 'PACIENTE MES ANEMIA' ELSE 'OTROS' END AS contrato_cronico_texto, CASE o_orderkey % 3 WHEN 0 THEN 'CENTRAL' WHEN 1 THEN 'CI' END AS grupo FROM (SELECT o_orderkey, o_orderkey % 400 AS c FROM orders)""")
def _(t):
    ruc = F.expr(f"CASE {K} % 3 WHEN 0 THEN '20501781291' WHEN 1 THEN '20100054184' ELSE 'X' END")
    df = t.orders.select(K, (F.col(K) % 400).alias("c"), label_map(ruc, lookups.clinic_groups("CENTRAL")).alias("grupo"))
    return df.withColumns(provider_feed.contract_classes(F.col("c"))).drop("c")


@query("e12_self_insured", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS flag FROM orders""")
def _(t):
    firm = F.expr(f"CASE {K} % 4 WHEN 0 THEN 'telefónica DEL perú' WHEN 1 THEN 'Internet para todos' WHEN 2 THEN 'Telefónica Móviles' ELSE 'x' END")
    product = F.expr(f"CASE WHEN {K} % 2 = 0 THEN 'EPS' ELSE 'AMI' END")
    df = t.orders.select(K, firm.alias("razon_social_contratante_siteds_ocr"), product.alias("producto_siteds_mod"))
    return enrichment.with_self_insured(df, lookups.self_insured(t.spark)).select(K, F.col("flag_contratante_autoseguro").alias("flag"))


_COUNTS = {"num_factura_documento_ocr": f"concat('F', {C} % 100)", "ruc_proveedor_emisor_ocr": RUC, "num_siteds_ocr_val": f"concat('A', {K} % 997)", "mecanismo_liqui_ocr": "CASE WHEN o_orderstatus = 'F' THEN '02' ELSE '01' END",
           "fecha_emision_siteds_ocr": "CAST(o_orderdate AS DATE)", "cod_sede_proveedor_siniestro": "'s'", "id_persona_afiliado": f"concat('M', {C} % 20)", "des_cobertura": "'c'", "des_producto": "'p'",
           "grupo_clinica_texto": "o_orderstatus", "cod_tipo_contrato_cronico": f"CASE WHEN {K} % 3 = 0 THEN 6 ELSE 9999 END", "key": K}
_AUTHS = {"periodo_autorizacion": "CAST(date_trunc('month', o_orderdate) AS DATE)", "num_doc_proveedor": RUC, "cod_sede_proveedor": "'s'", "id_persona_afiliado": f"concat('M', {C} % 20)", "des_cobertura": "'c'", "des_producto": "'p'", "cod_autorizacion": f"concat('A', {K} % 997)"}


@query("e13_attention_counts", f"""WITH {cte('d', _COUNTS)}, {cte('a', _AUTHS)},
k AS (SELECT periodo_autorizacion, num_doc_proveedor, id_persona_afiliado, count(DISTINCT cod_autorizacion) AS n FROM a WHERE cod_autorizacion IN (SELECT num_siteds_ocr_val FROM d WHERE mecanismo_liqui_ocr = '02') GROUP BY 1, 2, 3),
i AS (SELECT num_factura_documento_ocr, ruc_proveedor_emisor_ocr, count(DISTINCT num_siteds_ocr_val) AS n FROM d GROUP BY 1, 2),
g AS (SELECT date_trunc('month', fecha_emision_siteds_ocr) AS m, grupo_clinica_texto, cod_tipo_contrato_cronico, id_persona_afiliado, CASE WHEN cod_tipo_contrato_cronico <> 9999 THEN count(DISTINCT num_siteds_ocr_val) ELSE 0 END AS n FROM d GROUP BY 1, 2, 3, 4)
SELECT key, k.n AS per_key, i.n AS per_invoice, g.n AS chronic FROM d LEFT JOIN k ON date_trunc('month', fecha_emision_siteds_ocr) = periodo_autorizacion AND ruc_proveedor_emisor_ocr = num_doc_proveedor AND d.id_persona_afiliado = k.id_persona_afiliado
JOIN i ON d.num_factura_documento_ocr = i.num_factura_documento_ocr AND d.ruc_proveedor_emisor_ocr = i.ruc_proveedor_emisor_ocr
JOIN g ON date_trunc('month', fecha_emision_siteds_ocr) = g.m AND d.grupo_clinica_texto = g.grupo_clinica_texto AND d.cod_tipo_contrato_cronico = g.cod_tipo_contrato_cronico AND d.id_persona_afiliado = g.id_persona_afiliado""")
def _(t):
    out = provider_feed.with_attention_counts(view(t, _COUNTS), view(t, _AUTHS))
    return out.select("key", F.col("ctdAtencionesSitedsxLlaveRS").alias("per_key"), F.col("ctdAtencionesSitedsxFacturaTrama").alias("per_invoice"),
                      F.col("ctdAtencionesCPMCronicoClinica").alias("chronic"))


@query("e14_official_snapshot", f"""WITH {CLAIM_SQL}, kept AS (SELECT *, replace(num_siniestro, 'N', '')::BIGINT AS k FROM claim WHERE {_IN_MONTH} AND tip_reclamo = 'C' AND num_documento_proveedor_siniestro <> 'X' AND fec_notificacion::DATE >= DATE '2025-01-20')
SELECT num_siniestro, {FACTURA} AS factura, CASE WHEN id_estado_siniestro_origen IN ('4', '8', 'T') THEN 'Liquidado' WHEN id_estado_siniestro_origen = 'D' THEN 'Reserva' ELSE 'Rechazos' END AS tipo_base,
  CASE substr(id_siniestro_origen, 1, 1) WHEN '1' THEN 'EPS' WHEN '2' THEN 'ASISTENCIA MEDICA' END AS compania,
  CASE WHEN id_estado_siniestro_origen = '4' THEN 'cob' || (['P09', 'R24', 'H05', 'E18', 'O11', 'ZZZ'])[((k + 1) % 6 + 1)::INTEGER] ELSE 'des_cobertura_principal' || o_orderpriority END AS des_cobertura,
  CASE WHEN k % 2 = 0 THEN 'NOTIFICADOS' END AS bandeja, {sql_r6('mto_auditado_sol * 0.75')} AS imp_pagar, {sql_r6('mto_auditado_sol * 0.5')} AS imp_pagar_base FROM kept JOIN orders ON k = o_orderkey""")
def _(t):
    # the in-tray number skips its third and fourth characters, so its form differs from the claim's
    even = t.orders.where(f"{K} % 2 = 0")
    tray = even.select(F.concat(F.lit("N1xx"), F.col(K)).alias("NRO_SINIESTRO"), F.lit(" NOTIFICADO-CAMUNDA").alias("TAREA"), *[F.lit("").alias(c) for c in (
        "DESC_ESTADO", "TIPO_SINIESTRO", "MOTIVO_REPROCESO", "DESC_BENEFICIO")], F.lit("m").alias("MOTIVO_NOTIFICADO"))
    renamed = claims(t).withColumn("num_siniestro", F.concat(F.lit("N1-"), F.substr("num_siniestro", F.lit(2))))
    out = claim_plans.official_snapshot(renamed, tray, CONFIG)
    return out.select(F.concat(F.lit("N"), F.substr("num_siniestro", F.lit(4))).alias("num_siniestro"), "factura", "tipo_base", "compania", "des_cobertura", "bandeja",
                      r6("imp_pagar").alias("imp_pagar"), r6("imp_pagar_base").alias("imp_pagar_base"))


@query("e15_reprocessed_merge", "SELECT o_orderkey AS documento_id, l_linenumber, l_partkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def _(t):
    path = F.concat(F.lit("bucket/"), F.col(K)).alias("file_path")
    originals = t.orders.select(F.col(K).alias("id"), path)
    again = t.orders.select((-F.col(K)).alias("id2"), path)
    pages = t.lineitem.select((-F.col("l_orderkey")).alias("documento_id"), "l_linenumber", "l_partkey", "l_suppkey")
    return bridge(originals, again, pages, "file_path", "id", "id2", "documento_id")


# --- reports -------------------------------------------------------------------------------
ALERT = {"processed_date": "'2024-01-01'", "num_factura_documento_ocr": f"concat('F', CAST(floor({K} / 2.0) AS BIGINT))", "num_siniestro": f"concat('N', CAST(floor({K} / 2.0) AS BIGINT))",
         "reglas_mensaje": f"CASE {K} % 4 WHEN 0 THEN 'Factura OK' WHEN 1 THEN 'Factura con duplicidad de pago' WHEN 2 THEN 'La fecha de emision de NC y Trama no coinciden' ELSE 'La cantidad de siteds de CPM en la trama no coincide con RS' END",
         "estado": f"CASE WHEN {K} % 4 = 0 THEN 'OK' ELSE 'OBSERVADA' END", "ruc_proveedor_emisor_ocr": f"CASE WHEN {C} % 2 = 0 THEN '20501781291' ELSE '20100054184' END", "monto_factura_trama": P, "monto_factura_ocr": P,
         "grupo": f"CASE WHEN {C} % 2 = 0 THEN 'CENTRAL' ELSE 'CI' END"}
ALERT.update({c: "CAST(NULL AS STRING)" for c in ("factura_duplicada", "num_siniestro_factDup", "dsc_dup", "estado_procesado_duplicado")})
ALERT.update({"fec_atencion_duplicado": "CAST(NULL AS DATE)"})
SNAP = {"factura": f"concat('F', {K})", "num_siniestro": f"concat('N', {K})", "bandeja": "o_orderpriority", "des_cobertura": "'c'", "tip_caso_especial": f"CASE WHEN {K} % 5 = 0 THEN 'ESPECIAL' END", "proveedor": "o_orderstatus",
        "sede": "'s'", "red": f"CASE WHEN {K} % 3 = 0 THEN 'RED NORTE' END", "des_producto": "'p'", "paciente": "'x'", "nom_completo_contratante": "'y'", "desc_estado": "'e'", "motivo_notificado": "'m'"}
HEAD = {"invoice_number": f"concat('F-', {C})", "batch_name": "o_orderpriority", "processed_date": "CAST(year(o_orderdate) AS STRING)"}
DELIVERY = f"""WITH {cte('al', ALERT)}, {cte('sn', SNAP)}, {cte('he', HEAD)},
b AS (SELECT replace(invoice_number, '-', '') AS inv, batch_name FROM he QUALIFY row_number() OVER (PARTITION BY invoice_number ORDER BY processed_date DESC, batch_name DESC) = 1),
del AS (SELECT DISTINCT al.*, sn.bandeja, coalesce(tip_caso_especial, 'Flujo regular') AS tip_caso_especial, proveedor, sede, red, CASE WHEN bandeja IS NOT NULL THEN 1 ELSE 0 END AS "flag_ocurrenciaActual", b.batch_name AS num_lote
  FROM al LEFT JOIN sn ON num_factura_documento_ocr = factura AND al.num_siniestro = sn.num_siniestro LEFT JOIN b ON num_factura_documento_ocr = inv)"""
SAVINGS = "reglas_mensaje IN ('Factura con duplicidad de pago', 'La cantidad de siteds de CPM en la trama no coincide con RS')"
REPORT = f"""{DELIVERY}, rep0 AS (SELECT num_factura_documento_ocr AS num_factura, num_siniestro, estado AS est, reglas_mensaje AS alerta, monto_factura_trama AS monto, CASE WHEN {SAVINGS} THEN 1 ELSE 0 END AS ahorro,
  CASE WHEN reglas_mensaje = 'La fecha de emision de NC y Trama no coinciden' THEN 'SI' ELSE 'NO' END AS efectiva, CASE WHEN red IS NULL AND ruc_proveedor_emisor_ocr = '20501781291' THEN 'RED CENTRAL' ELSE red END AS red, proveedor, sede, num_lote FROM del WHERE tip_caso_especial = 'Flujo regular'),
rep AS (SELECT * FROM rep0 WHERE NOT (est = 'OK' AND num_factura IN (SELECT num_factura FROM rep0 GROUP BY 1 HAVING count(*) > 1)))"""
NOW = "2024-01-01 10:00:00"


def _delivered(t: Tables):
    return reports.delivery(view(t, ALERT).drop("grupo"), view(t, SNAP), view(t, HEAD), "2024-01-01")


def _report(t: Tables):
    rows = reports.report_rows(_delivered(t), "monto_factura_trama", F.lit(NOW))
    return reports.drop_superfluous_ok(reports.fill_network(rows, CONFIG.network))


@query("b1_delivery_rows", f"""{DELIVERY} SELECT num_factura_documento_ocr, reglas_mensaje, monto_factura_ocr, bandeja, tip_caso_especial, red, "flag_ocurrenciaActual", num_lote FROM del""")
def _(t):
    return _delivered(t).select("num_factura_documento_ocr", "reglas_mensaje", "monto_factura_ocr", "bandeja", "tip_caso_especial", "red", "flag_ocurrenciaActual", "num_lote")


@query("b2_report_rows", f"""{DELIVERY} SELECT num_factura_documento_ocr AS num_factura, reglas_mensaje AS "alerta_IA", monto_factura_trama AS monto_factura, CASE WHEN {SAVINGS} THEN 1 ELSE 0 END AS flag_reglas_ahorro,
  CASE WHEN reglas_mensaje = 'La fecha de emision de NC y Trama no coinciden' THEN 'SI' ELSE 'NO' END AS flag_alerta_efectiva FROM del WHERE tip_caso_especial = 'Flujo regular'""")
def _(t):
    rows = reports.report_rows(_delivered(t), "monto_factura_trama", F.lit(NOW))
    return rows.select("num_factura", "alerta_IA", "monto_factura", "flag_reglas_ahorro", "flag_alerta_efectiva")


@query("b2_provider_report", f"""WITH {cte('al', ALERT)}, {cte('sn', SNAP)},
del AS (SELECT DISTINCT al.*, sn.bandeja, coalesce(tip_caso_especial, 'Flujo regular') AS tce, proveedor FROM al LEFT JOIN sn ON num_factura_documento_ocr = factura AND al.num_siniestro = sn.num_siniestro WHERE reglas_mensaje <> 'La cantidad de siteds de CPM en la trama no coincide con RS')
SELECT num_factura_documento_ocr AS num_factura, reglas_mensaje AS "alerta_IA", grupo AS red, max(monto_factura_ocr) AS monto_factura FROM del WHERE tce = 'Flujo regular' AND estado <> 'OK' GROUP BY 1, 2, 3""")
def _(t):
    alerts = view(t, ALERT).withColumn("num_lote", F.lit("7"))
    delivered = reports.delivery(alerts, view(t, SNAP), None, "2024-01-01", group="grupo")
    return reports.provider_report(delivered, F.lit(NOW)).select("num_factura", "alerta_IA", "red", "monto_factura")


@query("b3_network_filled", f"{REPORT} SELECT num_factura, alerta, red FROM rep0")
def _(t):
    rows = reports.report_rows(_delivered(t), "monto_factura_trama", F.lit(NOW))
    return reports.fill_network(rows, CONFIG.network).select("num_factura", F.col("alerta_IA").alias("alerta"), "red")


@query("b4_superfluous_ok_dropped", f"{REPORT} SELECT num_factura, alerta, est FROM rep")
def _(t):
    return _report(t).select("num_factura", F.col("alerta_IA").alias("alerta"), F.col("estado_alerta_IA").alias("est"))


@query("b5_export_view", f"{REPORT} SELECT DISTINCT num_factura, alerta, monto, red, efectiva, CASE WHEN ahorro = 1 AND est <> 'OK' THEN 'Alerta rechazo' WHEN est = 'OK' THEN 'No alerta' ELSE 'Otras alertas' END AS clase, num_lote FROM rep")
def _(t):
    out = reports.export_view(_report(t), "2024-01-01")
    return out.select("num_factura", F.col("alerta_IA").alias("alerta"), F.col("monto_factura").alias("monto"), "red", F.col("flag_alerta_efectiva").alias("efectiva"),
                      F.col("flag_alerta_rechazo").alias("clase"), "num_lote")


_PROVIDERS = f"""prov AS (SELECT num_factura_documento_ocr AS num_factura, reglas_mensaje AS alerta, grupo AS red, max(monto_factura_ocr) AS monto, CASE WHEN reglas_mensaje = 'Factura con duplicidad de pago' THEN 1 ELSE 0 END AS ahorro
  FROM (SELECT DISTINCT al.*, coalesce(tip_caso_especial, 'Flujo regular') AS tce FROM al LEFT JOIN sn ON num_factura_documento_ocr = factura AND al.num_siniestro = sn.num_siniestro WHERE reglas_mensaje <> 'La cantidad de siteds de CPM en la trama no coincide con RS')
  WHERE tce = 'Flujo regular' AND estado <> 'OK' GROUP BY 1, 2, 3, 5)"""


def _provider_report(t: Tables):
    delivered = reports.delivery(view(t, ALERT).withColumn("num_lote", F.lit("7")), view(t, SNAP), None, "2024-01-01", group="grupo")
    return reports.provider_report(delivered, F.lit(NOW))


@query("b4_full_report", f"""{REPORT}, {_PROVIDERS}, both_reports AS (SELECT num_factura, alerta, est, monto, red FROM rep0 UNION ALL SELECT num_factura, alerta, 'OBSERVADA', monto, red FROM prov)
SELECT * FROM both_reports WHERE NOT (est = 'OK' AND num_factura IN (SELECT num_factura FROM both_reports GROUP BY 1 HAVING count(*) > 1))""")
def _(t):
    out = reports.full_report(reports.report_rows(_delivered(t), "monto_factura_trama", F.lit(NOW)), _provider_report(t), CONFIG)
    return out.select("num_factura", F.col("alerta_IA").alias("alerta"), F.col("estado_alerta_IA").alias("est"), F.col("monto_factura").alias("monto"), "red")


@query("b5_provider_export_view", f"{REPORT}, {_PROVIDERS} SELECT DISTINCT num_factura, alerta, monto, CASE WHEN red = 'CENTRAL' THEN 'RED CENTRAL' ELSE red END AS red, ahorro AS flag_reglas_ahorro, '7' AS num_lote FROM prov")
def _(t):
    out = reports.provider_export_view(_provider_report(t), "2024-01-01", CONFIG)
    return out.select("num_factura", F.col("alerta_IA").alias("alerta"), F.col("monto_factura").alias("monto"), "red", "flag_reglas_ahorro", F.col("num_lote").cast("string").alias("num_lote"))


def _summary_sql(where: str, network: str, group: str, columns: str) -> str:
    return f"""{REPORT}, ini AS (SELECT '2024-01-01' AS processed_date, CASE WHEN {network} THEN 'RED CENTRAL' ELSE red END AS red, num_factura, num_siniestro, proveedor, sede, max(CASE WHEN est = 'OBSERVADA' THEN num_factura END) AS seen,
  max(CASE WHEN est = 'OBSERVADA' THEN monto END) AS seen_amount, max(monto) AS amount FROM rep WHERE {where} GROUP BY 1, 2, 3, 4, 5, 6),
pot AS (SELECT num_factura, num_siniestro, max(monto) AS potential FROM rep WHERE ahorro = 1 GROUP BY 1, 2), fin AS (SELECT * FROM ini LEFT JOIN pot USING (num_factura, num_siniestro))
SELECT {columns} FROM fin GROUP BY {group}"""


_MEASURES = f"""count(num_factura) AS "ctdFacturas", round(sum(amount), 2) AS "mtoFacturado", count(seen) AS "ctdFactObservadas", {sql_r6('count(seen) / nullif(count(num_factura), 0)')} AS "pctFactObs", round(sum(seen_amount), 2) AS "mtoObservado",
  round(sum(potential), 2) AS "mtoPotAhorro", {sql_r6('sum(potential) / nullif(sum(seen_amount), 0)')} AS "pctMtoAhorrovsObservador" """


def _rounded(df):
    return df.withColumns({**{c: F.round(c, 2) for c in ("mtoFacturado", "mtoObservado", "mtoPotAhorro")}, **{c: r6(c) for c in ("pctFactObs", "pctMtoAhorrovsObservador")}})


@query("b6_daily_summary", _summary_sql("true", "red IS NULL OR red = 'CENTRAL'", "processed_date, red", f"processed_date, red, {_MEASURES}"))
def _(t):
    return _rounded(reports.daily_summary(_report(t), "2024-01-01", CONFIG))


@query("b7_rejection_summary", _summary_sql("ahorro = 1", "red IS NULL", "processed_date", f"""processed_date, count(num_factura) AS "ctdFacturas", round(sum(amount), 2) AS "mtoFacturado", count(seen) AS "ctdFactObservadas",
  {sql_r6('count(seen) / count(num_factura)')} AS "pctFactObs", round(sum(seen_amount), 2) AS "mtoObservado", round(sum(potential), 2) AS "mtoPotAhorro", {sql_r6('sum(seen_amount) / sum(potential)')} AS "pctMtoAhorrovsObservador" """))
def _(t):
    summary = reports.daily_summary(_report(t), "2024-01-01", CONFIG, savings_only=True, alias_network=False)
    return _rounded(reports.rejection_by_day(summary, "2024-01-01"))


@query("b8_network_extract", "SELECT * EXCLUDE (processed_date) FROM (" + _summary_sql("true", "red IS NULL OR red = 'CENTRAL'", "processed_date, red", f"processed_date, red, {_MEASURES}") + ") WHERE red = 'RED CENTRAL'")
def _(t):
    return _rounded(reports.network_extract(reports.daily_summary(_report(t), "2024-01-01", CONFIG), "2024-01-01", CONFIG))


@query("b9_message_figures", "SELECT \"ctdFacturas\" AS invoice_number, \"ctdFactObservadas\" AS invoice_number_obs, round(\"mtoFacturado\" / 1000000, 2)::DECIMAL(38,2)::VARCHAR || ' MM' AS invoice_amount FROM ("
       + _summary_sql("true", "red IS NULL OR red = 'CENTRAL'", "processed_date, red", f"processed_date, red, {_MEASURES}") + ") WHERE red = 'RED CENTRAL'")
def _(t):
    summary = reports.daily_summary(_report(t), "2024-01-01", CONFIG)
    extract = reports.network_extract(summary, "2024-01-01", CONFIG)
    return reports.message_figures(extract, extract).select("invoice_number", "invoice_number_obs", "invoice_amount")


@query("b10_emptiness", "SELECT (SELECT count(*) FROM orders) = 0 AS all_empty, (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0 AS negative_empty")
def _(t):
    everything, negative = io.is_empty(t.orders), io.is_empty(t.orders.where(F.col(P) < 0))
    return t.spark.range(1).select(everything.scalar().alias("all_empty"), negative.scalar().alias("negative_empty"))


# --- incremental writes ----------------------------------------------------------------------
@query("i1_period_replaced_twice", "SELECT o_orderpriority AS processed_date, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1")
def _(t):
    path = incremental.shared_folder(t.spark, "period")
    df = t.orders.select(K, P, F.col("o_orderpriority").alias("processed_date"))
    periods = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    for _run in range(2):
        incremental.replace_period(df, path, periods)
    # a rerun of one period that finds nothing must leave nothing of it
    incremental.replace_period(df.where("false"), path, ["1-URGENT"])
    return incremental.read_committed(t.spark, path).groupBy("processed_date").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(P), 2).alias("total"))


@query("i2_watermark_append", "SELECT o_orderstatus AS type, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    path = incremental.shared_folder(t.spark, "watermark")
    rows = t.orders.select(F.col(K).alias("documento_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("type"))
    rows.where("created_at <= timestamp_ntz'1999-06-01 00:00:00'").write.parquet(path)
    stored = t.spark.read.parquet(path)
    for kind in ("F", "O", "P"):
        fresh = incremental.newer_than_watermark(rows.where(F.col("type") == kind), stored, "created_at", {"type": kind}, "documento_id")
        fresh.write.mode("append").parquet(path)
        stored = t.spark.read.parquet(path)
    return stored.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


_UPDATED_SQL = """
SELECT o_orderkey, CASE WHEN l_orderkey IS NOT NULL THEN f ELSE 9 END AS flag FROM orders LEFT JOIN (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS f FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) ON o_orderkey = l_orderkey"""


@query("i3_update_committed", _UPDATED_SQL)
def _(t):
    path = incremental.shared_folder(t.spark, "updated")
    new = t.lineitem.where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias(K)).agg(F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("flag"))
    old = t.orders.select(K, F.lit(9).alias("flag"), F.col("o_orderpriority").alias("processed_date"))
    incremental.replace_period(old, path, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    incremental.update_period_rows(t.spark, path, new, [K], ["flag"])
    return incremental.read_committed(t.spark, path).select(K, "flag")


@query("i3_update_from", _UPDATED_SQL)
def _(t):
    new = t.lineitem.where("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("flag"))
    old = t.orders.select(K, F.lit(9).alias("flag"))
    return incremental.update_from(old, new, old[K] == new.l_orderkey, ["flag"])
