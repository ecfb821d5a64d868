"""Audit rules over invoices made from orders: one query per flag, the alert rows and the provider list.

The columns a rule looks at are SQL expressions both engines evaluate; the conditions
are the library's on one side and written out in SQL on the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.text import flag
from ..operators.dedup import top_per_key
from ..operators.rules import rule_flags
from ..plans import consolidation, enrichment, provider_feed
from ..plans.config import AuditConfig
from ..sources import lookups
from .registry import Tables, query

K, P, D = "o_orderkey", "o_totalprice", "CAST(o_orderdate AS DATE)"
TODAY = dt.date(1998, 1, 2)
CONFIG = AuditConfig(network="CENTRAL", insurer="Seguros", period="2024-01-01", today=TODAY)


def shift(days: str, base: str = D) -> str:
    return f"({base} + CAST({days} AS INT))"


def when(condition: str, value: str, other: str | None = None) -> str:
    return f"CASE WHEN {condition} THEN {value} {'ELSE ' + other if other else ''} END"


FACTS = {
    "num_factura_documento_ocr": f"concat('F', {K})",
    "processed_date": "'2024-01-01'",
    "ruc_proveedor_emisor_ocr": f"CASE {K} % 3 WHEN 0 THEN '20501781291' WHEN 1 THEN '20102756364' ELSE '20100054184' END",
    "agrupacion_cobertura_negocio": f"CASE {K} % 5 WHEN 0 THEN 'AMBULATORIO' WHEN 1 THEN 'HOSPITALARIO' WHEN 2 THEN 'EMERGENCIA' WHEN 3 THEN 'OTROS' END",
    "nom_sede_proveedor_siniestro": when(f"{K} % 4 <> 0", "o_orderpriority"),
    "monto_sub_factura_ocr": f"{P} / 4",
    "monto_factura_ocr": P,
    "monto_factura_trama": when(f"{K} % 6 <> 0", when(f"{K} % 5 = 0", f"{P} + 3", P)),
    "flag_producto_eps_siteds_ocr": when(f"{K} % 2 = 0", "1", "0"),
    "flag_compania_factura_ocr": f"CAST({K} % 3 AS INT)",
    "producto_siteds_ocr": when(f"{K} % 8 <> 0", "'EPS'"),
    "producto_siteds_mod": when(f"{K} % 4 = 0", "'EPS'", "'AMI'"),
    "ruc_compania_factura_ocr": when(f"{K} % 9 <> 0", "'20414955020'"),
    "des_agrupacion_n1": when(f"{K} % 4 = 1", "'PLANES MEDICOS'", "'OTRO'"),
    "flag_dni_rs_coincide": when(f"{K} % 7 = 0", "0", "1"),
    "flag_dni_perdetalle_coincide": when(f"{K} % 5 = 0", "1", "0"),
    "flag_sinSiteds": when(f"{K} % 17 = 0", "1", "0"),
    "flag_duplicidad_pago": when(f"{K} % 23 = 0", "1", "0"),
    "flag_conNC_trama": when(f"{K} % 2 = 0", "1", "0"),
    "num_factura_notacredito_ocr": when(f"{K} % 3 = 0", "'NC'"),
    "fecha_nc_limpia": when(f"{K} % 3 = 0", shift(f"{K} % 2")),
    "fecha_nc_trama": when(f"{K} % 2 = 0", D),
    "subtotal_ocr_nc": when(f"{K} % 3 = 0", f"{P} / 10"),
    "montoSub_nc_trama": when(f"{K} % 2 = 0", f"{P} / 10 + {K} % 2"),
    "importe_total_ocr_nc": when(f"{K} % 3 = 0", f"({P} / 10) * ({K} % 4)"),
    "mnt_nota_credito": when(f"{K} % 5 <> 0", f"{P} / 10"),
    "mecanismo_liqui_ocr": f"CASE {K} % 4 WHEN 0 THEN 'PPS' WHEN 1 THEN 'CPM' WHEN 2 THEN 'PQ' END",
    "cod_mecanismo_pago": when(f"{K} % 5 <> 0", "'01'", "'02'"),
    "mecanismo_pago_fact_trama": when(f"{K} % 7 <> 0", "'02'", "'03'"),
    "num_factura_preliqui_ocr": when(f"{K} % 4 <> 3", "'PRE'"),
    "monto_total_preliqui_ocr": f"{P} + {K} % 2",
    "fec_ingreso_preliqui_ocr": f"CAST({shift(f'{K} % 6')} AS TIMESTAMP)",
    "fec_alta_preliqui_ocr": f"CAST({shift('3')} AS TIMESTAMP)",
    "num_factura_liqui_ocr": when(f"{K} % 5 <> 4", "'LIQ'"),
    "monto_total_liqui_ocr": f"({P} + {K} % 3) * ({K} % 2)",
    "fec_ingreso_liqui_ocr": f"CAST({shift(f'{K} % 40 - 20')} AS TIMESTAMP)",
    "fec_alta_liqui_ocr": f"CAST({shift('5')} AS TIMESTAMP)",
    "fecha_emision_siteds_ocr": when(f"{K} % 19 <> 0", D),
    "fecha_emision_fact_limpio_val": shift(f"{K} % 9 - 2"),
    "num_siteds_ocr_val": when(f"{K} % 13 <> 0", f"concat('A', {K} % 100)"),
    "cod_autorizacion_liqui_ocr": f"concat('A', {K} % 50)",
    "num_documento_paciente_siteds_ocr_val": f"concat('D', o_custkey)",
    "num_documento_liqui_ocr": when(f"{K} % 6 <> 0", f"concat('D', o_custkey - {K} % 2)"),
    "num_documento_afiliado": when(f"{K} % 6 <> 1", f"concat('D', o_custkey - {K} % 2)"),
    "cobertura_copago_variable_siteds_ocr": when(f"{K} % 5 <> 0", f"({K} % 11) / 10.0"),
    "pct_coaseguro_liqui_ocr": when(f"{K} % 7 <> 0", f"({K} % 21) * 5"),
    "copago_fijo_siteds_ocr": f"({K} % 4) * 1.0",
    "deducible_liqui_ocr": f"({K} % 8) * 1.0",
    "flag_consultaAmboMed_liqui_ocr": when(f"{K} % 3 <> 0", "1", "0"),
    "gastos_afectos_subtotal3_liqui_ocr": f"({P} / 2) * ({K} % 3)",
    "subtotal_fact_trama": when(f"{K} % 4 <> 0", f"{P} / 2"),
    "num_factura_cartagarantia_ocr": when(f"{K} % 2 = 1", "'CG'"),
    "flag_conCG_trama": when(f"{K} % 3 = 1", "1", "0"),
    "monto_final_cg": when(f"{K} % 9 <> 0", f"{P} - ({K} % 30) * 100"),
    "flag_cg_anulada": when(f"{K} % 29 = 0", "1", when(f"{K} % 2 = 0", "0")),
    "razon_social_fact_limpia_ocr": f"concat('CLINICA ', {K} % 3)",
    "razon_social_proveedor_cg_limpia_ocr": f"concat('CLINICA ', {K} % 2)",
    "ruc_proveedor_cg_ocr": "'20501781291'",
    "num_factura_epicrisis_ocr": when(f"{K} % 3 <> 1", "'EPI'"),
    "fec_ingreso_epi_ocr": shift(f"{K} % 7 - 3"),
    "fec_egreso_epi_ocr": shift(f"{K} % 7 - 3 + {K} % 5"),
    "dias_hosp_epi_ocr": f"({K} % 4) * 1.0",
    "dx_ingreso_epi_ocr": f"concat('DX', {K} % 3)",
    "dx_entrada_transformada_cg_ocr": when(f"{K} % 5 <> 0", f"concat('DX', {K} % 2)"),
    "cobertura_siteds_ocr_limpia": f"CASE {K} % 4 WHEN 0 THEN 'AMBULATORIO' WHEN 1 THEN 'OTROS' WHEN 2 THEN 'EMERGENCIA' END",
    "cobertura_siteds_trama": f"CASE {K} % 3 WHEN 0 THEN 'AMBULATORIO' ELSE 'OTROS' END",
    "cie10_siteds_ocr": when(f"{K} % 11 <> 0", f"concat('J0', {K} % 6)"),
    "cod_cie101_trama_sited": when(f"{K} % 10 <> 0", f"concat('J0', {K} % 4)"),
    "cod_cie102_trama_sited": when(f"{K} % 2 = 0", f"concat('J0', {K} % 5)"),
    "cod_cie103_trama_sited": "CAST(NULL AS STRING)",
    "flag_medicamento_factura_ocr": when(f"{K} % 3 <> 2", "1", "0"),
    "num_factura_rc_ocr": when(f"{K} % 5 = 0", "'RC'"),
    "flag_contratante_autoseguro": when(f"{K} % 4 = 0", "1", "0"),
    "fec_emision": shift(f"{K} % 15 - 10"),
    "fec_val_sol": shift(f"{K} % 15 + 5"),
    "fec_inicio_vigencia": when(f"{K} % 8 <> 0", shift("-2")),
    "fec_fin_vigencia": when(f"{K} % 8 <> 0", shift(f"{K} % 25 - 5")),
    "factura_duplicada": "CAST(NULL AS STRING)", "fec_atencion": D, "num_siniestro": f"concat('S', {K})", "num_siniestro_factDup": "CAST(NULL AS STRING)",
    "dsc_dup": "'-'", "dsc_abono": "''", "estado_procesado": "o_orderstatus", "monto_duplicado": P,
}
FACTS_SQL = "facts AS (SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in FACTS.items()) + " FROM orders)"
THRESHOLD_SQL = """enriched AS (SELECT *, CASE ruc_proveedor_emisor_ocr || '-' || agrupacion_cobertura_negocio WHEN '20501781291-AMBULATORIO' THEN 4175.59
  WHEN '20501781291-EMERGENCIA' THEN 2982.07 WHEN '20501781291-HOSPITALARIO' THEN 80000.0 WHEN '20102756364-AMBULATORIO' THEN 1843.25 WHEN '20102756364-EMERGENCIA' THEN 1887.66
  WHEN '20102756364-HOSPITALARIO' THEN 29795.44 WHEN '20102756364-OTROS' THEN 50.0 ELSE 40000.0 END::DOUBLE AS umbral FROM facts)"""
BASE = f"WITH {FACTS_SQL}, {THRESHOLD_SQL}"


def facts(t: Tables):
    # timestamps of the shared expressions are wall times
    df = t.orders.select(*[F.expr(e).alias(n) for n, e in FACTS.items()])
    stamps = [n for n, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def flagged(t: Tables):
    df = enrichment.with_threshold(facts(t), lookups.thresholds(t.spark))
    return rule_flags(df, enrichment.flag_conditions(CONFIG.today_column()))


LETTER = "num_factura_cartagarantia_ocr IS NOT NULL"
SETTLED = "num_factura_liqui_ocr IS NOT NULL"
MECH = "(mecanismo_liqui_ocr = 'CPM' AND {0} <> '02') OR (mecanismo_liqui_ocr = 'PQ' AND {0} <> '03') OR (mecanismo_liqui_ocr = 'PPS' AND {0} <> '01')"
RANGE = "BETWEEN fec_inicio_vigencia AND fec_fin_vigencia"
# query name -> (flag column, condition in SQL)
CONDITIONS = {
    "r2_insurer_mismatch": ("flag_rucAseguradora_Fact_NoCoincide_producto_Siteds_ocr",
        "((flag_producto_eps_siteds_ocr = 1 AND flag_compania_factura_ocr <> 1) OR (flag_producto_eps_siteds_ocr = 0 AND flag_compania_factura_ocr = 1)) AND producto_siteds_ocr IS NOT NULL AND ruc_compania_factura_ocr IS NOT NULL"),
    "r6_credit_note_only_in_feed": ("flag_conNC_trama_sinNC_sustento", "flag_conNC_trama = 1 AND num_factura_notacredito_ocr IS NULL"),
    "r7_credit_note_only_in_documents": ("flag_sinNC_trama_conNC_sustento", "flag_conNC_trama = 0 AND num_factura_notacredito_ocr IS NOT NULL"),
    "r8_credit_note_dates": ("flag_fechaEmisionNC_noCoincide_sustento_trama", "fecha_nc_limpia <> fecha_nc_trama"),
    "r9_pre_settlement_dates": ("flag_fecIngreso_mayor_fecAlta_preliqui_ocr", "fec_ingreso_preliqui_ocr::DATE > fec_alta_preliqui_ocr::DATE AND mecanismo_liqui_ocr <> 'CPM'"),
    "r10_settlement_exceeds_invoice": ("flag_montoTotal_NoCoincide_Fact_Liqui_ocr", f"monto_total_liqui_ocr - monto_factura_ocr > 0.1 AND {SETTLED} AND monto_total_liqui_ocr <> 0"),
    "r11_settlement_dates": ("flag_fecIngreso_mayor_fecAlta_liqui_ocr", "fec_ingreso_liqui_ocr::DATE > fec_alta_liqui_ocr::DATE"),
    "r12_authorised_after_entry": ("flag_fecIngreso_liqui_ocr_menor_fecAutoSiteds_ocr", f"date_diff('day', fec_ingreso_liqui_ocr::DATE, fecha_emision_siteds_ocr) > 7 AND {SETTLED}"),
    "r13_entry_after_authorised": ("flag_fecIngreso_liqui_ocr_mayor15d_fecAutoSiteds_ocr", f"date_diff('day', fecha_emision_siteds_ocr, fec_ingreso_liqui_ocr::DATE) > 14 AND {SETTLED}"),
    "r14_authorisation_codes": ("flag_codAutorizacion_Siteds_ocr_NoCoincide_Liqui_ocr", f"num_siteds_ocr_val <> cod_autorizacion_liqui_ocr AND {SETTLED} AND mecanismo_liqui_ocr <> 'CPM'"),
    "r15_copay_shares": ("flag_pctCopagoPaciente_Siteds_ocr_NoCoincide_pctCoaseguroPaciente_Liqui_ocr", f"round(1.0 - cobertura_copago_variable_siteds_ocr) <> round(pct_coaseguro_liqui_ocr / 100) AND {SETTLED}"),
    "r16_copay_and_deductible": ("flag_deduciblePaciente_Siteds_ocr_NoCoincide_Liqui_ocr", f"copago_fijo_siteds_ocr <> deducible_liqui_ocr AND {SETTLED} AND \"flag_consultaAmboMed_liqui_ocr\" = 1 AND mecanismo_liqui_ocr = 'PPS'"),
    "r17_mechanism_and_claims": ("flag_mecanismoPago_Liquidacion_ocr_NoCoincide_RS", MECH.format("cod_mecanismo_pago")),
    "r18_letter_only_in_feed": ("flag_conCG_trama_sinCG_sustento", "flag_conCG_trama = 1 AND num_factura_cartagarantia_ocr IS NULL"),
    "r19_letter_only_in_documents": ("flag_sinCG_trama_conCG_sustento", f"flag_conCG_trama = 0 AND {LETTER}"),
    "r20_invoice_exceeds_letter": ("flag_monto_excede_cg", "(monto_factura_ocr > monto_final_cg + 1000 AND agrupacion_cobertura_negocio = 'AMBULATORIO') OR (monto_factura_ocr > monto_final_cg + 2000 AND agrupacion_cobertura_negocio = 'HOSPITALARIO') OR (monto_factura_ocr > monto_final_cg AND agrupacion_cobertura_negocio NOT IN ('AMBULATORIO', 'HOSPITALARIO'))"),
    "r22_mechanism_and_feed": ("flag_mecanismoPago_Liquidacion_ocr_NoCoincide_trama", MECH.format("mecanismo_pago_fact_trama")),
    "r23_settlement_subtotal": ("flag_subtotal_Liqui_ocr_NoCoincide_Fact_trama", f"round(gastos_afectos_subtotal3_liqui_ocr) <> round(subtotal_fact_trama) AND {SETTLED} AND gastos_afectos_subtotal3_liqui_ocr <> 0"),
    "r24_company_names": ("flag_razonSocial_fact_ocr_NoCoincide_cg_ocr", f"razon_social_fact_limpia_ocr <> razon_social_proveedor_cg_limpia_ocr AND {LETTER}"),
    "r25_tax_ids": ("flag_ruc_fact_ocr_NoCoincide_cg_ocr", f"ruc_proveedor_emisor_ocr <> ruc_proveedor_cg_ocr AND {LETTER}"),
    "r26_letter_of_two_claims": ("flag_cg_dobleSiniestro", "CAST(NULL AS BOOLEAN)"),
    "r27_credit_note_total": ("flag_totalNC_noCoincide_RS", "round(importe_total_ocr_nc) <> round(mnt_nota_credito) AND importe_total_ocr_nc <> 0"),
    "r28_stay_days": ("flag_fechasHosp_NoCoincide_diasHosp_epi_ocr", "date_diff('day', fec_ingreso_epi_ocr, fec_egreso_epi_ocr) > dias_hosp_epi_ocr AND num_factura_epicrisis_ocr IS NOT NULL"),
    "r29_admission_before_authorisation": ("flag_fecIngreso_epi_ocr_menor_fecSiteds_ocr", "fec_ingreso_epi_ocr < fecha_emision_siteds_ocr AND num_factura_epicrisis_ocr IS NOT NULL"),
    "r30_medicine_without_prescription": ("flag_sinReceta_ambulatorio", "cobertura_siteds_ocr_limpia = 'AMBULATORIO' AND flag_medicamento_factura_ocr = 1 AND num_factura_rc_ocr IS NULL AND \"flag_consultaAmboMed_liqui_ocr\" = 1"),
    "r31_admission_diagnosis": ("flag_dxEntrada_CG_NoCoincide_dxEntrada_epi", "cobertura_siteds_ocr_limpia = 'OTROS' AND dx_entrada_transformada_cg_ocr <> dx_ingreso_epi_ocr AND num_factura_epicrisis_ocr IS NOT NULL"),
    "r32_self_insured_expired": ("flag_autoseguro_vencido", "date_diff('year', fecha_emision_siteds_ocr, DATE '1998-01-02') >= 1 AND flag_contratante_autoseguro = 1"),
    "r33_authorised_after_invoice": ("flag_fecFact_mayor_fecSiteds_ocr", "fecha_emision_siteds_ocr > fecha_emision_fact_limpio_val AND num_siteds_ocr_val IS NOT NULL"),
    "r34_invoice_total_and_feed": ("flag_MtoTotal_ocr_NoCoincide_Trama", "round(monto_factura_ocr) <> round(monto_factura_trama)"),
    "r35_service_outside_letter": ("flag_fecAtencion_NoCoincide_rango_cg", f"{LETTER} AND (fecha_emision_siteds_ocr < fec_emision OR fecha_emision_siteds_ocr > fec_val_sol)"),
    "r36_not_covered_at_service": ("flag_afiliadoNoVigenteAtencion", f"(fecha_emision_siteds_ocr NOT {RANGE}) AND fec_fin_vigencia IS NOT NULL AND fecha_emision_siteds_ocr IS NOT NULL"),
    "r37_not_covered_in_letter_range": ("flag_afiliado_NoVigente_rango_cg", f"{LETTER} AND (fec_emision NOT {RANGE}) OR (fec_val_sol NOT {RANGE})"),
    "r38_pre_settlement_total": ("flag_montoTotal_NoCoincide_Fact_Preli_ocr", "monto_factura_ocr <> monto_total_preliqui_ocr AND num_factura_preliqui_ocr IS NOT NULL"),
    "r38_pre_settlement_date": ("flag_fecAutoSiteds_ocr_NoCoincide_fecIngreso_preliqui_ocr", "fecha_emision_siteds_ocr <> fec_ingreso_preliqui_ocr::DATE AND num_factura_preliqui_ocr IS NOT NULL"),
    "r38_patient_and_settlement": ("flag_dniPaciente_Siteds_ocr_NoCoincide_Liqui_ocr", f"num_documento_paciente_siteds_ocr_val <> num_documento_liqui_ocr AND {SETTLED}"),
    "r38_patient_and_claims": ("flag_dniPaciente_Siteds_ocr_NoCoincide_RS", f"num_documento_paciente_siteds_ocr_val <> num_documento_afiliado AND {SETTLED}"),
    "r38_diagnosis": ("flag_dxSiteds_ocr_NoCoincide_trama", "NOT coalesce(cie10_siteds_ocr = cod_cie101_trama_sited OR cie10_siteds_ocr = cod_cie102_trama_sited, false) AND cie10_siteds_ocr IS NOT NULL AND cod_cie101_trama_sited IS NOT NULL"),
    "r38_coverage": ("flag_coberturaSiteds_ocr_NoCoincide_trama", "cobertura_siteds_ocr_limpia <> cobertura_siteds_trama"),
    "r38_credit_note_subtotal": ("flag_subtotalNC_noCoincide_sustento_trama", "round(subtotal_ocr_nc) <> round(montoSub_nc_trama)"),
    "r38_credit_note_on_both": ("flag_conNC_trama_conNC_sustento", "flag_conNC_trama = 1 AND num_factura_notacredito_ocr IS NOT NULL"),
    "r38_letter_on_both": ("flag_conCG_trama_conCG_sustento", f"flag_conCG_trama = 1 AND {LETTER}"),
}


def _flag_query(name: str, column: str, condition: str) -> None:
    @query(name, f"{BASE} SELECT num_factura_documento_ocr, CASE WHEN {condition} THEN 1 ELSE 0 END AS flag FROM enriched")
    def _(t):
        return rule_flags(facts(t), {"flag": enrichment.flag_conditions(CONFIG.today_column())[column]}).select("num_factura_documento_ocr", "flag")


for _name, (_column, _condition) in CONDITIONS.items():
    _flag_query(_name, _column, _condition)


@query("r1_atypical_amount", f"{BASE} SELECT num_factura_documento_ocr, umbral, CASE WHEN monto_sub_factura_ocr > umbral THEN 1 ELSE 0 END AS flag FROM enriched")
def _(t):
    df = enrichment.with_threshold(facts(t), lookups.thresholds(t.spark))
    return df.select("num_factura_documento_ocr", "umbral", F.col("flag_anomaly").alias("flag"))


@query("r3_patient_unknown", f"{BASE} SELECT num_factura_documento_ocr, CASE WHEN flag_dni_rs_coincide = 0 AND flag_dni_perdetalle_coincide <> 1 THEN 1 ELSE 0 END AS flag FROM enriched")
def _(t):
    rule = next(r for r in enrichment.alert_rules(CONFIG.insurer) if r.name == "patient_unknown")
    return rule_flags(facts(t).withColumn("umbral", F.lit(0.0)), {"flag": rule.condition}).select("num_factura_documento_ocr", "flag")


@query("r4_no_authorisation_sheet", """
SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END AS flag FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey""")
def _(t):
    sheets = t.lineitem.where("l_returnflag = 'R'").select("l_orderkey").distinct()
    return (t.orders.join(sheets, t.orders.o_orderkey == sheets.l_orderkey, "left")
            .select("o_orderkey", flag(F.col("l_orderkey").isNull()).alias("flag")))


@query("r21_letter_annulled", f"{BASE} SELECT num_factura_documento_ocr, CASE WHEN flag_cg_anulada = 1 THEN 1 ELSE 0 END AS flag FROM enriched")
def _(t):
    rule = next(r for r in enrichment.alert_rules(CONFIG.insurer) if r.name == "flag_cg_anulada")
    return rule_flags(facts(t), {"flag": rule.condition}).select("num_factura_documento_ocr", "flag")


@query("r39_plan_coincidence", """
SELECT o_custkey, o_orderkey, plan FROM (SELECT *, CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS plan FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY plan DESC, o_orderkey) = 1""")
def _(t):
    company, group = F.expr(FACTS["ruc_compania_factura_ocr"]), F.expr(FACTS["des_agrupacion_n1"])
    plan = flag((company == lookups.INSURER_EPS) & (group == enrichment.PLAN_GROUPS[lookups.INSURER_EPS]))
    df = t.orders.withColumn("plan", plan)
    return top_per_key(df, ["o_custkey"], [F.desc("plan"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "plan")


def _text(message: str) -> str:
    return "'" + message + "'"


_NUMBER = r"regexp_replace(umbral::DECIMAL(38,2)::VARCHAR, '\.?0+$', '')"
_ALERT_CASES = ", ".join(
    [f"CASE WHEN monto_sub_factura_ocr > umbral THEN {_text(enrichment.ATYPICAL[0])} || {_NUMBER} || {_text(enrichment.ATYPICAL[1])} || coalesce(agrupacion_cobertura_negocio, '-') || {_text(enrichment.ATYPICAL[2])} || coalesce(nom_sede_proveedor_siniestro, '-') || ')' END",
     f"CASE WHEN {CONDITIONS['r2_insurer_mismatch'][1]} THEN {_text(enrichment.INSURER_MISMATCH.format(insurer='Seguros'))} END",
     f"CASE WHEN flag_dni_rs_coincide = 0 AND flag_dni_perdetalle_coincide <> 1 THEN {_text(enrichment.PATIENT_UNKNOWN)} END"]
    + [f"CASE WHEN {dict(CONDITIONS.values()).get(column, column + ' = 1')} THEN {_text(message)} END" for column, message in enrichment.ALERTS])
ALERTS_SQL = f"""{BASE}, fired AS (SELECT *, list_filter([{_ALERT_CASES}], lambda m: m IS NOT NULL) AS messages FROM enriched),
alerts AS (SELECT *, unnest(CASE WHEN len(messages) = 0 THEN ['Factura OK'] ELSE messages END) AS reglas_mensaje FROM fired)"""


@query("r_alert_rows", f"{ALERTS_SQL} SELECT num_factura_documento_ocr, reglas_mensaje, monto_factura_ocr, monto_factura_trama, CASE WHEN reglas_mensaje = 'Factura OK' THEN 'OK' ELSE 'OBSERVADA' END AS estado FROM alerts")
def _(t):
    return (enrichment.alerts(flagged(t), CONFIG)
            .select("num_factura_documento_ocr", "reglas_mensaje", "monto_factura_ocr", "monto_factura_trama", "estado"))


@query("r_state_counts", f"{ALERTS_SQL} SELECT CASE WHEN reglas_mensaje = 'Factura OK' THEN 'OK' ELSE 'OBSERVADA' END AS estado, reglas_mensaje, count(*) AS n FROM alerts GROUP BY 1, 2")
def _(t):
    return enrichment.alerts(flagged(t), CONFIG).groupBy("estado", "reglas_mensaje").agg(F.count(F.lit(1)).alias("n"))


# --- provider list: line items stand in for feed rows, so an invoice has several --------
L = "l_orderkey"
FEED_FACTS = {
    "num_factura_documento_ocr": f"concat('F', {L})", "processed_date": "'2024-01-01'", "grupo_clinica_texto": "l_returnflag",
    "ruc_proveedor_emisor_ocr": f"CASE {L} % 3 WHEN 0 THEN '20100054184' ELSE '20102756364' END",
    "ruc_contratante": f"CASE {L} % 4 WHEN 0 THEN '20100070970' ELSE '20161749126' END",
    "fecha_emision_fact_limpio_val": "CAST(l_shipdate AS DATE)", "flag_contratante_autoseguro": "CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END",
    "num_carta_garantia": f"CASE WHEN {L} % 2 = 0 THEN {L} END", "fec_aprobacion_carta": "(CAST(l_shipdate AS DATE) + CAST(l_partkey % 12 AS INT))",
    "fec_validez_carta": "(CAST(l_shipdate AS DATE) + CAST(l_partkey % 12 - 4 AS INT))", "fec_inicio_vigencia": "(CAST(l_shipdate AS DATE) + CAST(-1 AS INT))",
    "fec_fin_vigencia": "(CAST(l_shipdate AS DATE) + CAST(l_suppkey % 14 AS INT))", "fecha_emision_siteds_ocr": "CAST(l_shipdate AS DATE)",
    "flag_dup": "CASE WHEN l_partkey % 37 = 0 THEN 1 END", "ctdAtencionesSitedsxLlaveRS": "CASE WHEN l_partkey % 5 <> 0 THEN l_partkey % 7 END",
    "ctdAtencionesSitedsxFacturaTrama": "l_suppkey % 7", "mecanismo_liqui_ocr": "CASE WHEN l_suppkey % 11 = 0 THEN '02' ELSE '01' END",
    "ctdAtencionesCPMCronicoClinica": "l_partkey % 3", "id_persona_afiliado": "CASE WHEN l_suppkey % 4 <> 0 THEN 'P' END",
    "num_lote": "CAST(l_linenumber AS STRING)", "factura_duplicada": "CAST(NULL AS STRING)", "fec_atencion": "CAST(l_shipdate AS DATE)",
    "num_siniestro": f"concat('S', {L})", "num_siniestro_factDup": "CAST(NULL AS STRING)", "dsc_dup": "'-'", "dsc_abono": "''",
    "estado_procesado": "l_linestatus", "monto_sub_factura_ocr": "l_extendedprice", "monto_factura_ocr": "l_extendedprice", "monto_duplicado": "l_extendedprice",
    "key": "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)",
}
FEED_SQL = "WITH feed AS (SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in FEED_FACTS.items()) + " FROM lineitem)"
_INSURED = "flag_contratante_autoseguro = 1"
FEED_CONDITIONS = {
    "r40_provider_self_insured": ("flag_autoseguro_vencido", f"(ruc_proveedor_emisor_ocr = '20100054184' AND ruc_contratante IN ('20423924137','20100070970','20501827623','20607092851','20606862556') AND date_diff('month', fecha_emision_fact_limpio_val, DATE '1998-01-02') >= 6 AND {_INSURED}) OR (date_diff('year', fecha_emision_fact_limpio_val, DATE '1998-01-02') >= 1 AND {_INSURED})"),
    "r41_provider_not_covered": ("flag_afiliado_NoVigente_rango_cg", f"num_carta_garantia IS NOT NULL AND ((fec_aprobacion_carta NOT {RANGE}) OR (fec_validez_carta NOT {RANGE} AND fecha_emision_siteds_ocr > fec_validez_carta))"),
    "r42_provider_duplicate": ("flag_duplicidad_pago", "flag_dup = 1"),
    "r43_provider_more_authorisations": ("flag_ctdSiteds_trama_autorizaciones_noCoincide", "\"ctdAtencionesSitedsxLlaveRS\" > \"ctdAtencionesSitedsxFacturaTrama\" AND mecanismo_liqui_ocr = '02'"),
    "r44_provider_chronic_attentions": ("flag_afiliadoCPMAtencionesGrupoClinica", "\"ctdAtencionesCPMCronicoClinica\" > 1 AND id_persona_afiliado IS NOT NULL"),
}


def feed_flagged(t: Tables):
    df = t.lineitem.select(*[F.expr(e).alias(n) for n, e in FEED_FACTS.items()])
    return provider_feed.feed_flags(df, CONFIG.today_column())


def _feed_query(name: str, column: str, condition: str) -> None:
    @query(name, f"{FEED_SQL} SELECT key, CASE WHEN {condition} THEN 1 ELSE 0 END AS flag FROM feed")
    def _(t):
        return feed_flagged(t).select("key", F.col(column).alias("flag"))


for _name, (_column, _condition) in FEED_CONDITIONS.items():
    _feed_query(_name, _column, _condition)

_FEED_CASES = ", ".join(f"CASE WHEN {FEED_CONDITIONS[q][1]} THEN '{m}' END" for q, m in (
    ("r40_provider_self_insured", provider_feed.EXPIRED), ("r41_provider_not_covered", provider_feed.NOT_COVERED),
    ("r42_provider_duplicate", provider_feed.DUPLICATE), ("r43_provider_more_authorisations", provider_feed.MORE_AUTHORISATIONS)))


@query("r_provider_alert_rows", f"""{FEED_SQL}, fired AS (SELECT *, list_filter([{_FEED_CASES}], lambda m: m IS NOT NULL) AS messages FROM feed),
alerts AS (SELECT *, unnest(messages) AS reglas_mensaje FROM fired),
rows AS (SELECT num_factura_documento_ocr, num_lote, monto_factura_ocr, reglas_mensaje FROM alerts
  UNION ALL SELECT num_factura_documento_ocr, num_lote, monto_factura_ocr, 'Factura OK' FROM feed WHERE num_factura_documento_ocr NOT IN (SELECT num_factura_documento_ocr FROM alerts))
SELECT num_factura_documento_ocr, reglas_mensaje, count(DISTINCT num_lote) AS lots, max(monto_factura_ocr) AS top, CASE WHEN reglas_mensaje = 'Factura OK' THEN 'OK' ELSE 'OBSERVADA' END AS estado FROM rows GROUP BY ALL""")
def _(t):
    rows = provider_feed.provider_alerts(feed_flagged(t))
    return rows.groupBy("num_factura_documento_ocr", "reglas_mensaje", "estado").agg(
        F.count_distinct("num_lote").alias("lots"), F.max("monto_factura_ocr").alias("top"))
