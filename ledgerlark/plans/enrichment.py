"""Invoice flags and alert rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, money
from ..operators.dedup import top_per_key
from ..operators.joins import lookup_with_default, spread_null
from ..operators.rules import Rule, explode_rules, rule_flags
from ..sources import lookups
from .config import AuditConfig
from .consolidation import earliest_authorised, is_eps_product

NUMBER, RUC = "num_factura_documento_ocr", "ruc_proveedor_emisor_ocr"
# --- fixed values -----------------------------------------------------------
LETTER_TOLERANCE = {"AMBULATORIO": 1000, "HOSPITALARIO": 2000}
MECHANISM_CODES = {"CPM": "02", "PQ": "03", "PPS": "01"}
PLAN_GROUPS = {lookups.INSURER_EPS: "PLANES MEDICOS", lookups.INSURER_GENERAL: "ASISTENCIA MEDICA"}
MAX_DAYS_AUTHORISED_AFTER_ENTRY = 7
MAX_DAYS_ENTRY_AFTER_AUTHORISED = 14
# --- end of fixed values ----------------------------------------------------


def enrich(consolidated: DataFrame, claims_by_invoice: DataFrame, policies: DataFrame, claim_attentions: DataFrame,
           letter_states: DataFrame, validity: DataFrame, thresholds: DataFrame, duplicates: DataFrame,
           self_insured: DataFrame, config: AuditConfig, ties: list[str] = ()) -> DataFrame:
    """One row per invoice of the period with everything the rules look at, and their flags."""
    df = consolidated.where(F.col("processed_date") == config.processed_date)
    df = earliest_authorised(df, list(ties)).withColumn("flag_producto_eps_siteds_ocr", is_eps_product(F.col("producto_siteds_ocr")))
    df = _with_claim(df, claims_by_invoice)
    df = _with_policy(df, policies)
    df = _with_attentions(df, claim_attentions)
    df = _with_letter_state(df, letter_states)
    df = _with_validity(df, validity)
    df = with_threshold(df, thresholds)
    df = _with_duplicates(df, duplicates)
    df = with_self_insured(df, self_insured)
    flagged = rule_flags(df, flag_conditions(config.today_column()))
    order = [F.desc("coincide_plan"), F.asc_nulls_last("num_siniestro"), F.asc_nulls_last("id_cobertura_origen"),
             F.asc_nulls_last("agrupacion_cobertura_negocio"), F.desc_nulls_last("flag_cg_anulada"), F.asc_nulls_last("razon_social")]
    return top_per_key(flagged, [NUMBER], order).drop("razon_social")


def _with_claim(df: DataFrame, claims: DataFrame) -> DataFrame:
    right = claims.select(F.col("numero_factura").alias("__n"), F.col("num_documento_proveedor_siniestro").alias("__r"),
                          "id_siniestro", "id_poliza", "num_siniestro", "mto_auditado_sol")
    return df.join(right, (F.col(NUMBER) == F.col("__n")) & (F.col(RUC) == F.col("__r")), "left").drop("__n", "__r")


def _with_policy(df: DataFrame, policies: DataFrame) -> DataFrame:
    right = policies.select(F.col("nro_documento_paciente").alias("__doc"), F.col("periodo").alias("__month"), "des_agrupacion_n1").distinct()
    month = dates.month_start(F.col("fecha_emision_siteds_ocr"))
    joined = df.join(right, (spread_null(df, F.col("num_documento_paciente_siteds_ocr_val")) == F.col("__doc").cast("string")) & (month == F.col("__month")), "left")
    company, group = F.col("ruc_compania_factura_ocr"), F.col("des_agrupacion_n1")
    same_plan = None
    for ruc, plan in PLAN_GROUPS.items():
        hit = (company == ruc) & (group == plan)
        same_plan = hit if same_plan is None else same_plan | hit
    return joined.withColumns({
        "flag_dni_perdetalle_coincide": F.when(F.col("__doc").isNull(), 0).otherwise(1),
        "coincide_plan": F.when(same_plan, 1).otherwise(0),
        "periodo_emision": dates.month_start(F.col("fecha_emision_fact_limpio_val")),
        "periodo_emision_sited": month,
        "diferencia_dias_fecha_factura_prestacion": F.datediff("fecha_emision_fact_limpio_val", "fecha_emision_siteds_ocr"),
    }).drop("__doc", "__month")


def _with_attentions(df: DataFrame, attentions: DataFrame) -> DataFrame:
    right = attentions.withColumnsRenamed({"factura": "__n", "num_documento_proveedor_siniestro": "__r"}).drop("num_carta_garantia", "des_mecanismo_pago")
    joined = df.join(right, (F.col(NUMBER) == F.col("__n")) & (F.col(RUC) == F.col("__r")), "left")
    return joined.withColumns({
        "flag_dni_rs_coincide": F.when(F.col("num_documento_afiliado").isNull(), 0).otherwise(1),
        "flag_producto_rs_coincide": F.when(F.col("producto_siteds_ocr") == F.col("des_producto_agrupado"), 1).otherwise(0),
    }).drop("__n", "__r")


def _with_letter_state(df: DataFrame, states: DataFrame) -> DataFrame:
    number = F.get(F.split("nro_carta", "-"), F.lit(0)).try_cast("bigint")
    right = states.select(F.col("num_carta_garantia").alias("__c"), F.col("num_documento_proveedor").alias("__r"), "flag_cg_anulada")
    return df.join(right, (spread_null(df, number) == F.col("__c").cast("string")) & (F.col(RUC) == F.col("__r")), "left").drop("__c", "__r")


def _with_validity(df: DataFrame, validity: DataFrame) -> DataFrame:
    right = validity.select(F.col("id_persona").alias("__p"), F.col("id_poliza").alias("__pol"), "fec_inicio_vigencia", "fec_fin_vigencia")
    on = (spread_null(df, F.col("id_persona_afiliado")) == F.col("__p").cast("string")) & (F.col("id_poliza") == F.col("__pol"))
    return df.join(right, on, "left").drop("__p", "__pol")


def with_threshold(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Amount above which an invoice is atypical for its provider and coverage."""
    key = F.concat(RUC, F.lit("-"), "agrupacion_cobertura_negocio")
    out = lookup_with_default(df, thresholds, key == thresholds["key"], {
        "modelo": F.lit(lookups.DEFAULT_MODEL), "umbral": F.lit(lookups.DEFAULT_THRESHOLD)})
    return out.withColumn("flag_anomaly", F.when(F.col("monto_sub_factura_ocr") > F.col("umbral"), 1).otherwise(0))


def _with_duplicates(df: DataFrame, duplicates: DataFrame) -> DataFrame:
    right = duplicates.select(
        F.col(NUMBER).alias("__n"), F.col("num_siniestro").alias("num_siniestro_factDup"), "factura_duplicada", "monto_duplicado",
        "fec_atencion", "flag_dup", "dsc_dup", "flag_abono", "sts_abono", "dsc_abono", "flag_observada", "flag_devolucion", "estado_procesado")
    joined = df.join(right, F.col(NUMBER) == F.col("__n"), "left").drop("__n")
    return joined.withColumn("flag_duplicidad_pago", F.when(F.col("flag_dup") == 1, 1).otherwise(0)).drop("flag_dup")


def with_self_insured(df: DataFrame, firms: DataFrame) -> DataFrame:
    """Contracting firm on the self-insured list, names compared without case."""
    joined = df.join(firms.select("RUC", "razon_social"), F.upper("razon_social_contratante_siteds_ocr") == F.upper("razon_social"), "left")
    listed = F.col("RUC").isNotNull() & F.col("producto_siteds_mod").rlike("AMC|EPS|PLANES")
    return joined.withColumn("flag_contratante_autoseguro", F.when(listed, 1).otherwise(0)).drop("RUC")


def _differs_mechanism(code: Column) -> Column:
    mechanism, out = F.col("mecanismo_liqui_ocr"), None
    for name, expected in MECHANISM_CODES.items():
        hit = (mechanism == name) & (code != expected)
        out = hit if out is None else out | hit
    return out


def flag_conditions(today: Column) -> dict[str, Column]:
    """Condition of every flag column (those not fired as alerts included)."""
    c, day = F.col, lambda name: F.to_date(name)
    credit_note, letter = c("num_factura_notacredito_ocr"), c("num_factura_cartagarantia_ocr")
    settled, discharged = c("num_factura_liqui_ocr").isNotNull(), c("num_factura_epicrisis_ocr").isNotNull()
    pre_settled = c("num_factura_preliqui_ocr").isNotNull()
    company_known = c("producto_siteds_ocr").isNotNull() & c("ruc_compania_factura_ocr").isNotNull()
    eps, company = c("flag_producto_eps_siteds_ocr"), c("flag_compania_factura_ocr")
    authorised, entry = c("fecha_emision_siteds_ocr"), day("fec_ingreso_liqui_ocr")
    start, end = c("fec_inicio_vigencia"), c("fec_fin_vigencia")
    invoice_amount, letter_amount, group = c("monto_factura_ocr"), c("monto_final_cg"), c("agrupacion_cobertura_negocio")
    over_letter = ~group.isin(list(LETTER_TOLERANCE)) & (invoice_amount > letter_amount)
    for name, extra in LETTER_TOLERANCE.items():
        over_letter = over_letter | ((group == name) & (invoice_amount > letter_amount + extra))
    diagnosis, first = c("cie10_siteds_ocr"), c("cod_cie101_trama_sited")
    same_diagnosis = F.coalesce(diagnosis == first, F.lit(False))
    for other in ("cod_cie102_trama_sited", "cod_cie103_trama_sited"):
        same_diagnosis = same_diagnosis | F.coalesce(diagnosis == c(other), F.lit(False))
    outside_policy = lambda d: ~c(d).between(start, end)
    return {
        "flag_rucAseguradora_Fact_NoCoincide_producto_Siteds_ocr":
            (((eps == 1) & (company != 1)) | ((eps == 0) & (company == 1))) & company_known,
        "flag_conNC_trama_sinNC_sustento": (c("flag_conNC_trama") == 1) & credit_note.isNull(),
        "flag_sinNC_trama_conNC_sustento": (c("flag_conNC_trama") == 0) & credit_note.isNotNull(),
        "flag_conNC_trama_conNC_sustento": (c("flag_conNC_trama") == 1) & credit_note.isNotNull(),
        "flag_fechaEmisionNC_noCoincide_sustento_trama": c("fecha_nc_limpia") != c("fecha_nc_trama"),
        "flag_subtotalNC_noCoincide_sustento_trama": F.round("subtotal_ocr_nc") != F.round("montoSub_nc_trama"),
        "flag_totalNC_noCoincide_RS": (F.round("importe_total_ocr_nc") != F.round("mnt_nota_credito")) & (c("importe_total_ocr_nc") != 0),
        "flag_fecIngreso_mayor_fecAlta_preliqui_ocr":
            (day("fec_ingreso_preliqui_ocr") > day("fec_alta_preliqui_ocr")) & (c("mecanismo_liqui_ocr") != "CPM"),
        "flag_fecIngreso_mayor_fecAlta_liqui_ocr": entry > day("fec_alta_liqui_ocr"),
        "flag_fechasHosp_NoCoincide_diasHosp_epi_ocr":
            (F.datediff("fec_egreso_epi_ocr", "fec_ingreso_epi_ocr") > c("dias_hosp_epi_ocr")) & discharged,
        "flag_montoTotal_NoCoincide_Fact_Preli_ocr": (invoice_amount != c("monto_total_preliqui_ocr")) & pre_settled,
        "flag_fecAutoSiteds_ocr_NoCoincide_fecIngreso_preliqui_ocr": (authorised != day("fec_ingreso_preliqui_ocr")) & pre_settled,
        "flag_montoTotal_NoCoincide_Fact_Liqui_ocr":
            (c("monto_total_liqui_ocr") - invoice_amount > 0.1) & settled & (c("monto_total_liqui_ocr") != 0),
        "flag_fecIngreso_liqui_ocr_menor_fecAutoSiteds_ocr": (F.datediff(authorised, entry) > MAX_DAYS_AUTHORISED_AFTER_ENTRY) & settled,
        "flag_fecIngreso_liqui_ocr_mayor15d_fecAutoSiteds_ocr": (F.datediff(entry, authorised) > MAX_DAYS_ENTRY_AFTER_AUTHORISED) & settled,
        "flag_dniPaciente_Siteds_ocr_NoCoincide_Liqui_ocr":
            (c("num_documento_paciente_siteds_ocr_val") != c("num_documento_liqui_ocr")) & settled,
        "flag_dniPaciente_Siteds_ocr_NoCoincide_RS":
            (c("num_documento_paciente_siteds_ocr_val") != c("num_documento_afiliado")) & settled,
        "flag_codAutorizacion_Siteds_ocr_NoCoincide_Liqui_ocr":
            (c("num_siteds_ocr_val") != c("cod_autorizacion_liqui_ocr")) & settled & (c("mecanismo_liqui_ocr") != "CPM"),
        "flag_pctCopagoPaciente_Siteds_ocr_NoCoincide_pctCoaseguroPaciente_Liqui_ocr":
            (F.round(1 - c("cobertura_copago_variable_siteds_ocr")) != F.round(c("pct_coaseguro_liqui_ocr") / 100)) & settled,
        "flag_subtotal_Liqui_ocr_NoCoincide_Fact_trama":
            (F.round("gastos_afectos_subtotal3_liqui_ocr") != F.round("subtotal_fact_trama")) & settled
            & (c("gastos_afectos_subtotal3_liqui_ocr") != 0),
        "flag_deduciblePaciente_Siteds_ocr_NoCoincide_Liqui_ocr":
            (c("copago_fijo_siteds_ocr") != c("deducible_liqui_ocr")) & settled & (c("flag_consultaAmboMed_liqui_ocr") == 1)
            & (c("mecanismo_liqui_ocr") == "PPS"),
        "flag_mecanismoPago_Liquidacion_ocr_NoCoincide_RS": _differs_mechanism(c("cod_mecanismo_pago")),
        "flag_mecanismoPago_Liquidacion_ocr_NoCoincide_trama": _differs_mechanism(c("mecanismo_pago_fact_trama")),
        "flag_razonSocial_fact_ocr_NoCoincide_cg_ocr":
            (c("razon_social_fact_limpia_ocr") != c("razon_social_proveedor_cg_limpia_ocr")) & letter.isNotNull(),
        "flag_ruc_fact_ocr_NoCoincide_cg_ocr": (c(RUC) != c("ruc_proveedor_cg_ocr")) & letter.isNotNull(),
        # never decided: kept so that the column exists
        "flag_cg_dobleSiniestro": F.lit(None).cast("boolean"),
        "flag_fecIngreso_epi_ocr_menor_fecSiteds_ocr": (c("fec_ingreso_epi_ocr") < authorised) & discharged,
        "flag_dxSiteds_ocr_NoCoincide_trama": ~same_diagnosis & diagnosis.isNotNull() & first.isNotNull(),
        "flag_coberturaSiteds_ocr_NoCoincide_trama": c("cobertura_siteds_ocr_limpia") != c("cobertura_siteds_trama"),
        "flag_sinReceta_ambulatorio":
            (c("cobertura_siteds_ocr_limpia") == "AMBULATORIO") & (c("flag_medicamento_factura_ocr") == 1)
            & c("num_factura_rc_ocr").isNull() & (c("flag_consultaAmboMed_liqui_ocr") == 1),
        "flag_dxEntrada_CG_NoCoincide_dxEntrada_epi":
            (c("cobertura_siteds_ocr_limpia") == "OTROS") & (c("dx_entrada_transformada_cg_ocr") != c("dx_ingreso_epi_ocr")) & discharged,
        "flag_autoseguro_vencido": (dates.years_crossed(today, authorised) >= 1) & (c("flag_contratante_autoseguro") == 1),
        "flag_fecFact_mayor_fecSiteds_ocr": (authorised > c("fecha_emision_fact_limpio_val")) & c("num_siteds_ocr_val").isNotNull(),
        "flag_MtoTotal_ocr_NoCoincide_Trama": F.round("monto_factura_ocr") != F.round("monto_factura_trama"),
        "flag_fecAtencion_NoCoincide_rango_cg":
            letter.isNotNull() & ((authorised < c("fec_emision")) | (authorised > c("fec_val_sol"))),
        "flag_afiliadoNoVigenteAtencion": ~authorised.between(start, end) & end.isNotNull() & authorised.isNotNull(),
        # the letter guard covers only the first half
        "flag_afiliado_NoVigente_rango_cg": (letter.isNotNull() & outside_policy("fec_emision")) | outside_policy("fec_val_sol"),
        "flag_conCG_trama_sinCG_sustento": (c("flag_conCG_trama") == 1) & letter.isNull(),
        "flag_sinCG_trama_conCG_sustento": (c("flag_conCG_trama") == 0) & letter.isNotNull(),
        "flag_conCG_trama_conCG_sustento": (c("flag_conCG_trama") == 1) & letter.isNotNull(),
        "flag_monto_excede_cg": over_letter,
    }


# --- fixed values: messages of the alerts, in the order they are listed --------------
ALERTS = [
    ("flag_sinSiteds", "Factura no tiene hoja SITEDS"),
    ("flag_duplicidad_pago", "Factura con duplicidad de pago"),
    ("flag_conNC_trama_sinNC_sustento", "Con Nota Credito en la trama pero no en el sustento"),
    ("flag_sinNC_trama_conNC_sustento", "Sin Nota Credito en la trama pero si en el sustento"),
    ("flag_fechaEmisionNC_noCoincide_sustento_trama", "La fecha de emision de NC y Trama no coinciden"),
    ("flag_fecIngreso_mayor_fecAlta_preliqui_ocr", "La fecha de ingreso es posterior a la fecha de alta en la hoja Preliquidacion"),
    ("flag_montoTotal_NoCoincide_Fact_Liqui_ocr", "El monto total de la Factura no coincide con el de Liquidacion"),
    ("flag_fecIngreso_mayor_fecAlta_liqui_ocr", "La fecha de ingreso es posterior a la fecha de alta en la hoja Liquidacion"),
    ("flag_fecIngreso_liqui_ocr_menor_fecAutoSiteds_ocr", "La fecha de autorizacion de Siteds posterior a la fecha de ingreso en mas de 7 dias"),
    ("flag_fecIngreso_liqui_ocr_mayor15d_fecAutoSiteds_ocr", "La fecha de ingreso en la Liquidacion posterior a la fecha de autorizacion de Siteds en mas de 14 dias"),
    ("flag_codAutorizacion_Siteds_ocr_NoCoincide_Liqui_ocr", "El codigo de autorizacion de la hoja siteds no coincide con el de Liquidacion"),
    ("flag_pctCopagoPaciente_Siteds_ocr_NoCoincide_pctCoaseguroPaciente_Liqui_ocr", "El % cubierto del copago variable del SITEDS no coincide con el % de coaseguro del paciente en Liquidacion"),
    ("flag_deduciblePaciente_Siteds_ocr_NoCoincide_Liqui_ocr", "El deducible del Paciente en SITEDS no coincide con el de Liquidacion"),
    ("flag_mecanismoPago_Liquidacion_ocr_NoCoincide_RS", "El mecanismo de pago de Liquidacion no coincide con RS"),
    ("flag_conCG_trama_sinCG_sustento", "Con Carta Garantia en la trama pero no en el sustento"),
    ("flag_sinCG_trama_conCG_sustento", "Sin Carta Garantia en la trama pero si en el sustento"),
    ("flag_monto_excede_cg", "El monto de facturacion excede el de Carta Garantia del sustento"),
    ("flag_cg_anulada", "La carta de garantia se encuentra Anulada en RS"),
    ("flag_mecanismoPago_Liquidacion_ocr_NoCoincide_trama", "El mecanismo de pago de liquidación del sustento no coincide con el de la trama"),
    ("flag_subtotal_Liqui_ocr_NoCoincide_Fact_trama", "El monto subtotal de liquidación del sustento no coincide con el de la trama"),
    ("flag_razonSocial_fact_ocr_NoCoincide_cg_ocr", "La razon social de Factura no concide con la de la carta de garantia"),
    ("flag_ruc_fact_ocr_NoCoincide_cg_ocr", "El RUC de Factura no concide con el de la carta de garantia"),
    ("flag_cg_dobleSiniestro", "La Carta de Garantia de la trama esta asociada a mas de un siniestro"),
    ("flag_totalNC_noCoincide_RS", "El monto total de NC y RS no coincide"),
    ("flag_fechasHosp_NoCoincide_diasHosp_epi_ocr", "Fechas de hospitalizacion y los dias de estadia no coincide en el sustento de Epicrisis"),
    ("flag_fecIngreso_epi_ocr_menor_fecSiteds_ocr", "Fecha de ingreso en epicrisis menor a la fecha de siteds en el sustento"),
    ("flag_sinReceta_ambulatorio", "Ambulatorio con medicamento sin receta medica en el sustento"),
    ("flag_dxEntrada_CG_NoCoincide_dxEntrada_epi", "Hospitalarios con diagnostico de entrada CG no coincide con el de Epicrisis en el sustento"),
    ("flag_autoseguro_vencido", "Contratante con autoseguro vencido tras los 12 meses"),
    ("flag_fecFact_mayor_fecSiteds_ocr", "Fecha de autorizacion siteds posterior a fecha de facturacion en el sustento"),
    ("flag_MtoTotal_ocr_NoCoincide_Trama", "El monto total de la factura no coincide con el de la trama"),
    ("flag_fecAtencion_NoCoincide_rango_cg", "La fecha de atencion no esta dentro del rango de fechas de carta de garantia en el sustento"),
    ("flag_afiliadoNoVigenteAtencion", "Afiliado no vigente en RS durante la fecha de atencion en siteds"),
    ("flag_afiliado_NoVigente_rango_cg", "Afiliado no vigente en RS entre las fechas de la carta de garantia"),
]
ATYPICAL = ("Deteccion de Monto Atipico: El monto facturado es mucho mayor al monto historico promedio (S/. ",
            ") registrado para la cobertura (", ") en clínica (", ")")
INSURER_MISMATCH = "RUC {insurer} en Factura no coincide con producto usado en SITEDS"
PATIENT_UNKNOWN = "Doc Identidad Paciente no coincide con RS"
# --- end of fixed values ---------------------------------------------------------------


def alert_rules(insurer: str) -> list[Rule]:
    """The active rules: thirty-seven conditions with their messages."""
    c = F.col
    or_dash = lambda name: F.coalesce(c(name), F.lit("-"))
    atypical = F.concat(F.lit(ATYPICAL[0]), money.number_text(F.coalesce(c("umbral"), F.lit(0.0))), F.lit(ATYPICAL[1]),
                        or_dash("agrupacion_cobertura_negocio"), F.lit(ATYPICAL[2]), or_dash("nom_sede_proveedor_siniestro"), F.lit(ATYPICAL[3]))
    special = [
        Rule("atypical_amount", c("flag_anomaly") == 1, atypical),
        Rule("insurer_mismatch", c("flag_rucAseguradora_Fact_NoCoincide_producto_Siteds_ocr") == 1, INSURER_MISMATCH.format(insurer=insurer)),
        Rule("patient_unknown", (c("flag_dni_rs_coincide") == 0) & (c("flag_dni_perdetalle_coincide") != 1), PATIENT_UNKNOWN),
    ]
    return special + [Rule(name, c(name) == 1, message) for name, message in ALERTS]


ALERT_COLUMNS = [
    "processed_date", NUMBER, "factura_duplicada", "fecha_emision_siteds_ocr", "fec_atencion", "num_siniestro", "num_siniestro_factDup",
    "dsc_dup", "dsc_abono", "estado_procesado", "monto_sub_factura_ocr", "monto_factura_ocr", "monto_factura_trama", "monto_duplicado",
    "importe_total_ocr_nc", "montoSub_nc_trama", "monto_final_cg", "modelo", "umbral", "agrupacion_cobertura_negocio", RUC,
]
RENAMED = {"fec_atencion": "fec_atencion_duplicado", "estado_procesado": "estado_procesado_duplicado", "monto_duplicado": "monto_factura_duplicado"}


def alerts(enriched: DataFrame, config: AuditConfig) -> DataFrame:
    """One row per alert, one OK row per clean invoice; amounts go by name on both."""
    df = explode_rules(enriched, NUMBER, alert_rules(config.insurer), ALERT_COLUMNS)
    return df.withColumnsRenamed(RENAMED)
