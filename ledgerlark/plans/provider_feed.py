"""Other providers: audited from the feed alone, with four rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import label_map
from ..operators.nested import unnest
from ..operators.joins import spread_null
from ..operators.rules import Rule, explode_rules, rule_flags
from ..sources import feed, lookups
from .claims import claim_invoice, letter_validity
from .config import AuditConfig

NUMBER, RUC = "num_factura_documento_ocr", "ruc_proveedor_emisor_ocr"
# --- fixed values -----------------------------------------------------------
POLICY_PATTERN = r"^(.*)-[^-]+-[^-]+$"
CPM_CODE = "02"
SELF_INSURED_PRODUCTS = ["1", "62", "59", "S", "4", "11", "12", "38", "50", "52", "53", "95", "E1", "7", "49", "54", "93", "2", "15", "28",
                         "34", "16", "20"]
SHORT_LIMIT_MONTHS = 6
EXPIRED = "Contratante con autoseguro vencido"
NOT_COVERED = "Afiliado no vigente en RS entre las fechas de la carta de garantia"
DUPLICATE = "Factura con duplicidad de pago"
MORE_AUTHORISATIONS = "La cantidad de siteds de CPM en la trama no coincide con RS"
# --- end of fixed values ----------------------------------------------------


def feed_universe(documents: DataFrame, attentions: DataFrame, claims: DataFrame, lower: str, upper: str, config: AuditConfig) -> DataFrame:
    """Feed invoices with their attentions, for claims notified in the window."""
    latest = feed.latest_batch(documents, feed.KEYS, "CODIGOLOTE", [c for c in sorted(documents.columns) if c not in (*feed.KEYS, "CODIGOLOTE")])
    invoice = latest.select(
        F.col("NUMERODOCUMENTOPAGO").alias(NUMBER), F.col("RUCIPRESS").alias(RUC), F.col("CODIGOFINANCIADOR").alias("ruc_compania_factura_ocr"),
        dates.feed_date(F.col("FECHAEMISION")).alias("fecha_emision_fact_limpio_val"),
        F.col("MONTONETO").try_cast("double").alias("monto_sub_factura_ocr"), F.col("MONTOTOTAL").try_cast("double").alias("monto_factura_ocr"),
        F.col("CODIGOPRODUCTO").alias("codigoproducto_trama"), F.col("CODIGOMECANISMOPAGO").alias("mecanismo_liqui_ocr"),
        "FECHAENVIO", F.col("NUMEROLOTE").alias("num_lote"), "CODIGOLOTE")
    attention = attentions.select(
        F.col("NUMERODOCUMENTOPAGO").alias(NUMBER), F.col("RUCIPRESS").alias(RUC), F.col("NUMERODOCUMENTOIDENTIDAD").alias("dni_factura_ocr"),
        F.col("NUMEROAUTORIZACION").alias("num_siteds_ocr_val"), F.col("TIPOCOBERTURA").alias("cobertura_siteds_trama"),
        F.col("NUMERODOCUMENTOIDENTIDAD").alias("num_documento_paciente_siteds_ocr_val"),
        dates.feed_date(F.col("FECHAINICIOATENCION")).alias("fecha_emision_siteds_ocr"), F.col("CODIGOCIE101").alias("cie10_siteds_ocr"))
    universe = (claims.where((F.col("periodo") == config.month_column()) & (F.col("tip_reclamo") == "C")
                             & F.col("fec_notificacion").between(dates.instant(lower), dates.instant(upper))
                             & F.col("tip_caso_especial").isNull() & (F.substring("id_siniestro", 4, 1) != "9")
                             & F.col("num_documento_proveedor_siniestro").isin(lookups.ALL_PROVIDERS))
                .select(claim_invoice().alias(NUMBER), F.col("num_documento_proveedor_siniestro").alias(RUC)).distinct())
    return (invoice.join(universe, [NUMBER, RUC], "left_semi").join(attention, [NUMBER, RUC], "left")
            .withColumn("processed_date", F.lit(config.processed_date)).distinct())


def contract_classes(contract: Column) -> dict[str, Column]:
    """Chronic contract number (9999 when it is not one) and its text."""
    chronic = [n for members in lookups.CHRONIC_CONTRACTS.values() for n in members]
    label = None
    for name, members in lookups.CHRONIC_CONTRACTS.items():
        label = F.when(contract.isin(members), name) if label is None else label.when(contract.isin(members), name)
    return {"cod_tipo_contrato_cronico": F.when(contract.isin(chronic), contract).otherwise(lookups.NOT_CHRONIC),
            "contrato_cronico_texto": label.otherwise("OTROS")}


def enrich_feed(universe: DataFrame, claims: DataFrame, self_insured: DataFrame, units: DataFrame, letters: DataFrame,
                authorisations: DataFrame, config: AuditConfig) -> DataFrame:
    """Claim, contract, policy, letter and attention counts on every feed row."""
    month = claims.where(F.col("periodo") == config.month_column())
    per_invoice = month.groupBy(claim_invoice().alias(NUMBER), F.col("num_documento_proveedor_siniestro").alias(RUC)).agg(
        F.count_distinct("id_autorizacion").alias("ctdAtencionesSitedsxFacturaRS"))
    claim_columns = unnest(month, "atencion_salud", "ats", outer=True).select(
        claim_invoice().alias(NUMBER), F.col("num_documento_proveedor_siniestro").alias(RUC), "id_persona_afiliado", "num_siniestro",
        "id_siniestro", "id_poliza", F.col("num_poliza").alias("num_poliza_siteds_ocr"), "des_producto", "cod_producto_origen",
        "cod_tipo_contrato", F.col("ats.des_cobertura").alias("des_cobertura"), F.col("num_documento_contratante").alias("ruc_contratante"),
        "fec_notificacion", "id_autorizacion", "cod_sede_proveedor_siniestro", "nom_sede_proveedor_siniestro")
    df = universe.join(claim_columns, [NUMBER, RUC], "left").join(per_invoice, [NUMBER, RUC], "left")
    df = df.withColumns(contract_classes(F.col("cod_tipo_contrato")))
    df = df.withColumn("grupo_clinica_texto", label_map(F.col(RUC), lookups.clinic_groups(config.network)))
    firms = self_insured.where(F.col("RUC").isNotNull()).select(F.col("RUC").alias("__ruc")).distinct()
    df = df.join(firms, F.col("ruc_contratante") == F.col("__ruc"), "left")
    listed = F.col("__ruc").isNotNull() & F.col("codigoproducto_trama").isin(SELF_INSURED_PRODUCTS)
    df = df.withColumn("flag_contratante_autoseguro", F.when(listed, 1).otherwise(0)).drop("__ruc")
    df = _with_policy_dates(df, month, units)
    validity = letter_validity(letters, config).select(
        F.col("id_siniestro").alias("__claim"), "num_carta_garantia", "fec_aprobacion_carta", "fec_validez_carta",
        "mnt_carta_garantia_total", "flag_cg_anulada")
    df = df.join(validity, F.col("id_siniestro") == F.col("__claim"), "left").drop("__claim")
    return with_attention_counts(df, authorisations).distinct()


def _with_policy_dates(df: DataFrame, month: DataFrame, units: DataFrame) -> DataFrame:
    """Validity of the member's units on the same policy and product."""
    policy = F.nullif(F.regexp_extract("id_unidad_asegurable", POLICY_PATTERN, 1), F.lit(""))
    owned = units.where(F.col("id_origen") == "RS").select("id_persona", policy.alias("__policy"), "fec_inicio_vigencia", "fec_fin_vigencia").distinct()
    products = (month.where(F.col("tip_reclamo") == "C")
                .select(F.col("id_persona_afiliado").alias("id_persona"), F.col("id_poliza").alias("__policy"),
                        F.col("cod_producto_origen").alias("__product")).distinct())
    dated = owned.join(products, ["id_persona", "__policy"]).withColumnRenamed("id_persona", "__person")
    on = ((F.col("id_persona_afiliado") == F.col("__person")) & (F.col("id_poliza") == F.col("__policy"))
          & (F.col("cod_producto_origen") == F.col("__product")))
    return df.join(dated, on, "left").drop("__person", "__policy", "__product")


def with_attention_counts(df: DataFrame, authorisations: DataFrame) -> DataFrame:
    """Distinct authorisations per key in the mart, per invoice in the feed, per chronic contract and clinic group."""
    cpm = df.where(F.col("mecanismo_liqui_ocr") == CPM_CODE).select(F.col("num_siteds_ocr_val").alias("cod_autorizacion")).distinct()
    key = ["num_doc_proveedor", "cod_sede_proveedor", "id_persona_afiliado", "des_cobertura", "des_producto"]
    per_key = (authorisations.join(cpm, "cod_autorizacion", "left_semi").groupBy("periodo_autorizacion", *key)
               .agg(F.count_distinct("cod_autorizacion").alias("ctdAtencionesSitedsxLlaveRS"))
               .toDF("__period", *[f"__{k}" for k in key], "ctdAtencionesSitedsxLlaveRS"))
    month = dates.month_start(F.col("fecha_emision_siteds_ocr"))
    on = ((month == F.col("__period")) & (F.col(RUC) == F.col("__num_doc_proveedor"))
          & (F.col("cod_sede_proveedor_siniestro") == F.col("__cod_sede_proveedor"))
          & (spread_null(df, F.col("id_persona_afiliado")) == F.col("__id_persona_afiliado").cast("string")) & (F.col("des_cobertura") == F.col("__des_cobertura"))
          & (F.col("des_producto") == F.col("__des_producto")))
    df = df.join(per_key, on, "left").drop("__period", *[f"__{k}" for k in key])
    df = df.withColumn("__month", month)
    per_invoice = df.groupBy(NUMBER, RUC).agg(F.count_distinct("num_siteds_ocr_val").alias("ctdAtencionesSitedsxFacturaTrama"))
    group = ["__month", "grupo_clinica_texto", "cod_tipo_contrato_cronico", "id_persona_afiliado"]
    chronic = (df.groupBy(*group).agg(F.count_distinct(
        F.when(F.col("cod_tipo_contrato_cronico") != lookups.NOT_CHRONIC, F.col("num_siteds_ocr_val"))).alias("ctdAtencionesCPMCronicoClinica")))
    return df.join(chronic, group, "left").join(per_invoice, [NUMBER, RUC], "left").drop("__month")


def feed_flags(df: DataFrame, today: Column) -> DataFrame:
    """Flags of the provider list; column ``flag_dup`` comes from the duplicate waterfall."""
    c = F.col
    emitted = F.to_date("fecha_emision_fact_limpio_val")
    insured = c("flag_contratante_autoseguro") == 1
    short = ((c(RUC) == lookups.SHORT_LIMIT_PROVIDER) & c("ruc_contratante").isin(lookups.SHORT_LIMIT_FIRMS)
             & (dates.months_crossed(today, emitted) >= SHORT_LIMIT_MONTHS) & insured)
    yearly = (dates.years_crossed(today, emitted) >= 1) & insured
    start, end = c("fec_inicio_vigencia"), c("fec_fin_vigencia")
    outside = (~c("fec_aprobacion_carta").between(start, end)
               | (~c("fec_validez_carta").between(start, end) & (F.to_date("fecha_emision_siteds_ocr") > c("fec_validez_carta"))))
    return rule_flags(df, {
        "flag_autoseguro_vencido": short | yearly,
        "flag_afiliado_NoVigente_rango_cg": c("num_carta_garantia").isNotNull() & outside,
        "flag_duplicidad_pago": c("flag_dup") == 1,
        "flag_ctdSiteds_trama_autorizaciones_noCoincide":
            (c("ctdAtencionesSitedsxLlaveRS") > c("ctdAtencionesSitedsxFacturaTrama")) & (c("mecanismo_liqui_ocr") == CPM_CODE),
        "flag_afiliadoCPMAtencionesGrupoClinica": (c("ctdAtencionesCPMCronicoClinica") > 1) & c("id_persona_afiliado").isNotNull(),
    })


def provider_rules() -> list[Rule]:
    return [Rule("expired", F.col("flag_autoseguro_vencido") == 1, EXPIRED),
            Rule("not_covered", F.col("flag_afiliado_NoVigente_rango_cg") == 1, NOT_COVERED),
            Rule("duplicate", F.col("flag_duplicidad_pago") == 1, DUPLICATE),
            Rule("more_authorisations", F.col("flag_ctdSiteds_trama_autorizaciones_noCoincide") == 1, MORE_AUTHORISATIONS)]


ALERT_COLUMNS = [
    "grupo_clinica_texto", NUMBER, "factura_duplicada", "processed_date", "fecha_emision_siteds_ocr", "fec_atencion", "num_lote",
    "num_siniestro", "num_siniestro_factDup", "dsc_dup", "dsc_abono", "estado_procesado", "monto_sub_factura_ocr", "monto_factura_ocr",
    "monto_duplicado", RUC,
]


def provider_alerts(flagged: DataFrame) -> DataFrame:
    """Alert rows of the provider list; an invoice may have several feed rows."""
    df = explode_rules(flagged, NUMBER, provider_rules(), ALERT_COLUMNS, unique_key=False)
    return df.withColumnsRenamed({"fec_atencion": "fec_atencion_duplicado", "estado_procesado": "estado_procesado_duplicado",
                                  "monto_duplicado": "monto_factura_duplicado"}).distinct()
