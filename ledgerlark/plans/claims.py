"""Views of the claims mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, text
from ..operators.dedup import top_per_key
from ..operators.nested import unnest
from ..operators.positions import running_max
from ..sources import lookups
from .config import AuditConfig

# --- fixed values -----------------------------------------------------------
SNAPSHOT_FROM = "2025-01-20"
ACTIVE_CODES = ["ACT", "NO DETERMINADO", "NDE"]
ANNULLED_LETTER_STATES = ["ANULADA", "AN", "RECHAZADA"]
LETTER_VALID_DAYS = 30
NOTIFIED_TASKS = ["NOTIFICADOS", "NOTIFICADO-CAMUNDA"]
# --- end of fixed values ----------------------------------------------------


def claim_invoice() -> Column:
    return text.series_number(F.col("cod_serie_comprobante_siniestro"), F.col("num_comprobante_siniestro"))


def regular_claims(claims: DataFrame, config: AuditConfig, credit_only: bool = True) -> DataFrame:
    """Claims of the current month, without the excluded family, credit ones only by default."""
    df = claims.where((F.col("periodo") == config.month_column()) & (F.substring("id_siniestro", 4, 1) != "9"))
    return df.where(F.col("tip_reclamo") == "C") if credit_only else df


def coverage_group(coverage_id: Column, own: Column) -> Column:
    out = None
    for group, ids in lookups.COVERAGE_IDS.items():
        out = F.when(coverage_id.isin(ids), group) if out is None else out.when(coverage_id.isin(ids), group)
    return out.otherwise(text.trim_blanks(own))


def historical_claims(claims: DataFrame, config: AuditConfig) -> DataFrame:
    """One row per claim with its invoice number.

    The nested attentions only repeat these columns, so they are not exploded.
    """
    return regular_claims(claims, config).select(
        claim_invoice().alias("numero_factura"), "num_documento_proveedor_siniestro", "id_siniestro", "id_poliza",
        "num_siniestro", "mto_auditado_sol").distinct()


def claim_attentions(claims: DataFrame, config: AuditConfig) -> DataFrame:
    """Claim attentions with their coverage class, credit or not."""
    df = unnest(regular_claims(claims, config, credit_only=False), "atencion_salud", "ats", outer=True)
    return df.select(
        claim_invoice().alias("factura"), "num_documento_proveedor_siniestro", "nom_comercial_proveedor_siniestro",
        "nom_sede_proveedor_siniestro", "num_carta_garantia", "num_documento_afiliado", "id_persona_afiliado",
        "cod_mecanismo_pago", "des_mecanismo_pago", F.col("ats.id_cobertura_origen").alias("id_cobertura_origen"),
        coverage_group(F.col("ats.id_cobertura_origen"), F.col("ats.agrupacion_cobertura_negocio")).alias("agrupacion_cobertura_negocio"),
        "des_producto_agrupado", "mnt_nota_credito").distinct()


def active_policies(people: DataFrame) -> DataFrame:
    """Health policies in force by person and month; the person code loses its two-letter prefix."""
    active = (F.col("id_estado_poliza").isin(ACTIVE_CODES) & F.col("id_estado_certificado").isin(ACTIVE_CODES)
              & (F.col("des_riesgo") == "SALUD"))
    return people.where(active).select(F.substr("cuc", F.lit(3)).alias("nro_documento_paciente"), "periodo", "des_agrupacion_n1")


def letter_states(requests: DataFrame, config: AuditConfig) -> DataFrame:
    df = requests.where(F.col("periodo") == config.month_column())
    return df.select("num_carta_garantia", "num_documento_proveedor",
                     F.when(F.col("des_est_carta_garantia_origen") == "ANULADA", 1).otherwise(0).alias("flag_cg_anulada")).distinct()


def letter_validity(requests: DataFrame, config: AuditConfig) -> DataFrame:
    """Letter per claim with its latest approval and the thirty days it is valid."""
    df = unnest(requests.where(F.col("periodo") == config.month_column()), "carta_garantia_version", "v", outer=True)
    state = F.when(F.col("des_est_carta_garantia_origen").isin(ANNULLED_LETTER_STATES), 1).otherwise(0)
    approved = F.max("v.fec_aprobacion")
    return df.groupBy("id_siniestro", "num_carta_garantia", "num_carta_garantia_origen", "num_documento_proveedor",
                      "mnt_carta_garantia_total", state.alias("flag_cg_anulada")).agg(
        approved.alias("fec_aprobacion_carta"), F.date_add(approved, LETTER_VALID_DAYS).alias("fec_validez_carta"))


def policy_validity(units: DataFrame, pattern: str = r"^([^\\-]+-[^\\-]+)") -> DataFrame:
    """Validity per person and policy: the unit in force first, then the newest."""
    df = (units.where(F.col("id_origen") == "RS")
          .withColumn("id_poliza", F.nullif(F.regexp_extract("id_unidad_asegurable", pattern, 1), F.lit(""))))
    in_force = F.when(F.col("des_estado_origen_unidad_asegurable") == "VIGENTE", 1).otherwise(2)
    top = top_per_key(df, ["id_persona", "id_poliza"], [in_force, F.desc_nulls_last("fec_inicio_vigencia"),
                                                        F.desc_nulls_last("fec_fin_vigencia"), F.asc("id_unidad_asegurable")])
    return top.select("id_persona", "id_poliza", "fec_inicio_vigencia", "fec_fin_vigencia")


def processed_claims(claims: DataFrame, authorisations: DataFrame, products: DataFrame, letters: DataFrame,
                     payables: DataFrame, config: AuditConfig) -> DataFrame:
    """Settled and refunded claims with payment state, letter and last refund (report of processed claims)."""
    keep = [*lookups.SETTLED_STATES, lookups.REFUNDED_STATE]
    df = regular_claims(claims, config).where(F.col("id_estado_siniestro_origen").isin(keep))
    df = unnest(unnest(df, "atencion_salud", "ats", outer=True), "grupo_devolucion", "dev", outer=True)
    df = df.select(
        "*", F.col("dev.des_cod_motivo_devolucion").alias("__reason"), F.col("dev.num_correlativo_devolucion").alias("__item"),
        F.col("dev.fec_devolucion_siniestro").alias("__date"))
    late = F.lit(2**31)
    df = running_max(
        df, ["num_siniestro", "__reason"], [F.desc_nulls_last("__item"), F.desc_nulls_last("__date")],
        F.coalesce(-F.floor(F.col("__item") / 1000), late),
        item_dev=F.col("__item"), auditoria=F.col("dev.des_cod_grupo_devolucion"), motivo=F.col("__reason"),
        fec_devolucion=F.col("__date"), __code=F.col("dev.cod_motivo_devolucion"))
    refunded = F.col("id_estado_siniestro_origen") == lookups.REFUNDED_STATE
    definitive = F.col("__code").isin(lookups.DEFINITIVE_REFUND_REASONS)
    without = lambda c, prefix: F.replace(F.col(c), F.lit(prefix), F.lit(""))
    base = df.select(
        claim_invoice().alias("factura"), "id_siniestro", F.col("id_autorizacion").alias("__aut"),
        without("id_autorizacion", "RS-").alias("id_autorizacion"), F.substring("id_siniestro_origen", 1, 1).alias("cia"),
        F.col("mto_auditado_sol").alias("imp_documento"), "num_documento_proveedor_siniestro", "num_poliza",
        money.document_number(F.col("num_documento_afiliado")).alias("num_documento_afiliado"), "fec_comprobante_siniestro",
        F.col("ats.num_diagnostico_origen").alias("num_diagnostico_origen"), F.col("ats.id_cobertura_origen").alias("id_cobertura_origen"),
        without("id_persona_afiliado", "AX-").alias("id_persona_afiliado"), "num_siniestro", "id_estado_siniestro_origen",
        "des_estado_siniestro_origen", without("id_contratante", "AX-").alias("id_contratante"), "fec_ult_liquidacion",
        "fec_hora_ocurrencia", "fec_notificacion", without("id_persona_proveedor_siniestro", "AX-").alias("id_persona_proveedor_siniestro"),
        "cod_sede_proveedor_siniestro", without("id_producto", "AX-").alias("id_producto"), "cod_mecanismo_pago", "cod_tipo_contrato",
        F.col("num_obligacion").alias("__obligation"),
        *[F.when(refunded, F.col(c)).alias(c) for c in ("item_dev", "auditoria", "motivo", "fec_devolucion")],
        F.when(refunded & definitive, "Rechazo_Definitivo").when(refunded & ~definitive, "Rechazo_No_Definitivo").alias("ind_devoluc"))
    parts = F.split("id_maestro_cuenta_por_pagar", "-")
    payment = payables.select(F.concat(F.get(parts, F.lit(0)), F.lit("-"), F.get(parts, F.lit(1))).alias("__pay"),
                              F.col("cod_est_pago").alias("est_cuenta_por_pagar"))
    letter = letters.select(F.col("id_siniestro").alias("__claim"),
                            F.concat(F.col("anio_carta_garantia").cast("string"), F.lit("-"), F.col("num_carta_garantia").cast("string")).alias("carta_garantia"))
    authorised = authorisations.select(F.col("id_autorizacion").alias("__a"), "fec_autorizacion")
    product = products.select(F.col("cod_producto_ax").alias("__p"), "cod_producto").distinct()
    return (base.join(authorised, F.col("__aut") == F.col("__a"), "left")
            .join(product, F.col("id_producto") == F.col("__p"), "left")
            .join(letter, F.col("id_siniestro") == F.col("__claim"), "left")
            .join(payment, F.col("__obligation") == F.col("__pay"), "left")
            .drop("__a", "__p", "__claim", "__pay", "__aut", "__obligation", "id_siniestro").distinct())


def official_snapshot(claims: DataFrame, trays: DataFrame, config: AuditConfig) -> DataFrame:
    """Official claim list: state class, first attention, principal diagnosis, tray, payable amounts."""
    month = claims.where(F.col("periodo") == config.month_column())
    rows = (regular_claims(claims, config)
            .where((F.to_date("fec_notificacion") >= F.lit(SNAPSHOT_FROM).cast("date"))
                   & F.col("num_documento_proveedor_siniestro").isin(lookups.ALL_PROVIDERS)))
    first = F.array_min(F.transform("atencion_salud", lambda a: F.struct(
        a["num_correlativo_atencion"].alias("o"), a["des_cobertura"].alias("c"))))["c"]
    by_claim = month.groupBy(F.col("id_siniestro").alias("__c1")).agg(F.max(first).alias("__first"))
    excluded = month.where(F.substring("id_siniestro", 4, 1) != "9")
    principal = F.array_min(F.transform("diagnostico_principal", lambda d: d["des_cobertura_principal"]))
    by_diagnosis = excluded.groupBy(F.col("id_siniestro").alias("__c2")).agg(F.max(principal).alias("__principal"))
    state = F.col("id_estado_siniestro_origen")
    net = F.aggregate("atencion_salud", F.lit(None).cast("double"),
                      lambda acc, a: F.coalesce(acc + a["mnt_beneficio_sin_impuesto_aprobado_sol"], a["mnt_beneficio_sin_impuesto_aprobado_sol"], acc))
    gross_of = lambda a: a["mnt_beneficio_sin_impuesto_aprobado_sol"] + a["mnt_impuesto_aprobado_sol"]
    gross = F.aggregate("atencion_salud", F.lit(None).cast("double"), lambda acc, a: F.coalesce(acc + gross_of(a), gross_of(a), acc))
    company = F.substring("id_siniestro_origen", 1, 1)
    df = (rows.withColumn("__net", net).withColumn("__gross", gross)
          .join(by_claim, F.col("id_siniestro") == F.col("__c1"), "left")
          .join(by_diagnosis, F.col("id_siniestro") == F.col("__c2"), "left"))
    grouped = df.groupBy(
        F.when(state.isin(lookups.SETTLED_STATES), "Liquidado").when(state.isin(lookups.RESERVED_STATES), "Reserva").otherwise("Rechazos").alias("tipo_base"),
        F.to_date("fec_notificacion").alias("fecha_recepcion"), F.to_date("fec_ult_liquidacion").alias("fec_liquidacion"),
        F.to_date("fec_hora_ocurrencia").alias("fec_ocurrencia"),
        F.when(company == "1", "EPS").when(company == "2", "ASISTENCIA MEDICA").alias("compania"), "num_siniestro",
        claim_invoice().alias("factura"), F.col("nom_completo_proveedor_siniestro").alias("proveedor"),
        F.col("nom_sede_proveedor_siniestro").alias("sede"), F.col("nom_completo_afiliado").alias("paciente"),
        F.when(state.isin("4", "8"), F.col("__first")).otherwise(F.col("__principal")).alias("des_cobertura"),
        F.col("des_estado_siniestro_origen").alias("desc_estado"), "nom_completo_contratante", "des_producto", "des_producto_agrupado",
        F.when(F.col("ind_trama_tedef") == "SI", "TRAMA").when(F.col("ind_trama_tedef") == "NO", "MANUAL").alias("tipo_ingreso"),
        "mto_auditado_sol", "mnt_pagar_base", "tip_caso_especial").agg(F.sum("__net").alias("net"), F.sum("__gross").alias("gross"))
    out = grouped.join(tray_rows(trays), "num_siniestro", "left")
    nonzero = lambda c: F.nullif(F.col(c), F.lit(0.0))
    return out.select(
        F.lit("Regular").alias("flujo"), "tipo_base", "bandeja", "motivo_notificado", "fecha_recepcion", "fec_liquidacion",
        "fec_ocurrencia", "compania", "num_siniestro", "factura", F.lit(f"RED {config.network}").alias("red"), "proveedor", "sede",
        "paciente", F.coalesce("des_cobertura", "DESC_BENEFICIO").alias("des_cobertura"), "desc_estado", "tipo_ingreso",
        "tip_caso_especial", "nom_completo_contratante", "des_producto", "des_producto_agrupado",
        F.coalesce(nonzero("gross"), F.col("mto_auditado_sol")).alias("imp_pagar"),
        F.coalesce(nonzero("net"), F.col("mnt_pagar_base")).alias("imp_pagar_base"),
        F.date_sub(config.today_column(), 1).alias("fec_actualizacion"))


def tray_rows(trays: DataFrame) -> DataFrame:
    """In-tray class and reason per claim number."""
    task = F.trim("TAREA")
    claim = F.col("NRO_SINIESTRO").cast("string")
    return trays.select(
        F.concat(F.substring(claim, 1, 2), F.lit("-"), F.substring(claim, 5, 12).try_cast("bigint").cast("string")).alias("num_siniestro"),
        F.when(task.isin(NOTIFIED_TASKS), "NOTIFICADOS")
        .when(task == "", F.when(F.trim("DESC_ESTADO") == "CALCULADO", F.trim("DESC_ESTADO")).otherwise(F.trim("TIPO_SINIESTRO")))
        .otherwise(task).alias("bandeja"),
        F.coalesce(F.trim("MOTIVO_NOTIFICADO"), F.trim("MOTIVO_REPROCESO")).alias("motivo_notificado"),
        F.trim("DESC_BENEFICIO").alias("DESC_BENEFICIO")).distinct()
