"""All documents and feed columns around one invoice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.dedup import top_per_key

NUMBER, RUC = "num_factura_documento_ocr", "ruc_proveedor_emisor_ocr"


def consolidate(invoices: DataFrame, authorisations: DataFrame, credit_notes: DataFrame, pre_settlements: DataFrame,
                settlements: DataFrame, letters: DataFrame, discharges: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Invoice with its other documents; credit notes and pre-settlements join on the number alone."""
    stars = [
        (authorisations.drop("page_path"), "num_factura_siteds_ocr", "ruc_emisor_path"),
        (credit_notes.drop("documento_id"), "num_factura_notacredito_ocr", None),
        (pre_settlements, "num_factura_preliqui_ocr", None),
        (settlements, "num_factura_liqui_ocr", "ruc_liqui_ocr"),
        (letters.drop("page_path", "documento_id"), "num_factura_cartagarantia_ocr", "ruc_cg_ocr"),
        (discharges, "num_factura_epicrisis_ocr", "ruc_epi_ocr"),
        (prescriptions, "num_factura_rc_ocr", "ruc_rc_ocr"),
    ]
    out = invoices.where(F.col(RUC).isNotNull())
    for table, number, ruc in stars:
        # helper columns that two documents share are named once, on the first
        table = table.drop(*[c for c in table.columns if c in out.columns])
        on = [F.col(NUMBER) == F.col(number)] + ([F.col(RUC) == F.col(ruc)] if ruc else [])
        out = out.join(table, reduce(lambda a, b: a & b, on), "left")
    return out.withColumn("flag_sinSiteds", F.when(F.col("num_factura_siteds_ocr").isNull(), 1).otherwise(0)).distinct()


def attach_feed(df: DataFrame, credit_feed: DataFrame, letter_feed: DataFrame, invoice_feed: DataFrame,
                attention_feed: DataFrame) -> DataFrame:
    """Feed columns and presence flags, then the invoice number without its dash."""
    credit = credit_feed.where(F.col("TIPONOTA") == "C").select(
        F.col("numero_de_documento_de_pago").alias("numero_de_documento_de_pago_trama"),
        F.col("MONTONOTA").alias("montoSub_nc_trama"), F.col("FECHANOTA").alias("fecha_nc_trama"), F.col("ruc_tramaNC").alias("__r1"))
    letter = letter_feed.select("num_factura_trama_carta", F.col("ruc_tramaCG").alias("__r2"))
    invoice = invoice_feed.select(F.col("numero_de_documento_de_pago").alias("__n3"), F.col("ruc_tramas").alias("__r3"),
                                  F.col("subtotal_tramas").alias("subtotal_fact_trama"),
                                  F.col("descripcion_tramas").alias("mecanismo_pago_fact_trama"))
    no_dots = lambda c: F.replace(F.col(c), F.lit("."), F.lit(""))
    attention = attention_feed.select(
        F.col("num_factura_trama_sited").alias("__n4"), F.col("RUCIPRESS").alias("__r4"),
        no_dots("CODIGOCIE101").alias("cod_cie101_trama_sited"), no_dots("CODIGOCIE102").alias("cod_cie102_trama_sited"),
        no_dots("CODIGOCIE103").alias("cod_cie103_trama_sited"), F.col("TIPOCOBERTURA").alias("__cov"))
    bare = F.col("__bare")
    out = df.withColumn("__bare", text.bare_number(F.col(NUMBER)))
    for table, number, ruc in ((credit, "numero_de_documento_de_pago_trama", "__r1"), (letter, "num_factura_trama_carta", "__r2"),
                               (invoice, "__n3", "__r3"), (attention, "__n4", "__r4")):
        out = out.join(table, (bare == F.col(number)) & (F.col(RUC) == F.col(ruc)), "left")
    presence = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0)
    out = out.withColumns({
        "flag_conNC_trama": presence("numero_de_documento_de_pago_trama"),
        "flag_montoFinal_NC_coicinde": F.when(F.col("importe_total_ocr_nc") == F.col("montoSub_nc_trama"), 1).otherwise(0),
        "dif_montoSubFact_montoSubNC_ocr": F.col("monto_sub_factura_ocr") - F.col("montoSub_nc_trama"),
        "flag_conCG_trama": presence("num_factura_trama_carta"),
        "cobertura_siteds_trama": text.coverage_from_code(F.col("__cov"), text.COVERAGE_CODES_CONSOLIDATION),
        "fecha_emision_siteds_ocr": F.to_date("fecha_emision_siteds_ocr"),
        NUMBER: bare, "num_factura_siteds_ocr": text.bare_number(F.col("num_factura_siteds_ocr")),
    })
    return out.drop("__bare", "__r1", "__r2", "__n3", "__r3", "__n4", "__r4", "__cov", "flag_ruc_invalido",
                    "flag_poliza_ocr_invalida", "flag_poliza_invalida", "flag_tipo_doc_valido", "flag_codigo_cmp_valido",
                    "flag_tipo_afiliacion_valido", "flag_doc_paciente_siteds_invalido").distinct()


def consolidate_cpm(settlements: DataFrame, sheets: DataFrame, consolidated: DataFrame) -> DataFrame:
    """CPM settlements with their authorisation sheets and the period of their invoice."""
    on = ((F.col("num_factura_liqui_ocr") == F.col("num_factura_siteds_ocr")) & (F.col("ruc_liqui_ocr") == F.col("ruc_emisor_path"))
          & (F.col("cod_autorizacion_liqui_ocr") == F.col("num_siteds_ocr_val")))
    joined = settlements.where(F.col("ruc_liqui_ocr").isNotNull()).join(sheets, on, "left")
    periods = consolidated.groupBy("num_factura_liqui_ocr", "ruc_liqui_ocr").agg(F.max("processed_date").alias("processed_date"))
    return (joined.join(periods, ["num_factura_liqui_ocr", "ruc_liqui_ocr"], "left")
            .withColumn("flag_sinSiteds", F.when(F.col("num_factura_siteds_ocr").isNull(), 1).otherwise(0)).distinct())


def is_eps_product(product: Column) -> Column:
    up = F.upper(product)
    hit = up.contains("EPS") | up.contains("PLANES") | up.contains("ASEGURAMIENTO") | up.contains("SCTR")
    return F.when(hit, 1).otherwise(0)


def earliest_authorised(consolidated: DataFrame, ties: list[str]) -> DataFrame:
    """One row per invoice: the earliest authorised."""
    return top_per_key(consolidated, [NUMBER], [F.asc_nulls_last("fecha_emision_siteds_ocr"), *[F.asc_nulls_last(c) for c in ties]])


CPM_FLAGS = {
    "flag_consultaAmboMed_liqui_ocr": F.max,
    "flag_montoTotal_NoCoincide_Fact_Liqui_ocr": F.min,
    "flag_fecIngreso_liqui_ocr_menor_fecAutoSiteds_ocr": F.max,
    "flag_fecIngreso_liqui_ocr_mayor15d_fecAutoSiteds_ocr": F.max,
    "flag_dniPaciente_Siteds_ocr_NoCoincide_Liqui_ocr": F.max,
    "flag_codAutorizacion_Siteds_ocr_NoCoincide_Liqui_ocr": F.max,
    "flag_deduciblePaciente_Siteds_ocr_NoCoincide_Liqui_ocr": F.max,
}


def cpm_flags(cpm: DataFrame, consolidated: DataFrame) -> DataFrame:
    """Flags of each CPM authorisation."""
    amounts = consolidated.select(F.col("num_factura_liqui_ocr").alias("__n"), F.col("ruc_proveedor_emisor_ocr").alias("__r"), "monto_factura_ocr")
    df = cpm.join(amounts, (F.col("num_factura_liqui_ocr") == F.col("__n")) & (F.col("ruc_liqui_ocr") == F.col("__r")), "left").drop("__n", "__r")
    present = F.col("num_factura_liqui_ocr").isNotNull()
    entry, authorised = F.to_date("fec_ingreso_liqui_ocr"), F.to_date("fecha_emision_siteds_ocr")
    flag = text.flag
    return df.withColumns({
        "flag_producto_eps_siteds_ocr": is_eps_product(F.col("producto_siteds_ocr")),
        "flag_montoTotal_NoCoincide_Fact_Liqui_ocr": flag((F.col("monto_total_liqui_ocr") - F.col("monto_factura_ocr") > 0.1) & present),
        "flag_fecIngreso_liqui_ocr_menor_fecAutoSiteds_ocr": flag((F.datediff(authorised, entry) > 7) & present),
        "flag_fecIngreso_liqui_ocr_mayor15d_fecAutoSiteds_ocr": flag((F.datediff(entry, authorised) > 14) & present),
        "flag_dniPaciente_Siteds_ocr_NoCoincide_Liqui_ocr":
            flag((F.col("num_documento_paciente_siteds_ocr_val") != F.col("num_documento_liqui_ocr")) & present),
        "flag_codAutorizacion_Siteds_ocr_NoCoincide_Liqui_ocr":
            flag((F.col("num_siteds_ocr_val") != F.col("cod_autorizacion_liqui_ocr")) & present),
        "flag_deduciblePaciente_Siteds_ocr_NoCoincide_Liqui_ocr":
            flag((F.col("copago_fijo_siteds_ocr") != F.col("deducible_liqui_ocr")) & present & (F.col("flag_consultaAmboMed_liqui_ocr") == 1)),
    })


def cpm_flags_per_invoice(flags: DataFrame) -> DataFrame:
    """One row per invoice: any authorisation flagged; the amount flag needs all of them."""
    return (flags.groupBy("num_factura_liqui_ocr", "ruc_liqui_ocr")
            .agg(*[f(c).alias(c) for c, f in CPM_FLAGS.items()]))
