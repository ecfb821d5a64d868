"""Duplicate payments: invoices against settled claims, eight rules in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..operators.dedup import top_per_key
from ..operators.waterfall import MatchRule, match_waterfall
from ..sources import lookups

# --- fixed values: messages ------------------------------------------------------
MESSAGES = {
    1: "SITED_regla1: Existe Factura pagada por el proveedor con la misma atención en Sited, paciente, monto y ocurrencia",
    2: "SITED_regla2: Existe Factura pagada por el proveedor con el mismo Sited y ocurrencia por PPS que debio facturarse en CPM",
    3: "FACTURA_regla3: Existe Factura pagada, proveedor utilizo la factura con el monto ",
    4: "ATENCION_regla4: Existe Factura pagada por el proveedor para la misma atención en CPM",
    5: "ATENCION_regla5: Existe Factura pagada por el proveedor con la misma atención en paciente, producto, cliente, cobertura, diagnóstico, monto y misma fecha de emisión del Sited",
    6: "ATENCION_OCR_regla6: Existe Factura pagada por el proveedor con la misma atención en paciente, producto, cliente,  diagnóstico, monto y misma fecha de la emisión del Sited",
    7: "ATENCION_OCR_regla7: Existe Factura pagada por el proveedor con la misma atención en paciente, producto, cliente,  diagnóstico, monto, carta de garantia y por aproximación en 5 días de la ocurrencia desde la emisión del Sited",
    8: "ATENCION_regla9: Factura con rechazo definito que no debe volver a ingresar",
}
AMOUNT_TOLERANCE = 50
NEAR_DAYS = 5
LETTER_YEAR = "25-"
PAID, PENDING = "PAG", ["OPT", "PGP"]
# --- end of fixed values -----------------------------------------------------------

# an interval of 101 units is met as at most 28 pieces: units at its ends, tens between
AMOUNT_BLOCK = 10
PAYLOAD = ["fec_ocurrencia", "fec_liquidacion", "est_cuenta_por_pagar", "id_estado_siniestro_origen",
           "des_estado_siniestro_origen", "num_siniestro", "factura", "imp_documento"]


def letter_number(letter: Column) -> Column:
    """'N12345-2' -> '25-12345'; null unless the text has exactly two parts."""
    parts = F.split(letter, "-")
    number = F.substr(F.get(parts, F.lit(0)), F.lit(2)).try_cast("bigint").cast("string")
    return F.when(F.size(parts) == 2, F.concat(F.lit(LETTER_YEAR), number))


def letter_version(letter: Column) -> Column:
    parts = F.split(letter, "-")
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(1)).try_cast("bigint"))


def prepare_invoices(consolidated: DataFrame, ties: list[str]) -> DataFrame:
    """One row per invoice number with the fields the rules compare."""
    top = top_per_key(consolidated, ["num_factura_documento_ocr"],
                      [F.asc_nulls_last("fecha_emision_siteds_ocr"), *[F.asc_nulls_last(c) for c in ties]])
    return top.select(
        F.concat("num_factura_documento_ocr", "ruc_proveedor_emisor_ocr").alias("id"), "num_factura_documento_ocr",
        F.coalesce("num_documento_paciente_siteds_ocr_val", "dni_factura_ocr").alias("dni_factura_ocr"),
        "ruc_proveedor_emisor_ocr", F.coalesce("cod_autorizacion_factura_ocr", "num_siteds_ocr_val").alias("num_siteds_ocr_val"),
        "fecha_emision_siteds_ocr", "num_poliza_siteds_ocr", "monto_factura_ocr", "cie10_siteds_ocr", "cod_cie101_trama_sited",
        F.to_date("processed_date").alias("processed_date"), "mecanismo_pago_fact_trama", "codigoproducto_trama",
        F.when(F.col("mecanismo_liqui_ocr") == "PPS", "01").when(F.col("mecanismo_liqui_ocr") == "CPM", "02").alias("mecanismo_liqui_ocr"),
        letter_number(F.col("nro_carta")).alias("numero_carta_garantia"), letter_version(F.col("nro_carta")).alias("version"),
        F.lit(None).cast("string").alias("cod_sede_proveedor_siniestro"), F.lit(None).cast("bigint").alias("cod_tipo_contrato"))


def prepare_provider_invoices(enriched: DataFrame, ties: list[str]) -> DataFrame:
    """The same fields from the feed-only universe of the other providers."""
    top = top_per_key(enriched, ["num_factura_documento_ocr"],
                      [F.asc_nulls_last("fecha_emision_siteds_ocr"), *[F.asc_nulls_last(c) for c in ties]])
    letter = F.col("num_carta_garantia").cast("string")
    return top.select(
        F.concat("num_factura_documento_ocr", "ruc_proveedor_emisor_ocr").alias("id"), "num_factura_documento_ocr",
        F.coalesce("num_documento_paciente_siteds_ocr_val", "dni_factura_ocr").alias("dni_factura_ocr"),
        "ruc_proveedor_emisor_ocr", "num_siteds_ocr_val", "fecha_emision_siteds_ocr", "num_poliza_siteds_ocr", "monto_factura_ocr",
        "cie10_siteds_ocr", F.col("cie10_siteds_ocr").alias("cod_cie101_trama_sited"), F.to_date("processed_date").alias("processed_date"),
        F.col("mecanismo_liqui_ocr").alias("mecanismo_pago_fact_trama"), "codigoproducto_trama", "mecanismo_liqui_ocr",
        letter_number(letter).alias("numero_carta_garantia"), letter_version(letter).alias("version"),
        "cod_sede_proveedor_siniestro", "cod_tipo_contrato")


def with_authorisation(invoices: DataFrame, authorisations: DataFrame) -> DataFrame:
    """Invoice fields next to those of its registered authorisation (none for many invoices)."""
    registered = authorisations.select(
        "cod_autorizacion", "cod_producto_ax", "cod_proveedor_rs", "cod_sede_proveedor", "cod_contratante_origen_sistema",
        F.replace("id_persona_afiliado", F.lit("AX-"), F.lit("")).alias("id_persona_afiliado"), "cod_cobertura",
        F.to_date("fec_autorizacion").alias("fec_autorizacion_rs")).distinct()
    return invoices.join(registered, F.col("num_siteds_ocr_val") == F.col("cod_autorizacion"), "left")


def rules(by_site: bool = False) -> list[MatchRule]:
    """The eight rules; ``by_site`` adds site and contract type for the other providers.

    Invoice side: columns of with_authorisation.  Claim side: columns of claim_entries.
    """
    c, claim = F.col, lambda name: F.col(f"c_{name}")
    amount, claim_amount = money.truncate(c("monto_factura_ocr")), money.truncate(claim("imp_documento"))
    day, claim_day = c("fec_autorizacion_rs"), c("fec_ocurrencia")
    settled = claim("estado").isin(lookups.SETTLED_STATES)
    registered = c("cod_autorizacion").isNotNull()
    provider, member = c("cod_proveedor_rs"), c("id_persona_afiliado")
    claim_provider, claim_member = claim("id_persona_proveedor_siniestro"), claim("id_persona_afiliado")
    site = (c("cod_sede_proveedor"),) if by_site else ()
    claim_site = (claim("cod_sede_proveedor_siniestro"),) if by_site else ()
    contract = (c("cod_tipo_contrato"),) if by_site else ()
    claim_contract = (claim("cod_tipo_contrato"),) if by_site else ()
    attention = (provider, member, c("cod_contratante_origen_sistema"), c("cod_producto_ax"), c("cod_cobertura"),
                 c("cod_cie101_trama_sited"), amount)
    claim_attention = (claim_provider, claim_member, claim("id_contratante"), claim("id_producto"), claim("id_cobertura_origen"),
                       claim("num_diagnostico_origen"), claim_amount)
    scanned = (c("ruc_proveedor_emisor_ocr"), c("dni_factura_ocr"), c("num_poliza_siteds_ocr"), c("codigoproducto_trama"),
               c("cie10_siteds_ocr"), amount)
    claim_scanned = (claim("num_documento_proveedor_siniestro"), claim("num_documento_afiliado"), claim("num_poliza"),
                     claim("cod_producto"), claim("num_diagnostico_origen"), claim_amount)
    number_of = lambda date: F.unix_date(date)
    near_days = (number_of(F.date_sub(F.to_date("fecha_emision_siteds_ocr"), NEAR_DAYS)), number_of(F.date_add(day, NEAR_DAYS)),
                 number_of(claim_day))
    near_amounts = (amount - AMOUNT_TOLERANCE, amount + AMOUNT_TOLERANCE, claim_amount)
    cpm, claim_cpm = c("mecanismo_pago_fact_trama") == "02", claim("cod_mecanismo_pago") == "02"
    refunded = (claim("estado") == lookups.REFUNDED_STATE) & (claim("ind_devoluc") == "Rechazo_Definitivo")
    return [
        MatchRule(1, MESSAGES[1], (c("cod_autorizacion"), provider, member, amount, day, *site),
                  (claim("id_autorizacion"), claim_provider, claim_member, claim_amount, claim_day, *claim_site),
                  registered, settled),
        MatchRule(2, MESSAGES[2], (c("cod_autorizacion"), c("cie10_siteds_ocr"), day),
                  (claim("id_autorizacion"), claim("num_diagnostico_origen"), claim_day),
                  registered & cpm, settled & (claim("cod_mecanismo_pago") == "01"), between=near_amounts, widths=(1, AMOUNT_BLOCK)),
        MatchRule(3, MESSAGES[3], (c("num_factura_documento_ocr"), c("ruc_proveedor_emisor_ocr")),
                  (c("factura"), claim("num_documento_proveedor_siniestro")), None, settled),
        MatchRule(4, MESSAGES[4], (provider, member, c("cod_contratante_origen_sistema"), F.trunc(day, "MM"), *site, *contract),
                  (claim_provider, claim_member, claim("id_contratante"), F.trunc(claim_day, "MM"), *claim_site, *claim_contract),
                  registered & cpm, settled & claim_cpm),
        MatchRule(5, MESSAGES[5], (*attention, day), (*claim_attention, claim_day), registered, settled, unique=True),
        MatchRule(6, MESSAGES[6], (*scanned, day), (*claim_scanned, claim_day), None, settled, unique=True),
        MatchRule(7, MESSAGES[7], (*scanned, c("numero_carta_garantia")), (*claim_scanned, claim("carta_garantia")),
                  None, settled, between=near_days),
        MatchRule(8, MESSAGES[8], attention, claim_attention, None, refunded, dated=False, between=near_days),
    ]


def claim_entries(processed: DataFrame) -> DataFrame:
    """Processed claims with the payload of a match and the columns the rules compare (c_*)."""
    compared = ["id_persona_proveedor_siniestro", "id_persona_afiliado", "id_contratante", "id_producto", "id_cobertura_origen",
                "num_diagnostico_origen", "id_autorizacion", "cod_mecanismo_pago", "num_documento_proveedor_siniestro", "imp_documento",
                "num_documento_afiliado", "num_poliza", "cod_producto", "carta_garantia", "cod_sede_proveedor_siniestro", "cod_tipo_contrato",
                "ind_devoluc"]
    return processed.select(
        F.to_date("fec_hora_ocurrencia").alias("fec_ocurrencia"), F.to_date("fec_ult_liquidacion").alias("fec_liquidacion"),
        "est_cuenta_por_pagar", "id_estado_siniestro_origen", "des_estado_siniestro_origen", "num_siniestro", "factura", "imp_documento",
        F.col("id_estado_siniestro_origen").alias("c_estado"),
        *[F.col(x).alias(f"c_{x}") for x in compared if x != "imp_documento"], F.col("imp_documento").alias("c_imp_documento"))


def matched(invoices: DataFrame, authorisations: DataFrame, processed: DataFrame, by_site: bool = False) -> DataFrame:
    """Winning rule per invoice: id, rule, n_matches, best, best_other."""
    return match_waterfall(
        with_authorisation(invoices, authorisations), claim_entries(processed), rules(by_site), id="id",
        own="num_factura_documento_ocr", as_of=F.col("processed_date"), since=F.col("fec_liquidacion"), other="factura",
        payload=PAYLOAD, newest=["fec_ocurrencia"])


def duplicate_payments(invoices: DataFrame, matches: DataFrame) -> DataFrame:
    """Duplicate of another invoice (rules 1 to 7) or re-entry of a refunded one (rule 8), newest match per invoice.

    Rule 3 finds the invoice's own number, so it never names a duplicate; it only keeps
    later rules from looking.
    """
    one = matches.join(invoices.select("id", "num_factura_documento_ocr"), "id")
    refund = F.col("rule") == 8
    found = one.withColumn("m", F.when(refund, F.col("best")).otherwise(F.col("best_other")))
    found = found.where(F.col("m").isNotNull() & (F.col("rule") != 3))
    paid = F.col("m.est_cuenta_por_pagar")
    message = F.element_at(F.create_map(*[F.lit(x) for p in MESSAGES.items() for x in p]), F.col("rule"))
    return found.select(
        "id", "num_factura_documento_ocr", "rule", "n_matches",
        F.when(refund, 0).otherwise(1).alias("flag_dup"), F.lit(0).alias("flag_observada"), F.when(refund, 1).otherwise(0).alias("flag_devolucion"),
        F.col("m.fec_ocurrencia").alias("fec_atencion"), F.col("m.fec_liquidacion").alias("fec_liquidacion"),
        F.col("m.num_siniestro").alias("num_siniestro"), F.col("m.factura").alias("factura_duplicada"),
        F.col("m.imp_documento").alias("monto_duplicado"), F.col("m.des_estado_siniestro_origen").alias("estado_procesado"),
        message.alias("dsc_dup"), paid.alias("sts_abono"),
        F.when(~refund & (paid == PAID), 1).otherwise(0).alias("flag_abono"),
        F.when(refund, "").when(paid == PAID, "Pagado").when(paid.isin(PENDING), "Pendiente Pago").alias("dsc_abono"))


def rule_results(matches: DataFrame) -> DataFrame:
    """State of every matched invoice before duplicates are named; rule 3 flags only on an equal date."""
    best = F.col("best")
    flags = F.when((F.col("rule") == 3) & (best["fec_liquidacion"] != F.col("processed_date")), 0).when(F.col("rule") == 8, 0).otherwise(1)
    text = F.concat(F.lit(MESSAGES[3]), money.number_text(best["imp_documento"]))
    message = F.element_at(F.create_map(*[F.lit(x) for p in MESSAGES.items() for x in p]), F.col("rule"))
    return matches.withColumns({
        "flag_dup": flags,
        "dsc_dup": F.when(F.col("rule") == 3, F.when(flags == 1, text)).otherwise(message),
    })


def attach_duplicates(enriched: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Duplicate columns on every row of the invoice number."""
    found = duplicates.select(
        F.col("num_factura_documento_ocr").alias("__n"), "flag_dup", "factura_duplicada", "fec_atencion",
        F.col("num_siniestro").alias("num_siniestro_factDup"), "dsc_dup", "dsc_abono", "estado_procesado", "monto_duplicado").distinct()
    return enriched.join(found, F.col("num_factura_documento_ocr") == F.col("__n"), "left").drop("__n")
