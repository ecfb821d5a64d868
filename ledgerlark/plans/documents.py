"""From pages read off scanned documents to one clean row per invoice and document kind.

Every step is a projection or a keyed top-1, so each document kind is one plan with
one shuffle for the header, one for the dedup and one per feed it falls back to.
Column names are those of the audit tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, money, text
from ..operators import dedup
from ..operators.joins import attach_group
from ..operators.nested import any_nested, conform, dominant_value, first_element
from ..schemas import SETTLEMENT
from ..sources import lookups

NUMBER, RUC = "num_factura_documento_ocr", "ruc_emisor_path"
# --- fixed values -----------------------------------------------------------
COMPANY_ALIASES_INVOICE = {"VALLE SUR": "CLINICA VALLESUR SA"}
COMPANY_ALIASES_LETTER_EXACT = {"CLINICA DELGADO": "MEDIC SER SAC"}
COMPANY_ALIASES_LETTER = {"ONCOCENTER": "ONCOCENTER PERU SAC"}
# --- end of fixed values ----------------------------------------------------
PAGE_TIES = ["documento_id", "page_path"]


def source_pages(headers: DataFrame, pages: DataFrame, period: str | None, keep: str | None) -> DataFrame:
    """Pages of the period's uploads with invoice number, provider id and processing date."""
    named = headers.select(
        "id", "processed_date", "cutt_off_date",
        F.col("invoice_number").alias(NUMBER),
        F.regexp_substr("file_name", F.lit(r"^\d{11}")).alias(RUC))
    joined = dedup.latest_document(named, pages, NUMBER, ["processed_date", "cutt_off_date"], "processed_date",
                                   period, keep)
    return joined.drop("id", "cutt_off_date")


def with_feed(df: DataFrame, feed: DataFrame, number: str, ruc: str, **columns: str) -> DataFrame:
    """Left join to a feed view on (number without dash, provider); names the columns taken."""
    taken = feed.select(F.col(number).alias("__number"), F.col(ruc).alias("__ruc"),
                        *[F.col(c).alias(n) for n, c in columns.items()])
    on = (text.bare_number(F.col(NUMBER)) == F.col("__number")) & (F.col(RUC) == F.col("__ruc"))
    return df.join(taken, on, "left").drop("__number", "__ruc")


def invoices(headers: DataFrame, pages: DataFrame, attention_feed: DataFrame, invoice_feed: DataFrame,
             period: str | None) -> DataFrame:
    """One clean invoice per number ('factura breve')."""
    df = source_pages(headers, pages, period, "last").withColumn("ruc_clean", text.tax_id(F.col(RUC)))
    df = with_feed(df, attention_feed, "num_factura_trama_sited", "RUCIPRESS",
                   __aut="numero_del_documento_de_autorizacion", __dni="numero_del_documento_de_identidad")
    policy, dni = F.col("info_seguro.poliza"), F.col("paciente.dni")
    medicine = F.exists("items", lambda i: F.coalesce(F.upper(i["descripcion"]).contains("MEDICAMENTO"), F.lit(False)))
    df = df.select(
        "*",
        dates.spanish_date(F.col("cabecera.fecha_emision")).alias("__emitted"),
        text.invoice_numbers_match(F.col("cabecera.numero_factura"), F.col(NUMBER)).alias("__match"),
        F.when(F.size("items") > 0, F.when(medicine, 1).otherwise(0)).alias("__medicine"),
    )
    flags = df.groupBy(F.col(NUMBER).alias("__k")).agg(F.max("__medicine").alias("flag_medicamento_factura_ocr"))
    df = dedup.top_per_key(df, [NUMBER], [F.desc_nulls_last("__match"), F.desc_nulls_last("__emitted"),
                                          *[F.asc_nulls_last(c) for c in PAGE_TIES]])
    df = df.join(flags, F.col(NUMBER) == F.col("__k"), "left").drop("__k")
    df = with_feed(df, invoice_feed, "numero_de_documento_de_pago", "ruc_tramas", __sub="subtotal_tramas",
                   __total="importe_total_tramas", __date="fecha_emision_tramas")
    receiver = F.col("receptor.ruc")
    return df.select(
        "processed_date", NUMBER,
        text.identity_number(dni, F.col("__dni")).alias("dni_factura_ocr"),
        text.company_name(F.col("emisor.nombre"), containing=COMPANY_ALIASES_INVOICE).alias("razon_social_fact_limpia_ocr"),
        F.col("ruc_clean").alias("ruc_proveedor_emisor_ocr"),
        F.col("importe.tipo_moneda").alias("tipo_moneda_factura_ocr"),
        money.amount_with_fallback(F.col("totales.subtotal").cast("double"), F.col("__sub")).alias("monto_sub_factura_ocr"),
        money.amount_with_fallback(F.col("totales.importe_total").cast("double"), F.col("__total")).alias("monto_factura_ocr"),
        F.col("__total").alias("monto_factura_trama"),
        text.invoice_policy(policy).alias("poliza_factura_ocr"),
        text.tax_id_compact(receiver).alias("ruc_compania_factura_ocr"),
        F.when(receiver == lookups.INSURER_EPS, 1).when(receiver == lookups.INSURER_GENERAL, 2).otherwise(0)
        .alias("flag_compania_factura_ocr"),
        F.coalesce("__emitted", "__date").alias("fecha_emision_fact_limpio_val"),
        F.col("info_seguro.encuentro").alias("encuentro_factura_ocr"),
        text.authorisation_code(F.col("paciente.codigo_autorizacion"), F.col("__aut")).alias("cod_autorizacion_factura_ocr"),
        F.col("ruc_clean").isNull().alias("flag_ruc_invalido"),
        text.invoice_policy_invalid(policy).alias("flag_poliza_ocr_invalida"),
        text.identity_number_invalid(dni, F.col("__dni")).alias("flag_dni_invalido"),
        F.col("__match").alias("flag_fact_coincide"),
        "flag_medicamento_factura_ocr",
    )


def authorisation_sheets(headers: DataFrame, pages: DataFrame, attention_feed: DataFrame, invoice_feed: DataFrame,
                         period: str | None) -> DataFrame:
    """Authorisation sheet per invoice, with feed fallbacks."""
    df = source_pages(headers, pages, period, "last")
    # a sheet without diagnoses ranks before one with them, as it always did
    has_diagnosis = F.coalesce(F.size("diagnosticos"), F.lit(0)) > 0
    df = dedup.top_per_key(df, [NUMBER], [has_diagnosis.asc(), *[F.asc_nulls_last(c) for c in PAGE_TIES]])
    df = with_feed(df, attention_feed, "num_factura_trama_sited", "RUCIPRESS",
                   __aut="numero_del_documento_de_autorizacion", __dni="numero_del_documento_de_identidad",
                   fecha_de_prestacion="fecha_de_prestacion")
    df = with_feed(df, invoice_feed, "numero_de_documento_de_pago", "ruc_tramas", codigoproducto_trama="codigoproducto")
    # the coverage fallback looks at the number alone
    by_number = dedup.top_per_key(attention_feed.select("num_factura_trama_sited", "RUCIPRESS", "TIPOCOBERTURA"),
                                  ["num_factura_trama_sited"], [F.asc_nulls_last("RUCIPRESS")])
    df = df.join(by_number.select(F.col("num_factura_trama_sited").alias("__n"), F.col("TIPOCOBERTURA").alias("__cov")),
                 text.bare_number(F.col(NUMBER)) == F.col("__n"), "left").drop("__n")
    order_number, patient = F.col("cabecera.numero_orden"), F.col("paciente.num_documento")
    policy = F.col("paciente.num_poliza")
    licence, affiliation = F.col("visacion_medico.codigo_cmp"), F.col("titular.tipo_afiliacion")
    return df.select(
        "page_path", F.col(NUMBER).alias("num_factura_siteds_ocr"), RUC,
        text.coverage(F.col("beneficio_autorizado.nombre"), F.col("__cov")).alias("cobertura_siteds_ocr_limpia"),
        "codigoproducto_trama",
        text.product_family(F.col("codigoproducto_trama")).alias("producto_siteds_mod"),
        F.col("cabecera.producto").alias("producto_siteds_ocr"),
        money.percent_share(F.col("beneficio_autorizado.copago_variable")).alias("cobertura_copago_variable_siteds_ocr"),
        money.fixed_copay(F.col("beneficio_autorizado.copago_fijo")).alias("copago_fijo_siteds_ocr"),
        dates.mixed_timestamp(F.col("metadata.fecha_hora_autorizacion")).alias("fecha_emision_siteds_ocr"),
        F.col("titular.contratante").alias("razon_social_contratante_siteds_ocr"),
        text.diagnosis_code(first_element(F.col("diagnosticos"))["codigo"]).alias("cie10_siteds_ocr"),
        text.authorisation_policy(policy).alias("num_poliza_siteds_ocr"),
        text.document_type(F.col("paciente.tipo_documento")).alias("tipo_documento_limpio"),
        text.licence_code(licence).alias("codigo_cmp_limpio"),
        text.affiliation(affiliation).alias("tipo_afiliacion_ocr"),
        text.authorisation_policy_invalid(policy).alias("flag_poliza_invalida"),
        F.when(text.document_type(F.col("paciente.tipo_documento")).isNotNull(), 1).otherwise(0).alias("flag_tipo_doc_valido"),
        F.when(text.licence_code(licence).isNotNull(), 1).otherwise(0).alias("flag_codigo_cmp_valido"),
        F.when(text.affiliation(affiliation).isNotNull(), 1).otherwise(0).alias("flag_tipo_afiliacion_valido"),
        text.field_with_fallback(order_number, F.col("__aut")).alias("num_siteds_ocr_val"),
        text.field_with_fallback(patient, F.col("__dni")).alias("num_documento_paciente_siteds_ocr_val"),
        text.field_with_fallback_invalid(patient, F.col("__dni")).alias("flag_doc_paciente_siteds_invalido"),
        "fecha_de_prestacion",
    )


def unique_authorisations(sheets: DataFrame) -> DataFrame:
    """Earliest dated sheet per invoice."""
    return dedup.earliest_per_key(sheets, ["num_factura_siteds_ocr"], ["fecha_emision_siteds_ocr"], ["page_path"])


def cpm_authorisations(sheets: DataFrame, settlements: DataFrame) -> DataFrame:
    """Sheets of invoices whose settlement is paid by CPM."""
    cpm = settlements.where(F.col("mecanismo_liqui_ocr") == "CPM")
    on = (F.col("num_factura_siteds_ocr") == F.col("num_factura_liqui_ocr")) & (F.col(RUC) == F.col("ruc_liqui_ocr"))
    return sheets.join(cpm.select("num_factura_liqui_ocr", "ruc_liqui_ocr").distinct(), on, "left_semi")


def credit_notes(headers: DataFrame, pages: DataFrame, credit_feed: DataFrame, period: str | None) -> DataFrame:
    """One credit note per invoice: the one that refers to it, else one without reference.

    Uploads are not reduced to one per invoice here, unlike the other kinds.
    """
    df = source_pages(headers, pages, period, None).drop(RUC)
    df = df.select(
        "*", text.tax_id_exact(F.col("recuadro.ruc")).alias("ruc_clean"),
        F.col("recuadro.fecha").alias("fecha_nc_original"),
        dates.spanish_date(F.col("recuadro.fecha")).alias("fecha_nc_limpia"),
        F.col("resumen.subtotal").cast("double").alias("subtotal_ocr_nc"),
        F.col("resumen.importe_total").cast("double").alias("importe_total_ocr_nc"),
        text.reference_number(F.col("info_principal.ref_nro")).alias("num_factura_nc_ref_nro_ocr"),
    )
    df = df.select("*", *dates.date_parts(F.col("fecha_nc_limpia"), "nc_"))
    refers = F.col(NUMBER) == F.col("num_factura_nc_ref_nro_ocr")
    unreferenced = F.col("num_factura_nc_ref_nro_ocr").isNull()
    df = dedup.by_priority(df, [NUMBER], [refers, unreferenced], [F.asc_nulls_last(c) for c in PAGE_TIES])
    df = df.where(refers | unreferenced)
    credit = credit_feed.where(F.col("TIPONOTA") == "C")
    on = ((text.bare_number(F.col(NUMBER)) == credit.numero_de_documento_de_pago) & (F.col("ruc_clean") == credit.ruc_tramaNC))
    return (df.join(credit, on, "left")
            .select("documento_id", F.col(NUMBER).alias("num_factura_notacredito_ocr"), F.col("ruc_clean").alias("ruc_nc_ocr"),
                    "fecha_nc_original", "fecha_nc_limpia", "nc_unparsed", "nc_year", "nc_month", "nc_month_name",
                    "nc_weekday_name", "subtotal_ocr_nc", "importe_total_ocr_nc", "num_factura_nc_ref_nro_ocr",
                    F.col("MONTONOTA").alias("montonota_trama")))


def pre_settlements(headers: DataFrame, pages: DataFrame, period: str | None) -> DataFrame:
    """Smallest non-null total per invoice, from the oldest upload."""
    df = source_pages(headers, pages, period, "first")
    total = F.col("gastos_afectos.total_facturar")
    df = dedup.top_per_key(df, [NUMBER], [total.asc_nulls_last(), *[F.asc_nulls_last(c) for c in PAGE_TIES]])
    entry, leave = F.col("cabecera.fec_ingreso"), F.col("cabecera.fec_alta")
    return df.select(
        F.col(NUMBER).alias("num_factura_preliqui_ocr"), total.cast("double").alias("monto_total_preliqui_ocr"),
        dates.ddmmyyyy_hhmm(entry).alias("fec_ingreso_preliqui_ocr"), dates.ddmmyyyy_hhmm(leave).alias("fec_alta_preliqui_ocr"),
        dates.ddmmyyyy_hhmm_state(entry).alias("estado_fecha"), dates.ddmmyyyy_hhmm_state(leave).alias("estado_fecha_alta"),
        F.col(RUC).alias("ruc_preliqui_ocr"))


def settlement_layout(df: DataFrame, kind: str) -> DataFrame:
    """Any of the three settlement sheets in the common layout, tagged SUMMARY, T1 or T2."""
    columns = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for want in SETTLEMENT.fields:
        if want.name == "type":
            out.append(F.lit(kind).alias("type"))
        elif want.name not in columns:
            out.append(F.lit(None).cast(want.dataType).alias(want.name))
        elif want.name in ("cabecera", "calculo_cpm", "gastos_afectos", "gastos_inafectos"):
            out.append(conform(F.col(want.name), columns[want.name], want.dataType).alias(want.name))
        elif want.name == "subgrupos":
            have, element = columns["subgrupos"].elementType, want.dataType.elementType
            out.append(F.transform("subgrupos", lambda g: conform(g, have, element)).alias("subgrupos"))
        else:
            out.append(F.col(want.name).cast(want.dataType).alias(want.name))
    return df.select(*out)


def settlement_union(summaries: DataFrame, type_1: DataFrame, type_2: DataFrame) -> DataFrame:
    return (settlement_layout(summaries, "SUMMARY").unionByName(settlement_layout(type_1, "T1"))
            .unionByName(settlement_layout(type_2, "T2")))


def _settlement_rows(headers: DataFrame, pages: DataFrame, period: str | None) -> DataFrame:
    df = source_pages(headers, pages, period, "first")
    header = F.col("cabecera")
    consultation = any_nested(F.col("subgrupos"), "items", lambda i: F.upper(i["descripcion"]).rlike(r"^CONSULTA (MED|AMB)"))
    title = F.when(~header["titulo"].isin("null", "nul", "NULL", "NUL"), header["titulo"])
    number = header["num_autoriz"]
    df = df.select(
        "*",
        dates.ddmmyyyy_hhmm(header["fec_ingreso"]).alias("fec_ingreso_liqui_ocr"),
        dates.ddmmyyyy_hhmm_state(header["fec_ingreso"]).alias("estado_fecha"),
        dates.ddmmyyyy_hhmm(header["fec_alta"]).alias("fec_alta_liqui_ocr"),
        dates.ddmmyyyy_hhmm_state(header["fec_alta"]).alias("estado_fecha_alta"),
        F.coalesce(F.col("gastos_afectos.total_facturar"), F.col("calculo_cpm.total_facturar")).cast("double").alias("monto_total_liqui_ocr"),
        money.settlement_document(header["num_documento"]).alias("num_documento_liqui_ocr"),
        money.first_number(header["deducible"]).alias("deducible_liqui_ocr"),
        money.payment_mechanism(header["mecanismo"]).alias("mecanismo_liqui_ocr"),
        F.when(number.rlike(r"\d"), number).alias("cod_autorizacion_liqui_ocr"),
        money.coinsurance_percent(header["coaseguro"]).alias("pct_coaseguro_liqui_ocr"),
        F.when(consultation, 1).otherwise(0).alias("__consultation"),
        title.alias("__title"),
    )
    return attach_group(df, [NUMBER], flag_consultaAmboMed_liqui_ocr=F.max("__consultation"),
                        __sub3=F.max("gastos_afectos.subtotal_3"), total_por_factura=F.count(F.lit(1)),
                        con_titulo=F.count("__title"))


SETTLEMENT_COLUMNS = [
    "num_factura_liqui_ocr", "monto_total_liqui_ocr", "fec_ingreso_liqui_ocr", "fec_alta_liqui_ocr",
    "gastos_afectos_subtotal2_liqui_ocr", "gastos_afectos_subtotal3_liqui_ocr",
    "gastos_afectos_coaseguroPaciente_liqui_ocr", "pct_coaseguro_liqui_ocr", "deducible_liqui_ocr",
    "mecanismo_liqui_ocr", "flag_consultaAmboMed_liqui_ocr", "cod_autorizacion_liqui_ocr",
    "num_documento_liqui_ocr", "ruc_liqui_ocr",
]


def _settlement_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "num_factura_liqui_ocr": F.col(NUMBER), "ruc_liqui_ocr": F.col(RUC),
        "gastos_afectos_subtotal2_liqui_ocr": F.col("gastos_afectos.subtotal_2").cast("double"),
        "gastos_afectos_subtotal3_liqui_ocr": F.col("__sub3").cast("double"),
        "gastos_afectos_coaseguroPaciente_liqui_ocr": F.col("gastos_afectos.coaseguro_igv").cast("double"),
    }).select(*SETTLEMENT_COLUMNS)


def settlements(headers: DataFrame, pages: DataFrame, period: str | None) -> DataFrame:
    """One settlement per invoice: titled sheets first, then a sole sheet, then the largest total."""
    df = _settlement_rows(headers, pages, period)
    df = dedup.by_priority(df, [NUMBER], [F.col("__title").isNotNull(), F.col("total_por_factura") == 1],
                           [F.desc_nulls_last("monto_total_liqui_ocr"), *[F.asc_nulls_last(c) for c in PAGE_TIES]])
    return _settlement_columns(df)


def cpm_settlements(headers: DataFrame, pages: DataFrame, period: str | None) -> DataFrame:
    """CPM settlements unified per invoice, provider, authorisation and document."""
    df = _settlement_columns(_settlement_rows(headers, pages, period).where(F.col("mecanismo_liqui_ocr") == "CPM"))
    return unify_settlements(df)


SETTLEMENT_KEYS = ["num_factura_liqui_ocr", "ruc_liqui_ocr", "cod_autorizacion_liqui_ocr", "num_documento_liqui_ocr",
                   "mecanismo_liqui_ocr"]


def unify_settlements(df: DataFrame) -> DataFrame:
    measures = [c for c in SETTLEMENT_COLUMNS if c not in SETTLEMENT_KEYS]
    return df.groupBy(*SETTLEMENT_KEYS).agg(*[F.max(c).alias(c) for c in measures])


def guarantee_letters(headers: DataFrame, pages: DataFrame, equivalences: DataFrame, period: str | None) -> DataFrame:
    """One letter per invoice: the largest accumulated amount."""
    df = source_pages(headers, pages, period, "last")
    limits, header = F.col("limites_garantizados"), F.col("encabezado")
    df = df.select(
        "*", money.money_text(limits["monto_total"]).alias("monto_total_cg_clean"),
        money.money_text(limits["monto_acumulado"]).alias("monto_acumulado_cg_clean"))
    df = dedup.top_per_key(df, [NUMBER], [F.desc_nulls_last("monto_acumulado_cg_clean"), *[F.asc_nulls_last(c) for c in PAGE_TIES]])
    diagnosis = F.col("informe_medico.diagnostico")
    df = map_diagnosis(df, diagnosis, equivalences, "dx_entrada_transformada_cg_ocr")
    return df.select(
        "documento_id", "page_path", header["titulo"].alias("titulo"),
        text.tax_id(header["proveedor_ruc"]).alias("ruc_proveedor_cg_ocr"),
        text.tax_id(header["proveedor_ruc"]).isNull().alias("flag_ruc_cg_invalido"),
        text.company_name(header["proveedor_nombre"], COMPANY_ALIASES_LETTER_EXACT, COMPANY_ALIASES_LETTER)
        .alias("razon_social_proveedor_cg_limpia_ocr"),
        header["compania"].alias("compania"), header["nro_carta"].alias("nro_carta"),
        dates.digits_and_slashes_date(header["fec_emision"]).alias("fec_emision"),
        dates.digits_and_slashes_date(header["fec_val_sol"]).alias("fec_val_sol"),
        "monto_total_cg_clean", "monto_acumulado_cg_clean",
        money.letter_amount(F.col("monto_acumulado_cg_clean"), F.col("monto_total_cg_clean")).cast("double").alias("monto_final_cg"),
        "dx_entrada_transformada_cg_ocr", F.col(NUMBER).alias("num_factura_cartagarantia_ocr"), F.col(RUC).alias("ruc_cg_ocr"))


def map_diagnosis(df: DataFrame, diagnosis: Column, equivalences: DataFrame, name: str) -> DataFrame:
    """Equivalent diagnosis, or the original text."""
    keyed = df.withColumn("__dx", text.text_normal_form(diagnosis)).withColumn("__raw", diagnosis)
    equal = equivalences.withColumnsRenamed({"dx_norm": "__norm", "dx": "__equal"})
    joined = keyed.join(equal, F.col("__dx") == F.col("__norm"), "left")
    return joined.withColumn(name, F.coalesce("__equal", "__raw")).drop("__dx", "__raw", "__equal", "__norm")


def discharge_summaries(headers: DataFrame, pages: DataFrame, period: str | None) -> DataFrame:
    """One discharge summary per invoice with its dominant admission diagnosis."""
    df = source_pages(headers, pages, period, "last")
    usable = F.filter("info_ingreso.diagnosticos_ingreso", lambda d: (
        (text.trim_blanks(d["detalle"]) != "") & (text.trim_blanks(d["cie10"]) != "")
        & (F.upper(text.trim_blanks(d["cie10"])) != "STRING")))
    names = F.transform(usable, lambda d: text.text_normal_form(d["detalle"]))
    df = df.withColumn("dx_ingreso_epi_ocr", dominant_value(names))
    df = dedup.top_per_key(df, [NUMBER], [F.length("dx_ingreso_epi_ocr").desc_nulls_last(),
                                          *[F.asc_nulls_last(c) for c in PAGE_TIES]])
    df = df.where((F.col("encabezado.titulo") == "Epicrisis") & F.col("info_egreso.estadia").isNotNull())
    return df.select(
        F.col(NUMBER).alias("num_factura_epicrisis_ocr"), F.col(RUC).alias("ruc_epi_ocr"), "dx_ingreso_epi_ocr",
        dates.strict_ddmmyyyy(F.col("info_ingreso.fec_ingreso")).alias("fec_ingreso_epi_ocr"),
        dates.strict_ddmmyyyy(F.col("info_egreso.fec_egreso")).alias("fec_egreso_epi_ocr"),
        F.col("info_egreso.estadia").cast("double").alias("dias_hosp_epi_ocr"))


def prescriptions(headers: DataFrame, pages: DataFrame, period: str | None) -> DataFrame:
    df = source_pages(headers, pages, period, "last")
    return df.select(F.col(NUMBER).alias("num_factura_rc_ocr"), F.col(RUC).alias("ruc_rc_ocr")).distinct()
