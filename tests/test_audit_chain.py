"""Documents to alerts to summary on a handful of invented invoices."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.plans import claims, consolidation, documents, duplicates, enrichment, provider_feed, reports
from ledgerlark.plans.config import AuditConfig
from ledgerlark.session import cut_lineage
from ledgerlark.sources import feed, lookups

PERIOD, RUC = "2025-06-10", "20501781291"
CONFIG = AuditConfig(network="CENTRAL", insurer="Seguros", period=PERIOD, today=dt.date(2025, 6, 11))
MONTH = dt.date(2025, 6, 1)


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def bare(number):
    return number.replace("-", "")


class Case:
    """Tables of one audited invoice; keyword changes mutate single fields."""

    def __init__(self, number="F135-00000001", **change):
        c = dict(total=100.0, feed_total="100.00", settlement_total=100.0, authorised="05/06/2025 09:00:00", emitted="Viernes, 6 de Junía del 2025 10:30", order="1234567890",
                 settlement_order="1234567890", mechanism="PAGO POR SERVICIOS", claim_mechanism="01", feed_mechanism="01", coverage="Ambulatoria", coinsurance="10%", copay="CUBIERTO AL 90%",
                 entry="05/06/2025 10:00", leave="05/06/2025 12:00", pre_leave="05/06/2025 12:00", credit_feed=False, credit=False, letter=False, letter_feed=False, discharge=False, sheet=True, dni="44556677",
                 receiver=lookups.INSURER_EPS, product="EPS PLAN", insured="Empresa X", claim_dni="44556677", valid_to=dt.date(2025, 12, 31), items=None, prescription=False)
        c.update(change)
        self.number, self.c = number, c

    def build(self, spark):
        c, n, doc = self.c, self.number, "doc-" + self.number
        page = dict(documento_id=doc, page_path="p1")
        only = lambda flag, rows: rows if flag else []
        headers = frame(spark, schemas.DOCUMENT_HEADER, [
            dict(id=doc, invoice_number=n, file_name=f"{RUC}_01_{n}.pdf", file_path="x", processed_date=PERIOD, cutt_off_date="10", batch_name="L1"),
            dict(id="older", invoice_number=n, file_name=f"{RUC}_01_{n}.pdf", file_path="x", processed_date="2025-06-09", cutt_off_date="16", batch_name="L0")])
        invoice_pages = frame(spark, schemas.INVOICE, [dict(
            page, emisor=dict(nombre="CLINICA X S.A."), receptor=dict(ruc=c["receiver"]), paciente=dict(dni=c["dni"], codigo_autorizacion=c["order"]),
            cabecera=dict(numero_factura=bare(n), fecha_emision=c["emitted"]), info_seguro=dict(poliza="12345"),
            items=[dict(descripcion=d) for d in (c["items"] or ["CONSULTA"])], totales=dict(subtotal=_dec(c["total"]), importe_total=_dec(c["total"])), importe=dict(tipo_moneda="soles"))])
        sheets = frame(spark, schemas.AUTHORISATION, only(c["sheet"], [dict(
            page, cabecera=dict(numero_orden=c["order"], producto=c["product"]), paciente=dict(num_documento=c["dni"], num_poliza="12345", tipo_documento="DNI"),
            titular=dict(tipo_afiliacion="1 REGULAR", contratante=c["insured"]), metadata=dict(fecha_hora_autorizacion=c["authorised"]),
            beneficio_autorizado=dict(nombre=c["coverage"], copago_fijo="35.00 SOLES", copago_variable=c["copay"]), diagnosticos=[dict(codigo="J06.9")], visacion_medico=dict(codigo_cmp="CMP 123"))]))
        credit_pages = frame(spark, schemas.CREDIT_NOTE, only(c["credit"], [dict(
            page, recuadro=dict(ruc=RUC, fecha="06/06/2025"), info_principal=dict(ref_nro=n), resumen=dict(subtotal=_dec(10), importe_total=_dec(12)))]))
        pre_pages = frame(spark, schemas.PRE_SETTLEMENT, [dict(page, cabecera=dict(fec_ingreso=c["entry"], fec_alta=c["pre_leave"]), gastos_afectos=dict(total_facturar=_dec(c["total"])))])
        settlement_2 = frame(spark, schemas.SETTLEMENT_TYPE_2, [dict(
            page, cabecera=dict(titulo="LIQ", num_autoriz=c["settlement_order"], mecanismo=c["mechanism"], fec_ingreso=c["entry"], fec_alta=c["leave"], coaseguro=c["coinsurance"], deducible="35.0", num_documento=c["dni"]),
            subgrupos=[dict(categoria="A", items=[dict(descripcion="CONSULTA MEDICA")])], gastos_afectos=dict(total_facturar=_dec(c["settlement_total"]), subtotal_3=_dec(c["total"]), subtotal_2=_dec(90)))])
        empty = lambda schema: frame(spark, schema, [])
        settlement_pages = documents.settlement_union(empty(schemas.SETTLEMENT_SUMMARY), empty(schemas.SETTLEMENT_TYPE_1), settlement_2)
        letter_pages = frame(spark, schemas.guarantee_letter(), only(c["letter"], [dict(
            page, encabezado=dict(proveedor_ruc=RUC, proveedor_nombre="CLINICA X SA", nro_carta="N77-1", fec_emision="01/06/2025", fec_val_sol="30/06/2025"),
            informe_medico=dict(diagnostico="Colecistitis aguda"), limites_garantizados=dict(monto_total="S/. 10,000.00"))]))
        discharge_pages = frame(spark, schemas.DISCHARGE_SUMMARY, only(c["discharge"], [dict(
            page, encabezado=dict(titulo="Epicrisis"), info_ingreso=dict(fec_ingreso="05/06/2025", diagnosticos_ingreso=[dict(cie10="K81", detalle="colecistitis  aguda")]),
            info_egreso=dict(fec_egreso="09/06/2025", estadia=_dec(2)))]))
        recipes = frame(spark, schemas.PRESCRIPTION, only(c["prescription"], [page]))
        document = dict(RUCIPRESS=RUC, NUMERODOCUMENTOPAGO=bare(n), CODIGOLOTE="1", FECHAEMISION="20250606", CODIGOPRODUCTO="S", TIPOMONEDA="1", MONTOTOTAL=c["feed_total"], MONTOIGV="0",
                        MONTONETO="100.00", CODIGOMECANISMOPAGO=c["feed_mechanism"], TIPONOTA="C" if c["credit_feed"] else "N", MONTONOTA="10", FECHANOTA="20250606")
        attention = dict(RUCIPRESS=RUC, NUMERODOCUMENTOPAGO=bare(n), CODIGOLOTE="1", NUMEROAUTORIZACION=c["order"], NUMERODOCUMENTOIDENTIDAD=c["dni"], FECHAINICIOATENCION="20250605", TIPOCOBERTURA="4",
                         TIPODOCUMENTOPRESTACION="3" if c["letter_feed"] else "1", CODIGOCIE101="J06.9")
        self.documents, self.attentions = frame(spark, schemas.FEED_DOCUMENT, [document]), frame(spark, schemas.FEED_ATTENTION, [attention])
        claim = dict(
            periodo=MONTH, id_siniestro="RS-1-1", id_siniestro_origen="1x", num_siniestro="S1", id_autorizacion="RS-" + c["order"], id_poliza="P-1", cod_serie_comprobante_siniestro=bare(n)[:4],
            num_comprobante_siniestro=bare(n)[4:], num_documento_proveedor_siniestro=RUC, num_documento_afiliado=c["claim_dni"], id_persona_afiliado="M1", tip_reclamo="C", id_estado_siniestro_origen="D",
            cod_mecanismo_pago=c["claim_mechanism"], nom_sede_proveedor_siniestro="SEDE", des_producto_agrupado="EPS PLAN", mto_auditado_sol=c["total"], fec_notificacion=dt.datetime(2025, 6, 7),
            atencion_salud=[dict(num_correlativo_atencion=1, id_cobertura_origen="P09", des_cobertura="AMB", mnt_beneficio_sin_impuesto_aprobado_sol=80.0, mnt_impuesto_aprobado_sol=20.0)])
        self.claims = frame(spark, schemas.CLAIM, [claim])
        self.headers = headers
        att, inv = feed.attention_feed(self.attentions), feed.invoice_feed(self.documents)
        clean = documents.authorisation_sheets(headers, sheets, att, inv, PERIOD)
        settled = documents.settlements(headers, settlement_pages, PERIOD)
        star = consolidation.consolidate(
            documents.invoices(headers, invoice_pages, att, inv, PERIOD), documents.unique_authorisations(clean),
            documents.credit_notes(headers, credit_pages, feed.credit_note_feed(self.documents), PERIOD), documents.pre_settlements(headers, pre_pages, PERIOD), settled,
            documents.guarantee_letters(headers, letter_pages, lookups.diagnosis_equivalences(spark), PERIOD), documents.discharge_summaries(headers, discharge_pages, PERIOD),
            documents.prescriptions(headers, recipes, PERIOD))
        self.cpm_sheets, self.settled = documents.cpm_authorisations(clean, settled), settled
        self.cpm_settlements = documents.cpm_settlements(headers, settlement_pages, PERIOD)
        return consolidation.attach_feed(star, feed.credit_note_feed(self.documents), feed.letter_feed(self.attentions), inv, att)

    def enriched(self, spark):
        consolidated = cut_lineage(self.build(spark))  # the warehouse writes this table
        people = frame(spark, "cuc string, periodo date, des_riesgo string, id_estado_poliza string, id_estado_certificado string, des_agrupacion_n1 string",
                       [("DN" + self.c["dni"], MONTH, "SALUD", "ACT", "ACT", "PLANES MEDICOS")])
        units = frame(spark, "id_origen string, id_persona string, id_unidad_asegurable string, id_certificado string, fec_inicio_vigencia date, fec_fin_vigencia date, des_estado_origen_unidad_asegurable string",
                      [("RS", "M1", "P-1-9-8", "c", dt.date(2025, 1, 1), self.c["valid_to"], "VIGENTE")])
        requests = frame(spark, "periodo date, num_carta_garantia bigint, num_documento_proveedor string, des_est_carta_garantia_origen string", [])
        auths = frame(spark, AUTHORISATIONS, [])
        processed = claims.processed_claims(self.claims, auths, frame(spark, "cod_producto_ax string, cod_producto string", []),
                                            frame(spark, "id_siniestro string, anio_carta_garantia bigint, num_carta_garantia bigint", []),
                                            frame(spark, "id_maestro_cuenta_por_pagar string, cod_est_pago string", []), CONFIG)
        prepared = cut_lineage(duplicates.prepare_invoices(consolidated, ["monto_factura_ocr"]))
        found = cut_lineage(duplicates.duplicate_payments(prepared, duplicates.matched(prepared, auths, cut_lineage(processed))))
        return enrichment.enrich(consolidated, claims.historical_claims(self.claims, CONFIG), claims.active_policies(people), claims.claim_attentions(self.claims, CONFIG),
                                 claims.letter_states(requests, CONFIG), claims.policy_validity(units), lookups.thresholds(spark), found, lookups.self_insured(spark), CONFIG)

    def alerts(self, spark):
        return cut_lineage(enrichment.alerts(cut_lineage(self.enriched(spark)), CONFIG))


AUTHORISATIONS = ("id_autorizacion string, cod_autorizacion string, fec_autorizacion timestamp_ntz, periodo_autorizacion date, cod_producto_ax string, cod_proveedor_rs string, num_doc_proveedor string, "
                  "cod_sede_proveedor string, cod_contratante_origen_sistema string, id_persona_afiliado string, cod_cobertura string, des_cobertura string, des_producto string")


def _dec(value):
    from decimal import Decimal
    return Decimal(str(value))


def test_clean_invoice_fires_nothing(spark):
    case = Case()
    row = case.build(spark).first()
    assert row["num_factura_documento_ocr"] == "F13500000001"
    assert row["fecha_emision_fact_limpio_val"] == dt.date(2025, 6, 6)
    assert row["fecha_emision_siteds_ocr"] == dt.date(2025, 6, 5)
    assert (row["cie10_siteds_ocr"], row["cod_cie101_trama_sited"]) == ("J069", "J069")
    assert row["cobertura_siteds_ocr_limpia"] == "AMBULATORIO" and row["producto_siteds_mod"] == "EPS"
    assert row["mecanismo_liqui_ocr"] == "PPS" and row["flag_consultaAmboMed_liqui_ocr"] == 1
    alerts = Case().alerts(spark).collect()
    assert [(a["reglas_mensaje"], a["estado"]) for a in alerts] == [("Factura OK", "OK")]


MANY = dict(
    total=5000.0, feed_total="5100.00", settlement_total=5001.0, receiver=lookups.INSURER_GENERAL, credit=True, leave="04/06/2025 12:00", settlement_order="99", copay="CUBIERTO AL 10%",
    claim_mechanism="02", feed_mechanism="02", letter=True, discharge=True, items=["MEDICAMENTOS VARIOS"], valid_to=dt.date(2025, 6, 1), authorised="08/06/2025 09:00:00")
EXPECTED = {
    "Deteccion de Monto Atipico: El monto facturado es mucho mayor al monto historico promedio (S/. 4175.59) registrado para la cobertura (AMBULATORIO) en clínica (SEDE)",
    "RUC Seguros en Factura no coincide con producto usado en SITEDS",
    "Sin Nota Credito en la trama pero si en el sustento",
    "La fecha de ingreso es posterior a la fecha de alta en la hoja Liquidacion",
    "El monto total de la Factura no coincide con el de Liquidacion",
    "El codigo de autorizacion de la hoja siteds no coincide con el de Liquidacion",
    "El % cubierto del copago variable del SITEDS no coincide con el % de coaseguro del paciente en Liquidacion",
    "El mecanismo de pago de Liquidacion no coincide con RS",
    "El mecanismo de pago de liquidación del sustento no coincide con el de la trama",
    "Sin Carta Garantia en la trama pero si en el sustento",
    "Fechas de hospitalizacion y los dias de estadia no coincide en el sustento de Epicrisis",
    "Fecha de ingreso en epicrisis menor a la fecha de siteds en el sustento",
    "Ambulatorio con medicamento sin receta medica en el sustento",
    "Fecha de autorizacion siteds posterior a fecha de facturacion en el sustento",
    "El monto total de la factura no coincide con el de la trama",
    "El monto subtotal de liquidación del sustento no coincide con el de la trama",
    "Afiliado no vigente en RS durante la fecha de atencion en siteds",
    "Afiliado no vigente en RS entre las fechas de la carta de garantia",
}


@pytest.fixture(scope="module")
def observed(spark):
    case = Case(**MANY)
    return case, case.alerts(spark)


def test_mutations_fire_their_rules_and_nothing_else(observed):
    assert {a["reglas_mensaje"] for a in observed[1].collect()} == EXPECTED


def test_cpm_chain(spark):
    case = Case(mechanism="CPM")
    consolidated = cut_lineage(case.build(spark))
    cpm = consolidation.consolidate_cpm(case.cpm_settlements, case.cpm_sheets, consolidated)
    row = consolidation.cpm_flags_per_invoice(consolidation.cpm_flags(cpm, consolidated)).first()
    assert row["flag_codAutorizacion_Siteds_ocr_NoCoincide_Liqui_ocr"] == 0
    assert row["flag_montoTotal_NoCoincide_Fact_Liqui_ocr"] == 0


def test_duplicate_of_another_invoice(spark):
    case = Case()
    consolidated = cut_lineage(case.build(spark))
    day = dt.datetime(2025, 6, 5, 8)
    auths = frame(spark, AUTHORISATIONS, [dict(id_autorizacion="RS-1234567890", cod_autorizacion="1234567890", fec_autorizacion=day, cod_producto_ax="Q", cod_proveedor_rs="V", cod_contratante_origen_sistema="K",
                                              id_persona_afiliado="AX-M1", cod_cobertura="P09")])
    paid = dict(periodo=MONTH, id_siniestro="RS-1-2", id_siniestro_origen="1x", num_siniestro="S2", id_autorizacion="RS-1234567890", cod_serie_comprobante_siniestro="F999", num_comprobante_siniestro="5",
                num_documento_proveedor_siniestro=RUC, id_persona_afiliado="AX-M1", id_persona_proveedor_siniestro="AX-V", tip_reclamo="C", id_estado_siniestro_origen="4", mto_auditado_sol=100.4,
                fec_hora_ocurrencia=day, fec_ult_liquidacion=dt.datetime(2025, 6, 8), num_obligacion="1-2", atencion_salud=[dict(num_correlativo_atencion=1)])
    processed = claims.processed_claims(frame(spark, schemas.CLAIM, [paid]), auths, frame(spark, "cod_producto_ax string, cod_producto string", []),
                                        frame(spark, "id_siniestro string, anio_carta_garantia bigint, num_carta_garantia bigint", []),
                                        frame(spark, "id_maestro_cuenta_por_pagar string, cod_est_pago string", [("1-2-x", "PAG")]), CONFIG)
    prepared = duplicates.prepare_invoices(consolidated, ["monto_factura_ocr"])
    row = duplicates.duplicate_payments(prepared, duplicates.matched(prepared, auths, processed)).first()
    assert (row["rule"], row["flag_dup"], row["factura_duplicada"], row["dsc_abono"]) == (1, 1, "F99900000005", "Pagado")


def test_reports_from_alerts(spark, observed):
    case, alerts = observed
    trays = frame(spark, "NRO_SINIESTRO string, TAREA string, DESC_ESTADO string, TIPO_SINIESTRO string, MOTIVO_NOTIFICADO string, MOTIVO_REPROCESO string, DESC_BENEFICIO string", [])
    snapshot = claims.official_snapshot(case.claims, trays, CONFIG)
    assert cut_lineage(snapshot).first()["imp_pagar"] == 100.0
    rows = reports.report_rows(reports.delivery(alerts, snapshot, case.headers, PERIOD), "monto_factura_trama", F.lit(dt.datetime(2025, 6, 11)))
    report = cut_lineage(reports.full_report(cut_lineage(rows), rows.limit(0), CONFIG))
    summary = reports.daily_summary(report, PERIOD, CONFIG).first()
    assert (summary["ctdFacturas"], summary["ctdFactObservadas"], summary["red"]) == (1, 1, "RED CENTRAL")
    figures = reports.message_figures(reports.daily_summary(report, PERIOD, CONFIG), reports.daily_summary(report, PERIOD, CONFIG)).first()
    assert figures["invoice_amount"] == "0.01 MM" and figures["invoice_number_obs_percentage"] == 100.0


def test_provider_list(spark):
    case = Case()
    case.build(spark)
    universe = provider_feed.feed_universe(case.documents, case.attentions, case.claims, "2025-06-05 12:00:00", "2025-06-10 12:00:00", CONFIG)
    units = frame(spark, "id_origen string, id_persona string, id_unidad_asegurable string, fec_inicio_vigencia date, fec_fin_vigencia date", [])
    letters = frame(spark, "periodo date, id_siniestro string, num_carta_garantia bigint, num_carta_garantia_origen string, num_documento_proveedor string, mnt_carta_garantia_total double, "
                           "des_est_carta_garantia_origen string, carta_garantia_version array<struct<fec_aprobacion: date>>", [])
    enriched = provider_feed.enrich_feed(universe, case.claims, lookups.self_insured(spark), units, letters, frame(spark, AUTHORISATIONS, []), CONFIG)
    prepared = duplicates.prepare_provider_invoices(enriched, ["monto_factura_ocr"])
    assert prepared.count() == 1
    none = frame(spark, "num_factura_documento_ocr string, flag_dup int, factura_duplicada string, fec_atencion date, num_siniestro string, dsc_dup string, dsc_abono string, estado_procesado string, monto_duplicado double", [])
    flagged = provider_feed.feed_flags(duplicates.attach_duplicates(enriched, none), CONFIG.today_column())
    alerts = provider_feed.provider_alerts(flagged).collect()
    assert [(a["reglas_mensaje"], a["grupo_clinica_texto"]) for a in alerts] == [("Factura OK", "CENTRAL")]
