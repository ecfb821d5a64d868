"""Declared schemas: scanned documents, flat feed, claims mart, readings, agent traces.

A schema is written as groups of field names by type; order and names are the table
contract.  ``insurer`` prefixes the two insurer columns of the guarantee letter.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names and types of the table contracts ------------------

KINDS = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "numeric": T.DecimalType(38, 9), "cost": T.DecimalType(18, 6),
}


def _of(kind: str, names: str) -> list[T.StructField]:
    return [T.StructField(n, KINDS[kind]) for n in names.split()]


def text(names: str) -> list[T.StructField]:
    return _of("string", names)


def number(names: str) -> list[T.StructField]:
    return _of("numeric", names)


def struct(*groups: list[T.StructField]) -> T.StructType:
    return T.StructType([f for g in groups for f in g])


def array(element: T.DataType | str) -> T.ArrayType:
    return T.ArrayType(KINDS[element] if isinstance(element, str) else element)


def field(name: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, KINDS[kind] if isinstance(kind, str) else kind)]


table = struct

_DOCUMENT = text("documento_id page_path")
_ADDRESS = struct(text("calle distrito provincia departamento"))
_DIAGNOSES = array(struct(text("tipo cie10 detalle etapa")))
_SHORT_DIAGNOSES = array(struct(text("cie10 detalle")))
_DOCTOR = struct(text("nomb_doctor lugar fecha num_colegiado"))

INVOICE = table(
    _DOCUMENT,
    field("emisor", struct(text("nombre ruc"), field("direccion", _ADDRESS))),
    field("receptor", struct(text("nombre_senior ruc"), field("direccion", _ADDRESS))),
    field("paciente", struct(text("nombre_completo dni"), field("direccion", _ADDRESS),
                             text("titular compania codigo_autorizacion carta observacion"))),
    field("cabecera", struct(text("numero_factura fecha_emision"))),
    field("info_seguro", struct(text("empresa condiciones_pago numero_expediente historia_clinica_hc encuentro poliza"))),
    field("items", array(struct(text("descripcion"), number("cantidad"), text("unidad_medida"),
                                number("precio_unitario descuento valor_venta")))),
    field("totales", struct(number("icper igv importe_total operaciones_exoneradas operaciones_gratuitas operaciones_gravadas "
                                   "operaciones_inafectas subtotal total_descuentos total_venta"))),
    field("importe", struct(number("monto"), text("tipo_moneda"))),
    text("importe_letras"),
)

AUTHORISATION = table(
    _DOCUMENT,
    field("cabecera", struct(text("numero_orden producto"))),
    field("paciente", struct(text("nombre_completo parentesco sexo"), _of("bigint", "edad"),
                             text("tipo_documento num_documento inicio_vigencia num_solicitud_origen fin_vigencia fecha_nacimiento "
                                  "num_decl_accidente estado estado_civil num_poliza tipo_moneda"))),
    field("titular", struct(text("nombre_completo tipo_documento num_documento tipo_afiliacion numero_plan plan_salud contratante"))),
    field("metadata", struct(text("fecha_hora_autorizacion fecha_hora_impresion"))),
    field("beneficio_autorizado", struct(text("codigo nombre restricciones copago_fijo copago_variable fin_carencia observacion"))),
    field("procedimiento_copago", struct(text("codigo procedimiento sexo"), number("copago_fijo"), text("copago_variable"),
                                         _of("bigint", "frecuencia"),
                                         text("tiempo_dias observaciones observaciones_asegurado observaciones_adicionales"))),
    field("datos_clinicos", struct(text("sintomas_signos tiempo_enfermedad antecedentes num_consultas fechas_consultas"))),
    field("diagnosticos", array(struct(text("codigo descripcion")))),
    field("visacion_medico", struct(text("nombre codigo_cmp"))),
)

CREDIT_NOTE = table(
    _DOCUMENT,
    field("encabezado", struct(text("empresa direccion"))),
    field("recuadro", struct(text("ruc titulo codigo codigo_2 fecha"))),
    field("info_principal", struct(text("nomb_receptor ruc_receptor dir_receptor nomb_paciente dni_paciente carta_paciente "
                                        "ref_tipo_doc ref_nro cond_pago encuentro"))),
    field("resumen", struct(text("importe_total_str"),
                            number("subtotal op_gravada op_inafecta op_exonerada op_gratuita igv icpber total_venta descuento importe_total"))),
)

_PRE_ITEM = struct(text("codigo descripcion fec_registro"), number("cantidad precio_unitario importe igv paciente facturar"))
PRE_SETTLEMENT = table(
    _DOCUMENT,
    field("cabecera", struct(text("titulo sede garante empresa"), number("deducible coaseguro"),
                             text("num_autoriz paciente titular tratante hist_clin num_cama fec_ingreso fec_alta num_encuentro beneficio"))),
    field("subgrupos", array(struct(text("categoria"), field("items", array(_PRE_ITEM)),
                                    field("subtotal", struct(number("precio_unitario importe paciente facturar")))))),
    field("gastos_afectos", struct(number("total coaseguro_paciente garante monto_afecto igv total_facturar"))),
    field("gastos_inafectos", struct(number("total coaseguro_paciente garante"))),
)

SETTLEMENT_SUMMARY = table(
    _DOCUMENT,
    field("cabecera", struct(text("titulo sede garante empresa"), number("deducible coaseguro"),
                             text("num_autoriz paciente titular tratante hist_clin num_cama fec_ingreso fec_alta num_encuentro beneficio mecanismo"),
                             number("monto_cpm"), text("tipo_moneda"))),
    field("calculo_cpm", struct(number("cpm cpm_igv total_deducible total_coaseguros total_facturar"))),
)

_ITEM_HEAD = text("codigo descripcion fec_registro")
_ITEM_AMOUNTS = "cantidad precio_unitario importe igv coaseguro paciente"
SETTLEMENT_TYPE_1 = table(
    _DOCUMENT,
    field("cabecera", struct(text("titulo sede garante empresa"), number("deducible coaseguro"),
                             text("num_autoriz paciente titular tratante hist_clin fec_ingreso fec_alta num_encuentro beneficio mecanismo"),
                             number("monto_cpm"), text("tipo_moneda"))),
    field("subgrupos", array(struct(text("categoria"),
                                    field("items", array(struct(_ITEM_HEAD, number(f"{_ITEM_AMOUNTS} importe_garante")))),
                                    field("subtotal", struct(number("precio_unitario importe paciente importe_garante")))))),
    field("gastos_afectos", struct(number("total_garante deducible_igv coaseguro_igv"))),
    field("gastos_inafectos", struct(number("total_garante coaseguro"))),
)

SETTLEMENT_TYPE_2 = table(
    _DOCUMENT,
    field("cabecera", struct(text("titulo garante num_factura empresa deducible num_autoriz paciente titular tratante beneficio hist_clin "
                                  "fec_ingreso coaseguro num_encuentro fec_alta mecanismo num_documento"))),
    field("subgrupos", array(struct(text("categoria"),
                                    field("items", array(struct(_ITEM_HEAD, number(f"{_ITEM_AMOUNTS} total_inafectos total_afectos")))),
                                    field("subtotal", struct(number("precio_unitario importe paciente total_inafectos total_afectos")))))),
    field("gastos_afectos", struct(number("subtotal_1 deducible_igv subtotal_2 coaseguro_igv subtotal_3 igv total_facturar"))),
    field("gastos_inafectos", struct(number("subtotal_1 coaseguro total_garante"))),
)

# One layout for the three kinds of settlement sheet.
SETTLEMENT = table(
    _DOCUMENT,
    field("cabecera", struct(text("titulo sede garante empresa deducible coaseguro num_autoriz paciente titular tratante hist_clin num_cama "
                                  "fec_ingreso fec_alta num_encuentro beneficio mecanismo"),
                             number("monto_cpm"), text("tipo_moneda num_documento num_factura"))),
    field("calculo_cpm", struct(number("cpm cpm_igv total_deducible total_coaseguros total_facturar"))),
    field("subgrupos", array(struct(text("categoria"),
                                    field("items", array(struct(_ITEM_HEAD, number(f"{_ITEM_AMOUNTS} importe_garante total_inafectos total_afectos")))),
                                    field("subtotal", struct(number("precio_unitario importe paciente importe_garante total_inafectos total_afectos")))))),
    field("gastos_afectos", struct(number("total_garante subtotal_1 deducible_igv subtotal_2 coaseguro_igv subtotal_3 igv total_facturar"))),
    field("gastos_inafectos", struct(number("total_garante subtotal_1 coaseguro"))),
    field("created_at", "timestamp_ntz"),
    text("type"),
)


def guarantee_letter(insurer: str = "insurer") -> T.StructType:
    return table(
        _DOCUMENT,
        field("encabezado", struct(text("titulo proveedor_ruc proveedor_nombre usuario compania nro_carta fec_emision fec_val_sol"))),
        field("info_contratante", struct(text("nro_contrato fec_inic_vig razon_social titular"))),
        field("info_paciente", struct(text("ape_paterno ape_materno nombres nro_carnet cod_afiliado fec_nacimiento"), number("edad"),
                                      text("sexo parentesco obs_asegurado"))),
        field("informe_medico", struct(text("proc_medico diagnostico"))),
        field("limites_garantizados", struct(text("cobertura deducible"), number("cubierto"), text("monto_total monto_acumulado nota"))),
        field("observaciones", struct(text(f"observaciones {insurer}_empresa {insurer}_ruc"))),
        field("firma", struct(text("lugar_fecha auditor_admin"))),
    )


DISCHARGE_SUMMARY = table(
    _DOCUMENT,
    field("encabezado", struct(text("titulo direccion"), field("encuentros", array("string")))),
    field("info_ingreso", struct(text("paciente fec_ingreso servicio hora_ingreso cama nhc resumen complicaciones"),
                                 field("diagnosticos_ingreso", _SHORT_DIAGNOSES), field("proc_realizados", array("string")))),
    field("info_egreso", struct(text("fec_egreso hora_egreso"), number("estadia"), text("tipo_alta condicion_alta pronostico medico_tratante"),
                                field("diagnosticos_salida", struct(text("diagnostico_principal"), field("diagnosticos_salida", _DIAGNOSES))))),
    field("firma", _DOCTOR),
)

PRESCRIPTION = table(
    _DOCUMENT,
    field("encabezado", struct(text("titulo direccion fecha hora"))),
    field("info_principal", struct(text("episodio nhc poliza edad aseguradora empleadora"), number("deducible"),
                                   text("especialidad rne medico preexistencias"), field("diagnosticos", _DIAGNOSES))),
    field("medicamentos", array(struct(text("fec_inicio nomb_generico dosis frec"), number("dias cant_total"), text("via indicaciones")))),
    field("firma", _DOCTOR),
)

PHARMACY_ATTENTION = table(
    _DOCUMENT,
    field("encabezado", struct(text("titulo direccion fecha hora"))),
    field("info_principal", struct(text("usuario num_guia episodio nhc poliza dni aseguradora empleadora deducible especialidad rne medico coaseguro cie10"))),
    field("medicamentos", array(struct(text("dci_generico medicamento u_m dosis"), _of("double", "cantidad"), text("via estado")))),
    field("firma", struct(text("dni telf"))),
)

OPERATORY_REPORT = table(
    _DOCUMENT,
    field("encabezado", struct(text("titulo direccion"), field("encuentros", array("string")))),
    field("info_principal", struct(text("paciente nhc"), _of("double", "edad"), text("sexo servicio cama"))),
    field("info_proceso", struct(field("diagnostico_pre", _SHORT_DIAGNOSES), field("diagnostico_post", _SHORT_DIAGNOSES),
                                 field("cirugias_programadas", array("string")), field("cirugias_realizadas", array("string")),
                                 text("medico_responsable anestesiologo primer_ayudante segundo_ayudante tercer_ayudante instrumentista circulante "
                                      "perfusionista neonatologo tipo_anestesia hora_inicio hora_termino lateralidad hallaz_operat descrip_proced complicaciones"))),
    field("info_detalle", struct(_of("double", "vol_sangrado"),
                                 text("solicitud_ap_1 solicitud_ap_2 ctj_gas_compl congelacion_1 congelacion_2 ctj_inst_compl cultivo_1 cultivo_2 "
                                      "estado_hemo info_familiar destino_paciente"))),
    field("firma", _DOCTOR),
)

DOCUMENT_HEADER = table(text("id invoice_number file_name file_path processed_date cutt_off_date batch_name"), field("created_at", "timestamp_ntz"))

FEED_DOCUMENT = table(text(
    "RUCIPRESS NUMERODOCUMENTOPAGO CODIGOLOTE NUMEROLOTE FECHAEMISION FECHAENVIO CODIGOPRODUCTO TIPOMONEDA MONTOTOTAL MONTOIGV MONTONETO "
    "CODIGOMECANISMOPAGO CODIGOFINANCIADOR TIPONOTA NUMERONOTA MONTONOTA FECHANOTA MOTIVONOTA FECHAPRIMERENVIO"))
FEED_ATTENTION = table(text(
    "RUCIPRESS NUMERODOCUMENTOPAGO CODIGOLOTE TIPODOCUMENTOIDENTIDAD NUMERODOCUMENTOIDENTIDAD TIPODOCUMENTOPRESTACION NUMEROAUTORIZACION "
    "SEGUNDOTIPOAUTORIZACION SEGUNDONROAUTORIZACION FECHAINICIOATENCION TIPOCOBERTURA CODIGOPROFESIONALATENCION TIPOAFILIACIONPACIENTE "
    "CODIGOCIE101 CODIGOCIE102 CODIGOCIE103"))

CLAIM = table(
    _of("date", "periodo"),
    text("id_siniestro id_siniestro_origen num_siniestro id_autorizacion id_poliza num_poliza id_producto cod_producto_origen des_producto "
         "des_producto_agrupado id_contratante num_documento_contratante nom_completo_contratante id_persona_afiliado num_documento_afiliado "
         "nom_completo_afiliado id_persona_proveedor_siniestro num_documento_proveedor_siniestro nom_completo_proveedor_siniestro "
         "nom_comercial_proveedor_siniestro nom_sede_proveedor_siniestro cod_sede_proveedor_siniestro cod_serie_comprobante_siniestro "
         "num_comprobante_siniestro"),
    _of("date", "fec_comprobante_siniestro"), _of("timestamp_ntz", "fec_hora_ocurrencia fec_notificacion fec_ult_liquidacion"),
    text("num_obligacion"), _of("bigint", "num_carta_garantia"), _of("double", "mto_auditado_sol mnt_pagar_base mnt_nota_credito"),
    text("id_estado_siniestro_origen des_estado_siniestro_origen tip_reclamo tip_caso_especial ind_trama_tedef cod_mecanismo_pago des_mecanismo_pago"),
    _of("bigint", "cod_tipo_contrato"),
    field("atencion_salud", array(struct(
        _of("bigint", "num_correlativo_atencion"),
        text("id_cobertura_origen des_cobertura agrupacion_cobertura_negocio num_diagnostico_origen des_diagnostico_salud"),
        _of("double", "mnt_beneficio_sin_impuesto_aprobado_sol mnt_impuesto_aprobado_sol"),
        field("procedimiento_salud", array(struct(field("detalle_farmacia_insumo", array(struct(text("id")))))))))),
    field("grupo_devolucion", array(struct(_of("bigint", "num_correlativo_devolucion cod_motivo_devolucion"),
                                           text("des_cod_motivo_devolucion des_cod_grupo_devolucion"), _of("date", "fec_devolucion_siniestro")))),
    field("diagnostico_principal", array(struct(text("id_cobertura_principal des_cobertura_principal num_diagnostico_principal des_diagnostico_principal")))),
)

READING = table(text("READING_DATETIME STATION_ID"), _of("double", "VELO HUME TEMP"))
TARGET = table(text("READING_DATETIME STATION_ID"), _of("double", "N_PM25"))
PREDICTION = table(_of("timestamp_ntz", "READING_DATETIME"), text("STATION_ID"), _of("double", "prediction"))

TRACE = table(
    text("idtrace idconversation codagent nmagent nmowner nmsquad codidentity descidentitytype coddomain codsubdomain nmmodel nmtool"),
    _of("boolean", "flgsuccess"), _of("int", "amntdurationms qtyintoken qtyouttoken"),
    _of("cost", "amntcostin amntcostout"), _of("timestamp_ntz", "tsstart"),
)
# --- end of fixed values -----------------------------------------------------------

DOCUMENTS = {
    "INVOICE_IMPORT": INVOICE,
    "SITED_IMPORT_KEY": AUTHORISATION,
    "CREDIT_NOTE_KEY": CREDIT_NOTE,
    "PRE_SETTLEMENT_KEY": PRE_SETTLEMENT,
    "SETTLEMENT_SUMMARY_KEY": SETTLEMENT_SUMMARY,
    "SETTLEMENT_TYPE_1_KEY": SETTLEMENT_TYPE_1,
    "SETTLEMENT_TYPE_2_KEY": SETTLEMENT_TYPE_2,
    "GUARANTEE_LETTER_KEY": guarantee_letter(),
    "EPICRISIS_KEY": DISCHARGE_SUMMARY,
    "PRESCRIPTION_KEY": PRESCRIPTION,
    "PHARMACY_ATTENTION_KEY": PHARMACY_ATTENTION,
    "OPERATORY_REPORT_KEY": OPERATORY_REPORT,
}
