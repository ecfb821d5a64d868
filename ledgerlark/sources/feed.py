"""Typed views of the flat claim feed, where every column arrives as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import feed_date
from ..functions.money import CURRENCIES
from ..functions.text import label_map
from ..operators.dedup import latest_batch, newest_batch_then_earliest

KEYS = ["RUCIPRESS", "NUMERODOCUMENTOPAGO"]


def _ties(df: DataFrame) -> list[str]:
    """Every remaining column, so that equal lots are resolved the same way every time."""
    return [c for c in sorted(df.columns) if c not in KEYS and c != "CODIGOLOTE"]


def invoice_feed(documents: DataFrame) -> DataFrame:
    latest = latest_batch(documents, KEYS, "CODIGOLOTE", _ties(documents))
    return latest.select(
        F.col("NUMERODOCUMENTOPAGO").alias("numero_de_documento_de_pago"),
        feed_date(F.col("FECHAEMISION")).alias("fecha_emision_tramas"),
        F.col("CODIGOPRODUCTO").alias("codigoproducto"),
        F.col("RUCIPRESS").alias("ruc_tramas"),
        label_map(F.col("TIPOMONEDA"), CURRENCIES, F.col("TIPOMONEDA")).alias("tipo_moneda_tramas"),
        F.col("MONTOTOTAL").try_cast("double").alias("importe_total_tramas"),
        F.col("MONTOIGV").try_cast("double").alias("igv_tramas"),
        F.col("MONTONETO").try_cast("double").alias("subtotal_tramas"),
        F.col("CODIGOMECANISMOPAGO").alias("descripcion_tramas"),
    )


def attention_feed(attentions: DataFrame) -> DataFrame:
    dated = attentions.withColumn("fecha_de_prestacion", feed_date(F.col("FECHAINICIOATENCION")))
    latest = newest_batch_then_earliest(dated, KEYS, "CODIGOLOTE", "fecha_de_prestacion", _ties(attentions))
    return latest.select(
        "RUCIPRESS",
        F.col("TIPODOCUMENTOIDENTIDAD").alias("tipo_de_documento_de_identidad"),
        F.col("NUMERODOCUMENTOPAGO").alias("num_factura_trama_sited"),
        F.col("NUMEROAUTORIZACION").alias("numero_del_documento_de_autorizacion"),
        F.col("NUMERODOCUMENTOIDENTIDAD").alias("numero_del_documento_de_identidad"),
        "fecha_de_prestacion", "TIPOCOBERTURA", "CODIGOPROFESIONALATENCION", "TIPOAFILIACIONPACIENTE",
        "CODIGOCIE101", "CODIGOCIE102", "CODIGOCIE103",
    )


def credit_note_feed(documents: DataFrame) -> DataFrame:
    latest = latest_batch(documents, KEYS, "CODIGOLOTE", _ties(documents))
    return latest.select(
        F.col("NUMERODOCUMENTOPAGO").alias("numero_de_documento_de_pago"),
        "TIPONOTA", "NUMERONOTA",
        F.col("MONTONOTA").try_cast("double").alias("MONTONOTA"),
        feed_date(F.col("FECHANOTA")).alias("FECHANOTA"),
        "MOTIVONOTA", "FECHAPRIMERENVIO",
        F.col("RUCIPRESS").alias("ruc_tramaNC"),
    )


def letter_feed(attentions: DataFrame) -> DataFrame:
    """Attentions authorised by a guarantee letter as first or second document."""
    dated = attentions.withColumn("fecha_de_prestacion", feed_date(F.col("FECHAINICIOATENCION")))
    latest = newest_batch_then_earliest(dated, KEYS, "CODIGOLOTE", "fecha_de_prestacion", _ties(attentions))
    by_letter = (F.col("TIPODOCUMENTOPRESTACION").isin("3", "03") | F.col("SEGUNDOTIPOAUTORIZACION").isin("3", "03"))
    return latest.where(by_letter).select(
        F.col("RUCIPRESS").alias("ruc_tramaCG"),
        F.col("TIPODOCUMENTOIDENTIDAD").alias("tipo_de_documento_de_identidad"),
        F.col("NUMERODOCUMENTOPAGO").alias("num_factura_trama_carta"),
        F.col("TIPODOCUMENTOPRESTACION").alias("primer_tipo_doc_autorizacion"),
        F.col("NUMEROAUTORIZACION").alias("numero_del_documento_de_autorizacion"),
        F.col("SEGUNDOTIPOAUTORIZACION").alias("seg_tipo_doc_autorizacion"),
        F.col("SEGUNDONROAUTORIZACION").alias("seg_numero_del_documento_de_autorizacion"),
        F.col("NUMERODOCUMENTOIDENTIDAD").alias("numero_del_documento_de_identidad"),
        "fecha_de_prestacion", "TIPOCOBERTURA", "CODIGOPROFESIONALATENCION", "TIPOAFILIACIONPACIENTE",
    )


def read_claim_feed(kind: str, documents: DataFrame | None = None, attentions: DataFrame | None = None) -> DataFrame:
    """kind: 'invoice', 'attention', 'credit_note' or 'guarantee_letter'."""
    if kind == "invoice":
        return invoice_feed(documents)
    if kind == "credit_note":
        return credit_note_feed(documents)
    return {"attention": attention_feed, "guarantee_letter": letter_feed}[kind](attentions)
